"""Metrics by dimensions: a small model of tables, dimensions, facts and metrics over many-to-one joins.

``query`` joins only the tables that the named dimensions need, groups by the dimensions and aggregates the
metrics. Metrics of several tables are aggregated each at its own grain and only then put side by side, so that no fact is
counted once for every row of another. A parent joins once for each row of its child: where a parent's key repeats, the
query is refused, or one row a key is taken if asked. Names are unique across the model; columns are given as functions so
that a model needs no session.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W

from tierflow.operators.joining import cardinality_breaches

Expr = Callable[[], Column]


@dataclass(frozen=True)
class Table:
    frame: Callable[..., DataFrame]
    primary_key: tuple[str, ...] = ()
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``child`` refer to one row of ``parent``."""

    child: str
    child_key: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class Dimension:
    table: str
    expr: Expr
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Fact:
    table: str
    expr: Expr


@dataclass(frozen=True)
class Metric:
    """``expr`` aggregates rows of ``table``. With ``per`` it aggregates ``inner`` results, one per key."""

    table: str
    expr: Expr
    per: tuple[str, ...] = ()
    inner: Mapping[str, Expr] = field(default_factory=dict)
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Derived:
    """An expression over other metrics, computed after aggregation."""

    metrics: tuple[str, ...]
    expr: Expr


@dataclass(frozen=True)
class WindowMetric:
    """A window over an aggregated metric; partitions by the queried dimensions except ``excluding``."""

    metric: str
    excluding: tuple[str, ...]
    order_by: str
    expr: Callable[[Column, object], Column]
    order_expr: Expr | None = None


@dataclass
class Model:
    tables: dict[str, Table]
    relationships: list[Relationship]
    dimensions: dict[str, Dimension]
    facts: dict[str, Fact]
    metrics: dict[str, Metric | Derived | WindowMetric]

    def resolve(self, name: str) -> str:
        """The model name for a name or synonym."""
        for group in (self.dimensions, self.facts, self.metrics):
            if name in group:
                return name
            for known, item in group.items():
                if name in getattr(item, "synonyms", ()):
                    return known
        raise ValueError(f"unknown name {name}")

    def required_dimensions(self, metric: str) -> list[str]:
        m = self.metrics[metric]
        return sorted({*m.excluding, m.order_by}) if isinstance(m, WindowMetric) else []


class RepeatedKey(ValueError):
    """A parent has several rows of one key, so that a join would multiply the rows of its children."""


def _parents(model: Model, source, rels: Sequence[Relationship], repeated: str) -> dict[str, DataFrame]:
    """The rows of the parents, one a key; all keys are checked in one job that reads the key columns."""
    from pyspark.sql import functions as F

    found, breaches = {}, []
    for rel in rels:
        rows, key = model.tables[rel.parent].frame(source), rel.parent_key
        if repeated == "first":
            # Of the rows of a key the smallest by all its columns, in one aggregation.
            others = [c for c in rows.columns if c != key]
            least = rows.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")) if others else rows.distinct()
            rows = least.select(key, "_row.*") if others else least
        elif repeated == "refuse" or model.tables[rel.parent].primary_key != (key,):
            # A key that is null joins with nothing and may repeat.
            twice = cardinality_breaches(rows.where(F.col(key).isNotNull()), [key])
            breaches.append(twice.limit(1).select(F.lit(rel.parent).alias("parent"), F.lit(key).alias("key")))
        found[rel.parent] = rows
    for row in reduce(DataFrame.unionByName, breaches).collect() if breaches else ():
        raise RepeatedKey(f"{row.parent} holds several rows of one {row.key}; ask with repeated='first' to take one of each")
    return found


def _joined(model: Model, source, base: str, needed: set[str], repeated: str = "refuse") -> DataFrame:
    """The base table left-joined, along the declared relationships, to every table in ``needed``."""
    from pyspark.sql import functions as F

    reach: dict[str, list[Relationship]] = {base: []}
    todo = [base]
    while todo:
        here = todo.pop(0)
        for rel in model.relationships:
            if rel.child == here and rel.parent not in reach:
                reach[rel.parent] = [*reach[here], rel]
                todo.append(rel.parent)
    missing = needed - set(reach)
    if missing:
        raise ValueError(f"{sorted(missing)} cannot be reached from {base}")
    path = list(dict.fromkeys(rel for table in sorted(needed, key=lambda n: len(reach[n])) for rel in reach[table]))
    parents = _parents(model, source, path, repeated)
    frame = model.tables[base].frame(source)
    for rel in path:
        frame = frame.join(parents[rel.parent], F.col(rel.child_key) == F.col(rel.parent_key), "left")
    return frame


def query(
    model: Model,
    source,
    dimensions: Sequence[str] = (),
    metrics: Sequence[str] = (),
    facts: Sequence[str] = (),
    where: Callable[[], Column] | None = None,
    where_dimensions: Sequence[str] = (),
    aliases: Mapping[str, str] | None = None,
    order_by: Sequence[Column] = (),
    limit: int | None = None,
    repeated: str = "refuse",
) -> DataFrame:
    """Dimensions with metrics (grouped) or with facts (row level); output columns in the order they were named.

    ``where`` filters rows on dimension names, those queried or listed in ``where_dimensions``. Metrics may belong to several tables;
    each of these must reach all dimensions, and a metric without rows in a group is null there. ``repeated`` says what
    to do about a parent with several rows of a key: "refuse" raises ``RepeatedKey``, "first" takes the smallest row, "trust" takes the parent's ``primary_key`` at its word.
    """
    from pyspark.sql import functions as F

    if not (dimensions or metrics or facts):
        raise ValueError("name at least one dimension, metric or fact")
    if facts and metrics:
        raise ValueError("facts are row level and cannot be combined with metrics")
    dims = [model.resolve(d) for d in dimensions]
    names = [model.resolve(m) for m in metrics]
    rows = [model.resolve(f) for f in facts]
    aliases = dict(aliases or {})
    filters = [model.resolve(d) for d in where_dimensions if d not in dims]

    wanted = list(names)
    for n in names:
        m = model.metrics[n]
        for r in model.required_dimensions(n):
            if r not in dims:
                raise ValueError(f"{n} needs dimension {r}")
        wanted += [m.metric] if isinstance(m, WindowMetric) else list(getattr(m, "metrics", ()))
    basic = [n for n in dict.fromkeys(wanted) if isinstance(model.metrics[n], Metric)]
    for n in wanted:
        if isinstance(model.metrics[n], Derived):
            if any(isinstance(model.metrics[x], WindowMetric) for x in model.metrics[n].metrics):
                raise ValueError(f"{n} refers to a window metric")
            basic += [x for x in model.metrics[n].metrics if x not in basic]

    tables = {model.metrics[n].table for n in basic} | {model.facts[f].table for f in rows}
    tables = tables or {model.dimensions[d].table for d in dims[:1]}
    if rows and len(tables) > 1:
        raise ValueError(f"rows are read from one table, got {sorted(tables)}")
    needed = {model.dimensions[d].table for d in [*dims, *filters]}

    def read(base: str) -> DataFrame:
        frame = _joined(model, source, base, needed, repeated)
        frame = frame.withColumns({d: model.dimensions[d].expr() for d in [*dims, *filters]}) if dims or filters else frame
        return frame.where(where()) if where else frame

    if rows:
        out = read(tables.pop()).select(*dims, *[model.facts[f].expr().alias(f) for f in rows])
    elif basic:
        grains = {base: [n for n in basic if model.metrics[n].table == base] for base in sorted(tables)}
        sides = [_aggregated(model, read(base), dims, own) for base, own in grains.items()]
        out = sides[0]
        if len(sides) > 1:
            # Each side has one row a group, so that the largest value is the only one; null groups meet too.
            every = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), sides)
            out = every.groupBy(*dims).agg(*[F.max(n).alias(n) for n in basic])
        for n in wanted:
            if isinstance(model.metrics[n], Derived):
                out = out.withColumn(n, model.metrics[n].expr())
        for n in names:
            m = model.metrics[n]
            if isinstance(m, WindowMetric):
                by = [d for d in dims if d not in m.excluding and d != m.order_by]
                w = W.partitionBy(*by).orderBy(m.order_expr() if m.order_expr else F.col(m.order_by))
                out = out.withColumn(n, m.expr(F.col(m.metric), w))
    else:
        out = read(tables.pop()).select(*dims).distinct()
    out = out.select(*[F.col(n).alias(aliases.get(n, n)) for n in [*dims, *rows, *names]])
    out = out.orderBy(*order_by) if order_by else out
    return out.limit(limit) if limit else out


def _aggregated(model: Model, frame: DataFrame, dims: list[str], names: list[str]) -> DataFrame:
    """All plain metrics in one aggregation; each nested metric in two, joined on the dimensions."""
    from pyspark.sql import functions as F

    plain = [n for n in names if not model.metrics[n].per]
    out = frame.groupBy(*dims).agg(*[model.metrics[n].expr().alias(n) for n in plain]) if plain else None
    for n in names:
        m = model.metrics[n]
        if not m.per:
            continue
        staged = frame.groupBy(*dict.fromkeys([*dims, *m.per])).agg(*[e().alias(k) for k, e in m.inner.items()])
        nested = staged.groupBy(*dims).agg(m.expr().alias(n))
        if out is None:
            out = nested
        elif not dims:
            out = out.withColumn(n, nested.scalar())
        else:
            renamed = nested.select(*[F.col(d).alias(f"_d_{d}") for d in dims], n)
            on = [F.col(d).eqNullSafe(F.col(f"_d_{d}")) for d in dims]
            out = out.join(renamed, on, "left").drop(*[f"_d_{d}" for d in dims])
    return out
