"""Secret scanning with linking of multipart credentials, in DataFrame functions only.

Strong forms (assignments of passwords and keys, access ids, long hex strings) are reported wherever they stand. Weak
forms (account names, endpoints, mixed strings of letters and digits) are parts: each alone is ordinary text. Parts of
one text are joined by interval: a weak part is reported only when the complementary parts stand within its scope.

Spark has no function for the offsets of all matches. Each pattern therefore sets a mark before and after its matches;
the lengths of the stretches between marks, summed up, are the offsets in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.base import fresh, stored

#: Code points between parts of one credential at most.
SCOPE = 200
#: Marks of matches, and what stands for that character in a text that holds it; no pattern knows either.
_MARK, _OTHER = "\ue000", "\ue001"


@dataclass(frozen=True)
class Kind:
    """A pattern, the group whose length counts (0: the whole match), that least length, a pattern that every text with
    a counting match holds, and what a counting match must hold besides."""

    name: str
    pattern: str
    group: int
    least: int
    quick: str
    holds: tuple[str, ...] = ()


_ASSIGNED = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_NAMED = r"""(?i)(user_?name|user|login|client_?id|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)"""
_SERVED = r"""(?i)(https?|jdbc:[a-z]+|postgres|mysql|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""
# The strong forms.
STRONG = (
    Kind("assign", _ASSIGNED, 2, 6, _ASSIGNED),
    # A run that begins too short is too short from any later place too: the least length can stand in the pattern.
    Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20, r"AKIA[A-Z0-9]{16}"),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
)
#: The parts: an identifier, a secret and an endpoint.
WEAK = (
    Kind("identity", _NAMED, 2, 3, _NAMED),
    Kind("key", r"[A-Za-z0-9+_-]{16,}", 0, 16, r"[A-Za-z0-9+_-]{16}", ("[0-9]", "[a-z]", "[A-Z]")),
    Kind("endpoint", _SERVED, 0, 8, "://"),
)
KINDS = (*STRONG, *WEAK)
_NAMES = [k.name for k in KINDS]
_ASSIGN, _ACCESS, _HEX, _IDENTITY, _KEY, _ENDPOINT = range(len(KINDS))


def _stretches(text: Column, number: int, kind: Kind) -> Column:
    """array<struct<kind, i, size, counts>> of the stretches between marks; a match has an odd ``i``."""
    pieces = F.split(F.regexp_replace(text, kind.pattern, f"{_MARK}$0{_MARK}"), _MARK)

    def stretch(piece: Column, i: Column) -> Column:
        tested = F.regexp_extract(piece, kind.pattern, kind.group) if kind.group else piece
        counts = (i % 2 == 1) & (F.char_length(tested) >= kind.least)
        for needed in kind.holds:
            counts = counts & piece.rlike(needed)
        return F.struct(
            F.lit(number).alias("kind"), i.alias("i"), F.char_length(piece).alias("size"), counts.alias("counts")
        )

    none = F.array().cast("array<struct<kind:int,i:int,size:int,counts:boolean>>")
    return F.when(text.rlike(kind.quick), F.transform(pieces, stretch)).otherwise(none)


def found_parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (row, id, text_key, kind, start, end) of all matches, and one of kind -1 for every text."""
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(_MARK), F.lit(_OTHER))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
        text.alias("text"),
    )
    own = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(1).alias("i"), F.lit(0).alias("size"), F.lit(True).alias("counts")))
    every = F.concat(own, *[_stretches(F.col("text"), n, kind) for n, kind in enumerate(KINDS)])
    stretches = stored(numbered.select("row", "id", "text_key", F.inline(every)), "secret-stretches")
    before = Window.partitionBy("row", "kind").orderBy("i")
    placed = stretches.withColumn("end", F.sum("size").over(before))
    placed = placed.where((F.col("i") % 2 == 1) & F.col("counts"))
    return placed.select("row", "id", "text_key", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts (row, kind, start, end) with their complements within ``scope``.

    An interval join: a part stands in every bin of ``scope`` code points that it touches, a weak part also looks into
    the bins within reach, and pairs of one bin are compared by their gap. An identity needs a secret, a key needs an
    identity or an access id, an endpoint needs both. A key that overlaps a strong span or an identity is not counted.
    """
    bins = lambda low, high: F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope)))
    some = parts.where(F.col("kind") >= 0)
    near = some.select(
        F.col("row").alias("r"), F.col("kind").alias("k"), F.col("start").alias("s"), F.col("end").alias("e"),
        bins(F.col("start"), F.col("end")).alias("b"),
    )
    weak = some.where(F.col("kind") >= _IDENTITY).select(
        "row", "kind", "start", "end", bins(F.greatest(F.lit(0), F.col("start") - scope), F.col("end") + scope).alias("bin")
    )
    gap = F.greatest(F.col("s") - F.col("end"), F.col("start") - F.col("e"))
    same = (F.col("k") == F.col("kind")) & (F.col("s") == F.col("start"))
    pairs = weak.join(near, (F.col("row") == F.col("r")) & (F.col("bin") == F.col("b"))).where((gap <= scope) & ~same)
    touching = gap < 0
    is_id = F.col("k").isin(_IDENTITY, _ACCESS) & ~touching
    is_secret = F.col("k").isin(_ASSIGN, _HEX, _KEY) & ~touching
    covered = touching & F.col("k").isin(_ASSIGN, _ACCESS, _HEX, _IDENTITY, _ENDPOINT) & (F.col("kind") == _KEY)
    judged = pairs.groupBy("row", "kind", "start", "end").agg(
        F.max(is_id).alias("with_id"), F.max(is_secret).alias("with_secret"), F.max(covered).alias("covered")
    )
    holds = (
        F.when(F.col("kind") == _IDENTITY, F.col("with_secret"))
        .when(F.col("kind") == _KEY, F.col("with_id") & ~F.col("covered"))
        .otherwise(F.col("with_id") & F.col("with_secret"))
    )
    return judged.where(holds).select("row", "kind", "start", "end")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row a text: row, id, text_key, and spans, an array of (start, kind, end) by start and kind.

    Kinds are numbers into ``KINDS``; offsets are code points, the end exclusive. A null text counts as empty and has no
    spans. Repeated rows and repeated or null ids give a row each; ``text_key`` (XXH64 of the text) tells them apart.
    Only the id and text columns are read. An empty table gives no rows.
    """
    parts = found_parts(docs, id_col, text_col)
    weak = linked(parts, scope).select(
        "row", F.lit(None).cast(docs.schema[id_col].dataType).alias("id"), F.lit(None).cast("long").alias("text_key"),
        "kind", "start", "end",
    )
    kept = parts.where(F.col("kind") < _IDENTITY).unionByName(weak)
    span = F.when(F.col("kind") >= 0, F.struct(F.col("start").cast("long").alias("start"), "kind", F.col("end").cast("long").alias("end")))
    return kept.groupBy("row").agg(
        F.max(F.when(F.col("kind") < 0, F.col("id"))).alias("id"),
        F.max(F.when(F.col("kind") < 0, F.col("text_key"))).alias("text_key"),
        F.array_sort(F.collect_list(span)).alias("spans"),
    )


def described(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(n) for n in _NAMES])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per text: counts of the strong kinds, their digest, and all spans as a string."""
    strong = F.filter("spans", lambda s: s["kind"] < _IDENTITY)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return scan(docs, id_col, text_col, scope).select(
        F.col("id").alias(id_col),
        count(_ASSIGN).alias("n_assign"),
        count(_ACCESS).alias("n_access"),
        count(_HEX).alias("n_hex"),
        F.sha2(described(strong).cast("binary"), 256).alias("base_sha256"),
        described(F.col("spans")).alias("spans"),
    )


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with every stretch that spans cover replaced by one ``mask``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, (done["at"] + 1).cast("int"), F.greatest(F.lit(0), s["start"] - done["at"]).cast("int"))
        added = F.when(s["start"] >= done["at"], F.concat(done["out"], between, F.lit(mask))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), added.alias("out"))

    rest = lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.lit(2147483647)))
    return F.aggregate(spans, start, step, rest)


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with reported spans masked in the text; every row stays, texts without spans unchanged.

    Spans are matched to rows by id and text, so that repeated ids with other texts are not mixed up. Null texts stay null.
    """
    hits = scan(docs, id_col, text_col).where(F.size("spans") > 0).select("id", "text_key", "spans").dropDuplicates(["id", "text_key"])
    id_, key, spans = fresh(docs, "hit_id", "hit_key", "hit_spans")
    hits = hits.toDF(id_, key, spans)
    on = F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(key))
    joined = docs.join(hits, on, "left")
    changed = F.when(F.col(spans).isNotNull(), _masked(F.col(text_col), F.col(spans), mask)).otherwise(F.col(text_col))
    return joined.withColumn(text_col, changed).select(*docs.columns)
