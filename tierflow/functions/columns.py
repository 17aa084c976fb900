"""Small column builders shared by all layers. Everything stays a JVM expression."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_TOKEN = "_null_"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division as double; null when the denominator is zero or null."""
    return as_col(numerator).cast("double") / F.nullif(as_col(denominator).cast("double"), F.lit(0.0))


def rounded(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a double that ignores the last bits, so that summation order cannot flip a tie."""
    scale = float(10**digits)
    return F.floor(as_col(c).cast("double") * F.lit(scale) + F.lit(0.50001)) / F.lit(scale)


def money(c: Column | str, scale: int = 2) -> Column:
    return as_col(c).cast(f"decimal(15,{scale})")


def concat_key(*cols: Column | str) -> Column:
    """MD5 of the plain concatenation; null if any part is null, and parts may run into each other."""
    return F.md5(F.concat(*[as_col(c).cast("string") for c in cols]))


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 of the parts joined by '-', nulls replaced by a token, so that different parts give different keys."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def sha256(c: Column | str) -> Column:
    return F.sha2(as_col(c).cast("string"), 256)


def parse_variant(df: DataFrame, raw: str, fields: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns of a variant, read in one go; a missing path or a wrong type gives null in that field."""
    shape = "struct<" + ", ".join(f"{name}: {kind}" for name, kind in fields.items()) + ">"
    return df.select(*keep, F.try_variant_get(raw, "$", shape).alias("_parsed")).select(*keep, "_parsed.*")


def one_of(c: Column | str, values: Sequence[str]) -> Column:
    return as_col(c).isin(list(values))


def case_map(c: Column | str, mapping: Mapping, default=None) -> Column:
    """A CASE over a short fixed list."""
    out = None
    for key, value in mapping.items():
        hit = as_col(c) == F.lit(key)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def newest(df: DataFrame, c: str, shift: Callable[[Column], Column] = lambda m: m) -> Column:
    """Scalar subquery: the largest value of a column, shifted inside the subquery.

    Compared bare with a raw column, the subquery's value is pushed into the file scan.
    """
    return df.agg(F.max(c).alias("m")).select(shift(F.col("m")).alias("m")).scalar()


def calendar_date(c: Column | str, unit: str) -> Column:
    """Start of the week, month, quarter or year as a date."""
    return F.trunc(as_col(c).cast("date"), unit)


def hour_of(c: Column | str) -> Column:
    """Start of the hour as timestamp without zone."""
    return F.date_trunc("hour", as_col(c)).cast("timestamp_ntz")


def minutes_between(earlier: Column | str, later: Column | str) -> Column:
    gap = F.unix_micros(as_col(later).cast("timestamp")) - F.unix_micros(as_col(earlier).cast("timestamp"))
    return gap / F.lit(60_000_000.0)


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    dp = F.radians(as_col(lat2) - as_col(lat1))
    dl = F.radians(as_col(lon2) - as_col(lon1))
    h = F.pow(F.sin(dp / 2), F.lit(2)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), F.lit(2))
    return F.lit(2 * 6371008.8) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity of two equally long arrays, in double precision."""

    def dot(x, y):
        products = F.zip_with(as_col(x), as_col(y), lambda l, r: l.cast("double") * r.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))
