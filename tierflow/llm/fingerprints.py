"""Threshold-scaled fingerprints of documents, in DataFrame functions only.

A fingerprint keeps every word-shingle hash below a fixed fraction of the hash range. Which hashes are kept does not depend
on the document, so fingerprints of any two documents, however unequal in length, are samples of the same hashes: the share
of one found in the other estimates containment, and the fingerprint of a union is the union of fingerprints. A document
none of whose hashes falls below the threshold keeps its smallest one, so that no text with words is without a fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.base import COPIES, prepare, sliced, stored

#: Words of a shingle, and the fraction of hashes kept (one in ONE_IN).
WORDS, ONE_IN = 5, 8
#: Hexadecimal digits of the MD5 that make a hash; 15 fit into a signed long.
DIGITS = 15
#: Shingles hashed at a time, so that a long text never holds all its hashes.
BLOCK = 1 << 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def threshold(one_in: int) -> str:
    """The smallest hash that is not kept, as hexadecimal digits."""
    return f"{16**DIGITS // one_in:0{DIGITS}x}"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, wherever the lambda uses it."""
    return F.transform(F.array(value), then)[0]


def sketch_column(text: Column, words_per_shingle: int = WORDS, one_in: int = ONE_IN) -> Column:
    """The kept hashes of a text in ascending order, each once; empty for a text without words.

    Words are runs of characters outside space and U+0009 to U+000D, A-Z in lower case; a text of fewer words than a shingle
    has is one shingle.
    """
    words = F.array_remove(F.split(F.translate(text, UPPER, LOWER), r"[\x20\x09-\x0D]+"), "")
    limit = threshold(one_in)

    def hashes(w: Column, low: Column, high: Column) -> Column:
        grams = F.transform(F.sequence(low, high), lambda i: F.concat_ws(" ", F.slice(w, i + 1, words_per_shingle)))
        return F.transform(grams, lambda g: F.substring(F.md5(g.cast("binary")), 1, DIGITS))

    def block(h: Column) -> Column:
        return F.struct(F.filter(h, lambda x: x < limit).alias("kept"), F.array_min(h).alias("least"))

    def whole(w: Column) -> Column:
        last = F.greatest(F.size(w) - words_per_shingle, F.lit(0))
        starts = F.sequence(F.lit(0), last, F.lit(BLOCK))
        parts = F.transform(starts, lambda s: _let(hashes(w, s, F.least(s + BLOCK - 1, last)), block))
        found = _let(parts, lambda p: _let(F.flatten(p["kept"]), lambda k: F.when(F.size(k) > 0, k).otherwise(F.array(F.array_min(p["least"])))))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(found)

    digits = _let(words, whole)
    return F.array_sort(F.array_distinct(F.transform(digits, lambda x: F.conv(x, 16, 10).cast("long"))))


def shown(sketch: Column) -> Column:
    """A fingerprint as text: its hashes in ascending order, DIGITS lowercase hexadecimal digits each."""
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), DIGITS, "0"))), "")


def containment(a: Column, b: Column) -> Column:
    """The share of the smaller fingerprint that the other one holds; 1 for two empty ones, 0 if only one is empty."""
    smaller = F.least(F.size(a), F.size(b))
    share = F.size(F.array_intersect(a, b)) / smaller
    return F.when(smaller > 0, share).otherwise(F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0))


def merged(sketches: DataFrame, by: list[str], sketch: str = "sketch", one_in: int = ONE_IN) -> DataFrame:
    """Fingerprints of unions: rows (by..., hash) of the hashes of each group, combined before the shuffle.

    A hash above the threshold stands for a document without any below it, and goes where its group has one.
    """
    limit = int(threshold(one_in), 16)
    each = sketches.select(*by, F.explode(sketch).alias("hash")).distinct()
    most = each.groupBy(*by).agg(F.min("hash").alias("least")).select(*[F.col(c).alias(f"own_{c}") for c in by], "least")
    same = [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in by]
    return each.join(most, same).where((F.col("hash") < limit) | (F.col("hash") == F.col("least"))).select(*by, "hash")


def contained(sketches: DataFrame, id_col: str, unions: DataFrame, by: list[str], sketch: str = "sketch") -> DataFrame:
    """Rows (id, by..., containment): the share of each document's fingerprint in each union that holds any of it."""
    each = sketches.select(F.col(id_col), F.size(sketch).alias("size"), F.explode(sketch).alias("hash"))
    found = each.join(unions, "hash").groupBy(id_col, "size", *by).agg(F.count("*").alias("shared"))
    return found.select(id_col, *by, (F.col("shared") / F.col("size")).alias("containment"))


def neighbours(classes: DataFrame) -> DataFrame:
    """``classes(id, key, body, ...)``, unique by (id, body), with next_key and next_body of the one that follows.

    The order is descending by (id, body), nulls last, and the first follows the last. Rows are looked at in slices; what a
    slice inherits is the end of the slice before it.
    """
    parts = sliced(classes, "id", "body")
    me = F.struct("key", "body")
    ends = parts.groupBy("slice").agg(F.max_by(me, F.struct("id", "body")).alias("end"))
    along = Window.orderBy("slice")  # one row a slice
    every = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ends.select(F.col("slice").alias("of"), F.coalesce(F.lag("end").over(along), F.last("end").over(every)).alias("end"))
    inside = Window.partitionBy("slice").orderBy("id", "body")
    own = parts.withColumn("behind", F.lag(me).over(inside)).join(before, F.col("slice") == F.col("of"))
    other = F.coalesce("behind", "end")
    return own.select(*classes.columns, other["key"].alias("next_key"), other["body"].alias("next_body"))


def compared_with_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = WORDS,
    one_in: int = ONE_IN, copies: int = COPIES,
) -> DataFrame:
    """Fingerprints of every text and of the text with its second half replaced by the start of the next document.

    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next (``containment`` of the
    fingerprints). Documents follow each other by descending id (null ids last), then descending XXH64 of the text (seed
    42); a row repeated in id and text is followed by its copies, and the last row by the first. Null texts count as empty;
    an empty table gives no rows, and a single row is its own next one. Only the two columns are read.

    Ids and hashes find the next document; the texts are shuffled once, by id and hash, and half of each once more.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.xxhash64(text).alias("body"), text.alias("text"))
    classes = rows.groupBy("id", "key", "body").agg(F.max(F.char_length("text")).alias("n_chars"), F.count("*").alias("n"))
    one = F.lit(1).cast("long")
    link = lambda key, body, times: F.struct(key.alias("to_key"), body.alias("to_body"), times.alias("times"))
    to_itself = F.transform(
        F.sequence(one, F.col("n") - 1, F.lit(copies).cast("long")),
        lambda at: link(F.col("key"), F.col("body"), F.least(F.lit(copies).cast("long"), F.col("n") - at)),
    )
    to_next = F.array(link(F.col("next_key"), F.col("next_body"), one))
    links = F.when(F.col("n") > 1, F.concat(to_next, to_itself)).otherwise(to_next)
    ring = stored(neighbours(classes).select("id", "key", "body", "n_chars", F.inline(links)), "fingerprint-ring")

    sketch = sketch_column(F.col("text"), words_per_shingle, one_in)
    texts = rows.select("key", "body", "text", sketch.alias("sketch"))
    texts = texts.groupBy("key", "body").agg(F.first("text").alias("text"), F.first("sketch").alias("sketch"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    ahead = texts.select(F.col("key").alias("k"), F.col("body").alias("b"), F.col("text").alias("other"), F.col("sketch").alias("next"))
    sent = ring.join(ahead, (F.col("to_key") == F.col("k")) & (F.col("to_body") == F.col("b"))).select(
        "id", F.col("key").alias("k"), F.col("body").alias("b"), "n_chars", "times", F.substring("other", F.lit(1), half).alias("head"), "next"
    )
    met = texts.join(sent, (F.col("key") == F.col("k")) & (F.col("body") == F.col("b")))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.col("head"))
    made = met.select("id", "n_chars", "times", "sketch", "next", edited.alias("edited"))
    made = made.select("*", sketch_column(F.col("edited"), words_per_shingle, one_in).alias("changed"))
    each = made.select(
        F.col("id").alias(id_col),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        shown(F.col("sketch")).alias("fingerprint"),
        shown(F.col("changed")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("changed")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next")).alias("near_next"),
        F.sequence(one, F.col("times")).alias("again"),
    )
    return each.withColumn("again", F.explode("again")).drop("again")
