"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import (
    chat,
    decontam,
    divergence,
    embedding_dedup,
    fingerprints,
    html_text,
    importance,
    langid,
    license_scan,
    packing,
    secret_scan,
    simhash,
    tokencount,
)
from tierflow.llm.base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _secret_sql() -> str:
    """The secret scan for DuckDB: marks around matches, summed lengths as offsets, weak parts joined by interval."""
    mark, other = "chr(57344)", "chr(57345)"
    kinds = []
    for n, kind in enumerate(secret_scan.KINDS):
        pattern = kind.pattern.replace("'", "''")
        size = f"length(regexp_extract(m, '{pattern}', {kind.group}))" if kind.group else "length(m)"
        holds = "".join(f" AND regexp_matches(m, '{h}')" for h in kind.holds)
        kinds.append(
            f"""SELECT row, {n} AS kind, a AS start, a + length(m) AS "end" FROM (
      SELECT row, s[i] AS m, coalesce(list_sum(list_transform(s[1:i-1], lambda x: length(x))), 0) AS a
      FROM (SELECT row, string_split(regexp_replace(t, '{pattern}', {mark} || '\\0' || {mark}, 'g'), {mark}) AS s FROM d), unnest(range(2, len(s), 2)) AS u(i)
    ) WHERE {size} >= {kind.least}{holds}"""
        )
    near, over = f"greatest(c.start - w.\"end\", w.start - c.\"end\") <= {secret_scan.SCOPE}", 'c.start < w."end" AND w.start < c."end"'
    shown = lambda where: f"""coalesce(string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind){where}, '')"""
    names = ", ".join(f"'{k.name}'" for k in secret_scan.KINDS)
    has = lambda kinds: f"EXISTS (SELECT 1 FROM p c WHERE c.row = w.row AND c.kind IN ({kinds}) AND NOT (c.kind = w.kind AND c.start = w.start) AND {near} AND NOT ({over}))"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, replace(coalesce(text, ''), {mark}, {other}) AS t FROM documents),
    p AS MATERIALIZED ({" UNION ALL ".join(kinds)}),
    kept AS (SELECT * FROM p WHERE kind < 3
      UNION ALL SELECT * FROM p w WHERE kind = 3 AND {has("0, 2, 4")}
      UNION ALL SELECT * FROM p w WHERE kind = 4 AND {has("1, 3")} AND NOT EXISTS (SELECT 1 FROM p c WHERE c.row = w.row AND c.kind IN (0, 1, 2, 3, 5) AND {over})
      UNION ALL SELECT * FROM p w WHERE kind = 5 AND {has("0, 2, 4")} AND {has("1, 3")}),
    n AS (SELECT *, ([{names}])[kind + 1] AS name FROM kept)
    SELECT any_value(doc_id) AS doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
      count(*) FILTER (WHERE kind = 2) AS n_hex, sha256({shown(" FILTER (WHERE kind < 3)")}) AS base_sha256, {shown("")} AS spans
    FROM d LEFT JOIN n USING (row) GROUP BY row"""


_CHAT_SQL = f"""WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, list(role || chr(1) || text ORDER BY turn NULLS FIRST, role, text) AS turns,
      list('{chat.OPEN}' || role || chr(10) || replace(text, '<|im_', '{chat.ESCAPED}') || '{chat.CLOSE}' || chr(10) ORDER BY turn NULLS FIRST, role, text) AS shown FROM t GROUP BY 1),
    whole AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY 1),
    inside AS (SELECT DISTINCT turns[1:n] AS turns FROM whole, unnest(range(1, len(turns))) AS u(n))
    SELECT conv_id, CAST(part AS INTEGER) AS part, CAST(len(c.turns) AS BIGINT) AS n_turns, n_copies,
      array_to_string(shown[part * {chat.PART} + 1 : part * {chat.PART} + {chat.PART}], '') AS text
    FROM whole ANTI JOIN inside USING (turns) JOIN c USING (conv_id), unnest(range(0, (len(c.turns) + {chat.PART} - 1) // {chat.PART})) AS v(part)"""


_ASCII_LOWER = f"'{fingerprints.UPPER}', '{fingerprints.LOWER}'"

_FINGERPRINT_SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    n AS (SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER o, first_value(t) OVER o) AS other, coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS other_id
      FROM d WINDOW o AS (ORDER BY doc_id DESC NULLS LAST)),
    e AS (SELECT doc_id, other_id, n, t, substring(t, 1, n - n // 2) || substring(other, 1, n // 2) AS edited FROM n),
    x AS (SELECT doc_id, 0 AS which, t FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
    w AS (SELECT doc_id, which, list_filter(string_split_regex(translate(t, {_ASCII_LOWER}), '[\\x20\\x09-\\x0D]+'), lambda s: s <> '') AS w FROM x),
    h AS (SELECT doc_id, which, CASE WHEN len(w) = 0 THEN [] ELSE list_transform(range(0, greatest(len(w) - {fingerprints.WORDS}, 0) + 1),
      lambda i: substring(md5(array_to_string(w[i + 1:i + {fingerprints.WORDS}], ' ')), 1, {fingerprints.DIGITS})) END AS h FROM w),
    k AS (SELECT doc_id, which, h, list_filter(h, lambda s: s < '{fingerprints.threshold(fingerprints.ONE_IN)}') AS k FROM h),
    s AS (SELECT doc_id, which, list_sort(list_distinct(CASE WHEN len(k) > 0 OR len(h) = 0 THEN k ELSE [list_min(h)] END)) AS s FROM k),
    near AS (SELECT e.doc_id, n, edited, a.s AS a, b.s AS b, c.s AS c FROM e JOIN s a ON a.doc_id = e.doc_id AND a.which = 0
      JOIN s b ON b.doc_id = e.doc_id AND b.which = 1 JOIN s c ON c.doc_id = e.other_id AND c.which = 0)
    SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
      CASE WHEN least(len(a), len(b)) > 0 THEN len(list_intersect(a, b)) / least(len(a), len(b)) WHEN len(a) = len(b) THEN 1.0 ELSE 0.0 END::DOUBLE AS near_edited,
      CASE WHEN least(len(a), len(c)) > 0 THEN len(list_intersect(a, c)) / least(len(a), len(c)) WHEN len(a) = len(c) THEN 1.0 ELSE 0.0 END::DOUBLE AS near_next FROM near"""

_WORD_LIST = f"regexp_extract_all(translate(coalesce(text, ''), {_ASCII_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

def _license_sql() -> str:
    """The licence scan for DuckDB: every place where all key words stand, whatever their frequency."""
    values = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    listed = [license_scan.Template(label, phrase, phrase) for phrase, label in license_scan.PHRASES] + list(license_scan.TEMPLATES)
    plain = len(license_scan.PHRASES)
    names = values((n, t.label, len(t.key.split())) for n, t in enumerate(listed))
    keys = values((n, word, at) for n, t in enumerate(listed) for word, at in license_scan.key_places(t))
    wordings = values((n, word, at) for n, t in enumerate(listed) for at, word in enumerate(t.text.split()))
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORD_LIST} AS w FROM documents),
    e AS MATERIALIZED (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
    s(template, label, size) AS (VALUES {names}), k(template, word, place) AS (VALUES {keys}), t(template, word, place) AS (VALUES {wordings}),
    f AS (SELECT word, 1 + floor(1000 * ln(((SELECT count(*) FROM d) + 1) / (coalesce(n, 0) + 1)))::BIGINT AS weight
      FROM (SELECT DISTINCT word FROM t) LEFT JOIN (SELECT word, count(DISTINCT r) AS n FROM e GROUP BY 1) USING (word)),
    sure AS MATERIALIZED (SELECT r, template, pos - place AS start FROM e JOIN k USING (word) JOIN s USING (template) GROUP BY r, template, pos - place, size HAVING count(*) = size),
    c AS (SELECT sure.r AS r, template, start, sum(weight) AS weight FROM sure JOIN t USING (template) JOIN f USING (word)
      JOIN e ON e.r = sure.r AND e.word = t.word AND e.pos = start + place GROUP BY sure.r, template, start),
    whole AS (SELECT template, sum(weight) AS total FROM t JOIN f USING (word) GROUP BY 1),
    b AS (SELECT r, count(*) AS n, min(start) AS first, max(start) AS last, list_sort(list(DISTINCT label)) AS labels
      FROM sure JOIN s USING (template) WHERE template < {plain} GROUP BY 1),
    o AS (SELECT r, list(DISTINCT label) AS labels, max(weight::DOUBLE / total) AS cover FROM c JOIN whole USING (template) JOIN s USING (template) WHERE template >= {plain} GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0) AS n_base, b.first::BIGINT AS first_word, b.last::BIGINT AS last_word,
      array_to_string(coalesce(b.labels, []), ',') AS base_labels,
      array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(o.labels, [])))), ',') AS labels,
      CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(o.cover, 0) END::DOUBLE AS score
    FROM d LEFT JOIN b USING (r) LEFT JOIN o USING (r)"""


_IMPORTANCE_SQL = f"""WITH c AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
    d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {_WORD_LIST} AS w FROM documents),
    e AS (SELECT row, unnest(w) AS word FROM d), b AS (SELECT unnest({_WORD_LIST}) AS word FROM benchmark),
    v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM e UNION SELECT word FROM b)),
    k AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
      lambda s, x: xor(s >> 8, t[1 + (xor(s, x) & 255)])), 4294967295::BIGINT) % 10000 AS bucket FROM v, c),
    s AS (SELECT bucket, count(*) AS s FROM e JOIN k USING (word) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM b JOIN k USING (word) GROUP BY 1),
    g AS MATERIALIZED (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM e) + 10000)::DOUBLE)
      / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain FROM s FULL JOIN t USING (bucket)),
    w AS (SELECT row, sum(gain)::BIGINT AS weight FROM e JOIN k USING (word) JOIN g USING (bucket) GROUP BY 1),
    x AS (SELECT doc_id, len(d.w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM d LEFT JOIN w USING (row)),
    r AS (SELECT *, row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id, n_features) AS place FROM x)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM x WHERE n_features >= 20) THEN place END AS rank FROM r"""

_DIVERGENCE_SQL = f"""WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      regexp_extract_all(translate(coalesce(text, ''), {_ASCII_LOWER}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    e AS (SELECT row, lang, source, unnest(w) AS term FROM d),
    c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs FROM e GROUP BY 1, 2, 3),
    k AS MATERIALIZED (SELECT lang, term, sum(n)::BIGINT AS n FROM c GROUP BY 1, 2 HAVING sum(docs) >= 10),
    l AS MATERIALIZED (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM k GROUP BY 1),
    g AS MATERIALIZED (SELECT lang, source, coalesce(total, 0)::BIGINT AS total FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(c.n) AS total FROM c JOIN k USING (lang, term) GROUP BY 1, 2) USING (lang, source)),
    p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (g.total + 2 * v) AS p,
      1 + (1000000000 * (k.n + 2)) // (l.total + 2 * v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
    r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r QUALIFY part = 'pair' OR rank <= 10"""


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = tokencount.with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), limit=4096)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op3_html_main_text")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.with_main_text(pages).select("page_id", "url", "text", "n_chars")


@query("op4_benchmark_decontamination")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def held_out(id_col: str = "doc_id"):
    """Every fifth document by the CRC-32 of its id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out()))
    named = langid.with_language(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op6_secret_scan", _secret_sql())
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(table(spark, folder, "documents"))


@query("op7_license_scan", _license_sql())
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.report(table(spark, folder, "documents"))


@query("op8_embedding_near_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query("op9_chat_formatting", _CHAT_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_conversations(table(spark, folder, "conversations"))


@query("op10_power_of_two_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, longest=4096)
    return cut.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


@query("op11_document_fingerprints", _FINGERPRINT_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared_with_edits(table(spark, folder, "documents"))


@query("op12_importance_resampling", _IMPORTANCE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_source_divergence", _DIVERGENCE_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
