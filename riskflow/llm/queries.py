"""One query per operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import (
    language_id,
    lexical_search,
    lm_score,
    mixing,
    near_dedup,
    packing,
    quality_model,
    quality_rules,
    spelling,
    substring_dedup,
    suffix_dedup,
    topk,
    warc,
)

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written to a content-addressed archive and read back."""
    pages = _table(spark, sf_dir, "pages")
    archive = warc.write_archive(
        pages, warc.scratch_archive(spark), "page_id", "url", "html", min_bytes=0
    )
    return warc.records(archive, with_payload=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    queue, mix = mixing.schedule(_table(spark, sf_dir, "documents"))
    return mixing.taken_per_document(queue, mix).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source"
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 4096 tokens."""
    return packing.packed_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 4096
    )


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document, on n-grams of up to three words."""
    return lm_score.score_documents(_table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, on shingles of two words."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=2, percent=80)


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: its own evidence, its source, and the source's language."""
    return quality_model.judge(
        _table(spark, sf_dir, "documents"),
        _table(spark, sf_dir, "labels"),
        {"source": F.col("source"), "lang": F.col("lang")},
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and robust outliers over every document."""
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates of every fiftieth vector."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document without passages that stand in an earlier one."""
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=50)
    return cut.select(
        "doc_id", "n_words", "n_removed", substring_dedup.kept_digest().alias("kept_sha256")
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that aren't held out."""
    judged = language_id.identify(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "held_out", "lang_pred", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return lexical_search.search(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50
    )


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document without strings of 200 bytes that stand elsewhere too."""
    cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=200)
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of all words of seven letters or more that occur at least twice."""
    words = spelling.word_counts(
        _table(spark, sf_dir, "documents"), min_length=7, min_count=2, slip_every=31
    )
    return spelling.variant_groups(words, ratio=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_mixing,
        op3_packing,
        op4_lm_score,
        op5_near_dedup,
        op6_quality_model,
        op7_quality_rules,
        op8_top_k,
        op9_substring_dedup,
        op10_language_id,
        op11_lexical_search,
        op12_suffix_dedup,
        op13_spelling,
    )
}

_SHA1_BASE32 = """
list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(sha1(coalesce(html, '')), CAST(1 + 5 * i AS INT), 5) AS BIGINT) >> s) % 32 AS INT) + 1, 1)),
    'string_agg', '')), 'string_agg', '')
"""

#: CRC-32 of a string `s`, four bits at a time; the table is that of the half-byte method.
_CRC32 = """
xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        flatten(list_transform(range(1, strlen({s}) + 1), lambda i: [2 * i, 2 * i - 1])),
        lambda i: ('0x' || substr(hex(encode({s})), i::INT, 1))::BIGINT)),
    lambda c, b: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444,
        1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920,
        2262029012, 2685067896, 3183342108][((xor(c, b) & 15) + 1)::INT])), 4294967295::BIGINT)
"""

#: Queries without an entry (op3 to op7, op9, op10) are tested against brute force:
#: SQL has no tokenizer, suffix automaton, iterated estimate or fitted model, and lists of
#: all windows of whole texts are too slow there.
ORACLE_SQL = {
    "op1_warc": f"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        {_SHA1_BASE32} AS payload_digest,
        min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
    FROM pages)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p
""",
    "op2_mixing": r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':mix'), 1, 15) AS BIGINT) AS place
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
    FROM d GROUP BY source),
w AS (
    SELECT *, CASE r % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight, 2.0::DOUBLE * source_size AS cap,
        sum(source_size) OVER () * 1.5::DOUBLE AS budget
    FROM s),
f AS (  -- a source is full if the budget exceeds what all take at the level that just fills it
    SELECT a.source, sum(least(b.cap, b.weight * a.cap / a.weight)) <= any_value(a.budget) AS is_full
    FROM w a CROSS JOIN w b GROUP BY a.source),
t AS (
    SELECT w.source, source_size, round(CASE WHEN is_full THEN cap ELSE
        weight * (budget - coalesce(sum(cap) FILTER (is_full) OVER (), 0.0::DOUBLE)) / sum(weight) FILTER (NOT is_full) OVER () END, 6) AS target
    FROM w JOIN f ON w.source IS NOT DISTINCT FROM f.source),
q AS (
    SELECT d.*, t.source_size, t.target,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, source,
    CAST(least(size, greatest(0, floor(target) - before))
        + least(size, greatest(0, floor(target) - source_size - before)) AS BIGINT) AS taken
FROM q
""",
    "op8_top_k": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_lexical_search": r"""
WITH t AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
g AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM d),
w AS (
    SELECT term, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM f CROSS JOIN g GROUP BY term),
q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
s AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // ll))))::BIGINT AS score
    FROM q JOIN w USING (term) JOIN f USING (term) JOIN d USING (doc_id) CROSS JOIN g GROUP BY ALL),
r AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
""",
    "op12_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
b0 AS (SELECT doc_id, n, h, unnest(range(0, n - 199, 250)) AS base FROM d),  -- short pieces to cut windows from
p0 AS (SELECT doc_id, base, substr(h, 2 * base + 1, 900) AS h, unnest(range(0, least(250, n - 199 - base))) AS j FROM b0),
c AS (SELECT doc_id, base + j AS i, count(*) OVER (PARTITION BY md5(substr(h, 2 * j + 1, 400))) AS places FROM p0),
e AS (
    SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, -1) AS new
    FROM c WHERE places > 1),
s AS (
    SELECT doc_id, min(i) AS first, max(i) + 200 AS after
    FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM e) GROUP BY doc_id, run),
b AS (
    SELECT doc_id, first, after, coalesce(lag(after) OVER (PARTITION BY doc_id ORDER BY first), 0) AS kept_from FROM s),
k AS (
    SELECT doc_id, count(*) AS n_spans, sum(after - first) AS n_removed, max(after) AS last,
        list([kept_from, first] ORDER BY first) AS pieces
    FROM b GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(array_to_string(list_transform(pieces, lambda x: substr(h, 2 * x[1] + 1, 2 * (x[2] - x[1]))), ''), '')
        || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
    "op13_spelling": f"""
WITH RECURSIVE r AS (
    SELECT doc_id || ':' || w AS s, w
    FROM (SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+'),
              lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS w FROM documents)
    WHERE length(w) >= 7),
u AS (SELECT DISTINCT s FROM r),
x AS (SELECT s, {_CRC32.format(s='s')} AS h FROM u),
m AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w) + 2)::INT) ELSE w END AS word
    FROM r JOIN x USING (s)),
v AS MATERIALIZED (SELECT word, count(*) AS n FROM m WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
e AS (
    SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS cut
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM e a JOIN e b USING (i, cut) WHERE a.word <> b.word AND length(a.word) = length(b.word)
    UNION SELECT e.word, e.n, v.word, v.n FROM e JOIN v ON cut = v.word
    UNION SELECT v.word, v.n, e.word, e.n FROM e JOIN v ON cut = v.word),
near AS (
    SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS best, max(near_n) AS best_n FROM pairs GROUP BY word),
forms AS MATERIALIZED (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * v.n THEN best END AS form,
        CASE WHEN best_n >= 10 * v.n THEN best_n END AS form_n
    FROM v LEFT JOIN near USING (word)),
steps AS (
    SELECT word, form, word AS at FROM forms
    UNION ALL SELECT steps.word, next.form, next.word FROM steps JOIN forms next ON steps.form = next.word)
SELECT word, forms.form, steps.at AS root, n, n_near, form_n FROM forms JOIN steps USING (word) WHERE steps.form IS NULL
""",
}
