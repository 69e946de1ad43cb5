"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covdrift.llm import (
    embedding_dedup,
    hard_negatives,
    importance_resampling,
    license_scan,
    line_dedup,
    mixing,
    packing,
    quality_rules,
    radix_dedup,
    sharding,
    simhash,
    suffix_dedup,
    weak_labels,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Where each piece of each document lies."""
    pieces = packing.pack(_table(spark, folder, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures and the cascade's verdict of each document."""
    judged = quality_rules.judge(_table(spark, folder, "documents"))
    return judged.select("doc_id", "measures.*", "base_failed", "kept")


def op3_weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Score and verdict of each document."""
    return weak_labels.classify(_table(spark, folder, "documents"), keep=["doc_id"])


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Class, links and fate of each line."""
    return line_dedup.line_classes(_table(spark, folder, "documents")).drop("row")


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of each document; row counts are at most one apart."""
    cut = sharding.shard(_table(spark, folder, "documents"))
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is removed of each document, and a digest of the rest."""
    cut = suffix_dedup.remove_repeats(_table(spark, folder, "documents"))
    n_bytes, left = F.octet_length("data").cast("long"), F.octet_length("kept")
    return cut.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - left).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        left.cast("long").alias("n_kept"),
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes of each document."""
    chosen = mixing.mix(_table(spark, folder, "documents"))
    return chosen.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License labels of each document."""
    return license_scan.labelled(license_scan.scan(_table(spark, folder, "documents")))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate class of each document."""
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class and number of links of each vector."""
    return embedding_dedup.link_classes(_table(spark, folder, "embeddings"))


def op11_radix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    docs = _table(spark, folder, "documents").select("doc_id", "text", digest)
    found = radix_dedup.classes(docs, keep=["doc_id", "text_sha256"])
    return found.select("doc.doc_id", "keep_id", "group_size", "kept", "doc.text_sha256")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of each anchor and positive; every seventh row counts under the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, folder, "embeddings").withColumn("label", label))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank of each document against the benchmark texts."""
    docs, target = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    found = importance_resampling.resample(docs, target, keep=["doc_id"])
    return found.select("doc.doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_quality_rules,
        op3_weak_labels,
        op4_line_dedup,
        op5_sharding,
        op6_suffix_dedup,
        op7_mixing,
        op8_license_scan,
        op9_simhash,
        op10_embedding_dedup,
        op11_radix_dedup,
        op12_hard_negatives,
        op13_importance_resampling,
    )
}
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: The base measures, and each rule of the cascade as one condition; their order plays no part.
_QUALITY_SQL = rf"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT r, unnest({_WORDS.format("t")}) AS w,
                          generate_subscripts({_WORDS.format("t")}, 1) AS i FROM d),
grams AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
        SELECT r, i, w AS a, lead(w, 1) OVER win AS b, lead(w, 2) OVER win AS c FROM w
        WINDOW win AS (PARTITION BY r ORDER BY i)) WHERE c IS NOT NULL),
twice AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words
    FROM grams, (VALUES (0), (1), (2)) step(k) WHERE n > 1 GROUP BY r),
words AS (
    SELECT r, max(n) AS top, sum(n) AS n_words, sum(n * length(w)) AS word_chars
    FROM (SELECT r, w, count(*) AS n FROM w GROUP BY r, w) GROUP BY r),
lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
    WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
    SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(n_lines, 0) AS n_lines, coalesce(top, 0) AS top,
           len(regexp_extract_all(t, '[A-Z]')) AS upper, len(regexp_extract_all(t, '[a-z]')) AS lower,
           len(regexp_extract_all(t, '!')) AS bangs
    FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN twice USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR upper > lower OR 3 * bangs > n_words
            OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines) OR 5 * top > n_words
            OR word_chars > 20 * n_words) AS kept
FROM b"""

#: Equal texts by plain grouping.
_COPIES_SQL = """
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.t) AS text_sha256
FROM documents d JOIN (
    SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size
    FROM documents GROUP BY 1) g ON coalesce(d.text, '') = g.t"""

#: All pairs of an anchor and another row, scored outright.
_NEGATIVES_SQL = """
WITH v AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           list_inner_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
       (row_number() OVER best)::INTEGER AS rank
FROM positive JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 5"""

#: A step of the CRC's bit loop, eight times over for a table of all bytes; then byte by byte.
_RESAMPLING_SQL = r"""
WITH RECURSIVE crc_step(byte, k, c) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL
    SELECT byte, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
    FROM crc_step WHERE k < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY byte) AS t FROM crc_step WHERE k = 8),
texts AS (
    SELECT 'd' AS side, row_number() OVER () AS r, text FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark),
words AS MATERIALIZED (
    SELECT side, r, w, count(*) AS n FROM (
        SELECT side, r, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts)
    GROUP BY side, r, w),
hexed AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM words)),
hashed AS MATERIALIZED (
    SELECT w, xor(list_reduce(list_transform(range(1, length(x), 2),
                  lambda i: ('0x' || substr(x, i, 2))::BIGINT),
              lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)]), 4294967295), 4294967295) % 10000 AS bucket
    FROM hexed, crc_table),
bucketed AS MATERIALIZED (SELECT side, r, bucket, sum(n) AS n FROM words JOIN hashed USING (w) GROUP BY ALL),
counted AS (
    SELECT range AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t
    FROM range(10000) LEFT JOIN (
        SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t
        FROM bucketed GROUP BY bucket) ON bucket = range),
gained AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                     / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counted),
weights AS (
    SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
    FROM bucketed JOIN gained USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((
               ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
               / 4294967296::DOUBLE)))::BIGINT AS score
    FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) LEFT JOIN weights USING (r)),
drawn AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank,
           count(*) OVER () * 10 // 100 AS drawn
    FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, rank
FROM scored LEFT JOIN (SELECT doc_id, rank FROM drawn WHERE rank <= drawn) USING (doc_id)"""

#: Tokens, edit links, checksums, rotations and random rounding are tested by brute force instead.
ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": _QUALITY_SQL,
    "op11_radix_dedup": _COPIES_SQL,
    "op12_hard_negatives": _NEGATIVES_SQL,
    "op13_importance_resampling": _RESAMPLING_SQL,
}
