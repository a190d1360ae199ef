"""Registered queries of the numbered operators; oracles where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import alignment, common, conversations, dac, main_text, neighbours, packing, quality, secrets, segmentations, sharding, simhash, substrings, token_ids, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            common.arrow_batches(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return deco


@register("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document (offsets: no oracle)."""
    docs = common.table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


_OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS t,
         regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
wins AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) >= 8),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 7], ' ')) AS h FROM wins),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, h) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(COALESCE(cov.n, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS n_lines, length(regexp_replace(t, '[^!]', '', 'g')) AS n_ex
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
b AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 4 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_ex > 5 * n_words) AS kept
FROM b
"""


@register("op4_quality_rules", _OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = common.table(spark, sf_dir, "documents")
    order = [r for r, _, _ in quality.plan(docs)]
    asked = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.judge(docs, order, asked)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", *asked, failed.alias("base_failed"), "kept")


_OP7_SHARD = """(list_sort(list_transform(range({n}), lambda s: {{'draw': -ln((CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(s AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0), 'shard': s}}))[1]).shard"""
#: For tests: everything but the checksum, which SQL lacks.
OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, CAST(strlen(COALESCE(text, '')) + 16 AS BIGINT) AS size, {_OP7_SHARD.format(n=40)} AS shard, {_OP7_SHARD.format(n=41)} AS grown
  FROM documents)
SELECT doc_id, size, 'key' AS law, CAST(shard AS INTEGER) AS shard, CAST(grown AS INTEGER) AS grown_shard,
       CAST(ROW_NUMBER() OVER (PARTITION BY shard ORDER BY md5(COALESCE(CAST(doc_id AS VARCHAR), 'null')), doc_id, size) - 1 AS BIGINT) AS slot
FROM d
"""


@register("op7_rendezvous_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document among 40 equal shards, and its shard among 41."""
    placed = sharding.assign(common.table(spark, sf_dir, "documents"), [1.0] * 40, [1.0] * 41)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register("op8_simhash_trie")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@register("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 ids."""
    found = packing.pieces(common.table(spark, sf_dir, "documents"), token_ids.word_bpe_path())
    return packing.pack(found).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op6_dac_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of every document as addressable codes and read the files back."""
    path = common.shared_path(spark, "dac")
    dac.write(common.table(spark, sf_dir, "documents"), path, token_ids.word_bpe_path())
    return dac.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@register("op10_collision_counting")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every vector."""
    return vectors.near_duplicates(common.table(spark, sf_dir, "embeddings"))


@register("op9_template_removal")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract(common.table(spark, sf_dir, "pages"))


@register("op3_prefix_doubling")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 50 bytes that an earlier document holds."""
    return substrings.report(common.table(spark, sf_dir, "documents"))


@register("op1_gumbel_segmentations")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, decoded again."""
    return segmentations.segment(common.table(spark, sf_dir, "documents"), segmentations.piece_model_path())


@register("op12_anchor_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token alignment of every document between two vocabularies."""
    return alignment.align(common.table(spark, sf_dir, "documents"))


@register("op13_prefix_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return conversations.trie(common.table(spark, sf_dir, "conversations"))


@register("op11_collision_search")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return neighbours.search(common.table(spark, sf_dir, "embeddings"))
