"""The driver's queries over this subpackage's operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, exact_dedup, lm, ngram_join, packing, rollups, sstable, suffix_dedup, toxicity
from .blocks import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= 0.5).cast("int").alias("predicted"),
        F.col("tox_evidence").alias("evidence"),
        F.col("tox_words").alias("n_words"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), span=100, with_text=False)
    return found.drop("starts", "stops", "text")


def op4_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.read_shards(sstable.write_shards(table(spark, sf_dir, "documents")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), n=3, percent=90)


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), toxicity.held_out(F.col("doc_id"), 7, 2))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op10_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in under both tokenizer versions; version 1 is revised to count an end token too; documents
    labelled as of low quality are deleted. Every batch is committed twice, with no effect the second time."""
    counted = stored(rollups.counts(table(spark, sf_dir, "documents")), "token-counts")
    low = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").distinct()
    first = counted.where("tokenizer = 'words-1'")
    now = first.withColumn("n_tokens", F.col("n_tokens") + 1).unionByName(counted.where("tokenizer = 'words-2'"))
    batches = [
        ("insert-1", rollups.inserts(first)),
        ("insert-2", rollups.inserts(counted.where("tokenizer = 'words-2'"))),
        ("revise-1", rollups.revisions(first, F.col("n_tokens") + 1)),
        ("delete-low", rollups.deletes(now.join(low, "doc_id", "left_semi"))),
    ]
    rollup = rollups.Rollup(spark)
    for name, changes in batches + batches:
        rollup.commit(name, changes)
    return rollup.totals()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_sstable": op4_sstable,
    "op5_chat": op5_chat,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_lm": op8_lm,
    "op9_decontamination": op9_decontamination,
    "op10_rollups": op10_rollups,
}

ORACLE_SQL: dict[str, str] = {
    "op5_chat": r"""
        WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
        l AS (SELECT *, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS line, (role IS NULL)::VARCHAR || (text IS NULL)::VARCHAR || '|' || coalesce(role, '') || chr(30) || coalesce(text, '') || chr(31) AS raw FROM t),
        p AS (SELECT conv_id, place, n, string_agg(raw, '') OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS prefix FROM l),
        whole AS (SELECT n, prefix, min(conv_id) AS conv_id FROM p WHERE place = n GROUP BY n, prefix),
        kept AS (SELECT conv_id FROM whole ANTI JOIN (SELECT DISTINCT place, prefix FROM p WHERE place < n) q ON whole.n = q.place AND whole.prefix = q.prefix)
        SELECT conv_id, ((place - 1) // 500)::INTEGER AS segment, max(n)::BIGINT AS n_turns, count(*) FILTER (role = 'assistant') AS n_assistant, string_agg(line, '' ORDER BY place) AS rendered
        FROM l JOIN kept USING (conv_id) GROUP BY conv_id, segment
    """,
    "op10_rollups": r"""
        WITH c AS (
            SELECT doc_id, source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS n FROM documents
            UNION ALL
            SELECT doc_id, source, lang, 'words-2', len(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM documents)
        SELECT source, lang, tokenizer, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_tokens FROM c
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) GROUP BY source, lang, tokenizer
    """,
    "op6_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
    """,
    "op9_decontamination": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
        b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
        bs AS (SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS span FROM b WHERE len(w) > 0),
        lens AS (SELECT DISTINCT n FROM bs),
        ds AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, lens WHERE len(w) >= n),
        sp AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS span FROM ds),
        hit AS (SELECT DISTINCT sp.doc_id, sp.i, sp.n, bs.item_id FROM sp JOIN bs ON sp.span = bs.span AND sp.n = bs.n),
        cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
        it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
    """,
}
