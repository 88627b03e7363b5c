"""Registered queries of the operators, with checking SQL where SQL can say it."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.llm import alignment, exact_dedup, knn, language, mixing, near_dedup, packing, periodic, pii, sharding, substring, token_counts, toxicity
from trackside.llm.common import table


#: The vocabulary file, a parameter of the operator: byte_bpe_50k.json as ranks, with the same ids.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The rank file lacks the added tokens; they are read here.
ADDED = "byte_bpe_50k.json"


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(ADDED), encoding="utf-8") as file:
        special = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, special=special)


def op1_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"))


def op2_fingerprint_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op4_count_min_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_random_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(pii.labelled_lines(docs)))


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    # A row that repeats a doc_id counts as kept too; the operator itself keeps one of them.
    kept = F.when(F.col("doc_id").isNull(), F.col("kept")).otherwise(F.col("doc_id") == F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_key")


def op7_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


#: Documents are rejected when a grade of 1 or more is more likely than not.
REJECT = 0.5


def op8_ordinal_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.severity(docs, toxicity.learn(toxicity.graded(docs, table(spark, sf_dir, "labels"))))
    return scored.withColumn("toxic", F.col("p_toxic") >= REJECT)


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.pareto_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op10_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op11_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        vocabularies = alignment.Vocabularies(a.read(), b.read())
    return alignment.align(table(spark, sf_dir, "documents"), vocabularies)


#: Documents above this many tokens are over the limit.
TOKEN_LIMIT = 2048


def op12_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        counted = token_counts.prefix_counts(table(spark, sf_dir, "documents"), file.read())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def cycled(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of op 13: every tenth document, by a hash of its doc_id, has a tail that repeats."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def op13_lcp_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(table(spark, sf_dir, "documents"), change=cycled)
    # Greatest length first, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    told = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.less")
    exponent = F.expr("1000 * best.length div -best.less").alias("exponent_milli")
    return told.select("doc_id", "n_runs", (-F.col("best.before")).alias("start"), length.alias("length"), period.alias("period"), exponent, "runs_sha256", "collapsed_sha256")


QUERIES = {
    "op1_voronoi_top_k": op1_voronoi_top_k,
    "op2_fingerprint_dedup": op2_fingerprint_dedup,
    "op3_output_codes": op3_output_codes,
    "op4_count_min_windows": op4_count_min_windows,
    "op5_random_field": op5_random_field,
    "op6_chosen_path": op6_chosen_path,
    "op7_jump_shards": op7_jump_shards,
    "op8_ordinal_severity": op8_ordinal_severity,
    "op9_pareto_mix": op9_pareto_mix,
    "op10_vector_packing": op10_vector_packing,
    "op11_shared_cuts": op11_shared_cuts,
    "op12_prefix_counts": op12_prefix_counts,
    "op13_lcp_runs": op13_lcp_runs,
}

BLANKS_SQL = r"[\x20\x09-\x0D]"

ORACLE = {
    "op1_voronoi_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
    """,
    "op2_fingerprint_dedup": rf"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '{BLANKS_SQL}', '', 'g') AS bare
            FROM documents
        ), g AS (
            SELECT doc_id, bare, first_value(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY bare) AS group_size
            FROM t
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM g
    """,
    "op4_count_min_windows": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (
            SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
        ), least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (s) WHERE m < doc_id),
        g AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
               sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ps, []), i)), ' ')) AS kept_sha256
        FROM d LEFT JOIN g USING (doc_id)
    """,
}
