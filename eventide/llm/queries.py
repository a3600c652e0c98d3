"""Registered queries of the numbered operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm import oracles

#: The rules of op7, by (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.decontaminate import decontaminate

    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                          window=10, containment=1.0, columns=["doc_id"])
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", hit.alias("n_hit"),
                        F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op2_pfor_tokens(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    from eventide.llm.tokens import token_shards

    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_shards(_table(spark, sf_dir, "documents"), vocabulary, end_id=2)


def op3_bucket_pointer_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.substrings import drop_repeats

    cut = drop_repeats(_table(spark, sf_dir, "documents"), length=100, columns=["doc_id"])
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", (F.octet_length("kept") + gone).alias("n_bytes"), gone.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.neighbours import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op5_flow_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"), [5.0, 2.0, 1.0], max_repeat=3, carry=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.sharding import feistel_shards

    return feistel_shards(_table(spark, sf_dir, "documents"), 8, carry=["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.reputation import judge_urls, junk_outcome

    pages = _table(spark, sf_dir, "pages").select("page_id", "url", junk_outcome(F.col("html")).alias("bad"))
    return judge_urls(pages, URL_RULES, outcome=F.col("bad")).select("page_id", "host", "path", "rule", "verdict")


def op8_oph_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op9_instance_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.toxicity import held_out, score_documents, train

    docs = _table(spark, sf_dir, "documents")
    model = train(docs, _table(spark, sf_dir, "labels"))
    return score_documents(docs, model, columns=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.backoff import backoff_scores

    return backoff_scores(_table(spark, sf_dir, "documents"), order=3).select(
        "doc_id", "n_words", F.round("score", 3).alias("score"), "backoffs")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.lines import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents"), min_chars=10, columns=["doc_id"], with_text=True).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.phrases import collocations

    return collocations(_table(spark, sf_dir, "documents"), max_words=3, min_count=10, inside_percent=50, keep=2000)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.infill import fill_in_middle, restored

    made = restored(fill_in_middle(_table(spark, sf_dir, "documents"), rate=50, spm_rate=80, seed=42,
                                   columns=["doc_id"]))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {
    "op1_prefix_decontamination": op1_prefix_decontamination,
    "op2_pfor_tokens": op2_pfor_tokens,
    "op3_bucket_pointer_repeats": op3_bucket_pointer_repeats,
    "op4_nn_descent": op4_nn_descent,
    "op5_flow_mix": op5_flow_mix,
    "op6_feistel_shards": op6_feistel_shards,
    "op7_host_reputation": op7_host_reputation,
    "op8_oph_near_duplicates": op8_oph_near_duplicates,
    "op9_instance_toxicity": op9_instance_toxicity,
    "op10_backoff_scores": op10_backoff_scores,
    "op11_line_dedup": op11_line_dedup,
    "op12_collocations": op12_collocations,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLE_SQL: dict[str, str] = {
    "op1_prefix_decontamination": oracles.DECONTAMINATION,
    "op7_host_reputation": oracles.url_reputation(URL_RULES),
    "op10_backoff_scores": oracles.BACKOFF,
    "op11_line_dedup": oracles.LINES,
    "op12_collocations": oracles.COLLOCATIONS,
    "op13_fill_in_middle": oracles.INFILL,
}
