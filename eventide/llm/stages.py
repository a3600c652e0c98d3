"""The stages of the corpus pipeline, each around one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm.scratch import materialize

#: The columns every stage but the last hands on.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _document_columns(docs: DataFrame) -> list[str]:
    return [c for c in DOCUMENT_COLUMNS if c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a model of the labelled ones.

    A null, empty or blank text scores 0 and stays, as does everything where no
    toxic document is labelled; rows that repeat are scored one by one; long
    texts are scored whole; an empty table stays empty; extra columns go."""
    from eventide.llm.toxicity import score_documents, train

    cols = _document_columns(docs)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model, columns=cols).filter(F.col("score") < 0.5).select(*cols)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, 0.8.

    The row with the smallest doc_id stays (null last).  Where an id repeats or
    is null, rows are told apart by a number of their own, so only rows whose
    own text is a copy go; equal rows are copies of each other, and one stays.
    A row without words is nobody's copy and stays, and an empty table stays
    empty.  Long texts are compared whole."""
    from eventide.llm.minhash import near_duplicates

    cols = _document_columns(docs)
    vague = (docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
             .filter("n > 1 OR doc_id IS NULL").limit(1).count())
    if not vague:
        gone = near_duplicates(docs, shingle=5, percent=80).filter(~F.col("kept")).select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*cols)
    rows = materialize(docs.select(*cols, F.monotonically_increasing_id().alias("__row")), "numbered")
    found = (near_duplicates(rows, shingle=5, percent=80, id_col="__row")
             .select(F.col("doc_id").alias("__row"), "component_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "__row")).alias("first")
    stay = (found.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(first)
            .select("first.__row"))
    return rows.join(stay, "__row", "left_semi").select(*cols)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item (an item of
    fewer words is one window).

    A null, empty or blank text holds no window and stays; an item without words
    has none; rows that repeat are judged one by one; long texts are read whole;
    empty tables of documents or items drop nothing; extra columns go."""
    from eventide.llm.decontaminate import decontaminate

    cols = _document_columns(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items, window=10, containment=1.0, columns=cols) \
        .filter(F.size("hit_spans") == 0).select(*cols)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to 3 times.

    Sources weigh 5, 2, 1 by code point, null last; a text without words has no
    size and is taken as its source's draw falls; rows that repeat are drawn one
    by one; an empty table stays empty; extra columns go."""
    from eventide.llm.mixing import mix

    cols = _document_columns(docs)
    return (mix(docs, [5.0, 2.0, 1.0], max_repeat=3, carry=cols)
            .filter(F.col("repeats") > 0)
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
            .select(*cols))


def shard_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's number, shard of 8 and slot, counts at most one apart.

    Null texts and ids are placed like others (a null text has size 1); rows
    that repeat, as after mixing, each have a place; an empty table gives none;
    extra columns go."""
    from eventide.llm.sharding import feistel_shards

    return feistel_shards(docs, 8, carry=["doc_id"]).select(
        "doc_id", "size", "text_crc32", "row_number", "shard", "slot")
