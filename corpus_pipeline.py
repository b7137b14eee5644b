"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; docs are the rows that
the stage before it kept. All but the last give the columns of documents, and other
columns are ignored. An empty table gives an empty one. Null texts count as empty; rows
without a doc_id, and rows that repeat one, are kept or dropped as each stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepwise.llm.line_dedup import drop_repeated_lines
from stepwise.llm.mixing import mix, word_count
from stepwise.llm.near_dedup import near_duplicates
from stepwise.llm.packing import pack
from stepwise.llm.quality import classify, measured, quality_model
from stepwise.llm.queries import tokenizer_path
from stepwise.session import prepare

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on sf_dir's labels, doesn't reject; every row is judged by its own text, with a doc_id or without."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs.select(*COLUMNS), quality_model(measured(docs), labels)).filter("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document has; n_chars follows.

    Rows that share a doc_id are one document; rows without one are one that comes last.
    A null text becomes an empty one.
    """
    prepare(spark)
    out = drop_repeated_lines(docs, carry=["lang", "source"])
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id.

    Rows that share a doc_id stay or go together; rows without one, and without words, stay.
    """
    prepare(spark)
    kept = near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)
    return named.union(docs.filter("doc_id IS NULL").select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; rows that repeat a doc_id, or have none, are documents of their own.

    Only ids, sizes and a hash of the text are mixed. Rows that agree in all of these share their copies evenly.
    """
    prepare(spark)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(*COLUMNS, F.xxhash64("doc_id", "source", text).alias("_row"), F.xxhash64(text, F.lit(1)).alias("_text"))
    sized = rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), "_row", "_text")
    copies = mix(sized).groupBy("_row", "_text").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).filter("_copies > 0")
    same = Window.partitionBy("_row", "_text")
    out = rows.join(copies, ["_row", "_text"]).withColumn("_at", F.row_number().over(same.orderBy("_row")))
    times = F.floor(F.col("_copies") / F.col("_rows")) + F.when(F.col("_at") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    return out.withColumn("_times", times.cast("int")).filter("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with their ids; every row is a document, whatever its doc_id."""
    prepare(spark)
    return pack(docs, tokenizer_path(), with_ids=True)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near), ("mixing", mixing), ("packing", packing)]

#: No stage but line_dedup is expressible in SQL, so run() is tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = docs.checkpoint()  # later stages read their input more than once
    return docs
