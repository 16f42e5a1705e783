"""From raw documents to packed training sequences, one operator per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs. All stages but the last return the columns of documents.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assortment.llm import decontaminate, packing, quality_gam, secret_scan, simhash
from assortment.llm.texts import side
from assortment.sources.lineage import cut

#: The fingerprints of stage 2 and the fitted model of stage 1 have no SQL form; tests hold the whole pipeline
#: against plain Python.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` written once with a number of its own for each row, and that column's name, which `docs` does not have."""
    taken, name = {c.lower() for c in docs.columns}, "_row"
    while name in taken:
        name += "_"
    return cut(docs.withColumn(name, F.monotonically_increasing_id())), name


def _without(docs: DataFrame, number: str, rows: DataFrame) -> DataFrame:
    """Numbered rows whose number is not in `rows`, without it."""
    return docs.join(side(rows.toDF(number)), number, "left_anti").drop(number)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold; learned from the labels that are not held out.

    A null text counts as an empty one, rows with a null doc_id and repeated rows are scored like any other, and all
    columns stay as they are, whatever their names. An empty table stays empty; without labels no document passes.
    """
    model = quality_gam.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality_gam.score(F.col("text"), model) >= quality_gam.KEEP_FROM)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows of each component of near duplicates the one with the smallest doc_id.

    Null ids come last; equal ids go by text hash, then row. Rows in different components all stay, whatever
    their ids are; null and empty texts are one component. All columns stay as they are, an empty table stays empty.
    """
    rows, number = _numbered(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("print"), F.col(number).alias("row"))
    found = simhash.near_duplicates(rows.select(order.alias("order"), "text"), key="order")
    return _without(rows, number, found.where(F.col("order.row") != F.col("component.row")).select("order.row"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by the benchmark.

    Each row is judged by its own text, whatever its doc_id is; a null or empty text has no words and stays. All
    columns stay as they are, an empty table stays empty.
    """
    rows, number = _numbered(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(rows.select(F.col(number).alias("row"), "text"), benchmark, key="row")
    return _without(rows, number, found.where("contaminated").select("row"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; n_chars follows the text.

    A null text becomes an empty one, of no characters; rows with a null doc_id and repeated rows stay. Columns
    beside text and n_chars stay as they are. An empty table stays empty.
    """
    clean = docs.withColumn("text", secret_scan.redacted(F.col("text")))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences.

    Every row is packed: a null or empty text as its end mark alone, repeated rows and null ids as often as they
    appear. Other columns do not matter. An empty table gives no rows.
    """
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", uncontaminated),
    ("secret_scans", without_secrets),
    ("best_fit_packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what each keeps is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
