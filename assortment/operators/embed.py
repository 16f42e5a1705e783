"""Product texts to vectors, batch by batch, for products that have none yet."""

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.text import product_text, tokens
from assortment.functions.vectors import hashed_vector
from assortment.operators.calls import in_groups, retried
from assortment.operators.numbering import with_position
from assortment.sources.lineage import cut
from assortment.sources.tables import Catalogue

GROUP_BATCHES = 64
HASHING_MODEL = "signed-feature-hashing"

# texts of one batch -> (one vector per text, tokens used by the batch)
Embedder = Callable[[list[str]], tuple[list[list[float]], int]]


def embedding_text(clean: DataFrame) -> DataFrame:
    return clean.select("product_id", product_text().alias("embedding_text"))


def pending_embedding(clean: DataFrame, embedded: DataFrame) -> DataFrame:
    """Products without a vector row."""
    columns = ["product_id", "name", "brand", "category", "department"]
    return clean.select(*columns).join(embedded.select("product_id"), "product_id", "left_anti")


def assign_batches(rows: DataFrame, size: int = fixed.EMBEDDING_BATCH) -> DataFrame:
    """Add `position` and `batch`: runs of `size` rows in id order."""
    placed = with_position(rows, "product_id")
    return placed.withColumn("batch", F.floor(F.col("position") / size))


def token_count(text: Column) -> Column:
    return F.size(tokens(text)).cast("long")


def split_batch_tokens(rows: DataFrame, total: str = "batch_tokens") -> DataFrame:
    """Add `embedding_tokens`: an even share of the tokens of the batch, the rest on its last row.

    The window holds one batch at a time.
    """
    batch = Window.partitionBy("batch")
    n = F.count(F.lit(1)).over(batch)
    share = F.floor(F.col(total) / n)
    last = F.col("position") == F.max("position").over(batch)
    rest = F.when(last, F.col(total) - share * n).otherwise(0)
    return rows.withColumn("embedding_tokens", share + rest)


def embedding_cost(count: Column) -> Column:
    return count * fixed.EMBEDDING_USD_PER_TOKEN


def embed_texts(rows: DataFrame, text: str, dim: int = fixed.EMBEDDING_DIM, name: str = "embedding") -> DataFrame:
    """Add a unit vector per text by signed feature hashing of its tokens.

    It needs no figures of other rows, so vectors of different runs compare. Row by row: no shuffle.
    """
    return rows.withColumn(name, hashed_vector(F.col(text), dim))


def _embed_batches(rows: DataFrame, embedder: Embedder) -> DataFrame:
    """One call per batch; a batch has a fixed number of rows."""

    embed = retried(embedder)

    def call(batch: pd.DataFrame) -> pd.DataFrame:
        vectors, used = embed(list(batch.embedding_text))
        if len(vectors) != len(batch):
            raise ValueError(f"{len(vectors)} vectors for {len(batch)} texts")
        return batch.assign(embedding=[list(map(float, v)) for v in vectors], batch_tokens=used)

    schema = "product_id long, embedding_text string, position long, batch long, embedding array<double>, batch_tokens long"
    return rows.groupBy("batch").applyInPandas(call, schema)


def embed_rows(
    batched: DataFrame, at: dt.datetime, embedder: Embedder | None = None, model: str | None = None,
    dim: int = fixed.EMBEDDING_DIM,
) -> DataFrame:
    """`products_embedded` rows for texts in batches."""
    if embedder is None:
        used = F.sum(token_count(F.col("embedding_text"))).over(Window.partitionBy("batch"))
        # Vectors come last, so that they are not part of a shuffle.
        rows = embed_texts(split_batch_tokens(batched.withColumn("batch_tokens", used)), "embedding_text", dim)
    else:
        texts = batched.select("product_id", "embedding_text", "position", "batch")
        rows = split_batch_tokens(_embed_batches(texts, embedder))
    return rows.select(
        "product_id", "embedding_text", "embedding",
        F.lit(model or (HASHING_MODEL if embedder is None else "custom")).alias("embedding_model"),
        "embedding_tokens", embedding_cost(F.col("embedding_tokens")).alias("embedding_cost_usd"),
        F.lit(at).cast("timestamp").alias("embedding_created_at"),
    )


def embed_incremental(
    catalogue: Catalogue, at: dt.datetime, embedder: Embedder | None = None,
    batch_size: int = fixed.EMBEDDING_BATCH, group_batches: int = GROUP_BATCHES, **options,
) -> dict:
    """Embed what is pending and append it; returns counts.

    With an embedder, `group_batches` batches are called side by side and appended before the next ones are: a
    failure keeps all groups before it, and the next run calls only for the rest. Hashed vectors cost nothing and
    are appended by one job.
    """
    pending = pending_embedding(catalogue.read("products_clean"), catalogue.read("products_embedded"))
    batched = assign_batches(embedding_text(pending), batch_size)
    groups = [batched] if embedder is None else in_groups(cut(batched), "batch", group_batches)
    embedded = tokens_used = 0
    for group in groups:
        written = Observation()
        rows = embed_rows(group, at, embedder, **options).observe(
            written, F.count(F.lit(1)).alias("embedded"), F.sum("embedding_tokens").alias("tokens")
        )
        catalogue.append(rows, "products_embedded")
        embedded, tokens_used = embedded + written.get["embedded"], tokens_used + (written.get["tokens"] or 0)
    return {
        "embedded": embedded, "total_tokens": tokens_used,
        "total_cost_usd": tokens_used * fixed.EMBEDDING_USD_PER_TOKEN,
    }
