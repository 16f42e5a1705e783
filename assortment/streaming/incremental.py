"""The embedding step fed by new files of `products_clean`."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from assortment.operators.embed import assign_batches, embed_rows, embedding_text, pending_embedding
from assortment.plans.run import follow_index
from assortment.sources.schemas import TABLES
from assortment.sources.tables import Catalogue


def incremental_stream(
    catalogue: Catalogue, source: str, progress: str, at: dt.datetime, embedder=None,
    max_files: int = 1000, **options,
) -> StreamingQuery:
    """Embed the products in new files under `source` that have no vector; ends when none is left.

    `progress` is the folder of the stream's progress. A batch that is repeated after a failure adds
    nothing twice, since products with a vector row are left out and ids are unique per batch. A stored index takes in
    the vectors of each batch.
    """
    catalogue.create("products_embedded")

    def add(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates(["product_id"])
        pending = pending_embedding(fresh, catalogue.read("products_embedded"))
        catalogue.append(embed_rows(assign_batches(embedding_text(pending)), at, embedder, **options), "products_embedded")
        follow_index(catalogue)

    stream = catalogue.spark.readStream.schema(TABLES["products_clean"])
    return (
        stream.option("maxFilesPerTrigger", max_files).parquet(source)
        .writeStream.foreachBatch(add).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )
