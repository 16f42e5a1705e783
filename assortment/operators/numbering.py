"""Row positions without a window over the whole table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assortment.sources.lineage import cut


def with_position(df: DataFrame, order: str, name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in `order` (a unique column).

    Rows are range partitioned and numbered inside their partition; the partition counts give the
    offsets. The offset table has one row per partition, so it is broadcast.
    """
    ranged = df.repartitionByRange(order).sortWithinPartitions(order)
    ranged = cut(ranged.withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + inside)
    return numbered.drop("_at", "_part", "_offset")
