"""Running totals and positions over a whole table without one ordered task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchspark.session import materialize


def running_total(df: DataFrame, order: list[Column], out: str, weight: Column | None = None) -> DataFrame:
    """Add ``out``: the sum of ``weight`` (default 1: the position) over all rows up to each one in ``order``.

    Rows are range-partitioned by ``order`` into as many parts as
    ``spark.sql.shuffle.partitions`` says, the setting that follows the data,
    and written once, so both uses below see the same parts. The parts' totals
    (one row per part, so the broadcast is bounded by that setting) give each
    part's offset. Inside a part, positions are numbered when it is written, in its order, so rows are shuffled
    once; sums of weights come from a window. ``order`` should end in a key: equal rows cannot be split.
    ``df`` is read twice, for the ranges and for the rows.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)

    def offsets(placed: DataFrame, total: Column) -> DataFrame:
        sums = placed.groupBy("_part").agg(total.alias("_sum"))
        return F.broadcast(sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off")))

    if weight is None:
        # The id's upper bits are the part, its lower ones count the part's rows from 0.
        placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
        placed = materialize(placed.withColumn("_part", F.shiftright("_id", 33)), "running-total")
        inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
        return placed.join(offsets(placed, F.count(F.lit(1))), "_part").withColumn(out, F.col("_off") + inside).drop("_part", "_id", "_off")
    placed = (df.withColumn("_w", weight).repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    placed = materialize(placed, "running-total")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (placed.join(offsets(placed, F.sum("_w")), "_part").withColumn(out, F.col("_off") + F.sum("_w").over(inside))
            .drop("_part", "_w", "_off"))
