"""Row numbers over a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.sources.scratch import written


def numbered(rows: DataFrame, order: list[Column | str], name: str = "row_no") -> DataFrame:
    """rows with 1, 2, ... in the given order, which should be total. Rows are dealt by ranges of the order and numbered in each
    part; the parts' sizes, a row for each part, give where each begins. The dealt rows are written down, since two runs of
    a deal by ranges can differ."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = written(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(F.col("_part").alias("_p")).agg(F.count("*").alias("n"))
    base = sizes.select("_p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    return dealt.join(base, F.col("_part") == F.col("_p")).withColumn(name, F.col("_base") + F.col("_at") + 1).drop("_part", "_at", "_p", "_base")
