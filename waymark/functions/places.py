"""Places in one order of a whole table, without a task that holds it: rows are dealt by ranges, numbered within theirs, and what stands before a range is summed over ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialize


def in_order(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """df, written, with part and place (from 0 within its part): rows of one part stand before those of the next. df is worked out twice, and should be the same both times.

    Rows that are equal by order may be any number: chance deals them out.
    """
    dealt = df.withColumn("chance", F.rand(7)).repartitionByRange(*order, F.col("chance")).sortWithinPartitions(*order).drop("chance")
    placed = materialize(dealt.withColumn("at", F.monotonically_increasing_id()), label)
    return placed.withColumns({"part": F.shiftright("at", 33), "place": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("at")


def before_parts(placed: DataFrame, sums: dict[str, Column], part: str = "part") -> DataFrame:
    """part and, under each name, the sum over all parts before it. A row a partition, so that a broadcast is bounded by their number."""
    each = placed.groupBy(part).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    past = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(each.select(part, *[F.coalesce(F.sum(n).over(past), F.lit(0)).alias(n) for n in sums]))


def numbered(df: DataFrame, order: list[Column], label: str, into: str = "rank") -> DataFrame:
    """df with its rows' places, from 0, in order."""
    placed = in_order(df, order, label)
    return placed.join(before_parts(placed, {into: F.lit(1).cast("long")}), "part").withColumn(into, F.col(into) + F.col("place")).drop("part", "place")
