"""Dense ranks of a distributed, ordered set, without a global window.

``count_below`` numbers sorted values by range partitions: each partition numbers
its own values, the partitions' totals (one row each, a count we choose) are summed
up in order, and every value's rank is its partition's start plus its place there.
Values that are only asked about (not counted) lie in the same order, so a lower
bound search of any number of values costs no more than the ranks themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.operators.ordered import PID, POS, ordered_layout, tasks_for


def count_below(counted: DataFrame, asked: DataFrame | None = None, num_partitions: int | None = None) -> DataFrame:
    """(value, counted, below) for every distinct value of the one-column tables:
    ``below`` is the number of distinct counted values smaller than it. For a counted
    value that is its dense rank from 0; for an asked one it is the rank of the
    first counted value that is not smaller. Nulls have no rank and are left out."""
    points = counted.toDF("value").withColumn("counted", F.lit(1).cast("long"))
    if asked is not None:
        points = points.unionByName(asked.toDF("value").withColumn("counted", F.lit(0).cast("long")))
    points = points.where(F.col("value").isNotNull()).groupBy("value").agg(F.max("counted").alias("counted"))
    n = num_partitions or tasks_for(points.sparkSession, 0)
    laid = ordered_layout(points, [], ["value"], n)
    starts = (laid.groupBy(PID).agg(F.sum("counted").alias("own"))
              .select(PID, (F.sum("own").over(Window.orderBy(PID)) - F.col("own")).alias("start")))
    inside = F.sum("counted").over(Window.partitionBy(PID).orderBy(POS)) - F.col("counted")
    return (laid.withColumn("inside", inside).join(F.broadcast(starts), PID)
            .select("value", (F.col("counted") == 1).alias("counted"), (F.col("start") + F.col("inside")).alias("below")))


def rank_rows(low: Column, high: Column, block: int = 4096) -> tuple[Column, Column]:
    """Two generators that turn a range of ranks into its members, one after the other:
    ``block`` starts, then the members of each block, so that no row ever carries an
    array longer than ``block``. The second refers to the first as column ``block``."""
    starts = F.explode(F.sequence(low, high, F.lit(block).cast("long")))
    members = F.explode(F.sequence(F.col("block"), F.least(F.col("block") + F.lit(block - 1), high)))
    return starts, members
