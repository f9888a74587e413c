"""Totals per key where a few keys hold most rows: aggregation in a tree.

Each chunk of input (one input split, of a fixed size) is combined locally; the states of one key then meet in rounds
of at most ``fan_in`` states each, so that no task receives all partial states of a heavy key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expected_chunks(df: DataFrame) -> int:
    """How many partitions df may have, from the planner's estimate of its size; nothing is run for it."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return min(1 << 20, max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-size // split)))


def tree_aggregate(df: DataFrame, keys: list[str], measures: dict[str, tuple[str, Column]], fan_in: int = 32, chunks: int | None = None) -> DataFrame:
    """Totals of df per key.

    measures: name -> (kind, column), kind being "sum", "count" (rows in which the column isn't null), "min" or "max".
    Every round groups by key and by the number of the ``fan_in`` states that meet in it; the state of a chunk is what is combined before the first shuffle. The number of
    rounds is the logarithm of the number of chunks (by default :func:`expected_chunks`; should there be more, more of them meet in the first round) to the base fan_in; sums of integers are exact in
    whatever order they meet. Null keys form a group, nulls in a measure don't count, a sum over nothing is null; an empty
    table has no groups. Columns other than keys and measures are ignored, whatever their names.
    """
    chunks = chunks or expected_chunks(df)
    first = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    again = first | {"count": F.sum}
    width = -(-chunks // fan_in)
    state = df.select(*keys, *(c.alias(name) for name, (_, c) in measures.items()), F.floor(F.pmod(F.spark_partition_id(), F.lit(chunks)) / fan_in).cast("int").alias("__chunk"))
    step = first
    while width > 1:
        state = state.groupBy(*keys, "__chunk").agg(*(step[kind](F.col(name)).alias(name) for name, (kind, _) in measures.items()))
        state = state.withColumn("__chunk", F.floor(F.col("__chunk") / fan_in).cast("int"))
        width, step = -(-width // fan_in), again
    return state.groupBy(*keys).agg(*(step[kind](F.col(name)).alias(name) for name, (kind, _) in measures.items()))


def first_delivery(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key: the first by ``order``. The keys together are fine enough not to be skewed; the choice is made by
    a partial aggregate before the shuffle. Rows of null keys count as one group."""
    rest = [c for c in df.columns if c not in {*keys, *order}]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__row"), F.count("*").alias("deliveries"))
    return picked.select(*keys, *(F.col("__row")[c].alias(c) for c in [*order, *rest]), "deliveries")


def heavy_keys(df: DataFrame, key: str, share: float, fan_in: int = 32) -> DataFrame:
    """Keys with at least the given share of all rows as delivered, with their rows; null is no key."""
    total = df.count()
    counts = tree_aggregate(df.filter(F.col(key).isNotNull()), [key], {"n": ("count", F.lit(1))}, fan_in)
    return counts.filter(F.col("n") >= share * total).select(key, "n", F.lit(total).alias("total"))
