"""States that follow from a log of attempts; the log is only ever appended to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.storage import Shelf


def outcome(log: DataFrame, most: int = 3) -> DataFrame:
    """Per document: done after a success, failed for good after ``most`` failures, open otherwise. Rows delivered twice count once."""
    once = log.select("id", "doc_id", "ts", "ok", "error").distinct()
    out = once.groupBy("doc_id").agg(F.count_if(F.col("ok")).alias("good"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("bad"), F.max_by(F.substring("error", 1, 500), F.struct("ts", "id")).alias("last_error"))
    return out.withColumn("state", F.when(F.col("good") > 0, "done").when(F.col("bad") >= most, "failed").otherwise("open"))


def stale(docs: DataFrame, now: str, seconds: int = 3600) -> DataFrame:
    """Documents being fetched for longer than the given time, to be taken up again."""
    since = F.coalesce("fetched_at", "discovered_at")
    return docs.filter("status = 'fetching'").filter(since < F.lit(now).cast("timestamp") - F.make_interval(secs=F.lit(seconds))).select("doc_id", since.alias("since"))


def failure_streaks(log: DataFrame, key: str) -> DataFrame:
    """The longest run of failures in a row per key, and the share of failures (for a breaker on either). Runs are found from
    places alone: the place among all less the place among equals is constant within a run."""
    w = lambda *by: Window.partitionBy(*by).orderBy("ts", "id")
    good = F.coalesce("ok", F.lit(False))
    runs = log.withColumn("good", good).withColumn("run", F.row_number().over(w(key)) - F.row_number().over(w(key, "good")))
    each = runs.groupBy(key, "good", "run").agg(F.count("*").alias("n"))
    return each.groupBy(key).agg(F.coalesce(F.max(F.when(~F.col("good"), F.col("n"))), F.lit(0)).alias("longest"), F.sum(F.when(~F.col("good"), F.col("n")).otherwise(0)).alias("failed"), F.sum("n").alias("attempts"))


def append_new(shelf: Shelf, name: str, existing: DataFrame | None, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Adds the rows whose key isn't there yet, the first of each key by order, and returns them. A null in a key is a key of its own
    row, which is always added."""
    once = new.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__place = 1").drop("__place")
    fresh = once if existing is None else once.join(existing.select(*keys), keys, "left_anti")
    return shelf.put(name, fresh)
