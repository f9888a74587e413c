"""At most so many records of each contributor, kept by quality; batches are merged into a state table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.storage import Shelf

_STATE = "contributor string, id long, quality double"


def _ranked(df: DataFrame, limit) -> DataFrame:
    """Rows with their place in their contributor; the filter on the place lets Spark cut each group down before the shuffle."""
    order = Window.partitionBy("contributor").orderBy(F.desc_nulls_last("quality"), F.asc("id"))
    return df.withColumn("__place", F.row_number().over(order)).filter(F.col("__place") <= limit)


class CapState:
    """Kept records and cutoff of each contributor.

    ``limit`` is the most records of a contributor, ``share`` the most of all records seen so far (both may be given; the
    lower holds, at least one record is kept). The records kept are those of the highest quality, then of the smallest id.
    With a share the limit rises with the rows seen, so displaced records stay candidates; with a count alone the cutoff
    only rises, and new records below it are dropped before the merge. Tables: ``kept`` (contributor, id, quality),
    ``cutoff`` (contributor, quality and id of the last kept one where the limit is reached), ``displaced`` per batch.
    """

    def __init__(self, spark: SparkSession, limit: int | None = None, share: float | None = None):
        if limit is None and share is None:
            raise ValueError("a limit or a share is needed")
        self.spark, self.limit, self.share = spark, limit, share
        self.shelf, self.version, self.seen = Shelf(spark, "caps"), 0, 0

    def kept(self) -> DataFrame:
        return self.shelf.get(f"kept-{self.version}") if self.version else self.spark.createDataFrame([], _STATE)

    def cutoff(self) -> DataFrame:
        full = self.kept().groupBy("contributor").agg(F.count("*").alias("n"), F.min(F.struct("quality", (-F.col("id")).alias("minus"))).alias("last"))
        return full.filter(F.col("n") >= self._limit()).select("contributor", F.col("last.quality").alias("cut_quality"), (-F.col("last.minus")).alias("cut_id"))

    def displaced(self) -> DataFrame:
        parts = [self.shelf.get(f"displaced-{k}").withColumn("batch", F.lit(k)) for k in range(1, self.version + 1)]
        out = parts[0] if parts else self.spark.createDataFrame([], f"{_STATE}, batch int")
        for x in parts[1:]:
            out = out.unionByName(x)
        return out

    def _limit(self) -> int:
        by_share = [max(1, int(self.share * self.seen + 1e-9))] if self.share is not None else []
        return min([*by_share, *([self.limit] if self.limit is not None else [])])

    def add(self, batch: DataFrame) -> DataFrame:
        """Merges a batch (contributor, id, quality) and returns the records kept now. Rows without contributor or id are left
        out, a null quality is the lowest, a record delivered again counts once with its best quality. The log has every
        record that lost its place with this batch, or never had one."""
        rows = batch.select(F.col("contributor").cast("string"), F.col("id").cast("long"), F.col("quality").cast("double").alias("quality")).filter("contributor is not null and id is not null")
        rows = rows.groupBy("contributor", "id").agg(F.coalesce(F.max("quality"), F.lit(float("-inf"))).alias("quality"))
        name = f"batch-{self.version + 1}"
        rows = self.shelf.put(name, rows)
        if self.share is not None:
            self.seen += rows.count()
        old = self.kept()
        limit = self._limit()
        candidates = old.unionByName(rows)
        if self.share is not None:
            candidates = candidates.unionByName(self.displaced().select("contributor", "id", "quality"))
        elif self.version:
            cut = self.cutoff()
            above = F.col("cut_id").isNull() | (F.col("quality") > F.col("cut_quality")) | ((F.col("quality") == F.col("cut_quality")) & (F.col("id") < F.col("cut_id")))
            candidates = old.unionByName(rows.join(cut, "contributor", "left").filter(above).select("contributor", "id", "quality"))
        best = candidates.groupBy("contributor", "id").agg(F.max("quality").alias("quality"))
        kept = self.shelf.put(f"kept-{self.version + 1}", _ranked(best, limit).drop("__place"))
        gone = old.unionByName(rows).select("contributor", "id", "quality").join(kept.select("contributor", "id"), ["contributor", "id"], "left_anti")
        self.shelf.put(f"displaced-{self.version + 1}", gone)
        self.shelf.drop(name)
        self.version += 1
        return kept
