"""Sources mixed to target weights: how much of each is used, and in which order, by Pfair scheduling of blocks."""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.names import source_key
from leafmill.storage import cut


def schedule(shares: dict[str, float], slots: int) -> list[tuple[str, int, int]]:
    """(source, block, slot) for each slot. Block j of a source with share w is released at j/w and due at (j+1)/w; of the
    released blocks the one due first gets the slot. With shares adding up to 1 each source is at all times less than one block away from
    its share."""
    waiting: list[tuple[int, int, str, int]] = []
    for name, w in sorted(shares.items()):
        if w > 0:
            heapq.heappush(waiting, (0, math.ceil(1 / w - 1e-9), name, 0))
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, due, name, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, name, j))
        if not ready:
            continue
        _, name, j = heapq.heappop(ready)
        out.append((name, j, slot))
        w = shares[name]
        heapq.heappush(waiting, (math.floor((j + 1) / w + 1e-9), math.ceil((j + 2) / w - 1e-9), name, j + 1))
    return out


class Mix:
    """A mixture of ``total`` tokens (by default the tokens of all documents) in the weights of the targets.

    sizes: doc_id, source, n_tokens. targets: source, weight, max_repeats; a few rows (one per source), which are collected
    and broadcast. Sources are the same if they differ in case, white space around or word separators only. Rows without doc_id,
    source or tokens don't take part (their tokens still count for the total); a target without weight counts as 0, one without
    max_repeats as used once; of repeated targets of a source the first row by weight holds. A source whose tokens times
    max_repeats don't suffice gives all it has, and is named by :meth:`short`.
    """

    def __init__(self, sizes: DataFrame, targets: DataFrame, total: int | None = None, slots: int | None = None, limit: int = 10_000, seed: int = 7):
        self.spark, self.seed = sizes.sparkSession, seed
        self.sizes = cut(sizes.select("doc_id", source_key(F.col("source")).alias("source"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")))
        rows = targets.filter("source is not null").limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"more than {limit} targets")
        keyed = self.spark.createDataFrame([(r["source"], float(r["weight"] or 0), int(r["max_repeats"] if r["max_repeats"] is not None else 1)) for r in rows], "name string, weight double, max_repeats int")
        keyed = keyed.withColumn("source", source_key(F.col("name"))).orderBy(F.desc("weight"), "name").dropDuplicates(["source"])
        used = self.sizes.filter("doc_id is not null and n_tokens > 0")
        have = used.join(F.broadcast(keyed.select("source")), "source").groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
        everything = self.sizes.agg(F.sum("n_tokens")).first()[0] or 0
        self.total = everything if total is None else total
        self.slots = slots or min(1 << 20, max(4096, self.total >> 24))  # blocks of 16 million tokens, but never fewer than 4,096 nor over a million of them
        plan = keyed.join(have, "source", "left").select("source", "name", "weight", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.lit(self.total).cast("long").alias("total")).collect()
        self.plan = []
        for r in plan:
            wanted, capacity = r["weight"] * self.total, r["tokens"] * max(0, r["max_repeats"])
            self.plan.append((r["source"], r["name"], r["weight"], r["max_repeats"], r["tokens"], wanted, min(wanted, float(capacity))))

    def _table(self) -> DataFrame:
        return self.spark.createDataFrame(self.plan, "source string, name string, weight double, max_repeats int, tokens long, wanted double, quota double")

    def _reached(self) -> DataFrame:
        """The targets with what the mixture uses of each: a source is short whose uses, after all repeats, don't reach its weight."""
        used = self.chosen().groupBy("source").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("uses"))
        return self._table().join(used, "source", "left").fillna(0, ["used", "uses"]).withColumn("short", F.col("used") < F.col("wanted"))

    def short(self) -> DataFrame:
        """Sources (as spelled in the targets) that don't give their weight in the mixture."""
        return self._reached().filter("short").select(F.col("name").alias("source"), "weight", "max_repeats", "tokens", "wanted")

    def chosen(self) -> DataFrame:
        """One row per use of a text: doc_id, source, repeat (from 1), n_tokens, block (within the source), slot (place of the block
        in the mixture), place (tokens of the source before it)."""
        used = self.sizes.filter("doc_id is not null and n_tokens > 0")
        key = F.xxhash64("doc_id", F.lit(self.seed))
        used = used.join(F.broadcast(self._table().select("source", "tokens", "quota", "max_repeats")), "source").select("*", key.alias("k"), F.shiftrightunsigned(key, 54).alias("bucket"))
        # Sums before a text: over the buckets of its source (1,024 a source at most, hash ranges), then within its bucket.
        sums = used.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n"))
        before = sums.select("source", "bucket", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        within = Window.partitionBy("source", "bucket").orderBy("k", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
        placed = used.join(before, ["source", "bucket"]).withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        uses = placed.filter("max_repeats > 0").select("doc_id", "source", "n_tokens", "quota", F.explode(F.sequence(F.lit(1), "max_repeats")).alias("repeat"), "start", "tokens")
        uses = uses.withColumn("place", F.col("start") + (F.col("repeat") - 1) * F.col("tokens")).filter("place < quota")
        full = sum(p[6] for p in self.plan)
        block = max(1.0, full / self.slots)
        order = schedule({p[0]: p[6] / full for p in self.plan} if full else {}, self.slots)
        slots = self.spark.createDataFrame(order or [], "source string, block int, slot int")
        uses = uses.withColumn("block", F.floor(F.col("place") / block).cast("int"))
        # The last, partial block of a source may lie beyond the slots; it follows them.
        return uses.join(F.broadcast(slots), ["source", "block"], "left").select("doc_id", "source", "repeat", "n_tokens", "block", F.coalesce("slot", F.lit(self.slots)).alias("slot"), "place")

    def shares(self) -> DataFrame:
        """Per source: weight, tokens, quota, tokens used and the real share."""
        whole = Window.partitionBy()  # one row per source, bounded by the targets
        return self._reached().select(F.col("name").alias("source"), "weight", "max_repeats", "tokens", "used", "uses", F.try_divide("used", F.sum("used").over(whole)).alias("real_share"), "short")
