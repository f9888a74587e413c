"""A sample in given proportions of categories, from reservoirs that can be merged."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.storage import cut


def _reservoirs(capacity: dict[int, int], compact: int = 200_000):
    """Per partition, one pass: the ``capacity`` records of least random priority of each category. Two such
    states are merged by uniting them and cutting again."""
    most = np.array([capacity[k] for k in sorted(capacity)])

    def trim(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["category", "priority", "id"], kind="stable")
        place = df.groupby("category").cumcount().to_numpy()
        return df[place < most[df["category"].to_numpy()]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, limit = [], 0, compact
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size > limit:
                held = [trim(pd.concat(held))]
                size = len(held[0])
                limit = max(compact, 2 * size)
        if held:
            yield trim(pd.concat(held))

    return run


def _shared(total: int, weights: list[float], least: list[int], most: list[int]) -> list[int]:
    """Whole numbers in proportion to the weights within their limits, adding up to ``total`` if the limits allow it (else to what is nearest)."""
    total = min(max(total, sum(least)), sum(most))
    w, low, high = np.array(weights, float), np.array(least, float), np.array(most, float)
    unit = lambda x: np.clip(w * x, low, high)
    a, b = 0.0, float((high / np.where(w > 0, w, np.inf)).max(initial=0.0)) + 1.0
    for _ in range(200):
        middle = (a + b) / 2
        a, b = (middle, b) if unit(middle).sum() < total else (a, middle)
    exact = unit(b)
    out = np.clip(np.floor(exact + 1e-6), low, high).astype(np.int64)
    order = sorted(range(len(w)), key=lambda i: (out[i] - exact[i], -w[i], i))
    left = total - int(out.sum())
    while left:
        step = 1 if left > 0 else -1
        some = [i for i in (order if step > 0 else order[::-1]) if (out[i] < high[i] and w[i] > 0 if step > 0 else out[i] > low[i])] or [i for i in order if low[i] <= out[i] + step <= high[i]]
        for i in some[: abs(left)]:
            out[i] += step
            left -= step
    return out.tolist()


def feasible(targets: list[float], groups: list[str], counts: list[int], size: int) -> list[int]:
    """Whole quotas for a sample of ``size``: in proportion to the targets, never above the count, at least 1 where there is anything.
    What a category can't give goes to the others of its group in proportion to their targets, then stays open. The minima are taken
    from the larger categories, of other groups if need be; only where they alone exceed the size do the quotas add up to more than it."""
    size = int(size)
    if not sum(targets) or not size:
        return [0] * len(targets)
    least = [int(t > 0 and n > 0) for t, n in zip(targets, counts)]
    names = list(dict.fromkeys(groups))
    own = {g: [i for i, x in enumerate(groups) if x == g] for g in names}
    whole = _shared(size, [sum(targets[i] for i in own[g]) for g in names], [sum(least[i] for i in own[g]) for g in names], [max(size, len(targets)) if any(targets[i] > 0 for i in own[g]) else 0 for g in names])
    quotas = [0] * len(targets)
    for g, total in zip(names, whole):
        part = _shared(total, [targets[i] for i in own[g]], [least[i] for i in own[g]], [counts[i] if targets[i] > 0 else 0 for i in own[g]])
        for i, q in zip(own[g], part):
            quotas[i] = q
    return quotas


def _threshold(quota: int, count: int) -> int:
    """A priority (of 63 bits) below which at least ``quota`` of ``count`` random ones lie, but for a chance of about one in 10 ** 15."""
    if not count:
        return 0
    share = (quota + 8 * math.sqrt(quota + 16) + 32) / count
    return (1 << 63) - 1 if share >= 1 else int(share * (1 << 63))


def quota_sample(records: DataFrame, categories: DataFrame, size: float, seed: int = 11, limit: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """A sample and its report.

    records: id and the key columns of categories. categories: key columns, ``target`` and ``bucket``; one row each, few enough to
    be collected and broadcast (``limit``). Sample: id, category keys, bucket. Report, one row per category: keys, target, bucket,
    available, wanted (target share of size), quota, sampled, short (available < wanted), raised (the quota is above the share, since at least one was to be taken). Records without
    id or outside every category don't take part;
    categories with a null target take no part and aren't reported; repeated ones count once. Ties of the random priority
    are broken by id. The priority is a hash of id and seed: the same records give the same sample. The records are counted first;
    a record whose priority is far above what its category's quota can reach doesn't enter a reservoir (should fewer than the quota be left, all do).
    """
    spark = records.sparkSession
    keys = [c for c in categories.columns if c not in ("target", "bucket")]
    rows = categories.filter("target is not null").distinct().orderBy(*keys, F.desc("target")).dropDuplicates(keys).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories")
    rows = sorted(rows, key=lambda r: tuple(str(r[k]) for k in keys))
    whole = sum(r["target"] for r in rows) or 1
    fields = [categories.schema[k] for k in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    numbered = spark.createDataFrame([(*(r[k] for k in keys), i) for i, r in enumerate(rows)], f"{schema}, category int")
    own = records.select("id", *keys).filter("id is not null").join(F.broadcast(numbered), keys).select(F.col("id").cast("long").alias("id"), "category", F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 1).alias("priority"))
    counted = {r["category"]: r["n"] for r in own.groupBy("category").agg(F.count("*").alias("n")).collect()}
    counts = [counted.get(i, 0) for i in range(len(rows))]
    quotas = feasible([r["target"] for r in rows], [r["bucket"] for r in rows], counts, size)
    capacity = dict(enumerate(quotas)) or {0: 1}

    def reservoirs(all_of: set[int]) -> DataFrame:
        most = [(i, (1 << 63) - 1 if i in all_of else _threshold(q, n)) for i, (q, n) in enumerate(zip(quotas, counts))]
        near = own.join(F.broadcast(spark.createDataFrame(most, "category int, most long")), "category").filter("priority <= most").select("id", "category", "priority")
        return cut(near.mapInPandas(_reservoirs(capacity), "id long, category int, priority long"))

    state = reservoirs(set())
    held = {r["category"]: r["n"] for r in state.groupBy("category").agg(F.count("*").alias("n")).collect()}
    if few := {i for i, q in enumerate(quotas) if held.get(i, 0) < q}:
        state = reservoirs(few)
    # Final trim without one task per category: whole ranges of the priority, and ranks within the range that is cut. The ranges of a category divide
    # what its threshold lets through.
    width = spark.createDataFrame([(i, max(1, _threshold(q, n) >> 10 if i not in few else 1 << 53)) for i, (q, n) in enumerate(zip(quotas, counts))], "category int, width long")
    ranges = state.join(F.broadcast(width), "category").withColumn("range", F.floor(F.col("priority") / F.col("width"))).drop("width")
    sums = ranges.groupBy("category", "range").agg(F.count("*").alias("here"))
    up_to = sums.withColumn("upto", F.sum("here").over(Window.partitionBy("category").orderBy("range")))
    limits = spark.createDataFrame(list(enumerate(quotas)), "category int, quota long")
    marks = up_to.join(F.broadcast(limits), "category").filter(F.col("upto") - F.col("here") < F.col("quota")).select("category", "range", (F.col("quota") - (F.col("upto") - F.col("here"))).alias("take"))
    place = F.row_number().over(Window.partitionBy("category", "range").orderBy("priority", "id"))
    chosen = cut(ranges.join(marks, ["category", "range"]).withColumn("place", place).filter("place <= take").select("id", "category"))
    taken = {r["category"]: r["n"] for r in chosen.groupBy("category").agg(F.count("*").alias("n")).collect()}
    detail = []
    for i, r in enumerate(rows):
        wanted = size * r["target"] / whole
        detail.append((i, *(r[k] for k in keys), r["bucket"], int(r["target"]), counts[i], wanted, quotas[i], taken.get(i, 0), counts[i] < wanted, quotas[i] == 1 and wanted < 1))
    report = spark.createDataFrame(detail, f"category int, {schema}, bucket string, target long, available long, wanted double, quota long, sampled long, short boolean, raised boolean")
    return chosen.join(F.broadcast(report.select("category", *keys, "bucket")), "category").drop("category"), report.drop("category")
