"""A varied subset: greedy selection by determinant over composable core-sets."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.storage import cut


JITTER = 1e-3
_ITEM = "doc_id long, page_no int, kinds long, number int, `group` long, weight long, gain double, place int, part int"
_LIKE = ["kinds", "number", "group"]


def kernel(kinds: np.ndarray, number: np.ndarray, group: np.ndarray, i: int, jitter: float = JITTER) -> np.ndarray:
    """Similarity of item i to all: overlap of the sets of kinds (as bits), nearness of the numbers on a logarithmic scale, and
    whether the group is the same. A product of positive definite kernels, so it is one itself; the jitter makes copies of an item
    distinguishable, so that they are chosen only when nothing new is left."""
    same = np.bitwise_count(kinds & kinds[i])
    either = np.bitwise_count(kinds | kinds[i])
    overlap = np.where(either > 0, (same + 0.5) / (either + 0.5), 1.0)
    x = np.log1p(number)
    near = np.exp(-((x - x[i]) ** 2) * 4)
    out = overlap * near * np.where(group == group[i], 1.0, 0.6)
    out[i] += jitter
    return out


def greedy(kinds: np.ndarray, number: np.ndarray, group: np.ndarray, weight: np.ndarray, size: int, copies: np.ndarray | None = None) -> tuple[list[int], list[float]]:
    """Indices in order of choice, with the factor by which each raises the determinant. The Cholesky factor grows by one
    column per step; ties go to the larger weight, then to the first. With ``copies`` an index stands for so many equal items and is chosen up to
    as many times: those not chosen yet have one row of the factor in common."""
    n = len(kinds)
    open_ = np.ones(n, np.int64) if copies is None else copies.astype(np.int64).copy()
    size = min(size, int(open_.sum()))
    columns = np.zeros((n, size))
    left = np.full(n, 1.0 + JITTER)
    order = np.lexsort((np.arange(n), -weight))
    chosen, gains = [], []
    for k in range(size):
        gain = np.where(open_ > 0, left, -1.0)[order]
        i = int(order[np.flatnonzero(gain >= gain.max() - 1e-12)[0]])
        chosen.append(i)
        gains.append(float(left[i]))
        open_[i] -= 1
        new = (kernel(kinds, number, group, i, 0.0) - columns[:, :k] @ columns[i, :k]) / math.sqrt(max(left[i], 1e-12))
        columns[:, k] = new
        left = np.maximum(left - new**2, 1e-9)
    return chosen, gains


def _coreset(size: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # Of like items those of other documents come first.
        turn = rows.sort_values(["doc_id", "page_no"], kind="stable").groupby([*_LIKE, "doc_id"], sort=False).cumcount()
        rows = rows.assign(turn=turn).sort_values(["turn", "doc_id", "page_no"], kind="stable").reset_index(drop=True)
        number = rows.groupby(_LIKE, sort=False).ngroup().to_numpy()
        members = [np.flatnonzero(number == k) for k in range(number.max() + 1)] if len(rows) <= 64 else np.split(np.argsort(number, kind="stable"), np.cumsum(np.bincount(number))[:-1])
        first = rows.iloc[[m[0] for m in members]]
        weight = np.bincount(number, weights=rows["weight"].to_numpy(np.float64))
        chosen, gains = greedy(first["kinds"].to_numpy(np.uint64), first["number"].to_numpy(np.float64), first["group"].to_numpy(), weight, size, np.array([len(m) for m in members]))
        used, at = [0] * len(members), []
        for c in chosen:
            at.append(members[c][used[c]])
            used[c] += 1
        out = rows.iloc[at].assign(gain=gains)
        return out.assign(place=np.arange(1, len(out) + 1, dtype=np.int32), part=np.int32(key[0]))[["doc_id", "page_no", "kinds", "number", "group", "weight", "gain", "place", "part"]]

    return run


def varied_subset(items: DataFrame, size: int = 300, per_part: int = 20_000, fan_in: int = 16, most: int = 8_000) -> DataFrame:
    """``size`` items (all, if there are fewer) that cover the variety, with their place in the order of choice and gain.

    items: doc_id, page_no, kinds (bits), number, group (a hash). Like items of one document are one candidate, with their number as weight. Parts of at
    most about per_part candidates each choose a core-set of
    ``size`` by greedy determinant maximisation; up to fan_in core-sets at a time are united and chosen from again, until one is left. If there are
    fewer candidates than ``size``, the further items behind them (of each at most ``size``) are chosen among in the same way.
    Rows with a null doc_id or page_no can't be named and are left out; other nulls count as 0. ``size`` is at most ``most``, as a task's factor
    grows with its square.
    """
    if size > most:
        raise ValueError(f"a subset of more than {most} items")
    fan_in = min(fan_in, max(2, (1 << 27) // (size * size)))
    own = items.filter("doc_id is not null and page_no is not null").select("doc_id", "page_no", *(F.coalesce(c, F.lit(0)).alias(c) for c in _LIKE))
    like = cut(own.groupBy("doc_id", *_LIKE).agg(F.min("page_no").alias("page_no"), F.count_distinct("page_no").alias("weight")).select("doc_id", "page_no", *_LIKE, "weight"))
    found = like.count()
    if found < size:  # every candidate is chosen: go on with what each of them stands for
        place = F.row_number().over(Window.partitionBy("doc_id", *_LIKE).orderBy("page_no"))
        rows = own.distinct().withColumn("k", place).filter(F.col("k") <= size).drop("k").withColumn("weight", F.lit(1).cast("long"))
        return rows.withColumn("part", F.lit(0)).groupBy("part").applyInPandas(_coreset(size), _ITEM).drop("part")
    parts = max(1, math.ceil(found / per_part))
    dealt = like.withColumn("part", F.pmod(F.xxhash64("doc_id", "page_no"), F.lit(parts)).cast("int"))
    while True:
        some = dealt.groupBy("part").applyInPandas(_coreset(size), _ITEM)
        if parts == 1:
            return some.drop("part")
        some = cut(some)
        dealt = some.withColumn("part", F.floor(F.col("part") / fan_in).cast("int"))
        parts = math.ceil(parts / fan_in)


def coverage(items: DataFrame, chosen: DataFrame, limit: int = 100_000) -> DataFrame:
    """How well a subset covers the items: per item the most similar chosen one and the similarity (1: alike). chosen has the columns
    doc_id, page_no, kinds, number, group and at most ``limit`` rows, which are collected and broadcast; items as in
    :func:`varied_subset`. Nothing is chosen: no rows."""
    rows = chosen.select("doc_id", "page_no", "kinds", "number", "group").orderBy("doc_id", "page_no").limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} chosen items")
    shared = items.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        own = shared.value
        kinds, number, group = own["kinds"].to_numpy(np.uint64), own["number"].to_numpy(np.float64), own["group"].to_numpy()
        known: dict[tuple, tuple[int, float]] = {}
        for some in batches:
            if not len(own):
                return
            best = []
            for k, x, g in zip(some["kinds"].tolist(), some["number"].tolist(), some["group"].tolist()):
                if (k, x, g) not in known:
                    if len(known) > 1_000_000:
                        known.clear()
                    near = kernel(np.append(kinds, np.uint64(k)), np.append(number, float(x)), np.append(group, np.int64(g)), len(kinds), 0.0)[:-1]
                    known[k, x, g] = (int(near.argmax()), float(near.max()))
                best.append(known[k, x, g])
            at = [b[0] for b in best]
            yield pd.DataFrame({"doc_id": some["doc_id"], "page_no": some["page_no"], "by_doc_id": own["doc_id"].to_numpy()[at], "by_page_no": own["page_no"].to_numpy()[at], "similarity": [b[1] for b in best]})

    whole = items.filter("doc_id is not null and page_no is not null").select("doc_id", "page_no", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("kinds", "number", "group")))
    return whole.mapInPandas(run, "doc_id long, page_no int, by_doc_id long, by_page_no int, similarity double")
