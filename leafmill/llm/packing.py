"""Items into containers of fixed capacity, with bounds that certify how near the packing is to the best possible one."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.storage import cut

_PACKED = "doc_id long, piece int, pieces int, tokens long, part long, bin long, fill long, bins long, bound long"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit of the sizes in the order given (decreasing): the bin of each, and the fill of the bins. Bins are found by a
    bit mask over their free space, so a step costs the same however many bins are open."""
    free: dict[int, list[int]] = {}
    mask, bins, fills = 0, np.empty(len(sizes), np.int64), []
    for k, s in enumerate(sizes.tolist()):
        above = mask >> s
        if above:
            room = s + (above & -above).bit_length() - 1
            own = free[room]
            b = own.pop()
            if not own:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[k] = b
        fills[b] += s
        if room > s:
            left = room - s
            free.setdefault(left, []).append(b)
            mask |= 1 << left
    return bins, np.array(fills, np.int64)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The most of the bounds by dual feasible functions: the plain volume, the functions that round x to multiples of 1/k, and
    those that count items above 1 - e as whole and leave out items below e."""
    if not len(sizes):
        return 0
    values, counts = np.unique(sizes.astype(np.int64), return_counts=True)
    best = -(-int((values * counts).sum()) // capacity)
    for k in range(1, 31):
        whole = (values * (k + 1)) % capacity == 0
        part = np.where(whole, values * k, (values * (k + 1)) // capacity * capacity)
        best = max(best, -(-int((part * counts).sum()) // (k * capacity)))
    # Every e up to half the capacity: between two sizes the bound only grows with e, so the sizes and the half itself are enough.
    e = np.append(values[values <= capacity // 2], capacity // 2)
    number, volume = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(values * counts))
    low, high = np.searchsorted(values, e, "left"), np.searchsorted(values, capacity - e, "right")
    scaled = volume[high] - volume[low] + capacity * (number[-1] - number[high])
    return max(best, -(-int(scaled.max()) // capacity))


def _pack(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        sizes = rows["tokens"].to_numpy()
        bins, fills = best_fit(sizes, capacity)
        return rows.assign(bin=bins, fill=fills[bins] if len(bins) else [], bins=len(fills), bound=lower_bound(sizes, capacity))[["doc_id", "piece", "pieces", "tokens", "part", "bin", "fill", "bins", "bound"]]

    return run


def pack(sizes: DataFrame, capacity: int = 4096, items_per_part: int = 20_000, rounds: int = 2) -> DataFrame:
    """The container of every piece of every item: doc_id, piece, pieces, tokens, container, fill.

    sizes has doc_id and n_tokens. Only an item above the capacity is divided, into full pieces and a rest. Items without
    size (null, 0) need no container and are left out; equal items are told apart by doc_id. Parts of about
    ``items_per_part`` items are packed by best-fit decreasing; a part whose number of bins meets its lower bound is
    certified and stays. The others give up the items of their bins that aren't full; these are dealt anew among fewer parts
    and packed again, ``rounds`` times.
    """
    n = F.col("n_tokens")
    pieces = F.ceil(n / F.lit(capacity)).cast("int")
    items = sizes.filter("doc_id is not null and n_tokens > 0").select("doc_id", n, pieces.alias("pieces"), F.explode(F.sequence(F.lit(1), pieces)).alias("piece"))
    items = cut(items.select("doc_id", "piece", "pieces", F.when(F.col("piece") < F.col("pieces"), F.lit(capacity)).otherwise(n - (F.col("pieces") - 1) * capacity).cast("long").alias("tokens")))
    total = items.count()
    parts = max(1, math.ceil(total / items_per_part))

    def deal(df: DataFrame, parts: int, seed: int) -> DataFrame:
        return df.select("doc_id", "piece", "pieces", "tokens", (F.pmod(F.xxhash64("doc_id", "piece", F.lit(seed)), F.lit(parts)) + F.lit(seed << 40)).alias("part"))

    packed = cut(deal(items, parts, 0).groupBy("part").applyInPandas(_pack(capacity), _PACKED))
    done = None
    for k in range(1, rounds + 1):
        loose = F.col("bins") > F.col("bound")
        settled = packed.filter(~loose | (F.col("fill") == capacity))
        again = packed.filter(loose & (F.col("fill") < capacity))
        n_again, before = again.agg(F.count("*"), F.count_distinct("part", "bin")).first()
        if not n_again:
            break
        tried = cut(deal(again, max(1, math.ceil(n_again / (items_per_part * 4**k))), k).groupBy("part").applyInPandas(_pack(capacity), _PACKED))
        after = tried.agg(F.count_distinct("part", "bin")).first()[0]
        if after >= before:
            break
        done = settled if done is None else done.unionByName(settled)
        packed = tried
    everything = packed if done is None else done.unionByName(packed)
    return everything.select("doc_id", "piece", "pieces", "tokens", F.concat_ws("-", "part", "bin").alias("container"), "fill")


def certificates(packed: DataFrame, capacity: int = 4096) -> DataFrame:
    """Per part that was packed on its own: its containers, the bound for its items by dual feasible functions, and whether they meet, so that no packing of
    these items needs fewer (parts that were taken apart keep their full containers, which always meet the bound)."""

    def bounds(rows: pd.DataFrame) -> pd.DataFrame:
        bins, bound = rows["container"].nunique(), lower_bound(rows["tokens"].to_numpy(), capacity)
        return pd.DataFrame({"part": rows["part"].iloc[:1], "items": len(rows), "tokens": int(rows["tokens"].sum()), "bins": bins, "bound": bound, "certified": bins == bound})

    part = F.substring_index("container", "-", 1).cast("long").alias("part")
    return packed.select("container", "tokens", part).groupBy("part").applyInPandas(bounds, "part long, items long, tokens long, bins long, bound long, certified boolean")


def report(packed: DataFrame, capacity: int = 4096) -> DataFrame:
    """One row: containers, items, tokens, the least possible number by volume, the sum of the parts' bounds, parts, certified parts, and the share of unused space."""
    parts = certificates(packed, capacity)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    out = parts.agg(F.coalesce(F.sum("bins"), F.lit(0)).alias("containers"), total("items"), total("tokens"), total("bound"), F.count("*").alias("parts"), F.count_if("certified").alias("certified"))
    return out.select("*", F.ceil(F.col("tokens") / capacity).alias("least"), F.round(1 - F.try_divide("tokens", F.col("containers") * capacity), 6).alias("unused"))
