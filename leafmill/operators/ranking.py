"""Deduplication, caps, interleaving and quotas over ranked rows. Every order is made total by the caller's tie columns."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.storage import cut


def _place(keys: list, order: list, name: str = "place") -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias(name)


def first_seen(df: DataFrame, keys: list[str], order: list, count: str | None = None) -> DataFrame:
    """The first row of each key, and how many others there were. Rows with a null in a key aren't duplicates of anything and stay."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    window = Window.partitionBy(*keys)
    found = df.filter(whole).withColumn("__place", _place(keys, order))
    if count:
        found = found.withColumn(count, F.count("*").over(window) - 1)
    rest = df.filter(~whole)
    return found.filter("__place = 1").drop("__place").unionByName(rest.withColumn(count, F.lit(0).cast("long")) if count else rest)


def cap(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each key. The rank filter cuts each key down within the input partitions, before the shuffle."""
    return df.withColumn("__place", _place(keys, order)).filter(F.col("__place") <= n).drop("__place")


def spread_places(df: DataFrame, keys: list[str], order: list, name: str = "place") -> DataFrame:
    """The place of every row among those of its keys, also where one key holds most rows: rows are divided into ranges of the order, each range numbers
    its own rows of a key, and what the ranges before hold of it is added. Only the counts (one row per range and key) meet by key. A null key is a key."""
    ranged = cut(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    counts = ranged.groupBy("__range", *keys).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("__range").alias("__r"), *(F.col(k).alias(f"__{k}") for k in keys), F.coalesce(before, F.lit(0)).alias("__before"))
    placed = ranged.withColumn("__within", F.row_number().over(Window.partitionBy("__range", *keys).orderBy(*order)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.col("__range") == F.col("__r"))
    return placed.join(offsets, same).select(*df.columns, (F.col("__within") + F.col("__before")).alias(name))


def interleave(df: DataFrame, lanes: list[list[str]], order: list, name: str = "turn") -> DataFrame:
    """Takes turns between lanes. With several levels (inner first) the inner lanes take turns within each outer one, then the outer
    ones do. ``turn`` is the round of the outermost lane: sort by it and the lane for the order of the rows."""
    for level, lane in enumerate(lanes):
        df = spread_places(df, lane, order, f"{name}_{level}")
        order = [F.col(f"{name}_{level}"), *(F.col(c) for c in lane), *order]
    return df.withColumnRenamed(f"{name}_{len(lanes) - 1}", name).drop(*(f"{name}_{k}" for k in range(len(lanes) - 1)))


def seeded(*columns: str, seed: int) -> Column:
    """A random but repeatable order."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns)), 256)


def split_quota(counts: list[int], total: int) -> list[int]:
    """Quotas of slices taken in turn: of what is left, each gets its even share (rounded up) or what it has; a second pass gives what is
    still left to those that have more."""
    quotas, left = [], total
    for i, n in enumerate(counts):
        share = -(-left // (len(counts) - i)) if left > 0 else 0
        quotas.append(min(n, share))
        left -= quotas[-1]
    for i, n in enumerate(counts):
        more = min(left, n - quotas[i])
        quotas[i] += more
        left -= more
    return quotas


def take_quotas(df: DataFrame, key: str, quotas: dict[str | None, int], order: list) -> DataFrame:
    """The first rows of each slice, as many as its quota (one row a slice: small, broadcast). Rows with a null in the key are a slice
    too, with the quota of None."""
    table = df.sparkSession.createDataFrame(list(quotas.items()), "__key string, __quota long")
    found = df.join(F.broadcast(table), F.col(key).eqNullSafe(F.col("__key")))
    return found.withColumn("__place", _place([key], order)).filter("__place <= __quota").select(key, *(c for c in df.columns if c != key))


def coupled_caps(df: DataFrame, caps: dict[str, int], order: list[str], scope: list[str]) -> DataFrame:
    """Rows in order, each kept unless a cap of one of its keys is reached; a row that one cap rejects doesn't use up another. This
    depends on the order, so the rows of a scope are folded one by one; a row beyond the first n of a key can't be kept only
    if the fold says so, hence scopes should be bounded slices. Null keys aren't capped."""

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable")
        used: dict = {}
        keep = []
        for row in rows[list(caps)].itertuples(index=False):
            own = [(c, v) for c, v in zip(caps, row) if not pd.isna(v)]
            good = all(used.get(k, 0) < caps[k[0]] for k in own)
            for k in own if good else []:
                used[k] = used.get(k, 0) + 1
            keep.append(good)
        return rows[keep]

    return df.groupBy(*scope).applyInPandas(fold, df.schema)


def capped_turns(df: DataFrame, family: str, caps: dict[str, int], total: int, order: list[str], scope: list[str]) -> DataFrame:
    """Families take turns, the one with fewest rows so far first, until ``total`` rows are chosen; rows that a cap rejects are used up. One
    fold per scope, over the first rows only of those that are alike in family and all capped columns: as many as the least cap. This loses
    nothing, since caps only fill up: if one of these was rejected, or all were chosen, each later one is rejected too. Nulls of a column are
    one value."""
    keys = [family, *(c for c in caps if c != family)]
    cut = cap(df, [*scope, *keys], [F.col(c).asc_nulls_last() for c in order], min(total, *caps.values()))

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        lanes = {f: list(x.index) for f, x in rows.sort_values(order, kind="stable").groupby(family, sort=True)}
        used: dict = {}
        chosen: list = []
        while len(chosen) < total and lanes:
            before = len(chosen)
            for f in sorted(lanes, key=lambda f: (used.get((family, f), 0), f)):
                while lanes.get(f) and len(chosen) < total:
                    i = lanes[f].pop(0)
                    own = [(c, None if pd.isna(v := rows.at[i, c]) else v) for c in keys]
                    if all(used.get(k, 0) < caps.get(k[0], total) for k in own):
                        for k in own:
                            used[k] = used.get(k, 0) + 1
                        chosen.append(i)
                        break
                if not lanes.get(f):
                    lanes.pop(f, None)
            if len(chosen) == before:
                break
        return rows.loc[chosen]

    return cut.groupBy(*scope).applyInPandas(fold, df.schema)
