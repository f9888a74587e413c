"""Joins by prefix, by longest prefix and by shared runs of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.records import bare
from leafmill.functions.text import shingles


def prefixes(path: Column, separator: str) -> Column:
    """All proper prefixes that end before a separator: of a/b/c these are a and a/b."""
    parts = F.split(path, separator)
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), separator))).otherwise(F.array().cast("array<string>"))


def containers(df: DataFrame, key: str, separator: str = "/") -> DataFrame:
    """Keys that are a prefix of others, and of how many: prefixes are made and joined as equal, no pair of rows is compared."""
    inner = df.select(F.explode(prefixes(F.col(key), separator)).alias(key)).groupBy(key).agg(F.count("*").alias("members"))
    return inner.join(df.select(key).distinct(), key, "left_semi")


def longest_prefix(df: DataFrame, column: str, names: DataFrame, limit: int = 10_000) -> DataFrame:
    """The name of the longest prefix that the column starts with, null if none does. names: prefix, name; a small table that is
    collected (its size is checked) and tried from the longest on in one expression."""
    rows = names.select("prefix", "name").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} prefixes")
    out = None
    for r in sorted(rows, key=lambda r: (-len(r["prefix"]), r["prefix"])):
        hit = F.col(column).startswith(r["prefix"])
        out = F.when(hit, r["name"]) if out is None else out.when(hit, r["name"])
    return df.withColumn("name", out if out is not None else F.lit(None).cast("string"))


def shingle_overlap(texts: DataFrame, bench: DataFrame, least: int = 20, threshold: float = 0.2) -> DataFrame:
    """Pairs (doc_id, item_id) of near texts: the runs of five words that both have, over the fewer of the two, at least threshold, with at
    least ``least`` runs each. Both: id column first, then text. Runs meet by an equi-join on their hash."""
    side = lambda df, key, name: df.select(F.col(df.columns[0]).alias(key), shingles(F.col(df.columns[1])).alias("s")).filter(F.size("s") >= least).select(key, F.size("s").alias(name), F.explode(F.transform("s", lambda x: F.xxhash64(x))).alias("run"))
    a, b = side(texts, "doc_id", "n_doc"), side(bench, "item_id", "n_item")
    both = a.join(b, "run").groupBy("doc_id", "item_id", "n_doc", "n_item").agg(F.count("*").alias("shared"))
    return both.filter(F.col("shared") >= threshold * F.least("n_doc", "n_item")).select("doc_id", "item_id", "shared")


def either_prefix(df: DataFrame, column: str, ids: DataFrame, least: int = 4) -> DataFrame:
    """Rows of df of which the bare column (letters and digits) is a prefix of a bare id or the other way round, both of at least ``least`` characters. ids: one column.
    The prefixes of each side are made and joined as equal, so no pair is tried."""
    key = F.col("__bare")
    own = df.withColumn("__bare", bare(F.col(column))).filter(F.length(key) >= least)
    other = ids.select(bare(F.col(ids.columns[0])).alias("__bare")).filter(F.length(key) >= least).distinct()
    starts = lambda x: F.explode(F.transform(F.sequence(F.lit(least), F.length(x)), lambda n: F.substring(x, 1, n)))
    longer = other.select(starts(key).alias("__bare")).distinct()  # the column is a prefix of an id
    mine = own.select("__bare").distinct()
    shorter = mine.select("__bare", starts(key).alias("__start")).join(other.withColumnRenamed("__bare", "__start"), "__start").select("__bare").distinct()
    return own.join(longer.unionByName(shorter).distinct(), "__bare", "left_semi").drop("__bare")
