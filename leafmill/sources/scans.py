"""Scans of files other than Parquet, each as one DataFrame."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def patterned(spark: SparkSession, path: str, pattern: str, fields: list[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """Lines that match a pattern, one column per group, trimmed; other lines (headings, rules) are left out."""
    lines = spark.read.format("csv").options(encoding=encoding, sep="\u0001", quote="", header="false").schema("value string").load(path)
    return lines.filter(F.col("value").rlike(pattern)).select(*(F.trim(F.regexp_extract("value", pattern, i + 1)).alias(f) for i, f in enumerate(fields)))


def csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV file with a heading, with or without a byte order mark."""
    reader = spark.read.options(header="true", encoding="UTF-8", mode="PERMISSIVE")
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Elements of an XML file as rows; namespace prefixes are ignored."""
    return spark.read.format("xml").options(rowTag=tag, ignoreNamespace="true").schema(schema).load(path)


def zip_members(spark: SparkSession, path: str, suffix: str = ".pdf", most: int = 64 << 20) -> DataFrame:
    """The members of zip files: archive, name, n_bytes, content. One archive is read by one task; contents should be stored at once, not shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            for archive, body in zip(some["path"], some["content"]):
                with zipfile.ZipFile(io.BytesIO(body)) as z:
                    for m in z.infolist():
                        if m.filename.lower().endswith(suffix) and m.file_size <= most:
                            yield pd.DataFrame({"archive": [archive], "name": [m.filename], "n_bytes": [m.file_size], "content": [z.read(m)]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, name string, n_bytes long, content binary")


def merged(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files as one table of the first one's schema: columns by name, cast to its types; missing ones are null, others are left out."""
    frames = [spark.read.parquet(p) for p in paths]
    first = frames[0].schema
    cast = [df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in first)) for df in frames]
    return reduce(lambda a, b: a.unionByName(b), cast)


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row written of each key (a log of runs or facts that is only appended to); nulls in order come first."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x")).select(*keys, *(F.col("x")[c].alias(c) for c in rest))
