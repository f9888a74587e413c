"""The N best items of every group, by secondary sort."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stream(group: str, item: str, n: int):
    """Over rows sorted by group and rank: the first n distinct items of each group, by operations on whole batches. Of the group that a batch
    ends in, the items chosen so far (at most n) go before the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = None
        for batch in batches:
            rows = pd.DataFrame({"g": batch.column(group).to_pandas(types_mapper=pd.ArrowDtype), "x": batch.column(item).to_pandas(types_mapper=pd.ArrowDtype)})
            before = len(taken) if taken is not None else 0
            if before:
                rows = pd.concat([taken, rows], ignore_index=True)
            if not len(rows):
                continue
            g, new = rows["g"], ~rows.duplicated().to_numpy()
            other = (g != g.shift()).fillna(False).to_numpy(bool) | (g.isna() != g.isna().shift()).to_numpy(bool)
            other[0] = True
            so_far = np.cumsum(new)
            starts = np.flatnonzero(other)
            place = so_far - np.repeat(so_far[starts] - new[starts], np.diff(np.append(starts, len(rows))))
            keep = np.flatnonzero(new & (place <= n))
            taken = rows.iloc[keep[keep >= starts[-1]]]
            own = keep[keep >= before] - before
            if len(own):
                yield batch.take(pa.array(own))

    return run


def top_n(df: DataFrame, group: str, item: str, order: list[Column], n: int = 3) -> DataFrame:
    """The first n distinct items of each group in the given order, an item counting by its best row; all columns of these rows.

    order must end in a unique tie rule (commonly the item). Each input partition first keeps its own n best per group,
    so that a group of any size reaches the shuffle as n rows per partition; then rows are hash-partitioned by group,
    sorted within partitions, and streamed. Rows with a null group form a group of their own, null items are one item;
    fewer than n items are all kept; an empty table gives none.
    """
    run, schema = _stream(group, item, n), df.schema
    local = df.sortWithinPartitions(F.col(group), *order).mapInArrow(run, schema)
    return local.repartition(group).sortWithinPartitions(F.col(group), *order).mapInArrow(run, schema)
