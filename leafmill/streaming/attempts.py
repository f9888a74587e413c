"""Attempts as a stream: windowed failure rates, sessions, and each delivery once. Event times are cast from TIMESTAMP_NTZ, which
watermarks don't take."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def timed(stream: DataFrame, column: str = "ts", late: str = "1 hour") -> DataFrame:
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, late)


def once(stream: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark."""
    return timed(stream, late=late).dropDuplicatesWithinWatermark(keys)


def failure_rates(stream: DataFrame, by: str = "event_type", width: str = "1 day", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Attempts and failures per window and key; windows slide if asked to."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    counted = timed(stream, late=late).groupBy(window.alias("w"), by).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "errors")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    counted = timed(stream, late=late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return counted.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def new_refs(stream: DataFrame, keys: list[str], late: str = "7 days") -> DataFrame:
    """Discovered references as they arrive, each (source, source_id) once within the watermark; write with trigger(availableNow=True) and
    a checkpoint to work off a backlog."""
    return once(stream.withColumnRenamed("discovered_at", "ts"), keys, late)


def stale(stream: DataFrame, key: str, begun: str, ended: str, seconds: int = 3600, late: str = "1 hour") -> DataFrame:
    """Keys whose attempt began and didn't end within the given time, once the watermark has passed it. begun and ended are conditions
    on a row. State per key is one time; it is dropped when the attempt ends or is reported."""

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (since,) = state.get
            state.remove()
            yield pd.DataFrame({key: [k[0]], "since": [pd.Timestamp(since, unit="us")]})
            return
        since = state.get[0] if state.exists else None
        for rows in batches:
            for r in rows.sort_values("ts").itertuples(index=False):
                since = r.ts.value // 1000 if r.begun else None if r.ended else since
        if since is None:
            if state.exists:
                state.remove()
            return
        state.update((since,))
        # A timer must lie after the watermark; what is overdue already is reported with the next one.
        state.setTimeoutTimestamp(max(since // 1000 + seconds * 1000, state.getCurrentWatermarkMs() + 1))

    rows = timed(stream, late=late).select(key, "ts", F.coalesce(F.expr(begun), F.lit(False)).alias("begun"), F.coalesce(F.expr(ended), F.lit(False)).alias("ended"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, since timestamp", "since long", "append", GroupStateTimeout.EventTimeTimeout)
