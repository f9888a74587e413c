"""Gates with reasons: what is rejected stays countable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reason(gates: list[tuple[str, Column]]) -> Column:
    """The name of the first gate whose condition for rejection holds, null if none does; a null condition doesn't reject."""
    out = None
    for name, condition in gates:
        hit = F.coalesce(condition, F.lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(F.lit(None).cast("string")) if out is not None else F.lit(None).cast("string")


def tally(df: DataFrame, gates: list[tuple[str, Column]]) -> DataFrame:
    """Rows per reason, "kept" for those that no gate rejects."""
    return df.groupBy(F.coalesce(reason(gates), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def within(column: Column, low: int | None, high: int | None) -> Column:
    """Whether a value lies in a range; what isn't known passes."""
    out = F.lit(True)
    if low is not None:
        out = out & (column >= low)
    if high is not None:
        out = out & (column <= high)
    return F.coalesce(out, F.lit(True))


def plan_errors(rows: list[dict], accepted: dict[str, set[str]]) -> list[str]:
    """What is wrong with a collection plan: options that a connector doesn't have, and single texts where several values are meant."""
    errors = []
    for r in rows:
        known = accepted.get(r["source"])
        if known is None:
            errors.append(f"{r['source']}/{r['name']}: no such source")
            continue
        for key, value in (r.get("kwargs") or {}).items():
            if key not in known:
                errors.append(f"{r['source']}/{r['name']}: no option {key}")
            elif key.endswith("s") and isinstance(value, str):
                errors.append(f"{r['source']}/{r['name']}: {key} must be a list")
    return errors
