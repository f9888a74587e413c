"""Languages of texts: a naive Bayes model over runs of up to three characters, fitted to labelled texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from .text import SCRIPTS, script

_SLOTS = 1 << 16
#: Scripts that decide the language by themselves.
_ALONE = [x for x in SCRIPTS if x not in ("cjk", "cy")]


def _slots(text: str) -> np.ndarray:
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    parts = [codes]
    for n in (2, 3):
        if len(codes) >= n:
            parts.append(parts[-1][: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :])
    x = np.concatenate(parts)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)


@dataclass
class Languages:
    """names, and for each the logarithms of the shares of the runs' slots."""

    names: list[str]
    logs: np.ndarray

    @classmethod
    def fit(cls, labelled: DataFrame, most: int = 20_000) -> Languages:
        """labelled: text, lang. The model is fitted to at most ``most`` of them, chosen by hash; null and empty ones don't take part."""
        rows = labelled.filter("length(text) > 0 and lang is not null").orderBy(F.xxhash64("text"), "text").limit(most).select("text", "lang").toPandas()
        names = sorted(rows["lang"].unique())
        counts = np.full((len(names), _SLOTS), 0.5)
        for text, lang in zip(rows["text"], rows["lang"]):
            counts[names.index(lang)] += np.bincount(_slots(text), minlength=_SLOTS)
        return cls(names, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32))

    def detect(self, text: Column, least: int = 20) -> Column:
        """The likeliest language of a whole text; that of its script where the script tells; "und" for fewer than ``least`` characters or without a model."""
        names, logs = self.names, self.logs

        @pandas_udf(StringType())
        def likeliest(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: names[int(logs[:, _slots(t)].sum(1).argmax())] if t and len(t.strip()) >= least and names else "und")

        own = script(text)
        return F.when(own.isin(_ALONE), own).when(own == "cjk", "zh").when(own == "none", "und").otherwise(likeliest(F.coalesce(text, F.lit(""))))
