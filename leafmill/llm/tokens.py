"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary lies (one line per token: base64 of its bytes, rank).
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published split of texts that this vocabulary was made for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ready: dict[str, object] = {}


def encoding(path: str = RANKS):
    """The tokenizer of a rank file, one per process."""
    if path not in _ready:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        _ready[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ready[path]


def token_sizes(df: DataFrame, keep: list[str], text: str = "text", path: str = RANKS) -> DataFrame:
    """The columns ``keep`` and n_tokens, the tokens of the whole text; 0 for a null or empty one. Strings of special
    tokens in a text are ordinary text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(path)
        for batch in batches:
            sizes = [len(own.encode_ordinary(t)) if t else 0 for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], names=[*keep, "n_tokens"])

    rows = df.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{schema}, n_tokens long")
