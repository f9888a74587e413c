"""Hashes of words and of runs of words, computed over whole Arrow batches.

The texts of a batch are laid end to end as one array of code points; words, their
hashes and the hashes of all runs of ``width`` words come from array operations over
that concatenation, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multipliers of the hashes (any odd numbers do).
_CHAR = np.uint64(0x9E3779B97F4A7C15 | 1)
_WORD = np.uint64(0xD1342543DE82EF95)
_LIMIT = 1 << 21
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: np.uint64, name: str) -> np.ndarray:
    have = _tables.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _tables[name] = np.cumprod(steps)
    return have[:n]


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def _table(name: str) -> np.ndarray:
    if "word" not in _tables:
        _tables["word"] = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
        _tables["code"] = mix(np.arange(1, 0x110001, dtype=np.uint64) * _WORD)
    return _tables[name]


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    some: list[str] = []
    size = 0
    for t in texts:
        if some and size + len(t) > _LIMIT:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t) + 1
    if some:
        yield some


def words_of(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk of texts (already lower-cased): code points, first and end position of each word, its hash, and of
    each text the number of words before it (one more than there are texts)."""
    for some in _chunks(texts):
        joined = "\n".join(some) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(codes)
        inside = np.zeros(n + 1, np.int8)
        inside[1:] = _table("word")[codes]
        edge = np.diff(inside)
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(end) < len(first):
            end = np.append(end, n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_table("code")[codes] * _powers(n, _CHAR, "char"), out=sums[1:])
        back = _powers(n, _inverse(_CHAR), "back")
        hashes = mix((sums[end] - sums[first]) * back[first])
        borders = np.zeros(len(some) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in some], out=borders[1:])
        yield codes, first, end, hashes, np.searchsorted(first, borders)


def suffix_keys(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Of each run of ``width`` word hashes 48 bits in the order of the words: equally many leading bits of each word, the first word
    first. Sorting by these keys sorts the suffixes that begin there by their words."""
    each, more = divmod(48, width)
    n = len(words) - width + 1
    keys = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        bits = each + (k < more)
        keys = (keys << np.uint64(bits)) | (words[k : n + k] >> np.uint64(64 - bits))
    return keys


def runs_of(texts: list[str], width: int = 5, keys: bool = False) -> Iterator[tuple]:
    """Of each text: its number of words, a hash of its sequence of words, and the sorted distinct hashes of all runs
    of ``width`` words in a row; with ``keys`` also the suffix key of each of these. Words are the runs of letters and digits of the
    lower-cased text."""
    for _, _, _, words, at in words_of([t.lower() for t in texts]):
        n = len(words)
        if n >= width:
            runs = np.zeros(n - width + 1, np.uint64)
            for k in range(width):
                runs = runs * _CHAR + words[k : n - width + 1 + k]
            runs = mix(runs)
        places = suffix_keys(words, width) if keys else None
        power = _powers(max(n, 1), _WORD, "word_power")
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            whole = np.uint64((words[a:b] * power[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)) if b > a else np.uint64(0)
            if b - a < width:
                none = np.zeros(0, np.uint64)
                yield (b - a, whole, none, none) if keys else (b - a, whole, none)
                continue
            own = runs[a : b - width + 1]
            order = np.argsort(own) if keys else None
            own = own[order] if keys else np.sort(own)
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield (b - a, whole, own[keep], places[a : b - width + 1][order][keep]) if keys else (b - a, whole, own[keep])
