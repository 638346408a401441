"""What several training-data operators share: tables, scratch folders, word splitting, hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.scratch import cut, new_dir, shared_dir  # noqa: F401

#: Stands in for a null id while rows are compared; such rows sort after all others.
NO_ID = (1 << 63) - 1

#: Up to so many rows of a few numbers, about 16 MB, are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 400_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed odd multipliers of the 64-bit finaliser and of the rolling hashes.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int, most_hot: int = 100_000, written: bool = False) -> DataFrame:
    """rows joined to keyed (key, count, ...) by key, where count is about how many rows have the key.

    Keys with more than one in most_hot of total are fewer than that many: they are broadcast, so that
    their rows stay where they are.  All other keys are joined by a shuffle, in which none weighs much.
    Written tells that rows is such a table already, which costs nothing to read twice.
    """
    hot = F.col(count) > max(total // min(most_hot, BROADCAST_ROWS), 1000)
    few = cut(keyed.filter(hot).drop(count), "hot")
    cold = keyed.filter(~hot).drop(count)
    if few.isEmpty():
        return rows.join(cold, key)
    rows = rows if written else cut(rows, "dealt")
    return rows.join(F.broadcast(few), key).unionByName(rows.join(F.broadcast(few.select(key)), key, "left_anti").join(cold, key))


def digest_words(data: bytes) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of UTF-8 text with A-Z lower-cased; bytes methods treat ASCII only."""
    return data.lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 16
_POW, _INV = _powers(_BLOCK, _BASE), _powers(_BLOCK, _INVERSE)
#: A pseudo-random 64-bit value for each byte.
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power(exponents: np.ndarray, low: np.ndarray, base: int) -> np.ndarray:
    """base ** exponents modulo 2**64, from a table for the low 16 bits."""
    high = exponents >> 16
    out = low[exponents & (_BLOCK - 1)]
    if high.size and high[-1]:
        out = out * _powers(int(high[-1]) + 1, pow(base, _BLOCK, 1 << 64))[high]
    return out


#: White space, and the other characters that end a word, as tables of 256 flags.
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def word_hashes(data: bytes, breaks: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte and end byte of each word of UTF-8 text with A-Z lower-cased.

    Words are maximal runs of bytes for which ``breaks`` is false.  A word's hash is a polynomial over
    its bytes, taken as a difference of prefix sums, so that no Python code runs for each word.
    """
    raw = np.frombuffer(data.lower(), dtype=np.uint8)
    inside = np.zeros(raw.size + 2, dtype=np.int8)
    inside[1:-1] = ~breaks[raw]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not starts.size:
        return np.zeros(0, dtype=np.uint64), starts, ends
    sums = np.zeros(raw.size + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _power(np.arange(raw.size), _POW, _BASE), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power(starts, _INV, _INVERSE)
    return mix64(hashes + (ends - starts).astype(np.uint64)), starts, ends


def gram_hashes(words: np.ndarray, n: int, whole_if_short: bool = True) -> np.ndarray:
    """Hash of each run of n words; of fewer words, but not none, the whole run as one if asked for."""
    if not words.size or (words.size < n and not whole_if_short):
        return np.zeros(0, dtype=np.uint64)
    k = min(n, words.size)
    out = np.full(words.size - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = mix64(out * np.uint64(_BASE) + words[i : words.size - k + 1 + i])
    return out


def text_bytes(col: str = "text"):
    """The column as UTF-8 bytes, null as none: Arrow then hands over the bytes without decoding."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def quoted(name: str) -> str:
    """A column name to select by, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def columns(df: DataFrame) -> list:
    """All columns of df, of any names."""
    return [df[quoted(c)] for c in df.columns]


def spare(name: str, taken: list[str]) -> str:
    """A column name that is not among those taken: the input may have columns of any name."""
    while name.lower() in {x.lower() for x in taken}:
        name = "_" + name
    return name
