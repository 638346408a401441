"""Vocabulary files of public tokenizers: read once by the driver, sent to the tasks, parsed once a worker."""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import SparkSession


def send(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a vocabulary file, which are a few MB at most, for tasks to parse."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def place(name: str) -> str:
    """Where the installed package keeps this file."""
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def rank_encoding(data: bytes):
    """A tiktoken encoding of a rank file, made once a worker."""
    import tiktoken

    ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def byte_of_char() -> dict[str, int]:
    """The byte for each character of byte-level vocabularies: printable bytes stand for themselves, the others are numbered from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
