"""Alignment of the tokens that two tokenizers give for one text, and of their vocabularies over a corpus.

Both cut the same bytes, so tokens meet where both end.  Before a single space neither has a token that goes on, so texts are
cut there, and a worker encodes and aligns each distinct piece once, many of them end to end; a text's groups and links are
those of its pieces in a row.  The shorter list of ends drives a galloping intersection with the
longer: exponential steps bracket each end's rank, binary search finds it.  Common ends cut groups, and the
difference of ranks from one end to the next is the range of tokens that a token overlaps.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.llm import vocab
from kinetra.llm.common import cut, join_counted, text_bytes

#: Text that is encoded in one call, in bytes.
_CALL = 1 << 20


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Rank of each of short's numbers among long's: how many of them are less.  Both are ascending, without repeats.

    All searches step side by side, from start or else from where ranks are if both lists are equally dense; each doubles its
    steps, up or down, until it has passed its place, and ends with a binary search between the last two.
    """
    m = long.size
    start = np.arange(short.size, dtype=np.int64) * m // max(1, short.size) if start is None else start
    at = np.minimum(start, max(0, m - 1))
    if not m or not short.size:
        return np.zeros(short.size, dtype=np.int64)
    low, high = np.zeros(short.size, dtype=np.int64), np.full(short.size, m, dtype=np.int64)
    up = long[at] < short
    low[up], high[~up] = at[up] + 1, at[~up]
    step, going = 1, np.arange(short.size)
    while going.size:
        probe = np.where(up[going], at[going] + step, at[going] - step)
        here = (probe >= 0) & (probe < m)
        going, probe = going[here], probe[here]
        less = long[probe] < short[going]
        low[going[less]] = np.maximum(low[going[less]], probe[less] + 1)
        high[going[~less]] = np.minimum(high[going[~less]], probe[~less])
        going, step = going[less == up[going]], step * 2
    going = np.flatnonzero(low < high)
    while going.size:
        middle = (low[going] + high[going]) // 2
        less = long[middle] < short[going]
        low[going[less]], high[going[~less]] = middle[less] + 1, middle[~less]
        going = going[low[going] < high[going]]
    return low


@dataclass
class Alignment:
    """Tokens are numbered from 0 on each side.  Group g ends after token a_ends[g] - 1 and b_ends[g] - 1."""

    a_ends: np.ndarray
    b_ends: np.ndarray
    a: np.ndarray  # the links: token a[i] overlaps token b[i]
    b: np.ndarray


def align(a_ends: np.ndarray, b_ends: np.ndarray, pieces: tuple[np.ndarray, np.ndarray] | None = None) -> Alignment:
    """Align tokens by the byte offsets they end at; both lists end at the same byte, or both are empty.

    pieces: how many tokens each side has in each of a row of pieces that both end together, for searches to start near.
    """
    swap = a_ends.size > b_ends.size
    short, long = (b_ends, a_ends) if swap else (a_ends, b_ends)
    start = None
    if pieces is not None:
        own, other = pieces[::-1] if swap else pieces
        start = np.arange(short.size) + np.repeat((np.cumsum(other) - other) - (np.cumsum(own) - own), own)
    rank = gallop(short, long, start)
    common = np.zeros(short.size, dtype=bool)
    common[rank < long.size] = long[rank[rank < long.size]] == short[rank < long.size]
    # A token overlaps those from the first that ends after its start to the first that ends at or after its end.
    first = np.concatenate([[0], (rank + common)[:-1]]).astype(np.int64) if short.size else rank
    many = rank - first + 1
    of_short = np.repeat(np.arange(short.size), many)
    of_long = np.arange(of_short.size) + np.repeat(first - (np.cumsum(many) - many), many)
    ends = (np.flatnonzero(common) + 1, rank[common] + 1)
    return Alignment(*reversed(ends), of_long, of_short) if swap else Alignment(*ends, of_short, of_long)


#: A single space between characters that are no white space to any tokenizer: ASCII's visible ones, and letters and signs
#: from U+00C0 to U+024F.
_CUT = re.compile(" (?<=[!-~\u00c0-\u024f] )(?=[!-~\u00c0-\u024f])")


def cut_pieces(text: str) -> list[str]:
    """The text cut at each single space between two characters of words; the space before each piece is left out."""
    return _CUT.split(text)


class _Numbers(dict):
    """Numbers pieces from 0 in the order in which they first come."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


class Tokenizers:
    """A: a byte-level BPE in JSON, given a space and the text.  B: a sentencepiece model with byte fallback, which adds the space."""

    #: Pieces that a worker remembers, about 300 bytes each, and their characters and tokens together.  Beyond either, it keeps
    #: half, those used most of late, and none of more than LONG characters and tokens.
    REMEMBERED, WEIGHT, LONG = 200_000, 6_000_000, 200

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        byte_of = vocab.byte_of_char()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        # Pieces are exact if A looks at words alone and no token of B has a space after another character.
        made = json.loads(a)
        words = (made.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and made["pre_tokenizer"].get("use_regex", True) and not made.get("normalizer")
        self.cuts = bool(words) and not any("▁" in p.lstrip("▁") for p in pieces)
        # Each id's digits with what may follow it in the listing of groups.
        self.listed = [f"{i}{end}" for end in ",|;" for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        # What is known of each numbered piece: whether its tokens give back its bytes, how many tokens of A and B, groups and links
        # it has, its characters and tokens, how often it came, the listing of its groups, and all pieces' linked id pairs in a row.
        self.known = _Numbers()
        self.exact, self.sizes = np.zeros(0, dtype=bool), np.zeros((0, 4), dtype=np.int64)
        self.weights, self.uses = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.listed_pieces: list[str] = []
        self.pairs = np.zeros(0, dtype=np.int64)

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of each text by A and B; None where a text's bytes are not those of the tokens."""
        a = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        raw = [(" " + t).encode() for t in texts]
        out: list = list(zip(a, b, strict=True))
        for table, sizes, ids in ((self.a_bytes, self.a_sizes, a), (self.b_bytes, self.b_sizes, b)):
            flat, many = list(itertools.chain.from_iterable(ids)), [len(x) for x in ids]
            ends = np.concatenate([[0], np.cumsum(sizes[np.array(flat, dtype=np.int64)])])[np.cumsum(many)]
            if b"".join(map(table.__getitem__, flat)) == b"".join(raw) and ends.tolist() == np.cumsum([len(r) for r in raw]).tolist():
                continue  # all of them at once
            for i, (x, r) in enumerate(zip(ids, raw, strict=True)):
                if b"".join(map(table.__getitem__, x)) != r:
                    out[i] = None
        return out

    def listing(self, a: np.ndarray, b: np.ndarray, found: Alignment) -> list[str]:
        """Ids of both sides in the order of groups, as a1,a2|b1;a3|b2,b3; each with what follows it."""
        n = len(self.listed) // 3
        group = [np.repeat(np.arange(e.size), np.diff(e, prepend=0)) for e in (found.a_ends, found.b_ends)]
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        after_a, after_b = np.zeros(a.size, dtype=np.int64), np.zeros(b.size, dtype=np.int64)
        after_a[found.a_ends - 1], after_b[found.b_ends - 1] = n, 2 * n
        return list(map(self.listed.__getitem__, np.concatenate([a + after_a, b + after_b])[order].tolist()))

    def learn(self, pieces: list[str]) -> None:
        """Encode and align pieces, end to end, and add them to what is known."""
        found_ids = self.encode(pieces)
        sides = [[ids[k] if ids else [] for ids in found_ids] for k in (0, 1)]
        a, b = (np.array(list(itertools.chain.from_iterable(x)), dtype=np.int64) for x in sides)
        many = [np.array([len(x) for x in side], dtype=np.int64) for side in sides]
        found = align(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]), (many[0], many[1]))
        # Where each piece ends among tokens, groups and links.
        a_last, b_last = (np.cumsum(x) for x in many)
        last = [a_last, b_last, np.searchsorted(found.a_ends, a_last, side="right"), np.searchsorted(found.a, a_last)]
        listed, before = self.listing(a, b, found), 0
        for end in (a_last + b_last).tolist():
            self.listed_pieces.append("".join(listed[before:end]))
            before = end
        self.exact = np.concatenate([self.exact, [ids is not None for ids in found_ids]])
        self.sizes = np.concatenate([self.sizes, np.diff(np.column_stack(last), axis=0, prepend=0)])
        self.weights = np.concatenate([self.weights, many[0] + many[1] + [len(p) for p in pieces]])
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), dtype=np.int64)])
        self.pairs = np.concatenate([self.pairs, a[found.a] << 32 | b[found.b]])

    def links_of(self, numbers: np.ndarray) -> np.ndarray:
        """Linked id pairs of pieces in a row."""
        many = self.sizes[numbers, 3]
        starts = (np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3])[numbers]
        return self.pairs[np.arange(many.sum()) + np.repeat(starts - (np.cumsum(many) - many), many)]

    def forget(self) -> None:
        """Keep half of what may be remembered, if there is more than that."""
        if len(self.known) <= self.REMEMBERED and self.weights.sum() <= self.WEIGHT:
            return
        kept = np.argsort(-self.uses, kind="stable")
        kept = kept[self.weights[kept] <= self.LONG][: self.REMEMBERED // 2]
        kept = np.sort(kept[np.cumsum(self.weights[kept]) <= self.WEIGHT // 2])
        names, numbers = list(self.known), kept.tolist()
        self.known = _Numbers(zip(map(names.__getitem__, numbers), range(len(numbers)), strict=True))
        self.listed_pieces = list(map(self.listed_pieces.__getitem__, numbers))
        self.pairs = self.links_of(kept)
        self.exact, self.sizes, self.weights, self.uses = self.exact[kept], self.sizes[kept], self.weights[kept], (self.uses[kept] + 1) // 2

    def describe(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text, all empty where it has no tokens."""
        self.forget()
        before = len(self.known)
        try:
            seen = [list(map(self.known.__getitem__, cut_pieces(t) if self.cuts else [t])) if t else [] for t in texts]
            new = list(itertools.islice(self.known, before, None))
            for begin, end in _slices([len(p) for p in new], _CALL):
                self.learn(new[begin:end])
        except BaseException:
            for piece in list(self.known)[self.exact.size :]:
                del self.known[piece]  # numbered, but not learnt
            raise
        inexact = set(np.flatnonzero(~self.exact).tolist())
        if inexact:
            seen = [x if inexact.isdisjoint(x) else [] for x in seen]
        numbers = np.array(list(itertools.chain.from_iterable(seen)), dtype=np.int64)
        self.uses += np.bincount(numbers, minlength=self.uses.size)
        # All texts stand end to end: where each ends among tokens, groups and links.
        sizes = np.concatenate([np.zeros((1, 4), dtype=np.int64), np.cumsum(self.sizes[numbers], axis=0)])
        ends = sizes[np.cumsum([len(x) for x in seen], dtype=np.int64)]
        pairs, out, link = self.links_of(numbers), [], 0
        for ids, counts, end in zip(seen, np.diff(ends, axis=0, prepend=0).tolist(), ends[:, 3].tolist(), strict=True):
            groups = "".join(map(self.listed_pieces.__getitem__, ids))[:-1]
            distinct, times = np.unique(pairs[link:end], return_counts=True)
            out.append((*counts, groups, distinct, times))
            link = end
        return out


@lru_cache(maxsize=1)
def _tokenizers(a: bytes, b: bytes) -> Tokenizers:
    """Made once a worker."""
    return Tokenizers(a, b)


def _slices(sizes: list[int], most: int):
    """Ranges of neighbours of about so many bytes together; a larger one is alone."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if sizes:
        yield begin, len(sizes)


def aligned(docs: DataFrame, a_vocabulary: str | None = None, b_vocabulary: str | None = None, digest: bool = False) -> DataFrame:
    """Tokens and groups of every row of docs (doc_id, text), from the whole text.

    (doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times): groups lists them as a1,a2|b1;a3|b2,b3, pairs has the
    distinct linked id pairs as a << 32 | b, times how many links each has.  With digest, groups has the listing's
    SHA-256 instead, for the listing is several times as long as the text.  A text that is null or
    empty, or that the tokens' bytes do not give back, has no tokens: zeros and empty values.
    Rows are judged by themselves, repeated ones and null ids too.
    """
    spark = docs.sparkSession
    sent = [vocab.send(spark, p or vocab.place(n)) for p, n in ((a_vocabulary, "byte_bpe_50k.json"), (b_vocabulary, "piece_bpe_32k.model"))]

    def work(batches):
        both = _tokenizers(*(x.value for x in sent))
        for batch in batches:
            data, ids = batch.column("data"), batch.column("doc_id")
            for begin, end in _slices([len(x.as_buffer()) for x in data], 2 * _CALL):
                columns = [list(c) for c in zip(*both.describe([x.as_py().decode() for x in data[begin:end]]), strict=True)]
                if digest:
                    columns[4] = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in columns[4]]
                arrays = [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([ids[begin:end], *arrays], _NAMES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    return rows.mapInArrow(work, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>")


_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
_TYPES = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, links, rows, best) of rows (pair, times): links and rows corpus-wide, and whether no pair of its B id has more links.

    A pair of a third of all rows comes to the exchange once a task, summed.  A B id has at most as many pairs as
    A's vocabulary has entries, however large the corpus is.
    """
    counts = cut(pairs.groupBy("pair").agg(F.sum("times").alias("links"), F.count(F.lit(1)).alias("rows")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")
    most = counts.groupBy(b_id).agg(F.max("links").alias("most"))
    return counts.withColumn("b", b_id).join(most, "b").select("pair", "links", "rows", (F.col("links") == F.col("most")).alias("best"))


def align_vocabularies(docs: DataFrame, a_vocabulary: str | None = None, b_vocabulary: str | None = None, digest: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of every row of docs (doc_id, text).

    The first six as aligned gives them.  An id pair's count is how many links of all rows hold it.  n_best counts the row's
    links whose pair has the highest count of its B id, ties included; count_sum sums the counts over the row's links.
    Rows without tokens have zeros.  Equal rows count as often as they come; an empty table gives an empty result.

    Each row keeps its distinct pairs, so only they are counted and looked up.  Pairs that make up more than about a
    100,000th of the (row, pair) rows are fewer than that and are broadcast; the others are shuffled, where none weighs much.
    """
    rows = aligned(docs, a_vocabulary, b_vocabulary, digest).withColumn("row", F.monotonically_increasing_id())
    rows = cut(rows, "aligned")
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = cut(pair_counts(each.select("pair", "times")), "pairs")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    met = join_counted(each, counts, "pair", "rows", total, written=True)
    best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0))
    sums = met.groupBy("row").agg(best.alias("n_best"), F.sum(F.col("times") * F.col("links")).alias("count_sum"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return rows.drop("pairs", "times").join(sums, "row", "left").select("doc_id", *_NAMES[1:6], *zero)
