"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are runs of ten words of a benchmark item (or the whole item, if it has fewer).  Patterns of one
length share a table: a shift for each block of two words says how far the search may jump, zero shifts
lead to a bucket of patterns by a hash of their last words, and each is compared word by word.  The tables are
arrays of numbers, built once and sent to the tasks: a few bytes for each word of the benchmark.
"""

from __future__ import annotations

import array
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.llm.common import BROADCAST_ROWS, NO_ID, columns, cut, mix64, quoted, spare, text_bytes


#: Bytes that are no part of a word become spaces, A-Z become a-z: words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(data: bytes) -> list[bytes]:
    return data.translate(_TABLE).split()


#: Suffix hashes are taken modulo 2**63 with this fixed odd multiplier.
_MIX, _MASK = 1_000_003, (1 << 63) - 1


class WuManber:
    """Search tables for the runs of m words that start at given places of an array of word numbers below size.

    Sorted arrays hold the blocks with their shifts and the patterns by the hash of their last words: they take
    about 40 bytes a pattern and are searched by bisection, at the places that the shifts leave.
    """

    def __init__(self, numbers: np.ndarray, starts: np.ndarray, items: np.ndarray, m: int, size: int):
        self.numbers, self.length, self.size = numbers, m, size
        self.block, self.suffix, self.far = min(2, m), min(3, m), m - min(2, m) + 1
        keys, jumps = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        for end in range(m, self.block - 1, -1):  # least shifts first: a block keeps the first it gets
            new = numbers[starts + end - 1] if self.block == 1 else numbers[starts + end - 2] * size + numbers[starts + end - 1]
            new = np.unique(new)
            if keys.size:
                new = new[keys[np.minimum(np.searchsorted(keys, new), keys.size - 1)] != new]
            both = np.concatenate([keys, new])
            order = np.argsort(both, kind="stable")
            keys, jumps = both[order], np.concatenate([jumps, np.full(new.size, m - end, dtype=np.uint8)])[order]
        self.keys, self.jumps = array.array("q", keys.tobytes()), jumps.tobytes()
        # Equal runs of several items are one pattern.
        last, runs = np.zeros(starts.size, dtype=np.uint64), [np.full(starts.size, salt, dtype=np.uint64) for salt in (1, 2)]
        for k in range(m):
            word = numbers[starts + k].astype(np.uint64)
            runs = [mix64(x * np.uint64(_MIX) + word) for x in runs]
            if k >= m - self.suffix:
                last = last * np.uint64(_MIX) + word
        last &= np.uint64(_MASK)
        order = np.lexsort((items, runs[1], runs[0], last))
        new = np.ones(order.size, dtype=bool)
        new[1:] = (np.diff(np.stack([x[order] for x in (last, *runs)])) != 0).any(axis=0)
        first = np.flatnonzero(new)
        self.bucket, self.start, self.items = array.array("q", last[order][first].astype(np.int64).tobytes()), starts[order][first], items[order]
        self.item_range = np.concatenate([first, [order.size]])

    def search(self, text: list[bytes], vocabulary: dict[bytes, int]):
        """(end, pattern) of every occurrence in the words of a text, from left to right."""
        m, far, suffix, keys, jumps, bucket, size, get = self.length, self.far, self.suffix, self.keys, self.jumps, self.bucket, self.size, vocabulary.get
        end, n, two, most = m, len(text), self.block == 2, len(keys)
        while end <= n:
            b = get(text[end - 1])
            a = get(text[end - 2]) if two else 0
            if a is None or b is None:  # no block with this word
                end += far
                continue
            key = a * size + b
            at = bisect_left(keys, key)
            if at == most or keys[at] != key:
                end += far
                continue
            if jumps[at]:
                end += jumps[at]
                continue
            last = 0
            for k in range(end - suffix, end):
                last = last * _MIX + get(text[k], -1)
            last &= _MASK
            at = bisect_left(bucket, last)
            if at < len(bucket) and bucket[at] == last:
                window = [get(w, -1) for w in text[end - m : end]]
                while at < len(bucket) and bucket[at] == last:
                    if self.numbers[self.start[at] : self.start[at] + m].tolist() == window:
                        yield end, at
                    at += 1
            end += 1

    def items_of(self, pattern: int) -> np.ndarray:
        return self.items[self.item_range[pattern] : self.item_range[pattern + 1]]


class Tables:
    """Everything the search needs of a list of (item, text): all windows of long items, and the short items whole."""

    def __init__(self, items: list[tuple[int, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        each = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(data)], dtype=np.int64) for _, data in items]
        sizes = np.array([x.size for x in each], dtype=np.int64)
        numbers = np.concatenate([np.zeros(0, dtype=np.int64), *each])
        firsts = np.cumsum(sizes) - sizes
        self.searches = []
        for m in sorted({min(window, int(n)) for n in sizes} - {0}):
            own = [i for i, n in enumerate(sizes) if min(window, int(n)) == m]
            starts = np.concatenate([firsts[i] + np.arange(sizes[i] - m + 1) for i in own])
            names = np.repeat(np.array([items[i][0] for i in own], dtype=np.int64), [sizes[i] - m + 1 for i in own])
            self.searches.append(WuManber(numbers, starts, names, m, len(self.vocabulary)))

    def scan(self, data: bytes) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, merged spans of hit words and the items that occur."""
        text, found, spans = words(data), set(), []
        for table in self.searches:
            for end, pattern in table.search(text, self.vocabulary):
                found.update(table.items_of(pattern).tolist())
                spans.append((end - table.length, end))
        return len(text), merge(spans), found


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap made one."""
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _blocks(benchmark: DataFrame, most_bytes: int) -> list[DataFrame]:
    """The benchmark in parts of about most_bytes of text each, dealt by a hash of the item."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // most_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [benchmark.filter(part == i) if n > 1 else benchmark for i in range(n)]


def _search(docs: DataFrame, block: DataFrame, window: int):
    """A column function: bytes of a text to (n, spans as flat numbers, items), with the tables of this part."""
    rows = block.select("item_id", text_bytes().alias("data")).toLocalIterator()
    given = docs.sparkSession.sparkContext.broadcast(Tables([(NO_ID if r["item_id"] is None else r["item_id"], bytes(r["data"])) for r in rows], window))

    def search(batches):
        tables = given.value
        for data in batches:
            found = [tables.scan(bytes(x)) for x in data]
            yield pd.DataFrame({
                "n": [n for n, _, _ in found],
                "spans": [[x for ab in s for x in ab] for _, s, _ in found],
                "items": [sorted(k) for _, _, k in found],
            })

    return F.pandas_udf(search, "n long, spans array<long>, items array<long>", F.PandasUDFType.SCALAR_ITER)


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = 10, most_bytes: int = 16 << 20) -> DataFrame:
    """docs with three more columns: n_words, hit_spans (array of start, end in words) and hit_items.

    docs needs text, benchmark needs item_id and text; further columns stay.  A null or empty text has no
    words and is never hit; a null or empty item has no pattern; a null item_id comes back as NO_ID.  An
    item in several rows is one item with the patterns of all.  Repeated documents are searched each, texts of any
    length whole; an empty table gives none.  Added columns get a _ in front where the input has one of that name.
    The search tables are built once and broadcast: the benchmark's size is read first, and at most most_bytes of its
    text are in tables at a time.  A larger benchmark takes several passes that read the texts and write only
    what they hit, by a hash of the text; one join brings all hits to the documents, and nothing is left out.
    """
    names = {c: spare(c, docs.columns) for c in ("n_words", "hit_spans", "hit_items")}
    hit, own = spare("hit", docs.columns), columns(docs)
    blocks = _blocks(benchmark.select("item_id", "text"), most_bytes)
    out = docs.withColumn(hit, _search(docs, blocks[0], window)(text_bytes()))
    n_words, spans, items = (F.col(f"{hit}.{c}") for c in ("n", "spans", "items"))
    if len(blocks) > 1:
        key, more_spans, more_items = (spare(c, docs.columns) for c in ("hit_key", "more_spans", "more_items"))
        digest = F.unhex(F.md5(text_bytes())).alias(key)
        passes = None
        for block in blocks[1:]:
            one = docs.select(digest, text_bytes().alias("data")).withColumn("h", _search(docs, block, window)("data"))
            one = cut(one.filter(F.size("h.items") > 0).groupBy(key).agg(F.first("h.spans").alias("spans"), F.first("h.items").alias("items")), "hits")
            passes = one if passes is None else passes.unionByName(one)
        more = cut(passes.groupBy(key).agg(F.flatten(F.collect_list("spans")).alias(more_spans), F.flatten(F.collect_list("items")).alias(more_items)), "hits")
        numbers = more.agg(F.sum(F.size(more_spans) + F.size(more_items))).first()[0] or 0
        more = more.hint("broadcast" if numbers <= BROADCAST_ROWS else "shuffle_hash")
        out = out.join(more, F.unhex(F.md5(text_bytes())) == F.col(key), "left")
        none = F.array().cast("array<long>")
        spans, items = (F.concat(old, F.coalesce(new, none)) for old, new in ((spans, F.col(more_spans)), (items, F.col(more_items))))
    pairs = F.transform(F.sequence(F.lit(0), (F.size(spans) / 2).cast("int") - 1), lambda k: F.struct(F.get(spans, (2 * k).cast("int")).alias("start"), F.get(spans, (2 * k + 1).cast("int")).alias("end")))
    pairs = F.when(F.size(spans) > 0, pairs).otherwise(F.array().cast("array<struct<start:long,end:long>>"))
    if len(blocks) > 1:
        pairs = _merged()(pairs)
    return out.select(*own, n_words.alias(names["n_words"]), pairs.alias(names["hit_spans"]), F.array_sort(F.array_distinct(items)).alias(names["hit_items"]))


def _merged():
    """A column function: spans of several passes, made disjoint."""

    def join(batches):
        for spans in batches:
            yield pd.Series([[{"start": a, "end": b} for a, b in merge([(x["start"], x["end"]) for x in s])] for s in spans])

    return F.pandas_udf(join, "array<struct<start:long,end:long>>", F.PandasUDFType.SCALAR_ITER)


def hit_words(spans: str = "hit_spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])


def item_digest(items: str = "hit_items"):
    """SHA-256 of the item ids, sorted as strings and joined by commas; a null id is the empty string."""
    as_text = F.transform(items, lambda x: F.when(x == NO_ID, F.lit("")).otherwise(x.cast("string")))
    return F.sha2(F.array_join(F.array_sort(as_text), ","), 256)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents that hold no window of any item, with the columns they came with.

    Null, empty and wordless texts stay, as do all rows if the benchmark is empty; repeated rows are judged each.
    """
    found = find_items(docs, benchmark, window)
    return found.filter(F.size(found.columns[-1]) == 0).select(*map(quoted, docs.columns))
