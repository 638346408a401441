"""Line dedup that can be undone: exact reference counts with sharded cuckoo filters in front.

An index holds which documents hold which line keys (exact postings and, per key, the number of documents and
the smallest of them) and, for each shard of keys, a cuckoo filter of the keys that at least two documents
hold.  A document's lines first ask the filter; only those it lets through are looked up exactly.  As cuckoo
filters can forget, documents can be deleted again, and lines that only they repeated come back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.llm.common import NO_ID, columns, cut, join_counted, mix64, quoted, spare, text_bytes

_SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, least: int) -> bytes | None:
    """16 bytes for a line's key (stripped of ASCII space, A-Z lower-cased), none if it is too short."""
    key = line.strip(_SPACE).lower()
    if len(key) < least or len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class CuckooFilter:
    """Set of 64-bit values with deletion: 16-bit marks, buckets of four, two buckets for each value.

    All operations take arrays.  No value that was inserted and not deleted is ever denied; others are let
    through with a chance of about 8 / 65536.
    """

    WIDTH = 4

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.marks = np.zeros((buckets, self.WIDTH), dtype=np.uint16)

    @classmethod
    def build(cls, values: np.ndarray, load: float = 0.8) -> CuckooFilter:
        """A filter of these distinct values, with twice the buckets until all have a place."""
        need = max(1, int(values.size / load / cls.WIDTH))
        buckets = 1 << (need - 1).bit_length()
        while not (out := cls(buckets)).insert(values):
            buckets *= 2
        return out

    def _places(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix64(values.astype(np.uint64))
        return ((h >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16), (h & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mix64(mark.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, values: np.ndarray) -> np.ndarray:
        mark, at = self._places(values)
        return (self.marks[at] == mark[:, None]).any(axis=1) | (self.marks[self._other(at, mark)] == mark[:, None]).any(axis=1)

    def insert(self, values: np.ndarray, rounds: int = 400) -> bool:
        """Add distinct values that are not in the filter.  False: no room; build it anew from the exact table."""
        mark, at = self._places(values)
        random = np.random.default_rng(1)
        for turn in range(rounds):
            order = np.argsort(at, kind="stable")
            mark, at = mark[order], at[order]
            nth = np.arange(at.size) - np.searchsorted(at, at)
            empty = np.argsort(self.marks[at] != 0, axis=1, kind="stable")
            fits = nth < (self.marks[at] == 0).sum(axis=1)
            self.marks[at[fits], empty[fits, nth[fits]]] = mark[fits]
            mark, at = mark[~fits], at[~fits]
            if not mark.size:
                return True
            if turn % 2:  # push one mark of each full bucket out and take its place
                _, one = np.unique(at, return_index=True)
                slot = random.integers(0, self.WIDTH, one.size)
                pushed = self.marks[at[one], slot]
                self.marks[at[one], slot] = mark[one]
                mark[one] = pushed
            at = self._other(at, mark)
        return False

    def delete(self, values: np.ndarray) -> None:
        """Remove values that were inserted."""
        mark, at = self._places(values)
        for m, x, y in zip(mark, at, self._other(at, mark), strict=True):
            for bucket in (x, y):
                hit = np.flatnonzero(self.marks[bucket] == m)
                if hit.size:
                    self.marks[bucket, hit[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.marks.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        marks = np.frombuffer(data, dtype=np.uint16).reshape(-1, cls.WIDTH).copy()
        out = cls(1)
        out.marks, out.buckets = marks, len(marks)
        return out


def _values(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<u8")[::2]


def _fresh(key, group):
    return pd.DataFrame({"shard": [key[0]], "data": [CuckooFilter.build(np.unique(_values(group["key"]))).to_bytes()]})


def _row(text: str = "text"):
    """A hash of a row's text: rows that share a doc_id are looked up one by one, not in one heap."""
    return F.hash(text_bytes(text))


def line_pairs(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, row, key) for each distinct line key of each row; a null id becomes NO_ID, row is a hash of the text."""

    def pairs(batches):
        for b in batches:
            ids, rows, keys = [], [], []
            for doc, row, data in zip(b["doc_id"], b["row"], b["data"], strict=True):
                found = {k for line in set(bytes(data).split(b"\n")) if (k := line_key(line, least))}
                ids += [doc] * len(found)
                rows += [row] * len(found)
                keys += found
            yield pd.DataFrame({"doc_id": ids, "row": rows, "key": keys})

    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), _row().alias("row"), text_bytes().alias("data"))
    return texts.mapInPandas(pairs, "doc_id long, row int, key binary")


class LineIndex:
    """Reference counts of line keys over the documents inserted so far, with a filter for each shard.

    Three tables, each operation writing new ones to the shared folder: postings (doc_id, key), refs (key,
    refs, first: number of distinct documents and the smallest id) and filters (shard, data) over the keys
    with refs of two or more.  Shards are dealt by key and have about shard_keys keys; once they have grown to twice
    that, all filters are built anew for more shards.
    """

    def __init__(self, spark: SparkSession, shard_keys: int = 500_000):
        self.spark, self.shard_keys, self.shards = spark, shard_keys, 0
        self.postings = spark.createDataFrame([], "doc_id long, key binary")
        self.refs = spark.createDataFrame([], "key binary, refs long, first long")
        self.filters = spark.createDataFrame([], "shard int, data binary")

    def _shard(self, key: str = "key"):
        return F.pmod(F.xxhash64(key), F.lit(self.shards)).cast("int")

    def insert(self, pairs: DataFrame) -> None:
        """Add documents, given by their line pairs.  An id that the index holds is an error: delete it first.

        Rows of one id count as one document, so pairs may repeat.  They are made distinct by document and key and
        then counted by key, after partial counts in each task: a line in a third of all documents is a few rows there.
        """
        first_time, old = self.shards == 0, self.refs
        pairs = pairs.select("doc_id", "key")
        if not first_time:
            known = self.postings.select("doc_id").join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").first()
            if known is not None:
                raise ValueError(f"document {known['doc_id']} is in the index")
        added = pairs.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("refs"), F.min("doc_id").alias("first"))
        refs = added if first_time else old.unionByName(added).groupBy("key").agg(F.sum("refs").alias("refs"), F.min("first").alias("first"))
        refs = cut(refs, "refs")
        keys = refs.count()
        if keys > 2 * self.shards * self.shard_keys or first_time:
            self.shards = max(1, -(-keys // self.shard_keys))
            self.filters = cut(self._built(refs), "filters")
        else:
            self._change_filters(refs.filter("refs > 1").join(old.filter("refs > 1"), "key", "left_anti"), refs, add=True)
        self.refs, self.postings = refs, pairs if first_time else cut(self.postings.unionByName(pairs), "postings")

    def _built(self, refs: DataFrame) -> DataFrame:
        """Filters of all shards from the exact counts."""
        return refs.filter("refs > 1").select(self._shard().alias("shard"), "key").groupBy("shard").applyInPandas(_fresh, "shard int, data binary")

    def delete(self, doc_ids: DataFrame) -> None:
        """Take documents (doc_id) out again; keys only they repeated are no longer repeated."""
        gone = doc_ids.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id")).distinct()
        touched = cut(self.postings.join(gone, "doc_id", "left_semi").select("key").distinct(), "touched")
        postings = cut(self.postings.join(gone, "doc_id", "left_anti"), "postings")
        left = postings.join(touched, "key", "left_semi").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("refs"), F.min("doc_id").alias("first"))
        refs = cut(self.refs.join(touched, "key", "left_anti").unionByName(left), "refs")
        fallen = self.refs.filter("refs > 1").join(touched, "key", "left_semi").join(refs.filter("refs > 1"), "key", "left_anti")
        self._change_filters(fallen, refs, add=False)
        self.refs, self.postings = refs, postings

    def _change_filters(self, keys: DataFrame, refs: DataFrame, add: bool) -> None:
        """Insert keys into, or delete them from, the filters of their shards."""
        n = "shard int, data binary"

        def step(key, old, group):
            values = np.unique(_values(group["key"])) if len(group) else np.zeros(0, dtype=np.uint64)
            f = CuckooFilter.from_bytes(old["data"].iloc[0]) if len(old) else CuckooFilter.build(values)
            full = len(old) and add and not f.insert(values)
            if len(old) and not add:
                f.delete(values)
            return pd.DataFrame({"shard": [key[0]], "data": [b"" if full else f.to_bytes()]})

        changed = self.filters.groupBy("shard").cogroup(keys.select(self._shard().alias("shard"), "key").groupBy("shard"))
        changed = cut(changed.applyInPandas(step, n), "filters")
        full = changed.filter(F.octet_length("data") == 0).select("shard")
        if not full.isEmpty():  # these shards outgrew their filters: build them from the exact counts
            again = refs.withColumn("shard", self._shard()).join(full, "shard", "left_semi").drop("shard")
            changed = cut(changed.filter(F.octet_length("data") > 0).unionByName(self._built(again)), "filters")
        self.filters = changed

    def repeated_in(self, pairs: DataFrame, task_rows: int = 500_000, most_hot: int = 100_000) -> DataFrame:
        """Those (doc_id, row, key) whose key at least two documents hold and whose document isn't the smallest of them.

        Pairs meet the filter of their shard; a shard with many pairs is split into as many parts as it
        takes, each with a copy of the filter, so a line in a third of all documents fills no task.  The exact table
        then comes to the pairs of lines with more than one in most_hot of all references, which are fewer than
        that many, by a broadcast, and all others are joined by key.
        """
        if self.filters.isEmpty():
            return pairs.limit(0)
        dealt = pairs.withColumn("shard", self._shard())
        parts = dealt.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / task_rows).cast("int").alias("parts"))
        parts = cut(parts, "parts")
        blank = F.lit(None)
        asking = dealt.join(parts, "shard").select("shard", F.pmod(F.xxhash64("doc_id", "row"), "parts").cast("int").alias("part"), "key", "doc_id", "row", blank.cast("binary").alias("data"))
        answering = self.filters.join(parts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), blank.cast("binary").alias("key"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).alias("row"), "data")
        met = answering.unionByName(asking).repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("data").isNull())

        def probe(batches):
            at, f = None, None
            for b in batches:
                b = b.reset_index(drop=True)
                heads = np.flatnonzero(b["data"].notna().to_numpy())
                out = []
                for start, end in zip([0, *heads], [*heads, len(b)], strict=True):
                    if start < len(b) and b["data"].iat[start] is not None:
                        f, at, start = CuckooFilter.from_bytes(b["data"].iat[start]), (b["shard"].iat[start], b["part"].iat[start]), start + 1
                    rows = b.iloc[start:end]
                    rows = rows[(rows["shard"] == at[0]) & (rows["part"] == at[1])] if at else rows[:0]  # a shard without a filter has no repeated key
                    if len(rows):
                        out.append(rows[f.contains(_values(rows["key"]))])
                if out:
                    yield pd.concat(out)[["doc_id", "row", "key"]]

        maybe = met.mapInPandas(probe, "doc_id long, row int, key binary")
        total = self.refs.agg(F.sum("refs")).first()[0] or 0
        found = join_counted(maybe, self.refs.filter("refs > 1"), "key", "refs", total, most_hot)
        return found.filter(F.col("doc_id") != F.col("first")).select("doc_id", "row", "key")


def drop_lines(docs: DataFrame, dropped: DataFrame, least: int = 10) -> DataFrame:
    """docs with columns n_lines, n_dropped and kept: the text without the lines in dropped (doc_id, row, key).

    A null text is one empty line.  Kept lines stay as they are, joined by line feeds.  A row is joined to the keys of
    rows with its id and text, of which there are no more than it has lines.
    """
    key, row, keys = (spare(c, docs.columns) for c in ("line_doc_id", "line_row", "line_keys"))
    names = [spare(c, docs.columns) for c in ("n_lines", "n_dropped", "kept")]
    per_doc = dropped.groupBy(F.col("doc_id").alias(key), F.col("row").alias(row)).agg(F.collect_set("key").alias(keys))
    same = (F.coalesce(docs["doc_id"], F.lit(NO_ID)) == F.col(key)) & (_row() == F.col(row))
    joined = docs.join(per_doc.hint("shuffle_hash"), same, "left")

    def keep(batches):
        for texts, drops in batches:
            total, lost, kept = [], [], []
            for data, drop in zip(texts, drops, strict=True):
                lines = bytes(data).split(b"\n")
                total.append(len(lines))
                if drop is not None and len(drop):
                    drop = set(map(bytes, drop))
                    lines = [x for x in lines if line_key(x, least) not in drop]
                lost.append(total[-1] - len(lines))
                kept.append(b"\n".join(lines))
            yield pd.DataFrame({"n_lines": total, "n_dropped": lost, "kept": kept})

    cleaned = F.pandas_udf(keep, "n_lines long, n_dropped long, kept binary", F.PandasUDFType.SCALAR_ITER)
    out = joined.select(*columns(docs), cleaned(text_bytes(), F.col(keys)).alias(key))
    return out.select(*map(quoted, docs.columns), F.col(f"{key}.n_lines").alias(names[0]), F.col(f"{key}.n_dropped").alias(names[1]), F.col(f"{key}.kept").cast("string").alias(names[2]))


def dedup_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """Index all documents and drop, from each, the repeated lines that a smaller doc_id holds too.

    Returns docs with n_lines, n_dropped and kept, with a _ in front where docs has columns of these names.  Rows with
    one doc_id are one document; a null doc_id is one too, larger than all others.  Empty and short lines always
    stay, null texts are one empty line, an empty table gives none.  Texts of any length are read whole.
    """
    pairs = cut(line_pairs(docs, least), "pairs")
    index = LineIndex(docs.sparkSession)
    index.insert(pairs)
    return drop_lines(docs, cut(index.repeated_in(pairs), "dropped"), least)
