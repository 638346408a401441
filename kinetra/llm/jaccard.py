"""N-gram Jaccard join by T-occurrence search.

Two sets of shingles link when percent/100 of their union is shared, which is a required overlap T.  The search
runs inside blocks of candidate sets: a block's sets have inverted lists; for each query the T - 1 longest of
its lists are set aside, the short rest is merged, and what occurs there is completed by binary probes of
the long ones (DivideSkip).

Blocks come from an exact filter.  All sets have their shingles in one order, that of their hashes.  Sets that link
share at least so many shingles that the first few of those shared lie in a prefix of either set; the prefixes
are made a tenth of a set longer than for one such shingle, so that about a tenth of a set must be shared there.
A set with too few prefix shingles that another prefix has links with nothing and goes.  The sets left meet by the
rarest of their prefix shingles, and sketches tell most sets apart that meet by chance: sets that meet and may
link by their sketches, and the sets these may link with, form a family.  Passages shared by many documents are
not rare and so make none.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.llm.common import BROADCAST_ROWS, NO_ID, cut, gram_hashes, join_counted, spare, text_bytes, word_hashes
from kinetra.llm.graph import components


def shingles(data: bytes, n: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of n words; of fewer words, the whole as one; else none."""
    return np.unique(gram_hashes(word_hashes(data)[0], n))


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(tokens.astype("<u8").tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def least(size: int, percent: int) -> int:
    """Shingles that a set of this size shares at least with any set it links with; also that set's least size."""
    return -(-size * percent // 100)


def _early(size: int, percent: int) -> int:
    """How many of the shingles shared with another set its prefix is made long enough for."""
    return min(least(size, percent), 1 + size // 10)


def prefix_size(size: int, percent: int = 90) -> int:
    """Length of a set's prefix: of any shared shingles, the first _early(size) lie in it."""
    return size - least(size, percent) + _early(size, percent)


def needed(size: int, percent: int = 90) -> int:
    """How many shingles of its prefix a set has in common with the prefix of any set it links with, at least.

    The other set may be smaller, and its prefix made for fewer shared shingles, but not smaller than least(size).
    """
    return _early(least(size, percent), percent)


def sketch(tokens: np.ndarray, percent: int = 90) -> bytes:
    """The size of a set, and for each of 64 bits or more whether an odd number of its shingles falls there.

    Every shingle that only one of two sets has changes one bit, so that sets that link differ in few; unrelated
    ones differ in half of the bits, which are 2.5 times as many as equally large sets that link may differ in.
    """
    bits = 64
    while 2 * bits < 10 * (tokens.size - required(tokens.size, tokens.size, percent)):
        bits *= 2
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.array([tokens.size], dtype="<u8").tobytes() + np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class _Sketches:
    def __init__(self, sketches: list[bytes], percent: int):
        self.percent = percent
        self.words = np.frombuffer(b"".join(sketches), dtype="<u8")
        length = np.array([len(s) // 8 for s in sketches], dtype=np.int64)
        self.begin, self.width = np.cumsum(length) - length + 1, length - 1
        self.size = self.words[self.begin - 1].astype(np.int64)

    def _folded(self, at: np.ndarray, width: int, to: int) -> np.ndarray:
        """Words of these sets' bits, all of one width, as they are for fewer bits."""
        words = self.words[self.begin[at][:, None] + np.arange(width)]
        return np.bitwise_xor.reduce(words.reshape(at.size, width // to, to), axis=1)

    def may_link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each i whether sets a[i] and b[i] may link; of sets that do, it is always true."""
        found = np.zeros(a.size, dtype=bool)
        for k in range(0, a.size, 1 << 14):
            x, y = a[k : k + (1 << 14)], b[k : k + (1 << 14)]
            at = np.flatnonzero(100 * np.minimum(self.size[x], self.size[y]) >= self.percent * np.maximum(self.size[x], self.size[y]))
            widths = np.stack([self.width[x[at]], self.width[y[at]]], axis=1)
            for wx, wy in np.unique(widths, axis=0).tolist():
                i = at[(widths == (wx, wy)).all(axis=1)]
                to = min(wx, wy)
                apart = np.bitwise_count(self._folded(x[i], wx, to) ^ self._folded(y[i], wy, to)).sum(axis=1, dtype=np.int64)
                n, m = self.size[x[i]], self.size[y[i]]
                found[k + i] = apart <= n + m - 2 * required(n, m, self.percent)
        return found


class _Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.up[at]
        while (higher := self.up[up]).tolist() != up.tolist():
            up = higher
        return up

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def required(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of n and m shingles with 100 * overlap >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


class _Lists:
    """Inverted lists of a block as two arrays: the sets that hold each shingle, ascending, and where each list begins."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([s.size for s in sets], dtype=np.int64)
        everything, inverse = np.unique(np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64), return_inverse=True)
        self.length = np.bincount(inverse, minlength=everything.size)
        self.begin = np.cumsum(self.length) - self.length
        by_shingle = np.argsort(inverse, kind="stable")
        self.postings = np.repeat(np.arange(len(sets), dtype=np.int32), self.size)[by_shingle]
        self.seen = np.zeros(everything.size, dtype=np.int64)  # how many of a list's sets have been queries
        self.of = np.split(inverse, np.cumsum(self.size)[:-1]) if sets else []

    def part(self, t: int, least: int) -> np.ndarray:
        """Sets numbered least or more in list t, among those that have been queries."""
        found = self.postings[self.begin[t] : self.begin[t] + self.seen[t]]
        return found[np.searchsorted(found, least) :]

    def holding(self, lists: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """How many of these lists have each of the sets, by binary search: one set in all lists side by side, or all sets list by list."""
        if sets.size > 1:
            found = np.zeros(sets.size, dtype=np.int64)
            for t in lists.tolist():
                p = self.postings[self.begin[t] : self.begin[t] + self.seen[t]]
                if p.size:
                    found += p[np.minimum(np.searchsorted(p, sets), p.size - 1)] == sets
            return found
        low, ends = self.begin[lists], self.begin[lists] + self.seen[lists]
        high = ends.copy()
        while (going := np.flatnonzero(low < high)).size:
            middle = (low[going] + high[going]) // 2
            less = self.postings[middle] < sets[0]
            low[going[less]], high[going[~less]] = middle[less] + 1, middle[~less]
        return np.array([np.count_nonzero(self.postings[low[low < ends]] == sets[0])])


def link_block(sets: list[np.ndarray], percent: int = 90, sides: list[int] | None = None, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that span the components of a block of sorted shingle sets, by T-occurrence search.

    Each set is a query for the smaller ones.  The T - 1 longest of its lists are set aside; a heap merges the others, the
    nearest size first, and so counts in how many of them each candidate occurs.  Candidates that can reach T with the long
    lists are looked up in each of those by binary search (DivideSkip), a few at a time.  Not every link comes back, but every
    pair that links is connected by those that do: after a link, what is in the query's component by then leaves the
    lists.  With sides, only pairs of different sides are looked at; known are components found before.
    """
    n = len(sets)
    order = sorted(range(n), key=lambda i: sets[i].size)
    # Numbered by size, so that lists are ascending as sets become queries, and candidates of a least size are a list's end.
    sets = [sets[i] for i in order]
    sides, known = sides and np.array([sides[i] for i in order]), known and [known[i] for i in order]
    forest = _Forest(n)
    if known:
        first: dict[int, int] = {}
        for i, label in enumerate(known):
            forest.up[i] = first.setdefault(label, i)
    lists = _Lists(sets)
    links = []
    for x in range(n):
        mine = lists.of[x]
        if not mine.size:
            continue
        smallest = -(-mine.size * percent // 100)
        aside = required(mine.size, smallest, percent) - 1
        by_length = mine[np.argsort(lists.length[mine], kind="stable")]
        short, long = by_length[: mine.size - aside], by_length[mine.size - aside :]
        least = int(np.searchsorted(lists.size, smallest))
        parts = [lists.part(t, least) for t in short.tolist()]
        if sides is not None:
            parts = [p[sides[p] != sides[x]] for p in parts]
        apart, many = known is None, 1  # at first nothing but x itself is in its component
        while True:
            if not apart:
                root = forest.roots(np.arange(x + 1))
                parts = [p[root[p] != root[x]] for p in parts]
            merged = itertools.groupby(heapq.merge(*(p[::-1].tolist() for p in parts if p.size), reverse=True))
            linked = np.zeros(0, dtype=np.int64)
            while not linked.size and (some := [(y, sum(1 for _ in same)) for y, same in itertools.islice(merged, many)]):
                y, hits = np.array(some).T
                wanted = required(mine.size, lists.size[y], percent)
                y, hits, wanted = (v[hits + aside >= wanted] for v in (y, hits, wanted))
                if y.size:
                    linked = y[hits + lists.holding(long, y) >= wanted]
                many *= 4
            if not linked.size:
                break
            for y in linked.tolist():
                if forest.root(x) != forest.root(y):
                    links.append((order[x], order[y]))
                    forest.join(x, y)
            parts, apart = [p[p < some[-1][0]] for p in parts], False
        lists.seen[mine] += 1
    return links


def _starts(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where the rows of each key begin in rows sorted by it, and their end."""
    values = rows[keys].to_numpy()
    return np.concatenate([[0], 1 + np.flatnonzero((values[1:] != values[:-1]).any(axis=1)), [len(rows)]])


def _whole(batches, keys: list[str]):
    """Batches sorted by a key, divided anew so that all rows of a key are in one."""
    rest = None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        last = _starts(b, keys)[-2] if len(b) else 0
        if last:
            yield b.iloc[:last]
        rest = b.iloc[last:]
    if rest is not None and len(rest):
        yield rest


def _runs(batches, keys: list[str]):
    """Rows of each key, from batches sorted by it."""
    for b in _whole(batches, keys):
        for s, e in itertools.pairwise(_starts(b, keys)):
            yield b.iloc[s:e]


def near_pairs(starts: np.ndarray, sketches: _Sketches, few: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets that span the components of those that meet in a bucket and may link.

    Sets are numbered bucket by bucket, starts as _starts gives them.  In buckets of few sets every pair is looked at.  In
    others one set after the other gathers those it may link with from the sets that none has gathered yet.
    """
    n = np.diff(starts)
    after = np.repeat(np.where(n <= few, starts[1:], 0), n) - 1 - np.arange(starts[-1])
    after = np.maximum(after, 0)  # how many sets of its bucket each is compared with
    a = np.repeat(np.arange(starts[-1]), after)
    b = a + 1 + np.arange(a.size) - np.repeat(np.cumsum(after) - after, after)
    found = sketches.may_link(a, b)
    out = [(a[found], b[found])]
    for s, e in zip(starts[:-1][n > few].tolist(), starts[1:][n > few].tolist(), strict=True):
        left = np.arange(s, e)
        while left.size:
            todo, left = [left[0]], left[1:]
            while todo and left.size:
                x = np.full(left.size, todo.pop())
                found = sketches.may_link(x, left)
                out.append((x[found], left[found]))
                todo += left[found].tolist()
                left = left[~found]
    a, b = zip(*out, strict=True)
    return np.concatenate(a), np.concatenate(b)


def _near(rare: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) among k1 that connect all sets of rare (k1, token) that link, by their sketches (k1, sketch)."""

    def meet(batches):
        for rows in _whole(batches, ["token"]):
            k1 = rows["k1"].to_numpy()
            a, b = near_pairs(_starts(rows, ["token"]), _Sketches(rows["sketch"].tolist(), percent))
            yield pd.DataFrame({"a": np.minimum(k1[a], k1[b]), "b": np.maximum(k1[a], k1[b])}).drop_duplicates()

    dealt = rare.join(sketches.hint("merge"), "k1").select("token", "k1", "sketch").repartition("token").sortWithinPartitions("token")
    return dealt.mapInPandas(meet, "a long, b long").distinct()


def _solve(sets: DataFrame, percent: int, pairs: bool) -> DataFrame:
    """Edges (a, b) among sets (family, i, j, side, label, node, tokens), block by block of (family, i, j)."""

    def solve(batches):
        for rows in _runs(batches, ["family", "i", "j"]):
            arrays = [np.frombuffer(t, dtype="<u8") for t in rows["tokens"]]
            node = rows["node"].tolist()
            sides = rows["side"].tolist() if rows["i"].iat[0] != rows["j"].iat[0] else None
            found = link_block(arrays, percent, sides, rows["label"].tolist() if pairs else None)
            if found:
                yield pd.DataFrame({"a": [node[x] for x, _ in found], "b": [node[y] for _, y in found]})

    dealt = sets.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "node")
    return dealt.mapInPandas(solve, "a binary, b binary")


def _met_here(keys: list[int], prefixes: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each set, which shingles of its prefix other sets of the batch have too, and for which it is told.

    It is told for shingles that it alone has, and for the others if its key is their smallest or largest.
    """
    if not prefixes:
        return [], []
    sizes = [p.size for p in prefixes]
    owner = np.repeat(np.array(keys, dtype=np.int64), sizes)
    everything, inverse = np.unique(np.concatenate(prefixes), return_inverse=True)
    low, high = np.full(everything.size, np.iinfo(np.int64).max), np.full(everything.size, np.iinfo(np.int64).min)
    np.minimum.at(low, inverse, owner)
    np.maximum.at(high, inverse, owner)
    low, high = low[inverse], high[inverse]
    borders = np.cumsum(sizes)[:-1]
    return np.split(low < high, borders), np.split((owner == low) | (owner == high), borders)


def _text_digest():
    """128 bits of a row's text; with the doc_id, they name the rows that are judged alike."""
    return F.unhex(F.md5(text_bytes()))


def _describe(docs: DataFrame, n: int, percent: int, digest: bool) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, needed, alone, met, told, sketch) of each row; k1, k2 are a hash of the set, none of no shingles.

    If asked for, digest, of the whole text, comes before them.
    alone and met are the set's prefix: shingles that no other set of the same batch of rows has there, and those that
    another has.  A task gives them and the sketch once a set, however many copies it meets, as long as it remembers it.  told
    is true where a shingle of met must be known outside: a shingle of a third of all sets so reaches the exchange twice a batch.
    """

    def describe(batches):
        seen: set = set()
        for b in batches:
            out, prefixes, new, sketches = [], [], [], [None] * len(b)
            for data in b["data"]:
                tokens = shingles(bytes(data), n)
                if not tokens.size:
                    out.append((0, None, None, None))
                    continue
                key = set_key(tokens)
                if key not in seen:
                    seen.add(key)
                    sketches[len(out)] = sketch(tokens, percent)
                    new.append(len(out))
                    prefixes.append(tokens[: prefix_size(tokens.size, percent)].view(np.int64))
                out.append((tokens.size, *key, needed(tokens.size, percent)))
            if len(seen) > 1_000_000:
                seen.clear()
            size, k1, k2, need = zip(*out, strict=True) if out else ((), (), (), ())
            alone, met, told = [None] * len(out), [None] * len(out), [None] * len(out)
            for i, p, shared, tell in zip(new, prefixes, *_met_here([k1[i] for i in new], prefixes), strict=True):
                alone[i], met[i], told[i] = p[~shared], p[shared], tell[shared]
            keys = {"k1": pd.Series(k1, dtype="Int64"), "k2": pd.Series(k2, dtype="Int64"), "needed": pd.Series(need, dtype="Int64")}
            yield pd.DataFrame({**{c: b[c] for c in names}, "n_shingles": size, **keys, "alone": alone, "met": met, "told": told, "sketch": sketches})

    raw = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), text_bytes().alias("data"), *[_text_digest().alias("digest")] * digest)
    names = [c for c in raw.columns if c != "data"]
    kinds = "doc_id long, digest binary" if digest else "doc_id long"
    kinds += ", n_shingles long, k1 long, k2 long, needed long, alone array<long>, met array<long>, told array<boolean>, sketch binary"
    return raw.mapInPandas(describe, kinds)


def _rare_shingles(described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(k1, token): prefix shingles by which sets may link; any two sets that link both have a row of one token.  And (k1, sketch).

    First, sets with too few prefix shingles that another set has go; copies of a set in several tasks can only keep
    one more.  Of the s shingles that a set then still shares, another set must have needed, so that of the
    s - needed + 1 rarest both have one, whatever the ties.
    """
    sets = described.filter("alone IS NOT NULL")
    alone = sets.select(F.explode("alone").alias("token"), "k1", F.lit(True).alias("counts"))
    told = sets.select(F.explode(F.filter("met", lambda _, i: F.get("told", i))).alias("token"), "k1", F.lit(False).alias("counts"))
    bucket = Window.partitionBy("token")
    ends = alone.unionByName(told).select("k1", "counts", F.min("k1").over(bucket).alias("low"), F.max("k1").over(bucket).alias("high"))
    elsewhere = ends.filter("counts AND low < high").groupBy("k1").agg(F.count(F.lit(1)).alias("elsewhere"))
    here = sets.groupBy("k1").agg(F.max(F.size("met")).alias("here"), F.min("needed").alias("needed"), F.collect_set("sketch").alias("sketches"))
    enough = F.col("here") + F.coalesce("elsewhere", F.lit(0)) >= F.col("needed")
    left = cut(here.join(elsewhere, "k1", "left").filter(enough).select("k1", "needed", "sketches"), "left")

    postings = sets.select("k1", F.explode(F.concat("alone", "met")).alias("token")).join(_checked(left.select("k1", "needed")), "k1")
    postings = cut(postings.distinct(), "postings")
    tokens = postings.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    tokens = tokens.withColumn("rows", F.col("sets"))
    shared = join_counted(postings, tokens, "token", "rows", postings.count(), written=True)
    mine = Window.partitionBy("k1")
    ranked = shared.select(
        "k1", "token", "needed", F.count(F.lit(1)).over(mine).alias("of"), F.row_number().over(mine.orderBy("sets", "token")).alias("at")
    )
    return cut(ranked.filter("at <= of - needed + 1").select("k1", "token"), "rare"), left.select("k1", F.explode("sketches").alias("sketch"))


def _checked(few: DataFrame) -> DataFrame:
    """A written table of few columns as the right side of a join: broadcast if it is small enough, else shuffled."""
    return few.hint("broadcast" if few.count() <= BROADCAST_ROWS else "shuffle_hash")


def _node():
    """All 128 bits of a set's hash as bytes: what links and components name sets by, so that no two sets share a name."""
    part = lambda c: F.lpad(F.hex(c), 16, "0")
    return F.unhex(F.concat(part("k1"), part("k2")))


def _sets_of(docs: DataFrame, reps: DataFrame, n: int) -> DataFrame:
    """reps (doc_id, k1, k2, family) with the tokens of their sets, made again from the texts.

    A set may come more than once where rows share a doc_id; equal sets link with each other.
    """

    def read(batches):
        for b in batches:
            tokens = [shingles(bytes(x), n) for x in b["data"]]
            right = [set_key(t) == k for t, k in zip(tokens, zip(b["k1"], b["k2"], strict=True), strict=True)]
            out = b[["k1", "k2", "family"]].assign(tokens=[t.astype("<u8").tobytes() for t in tokens])
            yield out[right]

    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), text_bytes().alias("data"))
    joined = texts.join(_checked(reps), "doc_id").select("k1", "k2", "family", "data")
    return joined.mapInPandas(read, "k1 long, k2 long, family long, tokens binary")


def _blocks(sets: DataFrame, block: int, salt: int | None) -> DataFrame:
    """Deal each family's sets into blocks: side by side if there is a salt, else every pair of blocks."""
    sizes = sets.groupBy("family").agg(F.count(F.lit(1)).alias("sets"), F.sum(F.octet_length("tokens")).alias("bytes"))
    n = F.ceil(F.greatest(F.col("sets") / block, F.col("bytes") / (block << 13))).cast("int")
    sizes = cut(sizes.select("family", n.alias("n")), "sizes")
    dealt = sets.join(_checked(sizes), "family").withColumn("side", F.pmod(F.xxhash64(F.lit(salt or 0), "node"), "n").cast("int"))
    if salt is not None:
        return dealt.withColumn("i", F.col("side")).withColumn("j", F.col("side"))
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    return dealt.withColumn("other", other).withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other"))


def _label_sets(docs: DataFrame, n: int, percent: int, block: int, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows as _describe gives them, and (k1, k2, first, label) of each set: its smallest doc_id and its component.

    Equal sets are one node of all that follows.  Families are found by 64-bit hashes, where a collision only makes one
    larger; links and components go by 128 bits.  Families of more than block sets are first linked inside
    blocks, twice, dealt by different hashes; that is linear and joins nearly all that belongs together.  Only
    sets that still share a rare prefix shingle with another component are then compared block by block, each with those that
    such shingles lead to.
    """
    described = cut(_describe(docs, n, percent, digest), "described")
    rare, sketches = _rare_shingles(described)
    families = components(cut(_near(rare, sketches, percent), "near")).select(F.col("node").alias("k1"), F.col("label").alias("family"))

    classes = cut(described.filter("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id")), "classes")
    reps = cut(classes.join(families, "k1").select("doc_id", "k1", "k2", "family"), "reps")
    sets = cut(_sets_of(docs, reps, n).select("k1", _node().alias("node"), "family", "tokens", F.lit(None).cast("binary").alias("label")), "sets")
    sizes = sets.groupBy("family").agg((F.greatest(F.count(F.lit(1)), F.sum(F.octet_length("tokens")) / (1 << 13)) > block).alias("large"))
    large = cut(sizes.filter("large").select("family"), "large")
    small = sets.join(_checked(large), "family", "left_anti").withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(0)})
    links = [cut(_solve(small, percent, pairs=False), "links")]
    if not large.isEmpty():
        big = sets.join(_checked(large), "family", "left_semi")
        links += [cut(_solve(_blocks(big, block, salt), percent, pairs=False), "links") for salt in (1, 2)]
        labels = components(links[1].unionByName(links[2]))
        labelled = big.select("k1", "node", "family").distinct().join(labels, "node", "left")
        labelled = labelled.select("k1", "node", F.col("family").alias("of"), F.coalesce("label", "node").alias("label"))
        # Shingles meet numbers of labels, so that little crosses the network: those of two labels of a family or more, then their sets.
        numbered = cut(labelled.withColumn("number", F.xxhash64("label")), "labelled")
        few = _checked(numbered.select("k1", "number", "of"))
        buckets = rare.join(few, "k1").groupBy("token", "of").agg(F.min("number").alias("low"), F.max("number").alias("high")).filter("low < high")
        buckets = cut(buckets.select("token", "of", F.col("low").alias("first")), "buckets")
        shared = rare.join(few, "k1").join(_checked(buckets), ["token", "of"])
        shared = cut(shared.select("k1", "number", F.col("first").alias("low")).distinct(), "shared")
        near = components(shared.select(F.col("number").alias("a"), F.col("low").alias("b")).distinct())
        open_ = shared.join(_checked(near.select(F.col("node").alias("number"), F.col("label").alias("family"))), "number").select("k1", "family").distinct()
        open_ = numbered.select("k1", "node", "label").join(open_, "k1").select("node", "label", "family")
        rest = big.drop("label", "family").join(_checked(cut(open_, "open")), "node")
        links.append(cut(_solve(_blocks(rest, block, None), percent, pairs=True), "links"))
    together = links[0]
    for more in links[1:]:
        together = together.unionByName(more)
    named = classes.withColumn("node", _node()).join(_checked(components(together)), "node", "left")
    return described, named.select("k1", "k2", F.col("doc_id").alias("first"), F.coalesce("label", "node").alias("label"))


def near_duplicates(docs: DataFrame, n: int = 3, percent: int = 90, block: int = 1024) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text).

    component_id is the smallest doc_id that links reach, its own included.  Rows link when their sets of
    n-word shingles share percent/100 of their union; equal sets always do.  A text of fewer words is one shingle;
    null, empty and blank texts have none and link with nothing.  Every row is judged by its own text, so rows
    may share a doc_id.  A null doc_id counts as larger than all others and comes back as null.
    """
    described, named = _label_sets(docs, n, percent, block)
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    by_class = cut(named.join(smallest, "label").select("k1", "k2", "component_id"), "components")
    rows = described.select("doc_id", "n_shingles", "k1", "k2").join(by_class, ["k1", "k2"], "left")
    return rows.select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_shingles",
        F.nullif(F.coalesce("component_id", "doc_id"), F.lit(NO_ID)).alias("component_id"),
    )


def keep_one(docs: DataFrame, n: int = 3, percent: int = 90, block: int = 1024) -> DataFrame:
    """docs with one row of each component of near duplicates, and all rows whose texts have no shingles; same columns.

    The row with the smallest doc_id stays, a null one being the largest; of several with that id the one with
    the smallest digest of its text, of equal texts the smallest as JSON.  Every row is judged by its own text.
    """
    described, named = _label_sets(docs, n, percent, block, digest=True)
    rows = described.filter("n_shingles > 0").select("doc_id", "digest", "k1", "k2")
    first = rows.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "digest")).alias("first"))
    best = first.join(named.select("k1", "k2", "label"), ["k1", "k2"]).groupBy("label").agg(F.min("first").alias("first"))
    best = cut(best.select("first.*", F.lit(True).alias("stays")), "best")
    texts = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("rows"))
    found = texts.join(best, ["doc_id", "digest"], "left").filter("stays IS NULL OR rows > 1")
    names = [spare(c, docs.columns) for c in ("one_id", "one_digest", "one_row")]
    found = cut(found.select(F.col("doc_id").alias(names[0]), F.col("digest").alias(names[1]), "stays"), "gone")
    gone, repeated = _checked(found.select(*names[:2])), cut(found.filter("stays").select(*names[:2]), "repeated")
    same = (F.coalesce(F.col("doc_id"), F.lit(NO_ID)) == F.col(names[0])) & (_text_digest() == F.col(names[1]))
    left = docs.join(gone, same, "left_anti")
    if repeated.isEmpty():
        return left
    whole = F.struct(*(F.col(c) for c in docs.columns))
    one = docs.join(_checked(repeated), same).groupBy(*names[:2]).agg(F.min_by(whole, F.to_json(whole)).alias(names[2]))
    return left.unionByName(one.select(f"{names[2]}.*"))
