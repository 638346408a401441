"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact token length within each source; a source's target is met by whole
passes over it plus a chosen number of documents of each length.  Those numbers start in proportion to
the length counts, and a bounded-knapsack dynamic programme fits what is left of the budget.  Which
documents of a length are taken is decided by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.llm.common import cut, quoted, spare

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def count_words(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(totals: DataFrame) -> DataFrame:
    """totals with nth: the place of its source, from 0, in code-point order with null last.

    Ranges of sources are dealt out to tasks and ranked there; only one row a range is summed up in one task.
    """
    by_name = F.col("source").asc_nulls_last()
    ranges = cut(totals.repartitionByRange(by_name).withColumn("range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("sources"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("range", F.coalesce(F.sum("sources").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(by_name)) - 1
    return ranges.withColumn("inside", inside).join(offsets, "range").select(*totals.columns, (F.col("offset") + F.col("inside")).alias("nth"))


def source_targets(totals: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) to the same with target: a weighted share of the budget, filled like water.

    Sources in code-point order, null last, take the weights in turn.  The budget is share times the
    sum of all sizes; no target exceeds most times its source's size, and what is cut off goes to
    the others by weight until none is above.  Where share is over most, every source is at its limit.
    Each round of sharing is an aggregate over the sources; the driver sees sums by weight.
    """
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("nth") % len(weights) + 1).cast("int"))
    sources = cut(_ranked(totals).select("source", "source_size", w.alias("weight")), "weights")
    limit, level, full = F.col("source_size") * F.lit(float(most)), 0.0, -1
    while True:  # the level only rises, so sources only leave the sharing
        at_limit = F.lit(level) * F.col("weight") >= limit
        rows = sources.groupBy("weight").agg(
            F.sum("source_size").alias("size"), F.coalesce(F.sum(F.when(at_limit, F.col("source_size"))), F.lit(0)).alias("cut"),
            F.count_if(at_limit).alias("full"), F.count_if(~at_limit).alias("open"),
        ).orderBy("weight").collect()
        now, shared = sum(r["full"] for r in rows), sum(r["open"] * r["weight"] for r in rows)
        if now == full or not shared:
            break
        full, level = now, max(level, (share * sum(r["size"] for r in rows) - most * sum(r["cut"] for r in rows)) / shared)
    return sources.select("source", "source_size", F.least(limit, F.lit(level) * F.col("weight") if any(r["open"] for r in rows) else limit).alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = 1 << 13, seed: int = 17) -> np.ndarray:
    """How many documents of each length to take so that their words come near to budget from below, exactly where that is found.

    First a proportional share of every length, rounded so that among any stretch of lengths the number taken is within
    one of the proportion: the fractions are added up from the shortest length on, from a seeded start, and whole
    documents taken as the sum passes whole numbers.  What that leaves over or short is about one document.  Documents
    that come nearest make it less than window, then an exact bounded knapsack fits the rest: it finds
    the sum nearest below, among all that the remaining documents can make.  While something is left, a document, then two,
    four and eight of each length are handed back, as far as window allows, and the knapsack fits what then is free.
    """
    lengths, counts = np.asarray(lengths, dtype=np.int64), np.where(np.asarray(lengths) > 0, counts, 0).astype(np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros_like(counts)
    if budget >= total:
        return counts
    order = np.argsort(lengths, kind="stable")
    start = np.random.default_rng(seed).random()
    passed = np.floor(np.cumsum(counts[order]) * (budget / total) + start).astype(np.int64)
    take = np.empty_like(counts)
    take[order] = np.clip(np.diff(passed, prepend=0), 0, counts[order])
    rest = budget - int((take * lengths).sum())
    while rest < 0:  # give back the shortest document that is enough, or else the longest
        held = order[take[order] > 0]
        one = next((i for i in held if lengths[i] >= -rest), held[-1])
        take[one] -= 1
        rest += int(lengths[one])
    for i in order[::-1]:
        if rest <= window:
            break
        k = min(int(counts[i] - take[i]), rest // int(lengths[i])) if lengths[i] > 0 else 0
        take[i] += k
        rest -= k * int(lengths[i])
    best = take + _knapsack(lengths, counts - take, rest, seed)
    for many in (1, 2, 4, 8):
        left = budget - int((best * lengths).sum())
        if not left or rest > window:
            break
        tried, room = take.copy(), rest
        for i in np.random.default_rng(seed).permutation(np.flatnonzero(take)):
            k = min(many, int(tried[i]), (window - room) // int(lengths[i]))
            tried[i] -= k
            room += k * int(lengths[i])
        found = tried + _knapsack(lengths, counts - tried, room, seed)
        if budget - int((found * lengths).sum()) < left:
            best = found
    return best


def _knapsack(lengths: np.ndarray, free: np.ndarray, rest: int, seed: int = 17) -> np.ndarray:
    """Bounded knapsack: counts per length whose words sum to the largest reachable value up to rest.

    Lengths come in a seeded order, so that no kind of document is preferred.
    """
    out = np.zeros_like(free)
    reached = np.zeros(rest + 1, dtype=bool)
    reached[0] = True
    #: For each sum first made with length i: that i, and how many of it the sum holds.
    last, held = np.full(rest + 1, -1, dtype=np.int32), np.zeros(rest + 1, dtype=np.int32)
    for i in np.random.default_rng(seed).permutation(lengths.size):
        step, most = int(lengths[i]), int(free[i])
        if step <= 0 or most <= 0 or step > rest:
            continue
        fresh = reached.copy()
        for k in range(1, min(most, rest // step) + 1):
            made = np.flatnonzero(fresh[: rest + 1 - step]) + step
            made = made[~reached[made]]
            if not made.size:
                break
            reached[made], last[made], held[made] = True, i, k
            fresh = np.zeros_like(reached)
            fresh[made] = True
        if reached[rest]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        out[last[at]] += held[at]
        at -= int(held[at]) * int(lengths[last[at]])
    return out


def _fit_source(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size").reset_index(drop=True)
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    passes = int(target // size) if size else 0
    extra = fit_budget(group["size"].to_numpy(), group["n"].to_numpy(), round(target - passes * size))
    return pd.DataFrame({"source": group["source"], "size": group["size"], "n": group["n"], "passes": passes, "extra": extra})


def _row_key(docs: DataFrame, seed: int) -> list[Column]:
    """Two seeded 64-bit hashes of a whole row; which columns are null counts too."""
    whole = [c for name in docs.columns for c in (docs[quoted(name)].isNull(), docs[quoted(name)])]
    return [F.xxhash64(F.lit(seed + i), *whole) for i in (0, 1)]


def _choose(docs: DataFrame, weights, share: float, most: float, seed: int, slice_rows: int) -> tuple[DataFrame, DataFrame]:
    """Distinct rows (k1, k2, doc_id, source, size, n, passes, more) and the sources' targets.

    k1, k2 are a hash of the whole row and n is how often it occurs; more of these n are taken once more than passes.
    """
    k1, k2 = _row_key(docs, seed)
    sized = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), k1.alias("k1"), k2.alias("k2"))
    sized = cut(sized.groupBy("k1", "k2").agg(*(F.first(c).alias(c) for c in ("doc_id", "source", "size")), F.count(F.lit(1)).alias("n")), "sizes")
    counts = cut(sized.groupBy("source", "size").agg(F.sum("n").alias("n")), "lengths")
    targets = cut(source_targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most), "targets")
    keyed = counts.join(targets, counts["source"].eqNullSafe(targets["source"])).select(counts["source"], "size", "n", "source_size", "target")
    fitted = cut(keyed.groupBy("source").applyInPandas(_fit_source, "source string, size long, n long, passes long, extra long"), "fitted")

    plan = fitted.select(F.col("source").alias("s"), F.col("size").alias("z"), "passes", "extra", F.ceil(F.col("n") / slice_rows).cast("long").alias("slices"))
    known = sized.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    known = known.withColumn("slice", F.pmod("k1", "slices")).drop("slices")
    per_slice = known.filter("extra > 0").groupBy("source", "size", "slice", "extra").agg(F.sum("n").alias("m"))
    up_to = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("extra") - F.coalesce(F.sum("m").over(up_to), F.lit(0))
    per_slice = per_slice.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("slice").alias("c"), "m", left.alias("left"))
    per_slice = cut(per_slice.filter(F.col("left") > 0), "slices")
    at_slice = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("slice") == F.col("c"))
    dealt = cut(known.join(per_slice, at_slice, "left").drop("s", "z", "c", "extra"), "chosen")
    edge = F.coalesce(F.col("left") < F.col("m"), F.lit(False))
    before = Window.partitionBy("source", "size", "slice").orderBy("k1", "k2").rowsBetween(Window.unboundedPreceding, -1)
    whole = dealt.filter(~edge).withColumn("more", F.when(F.col("left").isNotNull(), F.col("n")).otherwise(0))
    on_edge = dealt.filter(edge).withColumn("more", F.greatest(F.lit(0), F.least("n", F.col("left") - F.coalesce(F.sum("n").over(before), F.lit(0)))))
    rows = whole.unionByName(on_edge).select("k1", "k2", "doc_id", "source", "size", "n", "passes", F.col("more").cast("long").alias("more"))
    return rows, targets


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 17, slice_rows: int = 1024) -> DataFrame:
    """Every row (doc_id, source, size, source_size, target, copies): how often the mix takes each document.

    docs needs doc_id, text, source; other columns only tell rows apart.  A null or empty text has no words and is
    never taken.  A null source is a source of its own.  Rows with equal doc_id are chosen each for
    itself; rows equal in all columns are alike, and so many of them as wanted are taken.  An empty table gives none.
    Very long texts count whole; one longer than the budget of its source's last pass is left out of that pass.
    No group is gathered whole: documents of one source and length are counted in slices of a seeded
    hash of about slice_rows rows each; slices below the wanted number go in whole, and only the slice
    on the edge is ranked.  Equal rows are one row with a number there.
    """
    rows, targets = _choose(docs, weights, share, most, seed, slice_rows)
    has_words = (F.col("size") > 0).cast("long")
    kinds = F.array(*(F.struct((F.col("passes") * has_words + k).alias("copies"), times.alias("times")) for k, times in ((1, F.col("more")), (0, F.col("n") - F.col("more")))))
    each = rows.select("doc_id", "source", "size", F.inline(kinds)).filter("times > 0")
    each = each.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times", "nth")
    t = targets.select(F.col("source").alias("s"), "source_size", "target")
    return each.join(t, each["source"].eqNullSafe(t["s"])).select("doc_id", "source", "size", "source_size", "target", "copies")


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 17, slice_rows: int = 1024) -> DataFrame:
    """The mixed corpus: each document's row as often as the mix takes it, numbered from 1 in column copy.

    Rows are told apart by all their columns.  Rows that are equal in all of them are numbered through together, in
    parts of ten thousand copies that are made in tasks of their own.  Null and empty texts are never taken.
    """
    rows, _ = _choose(docs, weights, share, most, seed, slice_rows)
    names = [spare(c, docs.columns) for c in ("mix_k1", "mix_k2", "mix_rows", "mix_copies", "mix_row")]
    total = (F.col("n") * F.col("passes") + F.col("more")).alias(names[3])
    times = rows.filter("size > 0").select(F.col("k1").alias(names[0]), F.col("k2").alias(names[1]), F.col("n").alias(names[2]), total).filter(F.col(names[3]) > 0)
    k1, k2 = _row_key(docs, seed)
    keyed = docs.withColumns({names[0]: k1, names[1]: k2})
    columns = [quoted(c) for c in docs.columns]
    out = spare("copy", docs.columns)
    one = F.lit(1).cast("long")
    single = keyed.join(times.filter(F.col(names[2]) == 1), names[:2]).select(*columns, F.explode(F.sequence(one, F.col(names[3]))).alias(out))
    again = times.filter(F.col(names[2]) > 1)
    if again.isEmpty():
        return single
    part = 10_000
    alike = keyed.join(again, names[:2]).groupBy(*names[:2]).agg(F.first(F.struct(*columns)).alias(names[4]), F.first(names[3]).alias(names[3]))
    starts = alike.select(*names[:2], names[4], names[3], F.explode(F.sequence(one, F.col(names[3]), F.lit(part).cast("long"))).alias(names[2])).repartition(*names[:3])
    copies = F.explode(F.sequence(F.col(names[2]), F.least(F.col(names[2]) + part - 1, F.col(names[3]))))
    return single.unionByName(starts.select(F.col(names[4]), copies.alias(names[2])).select(f"{names[4]}.*", F.col(names[2]).alias(out)))
