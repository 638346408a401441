"""Spelling variants: words of a corpus that differ by one edit, and the more frequent form that each belongs to.

Reduced-alphabet generation: letters are hashed to a few symbols, each reduced word's full one-edit neighbourhood is
generated and met with the reduced vocabulary, and pairs of words behind reduced words that meet are verified on the
originals.  A replaced letter may keep its symbol, so a reduced word is its own neighbour too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.llm.common import BROADCAST_ROWS, LOWER, UPPER, cut, mix64

#: Maximal runs of letters, and of all else from U+00C0 to U+00FF, in texts with A-Z lower-cased.
RUN = "[a-zÀ-ÿ]+"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def words_of(docs: DataFrame, noise: int = 97) -> DataFrame:
    """(word, n) of all words of docs (doc_id, text), n being how often they come.

    Words are runs with A-Z lower-cased.  Where the unsigned crc32 h of doc_id:word is divided by noise, the word has lost its
    code point h % length, as a slip of the pen would take it; a word of one letter so becomes empty.  A null doc_id counts as
    empty there, a null text has no words.  Counts are added up in each task before they cross the network.
    """
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))
    rows = docs.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % noise == 0, shorter).otherwise(F.col("run")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def reduce_words(words: list[str], symbols: int) -> np.ndarray:
    """The symbols, 0 to symbols - 1, of the letters of words of one length: a row for each word."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    return (mix64(letters * _BASE) % np.uint64(symbols)).reshape(len(words), -1)


def _polynomials(reduced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and the polynomial of each word's first letters, from none to all."""
    rows, n = reduced.shape
    powers = np.ones(n + 2, dtype=np.uint64)
    powers[1:] = np.multiply.accumulate(np.full(n + 1, _BASE))
    before = np.zeros((rows, n + 1), dtype=np.uint64)
    np.cumsum((reduced + np.uint64(1)) * powers[:n], axis=1, out=before[:, 1:])
    return powers, before


def _hash(polynomials: np.ndarray, length: int) -> np.ndarray:
    return mix64(polynomials ^ np.uint64(length)).view(np.int64)


def keys_of(reduced: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each reduced word."""
    return _hash(_polynomials(reduced)[1][:, -1].copy(), reduced.shape[1])


def neighbourhoods(reduced: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of each reduced word and of all that one edit makes of it, ascending, a row for each word; they may repeat.

    A hash is of a polynomial over the symbols, so that each neighbour's comes from those of the parts before and after
    the edit, in time that does not grow with the word's length.
    """
    rows, n = reduced.shape
    powers, before = _polynomials(reduced)
    after = before[:, -1:] - before  # of the letters from i on, at their own places
    own = np.arange(1, symbols + 1, dtype=np.uint64)[:, None, None]
    deleted = before[:, :-1] + after[:, 1:] * _INVERSE
    replaced = before[:, :-1] + after[:, 1:] + own * powers[:n]
    inserted = before + after * _BASE + own * powers[: n + 1]
    flat = lambda x: x.transpose(1, 0, 2).reshape(rows, -1)
    parts = [(before[:, -1:], n), (deleted, max(n - 1, 0)), (flat(replaced), n), (flat(inserted), n + 1)]
    return np.sort(np.concatenate([_hash(np.ascontiguousarray(x), size) for x, size in parts], axis=1), axis=1)


def _by_length(words: list[str], symbols: int, most: int = 1 << 21):
    """Places of words of one length, a few MB of neighbours at a time."""
    places: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(len(w), []).append(i)
    for n, at in places.items():
        step = max(1, most // ((2 * n + 2) * symbols))
        yield from (at[k : k + step] for k in range(0, len(at), step))


def _keyed(words: DataFrame, symbols: int) -> DataFrame:
    """words (word, n) with key, the hash of the reduced word."""

    def work(batches):
        for b in batches:
            words = b.column("word").to_pylist()
            keys = np.zeros(len(words), dtype=np.int64)
            for at in _by_length(words, symbols):
                keys[at] = keys_of(reduce_words([words[i] for i in at], symbols))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys)], [*b.schema.names, "key"])

    return words.select("word", "n").mapInArrow(work, "word string, n long, key long")


def _neighbours(reduced: DataFrame, symbols: int) -> DataFrame:
    """(key, near_key) of each row of reduced (key, word, alone): what its neighbourhood has, itself only if it is not alone."""

    def work(batches):
        for b in batches:
            words = b.column("word").to_pylist()
            key, alone = b.column("key").to_numpy(), b.column("alone").to_numpy(zero_copy_only=False)
            for at in _by_length(words, symbols):
                near = neighbourhoods(reduce_words([words[i] for i in at], symbols), symbols)
                keep = np.ones(near.shape, dtype=bool)
                keep[:, 1:] = near[:, 1:] != near[:, :-1]
                keep &= (near != key[at][:, None]) | ~alone[at][:, None]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(key[at], keep.sum(axis=1))), pa.array(near[keep])], ["key", "near_key"])

    return reduced.mapInArrow(work, "key long, near_key long")


#: Up to so many reduced words, 8 bytes each, are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 2_000_000


def _sized(few: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table as the right side of a join: broadcast if it is small enough, else shuffled."""
    return few.hint("broadcast" if few.count() <= most else "shuffle_hash")


def near_words(words: DataFrame, symbols: int = 8) -> DataFrame:
    """(word, n, other, other_n): each ordered pair of distinct words of words (word, n) that one edit turns into each other.

    An edit inserts, deletes or replaces one code point.  With 8 symbols a word of L letters has about 16 L neighbours, and
    words of 8 letters fall into 17 million reduced ones; fewer symbols make fewer neighbours and more pairs to verify.
    Neighbours are made from one word of each reduced word and meet the reduced vocabulary at once, as hashes; only those that
    are in it go on, to the words behind them.
    """
    plain = cut(_keyed(words, symbols), "keyed")
    reduced = plain.groupBy("key").agg(F.min("word").alias("word"), (F.count(F.lit(1)) == 1).alias("alone"))
    reduced = cut(reduced, "reduced")
    tasks = max(1, min(10_000, reduced.count() // 10_000))
    known = _sized(reduced.select(F.col("key").alias("near_key")), BROADCAST_KEYS)
    met = cut(_neighbours(reduced.repartition(tasks), symbols).join(known, "near_key"), "met")
    others = plain.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("key").alias("near_key"))
    pairs = met.join(plain, "key").join(others, "near_key").filter("word != other")
    return pairs.filter(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: forms (word, form) followed to the last.  Forms must not go in circles.

    Each round doubles how many forms are followed; words that have arrived take no further part.  A form has at least
    twice the word's count, so that 63 steps, or 7 rounds, are the most.
    """
    forms = cut(forms, "forms")
    done, going = None, forms.select("word", F.col("form").alias("root"))
    jump = forms
    while True:
        step = going.join(_sized(jump.select(F.col("word").alias("root"), F.col("form").alias("further"))), "root", "left")
        step = cut(step, "roots")
        here = step.filter("further IS NULL").select("word", "root")
        done = here if done is None else done.unionByName(here)
        going = step.filter("further IS NOT NULL").select("word", F.col("further").alias("root"))
        if going.isEmpty():
            return done
        twice = jump.select("word", F.col("form").alias("via")).join(_sized(jump.select(F.col("word").alias("via"), F.col("form").alias("further"))), "via", "left")
        jump = cut(twice.select("word", F.coalesce("further", "via").alias("form")), "jumps")


def group_variants(docs: DataFrame, least_letters: int = 5, least_n: int = 3, factor: int = 2, noise: int = 97, symbols: int = 8) -> DataFrame:
    """(word, n, n_near, form, form_n, root): the words of docs (doc_id, text) with at least so many letters and occurrences.

    n_near counts the words that one edit leads to.  form is the most frequent of these (of ties the smallest in the order
    of code points) if it comes at least factor times as often as the word, else null; root follows forms to the last and
    is the word itself where there is none.  Words are as words_of gives them, so null and empty texts add none, repeated
    rows count as often as they come, and an empty table gives an empty result.  A word of any length has its
    whole neighbourhood generated and is verified whole.
    """
    words = words_of(docs, noise).filter((F.length("word") >= least_letters) & (F.col("n") >= least_n))
    words = cut(words, "words")
    pairs = near_words(words, symbols)
    best = F.min(F.struct((-F.col("other_n")).alias("fewer"), F.col("other").alias("form"))).alias("best")
    near = pairs.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best)
    form_n = -F.col("best.fewer")
    enough = form_n >= factor * F.col("n")
    near = cut(near.select("word", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, form_n).alias("form_n")), "near-words")
    last = roots(near.filter("form IS NOT NULL").select("word", "form"))
    out = words.join(near, "word", "left").join(last, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
