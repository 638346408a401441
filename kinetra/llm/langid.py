"""Language identification by unigram piece models with all segmentations summed.

Each language has a probability for every piece of a fixed public vocabulary.  A word's probability is the sum over
all ways to cut it into pieces, found by the forward algorithm; a text's is the product over its words.  The
probabilities are fitted by expectation maximisation, where the expected use of a piece comes from
the forward and backward sums.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.llm.common import columns, cut, quoted, spare

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: What the vocabulary puts at the start of a word.
SPACE = "▁"
#: Runs of letters.
_WORD = re.compile(r"[^\W\d_]+")
#: Words up to this length are summed many at a time, longer ones letter by letter in memory linear in their length.
_SHORT = 40


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's distinct lower-cased pieces of letters, which may start with the word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    return sorted(p for p in plain if p.lstrip(SPACE).isalpha() or p == SPACE)


class PieceTable:
    """Ids of pieces by a 64-bit hash of their letters, looked up for whole arrays of hashes.

    A slot holds one piece; pieces that find theirs taken go on to the next level, which has slots of its own.
    """

    BASE, BITS = np.uint64(0x9E3779B97F4A7C15), 18
    #: A fixed odd multiplier for each level.
    MIX = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))

    def __init__(self, ids: dict[str, int]):
        values = np.array([self.prefixes(np.array([[ord(c) for c in p]], dtype=np.uint32))[0, -1] for p in ids], dtype=np.uint64)
        numbers = np.array(list(ids.values()), dtype=np.int32)
        if np.unique(values).size != values.size:
            raise ValueError("two pieces have one hash")
        self.levels = []
        for mix in self.MIX:
            keys, held = np.zeros(1 << self.BITS, dtype=np.uint64), np.zeros(1 << self.BITS, dtype=np.int32)
            slots, first = np.unique(self._slot(values, mix), return_index=True)
            keys[slots], held[slots] = values[first], numbers[first]
            self.levels.append((mix, keys, held))
            values, numbers = np.delete(values, first), np.delete(numbers, first)
        self.more = dict(zip(values.tolist(), numbers.tolist(), strict=True))

    @classmethod
    def prefixes(cls, letters: np.ndarray) -> np.ndarray:
        """Hashes of all starts of words of one length, given as rows of code points; that of none is 0."""
        out = np.zeros((letters.shape[0], letters.shape[1] + 1), dtype=np.uint64)
        for j in range(letters.shape[1]):
            out[:, j + 1] = out[:, j] * cls.BASE + letters[:, j].astype(np.uint64) + np.uint64(1)
        return out

    def _slot(self, values: np.ndarray, mix: np.uint64) -> np.ndarray:
        return ((values * mix) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The id of each hash, 0 for those of no piece."""
        out = np.zeros(values.size, dtype=np.int32)
        todo = np.arange(values.size)
        for mix, keys, held in self.levels:
            slot = self._slot(values[todo], mix)
            there = keys[slot]
            hit = there == values[todo]
            out[todo[hit]] = held[slot[hit]]
            todo = todo[~hit & (there != 0)]  # behind an empty slot there is no further level
            if not todo.size:
                return out
        for i in todo.tolist():
            out[i] = self.more.get(int(values[i]), 0)
        return out


class Lattice:
    """Forward and backward sums over all segmentations, for many words at once.

    probabilities: one row for each piece and one column for each language; row 0 is no piece, row 1 stands for
    any single character that isn't one.
    """

    def __init__(self, pieces: list[str]):
        self.ids = {p: i + 2 for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.size = len(pieces) + 2
        self.table = PieceTable(self.ids)

    def spans(self, length: int) -> list[tuple[int, int]]:
        return [(i, j) for j in range(1, length + 1) for i in range(max(0, j - self.longest), j)]

    def look_up(self, words: list[str]) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Spans of words of one length, and the piece in each of them: a row for each span."""
        n = len(words[0])
        starts = PieceTable.prefixes(np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(words), n)).T
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, PieceTable.BASE)]))
        spans = self.spans(n)
        first, last = (np.array(x) for x in zip(*spans, strict=True))
        hashes = starts[last] - starts[first] * powers[last - first][:, None]
        ids = self.table.find(hashes.ravel()).reshape(hashes.shape)
        alone = ids[last - first == 1]
        ids[last - first == 1] = np.where(alone == 0, 1, alone)
        return spans, ids

    def forward(self, length: int, spans, ids: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Logarithm of the sum over all segmentations up to each position."""
        sums = np.zeros((length + 1, ids.shape[1], p.shape[1]))
        scale = np.zeros((length + 1, 1, 1))
        sums[0] = 1
        for k, (i, j) in enumerate(spans):
            part = sums[i] * p[ids[k]]
            sums[j] += part * np.exp(scale[i] - scale[j - 1]) if scale[j - 1, 0, 0] != scale[i, 0, 0] else part
            if i == j - 1:
                scale[j] = scale[j - 1]
                least = sums[j].min()
                if least < 1e-200:  # one scale for all words keeps numbers of short ones as they are
                    top = sums[j].max()
                    sums[j] /= top
                    scale[j] += np.log(top)
        return np.log(sums) + scale

    def walk(self, word: str, p: np.ndarray):
        """Forward sums, as logarithms, of one word of any length, position by position; and the pieces that end there."""
        get, n = self.ids.get, len(word)
        logs = np.full((n + 1, p.shape[1]), -np.inf)
        logs[0] = 0
        ends = []
        for j in range(1, n + 1):
            found = [(i, get(word[i:j], 1 if j == i + 1 else 0)) for i in range(max(0, j - self.longest), j)]
            at, ids = (np.array(x) for x in zip(*[f for f in found if f[1]], strict=True))
            logs[j] = np.log((p[ids] * np.exp(logs[at] - logs[j - 1])).sum(axis=0)) + logs[j - 1]
            ends.append((at, ids))
        return logs, ends

    def log_likelihood(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """log P(word) for each word and language."""
        out = np.zeros((len(words), p.shape[1]))
        for at, group in _by_length(words):
            if len(group[0]) > _SHORT:
                out[at] = [self.walk(w, p)[0][-1] for w in group]
            else:
                spans, ids = self.look_up(group)
                out[at] = self.forward(len(group[0]), spans, ids, p)[-1]
        return out

    def expected(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words that occur counts times, for each language."""
        total = np.zeros_like(p)
        with np.errstate(divide="ignore"):
            logs = np.log(p)
        for at, group in _by_length(words):
            n = len(group[0])
            if n > _SHORT:
                for w, weight in zip(group, counts[at], strict=True):
                    self._expected_long(w, weight, p, logs, total)
                continue
            spans, ids = self.look_up(group)
            front = self.forward(n, spans, ids, p)
            back = np.full((n + 1, len(group), p.shape[1]), -np.inf)
            back[n] = 0
            for k in range(len(spans) - 1, -1, -1):
                i, j = spans[k]
                back[i] = np.logaddexp(back[i], back[j] + logs[ids[k]])
            weight = counts[at]
            for k, (i, j) in enumerate(spans):
                used = weight * np.exp(front[i] + logs[ids[k]] + back[j] - front[n])
                for g in range(p.shape[1]):
                    total[:, g] += np.bincount(ids[k], weights=used[:, g], minlength=self.size)
        return total

    def _expected_long(self, word: str, weight: np.ndarray, p: np.ndarray, logs: np.ndarray, total: np.ndarray) -> None:
        front, ends = self.walk(word, p)
        back = np.full_like(front, -np.inf)
        back[-1] = 0
        for j in range(len(word), 0, -1):
            at, ids = ends[j - 1]
            step = back[j] + logs[ids]
            np.add.at(total, ids, weight * np.exp(front[at] + step - front[-1]))
            back[at] = np.logaddexp(back[at], step)


def _by_length(words: list[str], most: int = 2_000_000):
    """Places and words of one length each, so many that their spans fit into a bounded array."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for n, at in groups.items():
        step = max(1, most // (16 * n))
        for s in range(0, len(at), step):
            part = at[s : s + step]
            yield part, [words[i] for i in part]


def text_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    probabilities: np.ndarray
    #: Mean log-likelihood a letter of each language's own training words.
    usual: np.ndarray

    def scorer(self, remember: int = 200_000):
        """A function from texts to (language or und, posterior of it, its fit); remembers so many words at most.

        The fit is how far the text's log-likelihood a letter is above what is usual for the language, plus 4 for the
        root of the number of words, as few words vary: little, or below 0, for text of no learned language.
        """
        lattice, p = Lattice(self.pieces), self.probabilities
        index: dict[str, int] = {}
        store = {"m": np.zeros((1, len(self.languages)))}

        def add(words: list[str]) -> None:
            fresh = [w for w in dict.fromkeys(words) if w not in index]
            if len(index) + len(fresh) > remember:
                index.clear()
                store["m"] = np.zeros((1, len(self.languages)))
                fresh = list(dict.fromkeys(words))
            letters = [w for w in fresh if any(map(str.isalpha, w))]
            index.update(dict.fromkeys(fresh, 0))
            if letters:
                start = len(store["m"])
                index.update(zip(letters, range(start, start + len(letters)), strict=True))
                store["m"] = np.concatenate([store["m"], lattice.log_likelihood([SPACE + w for w in letters], p)])

        def score(texts: list[str]) -> list[tuple[str, float, float]]:
            out: list[tuple[str, float, float]] = []
            if not self.languages:
                return [("und", 0.0, 0.0)] * len(texts)
            for start in range(0, len(texts), 128):  # so that the words of few texts are held at a time
                part = [text_words(t) for t in texts[start : start + 128]]
                add([w for ws in part for w in ws])
                for ws in part:
                    at = np.array([index[w] for w in ws], dtype=np.int64)
                    if not at.size or not at.any():
                        out.append(("und", 0.0, 0.0))
                        continue
                    total = store["m"][at].sum(axis=0)
                    share = np.exp(total - total.max())
                    best = int(np.argmax(share))
                    fit = total[best] / sum(map(len, ws)) - self.usual[best] + 4 / len(ws) ** 0.5
                    out.append((self.languages[best], round(float(1 / share.sum()), 6), float(fit)))
            return out

        return score


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = 300, rounds: int = 3, path: str = VOCABULARY, smooth: float = 1e-7) -> LanguageModel:
    """Fit from text and lang of the labelled documents that are not held out; null ids don't teach.

    per_language is a documented bound of the training sample: for each language that many documents,
    whole, in the order of a hash of doc_id.  Words are counted by Spark, the expectations of each round are
    summed by Spark, and the driver holds languages x vocabulary numbers.
    """
    spark = docs.sparkSession
    pieces = load_pieces(path)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("doc_id", "lang")
    sample = cut(ids.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_language).select("doc_id", "lang").distinct(), "sample")

    def count(batches):
        for b in batches:
            texts = pd.Series([text_words(t) for t in b["text"]], dtype=object)
            yield pd.DataFrame({"lang": b["lang"], "word": texts}).explode("word").dropna().groupby(["lang", "word"], as_index=False).size().rename(columns={"size": "n"})

    rows = docs.select("doc_id", "lang", "text").join(sample, ["doc_id", "lang"]).select("lang", "text")
    words = rows.mapInPandas(count, "lang string, word string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    words = cut(words, "words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    lattice = Lattice(pieces)
    given = spark.sparkContext.broadcast((pieces, languages))

    def expect(p: np.ndarray | None) -> np.ndarray:
        now = spark.sparkContext.broadcast(p)

        def step(batches):
            own, langs = given.value
            table, column = Lattice(own), {g: i for i, g in enumerate(langs)}
            current = now.value
            total = np.zeros((table.size, len(langs)))
            for b in batches:
                wide = b.assign(g=b["lang"].map(column)).pivot_table(index="word", columns="g", values="n", aggfunc="sum", fill_value=0).reindex(columns=range(len(langs)), fill_value=0)
                marked, counts = [SPACE + w for w in wide.index], wide.to_numpy(dtype=float)
                if current is None:  # a first guess: every piece that occurs in a word is used once
                    for at, group in _by_length(marked):
                        if len(group[0]) > _SHORT:
                            for word, n in zip(group, counts[at], strict=True):
                                for _, ids in table.walk(word, np.ones((table.size, 1)))[1]:
                                    np.add.at(total, ids, n)
                            continue
                        _, found = table.look_up(group)
                        for g in range(len(langs)):
                            total[:, g] += np.bincount(found.ravel(), weights=np.tile(counts[at, g], found.shape[0]), minlength=table.size)
                else:
                    total += table.expected(marked, counts, current)
            at, g = np.nonzero(total)
            yield pd.DataFrame({"piece": at, "g": g, "used": total[at, g]})

        sums = words.mapInPandas(step, "piece long, g long, used double").groupBy("piece", "g").agg(F.sum("used").alias("used")).toPandas()
        out = np.zeros((lattice.size, len(languages)))
        out[sums["piece"].astype(int), sums["g"].astype(int)] = sums["used"]
        out[0] = 0
        out /= np.maximum(out.sum(axis=0), 1e-300)
        out = out * (1 - smooth * lattice.size) + smooth
        out[0] = 0
        return out

    p = None
    for _ in range(rounds + 1):
        p = expect(p)
    now = spark.sparkContext.broadcast(p)

    def weigh(batches):
        own, langs = given.value
        table, column = Lattice(own), {g: i for i, g in enumerate(langs)}
        for b in batches:
            g = b["lang"].map(column).to_numpy()
            logs = table.log_likelihood([SPACE + w for w in b["word"]], now.value)[np.arange(len(b)), g]
            yield pd.DataFrame({"g": g, "logs": logs * b["n"], "letters": b["word"].str.len() * b["n"]})

    sums = words.mapInPandas(weigh, "g long, logs double, letters long").groupBy("g").agg(F.sum("logs").alias("logs"), F.sum("letters").alias("letters")).collect()
    usual = np.zeros(len(languages))
    for r in sums:
        usual[r["g"]] = r["logs"] / r["letters"]
    return LanguageModel(languages, pieces, p, usual)


#: The scorer of the model this worker used last, with the words it remembers.
_LAST: dict = {}


def _scorer(model: LanguageModel):
    key = hashlib.sha256(model.probabilities.tobytes() + repr(model.languages).encode()).digest()
    if _LAST.get("key") != key:
        _LAST.update(key=key, score=model.scorer())
    return _LAST["score"]


def _scored(docs: DataFrame, model: LanguageModel | None, options: dict) -> tuple[DataFrame, str]:
    """docs with a struct (lang_pred, score, fit), and its name."""
    model = model or fit(docs, **options)
    given = docs.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.probabilities, model.usual))

    def predict(batches):
        score = _scorer(LanguageModel(*given.value))
        for texts in batches:
            yield pd.DataFrame(score([t or "" for t in texts]), columns=["lang_pred", "score", "fit"])

    found = F.pandas_udf(predict, "lang_pred string, score double, fit double", F.PandasUDFType.SCALAR_ITER)
    name = spare("language", docs.columns)
    return docs.withColumn(name, found("text")), name


def identify(docs: DataFrame, model: LanguageModel | None = None, **options) -> DataFrame:
    """docs (doc_id, text, ...) with columns lang_pred and score, of every whole text.

    und with score 0 for a null text, one without a letter, and any text if nothing was learnt; else the
    language with the largest posterior under equal priors, ties to the first by code point.  Where the
    input has columns of these names, the new ones get a _ in front.  Repeated rows are scored each, an empty table
    gives none.  A word of any length is summed over all its segmentations.
    """
    out, name = _scored(docs, model, options)
    return out.select(*columns(docs), *(F.col(f"{name}.{c}").alias(spare(c, docs.columns)) for c in ("lang_pred", "score")))


def reject(docs: DataFrame, least: float = 0.5, below: float = 3.0, model: LanguageModel | None = None, **options) -> DataFrame:
    """The documents with a recognised language; same columns.

    Those go that are und, whose posterior is under least, or whose log-likelihood a letter is more than below (plus
    4 over the root of the number of words) under what is usual for the language: the posterior alone says only
    which of the learned languages is nearest, and is near 1 for junk and for other languages too.
    """
    out, name = _scored(docs, model, options)
    good = (F.col(f"{name}.lang_pred") != "und") & (F.col(f"{name}.score") >= least) & (F.col(f"{name}.fit") >= -below)
    return out.filter(good).select(*map(quoted, docs.columns))
