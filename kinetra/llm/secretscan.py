"""Secret scans: patterns of known kinds, and strings that a tokenizer finds random.

A tokenizer's vocabulary holds what is frequent in text, so a random string takes many tokens for its length.  Runs of
characters that keys are made of are cut at inner equals signs; those that are no known digest and no identifier, and
get few characters a token, are reported beside what the patterns find.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.llm import vocab
from kinetra.llm.common import text_bytes

#: The kinds of spans, in the order that spans of one start are listed in.
KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: One of these is in every text that ASSIGN matches in, once A-Z are lower-cased.
_KEYWORDS = (b"passw", b"secret", b"token", b"api")

#: Characters that keys, and so runs, are made of; all matches of ACCESS and HEX lie inside one run.
_RUN = np.zeros(256, dtype=bool)
_RUN[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.=~-"]] = True
_PART = re.compile(r"[A-Za-z0-9+/_.~-]+=*")

#: Hexadecimal digits of the lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512, and their base64 form after a name.
_DIGEST = re.compile(r"(?:(?:md5|sha\d{1,3})[-_/.])?(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128})|(?:md5|sha\d{1,3})-[A-Za-z0-9+/]+=*")
_UUID = re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
#: Names of code, files, hosts and versions: words of three letters or more, or numbers, side by side or between separators.
_NAME = re.compile(
    r"[+/_.~-]*+(?:(?:[A-Z]?[a-z]{2,}+|[A-Z]{3,}+|[aAI])++\d{0,4}|v?\d++)"
    r"(?:[+/_.~-]++(?:(?:[A-Z]?[a-z]++|[A-Z]{2,}+)++\d{0,4}|v?\d++|[A-Za-z]))*+[+/_.~=-]*+"
)
_LETTERS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def is_known(part: str, before: str, after: str) -> bool:
    """Whether a run's part is a digest, a UUID, an address, or a name made of words and numbers."""
    if part.startswith("//") or before == "@" or after == "@" or before + part[:2] == "://":
        return True
    core = part.strip("._~-/+")
    return bool(_DIGEST.fullmatch(core) or _UUID.fullmatch(core) or _NAME.fullmatch(core) and not _LETTERS.fullmatch(core))


def random_parts(text: str, start: int, end: int, taken: list[tuple[int, int]], encode, least_chars: int, most_ratio: float, word_ratio: float) -> list[tuple]:
    """(start, end, characters a token) of the random strings in a run, without what overlaps spans taken before."""
    out = []
    for m in _PART.finditer(text, start, end):
        s, e = m.span()
        before, after = text[s - 1 : s] if s else "", text[e : e + 1]
        lead = len(m[0]) - len(m[0].lstrip("._~-/+="))
        kept = m[0].strip("._~-/+") if not m[0].endswith("=") else m[0].lstrip("._~-/+=")
        s, e = s + lead, s + lead + len(kept)
        if len(kept) < least_chars or any(a < e and s < b for a, b in taken) or is_known(m[0], before, after):
            continue
        ratio = len(kept) / len(encode(kept))
        if ratio <= (word_ratio if _LETTERS.fullmatch(kept) else most_ratio):
            out.append((s, e, ratio))
    return out


def _long_runs(raw: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Byte ranges of maximal runs of at least so many key characters."""
    inside = np.zeros(raw.size + 2, dtype=np.int8)
    inside[1:-1] = _RUN[raw]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def find_spans(data: bytes, encode, least_chars: int = 20, most_ratio: float = 2.0, word_ratio: float = 1.5) -> list[tuple]:
    """(kind, start, end, characters a token) of one text in UTF-8, by start and kind; places count code points."""
    lowered = data.lower()
    assigned = any(k in lowered for k in _KEYWORDS)
    raw = np.frombuffer(data, dtype=np.uint8)
    runs = _long_runs(raw, min(20, least_chars)) if data else []
    if not assigned and not runs:
        return []
    text = data.decode()
    if runs and len(text) != len(data):  # bytes to code points
        starts = np.cumsum((raw & 0xC0) != 0x80)
        runs = [(int(starts[s]) - 1, int(starts[e - 1])) for s, e in runs]
    out = [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if assigned else []
    for s, e in runs:
        out += [("access", *m.span(), None) for m in ACCESS.finditer(text, s, e) if m.end() - m.start() >= 20]
        out += [("hex", *m.span(), None) for m in HEX.finditer(text, s, e) if m.end() - m.start() >= 24]
    # Runs and what was found before are both in order: each run sees the spans that reach into it.
    taken, at = sorted((s, e) for _, s, e, _ in out), 0
    for s, e in runs:
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        near = []
        for a, b in taken[at:]:
            if a >= e:
                break
            near.append((a, b))
        out += [("random", *x) for x in random_parts(text, s, e, near, encode, least_chars, most_ratio, word_ratio)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("chars_per_token", pa.float64()), ("text", pa.string())])


def scan(docs: DataFrame, vocabulary: str | None = None, least_chars: int = 20, most_ratio: float = 2.0, word_ratio: float = 1.5) -> DataFrame:
    """(doc_id, found) of every row of docs (doc_id, text): found has the spans of secrets by start, then kind.

    Spans are those of the three patterns, which stay whatever else is found, and random: strings of least_chars or more
    that overlap none of the others and get at most most_ratio characters a token; of a single word of letters
    word_ratio, for rare words take many tokens too.  vocabulary is a tiktoken rank file.  Known digests, UUIDs,
    addresses, and names made of words and numbers are not random.
    A row is judged by itself in one pass over its whole text, without an exchange.  Null and empty texts have no spans,
    repeated rows and ids give a row each, a null id stays null, other columns are ignored.  A very long text is one row of
    one task; time grows with its length.
    """
    ranks = vocab.send(docs.sparkSession, vocabulary or vocab.place("byte_bpe_50k.tiktoken"))

    def find(batches):
        encode = vocab.rank_encoding(ranks.value).encode_ordinary
        for b in batches:
            found = []
            for data in b.column("data"):
                data = data.as_py()
                spans = find_spans(data, encode, least_chars, most_ratio, word_ratio)
                text = data.decode() if spans else ""
                found.append([{"kind": k, "start": s, "end": e, "chars_per_token": r, "text": text[s:e]} for k, s, e, r in spans])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.list_(_SPAN))], ["doc_id", "found"])

    kinds = "doc_id long, found array<struct<kind string, start long, end long, chars_per_token double, text string>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data")).mapInArrow(find, kinds)


def joined(spans):
    """Spans as kind:start:end, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
