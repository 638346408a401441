"""Secret scans, cross-tokenizer alignment and spelling variants against plain versions."""

import base64
import hashlib
import itertools
import random
import re
import string
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetra.llm import queries, secretscan, tokenalign, variants, vocab

SHAPE = "doc_id long, text string, kind string, n long, found string"


def docs(spark, texts, parts=3):
    """Rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in texts], SHAPE).repartition(parts)


def documents(spark, tmp_path, texts):
    docs(spark, texts).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# 11 secret scans


def plain_secrets(text):
    """The base spans, each pattern run over the whole text as it is stated."""
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join([either("password"), either("passwd"), either("secret"), either("token"), either("api") + "_?" + either("key")])
    kinds = {"assign": (f"({words})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6), "access": ("AKIA[A-Z0-9]+", 20), "hex": ("[0-9a-f]+", 24)}
    out = []
    for k, (kind, (pattern, least)) in enumerate(kinds.items()):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[2] if kind == "assign" else m[0]) >= least]
    return [x for _, _, x in sorted(out)]


def test_base_secrets_are_those_of_the_patterns(spark, tmp_path):
    rng = random.Random(11)
    pieces = ["password", "PassWD", "ſecret", "secret", "toKen", "TOKEN", "api_key", "apikey", "API_KEY", " ", "  ", ":", "=", '"', "'", "\n", "é", "😀", "AKIA", "ABCDEF0123456789", "0123456789abcdef", "abcde", "f", "Z9", ".", "-", "/", "+", "="]
    texts = [None, "", " ", "token=" + "a" * 100_000, "é" * 50 + "deadbeef" * 4_000, "secret" + " " * 30_000, "secret: token=abcdef", "password=token:abcdef"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "secret=abcdef"), (3, "again")]
    got = queries.op11_secrets(spark, documents(spark, tmp_path, rows)).collect()
    want = Counter()
    for i, t in rows:
        base = plain_secrets(t or "")
        want[i, *(sum(x.startswith(k) for x in base) for k in ("assign:", "access:", "hex:")), hashlib.sha256(",".join(base).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    for r in got:  # the method adds spans in between; none of the base is lost or touched
        spans = [x for x in r.spans.split(",") if x]
        assert hashlib.sha256(",".join(x for x in spans if not x.startswith("random")).encode()).hexdigest() == r.base_sha256
        places = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in spans)]
        assert [s for _, s, _ in places] == sorted(s for _, s, _ in places)
        added = [p for p in places if p[0] == "random"]
        assert not any(a[1] < p[2] and p[1] < a[2] for a in added for p in places if p != a)


ENCODE = vocab.rank_encoding(Path(vocab.place("byte_bpe_50k.tiktoken")).read_bytes()).encode_ordinary


def added(text):
    return [text[s:e] for k, s, e, _ in secretscan.find_spans(text.encode(), ENCODE) if k == "random"]


def test_random_strings_are_found_and_names_are_not():
    rng = random.Random(1)
    letters = string.ascii_letters + string.digits
    found = 0
    for i in range(500):
        key = "".join(rng.choice(letters) for _ in range(rng.choice([24, 32, 40])))
        found += added(f"é for {key}, in {i}") == [key]
    assert found >= 495
    padded = base64.b64encode(bytes(range(200, 225))).decode()
    assert added(f"sig={padded}&x") == [padded] and added("(x9Kq2LmZ7pRt4VbN8cYw).") == ["x9Kq2LmZ7pRt4VbN8cYw"]
    for clean in (
        "Donaudampfschifffahrtsgesellschaft thtionintionreonststsh getHTTPResponseCodeFromServer2 my_long_variable_name_12 THE_LONGEST_CONSTANT_OF_ALL",
        "org.apache.spark.sql.catalyst.expressions src/main/java/com/example/Foo.java 2024-01-02-03.04.05 192.168.100.200-255.255.255.255 v10.20.30-alpha-release",
        "550e8400-e29b-41d4-a716-446655440000 D41D8CD98F00B204E9800998ECF8427E sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=",
        "https://example.com/Zx8kQw0pLr7TnVb2YcD4 x9Kq2LmZ7pRt4VbN8cYw@example.com me@x9Kq2LmZ7pRt4VbN8cYw ................................ ----====____~~~~",
        "", "a" * 5000, "ab1 " * 2000,
    ):
        assert added(clean) == [], clean[:40]


def test_scan_gives_texts_and_ratios(spark):
    text = "é secret=abcdef x9Kq2LmZ7pRt4VbN8cYw"
    row = secretscan.scan(docs(spark, [(1, text)])).first()
    assert [(x.kind, x.text) for x in row.found] == [("assign", "secret=abcdef"), ("random", "x9Kq2LmZ7pRt4VbN8cYw")]
    assert row.found[0].chars_per_token is None and row.found[1].chars_per_token == 20 / len(ENCODE("x9Kq2LmZ7pRt4VbN8cYw"))
    assert secretscan.scan(docs(spark, [(1, text)]), most_ratio=0.5).first().found[1:] == []
    assert secretscan.scan(spark.createDataFrame([], SHAPE)).count() == 0


# 12 cross-tokenizer alignment


def ascending(rng, n, end):
    return np.unique(np.append(rng.integers(1, end, n), end)) if n else np.zeros(0, dtype=np.int64)


def test_gallop_and_align_against_every_pair():
    rng = np.random.default_rng(12)
    assert tokenalign.gallop(np.array([5]), np.zeros(0, dtype=np.int64)).tolist() == [0]
    for _ in range(1500):
        end = int(rng.choice([3, 20, 400]))
        a, b = ascending(rng, int(rng.integers(1, 60)), end), ascending(rng, int(rng.integers(1, 60)), end)
        assert tokenalign.gallop(a[:-1], b).tolist() == np.searchsorted(b, a[:-1]).tolist()
        got = tokenalign.align(a, b)
        starts = [np.concatenate([[0], x[:-1]]) for x in (a, b)]
        pairs = {(i, j) for i in range(a.size) for j in range(b.size) if starts[0][i] < b[j] and starts[1][j] < a[i]}
        assert sorted(zip(got.a.tolist(), got.b.tolist(), strict=True)) == sorted(pairs)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[got.a_ends - 1].tolist() == common == b[got.b_ends - 1].tolist()


@pytest.fixture(scope="module")
def both():
    return tokenalign.Tokenizers(*(Path(vocab.place(n)).read_bytes() for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def plain_alignments(both, texts):
    """Each text's counts and groups byte by byte, then counts of id pairs over all links of all texts."""
    out, links_of = [], []
    for text in texts:
        a = b = []
        if text:
            a = both.a.encode(" " + text, add_special_tokens=False).ids
            b = both.b.encode(text)
            if b"".join(both.a_bytes[i] for i in a) != (" " + text).encode() or b"".join(both.b_bytes[i] for i in b) != (" " + text).encode():
                a = b = []
        owner = [[k for k, i in enumerate(ids) for _ in table[i]] for ids, table in ((a, both.a_bytes), (b, both.b_bytes))]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(*owner, strict=True)))]
        groups, mine = [], ([], [])
        for k, (i, j) in enumerate(zip(*owner, strict=True)):
            for side, n in zip(mine, (i, j), strict=True):
                if n not in side:
                    side.append(n)
            last = k + 1 == len(owner[0])
            if last or owner[0][k + 1] != i and owner[1][k + 1] != j:
                groups.append(",".join(str(a[x]) for x in mine[0]) + "|" + ",".join(str(b[x]) for x in mine[1]))
                mine = ([], [])
        out.append([len(a), len(b), len(groups), len(links), ";".join(groups)])
        links_of.append(links)
    count = Counter(itertools.chain(*links_of))
    most: dict = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return [(*x, sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links)) for x, links in zip(out, links_of, strict=True)]


def test_alignment_against_bytes(spark, tmp_path, both):
    rng = random.Random(12)
    pieces = ["the ", "anti", "disestablish", "ment", "é", "ção", "😀", "日本", "\n", "  ", "\t", "<|endoftext|>", "<s>", "<0x41>", "1234", "'s", "\x00", "…", " of", "ﬁ", "é"]
    texts = [None, "", " ", "\n", "a", "▁", "x▁y", "a" * 3000, "the same", "the same", "the same"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(150)]
    want = plain_alignments(both, texts)
    assert sum(w[0] == 0 for w in want) < 10 and len({w[4] for w in want}) > 100
    rows = list(enumerate(texts))
    for parts in (1, 7):
        got = {r.doc_id: tuple(r)[1:] for r in tokenalign.align_vocabularies(docs(spark, rows, parts)).collect()}
        assert [got[i] for i in range(len(texts))] == want
    kept = {r.doc_id: r for r in queries.op12_alignment(spark, documents(spark, tmp_path, rows)).collect()}
    assert all(kept[i].groups_sha256 == (hashlib.sha256(w[4].encode()).hexdigest() if w[4] else "") for i, w in enumerate(want))
    assert [(kept[i].n_a, kept[i].n_links, kept[i].n_best, kept[i].count_sum) for i in range(len(texts))] == [(w[0], w[3], w[5], w[6]) for w in want]


def test_pieces_give_what_whole_texts_give(both):
    """Cut at single spaces or not, both tokenizers give the same ids."""
    rng = random.Random(14)
    pieces = ["the", "don't", "x'll", "é", "Ünïcode", "×", "日本", "▁", "a▁", "12", "3.5", "...", "\n", "\t", "\u00a0", "\u2003", "\u3000", "\x00", "\x1f", "\x85", "<s>", "ʼn", "e\u0301", "\u0301", "😀", " ", "  "]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    assert both.cuts and sum(len(tokenalign.cut_pieces(t)) > 2 for t in texts) > 500
    for text, got in zip(texts, both.encode(texts), strict=True):
        each = both.encode(tokenalign.cut_pieces(text))
        want = None if None in each else tuple([i for x in each for i in x[side]] for side in (0, 1))
        assert got == want, text
        assert " ".join(tokenalign.cut_pieces(text)) == text


def test_alignment_judges_rows_and_hot_pairs(spark, monkeypatch):
    rows = [(None, "the cat"), (None, "the cat"), (5, "the cat sat"), (5, None)]
    got = sorted(tuple(r) for r in tokenalign.align_vocabularies(docs(spark, rows)).fillna({"doc_id": -1}).select("doc_id", "n_links", "n_best", "count_sum").collect())
    assert got == [(-1, 2, 2, 6), (-1, 2, 2, 6), (5, 0, 0, 0), (5, 3, 3, 7)]
    assert tokenalign.align_vocabularies(spark.createDataFrame([], SHAPE)).count() == 0
    many = [(i, f"the cat number {i} sat") for i in range(3000)]
    hot = tokenalign.align_vocabularies(docs(spark, many))  # pairs of each row pass the bound and are broadcast
    texts = [t for _, t in many]
    made = tokenalign.Tokenizers(*(Path(vocab.place(n)).read_bytes() for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    want = plain_alignments(made, texts)
    assert {r.doc_id: (r.n_best, r.count_sum) for r in hot.collect()} == {i: w[5:] for i, w in enumerate(want)}


def test_a_piece_is_aligned_once_and_what_is_forgotten_is_learnt_again(monkeypatch):
    made = [tokenalign.Tokenizers(*(Path(vocab.place(n)).read_bytes() for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))) for _ in range(2)]
    aligned, align = [], tokenalign.align
    monkeypatch.setattr(tokenalign, "align", lambda a, *more: aligned.append(a.size) or align(a, *more))
    made[0].describe(["the cat sat on the mat"] * 50)
    assert sum(aligned) == 5
    # one of them keeps next to nothing from call to call
    rng = random.Random(15)
    made[1].REMEMBERED, made[1].WEIGHT, made[1].LONG = 20, 100, 12
    for _ in range(60):
        texts = [" ".join(rng.choice(["the", "cat", "▁", "日本", "é", "x" * rng.randint(1, 40), str(rng.randint(0, 99)), ""]) for _ in range(rng.randint(0, 9))) for _ in range(8)]
        want, got = ([(*x[:5], x[5].tolist(), x[6].tolist()) for x in m.describe(texts)] for m in made)
        assert got == want
        assert [x[:5] for x in got] == [tuple(x[:5]) for x in plain_alignments(made[0], texts)]
    assert len(made[1].known) < len(made[0].known) and made[1].describe([]) == [] and len(made[1].known) <= 10
    # what a failed call has numbered does not stay
    with pytest.raises((TypeError, UnicodeEncodeError)):
        made[0].describe(["quite new", "\ud800"])
    assert [x[:5] for x in made[0].describe(["other words", "quite new"])] == [tuple(x[:5]) for x in plain_alignments(made[0], ["other words", "quite new"])]


# 13 spelling variants


def plain_words(rows, noise=97):
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return words


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def plain_variants(words, least_letters=5, least_n=3):
    n = {w: k for w, k in words.items() if len(w) >= least_letters and k >= least_n}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], form[w] and n[form[w]], root)
    return out


def test_variants_against_every_pair(spark):
    rng = random.Random(13)
    rows = [(None, None), (0, ""), (1, "123 -- …"), (None, "Éclair éclair ÉCLAIR " * 3), (2, "x×y÷zabc ÿÿÿÿÿ " * 3), (3, "a" * 6000 + " " + "a" * 6001 + " ") , (4, ("a" * 6000 + " " + "a" * 6001 + " ") * 3)]
    base = ["".join(rng.choice("abçdeé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    for i in range(5, 400):
        words = []
        for _ in range(rng.randint(1, 40)):
            w = rng.choice(base[: rng.choice([3, 15, 60])])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + "e" + w[at:], w[:at] + "b" + w[at + 1 :]])
            words.append(rng.choice([w, w.upper(), w.title()]))
        rows.append((i, " ".join(words)))
    want = plain_variants(plain_words(rows))
    assert sum(w[2] is not None for w in want.values()) > 100 and any(want[w[2]][2] for w in want.values() if w[2])
    for symbols, parts in ((8, 3), (2, 1), (16, 40)):
        got = variants.group_variants(docs(spark, rows, parts), symbols=symbols).collect()
        assert {r.word: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    assert variants.group_variants(spark.createDataFrame([], SHAPE)).count() == 0


def test_neighbourhoods_are_all_that_one_edit_makes():
    rng = np.random.default_rng(13)
    for n in (1, 2, 5, 9):
        for _ in range(20):
            word = rng.integers(0, 4, n).astype(np.uint64)
            made = {tuple(word.tolist())}
            for i in range(n + 1):
                made |= {(*word[:i].tolist(), s, *word[i:].tolist()) for s in range(4)}
                made |= {(*word[:i].tolist(), s, *word[i + 1 :].tolist()) for s in range(4) if i < n} | ({(*word[:i].tolist(), *word[i + 1 :].tolist())} if i < n else set())
            near = set(variants.neighbourhoods(word[None, :], 4)[0].tolist())
            assert near == {int(variants.keys_of(np.array([x], dtype=np.uint64))[0]) for x in made} and int(variants.keys_of(word[None, :])[0]) in near


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(50)] + [(f"v{i}", "w049") for i in range(30)] + [("lone", "end")]
    got = {r.word: r.root for r in variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {f"w{i:03}": "w050" for i in range(50)} | {f"v{i}": "w050" for i in range(30)} | {"lone": "end"}
    assert variants.roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_noise_takes_a_letter(spark):
    rows = [(i, "wörter Wörter") for i in range(300)]
    got = {r.word: r.n for r in variants.words_of(docs(spark, rows), noise=7).collect()}
    assert got == dict(plain_words(rows, 7)) and len(got) > 3
    assert variants.words_of(docs(spark, rows).filter(F.lit(False))).count() == 0
