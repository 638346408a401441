"""Operators against brute force, with nulls, empty and repeated rows, ties and columns of clashing names."""

import base64
import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinetra.llm import chat, decontam, html, jaccard, langid, licenses, linededup, media, mixing, warc
from kinetra.llm.common import NO_ID, gram_hashes, word_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def odd(spark):
    """Null and repeated ids, null, empty, blank and repeated texts."""
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(1, long, "en", "a", 1), (2, long, "en", None, 1), (2, long, "en", None, 1), (3, None, None, "a", None), (4, "", "en", "b", 0), (5, " \n\t", "en", "b", 3), (None, long + " end", "en", "c", 2), (None, None, None, None, None), (6, "One line of text\none LINE of text \nshort", "de", "c", 4)]
    return docs(spark, rows)


# 1 mixing


def reference_targets(sizes, weights, share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, budget, out = set(names), share * sum(sizes.values()), {}
    while open_:
        level = budget / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            budget -= out[s]
        open_ -= full
    return out


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), "en", str(rng.choice(["a", "b", "é", "Z"])), 0) for i in range(3000)] + [(9000 + i, "x y", "en", None, 0) for i in range(50)]
    got = [r.asDict() for r in mixing.mix(docs(spark, rows), slice_rows=64).collect()]
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    want = reference_targets(sizes, (3.0, 1.0, 2.0))
    assert len(got) == len(rows)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert own[0]["target"] == pytest.approx(want[s]) and own[0]["source_size"] == sizes[s]
        assert abs(sum(r["copies"] * r["size"] for r in own) - want[s]) <= 2
        assert all(0 <= r["copies"] <= 2 for r in own)
    again = mixing.mix(docs(spark, rows).repartition(7), slice_rows=64).select("doc_id", "copies").collect()
    assert sorted(map(tuple, again)) == sorted((r["doc_id"], r["copies"]) for r in got)


@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 3)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(0, 200))
@settings(max_examples=60, deadline=None)
def test_fit_budget_is_best(items, budget):
    lengths, counts = map(np.array, zip(*items, strict=True))
    take = mixing.fit_budget(lengths, counts, min(budget, int((lengths * counts).sum())))
    assert (take >= 0).all() and (take <= counts).all() and (take * lengths).sum() <= budget
    left = mixing._knapsack(lengths, counts, budget)
    sums = {0}
    for n, c in items:
        sums = {s + k * n for s in sums for k in range(c + 1)}
    assert (left * lengths).sum() == max(s for s in sums if s <= budget)


# 2 licenses


def test_license_spans(spark):
    mit = "Released under the MIT License"
    apache = licenses.TEMPLATES["Apache-2.0-header"]
    rows = [(1, f"Some text. {mit}. More.\n{mit.upper()}", "", "", 0), (2, apache.replace("express or implied", "express and implied").replace("governing", ""), "", "", 0), (3, None, "", "", 0), (4, "released under no license", "", "", 0)]
    got = licenses.scan(docs(spark, rows)).collect()
    assert [(r.doc_id, r.license, r.matched_words) for r in got if r.doc_id == 1] == [(1, "MIT", 5)] * 2
    assert all(rows[0][1][r.start_char : r.end_char].lower() == mit.lower() for r in got if r.doc_id == 1)
    (two,) = [r for r in got if r.doc_id == 2]
    assert two.license == "Apache-2.0-header" and two.matched_words == two.template_words - 2
    assert {r.doc_id for r in got} == {1, 2}


def plain_alignment(template, words):
    """Most matched words of an alignment of the whole template with a part of the words, by its score."""
    row = [(0, 0)] * (len(words) + 1)
    for t in template:
        new = [(row[0][0] - 1, row[0][1])]
        for j, w in enumerate(words):
            s, m = row[j]
            new.append(max((s + 2, m + 1) if w == t else (s - 1, m), (row[j + 1][0] - 1, row[j + 1][1]), (new[j][0] - 1, new[j][1])))
        row = new
    return max(row)[1]


def test_license_words_changed():
    found = tried = 0
    short = {"one": "copyleft", "three": "all rights reserved", "six": "see the file named license text"}
    for name, text in (licenses.TEMPLATES | short).items():
        index = licenses.Index({name: text}, 4, 4, 0.8)
        words = re.findall("[a-z0-9]+", text.lower())
        n = len(words)
        changes = [words[:i] + new + words[i + k :] for i in range(n) for new, k in ((["zzz"], 1), ([], 1), (["zzz"], 0))]
        few = n - next(m for m in range(n + 1) if m / n >= 0.8)
        if few > 1:  # as many words replaced as least allows, spread evenly
            spread = {round((i + 1) * n / (few + 1)) for i in range(few)}
            changes.append(["zzz" if i in spread else w for i, w in enumerate(words)])
        for change in changes:
            data = " ".join(["aaa", "bbb", "ccc", *change, "ddd", "eee", "fff"]).encode()
            best = plain_alignment(words, data.decode().split())
            got = [r[2] for r in licenses.find_licenses(data, index, 6, 0.8)]
            assert got == ([best] if best / n >= 0.8 else []), (name, change)
            tried, found = tried + 1, found + len(got)
    assert found > 0.9 * tried


# 3 pages


def test_main_text(spark):
    sure = "This is the text of an article that has the words which are the most frequent in it, and it is long enough to be sure of that. " * 2
    page = f"<html><head><title>T</title><script>if (a<b) '<p>no'</script></head><body><header>Site</header><nav><a href='/'>Home</a></nav><div class='cookie-notice'>We use cookies</div><article><h1>A &amp; B</h1><p>{sure}<p>Short &lt;one&gt;\n two<br>three</p><ul><li>x</ul><section class='comments'><p>{sure}</p></section></article><form>Name <input></form><aside>{sure}</aside><footer>&copy; us"
    want = "\n".join(["A & B", sure.strip(), "Short <one> two three", "x"])
    assert html.main_text(page) == want
    assert html.main_text(None) == html.main_text("") == html.main_text("<!--") == ""
    plain = f"<body><div><a href=a>One</a> <a href=b>Two</a></div><h2>Head</h2><p>{sure}</p><p>Tiny.</p><p>{sure}</p><div class=ad>Buy</div>"
    assert html.main_text(plain) == "\n".join(["Head", sure.strip(), "Tiny.", sure.strip()])
    got = html.extract(spark.createDataFrame([(1, "u", page), (2, None, None)], "page_id long, url string, html string")).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(1, want, len(want)), (2, "", 0)]


# 4 archives


def test_archive_round_trip(spark):
    rows = [(i, f"http://x/{i} \r\n", "same" if i % 3 == 0 else f"<p>é{i}</p>") for i in range(200)] + [(500, None, None), (501, "u", ""), (None, "u", "same"), (7, "u", "same"), (7, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages, shard_bytes=300, roll_bytes=600).collect()]
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        data, first = (h or "").encode(), top[h or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "response" if i == first else "revisit", None if i == first else first))
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(want, key=key)
    a, b = (warc.write_archive(pages.repartition(n), f"{spark.conf.get('spark.checkpoint.dir')}/w{n}", shard_bytes=300).orderBy("name").collect() for n in (1, 5))
    assert a == b and len(a) > 3


# 5 decontamination


def test_wu_manber_finds_all(spark):
    rng = np.random.default_rng(5)
    text = lambda n: " ".join(rng.choice(["a", "b", "c"], n))
    rows = [(i, text(int(rng.integers(0, 80))).replace(" ", " . ", 3).upper(), "", "", 0) for i in range(60)] + [(None, None, "", "", 0), (99, "b", "", "", 0)]
    bench = [(i, text(int(n))) for i, n in enumerate([4, 5, 5, 10, 11, 12, 6, 0])] + [(8, None), (9, "c"), (0, "b b a c")]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    want = []
    for i, t, *_ in rows:
        ws, hit, items = words(t), set(), set()
        for item, b in bench:
            bs = words(b)
            m = min(10, len(bs))
            for pattern in {tuple(bs[k : k + m]) for k in range(len(bs) - m + 1)} if m else ():
                for k in range(len(ws) - m + 1):
                    if tuple(ws[k : k + m]) == pattern:
                        hit |= set(range(k, k + m))
                        items.add(item)
        want.append((i, len(ws), len(hit), sorted(items)))
    for most in (1 << 20, 8):  # all tables at once, and in several passes
        found = decontam.find_items(docs(spark, rows), benchmark, most_bytes=most).select("doc_id", "n_words", decontam.hit_words().alias("n"), "hit_items").collect()
        assert sorted(map(str, want)) == sorted(str((r[0], r[1], r[2], list(r[3]))) for r in found)
    clash = docs(spark, rows).selectExpr("*", "doc_id AS n_words", "text AS hit_items")
    assert decontam.drop_contaminated(clash, benchmark).columns == clash.columns


# 6 lines


def brute_lines(rows):
    seen = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(" \t\n\r\x0b\x0c")
            key = re.sub("[A-Z]", lambda m: m[0].lower(), key)
            if len(key) >= 10:
                seen.setdefault(key, set()).add(NO_ID if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = []
        for line in lines:
            key = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\r\x0b\x0c"))
            ids = seen.get(key, set())
            if len(ids) < 2 or (NO_ID if i is None else i) == min(ids):
                keep.append(line)
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(map(str, out))


def test_line_dedup(spark):
    rng = np.random.default_rng(6)
    lines = [f"Line number {i}" for i in range(30)] + ["short", "", "  ÄÖÜ line éé  ", "line number 1"]
    rows = [(i % 70, "\n".join(rng.choice(lines, int(rng.integers(1, 9))))) for i in range(80)] + [(None, "line number 1\n"), (80, None), (81, "")]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert sorted(str(tuple(r)) for r in got) == brute_lines(rows)
    assert linededup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_index_is_reversible(spark):
    rows = [(i, "\n".join(f"a line of text {j}" for j in range(i % 4, i % 4 + 4))) for i in range(30)]
    frame = lambda part: linededup.line_pairs(spark.createDataFrame(part, "doc_id long, text string"))
    state = lambda x: sorted((bytes(r.key), r.refs, r.first) for r in x.refs.collect())
    kept = linededup.LineIndex(spark, shard_keys=3)
    kept.insert(frame(rows[:20]))
    before, hits = state(kept), sorted(map(tuple, kept.repeated_in(frame(rows[:20])).collect()))
    kept.insert(frame(rows[20:]))
    everything = linededup.LineIndex(spark, shard_keys=3)
    everything.insert(frame(rows))
    assert state(kept) == state(everything)
    assert sorted(map(tuple, kept.repeated_in(frame(rows)).collect())) == sorted(map(tuple, everything.repeated_in(frame(rows)).collect()))
    kept.delete(spark.createDataFrame([(i,) for i, _ in rows[20:]], "doc_id long"))
    assert state(kept) == before and sorted(map(tuple, kept.repeated_in(frame(rows[:20])).collect())) == hits


def test_cuckoo_filter():
    values = np.random.default_rng(1).integers(0, 1 << 62, 20000).astype(np.uint64)
    f = linededup.CuckooFilter.build(values[:15000])
    assert f.contains(values[:15000]).all() and f.contains(values[15000:]).mean() < 0.01
    f.delete(values[:5000])
    back = linededup.CuckooFilter.from_bytes(f.to_bytes())
    assert back.contains(values[5000:15000]).all() and back.contains(values[:5000]).mean() < 0.01


# 7 languages


def test_forward_sums_all_segmentations():
    lattice = langid.Lattice(["a", "b", "ab", "ba", "aba"])
    p = np.random.default_rng(0).random((lattice.size, 2))
    p[0] = 0

    def total(word):
        if not word:
            return np.ones(2)
        return sum(p[lattice.ids.get(word[:k], 1 if k == 1 else 0)] * total(word[k:]) for k in range(1, len(word) + 1))

    for word in ("a", "abab", "ababcba", "cc"):
        assert np.exp(lattice.log_likelihood([word], p)[0]) == pytest.approx(total(word))


def test_language_on_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(table.select("doc_id", "text", "lang"), per_language=60, rounds=2).withColumn("held", langid.held_out()).filter("held").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97
    few = langid.identify(odd(spark), per_language=5, rounds=1).select("text", "lang_pred", "score").collect()
    assert all((r.lang_pred == "und" and r.score == 0) == (not r.text or not r.text.strip()) for r in few)
    assert set(langid.identify(docs(spark, [(1, "text", None, "", 0)])).toPandas()["lang_pred"]) == {"und"}


# 8 media


def test_media_round_trip(spark):
    got = media.media_columns(media.store_media(odd(spark))).collect()
    assert len(got) == 9
    for data in (b"", b"abc", bytes(range(256)) * 30):
        payload = media.pad(data)
        assert len(payload) % 576 == 0 and len(payload) > 0 and payload.startswith(data) and set(payload[len(data) :]) <= {255}
        assert media.from_wav(media.to_wav(payload)) == payload
        assert (media.fingerprint(payload) == media.fingerprint(payload, block=3)).all()
    by_text = {}
    for r, source in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)), range(9), strict=True):
        by_text.setdefault(r.payload_sha256, set()).add(r.feature)
    assert all(len(v) == 1 for v in by_text.values())


# 9 near duplicates


def brute_components(rows, n=3, percent=90):
    def shingles(t):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), NO_ID), NO_ID if d is None else d)
    return sorted(str((d, len(sets[i]), None if least[root(i)] == NO_ID else least[root(i)])) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("block", [1024, 8])
def test_near_duplicates(spark, block):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = list(rng.choice(words, int(rng.integers(2, 90))))
        for _ in range(int(rng.integers(1, 30))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(len(copy)))] = str(rng.choice(words))
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    shared = " ".join(rng.choice(words, 60))
    rows += [(2000 + i, " ".join(rng.choice(words, 30)) + " " + shared) for i in range(20)]
    rows += [(None, shared), (None, None), (3000, ""), (3001, " "), (3002, "One two"), (3003, "one TWO"), (3004, rows[0][1])]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_components(rows)


@pytest.mark.parametrize("block", [4, 1024])
def test_jaccard_of_five_words(spark, block):
    """Copies about the threshold among texts that are mostly passages of others, dealt over many batches."""
    rng = np.random.default_rng(block)
    words = [f"w{i}" for i in range(400)]
    passages = [" ".join(rng.choice(words, 50)) for _ in range(4)]
    rows = []
    for family in range(25):
        own = list(rng.choice(words, int(rng.integers(5, 120))))
        for k in range(int(rng.integers(1, 8))):
            copy = list(own)
            for at in rng.integers(0, len(own), int(rng.integers(0, 3))):
                copy[at] = f"x{family}_{k}"
            rows.append((len(rows), " ".join(copy + [passages[family % 4]] * (family % 3 > 0) + [passages[(family + 1) % 4]] * (family % 3 > 1))))
    rows += [(1000 + i, f"{p} tail{i}") for i, p in enumerate(passages * 3)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(23)
    got = jaccard.near_duplicates(table, 5, 80, block).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_components(rows, 5, 80)


def linked_pairs(sets, percent):
    """For each pair whether links lead from one to the other, by comparing all sets."""
    reach = np.eye(len(sets), dtype=bool)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = np.intersect1d(a, b).size
            reach[i, j] |= both > 0 and 100 * both >= percent * (a.size + b.size - both)
    for k in range(len(sets)):
        reach |= np.outer(reach[:, k], reach[k])
    return reach.tolist()


@pytest.mark.parametrize("percent", [90, 80])
def test_link_block_of_unequal_sizes(percent):
    rng = np.random.default_rng(percent)
    families = []
    for size in (12, 40, 100):
        for _ in range(40):  # words inserted and deleted
            base = rng.integers(1, 1 << 62, size)
            copies = []
            for _ in range(int(rng.integers(3, 21))):
                gone, more = rng.integers(0, 2 + size * (100 - percent) // 150, 2)
                copies.append(np.unique(np.concatenate([rng.permutation(base)[gone:], rng.integers(1, 1 << 62, more)]).astype(np.uint64)))
            families.append(copies)
    for size in (20, 57, 100):  # pairs at the threshold and one shingle off it, beside sets that lengthen the lists
        base = np.sort(rng.integers(1, 1 << 62, size).astype(np.uint64))
        least = -(-size * percent // 100)
        for left in (least - 1, least, least + 1):
            families.append([base, base[:left], *(np.unique(np.concatenate([base[: size // 2], rng.integers(1, 1 << 62, k).astype(np.uint64)])) for k in (3, 70, 9))])
    for copies in families:
        links = jaccard.link_block(copies, percent)
        up = np.eye(len(copies), dtype=bool)
        for i, j in links:
            up[i, j] = up[j, i] = True
        for k in range(len(copies)):
            up |= np.outer(up[:, k], up[k])
        assert up.tolist() == linked_pairs(copies, percent)
    sides = [i % 2 for i in range(len(families[0]))]
    assert all(sides[i] != sides[j] for i, j in jaccard.link_block(families[0], percent, sides))


@pytest.mark.parametrize("percent", [90, 80, 40])
def test_sketches_keep_what_links(percent):
    rng = np.random.default_rng(percent)
    fresh = lambda n: rng.integers(0, 1 << 64, n, dtype=np.uint64)
    sets = []
    for size in (1, 2, 9, 64, 120, 400, 3000):
        for _ in range(6):  # copies about the threshold, many of them shorter
            base = fresh(size)
            sets.append(np.unique(base))
            for _ in range(8):
                gone, more = rng.integers(0, 2 + size * (100 - percent) // 100, 2)
                sets.append(np.unique(np.concatenate([rng.permutation(base)[gone:], fresh(more * int(rng.integers(2)))])))
    sets = [s for s in sets if s.size]
    sketches = jaccard._Sketches([jaccard.sketch(s, percent) for s in sets], percent)
    a, b = np.triu_indices(len(sets), 1)
    both = np.array([np.intersect1d(sets[i], sets[j], assume_unique=True).size for i, j in zip(a, b, strict=True)])
    size = np.array([s.size for s in sets])
    links = 100 * both >= percent * (size[a] + size[b] - both)
    assert links.sum() > 200 and sketches.may_link(a, b)[links].all() and sketches.may_link(b, a)[links].all()
    strangers = (both == 0) & (np.minimum(size[a], size[b]) > 50)
    assert percent < 80 or sketches.may_link(a, b)[strangers].mean() < 0.01
    starts = np.array([0, 5, 6, 6 + 130, len(sets)])  # few or many sets in a bucket, the same components
    for few in (1, 64, 1000):
        forest = jaccard._Forest(len(sets))
        for i, j in zip(*jaccard.near_pairs(starts, sketches, few), strict=True):
            forest.join(i, j)
        root = forest.roots(np.arange(len(sets)))
        same_bucket = np.searchsorted(starts, a, side="right") == np.searchsorted(starts, b, side="right")
        assert (root[a] == root[b])[links & same_bucket].all() and not (root[a] == root[b])[~same_bucket].any()
        found = len(set(root.tolist())) if few == 1 else found
        assert len(set(root.tolist())) == found


def test_chance_meetings_are_not_dealt_to_blocks(spark, monkeypatch):
    """Texts that share half with the next and so form one chain: the sets compared grow with their number, not with its square."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(5000)]
    passages = [" ".join(rng.choice(words, 60)) for _ in range(201)]
    rows = [(i, f"{passages[i]} {passages[i + 1]}") for i in range(200)]
    rows += [(1000 + i, f"{rows[i][1]} end") for i in range(0, 200, 20)]
    solve, dealt = jaccard._solve, []
    monkeypatch.setattr(jaccard, "_solve", lambda sets, *a, **b: (dealt.append(sets.count()), solve(sets, *a, **b))[1])
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=8).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_components(rows)
    assert sum(dealt) <= 3 * len(rows)


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_keep_one_judges_rows(spark, n, percent):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    clean = [" ".join(rng.choice(words, 60)) for _ in range(12)]
    near = [c + " end" for c in clean]
    rows = [
        (7, clean[0], "en", "a", 1), (None, near[0], "en", "a", 2), (None, clean[1], "en", "a", 3), (None, clean[2], "en", "a", 4),  # a null id copies 7
        (8, clean[3], "en", "a", 5), (9, near[3], "en", "a", 6), (9, clean[4], "en", "a", 7), (9, clean[5], "en", "a", 8),  # one row of 9 copies 8
        (10, clean[6], "en", "a", 9), (10, clean[6], "en", "a", 9), (10, clean[6], "en", "b", 9),  # equal rows, and another of the same text
        (11, clean[7], "en", "a", 10), (11, near[7], "en", "a", 10), (12, clean[7].upper(), "en", "a", 10),  # near copies under one id
        (None, clean[8], "en", "a", 11), (None, near[8], "en", "a", 11), (None, clean[8], "en", "a", 11),  # and under none
        (13, None, "en", "a", None), (13, "", "en", "a", 0), (13, "", "en", "a", 0), (None, " ", "en", "a", 0), (None, None, None, None, None),
    ]
    got = jaccard.keep_one(docs(spark, rows).withColumnRenamed("source", "one_id"), n, percent)
    assert got.columns == ["doc_id", "text", "lang", "one_id", "n_chars"]
    got = sorted(map(str, map(tuple, got.collect())))
    sure = [rows[i] for i in (0, 2, 3, 4, 6, 7, 8, 17, 18, 19, 20, 21)]
    assert [x for x in map(str, sorted(sure, key=str)) if x not in got] == []
    rest = [x for x in got if x not in map(str, sure)]
    assert len(got) == len(sure) + 2 and sorted(x.split(",")[0] for x in rest) == ["(11", "(None"]


def test_met_here():
    prefixes = [np.array(x, dtype=np.int64) for x in ([5, 6], [6, 7], [], [5, 6, 7, 8])]
    met, told = jaccard._met_here([10, 20, 30, 40], prefixes)
    assert [x.tolist() for x in met] == [[True, True], [True, True], [], [True, True, True, False]]
    assert [x.tolist() for x in told] == [[True, True], [False, True], [], [True, True, True, True]]
    assert jaccard._met_here([], []) == ([], [])


@pytest.mark.parametrize("percent", [90, 80])
def test_prefixes_meet(percent):
    rng = np.random.default_rng(2)
    linked = 0
    for n in [*range(1, 60), 300, 1000]:
        for share in (0.0, 0.04, 0.1, 0.19):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
            k = int(a.size * share)
            for b in (np.unique(np.concatenate([a[k // 2 :], rng.integers(0, 1 << 63, k // 2).astype(np.uint64)])), a[k:], a[: a.size - k]):
                if 100 * np.intersect1d(a, b).size >= percent * np.union1d(a, b).size:
                    linked += 1
                    for order in (1, -1):
                        both = np.intersect1d(*(x[::order][: jaccard.prefix_size(x.size, percent)] for x in (a, b))).size
                        assert both >= max(jaccard.needed(a.size, percent), jaccard.needed(b.size, percent)) >= 1
    assert linked > 300
    assert gram_hashes(word_hashes(b"A b\tC")[0], 3).tolist() == gram_hashes(word_hashes(b"a B c")[0], 3).tolist()


# 10 chats


def test_escape_is_reversible(spark):
    texts = ["<|im_end|>", "<!|", "<!!|<|", "a<|im_start|>assistant\nok", "", "<n>\n<!n>", "x|<"]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.unescape(chat.escape(chat.F.col("t"))).alias("a"), chat.unescape_role(chat.escape_role(chat.F.col("t"))).alias("b"), chat.escape_role(chat.F.col("t")).alias("c")).collect()
    assert all(r.t == r.a == r.b and "\n" not in r.c and "<|" not in r.c for r in out)


def test_events_fold(spark):
    events = [
        (1, 1, "message", 1, "user", "Hi"), (1, 2, "message", 2, "assistant", "He"), (1, 3, "delta", 2, None, "llo"), (1, 4, "regenerate", 2, None, None),
        (1, 5, "message", 2, "assistant", ""), (1, 6, "delta", 2, None, "Good "), (1, 7, "delta", 2, None, "day"), (1, 8, "edit", 1, None, "Hi!"),
        (2, 1, None, 1, "user", None), (None, 1, "message", None, None, "x"),
    ]
    out = chat.fold_events(spark.createDataFrame(events, "conv_id long, seq long, kind string, slot long, role string, text string"))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [(1, 1, "user", "Hi!"), (1, 2, "assistant", "Good day"), (2, 1, "user", ""), (None, None, None, "x")]))
    read = {r.conv_id: r for r in chat.read_back(chat.render(out)).collect()}
    assert [tuple(t) for t in read[1].turns] == [("user", "Hi!"), ("assistant", "Good day")] and read[1].loss_text == "Good day"
    assert [tuple(t) for t in read[2].turns] == [("user", "")] and read[2].loss_text == ""


def test_odd_rows_everywhere(spark):
    rows, empty = odd(spark), docs(spark, [])
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for table, n in ((rows, 9), (empty, 0)):
        assert mixing.mix(table).count() == n
        assert licenses.scan(table).count() == 0
        assert decontam.find_items(table, benchmark).count() == n
        assert linededup.dedup_lines(table).count() == n
        assert jaccard.near_duplicates(table).count() == n
        assert media.media_columns(media.store_media(table)).count() == n
        assert jaccard.keep_one(table).columns == table.columns
