"""Operators without SQL against plain versions, and cases that lost or changed rows before."""

import re

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import DOCS, brute_components, brute_lines, docs, plain_alignment

from kinetra.llm import chat, decontam, html, jaccard, langid, licenses, linededup, media, mixing, warc

PAGES = "page_id long, url string, html string"

# 3 pages made from a known article


def made_page(rng):
    """A page with furniture around and inside the article, and the text it should give."""
    stops = "the of and to in is that for on with as was".split()
    words = lambda n: [str(rng.choice(stops)) if rng.random() < 0.4 else "w" + str(rng.integers(1000)) for _ in range(n)]
    prose = lambda n: " ".join(words(n))
    furniture = lambda: str(rng.choice([
        f"<nav><ul><li><a href='/'>{prose(2)}</a><li><a href=b>{prose(1)}</a></ul></nav>", f"<div class='ad-slot'>{prose(40)}</div>", f"<aside><p>{prose(60)}</p></aside>",
        f"<div id=comments><p>{prose(50)}</p></div>", f"<form><p>{prose(30)}</p><input value='>'></form>", f"<script>if (a < b) {{ '<p>{prose(9)}</p>' }}</script>",
        f"<div class=\"cookie-notice\">{prose(30)}</div>", f"<!-- <p>{prose(30)}</p> -->", f"<p hidden>{prose(30)}</p>", f"<div role=navigation>{prose(30)}</div>",
    ]))
    parts, want = [], []
    for _ in range(int(rng.integers(2, 9))):
        text = words(int(rng.choice([3, 25, 60])))
        kind = int(rng.integers(8))
        if kind == 0:
            parts.append(furniture())
            continue
        plain = " ".join(text)
        marks = {1: f"<p class=it's>{plain}", 2: f"<p><img alt='it's'>{plain}</p>", 3: f"<section id=related-work><p>{plain}</p></section>", 4: f"<p>{plain[: len(plain) // 2]}<b>{plain[len(plain) // 2 :]}</b></p>", 5: f"<ul><li>{plain}</ul>"}
        if kind == 6:
            plain, mark = plain + " < & é", f"<p>{plain} &lt;\n\t&amp; &#233;</p>"
        elif kind == 7:
            mark = f"<p title='hidden x' data-id=comments>\n {plain.replace(' ', '  ')} </p>"
        else:
            mark = marks[kind]
        parts.append(mark)
        want.append(plain)
    title = prose(4)
    page = f"<!DOCTYPE html><html><head><title>{title}</title></head><body><header>{prose(5)}</header>{furniture()}<article><header><h1>{title}</h1></header>{''.join(parts)}</article>{furniture()}<footer>&copy; {prose(9)}</footer></body></html>"
    return page, "\n".join([title, *want])


def test_pages_give_their_articles(spark):
    rng = np.random.default_rng(3)
    made = [made_page(rng) for _ in range(300)]
    rows = [(i, None, page) for i, (page, _) in enumerate(made)]
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert [i for i, (_, want) in enumerate(made) if got[i] != (want, len(want))] == []
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. " * 3
    assert html.main_text(f"<body><nav>Menu</nav><p>{polish}</p><div><a href=x>{polish}</a></div>") == polish.strip()
    assert html.extract(spark.createDataFrame([], PAGES)).count() == 0
    long = "<article>" + "<p>the word</p>" * 20_000
    assert html.main_text(long).count("\n") == 19_999


# 2 licenses


def test_notices_in_long_texts(spark):
    rng = np.random.default_rng(2)
    index = licenses.Index(licenses.TEMPLATES, 4, 4, 0.8)
    found = 0
    for name, text in licenses.TEMPLATES.items():
        words = re.findall("[a-z0-9]+", text.lower())
        for _ in range(6):
            changed = [w for w in words if rng.random() > 0.08]
            changed.insert(int(rng.integers(len(changed))), "new")
            around = [f"x{i}" for i in rng.integers(0, 99, 40)]
            data = " ".join([*around, *changed, *around])
            best = max(plain_alignment([*re.findall("[a-z0-9]+", t.lower())], data.split()) / len(re.findall("[a-z0-9]+", t.lower())) for t in licenses.TEMPLATES.values())
            got = licenses.find_licenses(data.encode(), index, 6, 0.8)
            assert bool(got) == (best >= 0.8), (name, data)
            assert all(g[3] >= 0.8 and data.encode()[g[6] : g[7]].decode().split() == data.split()[g[4] : g[5]] for g in got)
            found += bool(got)
    assert found > 60
    many = licenses.find_licenses(("é Released under the MIT License. " * 3000).encode(), index, 6, 0.8)
    assert len(many) == 3000 and many[-1][6] == 2999 * len("é Released under the MIT License. ") + 2


# 8 media


def plain_fingerprint(samples, per_frame=3, reach=3):
    x = [b - 128.0 for b in samples]
    n = 1 + (len(x) - 576) // 288
    window = np.array([0.5 - 0.5 * np.cos(2 * np.pi * i / 575) for i in range(576)])
    k = np.arange(289)[:, None] * np.arange(576)[None, :]
    wave = np.exp(-2j * np.pi * k / 576)
    power = [np.abs(wave @ (np.array(x[288 * t : 288 * t + 576]) * window)) ** 2 for t in range(n)]
    peaks = []
    for t in range(n):
        tops = [f for f in range(1, 288) if power[t][f] > power[t][f - 1] and power[t][f] >= power[t][f + 1] and (t == 0 or power[t][f] > power[t - 1][f]) and (t == n - 1 or power[t][f] >= power[t + 1][f])]
        peaks += [(t, f) for f in sorted(sorted(tops, key=lambda f: -power[t][f])[:per_frame])]
    return sorted((t, f, g, u - t) for i, (t, f) in enumerate(peaks) for u, g in peaks[i + 1 :] if 1 <= u - t <= reach)


def test_fingerprints_match_plain_transform(spark):
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(list("etaoin shrdlu.é"), int(n))) for n in (1, 576, 700, 4000, 9000)]
    stored = media.store_media(docs(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)] + [(None, None, "", "", 0)]))
    for r in media.media_columns(stored).collect():
        payload = media.pad(("" if r.doc_id is None else texts[r.doc_id]).encode())
        want = plain_fingerprint(payload)
        rows = [(c.time, *x) for c, x in zip(r.codes, media.unpack(np.array([c.pair for c in r.codes], dtype=np.int32).reshape(-1)).tolist(), strict=True)]
        assert rows == want and r.feature.startswith(f"pairs={len(want)};") and r.payload_bytes == len(payload)


# 1 mixing


def test_every_length_has_its_share():
    lengths = np.arange(1, 2001)
    take = mixing.fit_budget(lengths, np.ones(2000, dtype=np.int64), int(lengths.sum()) // 2)
    assert (take * lengths).sum() == lengths.sum() // 2
    assert all(abs(part.sum() - 50) <= 6 for part in np.split(take, 20))


def test_mixture_counts_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(1, "a b c d e f g h i j", "en", "s", 1)] * 6 + [(2, "a b", "en", "s", 1), (2, "c d", "en", "s", 1), (2, "c d", "de", "s", 1), (None, "x", None, "s", None)] + [(50 + i, "w " * int(rng.integers(1, 9)), "en", None, 0) for i in range(40)]
    table = docs(spark, rows).withColumnRenamed("lang", "copy")
    chosen = mixing.mix(table).collect()
    taken = mixing.mix_documents(table).collect()
    assert len(chosen) == len(rows) and table.columns + ["_copy"] == mixing.mix_documents(table).columns
    for s in ("s", None):
        words = [len(r[1].split()) for r in taken if r[3] == s]
        assert sum(words) == sum(r.copies * r.size for r in chosen if r.source == s)
        assert abs(sum(words) - next(r.target for r in chosen if r.source == s)) <= 1
    assert sorted(r[5] for r in taken if r[0] == 1) == list(range(1, 1 + sum(r.copies for r in chosen if r.doc_id == 1)))
    sizes = spark.createDataFrame([(f"s{i:03d}", int(n)) for i, n in enumerate(rng.integers(1, 5000, 300))] + [(None, 10)], "source string, source_size long")
    from test_operators import reference_targets

    want = reference_targets({r.source: r.source_size for r in sizes.collect()}, (3.0, 1.0, 2.0))
    assert {r.source: r.target for r in mixing.source_targets(sizes).collect()} == pytest.approx(want)


# 4 archives, 6 lines, 7 language, 10 chats


def test_pages_without_ids_fill_several_files(spark):
    pages = spark.createDataFrame([(None, f"u{i}", f"<p>{i}</p>" * 9) for i in range(60)] + [(5, "v", f"<b>{i % 7}</b>") for i in range(40)], PAGES)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/null-ids"
    manifest = warc.write_archive(pages, folder, shard_bytes=400)
    assert manifest.count() > 4
    got = warc.read_archive(spark, folder).collect()
    assert sorted((r.page_id or -1, r.url, bytes(r.payload)) for r in got) == sorted((r.page_id or -1, r.url, r.html.encode()) for r in pages.collect())
    assert all(r.record_type == "response" for r in got)
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_lines_of_common_ids_and_names(spark):
    rows = [(i % 50 if i % 3 else None, "\n".join(f"a line of number {(i * k) % 40}" for k in range(1, 6))) for i in range(150)]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS `a.b`", "text AS kept")
    out = linededup.dedup_lines(table)
    assert out.columns == ["doc_id", "text", "a.b", "kept", "n_lines", "n_dropped", "_kept"]
    assert sorted(str((r.doc_id, r.n_lines, r.n_dropped, r._kept)) for r in out.collect()) == brute_lines(rows)
    index = linededup.LineIndex(spark, shard_keys=2)
    pairs = linededup.cut(linededup.line_pairs(table))
    index.insert(pairs)
    assert index.shards > 4
    common = sorted(map(str, index.repeated_in(pairs, task_rows=7).collect()))
    assert common == sorted(map(str, index.repeated_in(pairs, most_hot=1).collect())) and common
    with pytest.raises(ValueError, match="is in the index"):
        index.insert(pairs)


def test_hot_keys_are_broadcast(spark):
    rows = spark.range(5000).select((F.when(F.col("id") < 3000, 0).otherwise(F.col("id"))).alias("key"), "id")
    keyed = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    from kinetra.llm.common import join_counted

    assert sorted(map(tuple, join_counted(rows, keyed, "key", "n", 5000).select("key", "id", "first").collect())) == sorted((0 if i < 3000 else i, i, 0 if i < 3000 else i) for i in range(5000))


def test_words_of_any_length():
    pieces = ["▁", "a", "ab", "ba", "c"]
    lattice = langid.Lattice(pieces)
    p = np.random.default_rng(0).random((lattice.size, 2)) / 10
    p[0] = 0
    for n in (3, 40, 41, 300):
        word = "".join(np.random.default_rng(n).choice(list("abcd"), n))
        total = np.full((n + 1, 2), -np.inf)
        total[0] = 0
        for j in range(1, n + 1):
            for i in range(max(0, j - 3), j):
                k = lattice.ids.get(word[i:j], 1 if j == i + 1 else 0)
                if k:
                    total[j] = np.logaddexp(total[j], total[i] + np.log(p[k]))
        assert np.allclose(lattice.log_likelihood([word], p)[0], total[-1])


def test_language_stage(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*(c.split()[0] for c in DOCS.split(", ")))
    junk = "".join(np.random.default_rng(1).choice(list("bcdfghjklmnpqrstvwxz      "), 900))
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa"
    more = docs(spark, [(-1, junk, None, "", 0), (-2, polish, None, "", 0), (-3, None, None, "", 0), (-4, "12 34", None, "", 0)])
    kept = {r.doc_id for r in langid.reject(table.unionByName(more), per_language=60, rounds=2).select("doc_id").collect()}
    letters = {r.doc_id for r in table.collect() if re.search(r"[^\W\d_]", r.text or "")}
    assert kept <= letters and len(kept) >= 0.995 * len(letters)
    assert langid.identify(docs(spark, []), per_language=5, rounds=1).count() == 0


def test_chats_are_folded_from_real_events(spark):
    rows = [(c, t, ("user", "assistant", "assistant", None, "assistant")[t % 5], "<|im_end|> word é " * (t * c)) for c in range(1, 4) for t in range(12)] + [(None, None, "assistant", None), (9, 0, "assistant", "twice"), (9, 0, "assistant", "twice")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kinds = {r.kind: r["count"] for r in chat.events_of(table).groupBy("kind").count().collect()}
    assert set(kinds) == {"message", "delta", "edit", "regenerate"}
    for r in chat.read_back(chat.format_chats(table)).collect():
        own = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: (x[1] is not None, x[1] or 0))
        assert [tuple(t) for t in r.turns] == [(x[2] or "", x[3] or "") for x in own]
        assert r.loss_text == "".join(x[3] or "" for x in own if x[2] == "assistant")
        spans = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        assert [re.sub(r"<(!*)!\|", r"<\1|", s) for s in spans] == [x[3] or "" for x in own if x[2] == "assistant"]
    assert chat.format_chats(table.limit(0)).count() == 0


# the pipeline, each stage on its own input


def test_stages_against_plain_versions(spark, tmp_path):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(300)]
    line = lambda n: " ".join(rng.choice(words, n))
    shared, item = line(30), line(14)
    rows = [(i, "\n".join([line(40), shared if i % 3 == 0 else line(30), item if i % 7 == 0 else line(5)]), "en", "ab"[i % 2], 0) for i in range(42)]
    rows += [(100 + i, rows[i][1].replace("\n", " ") + " more", "en", "a", 0) for i in range(5)] + [(200, None, "en", "a", None), (201, "", "en", "b", 0)]
    spark.createDataFrame([(1, item), (2, "no such words at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table = docs(spark, rows)
    lines = corpus_pipeline.dedup_lines(spark, table, str(tmp_path))
    want = brute_lines([r[:2] for r in rows])
    assert lines.columns == table.columns
    assert sorted(r.text or "" for r in lines.collect()) == sorted(eval(x)[3] for x in want)
    near = jaccard.keep_one(table, 5, 80).collect()
    assert {r.doc_id for r in near} == {eval(x)[0] for x in brute_components([r[:2] for r in rows], 5, 80) if eval(x)[0] == eval(x)[2]}
    clean = corpus_pipeline.decontaminate(spark, table, str(tmp_path)).collect()
    window = lambda t: {tuple(x[i : i + 10]) for x in [t.split()] for i in range(len(x) - 9)}
    assert {r.doc_id for r in clean} == {r[0] for r in rows if not window(r[1] or "") & window(item)}
    mixed = corpus_pipeline.mix_sources(spark, table, "").collect()
    for s in "ab":
        size = sum(len((r[1] or "").split()) for r in rows if r[3] == s)
        assert {r.doc_id for r in mixed} <= {r[0] for r in rows if r[1]} and 0 < sum(len(r.text.split()) for r in mixed if r.source == s) <= 2 * size
    assert decontam.drop_contaminated(table, spark.createDataFrame([], "item_id long, text string")).count() == len(rows)
