"""The pipeline's stages on a small table, against what each must do."""

import corpus_pipeline
import numpy as np
from test_operators import brute_components, docs

from kinetra.llm.queries import ORACLE_SQL, QUERIES


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near duplicates", "decontamination", "mixture"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.cut(stage(spark, docs, sf))
        sizes.append(docs.count())
        assert docs.columns == columns + ["copy"] * (i == 4)
    assert sizes[0] >= sizes[1] == sizes[2] >= sizes[3] >= sizes[4] > 0
    assert sizes[1] > 0.98 * sizes[0]


def planted(seed=4):
    """Documents with copies that have words replaced or an end cut off, around the thresholds of the stage."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for family in range(8):
        base = list(rng.choice(words, 180))
        rows.append((len(rows), " ".join(base), "en", "a", 0))
        for k in range(1, 7):
            copy = list(base)
            for at in range(k):
                copy[10 + at * 25] = f"new{family}_{k}_{at}"
            rows.append((len(rows), " ".join(copy), "en", "a", 0))
        if family % 2:  # copies that only a cut at the end sets off
            del rows[-6:]
            rows += [(len(rows) + i, " ".join(base[: 180 - cut]), "en", "a", 0) for i, cut in enumerate((30, 90))]
    return rows


def test_near_duplicate_stage(spark):
    rows = planted()
    got = corpus_pipeline.near_duplicates(spark, docs(spark, rows), "").collect()
    left = [str(r) for r in rows if any(x.startswith(f"({r[0]}, ") and x.endswith(f", {r[0]})") for x in brute_components([r[:2] for r in rows], 5, 80))]
    assert sorted(str(tuple(r)) for r in got) == sorted(left)


def test_queries_are_named():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)
