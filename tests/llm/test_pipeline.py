"""The pipeline against brute force, stage by stage."""

import random

import pytest

pytest.importorskip("loomframe.llm")
import corpus_pipeline  # noqa: E402
from loomframe.llm import quality, secret_scan  # noqa: E402
from test_corpus_operators import words  # noqa: E402


def documents():
    rng = random.Random(11)
    shared = words(rng, 90)
    rows = [words(rng, rng.randint(60, 120)) for _ in range(25)]
    rows += [rows[0], rows[1] + " extra", "short text", None, "", "spam " * 80, rows[2][:150] + " " + shared + " " + rows[3], shared + " password = 'abcd1234efgh' " + words(rng, 80), "# $ % " * 60 + rows[4]]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(rows)]


def repeated(texts, w=200):
    from collections import Counter

    raw = [t.encode() for t in texts]
    seen = Counter(b[s : s + w] for b in raw for s in range(len(b) - w + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for s in range(len(b) - w + 1):
            if seen[b[s : s + w]] > 1:
                gone[s : s + w] = [True] * w
        out.append(bytes(x for x, g in zip(b, gone) if not g).decode(errors="ignore"))
    return out


def shingles(t):
    w = t.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_pipeline(spark, tmp_path):
    rows = documents()
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {r.doc_id for r in quality.quality_rules(docs.select("doc_id", "text")).filter("kept").collect()}
    assert kept.isdisjoint({27, 28, 29, 30, 33}) and len(kept) == 29
    left = []
    for i, t, *_ in rows:
        if i in kept and not any(100 * len(shingles(t) & shingles(u)) >= 75 * len(shingles(t) | shingles(u)) for _, u in left):
            left.append((i, t))
    cut = repeated([t for _, t in left])
    want = {i: secret_scan.mask_secrets(t) for (i, _), t in zip(left, cut)}
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert seen.columns == corpus_pipeline.COLUMNS
        stage(spark, seen, path).write.parquet(f"{path}/{name}")
        seen = spark.read.parquet(f"{path}/{name}")
    assert {r.doc_id: r.text for r in seen.collect()} == want
    assert all(r.n_chars == len(r.text) for r in seen.collect())
    packed = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in packed} == set(want)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, path).count() == 0
