"""Operators across texts against brute force."""

import hashlib
import random
from collections import Counter

import pytest

pytest.importorskip("loomframe.llm")
import numpy as np  # noqa: E402
from loomframe.llm import near_dedup, sharding, suffix_dedup, topk, url_filter  # noqa: E402


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def passages(seed=1):
    rng = random.Random(seed)
    shared = [words(rng, n)[: k] for n, k in ((60, 199), (60, 200), (60, 201), (80, 260), (120, 400), (400, 1500))]
    rows = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += [words(rng, rng.randint(0, 60)), rng.choice(shared)[: rng.choice((None, None, 230))]]
        rows.append("".join(parts) + words(rng, rng.randint(0, 50)))
    rows += [rows[3], rows[3], "z" * 900, "ab" * 300 + "é" * 200, "", None, "é" * 101, shared[4], shared[4][50:], rows[5][10:]]
    return [(i, t) for i, t in enumerate(rows)] + [(2, rows[2]), (None, rows[7])]


def brute_passages(rows, w=200):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[s : s + w] for b in raw for s in range(len(b) - w + 1))
    out = []
    for (i, _), b in zip(rows, raw):
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - w + 1):
            if seen[b[s : s + w]] > 1:
                gone[s : s + w] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((str(i), len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed, tmp_path):
    rows = passages(seed)
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    got = suffix_dedup.op6_suffix_dedup(spark, path).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_passages(rows)


def test_loser_tree_merges_and_measures():
    rng = random.Random(5)
    lists = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 40))) for _ in range(7)]
    runs = []
    for keys in lists:
        shared = [0, *[suffix_dedup.common_prefix(a, b) for a, b in zip(keys, keys[1:])]]
        runs.append(suffix_dedup.Run(np.array(shared[: len(keys)]), [k[n:] for k, n in zip(keys, shared)], keys))
    got = [(runs[r].extra[i], h) for r, i, h in suffix_dedup.merge(runs)]
    want = sorted(k for keys in lists for k in keys)
    assert [k for k, _ in got] == want
    assert [h for _, h in got][1:] == [suffix_dedup.common_prefix(a, b) for a, b in zip(want, want[1:])]


def near_rows():
    rng = random.Random(3)
    base = [words(rng, n).split() for n in (1, 3, 5, 30, 60, 200)]
    rows = [None, "", " \n", "A B c", "a b C", "a b"]
    for b in base:
        for k in (0, 0, 1, 2, 4):
            x = list(b)
            for _ in range(k):
                x[rng.randrange(len(x))] = "changed%d" % rng.randrange(99)
            rows.append(" ".join(x))
    return [(i * 7 % 101, t) for i, t in enumerate(rows)] + [(None, rows[10]), (None, rows[4]), (rows and 3, rows[12])]


def brute_near(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and a and b and 100 * len(a & b) >= 75 * len(a | b)]
    before = None
    while before != label:
        before = list(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((str(d), len(sets[i]), str(c), d == c))
    return sorted(out)


def test_near_duplicates(spark, tmp_path):
    rows = near_rows()
    spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = near_dedup.op5_near_duplicates(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == brute_near(rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.filter("text = 'a b'").count() == 1 and kept.filter("lower(text) = 'a b c'").count() == 1
    assert near_dedup.drop_near_duplicates(docs.limit(0)).count() == 0


def test_a_large_group_of_edited_copies(spark, tmp_path):
    """Similarities on both sides of the threshold: stars, further centres and exact bounds together find what brute force finds."""
    rng = random.Random(8)
    base = words(rng, 60).split()
    rows = []
    for i in range(160):
        x = list(base)
        for _ in range(rng.choice((1, 1, 2, 2, 3, 4))):
            x[rng.randrange(len(x))] = f"w{rng.randrange(40)}"
        rows.append((i, " ".join(x)))
    spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = near_dedup.op5_near_duplicates(spark, str(tmp_path)).collect()
    want = brute_near(rows)
    assert 1 < len({c for _, _, c, _ in want}) < 160
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == want


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for n in (30, 3000):
        s = near_dedup.super_minhash([np.unique(a[:n]), np.unique(a[n // 4 : n])])
        assert abs((s[0] == s[1]).mean() - 0.75) < 0.12
    assert (near_dedup.super_minhash([a[:1]])[0] >> np.uint64(48)).tolist().count(0) == 1


def test_shards_move_only_into_the_new_one(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 7)) for i in range(2000)] + [(5, None), (None, "n")], "doc_id long, text string")
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == 2002
    assert all(r.shard == r.grown_shard or r.grown_shard == 40 for r in rows)
    by = Counter(r.shard for r in rows)
    assert len(by) == 40 and max(by.values()) < 100
    for s in by:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(by[s]))
    again = {r.doc_id: r.shard for r in sharding.shard_documents(docs.repartition(5)).collect()}
    assert all(again[r.doc_id] == r.shard for r in rows)


def test_weight_change_stays_in_its_subtree(spark):
    from pyspark.sql import functions as F

    tree = sharding.standard_tree(16, 16)
    heavier = [(r, k, s, 3.0 if s == 9 else w) for r, k, s, w in tree]
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    both = sharding.hash_tree_shard(sharding.hash_tree_shard(ids, F.col("doc_id"), tree, "a"), F.col("doc_id"), heavier, "b").collect()
    region = {s: r for r, _, s, _ in tree}
    assert all(r.a == r.b or region[r.b] == "r1" for r in both)


def test_top_k_ties_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.5]) for i in range(120)] + [(200, None), (201, [float("nan"), 1.0]), (202, [1.0, None]), (203, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (250, [-1.0, 0.25])]
    v = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = topk.top_k(v, v.filter("vec_id % 50 = 0"), 5).collect()
    assert sorted((r["rank"], r.vec_id) for r in got if r.query_id == 0) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    assert {r.query_id for r in got} == {0, 50, 100, 250}
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0


def test_kd_tree_is_exact():
    rng = np.random.default_rng(0)
    x = rng.integers(-200, 200, (3000, 6)).astype(float)
    tree = topk.KDTree(np.arange(3000), x, 32)
    for q in range(0, 3000, 500):
        got = sorted(tree.search(x[q], q, 5), reverse=True)
        s = x @ x[q]
        want = sorted(((int(s[i]), -i) for i in range(3000) if i != q), reverse=True)[:5]
        assert [(int(a), int(b)) for a, b in got] == want


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?q#f", "https://example.org/en/12", "https://x.com/fr/1", "http://com/de/", "http://notexample.org/es/", "a://b.net", "http://h.org?x", "http://h.org#/y"]
    pages = spark.createDataFrame([(i, u, "keep") for i, u in enumerate(urls)] + [(4, urls[4], "keep")], "page_id long, url string, rule string")
    rules = spark.createDataFrame(url_filter.CONTRACT_RULES, "host string, path string, verdict string")
    got = {r.page_id: r for r in url_filter.url_filter(pages, rules).collect()}
    assert (got[4].host, got[4].path, got[4].rule, got[4].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert [got[i].verdict for i in range(12)] == ["allow"] * 4 + ["block", "block", "allow", "block"] + ["allow"] * 4
    assert [got[i].rule for i in (0, 5, 6, 7, 8, 10)] == [None, "example.org/en/1", "com/fr/", "com/de/", "org/", None]
    assert got[0].host == "" and got[3].path == ""
    assert url_filter.url_filter(pages, rules).count() == 13


def test_anchors_of_long_texts_do_not_depend_on_the_step(monkeypatch):
    from loomframe.llm import anchors

    data = np.frombuffer((words(random.Random(4), 3000) + "z" * 700).encode(), np.uint8)
    whole = anchors.anchors(data, np.array([0, 900, len(data)]))
    monkeypatch.setattr(anchors, "STEP", 333)
    parts = anchors.anchors(data, np.array([0, 900, len(data)]))
    assert all((a == b).all() for a, b in zip(whole, parts))


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_that_polynomial_hashes_confuse_stay_apart(spark, tmp_path):
    a = thue_morse(1024)
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"one two {a} three four"), (2, f"one two {b} three four")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert all(r.kept and r.component_id == r.doc_id for r in near_dedup.op5_near_duplicates(spark, str(tmp_path)).collect())
    rows = [(1, "x" * 50 + a + "y" * 200), (2, "z" * 50 + b + "w" * 200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = suffix_dedup.op6_suffix_dedup(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_passages(rows)


def test_passages_with_one_hot_line_in_narrow_ranges(spark, tmp_path, monkeypatch):
    """A line of 64 to 199 bytes in most texts, with other text around it: its strings are dealt to several ranges, with exact neighbours across them."""
    monkeypatch.setattr(suffix_dedup, "RANGE_STRINGS", 40)
    rng = random.Random(9)
    line = words(rng, 40)[:150]
    tails = [words(rng, 12) for _ in range(6)]
    rows = [(i, words(rng, rng.randint(5, 30)) + line + rng.choice(tails)[: rng.randint(20, 60)] + words(rng, 20)) for i in range(150)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = suffix_dedup.op6_suffix_dedup(spark, str(tmp_path)).collect()
    want = brute_passages(rows)
    assert sum(r[2] for r in want) > 0
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_cut_passages_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "abc " * 90, "mine", "x") for i in range(3)], "_row long, text string, kept string, _ranges string")
    out = suffix_dedup.cut_passages(docs)
    assert out.columns == ["_row", "text", "_ranges", "kept", "n_bytes", "n_removed", "n_spans"]
    assert {r.n_removed for r in out.collect()} == {360}


def test_shingles_in_pieces_are_the_same(monkeypatch):
    from loomframe.llm import shingles

    rng = random.Random(6)
    a, b = words(rng, 900), words(rng, 300)
    texts = [(a + " " + b).encode(), (b + " " + a[:2000]).encode()]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    want = (len(sets[0]), len(sets[1]), len(sets[0] & sets[1]))

    def made():
        return [shingles.Shingles(shingles.word_keys(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[1]) for t in texts]

    assert shingles.common(*made()) == want
    monkeypatch.setattr(shingles, "TOGETHER", 100)
    monkeypatch.setattr(shingles, "SLICE_BYTES", 700)
    assert shingles.common(*made()) == want and made()[0].pieces() > 5
    # hashes that clash: shingles are told apart by their keys
    chained = shingles._chained
    monkeypatch.setattr(shingles, "_chained", lambda h: chained(h) % np.uint64(7))
    assert shingles.common(*made()) == want


def test_many_pages_of_one_template_are_settled_without_all_pairs(spark, tmp_path):
    """Pages that share 70 % with each other: none is linked, and no join lists their pairs."""
    rng = random.Random(12)
    template = words(rng, 120)
    rows = [(i, template + " " + " ".join(f"u{i}x{k}" for k in range(45))) for i in range(1500)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = near_dedup.op5_near_duplicates(spark, str(tmp_path))
    assert got.filter("kept AND component_id = doc_id").count() == 1500


def test_shards_have_sizes_and_checksums(spark):
    import zlib

    texts = {i: t for i, t in enumerate(["", "a", "é日𝒳", "x" * 5000])} | {9: None}
    docs = spark.createDataFrame([(i, t, "mine") for i, t in texts.items()], "doc_id long, text string, shard string")
    for r in sharding.shard_documents(docs).collect():
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 16, zlib.crc32(raw)) and 0 <= r.shard < 40 and r.law == "key"
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_top_k_of_repeated_rows_clusters_and_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 64)
    rng = np.random.default_rng(4)
    centres = rng.integers(-500, 500, (6, 5))
    x = centres[rng.integers(0, 6, 900)] + rng.integers(-9, 9, (900, 5))
    x[:300] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5, x[5].tolist())]
    v = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = topk.top_k(v, v.filter("vec_id % 100 = 0"), 5).collect()
    for q in range(0, 900, 100):
        want = sorted(((-int(np.dot(x[q], w)), i) for i, w in rows if i != q))[:5]
        assert [(r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == [(-s, i) for s, i in want]
    big = spark.createDataFrame([(0, [2**30, 1]), (1, [2**30, 3]), (2, [2**30, 2])], "vec_id long, v array<long>")
    assert [r.score for r in sorted(topk.top_k(big, big.filter("vec_id = 0"), 2).collect(), key=lambda r: r["rank"])] == [2**60 + 3, 2**60 + 2]


def test_oracles_agree(spark):
    import duckdb
    from loomframe.llm.queries import ORACLES, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, sf)
        columns = ", ".join(sorted(df.columns))
        assert sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect()))) == sorted(map(str, con.sql(f"SELECT {columns} FROM ({sql})").fetchall())), name


@pytest.mark.parametrize("place", ["op5", "near_dedup", "op6", "passages"])
def test_row_numbers_stay_when_the_splits_change(spark, monkeypatch, place):
    import corpus_pipeline
    from loomframe.llm import near_dedup, suffix_dedup
    from loomframe.llm.common import table

    class Seen(Exception):
        pass

    def caught(docs, **_):
        raise Seen(docs)

    for module, name in ((near_dedup, "near_duplicates"), (suffix_dedup, "cut_passages"), (corpus_pipeline, "cut_passages")):
        monkeypatch.setattr(module, name, caught)
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    run = {
        "op5": lambda: near_dedup.op5_near_duplicates(spark, sf),
        "near_dedup": lambda: near_dedup.drop_near_duplicates(docs),
        "op6": lambda: suffix_dedup.op6_suffix_dedup(spark, sf),
        "passages": lambda: corpus_pipeline.passage_stage(spark, docs, sf),
    }[place]
    with pytest.raises(Seen) as seen:
        run()
    frame = seen.value.args[0]
    before = sorted(map(tuple, frame.select("_row", "text").collect()), key=str)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert sorted(map(tuple, frame.select("_row", "text").collect()), key=str) == before
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_sharding_keeps_other_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "c", 7), (2, "b", 6)], "doc_id long, _tree_leaf string, _tree_root int")
    tree = sharding.standard_tree(8)
    got = sharding.hash_tree_shard(df, F.col("doc_id"), tree)
    plain = sharding.hash_tree_shard(df.select("doc_id"), F.col("doc_id"), tree)
    assert got.columns == [*df.columns, "shard"]
    assert sorted((str(r.doc_id), r._tree_leaf, r._tree_root) for r in got.collect()) == sorted((str(r.doc_id), r._tree_leaf, r._tree_root) for r in df.collect())
    assert {(r.doc_id, r.shard) for r in got.collect()} == {(r.doc_id, r.shard) for r in plain.collect()}
    assert sharding.hash_tree_shard(df.limit(0), F.col("doc_id"), tree).count() == 0
