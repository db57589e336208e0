"""Graph invariants, plans without nested loops, small negative cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.functions import scalars
from loomframe.operators import graph, joins, masks
from loomframe.plans import catalog
from loomframe.plans.adapters import nodes
from loomframe.sources import readers

SF = "/root/testdata/sf0.001"


@pytest.fixture
def path(spark):
    pairs = [(0, 1), (1, 2), (3, 4), (4, 5), (5, 6)]
    return spark.createDataFrame([*pairs, *[(b, a) for a, b in pairs]], "src long, dst long")


def table(spark, values, name="label_id"):
    return spark.createDataFrame(list(enumerate(values)), f"node_id long, {name} int")


def test_patches_follow_edges_and_labels(spark, path):
    got = {r.node_id: r.patch for r in graph.connected_patches(table(spark, [1, 1, 2, 1, 1, 1, 0]), path).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3, 5: 3}


def test_majority_and_pruning(spark, path):
    got = {r.node_id: r.label_id for r in graph.majority_smooth(table(spark, [1, 2, 1, 3, 2, 3, 9]), path).collect()}
    assert got[1] == 1 and got[4] == 3 and got[6] == 3
    pruned = {r.node_id: r.label_id for r in graph.prune_small_patches(table(spark, [1, 2, 1, 3, 3, 3, 2]), path, 2).collect()}
    assert pruned[1] == 1 and pruned[6] == 3


def test_morphology(spark, path):
    m = spark.createDataFrame([(4,), (5,)], "node_id long")
    assert {r.node_id for r in graph.dilate(m, path).collect()} == {3, 4, 5, 6}
    assert {r.node_id for r in graph.erode(graph.dilate(m, path), path).collect()} == {3, 4, 5, 6}
    assert {r.node_id for r in graph.largest_component(spark.createDataFrame([(i,) for i in range(7)], "node_id long"), path).collect()} == {3, 4, 5, 6}


def test_spaced_reference_is_spaced_and_maximal(spark):
    n = nodes(spark, SF).limit(200)
    near = joins.near_pairs(n, 0.1)
    chosen = {r.node_id for r in graph.spaced_reference(n, 0.1).collect()}
    pairs = [(r.src, r.dst) for r in near.collect() if r.src != r.dst]
    assert not any(a in chosen and b in chosen for a, b in pairs)
    reached = chosen | {a for a, b in pairs if b in chosen}
    assert reached == {r.node_id for r in n.collect()}


@pytest.mark.parametrize("most,mm", [(1, 0.01), (9, 0.01), (40, 0.2), (0, 0.1)])
def test_spread_reference(spark, most, mm):
    table = nodes(spark, SF).select("node_id", "x", "y", "z").repartition(5)
    rows = table.collect() + [table.first()]
    ids, xyz = [r.node_id for r in rows], np.array([(r.x, r.y, r.z) for r in rows])
    at = {n: p for n, p in zip(ids, xyz)}
    got = [r.node_id for r in graph.spaced_reference(table, mm, most).collect()]
    assert len(got) == len(set(got)) <= most
    if not most:
        return
    picks = np.array([at[n] for n in got])
    apart = np.sqrt(((picks[:, None] - picks[None]) ** 2).sum(2))[np.triu_indices(len(picks), 1)]
    assert not len(apart) or apart.min() > mm
    cover = np.sqrt(((xyz[:, None] - picks[None]) ** 2).sum(2)).min(1).max()
    # farthest-point picks
    greedy = [0]
    far = np.sqrt(((xyz - xyz[0]) ** 2).sum(1))
    while len(greedy) < most and far.max() >= mm:
        greedy.append(int(far.argmax()))
        far = np.minimum(far, np.sqrt(((xyz - xyz[greedy[-1]]) ** 2).sum(1)))
    assert cover <= max(mm, 2.05 * far.max())


def test_near_pairs_is_an_equi_join(spark):
    plan = joins.near_pairs(nodes(spark, SF), 0.05)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_near_is_inclusive(spark):
    n = spark.createDataFrame([(0, 0.0, 0.0, 0.0), (1, 3.0, 4.0, 0.0), (2, 5.000001, 0.0, 0.0)], "node_id long, x double, y double, z double")
    assert {(r.src, r.dst) for r in joins.near_pairs(n, 5.0).filter("src < dst").collect()} == {(0, 1), (1, 2)}


def test_patches_are_split_within_the_window(spark):
    rng = np.random.default_rng(5)
    centres = np.eye(6)[:4] * 5
    rows, edges = [], []
    for p, parts in ((1, 3), (2, 4), (3, 1)):
        for i in range(12 * parts):
            rows.append((p, p * 100 + i, [float(v) for v in centres[i // 12] + rng.normal(0, 0.1, 6)]))
            edges += [(p * 100 + i, p * 100 + i + 1), (p * 100 + i + 1, p * 100 + i)] if i % 12 < 11 else []
    features = spark.createDataFrame(rows, "patch long, node_id long, ts array<double>")
    bounds = spark.createDataFrame([(1, 4, 2), (2, 4, 1), (3, 1, 1)], "patch long, k_max int, window int")
    got = graph.split_patch(features, bounds, spark.createDataFrame(edges, "src long, dst long"), 4).orderBy("node_id").toPandas()
    for p, parts in ((1, 3), (2, 4), (3, 1)):
        mine = got[got["patch"] == p]
        x, label = np.array([r[2] for r in rows if r[0] == p]), np.arange(12 * parts) // 12
        assert set(mine["k"]) == {parts} and len(set(zip(label, mine["part"]))) == parts
        if parts == 1:
            assert mine["contrast"].isna().all()
            continue
        means = np.array([x[label == k].mean(0) for k in range(parts)])
        cosine = (x @ means.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(means, axis=1)
        own = cosine[np.arange(len(x)), label]
        cosine[np.arange(len(x)), label] = -9
        assert np.allclose(mine["contrast"], (own - cosine.max(1)).mean(), atol=1e-6)
    # a window that leaves out the best number of parts
    only = graph.split_patch(features.filter("patch = 1"), spark.createDataFrame([(1, 2, 0)], "patch long, k_max int, window int"), spark.createDataFrame(edges, "src long, dst long"), 4)
    assert {r.k for r in only.collect()} == {2}


def grid_graph(spark, rng, side=9):
    """Labels and edges of a grid, as tables and as dictionaries."""
    near = {(r, c): [(r + a, c + b) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0)) if 0 <= r + a < side and 0 <= c + b < side] for r in range(side) for c in range(side)}
    near = {r * side + c: [a * side + b for a, b in v] for (r, c), v in near.items()}
    edges = spark.createDataFrame([(a, b) for a, v in near.items() for b in v], "src long, dst long")
    return near, edges, {n: int(x) for n, x in enumerate(rng.integers(0, 4, side * side))}


def components_of(label, near):
    out = {}
    for n in sorted(label):
        if label[n] > 0 and n not in out:
            todo = [n]
            while todo:
                k = todo.pop()
                if k not in out:
                    out[k] = n
                    todo += [m for m in near[k] if label[m] == label[n]]
    return out


def test_pruning_is_the_vote_of_other_labels(spark):
    near, edges, label = grid_graph(spark, np.random.default_rng(1))
    got = graph.prune_small_patches(spark.createDataFrame(list(label.items()), "node_id long, label_id int"), edges, 4, passes=2)
    for _ in range(2):
        patch = components_of(label, near)
        size = {p: list(patch.values()).count(p) for p in patch.values()}
        new = dict(label)
        for n, p in patch.items():
            others = [label[m] for m in near[n] if label[m] not in (0, label[n])]
            if size[p] < 4 and others:
                new[n] = min(sorted(set(others)), key=lambda x: (-others.count(x), x))
        label = new
    assert {r.node_id: r.label_id for r in got.collect()} == label


def test_diffusion_is_the_dense_solution(spark):
    rng = np.random.default_rng(2)
    near, edges, _ = grid_graph(spark, rng, 6)
    part = rng.integers(0, 3, 36)
    got = graph.diffuse_labels(spark.createDataFrame([(n // 18, n, int(part[n])) for n in range(36)], "patch long, node_id long, part int"), edges, 0.7, 4)
    got = {r.node_id: r.part for r in got.collect()}
    for p in (0, 1):
        ids = range(18 * p, 18 * p + 18)
        w = np.array([[float(b in near[a]) for b in ids] for a in ids])
        a = np.eye(18) * (1 + 1e-6) + 0.7 * (np.diag(w.sum(1)) - w)
        label = part[18 * p : 18 * p + 18]
        for _ in range(4):
            label = np.round(np.linalg.solve(a, np.eye(3)[label]), 9).argmax(1)
        assert [got[n] for n in ids] == label.tolist()


def test_merging_follows_the_rule_of_a_round(spark):
    rng = np.random.default_rng(3)
    near, edges, _ = grid_graph(spark, rng)
    parcel, value = {n: n // 27 * 3 + n % 9 // 3 + 1 for n in near}, {n: round(float(v), 3) for n, v in enumerate(rng.random(81))}
    parcel[0], parcel[80] = 50, 60
    got = graph.merge_parcels(spark.createDataFrame(list(parcel.items()), "node_id long, parcel long"), edges, spark.createDataFrame(list(value.items()), "node_id long, value double"), 3, 0.45)
    while True:
        along = {}
        for n, others in near.items():
            for m in others:
                if parcel[n] != parcel[m]:
                    along.setdefault((parcel[n], parcel[m]), []).append((value[n] + value[m]) / 2)
        weak = {}
        for (a, b), v in along.items():
            weak[a] = min(weak.get(a, (9, 0)), (round(float(np.mean(v)), 12), b))
        size = {p: list(parcel.values()).count(p) for p in parcel.values()}
        moves = {}
        for a, (g, b) in weak.items():
            small = size[a] < 3
            if small or g < 0.45:
                if b < a:
                    moves[a] = min(moves.get(a, b), b)
                elif small:
                    moves[b] = min(moves.get(b, a), a)
        if not moves:
            break
        parcel = {n: moves.get(p, p) for n, p in parcel.items()}
    assert {r.node_id: r.parcel for r in got.collect()} == parcel


def test_merge_parcels_meets_the_minimum(spark, path):
    parcels = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 3), (4, 3), (5, 4), (6, 4)], "node_id long, parcel long")
    gradient = spark.createDataFrame([(i, 0.9) for i in range(7)], "node_id long, value double")
    got = graph.merge_parcels(parcels, path, gradient, 2, 0.1)
    assert {r["count"] for r in got.groupBy("parcel").count().collect()} == {3, 2}


def test_errors(spark):
    with pytest.raises(Exception, match="no component number"):
        spark.createDataFrame([("x",)], "s string").select(scalars.component_id(F.col("s"))).collect()
    with pytest.raises(ValueError):
        scalars.expand_range("1:0:3")
    with pytest.raises(ValueError):
        readers.require_columns(spark.range(1), ["value"])
    with pytest.raises(Exception, match="columns"):
        readers.parse_matrix(spark.createDataFrame([(0, "1 2")], "frame int, line string"), 6).collect()
    concat = spark.createDataFrame([(0, 0, 1.0)], "node_id long, global_frame int, value double")
    extent = spark.createDataFrame([("a", 0, 1)], "run string, start int, stop int")
    with pytest.raises(ValueError, match="unknown"):
        joins.extract_runs(concat, extent, ["a", "b"])
    with pytest.raises(ValueError, match="twice"):
        joins.extract_runs(concat, extent, ["a", "a"])


def test_empty_subset_gives_one_zero_map(spark):
    maps = spark.createDataFrame([(0, 5, 1.0), (0, 6, 2.0)], "component_id int, node_id long, loading double")
    assert [(r.position, r.loading) for r in masks.subset_components(maps, [9]).collect()] == [(0, 0.0), (0, 0.0)]


def test_format_g(spark):
    values = [0.0, 1.5, 123456.0, 0.00001234, -2.25, 99999.9, 0.1]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(scalars.format_g(F.col("v"))).collect()] == [f"{v:.5g}" for v in values]


def test_readers_round_trip(spark, tmp_path):
    (tmp_path / "m.txt").write_text("1 2 3\n4 5 6\n")
    assert [tuple(r) for r in readers.read_matrix_text(spark, str(tmp_path / "m.txt"), 3).orderBy("frame").collect()] == [(0, 1.0, 2.0, 3.0), (1, 4.0, 5.0, 6.0)]
    (tmp_path / "keep.txt").write_text("1 0\n1\n")
    assert [r.keep for r in readers.read_keep(spark, str(tmp_path / "keep.txt")).orderBy("frame").collect()] == [True, False, True]
    (tmp_path / "c.tsv").write_text("Component\tkappa\trho\tclassification\nICA_03\t1.5\t2\taccepted\n")
    assert readers.read_components(spark, str(tmp_path / "c.tsv")).first().component_id == 3
    run = tmp_path / "session_2" / "run_10"
    run.mkdir(parents=True)
    (run / "x.bin").write_bytes(b"abc")
    assert [(r.session, r.run, r.length) for r in readers.list_runs(spark, str(tmp_path), 2).collect()] == [(2, 10, 3)]
    (tmp_path / "side.json").write_text('{"RepetitionTime": 1.5}')
    assert readers.read_sidecars(spark, str(tmp_path / "side.json")).first().tr == 1.5


def test_densities_follow_the_number_of_nodes(spark, tmp_path):
    import numpy as np

    x = np.random.default_rng(3).normal(size=(1200, 64))
    spark.createDataFrame([(i, [float(v) for v in r], i % 10) for i, r in enumerate(x)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    fc = np.corrcoef(x.astype("float32"))
    np.fill_diagonal(fc, -1)
    order = np.argsort(-fc, axis=1)
    want = {k: {(min(i, int(j)), max(i, int(j))) for i in range(1200) for j in order[i, :k]} for k in (5, 12)}
    got = {(r.src, r.dst) for r in catalog.QUERIES["T1_topk_edges"](spark, str(tmp_path)).collect()}
    assert got == want[12] | {(b, a) for a, b in want[12]}
    graphs = catalog.QUERIES["G1_density_graphs"](spark, str(tmp_path)).collect()
    assert {(r.src, r.dst) for r in graphs if r.density == 0.004} == want[5]
    assert {(r.src, r.dst) for r in graphs if r.density == 0.01} == want[12]


def test_pairs_of_directions_are_the_mean_tensors_axes(spark):
    rng = np.random.default_rng(4)
    rows = {side: [(s, 3 * i + 1, float(b), *map(float, v / np.linalg.norm(v))) for s, n in sizes.items() for i, (b, v) in enumerate(zip(rng.integers(500, 3000, n), rng.normal(size=(n, 3))))] for side, sizes in (("p", {1: 4, 2: 2}), ("n", {1: 2, 2: 3}))}
    kind = "series int, vol int, bval double, bx double, by double, bz double"
    pos, neg = (spark.createDataFrame(rows[side], kind) for side in "pn")
    want = {}
    for s in (1, 2):
        p, n = ([r for r in rows[side] if r[0] == s] for side in "pn")
        for i in range(max(len(p), len(n))):
            pair = [side[i] for side in (p, n) if i < len(side)]
            tensor = sum(r[2] * np.outer(r[3:], r[3:]) for r in pair) / len(pair)
            want[s, p[i][1] if i < len(p) else -1, n[i][1] if i < len(n) else -1] = tensor
    got = {(r["series"], r["pos_vol"], r["neg_vol"]): r for r in joins.pair_directions(pos, neg).collect()}
    assert got.keys() == want.keys()
    for k, tensor in want.items():
        v = np.array([got[k]["bx"], got[k]["by"], got[k]["bz"]])
        assert np.allclose(tensor @ v, got[k]["bval"] * v) and np.isclose(np.linalg.norm(v), 1)
        assert np.isclose(got[k]["bval"], np.linalg.norm(tensor, 2))
    both = joins.pair_directions(pos, neg, combine_only=True).select("series", "pos_vol", "neg_vol").collect()
    assert sorted(map(tuple, both)) == sorted(k for k in want if -1 not in k)
