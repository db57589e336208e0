"""Near-duplicate documents: SuperMinHash, banding, exact verification, union of the links."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomframe.llm.common import Workspace, numbered, spread_join, stored, table
from loomframe.llm.shingles import Shingles, common, mix, shingled

#: A pair at similarity 0.75 shares none of 40 bands of 5 rows with probability 2e-5, at 0.8 with 1e-7.
BANDS, ROWS = 40, 5
#: Linked: 100 * intersection >= LEAST * union.
LEAST = 75
#: Members that are compared with a centre in one task group, and shingles whose permutations are drawn together.
GROUP, DRAWN = 64, 1 << 17
#: Classes of shingles that are counted for a bound, and rarer shingles that go with one.
CLASSES, RARER = 64, 64


class Signature:
    """SuperMinHash signatures (n x m) of n sets of 64-bit hashes, which are added set by set or in parts of a set.

    Every element draws a random permutation of the m places step by step. At step j it offers j (and a random fraction) to its
    j-th place, which keeps its smallest offer. All elements that are added together take step j together; a set stops as soon as no
    place can still get a smaller offer, which takes few steps for sets larger than m, and for parts of a set that come later.
    """

    def __init__(self, n: int, m: int = BANDS * ROWS):
        self.n, self.m = n, m
        self.best = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)

    def add(self, owner: np.ndarray, element: np.ndarray) -> None:
        for at in range(0, len(element), DRAWN):
            self._draw(owner[at : at + DRAWN], element[at : at + DRAWN])

    def _draw(self, owner: np.ndarray, element: np.ndarray) -> None:
        m, best = self.m, self.best
        places = np.tile(np.arange(m, dtype=np.uint8), (len(element), 1))
        for j in range(m):
            if not len(element):
                break
            draw = mix(element + np.uint64((j * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % (1 << 64)))
            k = j + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
            at = np.arange(len(element))
            chosen = places[at, k]
            places[at, k] = places[:, j]
            offer = (np.uint64(j) << np.uint64(48)) | (mix(draw) >> np.uint64(16))
            np.minimum.at(best, owner * m + chosen, offer)
            if j < 12 or j % 8 == 0:
                open_ = (best.reshape(self.n, m).max(1) >> np.uint64(48)) > j
                going = open_[owner]
                if not going.all():
                    owner, element, places = owner[going], element[going], places[going]

    def values(self) -> np.ndarray:
        return self.best.reshape(self.n, self.m)


def super_minhash(sets: list[np.ndarray], m: int = BANDS * ROWS) -> np.ndarray:
    """Signatures (len(sets) x m) of sets of 64-bit hashes."""
    out = Signature(len(sets), m)
    if sets:
        out.add(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets))
    return out.values()


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def band_keys(signature: np.ndarray) -> np.ndarray:
    sig = signature.reshape(len(signature), BANDS, ROWS)
    band = np.zeros(sig.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        band = mix(band ^ sig[:, :, r]) * np.uint64(0x2545F4914F6CDD1D)
    return _signed(band)


def signatures(docs: DataFrame) -> DataFrame:
    """_row, doc_id, n_shingles, digest and keys (one per band).

    digest is 128 cryptographic bits of the words (of their keys), null without words. Rows that have the same set by other words have
    other digests but the same signature, and meet in every band.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_row", "doc_id", "n_shingles", "digest", "keys"]
        for batch in batches:
            for first, sets, words in shingled(batch.column(2)):
                full = [i for i, w in enumerate(words) if len(w)]
                sig = Signature(len(full))
                sizes, digest, keys = [0] * len(sets), [None] * len(sets), [None] * len(sets)
                owner, element = [], []
                for k, i in enumerate(full):
                    digest[i] = blake2b(np.ascontiguousarray(words[i]), digest_size=16).digest()
                    for size, hashes in sets[i].distinct():
                        sizes[i] += size
                        if sets[i].pieces() > 1:
                            sig.add(np.full(len(hashes), k), hashes)
                        else:
                            owner.append(np.full(len(hashes), k))
                            element.append(hashes)
                if owner:
                    sig.add(np.concatenate(owner), np.concatenate(element))
                for i, b in zip(full, band_keys(sig.values())):
                    keys[i] = b
                part = batch.slice(first, len(sets))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names)

    return docs.select("_row", "doc_id", "text").mapInArrow(run, "_row long, doc_id long, n_shingles long, digest binary, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame, space: Workspace) -> DataFrame:
    """a, b and linked of the pairs (a, b), from their full shingle sets. texts: (node, text), one row per node.

    Members b travel to their centre a with their texts. A centre with more than GROUP members is sent to several groups, so no
    group holds more than about GROUP texts, of which a task keeps two at a time. Shingles are compared by their words' keys.
    """
    salts = space.stored(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("salts")), "salts")
    members = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"), F.col("b").alias("node"))
    centres = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("a").alias("node"))
    rows = members.unionByName(centres).join(texts, "node").select("a", "salt", "role", "node", "text")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = centre = None
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            a, salt, role, node = (batch.column(i).to_pylist() for i in range(4))
            for first, sets, _ in shingled(batch.column(4)):
                for i, own in enumerate(sets, first):
                    if role[i] == 0:
                        key, centre = (a[i], salt[i]), own
                    elif key == (a[i], salt[i]):
                        x, y, both = common(centre, own)
                        for column, v in zip(out, (a[i], node[i], 100 * both >= LEAST * (x + y - both))):
                            column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], ["a", "b", "linked"])

    return rows.mapInArrow(run, "a long, b long, linked boolean")


def shingle_rows(texts: DataFrame) -> DataFrame:
    """shingle (a hash), node of texts (node, text): one row for each distinct shingle of a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets, _ in shingled(batch.column(1)):
                for i, own in enumerate(sets, first):
                    for _, hashes in own.distinct():
                        h = np.unique(hashes)
                        yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array(np.full(len(h), batch.column(0)[i].as_py(), np.int64))], ["shingle", "node"])

    return texts.select("node", "text").mapInArrow(run, "shingle long, node long")


def components(links: DataFrame, space: Workspace) -> DataFrame:
    """(node, label) of every node of links (a, b): label is the smallest node that it reaches.

    Each round every node takes the smallest label among its neighbours, then its label's label; labels are written
    to the shared folder after each round. A label that many nodes have is dealt to several tasks.
    """
    edges = space.stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = space.stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        heard = edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        lower = space.stored(labels.join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label")), "lower")
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = space.stored(spread_join(lower, up, ["label"]).select("node", "old", F.least("label", "up").alias("label")), "labels")
        done = jumped.filter("old <> label").isEmpty()
        labels = jumped.select("node", "label")
        if done:
            return labels


def needed(size: Column) -> Column:
    """Shingles that a set of this size shares with any that it is linked with: LEAST / 100 of its own."""
    return F.ceil(size * F.lit(LEAST) / 100)


def rare_shingles(open_: DataFrame, rows: DataFrame, space: Workspace) -> DataFrame:
    """The rarest shingles of each open node (node, size, label) that can still be linked with one of another label: shingle, node, size, label, rest, rank,
    small, rarer, classes. rows: (shingle, node).

    A linked pair shares at least LEAST / 100 of either set, and 2 * LEAST / (100 + LEAST) of the smaller one. So
    1. a node goes when fewer of its shingles than that occur under another label too; this is repeated, as fewer nodes are left;
    2. each node's remaining shingles (rest of them) are ranked, the rarest first, in one order for all; a linked pair has its first common shingle
       among the first of either, as many as can be missing, plus one; for the smaller of the two sets (small) fewer can be missing.
    rarer has the shingles ranked before, up to RARER of them (else null); classes counts the rest by CLASSES classes of their hashes.
    """
    nodes = space.stored(open_, "open")
    rows = space.stored(rows.join(nodes.select("node"), "node", "left_semi"), "shingles")
    while True:
        held = rows.join(nodes.select("node", "label"), "node")
        known = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("shingle", "n")
        known = space.stored(known, "known")
        # both sides are stored tables, so that a hot shingle's rows can be split
        rows = space.stored(rows.join(known, "shingle").select("shingle", "node", "n"), "shingles")
        left = nodes.join(rows.groupBy("node").agg(F.count(F.lit(1)).alias("rest")), "node").filter(F.col("rest") >= needed(F.col("size")))
        left = space.stored(left.select("node", "size", "label", "rest"), "open")
        before, after = nodes.count(), left.count()
        nodes = left.drop("rest")
        if before - after <= before / 20:
            break
        rows = space.stored(rows.join(nodes.select("node"), "node", "left_semi").select("shingle", "node"), "shingles")
    counts = rows.groupBy("node", F.pmod("shingle", F.lit(CLASSES)).alias("c")).agg(F.count(F.lit(1)).cast("int").alias("m"))
    entry = F.map_from_entries(F.collect_list(F.struct("c", "m")))
    classes = counts.groupBy("node").agg(entry.alias("e")).select("node", F.expr(f"transform(sequence(0L, {CLASSES - 1}L), c -> coalesce(e[c], 0))").alias("classes"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("n", "shingle"))
    first = rows.join(left, "node").withColumn("rank", rank)
    # one more place than the theorem asks for, as two shingles of a node could have one hash
    most = F.col("rest") - needed(F.col("size")) + 2
    fewer = F.col("rest") - F.ceil(F.col("size") * F.lit(2 * LEAST) / (100 + LEAST)) + 2
    first = first.filter(F.col("rank") <= most).withColumn("small", F.col("rank") <= fewer)
    rarer = F.collect_list("shingle").over(Window.partitionBy("node").orderBy("n", "shingle").rowsBetween(-RARER, -1))
    first = first.withColumn("rarer", F.when(F.col("rank") <= RARER + 1, rarer)).join(classes, "node")
    return space.stored(first.select("shingle", "node", "size", "label", "rest", "rank", "small", "rarer", "classes"), "first")


def all_pairs(first: DataFrame) -> DataFrame:
    """(a, b): every pair of different labels that can be linked, by exact bounds; and no pair twice.

    Nodes meet in an equi-join on their rare shingles. A shingle that all share, as on pages of one template, is rare to none of them unless they share
    all they may miss. Of each class of shingles no more are common than the node with fewer has.
    """
    names = ("node", "size", "label", "rest", "rank", "rarer", "classes")
    s = first.filter("small").select("shingle", *[F.col(c).alias(f"s_{c}") for c in names])
    t = first.select("shingle", *[F.col(c).alias(f"t_{c}") for c in names])
    fits = f"s_label <> t_label AND (s_size < t_size OR (s_size = t_size AND s_node < t_node)) AND 100 * s_size >= {LEAST} * t_size"
    # of a pair's common shingles the first one counts: behind it there are no more than so many; two more as two shingles could have one hash
    reach = f"{100 + LEAST} * (least(s_rest - s_rank, t_rest - t_rank) + 3) >= {LEAST} * (s_size + t_size)"
    shared = "aggregate(zip_with(s_classes, t_classes, (x, y) -> least(x, y)), 0, (n, x) -> n + x)"
    near = f"{100 + LEAST} * ({shared} + 2) >= {LEAST} * (s_size + t_size)"
    # a pair that has met on a rarer shingle needn't meet again; where that isn't known, distinct sees to it
    once = "(s_rarer IS NULL OR t_rarer IS NULL OR NOT arrays_overlap(s_rarer, t_rarer))"
    return s.join(t, "shingle").filter(f"{fits} AND {reach} AND {once} AND {near}").select(F.least("s_node", "t_node").alias("a"), F.greatest("s_node", "t_node").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """_row, doc_id, n_shingles, component_id, kept, lead of every row of docs (_row, doc_id, text).

    Rows with the same words are one node; component_id is the smallest doc_id of the nodes that links connect (nulls
    aside). Rows without words (null texts too) have n_shingles 0 and are components of their own. kept: doc_id equals component_id, null
    equal to null. lead marks one row of each component: the one with the smallest doc_id, then the smallest _row. An empty table gives an
    empty table; a text of any length is cut into words and shingles piece by piece.

    Nodes that share a band key are candidates. Each bucket compares its smallest node with all others, on the full sets.
    Where that leaves a bucket in more than one component, ``all_pairs`` gives the pairs among the nodes of such buckets that exact bounds don't
    exclude, and they are compared too. So no pair of a bucket goes untested unless links or bounds settle it, and no bucket's pairs are
    ever listed.
    """
    with Workspace(docs.sparkSession) as space:
        thin = space.stored(signatures(docs), "signatures")
        worded = thin.filter("digest IS NOT NULL")
        nodes = space.stored(worded.groupBy("digest").agg(F.min("_row").alias("node"), F.min("doc_id").alias("id"), F.min("n_shingles").alias("size")), "nodes")
        bands = worded.join(nodes.select(F.col("node").alias("_row")), "_row", "left_semi").select(F.col("_row").alias("node"), F.explode("keys").alias("key"))
        bands = space.stored(bands, "bands")
        heads = bands.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        # stored, so that the join deals out both sides itself and can split a hot bucket
        shared = space.stored(bands.join(space.stored(heads, "heads"), "key"), "buckets")
        pairs = space.stored(shared.filter("a <> node").select("a", F.col("node").alias("b")).distinct(), "pairs")
        texts = space.stored(docs.select(F.col("_row").alias("node"), "text").join(shared.select("node").distinct(), "node", "left_semi"), "texts")
        tested = space.stored(verified(pairs, texts, space), "tested")
        links = tested.filter("linked").select("a", "b")
        labels = components(links, space)
        members = shared.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
        members = space.stored(members, "members")
        split = members.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("key")
        unsettled = space.stored(members.join(space.stored(split, "split"), "key").select("node", "label").distinct(), "unsettled")
        if not unsettled.isEmpty():
            rows = space.stored(shingle_rows(texts.join(unsettled.select("node"), "node", "left_semi")), "shingles")
            first = rare_shingles(unsettled.join(nodes.select("node", "size"), "node"), rows, space)
            more = space.stored(all_pairs(first).join(tested.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
            if not more.isEmpty():
                found = space.stored(verified(more, texts, space).filter("linked"), "tested")
                labels = components(links.unionByName(found.select("a", "b")), space)
        named = space.stored(nodes.select("digest", "node", "id").join(labels, "node", "left").select("digest", "id", F.coalesce("label", "node").alias("label")), "named")
        smallest = space.stored(named.groupBy("label").agg(F.min("id").alias("component_id")), "smallest")
        named = space.stored(spread_join(named, smallest, ["label"]).select("digest", "label", "component_id"), "named")
        rows = space.stored(spread_join(worded.select("_row", "doc_id", "n_shingles", "digest"), named, ["digest"]).drop("digest"), "rows")
        leads = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("m")).select(F.col("m._row").alias("_row"), F.lit(True).alias("lead"))
        rows = rows.drop("label").join(leads, "_row", "left").na.fill({"lead": False})
        alone = thin.filter("digest IS NULL").select("_row", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("lead"))
        return stored(rows.unionByName(alone).select("_row", "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "lead"), "near")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of docs from each component, with all columns: the one of the smallest doc_id; of repeated rows, the first.

    Rows without words stay, each of them. Columns besides doc_id and text may have any name but _row.
    """
    rows = numbered(docs)
    found = near_duplicates(rows.select("_row", "doc_id", "text"))
    return rows.join(found.filter("lead").select("_row"), "_row", "left_semi").drop("_row")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM d),
u AS (SELECT r, unnest(sh) AS g FROM s),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM u a JOIN u b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN s x ON x.r = p.a JOIN s y ON y.r = p.b WHERE 100 * n >= 75 * (len(x.sh) + len(y.sh) - n)),
c(r, t) AS (SELECT r, r FROM s UNION SELECT c.r, l.b FROM c JOIN l ON l.a = c.t)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, min(t.doc_id) AS component_id, s.doc_id IS NOT DISTINCT FROM min(t.doc_id) AS kept
FROM s JOIN c ON c.r = s.r JOIN s t ON t.r = c.t GROUP BY s.r, s.doc_id, s.sh
"""
QUERIES = {"op5_near_duplicates": op5_near_duplicates}
ORACLES = {"op5_near_duplicates": ORACLE}
