"""WARC archives: what is read back against brute force, the same bytes however the work is dealt, damage found."""

import base64
import glob
import gzip
import hashlib
import os
import random
from collections import Counter, defaultdict

import pytest

pytest.importorskip("loomframe.llm")
from loomframe.llm import warc  # noqa: E402

SCHEMA = "page_id long, url string, html string, sha string, owner string"


def pages(seed=1, n=300):
    rng = random.Random(seed)
    bodies = ["".join(rng.choice("abc é\r\n<>") for _ in range(rng.randint(0, 400))) for _ in range(60)] + ["", None]
    rows = [(rng.choice((i, i, i, i - 1)), rng.choice((f"http://a/{i}", f"http://b/ é\r\nX: {i}", None)), rng.choice(bodies), "x", "y") for i in range(n)]
    return rows + [rows[5], rows[5], (None, "u", bodies[0], "x", "y"), (None, "u", "only null", "x", "y"), (None, None, "only null", "x", "y"), (-(10**12), "far", "z" * 100_000, "x", "y")]


def brute(rows, least=0):
    groups = defaultdict(list)
    for k, _, body, *_ in rows:
        groups[(body or "").encode()].append(k)
    out = Counter()
    for body, keys in groups.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        known = [k for k in keys if k is not None]
        owner = min(known) if known else None
        first = True
        for k in keys:
            response = len(body) < least or (k == owner and first)
            first = first and not (k == owner)
            out[(k, len(body), digest, "response" if response else "revisit", None if response else owner)] += 1
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_round_trip(spark, tmp_path, hot, monkeypatch):
    rows = pages()
    if hot:  # one page under one or several urls holds a third of all rows
        rows += [(7, "http://same", "the same", "x", "y")] * 90 + [(7, f"http://{i}", "the same", "x", "y") for i in range(40)]
        monkeypatch.setattr(warc, "HOT_ROWS", 50)
        monkeypatch.setattr(warc, "HOT_SHARE", 0.01)
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 5 if hot else 1000)
    path = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/pages.parquet")
    got = warc.op13_warc(spark, path).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(rows)


def test_files_are_the_same_however_the_work_is_dealt(spark, tmp_path):
    rows = pages(2)
    seen = []
    for parts in (1, 5):
        root = f"{tmp_path}/{parts}"
        made = warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(parts), root, shard_bytes=20_000, file_bytes=4_000, least_bytes=50)
        files = {os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{root}/*.warc.gz")}
        assert {r["name"]: (r["bytes"], r["sha256"]) for r in made.collect()} == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in files.items()}
        assert not os.path.exists(f"{root}/.tmp") and len(files) > 5
        assert all(len(b) <= 4_000 for n, b in files.items() if len(list(gzip.decompress(b).split(b"WARC/1.1"))) > 3)
        seen.append(files)
        back = warc.read_warc(spark, root).collect()
        assert Counter((int(r.page_id) if r.page_id else None, r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None) for r in back) == brute(rows, 50)
        assert all(r.payload is None or len(r.payload) == r.payload_bytes for r in back)
        responses = {r.record_id for r in back if r.record_type == "response"}
        assert len({r.record_id for r in back}) == len(rows) and len(responses) < len(rows)
    assert seen[0] == seen[1]


def test_every_revisit_names_a_response_that_is_there(spark, tmp_path):
    root = str(tmp_path)
    warc.write_warc(spark.createDataFrame(pages(3), SCHEMA), root, shard_bytes=10_000)
    fields = [warc.parsed(raw)[0] for f in glob.glob(f"{root}/*.warc.gz") for raw in warc.members(open(f, "rb"))]
    known = {f["warc-record-id"]: f["warc-payload-digest"] for f in fields if f["warc-type"] == "response"}
    revisits = [f for f in fields if f["warc-type"] == "revisit"]
    assert revisits and all(known[f["warc-refers-to"]] == f["warc-payload-digest"] for f in revisits)


def test_damage_is_found(spark, tmp_path):
    root = str(tmp_path)
    warc.write_warc(spark.createDataFrame([(1, "u", "body " * 50, "", "")], SCHEMA), root)
    [name] = glob.glob(f"{root}/*.warc.gz")
    [info, page] = list(warc.members(open(name, "rb")))
    assert warc.parsed(page)[1].endswith(b"body " * 50)
    with pytest.raises(ValueError):
        warc.parsed(page.replace(b"body body", b"body bodY", 1))
    with open(name, "ab") as f:
        f.write(gzip.compress(page))
    with pytest.raises(Exception, match="isn't the file"):
        warc.read_warc(spark, root).collect()


def test_orphans_of_failed_attempts_are_no_part_of_the_archive(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/.tmp")
    open(f"{root}/.tmp/half", "wb").write(b"half a file")
    open(f"{root}/part-999999-00000.warc.gz", "wb").write(b"older")
    warc.write_warc(spark.createDataFrame([(1, "u", "a", "", ""), (2, "u", "a", "", "")], SCHEMA), root)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_warc(spark, root).collect()) == [("1", "response", None), ("2", "revisit", "1")]


def test_empty_table(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/pages.parquet")
    assert warc.op13_warc(spark, path).collect() == []
