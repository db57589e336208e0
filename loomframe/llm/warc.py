"""WARC archives: a deterministic sharded writer that commits by manifest, and the reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import HOT_ROWS, HOT_SHARE, Workspace, stored, table

#: Payload bytes that a shard aims at, and the compressed size at which a file is closed.
SHARD_BYTES, FILE_BYTES = 1 << 30, 1 << 30
#: Cells of the histogram of keys that decides the shards: what the driver sees, whatever the table's size.
CELLS = 65_536
#: Digests of repeated payloads that are broadcast at most; with more, the table is joined by shuffling.
BROADCAST_ROWS = 100_000
#: The date that all records carry, so that the same pages give the same bytes.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_value(text: str) -> str:
    """A url as one header line: white space, control and non-ASCII characters percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in text)


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, repr(parts))}>"


def member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member; the same input gives the same bytes."""
    head = [("WARC-Date", DATE), *fields, ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("Content-Length", str(len(block)))]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def page_record(key: object, url: str | None, payload: bytes | None, size: int, digest: str, sha: str, owner: object, number: int) -> bytes:
    """A response with its payload, or (payload None) a revisit of the owner's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    kind = "revisit" if payload is None else "response"
    # the response of a payload can be named from its key and digest alone, wherever it stands
    own = record_id(key, sha) if payload is not None and not number else record_id(key, sha, url, number)
    fields = [("WARC-Type", kind), ("WARC-Record-ID", own)]
    fields += [("WARC-Target-URI", header_value(url))] if url is not None else []
    fields += [("WARC-Payload-Digest", "sha1:" + digest), ("Content-Type", "application/http; msgtype=response")]
    fields += [("X-Page-Id", str(key))] if key is not None else []
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(owner, sha))]
        fields += [("X-Refers-To-Page-Id", str(owner))] if owner is not None else []
    return member(fields, http + (payload or b""))


def opened(root: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(root)


class Roll:
    """The files of one shard under temporary names; finished ones are rows of the manifest."""

    def __init__(self, root: str, shard: int, file_bytes: int):
        self.files, self.path = opened(root)
        self.shard, self.most, self.number, self.out = shard, file_bytes, 0, None

    def add(self, data: bytes) -> Iterator[tuple]:
        if self.out and self.records and self.bytes + len(data) > self.most:
            yield self.close()
        if not self.out:
            self.temp = f".tmp/{uuid.uuid4().hex}"
            self.files.create_dir(f"{self.path}/.tmp", recursive=True)
            self.out, self.bytes, self.records, self.sha = self.files.open_output_stream(f"{self.path}/{self.temp}", compression=None), 0, 0, hashlib.sha256()
            info = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("file", self.shard, self.number)), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            self.write(info)
        self.write(data)
        self.records += 1

    @property
    def name(self) -> str:
        return f"part-{self.shard:06d}-{self.number:05d}.warc.gz"

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def close(self) -> tuple:
        self.out.close()
        row = (self.name, self.temp, self.bytes, self.records, self.sha.hexdigest())
        self.out, self.number = None, self.number + 1
        return row


_MANIFEST = "name string, temp string, bytes long, records long, sha256 string"


def manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["name", "temp", "bytes", "records", "sha256"])


def _sharded(rows: DataFrame, keys: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """rows with their shard, a function of the table alone, and the number of shards.

    The keys' range is cut into CELLS cells of equal width; neighbouring cells fill a shard up to shard_bytes. A cell that is larger is cut into
    several shards by the payloads' digests. Null keys are a cell of their own.
    """
    ends = keys.agg(F.min("key").cast("double").alias("lo"), F.max("key").cast("double").alias("hi")).first()
    lo, width = ends["lo"] or 0.0, max(((ends["hi"] or 0.0) - (ends["lo"] or 0.0)) / CELLS, 1.0)
    cell = F.when(F.col("key").isNull(), -1).otherwise(F.least(F.floor((F.col("key").cast("double") - lo) / width), F.lit(CELLS - 1))).cast("int")
    sizes = sorted((r["cell"], r["bytes"]) for r in keys.groupBy(cell.alias("cell")).agg(F.sum(F.col("size") + 512).alias("bytes")).collect())
    plan, shard, filled = [], 0, 0
    for c, amount in sizes:
        pieces = -(-amount // shard_bytes)
        if filled and filled + amount > shard_bytes:
            shard, filled = shard + 1, 0
        plan.append((c, shard, pieces))
        shard, filled = (shard + pieces, 0) if pieces > 1 else (shard, filled + amount)
    where = F.broadcast(rows.sparkSession.createDataFrame(plan, "_cell int, _first int, _pieces int"))
    placed = rows.withColumn("_cell", cell).join(where, "_cell")
    piece = F.pmod(F.xxhash64("sha", "copy"), F.col("_pieces"))
    return placed.withColumn("shard", (F.col("_first") + piece).cast("int")).drop("_cell", "_first", "_pieces"), shard + bool(filled)


def _with_owners(rows: DataFrame, keys: DataFrame, least_bytes: int, space: Workspace) -> DataFrame:
    """rows with many (other records have the same payload) and owner (the smallest key among them)."""
    equal = keys.filter(F.col("size") >= least_bytes).groupBy("sha").agg(F.count(F.lit(1)).alias("_n"), F.min("key").alias("owner")).filter("_n > 1")
    equal = space.stored(equal, "owners")
    if equal.count() <= BROADCAST_ROWS:
        found = rows.join(F.broadcast(equal), "sha", "left")
    else:
        # payloads of more than a share of the rows, of which there are few, don't go to one task
        hot = keys.count() * HOT_SHARE
        some = rows.join(F.broadcast(equal.filter(F.col("_n") > hot).select("sha", F.col("owner").alias("_owner"), F.lit(True).alias("_hot"))), "sha", "left")
        rest = some.filter("_hot IS NULL").drop("_owner", "_hot").join(equal.filter(F.col("_n") <= hot), "sha", "left")
        found = rest.unionByName(some.filter("_hot").withColumnRenamed("_owner", "owner").withColumn("_n", F.lit(2).cast("long")).drop("_hot"))
    return found.withColumn("many", F.col("_n").isNotNull()).drop("_n")


def _folded(rows: DataFrame, keys: DataFrame, least_bytes: int) -> DataFrame:
    """rows in which (key, payload) pairs of more than a thousandth of the table's rows (so fewer than a thousand pairs) are one row with the
    payload, and numbered copies without it, made from counts; the others as they are, with copy null. Payloads under least_bytes are needed in every
    record and stay."""
    most = max(HOT_ROWS, int(keys.count() * HOT_SHARE))
    hot = F.broadcast(keys.filter(F.col("size") >= least_bytes).groupBy("key", "sha").count().filter(F.col("count") > most).select(F.col("key").alias("_k"), F.col("sha").alias("_s")))
    same = F.col("key").eqNullSafe(F.col("_k")) & (F.col("sha") == F.col("_s"))
    plain = rows.join(hot, same, "left_anti").withColumn("copy", F.lit(None).cast("long"))
    often = rows.join(hot, same, "left_semi")
    first = often.groupBy("key", "sha").agg(F.min("url").alias("url"), F.first("payload").alias("payload"), F.first("sha1").alias("sha1"), F.first("size").alias("size")).withColumn("copy", F.lit(0).cast("long"))
    counts = often.groupBy("key", "sha", "url").agg(F.count(F.lit(1)).alias("_n"), F.first("sha1").alias("sha1"), F.first("size").alias("size"))
    taken = F.broadcast(first.select(F.col("key").alias("_k"), F.col("sha").alias("_s"), F.col("url").alias("_u")))
    left = counts.join(taken, same).withColumn("_n", F.col("_n") - F.col("url").eqNullSafe(F.col("_u")).cast("int")).filter("_n > 0")
    others = left.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).withColumn("payload", F.lit(None).cast("binary"))
    return plain.unionByName(first.select(plain.columns)).unionByName(others.select(plain.columns))


def write_warc(
    pages: DataFrame, root: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, shard_bytes: int = SHARD_BYTES, least_shards: int | None = None, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes a record for each row into WARC files under root, a folder that all executors share, and returns the manifest (name, bytes, records, sha256).
    root is a path or a URI that both Spark and pyarrow's file systems open (file, hdfs, s3, gs).

    Records stand in order of (key, digest, url); shards are ranges of keys of about shard_bytes payload bytes (smaller where the table would
    give fewer than least_shards, the session's shuffle partitions by default), and a shard's file is closed before its compressed size passes file_bytes. So
    for the same rows and parameters files have the same names and bytes, however Spark deals the work. Of records with equal payloads
    (by SHA-256) of least_bytes or more, one of the smallest key is a response and the others revisits of it; null keys come last among them.

    Tasks write under temporary names and give out rows of the manifest; Spark stores the rows of one attempt of each task, a second job renames
    the files they name (again, if it is repeated), and only the stored manifest tells a reader what belongs to the archive. Repeated rows are records of their
    own. Null payloads are empty, null urls have no target. An empty table gives an empty manifest. Nothing is held in memory but one record.
    """
    spark = pages.sparkSession
    with Workspace(spark) as space:
        body = F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary")
        rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), body.alias("payload")).withColumns({"sha": F.sha2("payload", 256), "sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
        keys = space.stored(rows.select("key", "sha", "size"), "keys")
        total = keys.agg(F.sum(F.col("size") + 512)).first()[0] or 0
        least = least_shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed, shards = _sharded(_with_owners(_folded(rows, keys, least_bytes), keys, least_bytes, space), keys, max(1, min(shard_bytes, -(-total // least))))
        order = ["shard", "key", "sha", "copy", "url"]
        # what a revisit's record doesn't hold isn't moved; the key's first row of a payload may be the response
        revisit = F.col("many") & F.col("owner").isNotNull() & ~F.col("key").eqNullSafe(F.col("owner"))
        light = placed.withColumn("payload", F.when(~revisit, F.col("payload")))
        dealt = light.repartitionById(max(1, shards), F.col("shard")).sortWithinPartitions(*order).select("shard", "key", "sha", "copy", "url", "payload", "size", "owner", "many", "sha1")
        manifest = dealt.mapInArrow(_writer(root, file_bytes), _MANIFEST)
        pending = space.stored(manifest, "pending")
        final = pending.repartition(max(1, min(shards, pending.count()))).mapInArrow(_renamer(root), _MANIFEST)
        final.drop("temp").write.mode("overwrite").parquet(f"{root}/_manifest")
        temp = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/.tmp")
        temp.getFileSystem(spark._jsc.hadoopConfiguration()).delete(temp, True)
    return manifest_of(spark, root)


def _writer(root: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, last, number = None, None, 0
        for batch in batches:
            done = []
            columns = [batch.column(c) for c in range(batch.num_columns)]
            for r in range(batch.num_rows):
                shard, key, sha, copy, url, payload, size, owner, many, sha1 = (c[r].as_py() for c in columns)
                if roll is None or roll.shard != shard:
                    done += [roll.close()] if roll else []
                    roll = Roll(root, shard, file_bytes)
                number = number + 1 if (key, sha) == last else 0
                last = (key, sha)
                first = not many or (key == owner and not number and not copy)
                number_ = copy if copy is not None else number
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                done += roll.add(page_record(key, url, payload if first else None, size, digest, sha, owner, number_))
            if done:
                yield manifest_batch(done)
        if roll:
            yield manifest_batch([roll.close()])

    return run


def _renamer(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(root)
        for batch in batches:
            for r in batch.to_pylist():
                temp, name = f"{path}/{r['temp']}", f"{path}/{r['name']}"
                if files.get_file_info(temp).type != arrow_fs.FileType.NotFound:
                    files.move(temp, name)
                elif files.get_file_info(name).size != r["bytes"]:
                    raise FileNotFoundError(f"{name}: neither the temporary nor the final file is there")
            yield batch

    return run


def manifest_of(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("name string, bytes long, records long, sha256 string").parquet(f"{root}/_manifest")


def members(stream, sha=None) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    z, parts, data = zlib.decompressobj(31), [], b""
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                break
            if sha:
                sha.update(data)
        parts.append(z.decompress(data))
        data = b""
        if z.eof:
            yield b"".join(parts)
            data, z, parts = z.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the last member is cut off")


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record; lengths and the block's digest are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(fields["content-length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n" or fields.get("warc-block-digest", "sha1:" + base32_sha1(block)) != "sha1:" + base32_sha1(block):
        raise ValueError(f"damaged record {fields.get('warc-record-id')}")
    return fields, block


_RECORD = "record_type string, record_id string, page_id string, uri string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def read_warc(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """record_type, record_id, page_id, uri, payload_bytes, payload_digest, refers_to (a page_id) and payload (null for revisits, and for all unless
    payloads) of the records in the files that root's manifest names.

    A file is read record by record by one task; sizes and digests of files, blocks and payloads are checked. The digest of a response is that of the payload
    read; a revisit's, and the size of its payload, are those that its header tells.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(root)
        names = [f.split(" ")[0] for f in _RECORD.split(", ")]
        kinds = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 2 + [pa.binary()]
        for batch in batches:
            for wanted in batch.to_pylist():
                rows, held, sha = [], 0, hashlib.sha256()
                with files.open_input_stream(f"{path}/{wanted['name']}", compression=None) as stream:
                    for raw in members(stream, sha):
                        fields, block = parsed(raw)
                        kind = fields["warc-type"]
                        if kind not in ("response", "revisit"):
                            continue
                        http, _, body = block.partition(b"\r\n\r\n")
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        size = next(int(line[16:]) for line in http.decode().split("\r\n") if line.lower().startswith("content-length: "))
                        if kind == "response" and (base32_sha1(body) != digest or len(body) != size):
                            raise ValueError(f"damaged payload of {fields['warc-record-id']}")
                        rows.append((kind, fields["warc-record-id"], fields.get("x-page-id"), fields.get("warc-target-uri"), size, digest, fields.get("x-refers-to-page-id"), body if payloads and kind == "response" else None))
                        held += len(body) if payloads else 0
                        if len(rows) >= 2000 or held >= 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if sha.hexdigest() != wanted["sha256"]:
                    raise ValueError(f"{wanted['name']} isn't the file that the manifest names")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    listed = manifest_of(spark, root).select("name", "sha256")
    return listed.repartition(max(1, listed.count())).mapInArrow(run, _RECORD)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of all pages, written to archives and read back from them.

    Null and empty pages have the empty payload; of repeated rows of a page one at most is a response, the others refer to their own page; a null
    page_id stays null, and is referred to only if all of a payload's pages have none. The archives go when the result is stored.
    """
    with Workspace(spark) as space:
        root = f"{space.folder}/archive"
        write_warc(table(spark, sf_dir, "pages"), root)
        got = read_warc(spark, root, payloads=False)
        return stored(got.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to")), "warc-records")


QUERIES = {"op13_warc": op13_warc}
#: The k-th character of a base-32 digest comes from five bits of two neighbouring hexadecimal digits.
ORACLES = {
    "op13_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS owner, row_number() OVER (PARTITION BY html ORDER BY page_id) AS place FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + (((16 * (strpos('0123456789abcdef', substr(h, (1 + 5 * k // 4)::INTEGER, 1)) - 1) + strpos('0123456789abcdef', substr(h || '0', (2 + 5 * k // 4)::INTEGER, 1)) - 1) >> (3 - 5 * k % 4)::INTEGER) & 31))::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN owner END AS refers_to
FROM q"""
}
