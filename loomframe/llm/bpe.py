"""Byte-level BPE with reuse of content-defined chunks."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loomframe.llm.common import table

#: A chunk ends where the rolling hash of the last bytes has CUT_BITS zero bits (about 2 kB on average), wherever that is ...
HASH_BYTES, CUT_BITS = 8, 11
#: ... and a worker keeps two generations of chunks of so many bytes each; the older one goes when the younger one is full.
CACHE_BYTES = 12 << 20
#: Bytes of text that are hashed at once.
SLICE_BYTES = 4 << 20
#: Texts with other characters than these go through the tokenizers library itself, chunk by chunk.
_COMMON = re.compile("[^\x00-\u2fff]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, and the others as the letters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBPE:
    """Ids as the tokenizers library gives them for the same file; bytes of every id."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.load(open(path))  # noqa: SIM115
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for piece, i in vocab.items():
            self.table[i] = piece.encode() if piece in self.special else bytes(letters[c] for c in piece)
        for piece, i in self.special.items():
            self.table[i] = piece.encode()
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        # ids in merge order: merging by rank is then the same as merging by id
        self.ranked = all(vocab[m] == 256 + i for i, m in enumerate(merges)) and all(t["id"] >= 256 + len(merges) for t in spec["added_tokens"])
        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ranks = {self.table[i]: i for i in vocab.values() if i < 256 + len(merges)}
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special) if self.ranked else None

    def encode(self, text: str) -> list[int]:
        if self.fast is None or (not text.isascii() and _COMMON.search(text)):
            return self.exact.encode(text, add_special_tokens=False).ids
        if any(x in text for x in self.special):
            return self.fast.encode(text, allowed_special="all")
        return self.fast.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text; ids that don't form characters become U+FFFD."""
        raw = self.fast.decode_bytes(ids) if self.fast else b"".join([self.table[i] for i in ids])
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


def utf8_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data, offsets


def cut_points(data: np.ndarray) -> np.ndarray:
    """Where chunks of data begin, apart from 0: content-defined, at any character. A hash of the HASH_BYTES before a place takes one in 2 ** CUT_BITS."""
    n = len(data)
    if n < 2 * HASH_BYTES:
        return np.empty(0, np.int64)
    window = np.ndarray((n - HASH_BYTES,), "<u8", data, strides=(1,))
    window = (window ^ (window >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    at = np.flatnonzero(window >> np.uint64(64 - CUT_BITS) == 0) + HASH_BYTES
    return at[(data[at] & 0xC0) != 0x80]


#: Where every tokenization splits, whatever stands around: before white space that follows a printable ASCII character.
_SAFE = re.compile(rb"(?<=[\x21-\x7E])[\x20\t\r\n]")
_SAFE_LAST = re.compile(rb"(?s).*[\x21-\x7E](?=[\x20\t\r\n])")


@dataclass
class Chunk:
    """ids of a chunk that was encoded by itself, the text they decode to (before, in and behind its certain part), and its certain part, from ids[head] to ids[tail] (bytes first to last):
    between two places where every tokenization splits. A chunk without two such places has no certain part."""

    ids: np.ndarray
    decoded: tuple[bytes, bytes, bytes]
    head: int
    tail: int
    first: int
    last: int


class ChunkCoder:
    """Encodes texts chunk by chunk; a chunk that was met before, in any text of this worker, isn't encoded again.

    Chunks end anywhere, so the ids around a join of two chunks can be others than those of the text. They are repaired: the window around the join grows, to
    the left and to the right, until at both ends it reaches a place where every tokenization splits; outside of it the chunks' own ids are
    exact, and the window is encoded anew. A chunk without such a place goes into the window whole. Windows are kept like chunks.
    """

    def __init__(self, bpe: ByteBPE, decode: bool = False):
        self.bpe, self.decode = bpe, decode
        self.young: dict = {}
        self.old: dict = {}
        self.held = self.encoded = self.reused = self.repaired = 0

    def _kept(self, key: tuple | bytes, make: Callable[[], tuple[object, int]]) -> object:
        entry = self.young.get(key)
        if entry is not None:
            self.reused += 1
            return entry[0]
        entry = self.old.get(key)
        if entry is None:
            entry = make()
            self.encoded += 1
        else:
            self.reused += 1
        self.held += entry[1]
        if self.held > CACHE_BYTES:
            self.young, self.old, self.held = {}, self.young, entry[1]
        self.young[key] = entry
        return entry[0]

    def _code(self, raw: bytes) -> tuple[list[int], bytes]:
        ids = self.bpe.encode(raw.decode())
        return ids, self.bpe.decode(ids) if self.decode else b""

    def _window(self, raw: bytes) -> tuple[np.ndarray, bytes]:
        def make() -> tuple[object, int]:
            ids, decoded = self._code(raw)
            return (np.array(ids, np.uint32), decoded), len(raw) * 3 + 300

        return self._kept((raw,), make)

    def _chunk(self, raw: bytes) -> Chunk:
        def make() -> tuple[object, int]:
            ids = self.bpe.encode(raw.decode())
            a, b = _SAFE.search(raw), _SAFE_LAST.match(raw)
            out = Chunk(np.array(ids, np.uint32), (b"", b"", b""), 0, 0, 0, 0)
            if a and b.end() > a.start():
                edges = np.cumsum([0, *[len(self.bpe.table[i]) for i in ids]])
                head, tail = np.searchsorted(edges, (a.start(), b.end())).tolist()
                # an end between two ids; bytes that an id doesn't hold as they are leave the chunk without a certain part
                if edges[-1] == len(raw) and edges[head] == a.start() and edges[tail] == b.end():
                    out.head, out.tail, out.first, out.last = head, tail, a.start(), b.end()
            if self.decode:
                # places where every tokenization splits are between characters
                out.decoded = tuple(self.bpe.decode(part) for part in (ids[: out.head], ids[out.head : out.tail], ids[out.tail :]))
            return out, len(raw) * 3 + 500

        return self._kept(raw, make)

    def _joined(self, chunks: list[bytes]) -> tuple[np.ndarray, bytes]:
        if len(chunks) == 1:
            one = self._chunk(chunks[0])
            return one.ids, b"".join(one.decoded)
        ids: list[np.ndarray] = []
        decoded: list[bytes] = []
        window = b""

        def close() -> None:
            nonlocal window
            if window:
                got = self._window(window)
                ids.append(got[0])
                decoded.append(got[1])
                self.repaired += 1
            window = b""

        for k, raw in enumerate(chunks):
            chunk = self._chunk(raw)
            left, right = k == 0, k == len(chunks) - 1
            if chunk.tail == chunk.head:
                window += raw
                continue
            # the text's own ends need no repair
            head, first = (0, 0) if left else (chunk.head, chunk.first)
            tail, last = (len(chunk.ids), len(raw)) if right else (chunk.tail, chunk.last)
            window += raw[:first]
            close()
            ids.append(chunk.ids[head:tail])
            decoded.append(b"".join(chunk.decoded[0 if left else 1 : 3 if right else 2]))
            window = raw[last:]
        close()
        return np.concatenate(ids) if ids else np.empty(0, np.uint32), b"".join(decoded)

    def texts(self, column: pa.Array) -> Iterator[tuple[np.ndarray, bytes]]:
        """(ids, decoded text) of each text, in order."""
        data, offsets = utf8_buffers(column)
        i = 0
        while i < len(offsets) - 1:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES)))
            j = min(j, len(offsets) - 1)
            base = int(offsets[i])
            part = data[base : int(offsets[j])]
            cuts = cut_points(part)
            for k in range(i, j):
                start, end = int(offsets[k]) - base, int(offsets[k + 1]) - base
                inner = cuts[np.searchsorted(cuts, start, "right") : np.searchsorted(cuts, end)].tolist()
                edges = [start, *inner, end]
                if end > start:
                    yield self._joined([part[a:b].tobytes() for a, b in zip(edges, edges[1:])])
                else:
                    yield np.empty(0, np.uint32), b""
            i = j


@lru_cache(maxsize=4)
def coder(path: str, decode: bool) -> ChunkCoder:
    """One for each file and worker process: what a task has encoded, later tasks of the worker find."""
    return ChunkCoder(load(path), decode)


def map_tokens(docs: DataFrame, rows: Callable, schema: str, path: str | None = None, decode: bool = False) -> DataFrame:
    """Runs rows(doc_ids, [(ids, decoded), ...]) -> list of columns over batches of (doc_id, text)."""
    path = path or default_path()
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = coder(path, decode)
        for batch in batches:
            step = 500
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                columns = rows(part.column(0).to_pylist(), shared.texts(part.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def bpe_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    Null and empty texts have no ids; repeated rows are encoded alike; an empty table gives an empty table; texts may have any length. Other
    columns of docs aren't read.
    """

    def rows(doc_ids: list, coded: Iterator[tuple[np.ndarray, bytes]]) -> list[list]:
        n, ids_sha, text_sha = [], [], []
        for ids, decoded in coded:
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            text_sha.append(hashlib.sha256(decoded).hexdigest())
        return [doc_ids, n, ids_sha, text_sha]

    return map_tokens(docs, rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", path, decode=True)


def encode_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) of every row."""

    def rows(doc_ids: list, coded: Iterator[tuple[np.ndarray, bytes]]) -> list[list]:
        return [doc_ids, [ids.astype(np.int32) for ids, _ in coded]]

    return map_tokens(docs, rows, "doc_id long, ids array<int>", path)


def decode_ids(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of rows of (doc_id, ids); null ids give a null text."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [None if ids is None else bpe.decode(ids).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


QUERIES = {"op10_bpe": op10_bpe}
ORACLES: dict[str, str] = {}
