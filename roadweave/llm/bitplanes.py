"""Token ids in files of compressed bit planes, with an index of their chunks.

A file is a row of a table: documents in ascending doc_id order, their ids end to end, cut into chunks of a fixed number
of ids. A chunk's ids are transposed into planes, plane k holding bit k of every id, and each plane is compressed by
itself; planes that are zero throughout take no bytes. Layout of a file, little-endian:

    magic "BPL1", ids per chunk (u4), chunks (u4), documents (u4)
    for each document: ids (u4)
    for each chunk (the index): offset of its bytes after the header (u8), ids (u4), crc32 of its ids (u4), and of
        each of the 32 planes the compressed length (u4)
    the planes' bytes
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.bpe import runs
from roadweave.llm.common import text_of
from roadweave.llm.pretokens import Coder, known
from roadweave.sources.tables import materialize

MAGIC = b"BPL1"
CHUNK_IDS = 1 << 16
FILE_IDS = 1 << 22  # a file ends with the document that reaches so many ids
LEVEL = 3
PLANES = 32
_HEAD, _CHUNK = struct.Struct("<4sIII"), struct.Struct(f"<QII{PLANES}I")


def planes_of(ids: np.ndarray) -> list[bytes]:
    """Bit k of every id, packed, for each k."""
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return [plane.tobytes() if plane.any() else b"" for plane in packed]


def ids_of(planes: list[bytes], n: int) -> np.ndarray:
    packed = np.zeros((PLANES, -(-n // 8)), dtype=np.uint8)
    for k, plane in enumerate(planes):
        if plane:
            packed[k] = np.frombuffer(plane, dtype=np.uint8)
    bits = np.unpackbits(packed, axis=1, bitorder="little")[:, :n]
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").reshape(-1).view("<u4")


def pack(documents: list[np.ndarray], chunk_ids: int = CHUNK_IDS) -> bytes:
    """A file of these documents' ids."""
    ids = np.concatenate(documents).astype("<u4") if documents else np.zeros(0, dtype="<u4")
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    index, body, at = [], [], 0
    for start in range(0, len(ids), chunk_ids):
        part = ids[start : start + chunk_ids]
        coded = [squeeze.compress(plane) if plane else b"" for plane in planes_of(part)]
        index.append(_CHUNK.pack(at, len(part), zlib.crc32(part.tobytes()), *map(len, coded)))
        body += coded
        at += sum(map(len, coded))
    lengths = np.array([len(d) for d in documents], dtype="<u4").tobytes()
    return b"".join([_HEAD.pack(MAGIC, chunk_ids, len(index), len(documents)), lengths, *index, *body])


def read_chunk(file: bytes, chunk: int) -> np.ndarray:
    """The ids of one chunk; nothing else of the file is decompressed."""
    magic, _, chunks, documents = _HEAD.unpack_from(file)
    if magic != MAGIC or not 0 <= chunk < chunks:
        raise ValueError("not a file of bit planes, or no such chunk")
    index = _HEAD.size + 4 * documents
    at, n, check, *lengths = _CHUNK.unpack_from(file, index + chunk * _CHUNK.size)
    at += index + chunks * _CHUNK.size
    expand, planes = zstandard.ZstdDecompressor(), []
    for length in lengths:
        planes.append(expand.decompress(file[at : at + length]) if length else b"")
        at += length
    ids = ids_of(planes, n)
    if zlib.crc32(ids.tobytes()) != check:
        raise ValueError("a chunk's ids don't match their checksum")
    return ids


def unpack(file: bytes) -> list[np.ndarray]:
    """The ids of every document of a file."""
    _, _, chunks, documents = _HEAD.unpack_from(file)
    lengths = np.frombuffer(file, dtype="<u4", count=documents, offset=_HEAD.size)
    ids = np.concatenate([read_chunk(file, k) for k in range(chunks)]) if chunks else np.zeros(0, dtype="<u4")
    return np.split(ids, np.cumsum(lengths, dtype=np.int64)[:-1]) if documents else []


@functools.cache
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def plain(text: str) -> bool:
    """Every code point is one that all Unicode tables at hand class alike."""
    return text.isascii() or bool(known()[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)].all())


def odd(run: list[str]) -> list[int]:
    """Which texts of a run aren't plain. The run is looked at as a whole first, as next to all are."""
    return [] if plain("".join(run)) else [i for i, text in enumerate(run) if not plain(text)]


class Library:
    """Ids of many pre-tokens as the tokenizers library encodes them.

    The library splits texts by the same pattern before it merges, so a pre-token's ids don't depend on the rest.
    Texts with code points that its Unicode tables may class differently are encoded as wholes.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _library(path)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def __call__(self, pieces_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces_], add_special_tokens=False)]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(counts.sum())), counts


REMEMBERED = 1_000_000  # pre-tokens a worker remembers, about


@functools.cache
def _coder(path: str) -> Coder:
    """A worker's pre-tokens, kept from task to task; what is remembered changes no result."""
    return Coder(Library(path), REMEMBERED)


FILES = "part int, seq int, n_ids long, doc_ids array<long>, content binary"


def _writer(path: str, end_id: int, chunk_ids: int, file_ids: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder = TaskContext.get().partitionId(), _coder(path)
        names, documents, held, seq = [], [], 0, 0

        def file() -> pa.RecordBatch:
            columns = [
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([held], pa.int64()),
                pa.array([names], pa.list_(pa.int64())), pa.array([pack(documents, chunk_ids)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["part", "seq", "n_ids", "doc_ids", "content"])

        for batch in batches:
            ids, at = batch.column("doc_id").to_pylist(), 0
            for run in runs(batch.column("text").to_pylist()):
                coded, counts = coder.code(run)
                # the end id goes behind each text's ids in one array, of which the documents are views
                ends = np.cumsum(counts + 1)
                room = np.full(int(ends[-1]), end_id, dtype="<u4")
                mine = np.ones(len(room), dtype=bool)
                mine[ends - 1] = False
                room[mine] = coded
                own = np.split(room, ends[:-1])
                for i in odd(run):
                    own[i] = np.append(coder.encode.whole(run[i]), end_id).astype("<u4")
                for document in own:
                    names.append(ids[at])
                    documents.append(document)
                    at += 1
                    held += len(document)
                    if held >= file_ids:
                        yield file()
                        names, documents, held, seq = [], [], 0, seq + 1
        if names:
            yield file()

    return work


def write_files(docs: DataFrame, path: str, end_id: int, chunk_ids: int = CHUNK_IDS, file_ids: int = FILE_IDS) -> DataFrame:
    """The table of files (part, seq, n_ids, doc_ids, content), written to the shared folder.

    Rows are dealt out by ranges of doc_id (nulls first) and sorted by doc_id, then a digest of the text; a file never spans
    two ranges, and files in order of part and seq hold all documents in order. Rows that share a doc_id, or have none, are
    dealt on by the digest and the place they are read from, so repeated rows don't all meet in one range. Null texts have
    the end id alone, repeated rows stand as often as they come, and an empty table gives no file.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumns(
        {"digest": F.xxhash64("text"), "place": F.monotonically_increasing_id()}
    )
    ordered = rows.repartitionByRange("doc_id", "digest", "place").sortWithinPartitions("doc_id", "digest", "place")
    return materialize(ordered.select("doc_id", "text").mapInArrow(_writer(path, end_id, chunk_ids, file_ids), FILES))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            documents = unpack(batch.column("content")[i].as_py())
            lengths = np.array([len(d) for d in documents], dtype=np.int64)
            n = len(documents)
            columns = [
                pa.array(np.full(n, batch.column("part")[i].as_py(), dtype=np.int32)),
                pa.array(np.full(n, batch.column("seq")[i].as_py(), dtype=np.int32)),
                batch.column("doc_ids")[i].values, pa.array(np.cumsum(lengths) - lengths), pa.array(lengths),
                pa.array(np.array([zlib.crc32(d.tobytes()) for d in documents], dtype=np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"])


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the contents of the files.

    A file's first position is the sum of the ids of the files before it: summed by part first, then within a part.
    """
    sizes = files.select("part", "seq", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("file_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.col("file_start")).alias("first")
    )
    read = files.mapInArrow(_read, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return read.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )
