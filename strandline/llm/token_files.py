"""Token-id files of bit- or byte-shuffled blocks, written and read by tasks.

File: magic, compressed blocks, then a compressed table of documents and one of chunks, then their
places and sizes and the magic again. A block holds ``BLOCK`` ids as little-endian 32-bit values,
transposed into 4 byte planes or 32 bit planes; each plane is compressed by itself with zstandard,
so planes without content cost a few bytes. The chunk table has a row per plane: offset, size.
The document table has, in order, each document's id, whether it is null, and its number of ids.

``write`` deals documents by range of doc_id (then of a hash of the text and of the input's
order, so that one frequent id is dealt to many files), sorts each part and writes it as files of
about ``file_ids`` ids and at most about ``file_docs`` documents, in order, under names that no other attempt uses. So what a task
holds of a file (its document and chunk tables, on either side) follows these bounds and not the size of a part. Only files named in the returned manifest count, so
lost or repeated tasks leave at most unread files. Null texts count as empty: they have the end
id only. Null doc_ids come first. An empty table gives an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm import bpe

MAGIC, BLOCK, LEVEL = b"SLPLANE1", 1 << 16, 3
MAX_WORDS = 1_000_000  # of the tasks' dictionaries
FILE_IDS, FILE_DOCS = 1 << 26, 1 << 20  # a file is closed behind the group of texts that reaches one of them
FOOTER = "<QQQQIIQ"  # documents' place, size; chunks' place, size; block size, planes, ids


def planes_of(ids: np.ndarray, planes: int) -> list[bytes]:
    """The planes of a block: 4 of bytes or 32 of bits, lowest first."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if planes == 4:
        return [np.ascontiguousarray(o).tobytes() for o in octets]
    return [np.packbits((o >> b) & 1).tobytes() for o in octets for b in range(8)]


def ids_of(planes: list[bytes], count: int) -> np.ndarray:
    octets = np.zeros((count, 4), np.uint8)
    if len(planes) == 4:
        for k, plane in enumerate(planes):
            octets[:, k] = np.frombuffer(plane, np.uint8)
    else:
        for k, plane in enumerate(planes):
            octets[:, k // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=count) << (k % 8)
    return octets.reshape(-1).view("<u4")


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://"))


class _Writer:
    def __init__(self, out, planes: int, name: str):
        import zstandard

        self.out, self.planes, self.name, self.pack = out, planes, name, zstandard.ZstdCompressor(level=LEVEL)
        self.at = out.write(MAGIC)
        self.held, self.size, self.total = [], 0, 0
        self.chunks, self.docs = [], []

    def add(self, names: list, ids: list[np.ndarray]) -> None:
        self.docs += [(n or 0, n is None, len(i)) for n, i in zip(names, ids)]
        self.held += ids
        self.size += sum(map(len, ids))
        while self.size >= BLOCK:
            flat = np.concatenate(self.held)
            for start in range(0, len(flat) - BLOCK + 1, BLOCK):
                self._block(flat[start : start + BLOCK])
            rest = flat[len(flat) - len(flat) % BLOCK :]
            self.held, self.size = [rest], len(rest)

    def _put(self, data: bytes) -> tuple[int, int]:
        place = self.at
        self.out.write(data)
        self.at += len(data)
        return place, len(data)

    def _block(self, ids: np.ndarray) -> None:
        self.chunks += [self._put(self.pack.compress(p)) for p in planes_of(ids, self.planes)]
        self.total += len(ids)

    def close(self) -> None:
        if self.size:
            self._block(np.concatenate(self.held))
        docs = np.array(self.docs, np.dtype([("id", "<i8"), ("null", "?"), ("n", "<i8")]))
        places = self._put(self.pack.compress(docs.tobytes())) + self._put(self.pack.compress(np.array(self.chunks, "<u8").tobytes()))
        self.out.write(struct.pack(FOOTER, *places, BLOCK, self.planes, self.total) + MAGIC)


def write(docs: DataFrame, stage, tokenizer: str, folder: str, end_id: int = 1, text: str = "text", planes: int = 4, parts: int | None = None,
          file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS, group: int = 2 * bpe.GROUP) -> DataFrame:
    """Write the files below ``folder`` (shared by all executors); the manifest: part, file (its number in the part), path, n_docs, n_ids, start.

    Texts are encoded ``group`` bytes at a time; a file ends with the group that reaches one of its bounds.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = ["doc_id", "h", "u"]
    dealt = body.withColumns({"h": F.xxhash64("text"), "u": F.monotonically_increasing_id()})
    dealt = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, writer, stop = bpe.kept(bpe.Chunks, tokenizer, False, MAX_WORDS), None, np.array([end_id], np.uint32)
        files, path = _open(folder)
        part, number = TaskContext.get().partitionId(), 0

        def closed() -> pa.RecordBatch:
            writer.close()
            writer.out.close()
            names = ["part", "file", "path", "n_docs", "n_ids"]
            return pa.RecordBatch.from_pylist([dict(zip(names, (part, number, f"{folder}/{writer.name}", len(writer.docs), writer.total)))])

        for batch in batches:
            for names, texts in bpe.in_groups(batch, group):
                if writer is None:
                    files.create_dir(path, recursive=True)
                    name = f"part-{part:06d}-{number:06d}-{uuid.uuid4().hex}.planes"
                    writer = _Writer(files.open_output_stream(f"{path}/{name}"), planes, name)
                writer.add(names, [np.append(i, stop) for i in chunks.encode(texts)])
                if writer.total + writer.size >= file_ids or len(writer.docs) >= file_docs:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()

    done = dealt.mapInArrow(run, "part long, file long, path string, n_docs long, n_ids long")
    # one row per file
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return stage(done).withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(files, path: str) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Documents of a file, some at a time: ids, which are null, and their token ids as little-endian bytes."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    with files.open_input_file(path) as f:
        tail = struct.calcsize(FOOTER) + len(MAGIC)
        size = f.size()
        end = f.read_at(tail, size - tail)
        if end[-len(MAGIC) :] != MAGIC or f.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no complete token file")
        docs_at, docs_size, chunks_at, chunks_size, block, planes, total = struct.unpack(FOOTER, end[: -len(MAGIC)])
        docs = np.frombuffer(unpack.decompress(f.read_at(docs_size, docs_at)), np.dtype([("id", "<i8"), ("null", "?"), ("n", "<i8")]))
        places = np.frombuffer(unpack.decompress(f.read_at(chunks_size, chunks_at)), "<u8").reshape(-1, planes, 2)
        held, left, at = [], 0, 0
        for k, chunk in enumerate(places):
            count = min(block, total - k * block)
            first, last = chunk[0, 0], chunk[-1, 0] + chunk[-1, 1]
            data = f.read_at(int(last - first), int(first))
            held.append(ids_of([unpack.decompress(data[int(a - first) : int(a - first + n)]) for a, n in chunk], count))
            left += count
            upto = at
            need = 0
            while upto < len(docs) and need + docs["n"][upto] <= left:
                need += int(docs["n"][upto])
                upto += 1
            if upto > at:
                flat = np.concatenate(held)
                bounds = np.concatenate(([0], np.cumsum(docs["n"][at:upto])))
                yield docs["id"][at:upto], docs["null"][at:upto], [flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                held, left, at = [flat[need:]], left - need, upto


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), ids (binary, little-endian 32-bit), from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = _open(row["path"])
                start = row["start"]
                for names, null, ids in _read(files, path):
                    sizes = np.array([len(i) // 4 for i in ids], np.int64)
                    starts = start + np.cumsum(sizes) - sizes
                    start += int(sizes.sum())
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64(), mask=null), pa.array(starts), pa.array(ids, pa.binary())], ["doc_id", "start", "ids"])

    files = max(1, manifest.count())  # a fixed number, or adaptive execution would put the few bytes of the manifest into one task
    return manifest.select("path", "start", "part", "file").repartition(files, "part", "file").mapInArrow(run, "doc_id long, start long, ids binary")
