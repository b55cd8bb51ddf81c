"""Token ids in files of independent zstandard frames with a trailing seek table.

One document is one frame.  A file is

    frames | skippable frame with the documents' keys | skippable frame with the seek table

The seek table is that of the public seekable format: for each frame its size,
its size decompressed and a checksum (the low 32 bits of the XXH64 of the ids),
then the number of frames and a magic number, so a reader starts at the end of
the file and decompresses only the documents it was asked for.  Any zstandard
tool can decompress a whole file; it skips the two last frames.

Ids are little-endian unsigned 32-bit integers.  A null text has no ids but its
end id.  Rows with equal keys stand one after the other, ordered by a hash of the text; a
null key comes last.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.chunks import slices, token_encoder
from tickloom.llm.shared_files import reading, writing
from tickloom.sources.staging import stage

# Fixed values of the public format.
SKIPPABLE_KEYS, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80

_ENTRY = np.dtype([("size", "<u4"), ("length", "<u4"), ("checksum", "<u4")])
_FOOTER = struct.Struct("<IBI")
_HEADER = struct.Struct("<II")


def checksum(data) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Adds one frame for each document; ``finish`` writes keys and seek table."""

    def __init__(self, stream, level: int = 3):
        self.stream, self.compressor = stream, zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple[int, int, int]] = []
        self.keys: list[int | None] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        data = np.ascontiguousarray(ids, dtype="<u4").tobytes()
        frame = self.compressor.compress(data)
        self.stream.write(frame)
        self.entries.append((len(frame), len(data), checksum(data)))
        self.keys.append(key)

    def finish(self) -> None:
        keys = np.array([0 if k is None else k for k in self.keys], dtype="<i8").tobytes()
        keys += np.array([k is None for k in self.keys], dtype=np.uint8).tobytes()
        table = np.array(self.entries, dtype=_ENTRY).tobytes() + _FOOTER.pack(len(self.entries), CHECKSUMS, SEEKABLE)
        for magic, content in ((SKIPPABLE_KEYS, keys), (SKIPPABLE_SEEK, table)):
            self.stream.write(_HEADER.pack(magic, len(content)) + content)


class FrameReader:
    """Documents of one file, found by its seek table."""

    def __init__(self, source):
        self.source, size = source, source.size()
        frames, flags, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table_size = frames * _ENTRY.itemsize + _FOOTER.size
        table_at = size - table_size - _HEADER.size
        if _HEADER.unpack(self._at(table_at, _HEADER.size)) != (SKIPPABLE_SEEK, table_size):
            raise ValueError("the seek table's frame is damaged")
        self.entries = np.frombuffer(self._at(table_at + _HEADER.size, frames * _ENTRY.itemsize), _ENTRY)
        keys = self._at(table_at - frames * 9, frames * 9)
        self.keys = np.frombuffer(keys[: frames * 8], "<i8")
        self.null = np.frombuffer(keys[frames * 8 :], np.uint8).astype(bool)
        self.starts = np.cumsum(self.entries["size"], dtype=np.int64) - self.entries["size"]
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def frame(self, i: int) -> np.ndarray:
        entry = self.entries[i]
        data = self.decompressor.decompress(
            self._at(int(self.starts[i]), int(entry["size"])), max_output_size=max(1, int(entry["length"]))
        )
        if len(data) != entry["length"] or checksum(data) != entry["checksum"]:
            raise ValueError(f"frame {i} is damaged")
        return np.frombuffer(data, "<u4")

    def documents(self, keys: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """Ids of the documents with these keys; nothing else is decompressed."""
        for i in np.flatnonzero(np.isin(self.keys, np.fromiter(keys, np.int64)) & ~self.null):
            yield int(self.keys[i]), self.frame(int(i))


PARTS = "part long, path string, n_docs long, n_ids long"


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Writes the documents in ascending order of ``key`` and returns the table of files.

    Columns: ``part`` (order of the files), ``path``, ``n_docs``, ``n_ids`` and ``start``, the number of ids in all
    files before.  Rows are dealt by ranges of the key and each task writes one file as its sorted rows come in, so no
    task holds more than one document's frame and the seek table.  Every other column of ``docs`` is left out.  An
    empty table makes no file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, writer, n_ids = token_encoder(tokenizer), TaskContext.get().partitionId(), None, 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with writing(folder, f"part-{part:06d}", ".ids.zst") as (path, stream):
            writer = FrameWriter(stream)
            for batch in _chained(first, batches):
                for piece in slices(batch, "text"):
                    lengths, ids = encode(piece.column("text"))
                    ids = np.insert(ids, np.cumsum(lengths), end_id)
                    ends = np.cumsum(lengths + 1)
                    for k, a, b in zip(piece.column("key").to_pylist(), ends - lengths - 1, ends):
                        writer.add(k, ids[a:b])
                    n_ids += len(ids)
            writer.finish()
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "path": [path], "n_docs": [len(writer.keys)], "n_ids": [n_ids]}
        )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # Hash and number let the rows of one key, a null one too, fill several ranges.
    placed = rows.withColumns({"hash": F.xxhash64("text"), "number": F.monotonically_increasing_id()})
    by = [F.col("key").asc_nulls_last(), F.col("hash"), F.col("number")]
    ordered = placed.repartitionByRange(*by).sortWithinPartitions(*by).select("key", "text")
    files = stage(ordered.mapInArrow(write, PARTS), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _chained(first, rest):
    yield first
    yield from rest


def read_token_files(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files.

    One row of ``files`` is one task's work; frames are read one after the other and their checksums verified.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with reading(path) as source:
                    reader = FrameReader(source)
                    for a in range(0, len(reader.keys), 4096):
                        yield block(reader, a, start)
                        start += int(reader.entries["length"][a : a + 4096].sum()) // 4

    def block(reader: FrameReader, a: int, start: int) -> pa.RecordBatch:
        part = slice(a, min(a + 4096, len(reader.keys)))
        counts = reader.entries["length"][part].astype(np.int64) // 4
        crcs = [zlib.crc32(reader.frame(i).tobytes()) for i in range(part.start, part.stop)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(reader.keys[part], pa.int64(), mask=reader.null[part]),
                pa.array(start + np.cumsum(counts) - counts, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(crcs, pa.int64()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    tasks = max(1, files.count())
    return files.repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
