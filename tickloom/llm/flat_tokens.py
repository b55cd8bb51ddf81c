"""Counting documents and tokens in flat token files that have no index.

A flat file is nothing but token ids, an end-of-document id after each document.
It is read in blocks cut anywhere, also inside a document.  Each block is
searched for the end id with numpy and says, without knowing the others, where
its documents end; what a block has before its first end and after its last is
joined to its neighbours' by a running sum over the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.chunks import slices, token_encoder
from tickloom.llm.shared_files import reading, writing
from tickloom.sources.staging import stage

BLOCK_IDS = 1 << 20
#: Blocks that one task scans, one after the other.
TASK_BLOCKS = 16


def write_flat_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One flat file of unsigned 16-bit ids per partition; returns ``key, path, ordinal`` of every document.

    Documents keep the order of their partition.  A null text is an empty document.  Names of special tokens in a text are
    encoded as the characters they are, so a text that spells the end of a document does not end one.  The tokenizer must
    not give ids beyond 65535, nor the end id within a text; both are refused.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, ordinal = token_encoder(tokenizer, plain=True), TaskContext.get().partitionId(), 0
        with writing(folder, f"flat-{part:06d}", ".u16") as (path, stream):
            for batch in batches:
                for piece in slices(batch, "text"):
                    lengths, ids = encode(piece.column("text"))
                    if len(ids) and (int(ids.max()) > 0xFFFF or (ids == end_id).any()):
                        raise ValueError("an id is beyond 16 bits or is the end id itself")
                    stream.write(np.insert(ids, np.cumsum(lengths), end_id).astype("<u2").tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column("key"),
                            pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(lengths), np.int32)), [path]).cast(
                                pa.string()
                            ),
                            pa.array(np.arange(ordinal, ordinal + len(lengths)), pa.int64()),
                        ],
                        ["key", "path", "ordinal"],
                    )
                    ordinal += len(lengths)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return stage(rows.mapInArrow(write, f"key {kind}, path string, ordinal long"), "flat-documents")


def blocks_of(paths: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``path, block, first, ids`` of every block of the files named in ``path``: their sizes are all that is read."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with reading(path) as source:
                    first = np.arange(0, source.size() // 2, block_ids)
                    ids = np.minimum(block_ids, source.size() // 2 - first)
                yield pa.RecordBatch.from_pydict(
                    {"path": [path] * len(first), "block": np.arange(len(first)), "first": first, "ids": ids}
                )

    return paths.select("path").mapInArrow(sized, "path string, block long, first long, ids long")


def scan_blocks(blocks: DataFrame, end_id: int) -> DataFrame:
    """Of every block: its end ids' places in the block, as an array of ints."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with reading(row["path"]) as source:
                    source.seek(2 * row["first"])
                    found = np.flatnonzero(np.frombuffer(source.read(2 * row["ids"]), "<u2") == end_id)
                yield pa.RecordBatch.from_pydict(
                    {
                        **{k: [row[k]] for k in ("path", "block", "first", "ids")},
                        "ends": pa.array([found.astype(np.int32)], pa.list_(pa.int32())),
                    }
                )

    return blocks.mapInArrow(scan, "path string, block long, first long, ids long, ends array<int>")


def document_spans(scanned: DataFrame) -> DataFrame:
    """``path, ordinal, start, n_tokens`` of every document (the end id is not counted).

    A block knows how many documents end in it and where its last one ends; the running sum and maximum of these over
    the file's blocks give its first document's number and start.  Ids after a file's last end id are a document too.
    """
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("path").orderBy(F.desc("block"))
    placed = (
        scanned.withColumn("found", F.size("ends"))
        .withColumn("last_end", F.when(F.col("found") > 0, F.col("first") + F.element_at("ends", -1)))
        .withColumn("ordinal", F.coalesce(F.sum("found").over(before), F.lit(0)))
        .withColumn("start", F.coalesce(F.max("last_end").over(before) + 1, F.lit(0)))
        .withColumn("final", F.row_number().over(last) == 1)
        .withColumn("size", F.col("first") + F.col("ids"))
        .withColumn("open", F.col("final") & (F.coalesce(F.col("last_end") + 1, F.col("start")) < F.col("size")))
    )
    ends = F.transform("ends", lambda e: F.col("first") + e)
    ends = F.when(F.col("open"), F.concat(ends, F.array("size"))).otherwise(ends)
    starts = F.concat(F.array("start"), F.transform("ends", lambda e: F.col("first") + e + 1))
    spans = placed.select("path", "ordinal", starts.alias("start"), ends.alias("end"))
    # The last start has no end in this block, unless the file ends there.
    return (
        spans.select("path", "ordinal", F.posexplode(F.arrays_zip("start", "end")).alias("i", "span"))
        .where("span.end is not null")
        .select(
            "path",
            (F.col("ordinal") + F.col("i")).alias("ordinal"),
            F.col("span.start").alias("start"),
            (F.col("span.end") - F.col("span.start")).alias("n_tokens"),
        )
    )


def token_counts(paths: DataFrame, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``path, ordinal, start, n_tokens`` of every document in the flat files of column ``path``."""
    files = paths.select("path").distinct()
    spread = files.repartition(max(1, files.count()))
    blocks = stage(blocks_of(spread, block_ids), "flat-blocks")
    tasks = max(1, -(-blocks.count() // TASK_BLOCKS))
    # Written, so that its size is known where it is joined: it has a row for each document.
    return stage(document_spans(scan_blocks(blocks.repartition(tasks), end_id)), "flat-spans")
