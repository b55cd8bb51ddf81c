"""What a worker process keeps between the tasks of a pipeline's stages."""

import re
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import chunks
from tickloom.llm import near_duplicates as nd
from tickloom.llm import quality
from tickloom.session import TEXT_BATCHES, bound_text_batches


def test_a_worker_keeps_the_encoder_of_one_stage():
    texts = pa.array(["some words, some words"])
    quality.slot_encoder()(texts)
    nd.shingle_sets(texts, 3)
    assert list(chunks._held) == ["word hashes"]
    own = chunks.token_encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert list(chunks._held.values()) == [own]
    assert chunks.token_encoder(public_tokenizers.path("word_bpe_49k.json")) is own
    chunks.forget_encoders()
    assert not chunks._held


@pytest.mark.parametrize("some", [[b"", b"abcdefgh", b"ABCDEFGHabcdefgh"], [b"", b""], []])
def test_cells_are_the_values_of_a_column(some):
    column = pa.array([b"12345678", *some], pa.binary()).slice(1)
    found = nd._cells(column, np.uint64)
    assert [f.tobytes() for f in found] == some
    assert not any(f.flags.owndata for f in found)


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_freed_memory_goes_back_to_the_system():
    def held() -> int:
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Anonymous:\s+(\d+)", f.read())[1]) >> 10

    chunks.forget_encoders()
    blocks = [bytearray(b"x" * 65536) for _ in range(2000)]
    # Every fiftieth stays in use, so the memory between them is not the heap's end.
    kept, full = blocks[::50], held()
    del blocks
    chunks.forget_encoders()
    assert held() < full - 90
    assert len(kept) == 40


def test_batches_of_texts_are_bounded_by_bytes(spark):
    for key in TEXT_BATCHES:
        spark.conf.unset(key)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        bound_text_batches(spark)
        rows = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"size": pa.array([batch.nbytes], pa.int64())})

        assert max(r.size for r in rows.mapInArrow(sizes, "size long").collect()) <= 8 << 20
        spark.conf.set(key, "1234567")
        bound_text_batches(spark)
        assert spark.conf.get(key) == "1234567"
    finally:
        for key in TEXT_BATCHES:
            spark.conf.unset(key)
