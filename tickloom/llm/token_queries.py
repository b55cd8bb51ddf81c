"""op2, op3, op10: queries that encode documents with a public tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.flat_tokens import token_counts, write_flat_files
from tickloom.llm.packing import pack_documents
from tickloom.llm.registry import query, table
from tickloom.llm.token_frames import read_token_files, write_token_files
from tickloom.sources.staging import fresh_path

END_OF_TEXT = 50256


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_token_files")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as ids in seekable zstandard files, in order of doc_id, read back."""
    out = fresh_path(spark, "op2-files")
    return read_token_files(
        write_token_files(table(spark, folder, "documents"), out, tokenizer_file("byte_bpe_50k.json"), end_id=2)
    )


@query("op3_token_counts")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, counted in flat files by their separators."""
    out = fresh_path(spark, "op3-files")
    written = write_flat_files(
        table(spark, folder, "documents"), out, tokenizer_file("byte_bpe_50k.json"), END_OF_TEXT
    )
    counts = token_counts(written, END_OF_TEXT)
    return written.join(counts, ["path", "ordinal"]).select(
        F.col("key").alias("doc_id"),
        F.regexp_extract("path", r"flat-(\d+)-", 1).cast("int").alias("file"),
        "ordinal",
        "start",
        "n_tokens",
    )


@query("op10_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Documents packed into sequences of at most 2048 tokens."""
    return pack_documents(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=0)
