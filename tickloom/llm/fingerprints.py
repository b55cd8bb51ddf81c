"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes of the UTF-8 text ends a chunk wherever it
is 0 modulo the block size, so an edit changes the chunks it touches and no
others.  Every chunk gives one character of a signature, made from a hash of the
whole chunk.  The block size is a power of two that follows from the length
alone; a fingerprint holds the signature at that size and at twice the size:

    block size : signature : signature at twice the size

Fingerprints are compared where their block sizes agree, which they do up to a
factor of two in length, by the edit distance of the signatures: 1 less the
insertions and deletions in proportion to both lengths.  Signatures that share
no run of characters are taken to be unlike, as chance matches are all they have.

All bytes of a slice of texts are hashed at once with numpy, and the edit
distances of many pairs run side by side, one bit of a word for each character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.chunks import slices

WINDOW = 7
#: Characters of a signature at most; the last one stands for all the rest of the text.
LONGEST = 64
#: Chunks that a block size aims at, at most.
AIM = 44
#: Equal characters in a row that two signatures need to be compared at all.
RUN = 4
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)

SLICE_CHARS = 1 << 20
#: Characters of text that one task takes, about, and how many such ranges there are at most.
RANGE_CHARS, MOST_RANGES = 2 << 20, 1 << 16

_ROLL, _MIX, _BASE = np.uint32(0x01000193), np.uint32(0x85EBCA6B), 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers, _inverse = tables
    return _powers[:n], _inverse[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def block_sizes(lengths: np.ndarray) -> np.ndarray:
    """Exponent of the smallest power of two that gives at most ``AIM`` chunks on the average."""
    return np.ceil(np.log2(np.maximum(lengths, 1) / AIM)).clip(0).astype(np.int64)


def fingerprints(texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Fingerprints, block-size exponents, and both signatures as (texts, 2, LONGEST) characters, 0 after the end."""
    n = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    exponents = block_sizes(sizes)
    signatures = np.zeros((n, 2, LONGEST), np.uint8)
    # Zero bytes before every text, so that no window reaches into the text before it.
    data = np.frombuffer(b"".join([b"\0" * WINDOW + t for t in texts]), np.uint8)
    if sizes.any():
        ends = np.cumsum(sizes + WINDOW)
        starts = ends - sizes
        rolled = np.zeros(len(data), np.uint32)
        padded = np.concatenate([np.zeros(WINDOW, np.uint8), data])
        for k in range(WINDOW):
            rolled *= _ROLL
            rolled += padded[k + 1 : k + 1 + len(data)]
        rolled ^= rolled >> np.uint32(15)
        rolled *= _MIX
        rolled ^= rolled >> np.uint32(13)
        powers, inverse = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
        for level in (0, 1):
            mask = ((np.uint32(1) << (exponents + level).astype(np.uint32)) - np.uint32(1)).astype(np.uint32)
            cut = (rolled & np.repeat(mask, sizes + WINDOW)) == 0
            cut[ends[sizes > 0] - 1] = True  # what is left is a chunk too
            at = np.flatnonzero(cut)
            owner = np.searchsorted(ends, at, side="right")
            inside = at >= starts[owner]
            at, owner = at[inside], owner[inside]
            number = np.arange(len(at)) - np.searchsorted(owner, np.arange(n))[owner]
            total = np.bincount(owner, minlength=n)
            keep = (number < LONGEST - 1) | (number == total[owner] - 1)
            at, owner, number = at[keep], owner[keep], np.minimum(number[keep], LONGEST - 1)
            begin = np.where(number == 0, starts[owner], np.concatenate(([0], at[:-1] + 1)))
            chunk = (sums[at + 1] - sums[begin]) * inverse[begin]
            signatures[owner, level, number] = ALPHABET[(_mixed(chunk) >> np.uint64(58)).astype(np.int64)]
    names = []
    for e, pair in zip(exponents.tolist(), signatures):
        one, two = (bytes(s).rstrip(b"\0").decode() for s in pair)
        names.append(f"{1 << e}:{one}:{two}")
    return names, exponents, signatures


def _same_run(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Whether the signatures share ``RUN`` characters in a row, or a third of the shorter one if that is less."""
    need = np.clip(np.minimum(la, lb) // 3, 1, RUN)
    best = np.zeros(len(a), np.int64)
    equal = (a[:, :, None] == b[:, None, :]) & (a != 0)[:, :, None]
    runs = equal.astype(np.int8)
    for i in range(1, runs.shape[1]):
        runs[:, i, 1:] += runs[:, i - 1, :-1] * runs[:, i, 1:]
    best = runs.reshape(len(a), -1).max(axis=1)
    return best >= need


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair of signatures, all pairs side by side."""
    weights = np.uint64(1) << np.arange(LONGEST, dtype=np.uint64)
    row = np.full(len(a), ~np.uint64(0), np.uint64)
    for j in range(LONGEST):
        matches = ((a == b[:, j, None]) & (a != 0)) @ weights
        hit = row & matches
        row = (row + hit) | (row - hit)
    return np.bitwise_count(~row).astype(np.int64)


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    la, lb = (a != 0).sum(axis=1), (b != 0).sum(axis=1)
    out = np.zeros(len(a))
    for i in range(0, len(a), 512):
        part = slice(i, i + 512)
        shared = _common(a[part], b[part])
        score = 2 * shared / np.maximum(la[part] + lb[part], 1)
        out[part] = np.where(_same_run(a[part], b[part], la[part], lb[part]), score, 0.0)
    return out


def likeness(first, second) -> np.ndarray:
    """Likeness from 0 to 1 of pairs of fingerprints, given as ``fingerprints`` returns them.

    Equal fingerprints are 1 alike; an empty text is like another empty one and nothing else.
    """
    (names_a, ea, sa), (names_b, eb, sb) = first, second
    out = np.zeros(len(names_a))
    difference = ea - eb
    for shift, pairs in ((0, ((0, 0), (1, 1))), (1, ((0, 1),)), (-1, ((1, 0),))):
        rows = np.flatnonzero(difference == shift)
        for x, y in pairs:
            if len(rows):
                out[rows] = np.maximum(out[rows], _alike(sa[rows, x], sb[rows, y]))
    same = np.fromiter((x == y for x, y in zip(names_a, names_b)), bool, len(names_a))
    return np.where(same, 1.0, out)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first half as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(keys: list, texts: list[str]) -> pa.RecordBatch:
    """Rows of all texts but the last, which is only the next one of the one before."""
    count = len(texts) - 1
    plain = [t.encode() for t in texts]
    changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:])]
    own, new = fingerprints(plain), fingerprints(changed)
    this = tuple(x[:count] for x in own)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys[:count], pa.int64()),
            pa.array([len(t) for t in texts[:count]], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
            pa.array(this[0], pa.string()),
            pa.array(new[0], pa.string()),
            pa.array(likeness(this, new)),
            pa.array(likeness(this, tuple(x[1:] for x in own))),
        ],
        [c.split()[0] for c in RESULT.split(", ")],
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the documents of each range, which come in order, the first one after the range as the last."""
    keys, texts, chars, current, opening, closed = [], [], 0, None, None, False

    def rest() -> Iterator[pa.RecordBatch]:
        if texts and not closed:  # the only range: after the last document comes its first
            keys.append(opening[0])
            texts.append(opening[1])
        if len(texts) > 1:
            yield _compared(keys, texts)

    for batch in batches:
        for part, after, key, text in zip(*[batch.column(c).to_pylist() for c in ("range", "after", "key", "text")]):
            if part != current:
                yield from rest()
                keys, texts, chars, current, opening, closed = [], [], 0, part, (key, text), False
            if closed:
                continue
            closed = bool(after)
            keys.append(key)
            texts.append(text)
            chars += len(text)
            if chars >= SLICE_CHARS and len(texts) > 1:
                yield _compared(keys, texts)
                keys, texts, chars = keys[-1:], texts[-1:], len(texts[-1])
    yield from rest()


def compare_with_next(
    docs: DataFrame, key: str = "doc_id", text: str = "text", range_chars: int = RANGE_CHARS
) -> DataFrame:
    """Every text's fingerprint and how like it is to the next text's and to an edited text's.

    The order is that of ``key``, null last, rows of one key by text; after the last one comes the first.  A null text
    is empty.  Other columns are left out.  Documents are dealt by ranges of the key that hold about ``range_chars``;
    the first row of each range also goes to the range before, so every task has the text it needs and texts are
    shuffled once.  The bounds of the ranges, ``MOST_RANGES`` at most, are all that the driver sees.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    wanted = int(min(MOST_RANGES, max(1, chars // range_chars)))
    found = rows.agg(
        F.min("key"), F.percentile_approx("key", [i / wanted for i in range(wanted)], max(10_000, 10 * wanted))
    ).first()
    bounds = np.unique(np.array([found[0], *found[1]] if found[0] is not None else [], np.int64))
    ranges = max(1, len(bounds))

    @F.pandas_udf("long")
    def located(keys):
        at = np.searchsorted(bounds, keys.to_numpy(), side="right") - 1
        return type(keys)(2 * at + (bounds[at] == keys.to_numpy()))

    where = F.lit(0).cast("long")
    if len(bounds):
        last = F.lit(2 * (ranges - 1)).cast("long")
        where = F.when(F.col("key").isNull(), last).otherwise(located(F.coalesce("key", F.lit(int(bounds[0])))))
    own = F.struct(F.shiftright("at", 1).alias("range"), F.lit(0).alias("after"))
    before = F.struct(
        F.pmod(F.shiftright("at", 1) - 1, F.lit(ranges).cast("long")).alias("range"), F.lit(1).alias("after")
    )
    dealt = rows.withColumn("at", where).select(
        "key", "text", F.inline(F.when(F.col("at") % 2 == 1, F.array(own, before)).otherwise(F.array(own)))
    )
    ordered = dealt.repartition("range").sortWithinPartitions(
        "range", "after", F.col("key").asc_nulls_last(), "text"
    )
    return ordered.mapInArrow(_ranges, RESULT)


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint`` of every text; a null text is empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_CHARS):
                names, _, _ = fingerprints([t.encode() for t in pc.fill_null(part.column("text"), "").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(names, pa.string())], ["key", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(hashed, f"key {kind}, fingerprint string").withColumnRenamed("key", key)
