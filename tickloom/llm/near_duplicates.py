"""Exact Jaccard self-join of word shingles by partitions of the universe.

Two sets whose Jaccard similarity is at least a given fraction differ in at most H
elements, and H follows from their sizes.  The universe of shingle hashes is cut into m
segments.  With m = H + 1 at least one segment of both sets is the same; with one
to spare (m = H + 2) at least two are, and so on.  Where a segment's one-deletion
neighbourhood is indexed too, it stands for two: the sets meet in it even when
they differ in one element there.  So with a of the m segments indexed that way,
m + a > H is enough.

Sizes are split into bands so that similar sets are in one band or in adjacent
ones.  For every pair of adjacent bands the cheapest of these allocations is
taken, by the rows it makes and the chance matches that segments so short let
through (``allocation``).

An empty segment matches every other empty one, and unrelated sets of like size
have about as many equal segments by that as there are such sets: the pairs grow
with the square of the corpus.  With s segments to spare two sets that only share
empty ones share at least s + 1 of them, and the first of these has s more after it
in both.  So a set needs no row for its last s empty segments, and with enough to
spare most sets have none for any.

Rows of equal signature meet by one shuffle.  Equal sets were made one before.
The pairs in a signature's rows are not all written out: first every set is
compared with the one set that it shares most signatures with among those that
come first in them.  Links found so far are contracted to components; after that
only signatures whose rows are of different components are looked at, with the
first ``PARTNERS`` of their sets as partners of all the others, then the next
ones, ever more, until every pair of sets that share a signature is in one
component or was compared.  Those that share most signatures come first: what copies
were made from shares more than any copy, so a large group is one component before
many of its pairs are written.  A sketch of each set, a byte for each of many small
segments, refutes most pairs that are not similar: sets differ in at least as many
elements as bytes.  Rows carry its outline, of long sketches a bit or two of each byte,
which refutes most of them already.  Each other pair is verified on its whole sets.

Shingles are 64-bit hashes of 64-bit hashes of their words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.chunks import ChunkEncoder, forget_encoders, give_back, slices, worker_encoder
from tickloom.llm.components import component_roots
from tickloom.operators.stacking import stack
from tickloom.sources.staging import Scratch, stage

#: Similarity as a fraction, unless a caller names another.
LEAST = (9, 10)
#: Sets known to be few enough for every task to hold their ids; more are joined by a shuffle.
FEW_SETS = 1 << 20
#: Parts that the partners of one set are dealt into.
SALTS = 64
#: Partners that a signature's sets get in the first round, and how many times as many in each later round.
PARTNERS, MORE_PARTNERS = 2, 64
#: Sketch bytes for each element by which sets may differ.
SKETCH = 3
#: Sets with fewer shingles vote with all their signatures.
FEW_SHINGLES = 64
#: Documents' rows that one file of a written round holds, about.
FILE_ROWS = 20_000
#: Share of a set's shingles that an unrelated set of like size holds, for the cost of short segments: that of one word, to the
#: power of a shingle's words.
COMMON = 0.29
SLICE = 1 << 20

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _B
    x = (x ^ (x >> _S)) * _B
    return x ^ (x >> _S)


def _word_hashes(piece: str) -> list[int]:
    return [xxhash.xxh64_intdigest(w.encode()) for w in _WORD.findall(piece)]


def _hashes_of_pieces(pieces: list[str]) -> list[bytes]:
    return [np.array(_word_hashes(p), np.uint64).tobytes() for p in pieces]


def _encoder() -> ChunkEncoder:
    return worker_encoder("word hashes", lambda: ChunkEncoder(_hashes_of_pieces, _word_hashes, np.uint64))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of every text's set, and the sets one after the other, each in ascending order.

    Words are lower-cased from A to Z alone.  A text of fewer than ``width`` words has them all as its one shingle.
    """
    counts, words = _encoder()(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), shingles)
    if not len(owner):
        return shingles, np.zeros(0, np.uint64)
    at = np.repeat(starts - (np.cumsum(shingles) - shingles), shingles) + np.arange(len(owner))
    length = np.minimum(counts, width)[owner]
    hashed = length.astype(np.uint64) * _A
    for k in range(width):
        inside = k < length
        hashed = np.where(inside, _mix(hashed * _A + words[np.minimum(at + k, len(words) - 1)]), hashed)
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    fresh = np.concatenate(([True], (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])))
    return np.bincount(owner[fresh], minlength=len(counts)), hashed[fresh]


@lru_cache(maxsize=None)
def bands(most: int, least: tuple[int, int] = LEAST) -> np.ndarray:
    """First sizes of the bands, up to the one beyond ``most``."""
    over, under = least
    first = [1]
    while first[-1] <= most:
        first.append(max(first[-1] + 1, (first[-1] - 1) * under // over + 1))
    return np.array([*first, max(first[-1] + 1, (first[-1] - 1) * under // over + 1)], np.int64)


def limit(smaller: int, least: tuple[int, int] = LEAST) -> int:
    """Elements by which two similar sets differ at most, where the smaller one has at most ``smaller``."""
    over, under = least
    return (smaller + smaller * under // over) * (under - over) // (under + over)


#: Sizes of the sets that meet in a group, of its smaller band and of the larger one, for the cost of an allocation.
SIZES = (0.8, 0.9, 1.0, 1.1, 1.2)


@lru_cache(maxsize=None)
def allocation(smaller: int, sets: int, least: tuple[int, int] = LEAST, width: int = 3) -> tuple[int, int, int]:
    """(segments, how many of them with deletions, how many to spare) for pairs whose smaller set has at most ``smaller``
    elements of ``width`` words, where about ``sets`` sets are of a like size.  No segments: only equal sets are
    similar."""
    differ = limit(smaller, least)
    if not differ:
        return 0, 0, 0
    own = 1 - COMMON**width

    def cost(choice: tuple[int, int, int]) -> float:
        m, a, spare = choice
        total = 0.0
        for part in SIZES:
            t = part * smaller / m
            # Two unrelated sets have nothing of their own in a segment; most often there is nothing in it at all.
            alike, none = math.exp(-2 * t * own), math.exp(-2 * t)
            empty = m * math.exp(-t)
            z = (spare - empty) / math.sqrt(empty)
            shown = math.sqrt(empty / 2 / math.pi) * math.exp(-z * z / 2) - (spare - empty) * math.erfc(z / math.sqrt(2)) / 2
            plain = (m - a - empty) * (1 + sets * (alike - none)) + shown * (1 + sets * math.exp(-t) * shown / empty)
            total += plain + a * (1 + t + sets * (1 + 2 * t) * alike)
        return total

    with_deletions = [(m, differ + 1 - m, 0) for m in range((differ + 2) // 2, differ + 1)]
    to_spare = sorted({*range(min(differ, 16)), *range(0, differ // 2, 1 + differ // 64)})
    return min([*((differ + 1 + s, 0, s) for s in to_spare), *with_deletions], key=cost)


def _signatures(group: np.ndarray, segments: np.ndarray, deleting: np.ndarray, spare: np.ndarray, sizes, values):
    """(owner, signature, deleted) of all rows of sets, each with its own number of segments."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    use = (segments > 0)[owner]
    owner, values = owner[use], values[use]
    offsets = np.cumsum(segments) - segments
    segment = ((values >> _S) * segments[owner].astype(np.uint64) >> _S).astype(np.int64)
    place = offsets[owner] + segment  # ascending, as values are
    total = int(segments.sum())
    counts = np.bincount(place, minlength=total)
    mixed = _mix(values + _A)
    sums = np.zeros(total, np.uint64)
    filled = np.flatnonzero(counts)
    if len(filled):
        sums[filled] = np.add.reduceat(mixed, (np.cumsum(counts) - counts)[filled])
    of = np.repeat(np.arange(n), segments)
    number = np.arange(total) - offsets[of]
    salt = _mix(group[of].astype(np.uint64) * _A + number.astype(np.uint64))

    def signed(some, s, c):
        return _mix((s + c.astype(np.uint64) * _A) ^ salt[some])

    # Of a set's empty segments all but the last to spare.
    empty = counts == 0
    before = np.concatenate(([0], np.cumsum(empty)))
    rank = before[:-1] - before[offsets][of]
    shown = ~empty | (rank < (np.bincount(of[empty], minlength=n) - spare)[of])
    rows = np.flatnonzero(shown)
    out = [(of[rows], signed(rows, sums[rows], counts[rows]), np.zeros(len(rows), bool))]
    # One element of a segment left out at a time.
    less = (number < deleting[of])[place]
    out.append((owner[less], signed(place[less], sums[place[less]] - mixed[less], counts[place[less]] - 1), np.ones(less.sum(), bool)))
    return tuple(np.concatenate(part) for part in zip(*out))


def _groups(sizes: np.ndarray, least: tuple[int, int]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """First sizes of the bands; every set's group with the band above and with the band below; which of these exist."""
    first = bands(int(sizes.max(initial=1)), least)
    band = np.searchsorted(first, sizes, side="right") - 1
    groups = [band, band - 1]
    return first, groups, [(g >= 0) & (sizes > 0) for g in groups]


def signatures(
    sizes: np.ndarray, values: np.ndarray, sets: int, least: tuple[int, int] = LEAST, width: int = 3
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, signature, kind): rows in which any two similar, unequal sets meet, not both deleted.

    ``kind`` is 1 for a set that is the larger band's in its group, and 2 more for a deleted element.
    """
    first, groups, real = _groups(sizes, least)
    parts = []
    for upper, (group, some) in enumerate(zip(groups, real)):
        choices = np.array(
            [
                allocation(int(first[g + 1] - 1), sets, least, width) if r else (0, 0, 0)
                for g, r in zip(group.tolist(), some.tolist())
            ]
        ).reshape(-1, 3)
        owner, signature, deleted = _signatures(group, choices[:, 0], choices[:, 1], choices[:, 2], sizes, values)
        parts.append((owner, signature, upper + 2 * deleted.astype(np.int64)))
    return tuple(np.concatenate(p) for p in zip(*parts))


def sketches(sizes: np.ndarray, values: np.ndarray, least: tuple[int, int] = LEAST) -> list[list[bytes]]:
    """For both groups of every set one byte of each of ``SKETCH`` times as many small segments as elements may differ.

    Two sets of a group differ in at least as many elements as bytes.
    """
    first, groups, real = _groups(sizes, least)
    out, n = [], len(sizes)
    for group, some in zip(groups, real):
        lengths = np.array(
            [SKETCH * limit(int(first[g + 1] - 1), least) if r else 0 for g, r in zip(group.tolist(), some.tolist())],
            np.int64,
        )
        offsets, owner = np.cumsum(lengths) - lengths, np.repeat(np.arange(n), sizes)
        use = (lengths > 0)[owner]
        of, own = owner[use], values[use]
        place = offsets[of] + ((own >> _S) * lengths[of].astype(np.uint64) >> _S).astype(np.int64)
        total = int(lengths.sum())
        counts, sums = np.bincount(place, minlength=total), np.zeros(total, np.uint64)
        filled = np.flatnonzero(counts)
        if len(filled):
            sums[filled] = np.add.reduceat(_mix(own + _A), (np.cumsum(counts) - counts)[filled])
        data = (_mix(sums) >> np.uint64(56)).astype(np.uint8).tobytes()
        out.append([data[a : a + k] for a, k in zip(offsets.tolist(), lengths.tolist())])
    return out


#: Sketches up to so many bytes are outlines as they are; fewer bits would refute too little, and the pairs of a large group of
#: texts that are nearly similar would be written for every signature they share.
SHORT_SKETCH = 512
#: Of longer sketches than this one bit of each byte is enough.
LONG_SKETCH = 1024
#: By an outline's first byte: of each other byte, how many of its fields (one, four of two bits, or eight bits) are not 0.
_FIELDS = np.array(
    [[x > 0 for x in range(256)], *([sum(x >> k & (1 << n) - 1 > 0 for k in range(0, 8, n)) for x in range(256)] for n in (2, 1))],
    np.uint8,
)


def outlines(drawn: list[bytes]) -> list[bytes]:
    """A sketch that is short, behind a 0, or two bits of each of its bytes, four in a byte, behind a 1, or of a long one a
    bit of each, eight in a byte, behind a 2.

    Outlines differ in no more fields than sketches in bytes.
    """
    out = []
    for sketch in drawn:
        if len(sketch) <= SHORT_SKETCH:
            out.append(b"\0" + sketch)
            continue
        if len(sketch) > LONG_SKETCH:
            out.append(b"\2" + np.packbits(np.frombuffer(sketch, np.uint8) & 1).tobytes())
            continue
        bits = np.zeros((-(-len(sketch) // 4), 4), np.uint8)
        bits.reshape(-1)[: len(sketch)] = np.frombuffer(sketch, np.uint8) & 3
        out.append(b"\1" + (bits << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes())
    return out


DIGEST = ["n", "d1", "d2"]


def _digests(sizes: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of each set; those of an empty set are 0."""
    some = sizes > 0
    starts, out = (np.cumsum(sizes) - sizes)[some], []
    for seed in (_A, _B):
        sums = np.zeros(len(sizes), np.uint64)
        if len(starts):
            sums[some] = np.add.reduceat(_mix(values ^ seed), starts)
        out.append(sums)
    return out


#: Nodes whose signatures a task has given out and remembers, at most.
REMEMBERED = 1 << 20


def _node_ids(digests: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set; the second one is for sets whose first name another set has too."""
    return tuple((digests[i] ^ _mix(digests[1 - i] + c)).view(np.int64) for i, c in ((0, _B), (1, _A)))


def _documents_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc, n, d1, d2, node, other`` of every row: its set's size and digest, and two 64-bit names of the set."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sizes, values = shingle_sets(part.column("text"), width)
                digests = _digests(sizes, values)
                columns = [pa.array(c.view(np.int64)) for c in (*digests, *_node_ids(digests))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(sizes, pa.int64()), *columns], ["doc", *DIGEST, "node", "other"]
                )
            give_back()

    return docs.mapInArrow(digest, "doc long, n long, d1 long, d2 long, node long, other long")


def _signature_rows(docs: DataFrame, width: int, sets: int, least: tuple[int, int], clashing: list[int]) -> DataFrame:
    """``doc, n, signature, kind`` of the set of every row with a key, ``doc`` its name by 64 bits.

    A task gives a set's rows once, so copies of a text add a set's rows for each task at most.  ``clashing`` are the first
    names that different sets share.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sizes, values = shingle_sets(part.column("text"), width)
                nodes, others = _node_ids(_digests(sizes, values))
                if clashing:
                    nodes = np.where(np.isin(nodes, clashing), others, nodes)
                fresh = np.zeros(len(nodes), bool)
                for i, node in enumerate(nodes.tolist()):
                    if sizes[i] and node not in given:
                        fresh[i] = True
                        given.add(node)
                if len(given) > REMEMBERED:
                    given.clear()
                values = values[np.repeat(fresh, sizes)]
                sizes, nodes = sizes[fresh], nodes[fresh]
                owner, signature, kind = signatures(sizes, values, sets, least, width)
                columns = [nodes[owner], sizes[owner], signature.view(np.int64), kind.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "n", "signature", "kind"])
            give_back()

    return docs.where("doc is not null").mapInArrow(sign, "doc long, n long, signature long, kind int")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of the documents in ``wanted``, which may hold other sets too."""
    keys = wanted.select("key").distinct()
    few = keys.count() <= FEW_SETS
    return docs.join(F.broadcast(keys) if few else keys, docs["doc"] == keys["key"], "left_semi").select("text")


def _made_of(docs: DataFrame, wanted: DataFrame, width: int, make, names: list[str]) -> DataFrame:
    """``doc`` and the binary columns that ``make(sizes, values)`` gives for the set of every row of ``wanted``.

    ``wanted`` has ``doc`` (the set's node), ``key`` (a document with that set) and the set's digest.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sizes, values = shingle_sets(part.column("text"), width)
                columns = [pa.array(sizes, pa.int64()), *(pa.array(d.view(np.int64)) for d in _digests(sizes, values))]
                columns += [pa.array(c, pa.binary()) for c in make(sizes, values)]
                yield pa.RecordBatch.from_arrays(columns, [*DIGEST, *names])
            give_back()

    kinds = ", ".join([*(f"{c} long" for c in DIGEST), *(f"{c} binary" for c in names)])
    # Equal texts are one set; the documents may have sets that are not wanted.
    found = _texts_of(docs, wanted).mapInArrow(find, kinds).groupBy(*DIGEST).agg(*[F.first(c).alias(c) for c in names])
    return found.join(wanted.select("doc", *DIGEST), DIGEST).select("doc", *names)


def _elements(sizes: np.ndarray, values: np.ndarray) -> list[list[bytes]]:
    data, ends = values.tobytes(), 8 * np.cumsum(sizes)
    return [[data[e - 8 * n : e] for e, n in zip(ends.tolist(), sizes.tolist())]]


def similar(x: np.ndarray, y: np.ndarray, least: tuple[int, int] = LEAST) -> bool:
    over, under = least
    common = int(np.isin(x, y, assume_unique=True).sum())
    return under * common >= over * (len(x) + len(y) - common)


def _cells(column: pa.Array, kind: type) -> list[np.ndarray]:
    """The numbers of ``kind`` in each value of a binary column, which stay where they are."""
    column = column.cast(pa.binary())
    if not len(column):
        return []
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32, len(column) + 1, 4 * column.offset) // np.dtype(kind).itemsize
    values = np.frombuffer(data or b"", np.uint8, int(ends[-1]) * np.dtype(kind).itemsize).view(kind)
    return [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _verified(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """``a, b, linked`` of all pairs ``a, b``: a's set travels to b's, which stays for all its partners."""
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    movers = pairs.join(sets.select(F.col("doc").alias("a"), "elements"), "a").select("b", "salt", "a", "elements")
    heads = (
        pairs.select("b", "salt").distinct()
        .join(sets.select(F.col("doc").alias("b"), "elements"), "b")
        .select("b", "salt", F.lit(None).cast("long").alias("a"), "elements")
    )
    together = stack(movers, heads).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        head = None
        for batch in batches:
            rows = []
            # Whole sets are the most that is sent to a task at once, so they are not copied; a head outlives its batch.
            sets = _cells(batch.column("elements"), np.uint64)
            for b, a, values in zip(batch.column("b").to_pylist(), batch.column("a").to_pylist(), sets):
                if a is None:
                    head = values.copy()
                else:
                    rows.append((a, b, similar(values, head, least)))
            columns = list(zip(*rows)) or [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", "linked"])

    return together.mapInArrow(compare, "a long, b long, linked boolean")


def _not_refuted(pairs: DataFrame, drawn: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Those of the pairs ``a, b`` whose sketches differ in no more bytes than similar sets may.

    Of two bands' sets the one of the larger band takes part with the sketch of the group below it.
    """
    over, under = least
    first = pairs.join(drawn.select(F.col("doc").alias("a"), *[F.col(c).alias(f"a_{c}") for c in DRAWN]), "a")
    both = first.join(drawn.select(F.col("doc").alias("b"), *[F.col(c).alias(f"b_{c}") for c in DRAWN]), "b")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            columns = {
                f"{s}_{c}": _cells(batch.column(f"{s}_{c}"), np.uint8) if c != "size" else batch.column(f"{s}_{c}").to_pylist()
                for s in "ab"
                for c in DRAWN
            }
            fit = []
            for n, m, x, y, u, v in zip(*(columns[f"{s}_{c}"] for c in DRAWN for s in "ab")):
                # The sketches of the group that both are in: of one band, or one's own and the other's below.
                own, other = (x, y) if len(x) == len(y) else (x, v) if len(x) == len(v) else (u, y)
                if len(own) == len(other):
                    unlike = int(np.count_nonzero(own != other))
                    fit.append((under + over) * unlike <= (under - over) * (n + m))
                else:
                    fit.append(False)  # bands apart
            yield batch.select(["a", "b"]).filter(pa.array(fit, pa.bool_()))

    columns = ["a", "b", *(f"{s}_{c}" for c in DRAWN for s in "ab")]
    return both.select(*columns).mapInArrow(keep, "a long, b long")


def _firsts(rows: DataFrame, least: tuple[int, int]) -> DataFrame:
    """``a, b, votes``: how many signatures each set shares with the set that comes first in them.

    Of sets with many signatures an eighth of these vote; the pairs that matter are found by ``_partners`` anyway.
    """
    over, under = least
    voting = rows.where((F.col("n") < FEW_SHINGLES) | (F.pmod("signature", F.lit(8)) == 0))
    ordered = voting.repartition("signature").sortWithinPartitions("signature", "kind", "doc")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        current, head = None, None
        for batch in batches:
            out = []
            for s, doc, n in zip(*[batch.column(c).to_pylist() for c in ("signature", "doc", "n")]):
                if s != current:
                    current, head = s, (doc, n)
                elif doc != head[0] and under * min(n, head[1]) >= over * max(n, head[1]):
                    out.append((doc, head[0]))
            columns = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return ordered.mapInArrow(pair, "a long, b long").groupBy("a", "b").agg(F.count("*").alias("votes"))


def _unlike(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The number of fields in which the outlines of rows ``x`` and ``y``, of one length each pair, differ."""
    out = np.zeros(len(x), np.int64)
    for i in range(0, len(x), AT_A_TIME):
        own, other = x[i : i + AT_A_TIME], y[i : i + AT_A_TIME]
        sizes = lengths[own]
        if sizes.min() == sizes.max():
            rows = np.lib.stride_tricks.sliding_window_view(data, sizes[0])
            bits, form = rows[starts[own]] ^ rows[starts[other]], data[starts[own[0]]]
            out[i : i + AT_A_TIME] = _FIELDS[form][bits].sum(axis=1) if form else np.count_nonzero(bits, axis=1)
            continue
        ends = np.cumsum(sizes)
        at = np.repeat(starts[own] - (ends - sizes), sizes) + np.arange(ends[-1])
        bits = data[at] ^ data[at + np.repeat(starts[other] - starts[own], sizes)]
        fields = _FIELDS[np.repeat(data[starts[own]], sizes), bits]
        out[i : i + AT_A_TIME] = np.add.reduceat(fields, ends - sizes, dtype=np.int64)
    return out


def _partners(rows: DataFrame, sets: DataFrame, since: int, until: int, least: tuple[int, int]) -> DataFrame:
    """``a, b``: sets b that are number ``since`` to ``until`` among a signature's rows, with all sets a after them.

    Rows are ``signature, doc, n, kind, root``.  Only partners of a like size, of different components, not both by
    deletion and whose outlines differ in no more fields than similar sets may; of a signature's rows the first ``until``
    are held at a time.  ``sets`` has how many rows each set ``shared``; those with most come first.
    """
    over, under = least
    known = sets.select("doc", "shared", "own_outline", "below_outline")
    outline = F.when(F.col("kind") % 2 == 1, F.col("below_outline")).otherwise(F.col("own_outline"))
    drawn = rows.join(known, "doc").select("signature", "doc", "n", "kind", "root", "shared", outline.alias("outline"))
    # Outlines of one length: equal signatures of different groups, which chance makes, are kept apart.
    order = [F.length("outline"), F.col("kind") > 1, F.col("shared").desc(), F.col("doc"), F.col("kind")]
    ordered = drawn.repartition("signature").sortWithinPartitions("signature", *order).drop("shared")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        # Of the last signature: its key, how many of its rows have come, and the partners among them.
        current, seen, held = None, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            goes_on = current == (batch.column("signature")[0].as_py(), len(batch.column("outline")[0].as_py()))
            old = held.num_rows if goes_on else 0
            if old:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            signature, doc, n, kind, root = (np.asarray(batch.column(c)) for c in ("signature", "doc", "n", "kind", "root"))
            lengths = np.asarray(pc.binary_length(batch.column("outline"))).astype(np.int64)
            data = np.frombuffer(b"".join(batch.column("outline").to_pylist()), np.uint8)
            starts = np.cumsum(lengths) - lengths
            fresh = np.concatenate(([True], (signature[1:] != signature[:-1]) | (lengths[1:] != lengths[:-1])))
            first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            # The row of a signature's number j is ``zero + j``; held ones are numbers from ``since`` on.
            place, zero = np.arange(len(doc)) - first, first.copy()
            if goes_on:
                own = first == 0
                place[own] += seen - old
                zero[own] = -min(seen, since)
                place[:old] = np.arange(since, since + old)
            out = []

            def try_all(x: np.ndarray, y: np.ndarray, among: np.ndarray | bool = True) -> None:
                """Rows ``x`` with partners ``y``, of shapes that go together."""
                fits = (root[y] != root[x]) & (doc[y] != doc[x]) & ((kind[y] < 2) | (kind[x] < 2)) & among
                fits &= under * np.minimum(n[y], n[x]) >= over * np.maximum(n[y], n[x])
                x, y = (np.broadcast_to(rows, fits.shape)[fits] for rows in (x, y))
                near = (under + over) * _unlike(data, starts, lengths, x, y) <= (under - over) * (n[x] + n[y])
                out.append(np.stack([doc[x[near]], doc[y[near]]], axis=1))

            ends = np.concatenate((np.flatnonzero(fresh)[1:], [len(doc)]))
            many = np.minimum(place[ends - 1], until) - since > FEW_PARTNERS
            later = np.flatnonzero(~many[np.cumsum(fresh) - 1])
            later = later[later >= old]
            for j in range(since, min(until, since + FEW_PARTNERS)):
                later = later[place[later] > j]
                if not len(later):
                    break
                try_all(later, zero[later] + j)
            # Signatures with many partners, one after the other.
            for end in ends[many].tolist():
                x = np.arange(max(first[end - 1], old if first[end - 1] == 0 else 0), end)
                numbers = np.arange(since, min(until, int(place[end - 1])))
                step = max(1, CELLS // len(numbers))
                for part in (x[i : i + step, None] for i in range(0, len(x), step)):
                    try_all(part, zero[end - 1] + numbers[None, :], numbers[None, :] < place[part])
            pairs = np.unique(np.concatenate([*out, np.zeros((0, 2), np.int64)]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pairs.T], ["a", "b"])
            current, seen = (int(signature[-1]), int(lengths[-1])), int(place[-1]) + 1
            last = np.flatnonzero((first == first[-1]) & (place >= since) & (place < until))
            held = batch.take(pa.array(last))

    return ordered.mapInArrow(pair, "a long, b long").distinct()


#: Signatures with at most so many partners are looked at side by side, others alone, so many pairs at a time.
FEW_PARTNERS, CELLS = 64, 1 << 18
#: Pairs whose outlines are compared at a time.
AT_A_TIME = 4096
#: What pairs are refuted by: the size of a set and its two sketches.
DRAWN = ["size", "own_sketch", "below_sketch"]
OUTLINES = ["own_outline", "below_outline"]
#: A set is joined by broadcast when more than this part of all rows have it; so there are fewer such sets.
HOT_PART = 512


def similar_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, least: tuple[int, int] = LEAST
) -> DataFrame:
    """``key, n_shingles, component_id`` of every row: its set's size and the least key that links lead to.

    Sets of shingles of ``width`` words are linked whose Jaccard similarity is at least the fraction ``least``.

    Null and empty texts have an empty set and no links.  A row without a key has no links and no component.  Rows that
    share a key but not their set are linked each by its own set.  Columns of other names are not read.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        found = scratch.stage(_documents_sets(docs, width), "documents-sets")
        # Equal sets are one.
        firsts = found.where("doc is not null and n > 0").groupBy(*DIGEST, "node", "other").agg(
            F.min("doc").alias("key"), F.count(F.lit(1)).alias("rows")
        )
        firsts = scratch.stage(firsts, "sets-nodes")
        # Names that different sets share are a handful among billions of sets.
        shared = firsts.groupBy("node").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
        clashing = [r.node for r in shared.collect()]
        name = F.when(F.col("node").isin(clashing), F.col("other")).otherwise(F.col("node")) if clashing else F.col("node")
        firsts = firsts.withColumn("doc", name).drop("node", "other")
        met = _met(_signature_rows(docs, width, max(1, firsts.count() // 64), least, clashing))
        met = scratch.stage(met, "met")
        shared = met.groupBy("doc").agg(F.count(F.lit(1)).alias("shared"))
        wanted = scratch.stage(firsts.join(shared, "doc"), "met-sets")
        files = 8 + wanted.count() // FILE_ROWS

        def sketched(sizes: np.ndarray, values: np.ndarray) -> list[list[bytes]]:
            both = sketches(sizes, values, least)
            return [*both, *map(outlines, both)]

        drawn = _made_of(docs, wanted, width, sketched, [*DRAWN[1:], *OUTLINES])
        drawn = drawn.join(wanted.select("doc", F.col("n").alias("size"), "shared"), "doc")
        drawn = scratch.stage(drawn.coalesce(files), "sketches")
        sets = None

        def verified(pairs: DataFrame) -> DataFrame:
            """Verdicts on pairs; the sets that none before needed are made from their texts."""
            nonlocal sets
            needed = stack(pairs.select(F.col("a").alias("doc")), pairs.select(F.col("b").alias("doc"))).distinct()
            if sets is not None:
                needed = needed.join(sets.select("doc"), "doc", "left_anti")
            needed = scratch.stage(wanted.join(needed, "doc", "left_semi"), "needed-sets")
            made = scratch.stage(_made_of(docs, needed, width, _elements, ["elements"]), "sets")
            scratch.drop(needed)
            sets = made if sets is None else stack(sets, made)
            return scratch.stage(_verified(pairs, sets, least).coalesce(files), "verified")

        # Each set with the one it shares most signatures with among the first ones.
        best = _firsts(met, least).groupBy("a").agg(F.max_by("b", F.struct("votes", -F.col("b"))).alias("b"))
        best = scratch.stage(_not_refuted(best, drawn, least).coalesce(files), "partners")
        compared = verified(best)
        roots = component_roots(compared.where("linked").select("a", "b"))
        done, until = 0, PARTNERS
        while True:
            before = met
            met = scratch.stage(_open(_rooted(met, roots), done).coalesce(files), "open")
            scratch.drop(before)
            if not met.take(1):
                break
            # Staged before those compared are left out, which Spark would do before it makes them distinct.
            outlined = scratch.stage(_partners(met, drawn, done, until, least).coalesce(files), "outlined")
            new = _not_refuted(outlined.join(compared, ["a", "b"], "left_anti"), drawn, least)
            more = verified(scratch.stage(new.coalesce(files), "partners"))
            scratch.drop(outlined)
            met, done, until = met.drop("root"), until, until * MORE_PARTNERS
            compared = scratch.stage(stack(compared, more).coalesce(files), "verified")
            linked = more.where("linked").select("a", "b")
            if linked.take(1):
                known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
                roots = component_roots(stack(known, linked))
        return stage(_answers(found, firsts, roots).withColumnRenamed("doc", key), "components")


def _answers(found: DataFrame, firsts: DataFrame, roots: DataFrame) -> DataFrame:
    """``doc, n_shingles, component_id`` of every row, from its set and the components of sets."""
    rooted = _rooted(firsts, roots)
    # Names of sets are not all keys: a component is called by its least key.
    linked = rooted.join(stack(roots.select("root"), roots.select(F.col("node").alias("root"))).distinct(), "root", "left_semi")
    names = linked.groupBy("root").agg(F.min("key").alias("least_key"))
    own = rooted.join(names, "root", "left").select(*DIGEST, "rows", F.coalesce("least_key", "key").alias("component_id"))
    hot = F.col("rows") * HOT_PART > F.lit(found.count())
    with_set = found.where("doc is not null and n > 0")
    # All sets' rows together are the table, so fewer than HOT_PART are hot.
    few, rest = F.broadcast(own.where(hot).drop("rows")), own.where(~hot).drop("rows")
    out = stack(
        with_set.join(few, DIGEST),
        with_set.join(F.broadcast(own.where(hot).select(*DIGEST)), DIGEST, "left_anti").join(rest, DIGEST),
        found.where("doc is null or n = 0").withColumn("component_id", F.col("doc")),
    )
    return out.select("doc", F.col("n").alias("n_shingles"), "component_id")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    known = roots.select(F.col("node").alias("doc"), "root")
    return rows.join(known, "doc", "left").withColumn("root", F.coalesce("root", "doc"))


def _met(rows: DataFrame) -> DataFrame:
    """Rows whose signature another set has too, each row once."""
    ordered = rows.repartition("signature").sortWithinPartitions("signature", "doc", "kind")

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of the last signature: all of them while one set alone has it, else the last one, which was given out.
        held, several_sets = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            given = held.num_rows if several_sets else 0
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            s, doc, kind = (np.asarray(batch.column(c)) for c in ("signature", "doc", "kind"))
            same = s[1:] == s[:-1]
            new = np.concatenate(([True], ~same | (doc[1:] != doc[:-1]) | (kind[1:] != kind[:-1])))
            group = np.concatenate(([0], np.cumsum(~same)))
            shared = np.zeros(group[-1] + 1, bool)
            shared[group[1:][same & (doc[1:] != doc[:-1])]] = True
            shared[0] |= several_sets
            keep = shared[group] & new
            keep[:given] = False
            yield batch.filter(pa.array(keep))
            several_sets, start = bool(shared[-1]), int(np.searchsorted(group, group[-1]))
            held = batch.slice(batch.num_rows - 1) if several_sets else batch.slice(start).filter(pa.array(new[start:]))

    return ordered.mapInArrow(several, rows.schema)


def _open(rows: DataFrame, done: int) -> DataFrame:
    """Rows of signatures that more than ``done + 1`` rows of more than one component have."""
    states = rows.groupBy("signature").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("rows"))
    several = states.where((F.col("x") < F.col("y")) & (F.col("rows") > done + 1)).select("signature")
    return rows.join(several, "signature", "left_semi")
