"""Best-fit packing of documents into sequences by bin completion.

Documents are cut into pieces of at most ``capacity`` tokens, only where they are
longer than that.  Pieces are dealt into groups of a few thousand by a hash of
the row, so no key can make a group large, and every group is packed by a branch
and bound search over sequences:

* the sequence around the largest piece left is filled next;
* the fillings tried, of any number of pieces, come from the sums that the
  lengths left can give, the fullest first; a filling is left out when another
  one puts larger pieces in the same places;
* the waste that a filling causes is counted against the best solution known,
  the incumbent, which at first is that of best-fit decreasing or of largest
  pieces with smallest ones; a branch whose waste can no longer give fewer
  sequences is cut;
* the search ends when the number of sequences equals the lower bound, or after
  ``nodes`` steps, and then the incumbent is the result.

Sequences that a group left with much room are opened again and their pieces,
far fewer, packed in a second round of groups.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.chunks import forget_encoders, give_back, slices, token_encoder
from tickloom.operators.series import number_rows
from tickloom.operators.stacking import stack
from tickloom.sources.staging import stage

CAPACITY = 2048
GROUP_PIECES = 4096
NODES = 4_000
#: Pieces left from which on the search tries many more fillings.
FEW_PIECES = 32
#: Lengths that a filling is first looked for among, where there are many more.
SPREAD = 48
#: Parts of the capacity that the lower bound counts pieces by.
MOST_PARTS = 32
#: Room, as a part of the capacity, from which a sequence is opened again for the second round.
REOPENED = 1 / 32
#: Groups are packed by at most so many tasks.
TASKS = 10_000

PIECES = "key long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, piece, start, length, ids_crc32``: the documents' ids with their end id, cut into pieces.

    A null text is an empty one, so it is its end id alone.  Rows with equal keys are documents of their own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                lengths, ids = encode(part.column("text"))
                ids = np.insert(ids, np.cumsum(lengths), end_id).astype("<u4")
                lengths = lengths + 1
                pieces = -(-lengths // capacity)
                number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                length = np.minimum(np.repeat(lengths, pieces) - start, capacity)
                ends, data = np.cumsum(length), memoryview(ids).cast("B")
                crcs = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), length.tolist())]
                keys = part.column("key").take(pa.array(np.repeat(np.arange(len(lengths)), pieces)))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(number, pa.int32()), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())],
                    ["key", "piece", "start", "length", "ids_crc32"],
                )
            give_back()

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(cut, PIECES)


def _sums(lengths: list[int], counts: list[int], room: int) -> list[int]:
    """For each number of the first lengths, as bits, the sums up to ``room`` that these lengths give."""
    mask, sums = (2 << room) - 1, [1]
    for n, count in zip(lengths, counts):
        reached, count, some = sums[-1], min(count, room // n), 1
        while count > 0:
            reached |= (reached << min(some, count) * n) & mask
            count, some = count - some, 2 * some
        sums.append(reached)
    return sums


def _fillings(left: np.ndarray, room: int, width: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` by any number of the lengths counted in ``left``, the fullest first.

    At most ``width`` are given, each with another largest piece while many pieces are left, and sixteen times as many
    of all kinds once ``FEW_PIECES`` are left.
    """
    lengths = np.flatnonzero(left[: room + 1]).tolist()
    if not lengths:
        return [()]
    if lengths[-1] == room:
        return [(room,)]
    few = int(left.sum()) <= FEW_PIECES
    if not few and len(lengths) > 2 * SPREAD:
        # Some of the lengths, spread evenly, often fill the room already; fuller than full no others can make it.
        some = lengths[:: len(lengths) // SPREAD]
        if _sums(some, left[some].tolist(), room)[-1] >> room & 1:
            lengths = some
    counts = left[lengths].tolist()
    sums = _sums(lengths, counts, room)
    if few:
        width *= 16

    def exact(first: int, rest: int) -> Iterator[tuple[int, ...]]:
        """Fillings of ``rest`` by the ``first`` smallest lengths, larger pieces first."""
        if not rest:
            yield ()
            return
        for i in range(min(first, bisect_right(lengths, rest)) - 1, -1, -1):
            n = lengths[i]
            if not sums[i + 1] >> rest & 1:
                return  # nor do fewer lengths give it
            for k in range(min(counts[i], rest // n), 0, -1):
                if sums[i] >> (rest - k * n) & 1:
                    for others in exact(i, rest - k * n):
                        yield (n,) * k + others

    def one_each(total: int) -> Iterator[tuple[int, ...]]:
        for i in range(bisect_right(lengths, total) - 1, -1, -1):
            n = lengths[i]
            for k in range(min(counts[i], total // n), 0, -1):
                if sums[i] >> (total - k * n) & 1:
                    yield (n,) * k + next(exact(i, total - k * n))
                    break

    found: list[tuple[int, ...]] = []
    reached = sums[-1]
    tried = 0
    while reached:
        total = reached.bit_length() - 1
        reached ^= 1 << total
        for filling in exact(len(lengths), total) if few else one_each(total):
            tried += 1
            # Dominated: another one has a piece at least as large in each place.
            if not any(len(f) >= len(filling) and all(x >= y for x, y in zip(f, filling)) for f in found):
                found.append(filling)
            if len(found) == width or tried == 8 * width:
                return found
    return found


def ends_first(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """The largest piece, the smallest ones as long as two more fit, and then the largest that fits."""
    rest, sequences = sorted(lengths.tolist()), []
    while rest:
        own = [rest.pop()]
        room = capacity - own[0]
        while rest and rest[0] <= room:
            both = len(rest) > 1 and rest[0] + rest[1] <= room
            own.append(rest.pop(0 if both else bisect_right(rest, room) - 1))
            room -= own[-1]
        sequences.append(own)
    return sequences


def fewest_sequences(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound: by the sum, and by how many pieces beyond a part of the capacity a sequence can hold.

    A piece counts floor((k + 1) length / capacity) of k, or its share of the capacity where that has no remainder:
    pieces that fit together never count more than one.
    """
    bound = -(-int(lengths.sum()) // capacity)
    for k in range(1, MOST_PARTS + 1):
        whole, over = np.divmod((k + 1) * lengths, capacity)
        # In parts of k (k + 1), so that both kinds are whole numbers.
        counted = np.where(over == 0, whole * k, whole * (k + 1))
        bound = max(bound, -(-int(counted.sum()) // (k * (k + 1))))
    return bound


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each length goes where the least room is left that holds it."""
    sequences: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = np.zeros(capacity + 1, dtype=bool)
    for n in np.sort(lengths)[::-1].tolist():
        i = int(open_rooms[n:].argmax()) + n if open_rooms[n:].any() else -1
        if i < 0:
            sequences.append([n])
            room, at = capacity - n, len(sequences) - 1
        else:
            at = by_room[i].pop()
            open_rooms[i] = bool(by_room[i])
            sequences[at].append(n)
            room = i - n
        by_room[room].append(at)
        open_rooms[room] = True
    return sequences


def complete_bins(lengths: np.ndarray, capacity: int, nodes: int = NODES, width: int = 4) -> list[list[int]]:
    """Sequences of lengths, each of at most ``capacity`` in sum, as few as the search finds."""
    if not len(lengths):
        return []
    incumbent = min(best_fit(lengths, capacity), ends_first(lengths, capacity), key=len)
    total = int(lengths.sum())
    bound = fewest_sequences(lengths, capacity)
    left = np.bincount(lengths, minlength=capacity + 1)
    path: list[list[int]] = []  # the sequences so far
    choices: list[list[tuple[int, ...]]] = []  # fillings of each that are yet to be tried
    waste, steps = 0, 0

    def undo() -> int:
        gone = path.pop()
        np.add.at(left, gone, 1)
        return capacity - sum(gone)

    while len(incumbent) > bound and steps < nodes:
        steps += 1
        filled = not left.any()
        if filled and len(path) < len(incumbent):
            incumbent = [list(s) for s in path]
        # Waste beyond this can't give fewer sequences than the incumbent has.
        allowed = (len(incumbent) - 1) * capacity - total
        if not filled and waste <= allowed:
            largest = int(np.flatnonzero(left)[-1])
            left[largest] -= 1
            options = _fillings(left, capacity - largest, width)
            left[largest] += 1
            choices.append([(largest, *f) for f in reversed(options)])
        else:
            # Back to the last sequence that has another filling.
            while path and not choices[len(path) - 1]:
                waste -= undo()
                choices.pop()
            if not path:
                break
            waste -= undo()
        options = choices[-1]
        while options and waste + capacity - sum(options[-1]) > allowed:
            options.pop()
        if not options:
            choices.pop()
            while path and not choices[len(path) - 1]:
                waste -= undo()
                choices.pop()
            if not path:
                break
            waste -= undo()
            options = choices[-1]
        chosen = list(options.pop())
        np.subtract.at(left, chosen, 1)
        path.append(chosen)
        waste += capacity - sum(chosen)
    return incumbent


PACKED = f"{PIECES}, group long, sequence long, offset long, room long"


def _packed(capacity: int, nodes: int):
    """A mapInArrow function over rows that are sorted by group and length: sequence and offset of every row."""

    def places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sequences = complete_bins(lengths, capacity, nodes)
        bins = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
        members = np.array([n for s in sequences for n in s], dtype=np.int64)
        offsets = np.concatenate([np.cumsum([0, *s[:-1]]) for s in sequences])
        fill = np.array([sum(s) for s in sequences], dtype=np.int64)
        by_length = np.argsort(members, kind="stable")  # the i-th smallest member takes the i-th row
        return bins[by_length], offsets[by_length], capacity - fill[bins[by_length]]

    def solved(table: pa.Table) -> pa.RecordBatch:
        """All rows of one group."""
        batch = table.combine_chunks().to_batches()[0]
        added = [pa.array(x.astype(np.int64)) for x in places(np.asarray(batch.column("length")))]
        return pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "sequence", "offset", "room"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        held: list[pa.RecordBatch] = []  # rows of the group that goes on
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.asarray(batch.column("group"))
            starts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist()]
            for a, b in zip(starts, [*starts[1:], len(group)]):
                if held and held[0].column("group")[0].as_py() != group[a]:
                    yield solved(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield solved(pa.Table.from_batches(held))

    return pack


def _grouped(pieces: DataFrame, groups: int, first: int, group_pieces: int) -> DataFrame:
    """Adds ``group``: a hash of the row, and for rows of which there are many equal ones of their number too."""
    row = ["key", "piece", "ids_crc32", "length", "start"]
    counts = pieces.groupBy(*row).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > max(1, group_pieces // 16))
    counts = stage(counts.drop("copies"), "copied-pieces")
    dealt = F.xxhash64(F.lit(first), *row[:4])
    if counts.isEmpty():
        spread = pieces.withColumn("dealt", dealt)
    else:
        # Null keys are equal here too.
        same = [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in row]
        others = pieces.alias("p").join(counts.alias("c"), same, "left_anti")
        copies = number_rows(
            pieces.alias("p").join(counts.alias("c"), same, "left_semi").withColumn("like", F.xxhash64(F.col("key").isNull(), *row)),
            ["like"], row, "copy",
        )
        spread = stack(
            others.withColumn("dealt", dealt), copies.withColumn("dealt", F.xxhash64("like", "copy")).select(*pieces.columns, "dealt")
        )
    return spread.withColumn("group", (F.pmod("dealt", F.lit(groups)) + first).cast("long")).drop("dealt")


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, nodes: int = NODES, rounds: int = 2
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a stored table of pieces.

    ``sequence_id`` is unique and otherwise arbitrary.  A piece as long as the capacity fills a sequence alone.
    """
    done, rest, first = [], pieces, 0
    for turn in range(rounds):
        rows = rest.count()
        if not rows and done:
            break
        groups = max(1, -(-rows // group_pieces))
        # The rows are few bytes and much work: their number of tasks follows the groups, not the bytes.  Pieces of one
        # length are alike; the order of the others in a group makes the result the same at every run.
        dealt = _grouped(rest, groups, first, group_pieces).repartition(min(groups, TASKS), "group")
        sorted_rows = dealt.sortWithinPartitions("group", "length", "key", "piece", "ids_crc32", "start")
        packed = stage(sorted_rows.mapInArrow(_packed(capacity, nodes), PACKED), "packed")
        last, much = turn == rounds - 1, F.col("room") >= capacity * REOPENED
        done.append(packed if last else packed.where(~much))
        rest, first = packed.where(much).select(*pieces.columns), first + groups
    # Group and place in the group: a group has fewer sequences than pieces.
    return stack(*done).withColumn("sequence_id", F.shiftleft(F.col("group"), 32) + F.col("sequence")).drop(
        "group", "sequence", "room"
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document."""
    pieces = stage(token_pieces(docs, tokenizer, end_id, capacity, key, text), "pieces")
    return pack_pieces(pieces, capacity).select(
        F.col("key").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
