"""Trades of one group in order of (time, id), however many: runs sorted in memory and written, then merged batch by batch."""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs

from tickloom.operators.candles import id_turn

#: Rows of a run, rows that are read of one at a time, and short runs that are kept before they are merged into longer ones.
RUN_ROWS, BATCH_ROWS, SHORT_RUNS = 1 << 18, 1 << 11, 64
_TURN = ["_turn_kind", "_turn_length", "_turn_text"]
_FACTS = {"path": pa.string(), "rows": pa.int64(), "done": pa.int64(), "least": pa.int64()}
_MARK = {b"holds": b"runs"}


def turned(rows: pd.DataFrame) -> pa.Table:
    """The rows with their ids' places in the order as columns."""
    table = pa.Table.from_pandas(rows, preserve_index=False).replace_schema_metadata(None)
    turns = [id_turn(None if pd.isna(t) else str(t)) for t in rows["trade_id"]]
    kinds = (pa.int8(), pa.int64(), pa.string())
    for name, kind, values in zip(_TURN, kinds, zip(*turns)):
        table = table.append_column(name, pa.array(values, kind))
    return table


def plain(table: pa.Table) -> pd.DataFrame:
    return table.drop_columns(_TURN).to_pandas()


def _joined(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables, promote_options="permissive").combine_chunks()


def _sorted(tables: list[pa.Table], at: str) -> pa.Table:
    table = _joined(tables)
    return table.take(pc.sort_indices(table, [(c, "ascending") for c in (at, *_TURN)]))


def sorted_tables(tables: Iterable[pa.Table], at: str) -> Iterator[pa.Table]:
    """The rows in tables of up to about ``RUN_ROWS``, each in order."""
    held, rows = [], 0
    for table in tables:
        held.append(table)
        rows += table.num_rows
        if rows >= RUN_ROWS:
            yield _sorted(held, at)
            held, rows = [], 0
    if rows:
        yield _sorted(held, at)


class Run:
    """A file of rows in order of ``at`` and id, of which the first ``done`` have had their turn."""

    def __init__(self, path: str, rows: int, done: int, least: int):
        self.path, self.rows, self.done, self.least = path, rows, done, least

    @classmethod
    def write(cls, table: pa.Table, folder: str, at: str) -> Run:
        """The name is unique, so an attempt that runs again never meets the file of one that was lost."""
        path = f"{folder.rstrip('/')}/run-{uuid.uuid4().hex}.arrow"
        system, place = fs.FileSystem.from_uri(path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with system.open_output_stream(place, compression=None) as sink, pa.ipc.new_file(sink, table.schema, options=options) as writer:
            writer.write_table(table, max_chunksize=BATCH_ROWS)
        return cls(path, table.num_rows, 0, table[at][0].as_py())

    def tables(self, at: str, until: int | None = None) -> Iterator[pa.Table]:
        """The rows whose turn has not come yet, up to the time ``until``; they are done as they are read."""
        system, place = fs.FileSystem.from_uri(self.path)
        with system.open_input_file(place) as source:
            reader = pa.ipc.open_file(source)
            size = reader.get_batch(0).num_rows  # of all batches but the last
            while self.done < self.rows:
                number, skip = divmod(self.done, size)
                table = pa.Table.from_batches([reader.get_batch(number)]).slice(skip)
                times = np.asarray(table[at])
                reached = len(times) if until is None else int(np.searchsorted(times, until, side="right"))
                self.done += reached
                if reached:
                    yield table.slice(0, reached)
                if reached < len(times):
                    self.least = int(times[reached])
                    return

    def delete(self) -> None:
        system, place = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(place).type != fs.FileType.NotFound:
            system.delete_file(place)


class _Head:
    """The batch of a sorted source that is read just now."""

    def __init__(self, source: Iterator[pa.Table], at: str):
        self.source, self.at, self.table = source, at, None
        self.next()

    def next(self) -> bool:
        self.table = next(self.source, None)
        if self.table is not None:
            self.times = np.asarray(self.table[self.at])
            self.turns = [self.table[c] for c in _TURN]
        return self.table is not None

    def key(self, i: int) -> tuple:
        return int(self.times[i]), *(c[i].as_py() for c in self.turns)

    def upto(self, bound: tuple) -> pa.Table | None:
        """Takes the rows up to ``bound``."""
        low, high = np.searchsorted(self.times, bound[0], side="left"), np.searchsorted(self.times, bound[0], side="right")
        n = bisect_right(range(len(self.times)), bound, int(low), int(high), key=self.key)
        if not n:
            return None
        out, self.table, self.times = self.table.slice(0, n), self.table.slice(n), self.times[n:]
        self.turns = [self.table[c] for c in _TURN]
        return out


def merged(sources: list[Iterator[pa.Table]], at: str) -> Iterator[pa.Table]:
    """The rows of sorted sources in order, a batch of each held at a time."""
    heads = [h for h in (_Head(s, at) for s in sources) if h.table is not None]
    while len(heads) > 1:
        bound = min(h.key(len(h.times) - 1) for h in heads)
        parts = [part for part in (h.upto(bound) for h in heads) if part is not None]
        yield _sorted(parts, at) if len(parts) > 1 else parts[0]
        heads = [h for h in heads if len(h.times) or h.next()]
    for head in heads:
        yield head.table
        yield from head.source


def lengthened(runs: list[Run], folder: str, at: str) -> list[Run]:
    """The runs, many short ones made into few; those that took their place are done."""
    short = [r for r in runs if 0 < r.rows - r.done < RUN_ROWS // 2]
    if len(short) <= SHORT_RUNS:
        return runs
    # In order already, so each table is a run behind the one before.
    longer = [Run.write(t, folder, at) for t in sorted_tables(merged([r.tables(at) for r in short], at), at)]
    return [*runs, *longer]


def packed_runs(runs: list[Run]) -> bytes | None:
    """The runs for the state."""
    if not runs:
        return None
    table = pa.table({c: pa.array([getattr(r, c) for r in runs], kind) for c, kind in _FACTS.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema.with_metadata(_MARK)) as writer:
        writer.write_table(table.replace_schema_metadata(_MARK))
    return sink.getvalue().to_pybytes()


def unpacked_runs(waiting: bytes | None) -> list[Run] | None:
    """The runs in the state; nothing if it holds trades or none."""
    if waiting is None:
        return None
    reader = pa.ipc.open_stream(bytes(waiting))
    if not reader.schema.metadata or reader.schema.metadata.get(b"holds") != b"runs":
        return None
    return [Run(**r) for r in reader.read_all().to_pylist()]
