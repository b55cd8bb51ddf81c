"""Trie of conversation prefixes, with subtree totals by centroid decomposition.

A node stands for a distinct sequence of first turns; its members are the
conversations that start with it.  Prefixes are compared by two 64-bit hashes
that are the running xor of a hash of (position, turn), so they come out of a
running aggregate in blocks and no task holds a conversation.

Totals over subtrees follow the forest of parent edges.  A component is weighed
in turns: a node weighs as much as it has members, and what hangs below it weighs
the turns its members have from there on, which the aggregate that makes the
nodes yields as well.  In every round

* the centroid of a component is the lowest node with more than half of the
  component's weight at and below it; the nodes with more than half are the path
  from the top of the component to it;
* the values at and below the centroid are added up and the sum is added to the
  nodes of that path, which finishes the centroid;
* the edges at the centroid are cut.  What is left hangs together in components of
  at most half the weight: one for every child, and the rest with the top.

So a node takes part in as many rounds as the logarithm of the weight, however
deep the trie is.  Rounds over components above ``BOUND`` turns are joins and
aggregates over staged tables; a component below it is finished within one task,
by the same rounds over numpy arrays for many components at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.series import number_rows, running_rows
from tickloom.operators.stacking import stack
from tickloom.sources.staging import stage

#: Turns in a component that one task finishes, at most.
BOUND = 1 << 15
#: A node is joined by broadcast when it has more than this part of all turns; so there are fewer such nodes.
HOT_PART = 512
#: Nodes that a task decomposes together, about.
TOGETHER = 1 << 17
#: Ids of one node that are joined into one piece of text.
PIECE_IDS = 1024

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def order_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, pos, said, chars``: every turn with its number from 1, a digest of role and text, and its code points.

    Turns are ordered by ``turn``, null first; turns of one number, repeated rows among them, in the order of the digest.
    A null role or text is empty.  Rows without a conversation's id are left out.
    """
    who, what = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    narrow = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what)).alias("said"),
        F.length(what).cast("long").alias("chars"),
    )
    return number_rows(narrow, ["conv_id"], ["turn", "said"], "pos").select("conv_id", "pos", "said", "chars")


def borrow_heads(turns: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the head of another one: their turns, and ``conv_id, length`` of each.

    Conversation c takes the first h turns of conversation ``c - c % every`` (all, if it has fewer; none, if there is no
    such one) in place of its own first h; h is the CRC-32 of c in decimal digits modulo ``most + 1``.
    """
    turns = stage(turns, "turns")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    lenders = sizes.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("lent"))
    convs = (
        sizes.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1)))
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
        .join(lenders, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("lent", F.lit(0))))
        .withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
        .select("conv_id", "base", "h", "taken", "length")
    )
    convs = stage(convs, "conversations")
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") <= most)).withColumnRenamed("conv_id", "base")
    borrowed = convs.join(heads, "base").where("pos <= h").select("conv_id", "pos", "said", "chars", "length")
    kept = turns.join(convs, "conv_id").where("pos > h")
    kept = kept.select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "said", "chars", "length")
    return stage(stack(borrowed, kept), "rebuilt-turns"), convs.select("conv_id", "length")


def _paths(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, length, node, n_convs, weight, chars``: every turn of every conversation with the node it leads to.

    ``node`` is the node's least member; with ``pos`` it names the node.
    """
    hashed = turns.withColumns({"a": F.xxhash64(F.lit(1), "pos", "said"), "b": F.xxhash64(F.lit(2), "pos", "said")})
    hashed = running_rows(hashed, ["conv_id"], {"x": ("xor", "a"), "y": ("xor", "b")}, row="pos")
    hashed = stage(hashed.select("conv_id", "pos", "x", "y", "length", "chars"), "prefixes")
    key = ["pos", "x", "y"]
    nodes = hashed.groupBy(*key).agg(
        F.min("conv_id").alias("node"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("pos") + 1).alias("weight"),
    )
    nodes = stage(nodes, "nodes")
    hot = F.col("n_convs") * HOT_PART > hashed.count()
    # All nodes' members together are the rows, so fewer than HOT_PART nodes are hot.
    busy = F.broadcast(nodes.where(hot))
    rest = hashed.join(F.broadcast(nodes.where(hot).select(*key)), key, "left_anti").join(nodes.where(~hot), key)
    return stack(hashed.join(busy, key), rest).drop("x", "y")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, pos, conv_id) to pieces of text that join the ids of one node."""

    def record(pieces):
        node, pos, first, text = zip(*pieces)
        return pa.RecordBatch.from_arrays(
            [pa.array(node, pa.int64()), pa.array(pos, pa.int64()), pa.array(first, pa.int64()), pa.array(text, pa.string())],
            ["node", "pos", "first", "ids"],
        )

    key, own, ready = None, [], []
    for batch in batches:
        for node, pos, conv in zip(*(batch.column(name).to_pylist() for name in ("node", "pos", "conv_id"))):
            if own and (key != (node, pos) or len(own) == PIECE_IDS):
                ready.append((*key, own[0], ",".join(map(str, own))))
                own = []
                if len(ready) == 4096:
                    yield record(ready)
                    ready = []
            key = (node, pos)
            own.append(conv)
    if own:
        ready.append((*key, own[0], ",".join(map(str, own))))
    if ready:
        yield record(ready)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (node, pos, first) to one SHA-256 for each node, fed piece after piece."""

    def record(done):
        node, pos, digest = zip(*done)
        return pa.RecordBatch.from_arrays(
            [pa.array(node, pa.int64()), pa.array(pos, pa.int64()), pa.array(digest, pa.string())],
            ["conv_id", "depth", "ends_sha256"],
        )

    key, state, done = None, None, []
    for batch in batches:
        for node, pos, ids in zip(*(batch.column(name).to_pylist() for name in ("node", "pos", "ids"))):
            if key == (node, pos):
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (node, pos), hashlib.sha256()
            state.update(ids.encode())
            if len(done) >= 8192:
                yield record(done)
                done = []
    if key is not None:
        done.append((*key, state.hexdigest()))
    if done:
        yield record(done)


def _end_digests(ends: DataFrame) -> DataFrame:
    """``conv_id, depth, ends_sha256`` of nodes at which conversations end.

    A digest is one sequence by nature.  Ids are joined in parallel, in ranges that may split a node, so the task that
    digests a node reads one piece for a thousand ids.
    """
    by = ["node", "pos", "conv_id"]
    pieces = ends.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(
        _joined_ids, "node long, pos long, first long, ids string"
    )
    by = ["node", "pos", "first"]
    return pieces.repartition("node", "pos").sortWithinPartitions(*by).mapInArrow(
        _digests, "conv_id long, depth long, ends_sha256 string"
    )


def trie_nodes(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, paths and ends of the trie of conversations.

    Nodes have ``conv_id, depth, parent, n_convs, weight, chars, n_children``; paths ``conv_id, pos, node, parent`` for
    every turn of every conversation; ends ``node, pos, conv_id`` for every conversation.
    """
    root = convs.agg(F.min("conv_id"), F.count(F.lit(1)), F.sum(F.col("length") + 1)).first()
    top = F.lit(root[0]).cast("long")
    steps = stage(_paths(turns), "steps")
    above = steps.select("conv_id", (F.col("pos") + 1).alias("pos"), F.col("node").alias("parent"))
    paths = steps.join(above, ["conv_id", "pos"], "left").withColumn("parent", F.coalesce("parent", top))
    paths = stage(paths, "paths")
    own = paths.where("conv_id = node")
    children = own.groupBy(F.col("parent").alias("conv_id"), (F.col("pos") - 1).alias("pos")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    inner = own.join(children, ["conv_id", "pos"], "left").select(
        "conv_id", F.col("pos").alias("depth"), "parent", "n_convs", "weight", "chars",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
    )
    first = (
        children.where("pos = 0").agg(F.coalesce(F.sum("n_children"), F.lit(0)).alias("n_children"))
        .where(F.lit(root[1] > 0))
        .select(
            top.alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"),
            F.lit(root[1]).cast("long").alias("n_convs"), F.lit(root[2]).cast("long").alias("weight"),
            F.lit(0).cast("long").alias("chars"), "n_children",
        )
    )
    ends = stack(
        paths.where("pos = length").select("node", "pos", "conv_id"),
        convs.where("length = 0").select(top.alias("node"), F.lit(0).cast("long").alias("pos"), "conv_id"),
    )
    return stage(stack(inner, first), "trie"), paths.select("conv_id", "pos", "node", "parent"), ends


def _cut(state: DataFrame, paths: DataFrame, large: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """One round over the components in ``large``: (finished centroids, the nodes that are left)."""
    comp = ["comp", "comp_depth"]
    big = state.join(large, comp)
    heavy = F.col("weight") * 2 > F.col("whole")
    centres = big.where(heavy).groupBy(*comp).agg(F.min(F.struct("weight", "conv_id", "depth")).alias("c"))
    centres = stage(
        centres.select(*comp, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")),
        "centroids",
    )
    # A node hangs below the centroid if its path leads through it; the next step of the path is the new component's top.
    step = F.when(F.col("depth") > F.col("c_depth"), F.col("c_depth") + 1)
    seen = paths.select("conv_id", F.col("pos").alias("step"), F.col("node").alias("x"), F.col("parent").alias("above"))
    tagged = big.join(centres, comp).withColumn("step", step).join(seen, ["conv_id", "step"], "left")
    below = F.coalesce(F.col("above") == F.col("c_conv"), F.lit(False))
    centre = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
    tagged = stage(tagged.withColumns({"below": below, "centre": centre}), "tagged")
    sums = tagged.where("below or centre").groupBy(*comp).agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
    joined = tagged.join(stage(sums, "totals"), comp)
    done = joined.where("centre").select("conv_id", "depth", *[(F.col(f"acc_{v}") + F.col(f"sum_{v}")).alias(v) for v in values])
    on_path = heavy & ~F.col("below")
    left = joined.where("not centre").select(
        "conv_id",
        "depth",
        "parent",
        (F.col("weight") - F.when(on_path, F.col("c_weight")).otherwise(0)).alias("weight"),
        *values,
        *[(F.col(f"acc_{v}") + F.when(on_path, F.col(f"sum_{v}")).otherwise(0)).alias(f"acc_{v}") for v in values],
        F.when(F.col("below"), F.col("x")).otherwise(F.col("comp")).alias("comp"),
        F.when(F.col("below"), F.col("step")).otherwise(F.col("comp_depth")).alias("comp_depth"),
    )
    return done, left


def decompose(parent: np.ndarray, weight: np.ndarray, values: np.ndarray, acc: np.ndarray) -> tuple[np.ndarray, int]:
    """Subtree totals of a forest, and the rounds they took.

    ``parent`` is the index of a node's parent, or its own index at a top; ``weight`` what hangs at and below a node;
    ``values`` and ``acc`` have a row for each node: its own values, and what is known to hang below it already.
    """
    n = len(parent)
    weight, total = weight.copy(), acc.copy()
    alive, top, rounds = np.ones(n, bool), np.arange(n), 0
    link = parent.copy()
    while alive.any():
        rounds += 1
        # The top of every living node: cut edges point to themselves.
        top = link
        while True:
            further = top[top]
            if np.array_equal(further, top):
                break
            top = further
        heavy = np.flatnonzero(alive & (2 * weight > weight[top]))
        # Lowest on the path: the least weight of the heavy nodes of a component.
        order = heavy[np.lexsort((weight[heavy], top[heavy]))]
        centre = order[np.concatenate(([True], top[order][1:] != top[order][:-1]))]
        of = np.full(n, -1)
        of[top[centre]] = centre
        mine = np.where(alive, of[top], -1)
        is_centre = np.zeros(n, bool)
        is_centre[centre] = True
        # Cut: the centroids, and the edges to their children.
        child = alive & is_centre[link] & (link != np.arange(n)) & ~is_centre
        freed = link.copy()
        freed[child] = np.flatnonzero(child)
        freed[centre] = centre
        reach = freed
        while True:
            further = reach[reach]
            if np.array_equal(further, reach):
                break
            reach = further
        below = alive & (is_centre[reach] | child[reach])
        sums = np.zeros_like(total)
        np.add.at(sums, mine[below], values[below])
        path = heavy[~below[heavy]]
        total[path] += sums[mine[path]]
        weight[path] -= weight[mine[path]]
        total[centre] += sums[centre]
        alive[centre] = False
        link = freed
    return total, rounds


def _totals(values: list[str]):
    """A mapInArrow function: totals of whole components, which come sorted."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        conv, depth, up = (np.asarray(table[name]) for name in ("conv_id", "depth", "parent"))
        comp, comp_depth = np.asarray(table["comp"]), np.asarray(table["comp_depth"])
        names, code = np.unique(conv, return_inverse=True)
        span = int(depth.max()) + 2
        place = code * span + depth
        order = np.argsort(place)
        is_top = (conv == comp) & (depth == comp_depth)
        at = np.minimum(np.searchsorted(names, up), len(names) - 1) * span + depth - 1
        parent = order[np.minimum(np.searchsorted(place, at, sorter=order), len(order) - 1)]
        parent[is_top] = np.flatnonzero(is_top)
        columns = [np.stack([np.asarray(table[f"{kind}{v}"]) for v in values], axis=1) for kind in ("", "acc_")]
        total, _ = decompose(parent, np.asarray(table["weight"]), *columns)
        return pa.RecordBatch.from_arrays(
            [pa.array(conv), pa.array(depth), *(pa.array(total[:, i]) for i in range(len(values)))], ["conv_id", "depth", *values]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count >= TOGETHER:
                table = pa.Table.from_batches(held)
                comp, deep = np.asarray(table["comp"]), np.asarray(table["comp_depth"])
                last = int(np.flatnonzero((comp != comp[-1]) | (deep != deep[-1]))[-1]) + 1 if (
                    (comp[0], deep[0]) != (comp[-1], deep[-1])
                ) else 0
                if last:
                    yield solve(table.slice(0, last).combine_chunks())
                held = table.slice(last).combine_chunks().to_batches()
                count = sum(b.num_rows for b in held)
        if count:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    return run


def subtree_totals(nodes: DataFrame, paths: DataFrame, values: dict[str, Column], bound: int = BOUND) -> DataFrame:
    """``conv_id, depth`` and the sums of ``values``, integers of each node, over every node's subtree."""
    names = list(values)
    root = nodes.where("depth = 0").select("conv_id").first()
    top = F.lit(root[0] if root else None).cast("long")
    state = nodes.select(
        "conv_id", "depth", "parent", "weight",
        *[v.cast("long").alias(name) for name, v in values.items()],
        *[F.lit(0).cast("long").alias(f"acc_{name}") for name in names],
        top.alias("comp"), F.lit(0).cast("long").alias("comp_depth"),
    )
    comp, ready = ["comp", "comp_depth"], []
    state = stage(state, "components")
    while True:
        large = state.groupBy(*comp).agg(F.max("weight").alias("whole")).where(F.col("whole") > bound)
        large = stage(large, "large-components")
        if large.isEmpty():
            break
        done, left = _cut(state, paths, large, names)
        ready.append(stage(done, "centroid-totals"))
        small = state.join(large.select(*comp), comp, "left_anti")
        state = stage(stack(left, small.select(*left.columns)), "components")
    schema = ", ".join(f"{name} long" for name in ["conv_id", "depth", *names])
    rest = state.repartition(*comp).sortWithinPartitions(*comp).mapInArrow(_totals(names), schema)
    return stack(rest, *ready)


def prefix_trie(turns: DataFrame, convs: DataFrame, bound: int = BOUND) -> DataFrame:
    """Every node of the trie of conversations.

    ``turns`` has ``conv_id, pos, said, chars, length`` (positions from 1 without gaps, a digest of the turn, its code
    points, the conversation's turns) and ``convs`` every conversation's ``conv_id, length``, turnless ones included.
    Columns: ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes in the subtree), ``saved_tokens`` (over the subtree, code points of a node's turn for
    every member but one), ``ends_sha256`` (of the ids of the conversations that end at the node, ascending and joined
    by commas).  Without conversations there is no node.
    """
    nodes, paths, ends = trie_nodes(turns, convs)
    totals = subtree_totals(
        nodes,
        paths,
        {"n_leaves": F.col("n_children") == 0, "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")},
        bound,
    )
    # Staged: a Python step of its own for each side of the joins.
    totals, digests = stage(totals, "subtree-totals"), stage(_end_digests(ends), "ends")
    key = ["conv_id", "depth"]
    return nodes.join(totals, key).join(digests, key, "left").select(
        *key,
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
