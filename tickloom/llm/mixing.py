"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Sources ask for shares of the mix in proportion to their weights.  A source gives
at most ``cap`` times its own size; what it can't give is shared by the others in
proportion to their weights, again and again until no source is above its cap.
The end of these rounds is found at once: in the order of size by weight the
sources at their cap come first, so running sums over the sources, one row for
each, tell which those are.

A source's target is taken in whole repetitions of all its documents and one
repetition of a part of them: in a seeded order each document is taken that still
fits into what is left of the part, so what is missed at the end is less than the
smallest document left out.  No source is sorted or walked through.  In rounds,
for all sources side by side: of the documents that are small enough, sums over
coarse buckets of the order name the bucket in which the rest runs out, sums over
its fine buckets one of these; all before it are taken, its few documents are
walked through, and the next round goes on behind it with the smaller rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.stacking import stack
from tickloom.sources.staging import stage

#: What is between words: space, and the characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
TOTAL, CAP = 1.5, 2.0
SEED = 20
#: Documents of a source in one fine bucket, about.
BUCKET_ROWS = 128
_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_place(key: Column, text: Column, seed: int) -> Column:
    """The row's place in the seeded order: the first 60 bits of an MD5 sum of seed, key and text."""
    named = F.concat_ws(
        "|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))
    )
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, total: float = TOTAL, cap: float = CAP
) -> DataFrame:
    """``source, source_size, rows, weight, target`` from rows of ``source, size``.

    ``weights`` go to the sources in the order of their code points, null last, and repeat.  The targets' sum is
    ``total`` times all sizes, or ``cap`` times them where that is less.
    """
    everywhere = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1
    )
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
        .withColumn("weight", weight)
    )
    earlier = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        sources.withColumn("wanted", total * F.sum("source_size").over(everywhere))
        .withColumn("given", cap * F.coalesce(F.sum("source_size").over(earlier), F.lit(0)))
        .withColumn("sharing", F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn(
            "capped", cap * F.col("source_size") * F.col("sharing") <= (F.col("wanted") - F.col("given")) * F.col("weight")
        )
    )
    rest = F.col("wanted") - cap * F.sum(F.when(F.col("capped"), F.col("source_size")).otherwise(0)).over(everywhere)
    sharing = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everywhere)
    target = F.when(F.col("capped"), cap * F.col("source_size")).otherwise(F.col("weight") * rest / sharing)
    return filled.select("source", "source_size", "rows", "weight", target.alias("target"))


_LAST = 2**63 - 1


def source_cuts(placed: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds to each source ``whole`` repetitions, and what of it is taken once more: ``spans`` and single ``places``.

    ``placed`` has a row ``source, size, place`` for each document; rows of one place are one document.  A span is taken
    from behind its ``start`` to its ``end`` but for documents above its ``limit``.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("rows") / BUCKET_ROWS))).cast("int")
    wanted = stage(
        targets.withColumn("whole", whole.cast("long"))
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("fine_shift", (_BITS - bits).cast("int"))
        .withColumn("coarse_shift", (_BITS - F.floor(bits / 2)).cast("int")),
        "mix-sources",
    )
    # A source taken in whole repetitions alone has no part; its empty texts would still fit into none.
    state = wanted.where("part > 0").select(
        F.col("source").alias("of"), F.floor("part").alias("rest"), F.lit(-1).cast("long").alias("start"), "fine_shift", "coarse_shift"
    )
    rounds = []
    state = stage(state, "mix-state")
    while not state.isEmpty():
        done = _round(placed, state)
        rounds.append(done)
        state = stage(
            done.where("edge is not null").select(
                "of", F.col("left").alias("rest"), F.expr("shiftleft(edge + 1, fine_shift) - 1").alias("start"), "fine_shift", "coarse_shift"
            ),
            "mix-state",
        )
    if not rounds:
        return wanted.select(
            "source", "source_size", "target", "whole",
            F.expr("cast(array() as array<struct<start: bigint, end: bigint, limit: bigint>>)").alias("spans"),
            F.expr("cast(array() as array<bigint>)").alias("places"),
        )
    end = F.when(F.col("edge").isNull(), F.lit(_LAST)).otherwise(F.expr("shiftleft(edge, fine_shift) - 1"))
    span = F.struct("start", end.alias("end"), F.col("rest").alias("limit"))
    taken = (
        stack(*rounds).groupBy("of")
        .agg(F.array_sort(F.collect_list(span)).alias("spans"), F.flatten(F.collect_list("places")).alias("places"))
    )
    return wanted.join(taken, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "target", "whole", "spans", "places"
    )


def _round(placed: DataFrame, state: DataFrame) -> DataFrame:
    """One round: ``state`` with the fine bucket ``edge`` in which the rest runs out (null if it doesn't), the ``places``
    taken in it and what is ``left`` after it."""
    same = F.col("source").eqNullSafe(F.col("of"))
    rows = placed.join(state, same).where((F.col("place") > F.col("start")) & (F.col("size") <= F.col("rest")))
    rows = rows.withColumn("coarse", F.expr("shiftright(place, coarse_shift)")).withColumn(
        "fine", F.expr("shiftright(place, fine_shift)")
    )
    sums = rows.groupBy("source", "rest", "coarse", "fine").agg(F.sum("size").alias("size"))
    sums = stage(sums, "mix-buckets")

    def edge(buckets: DataFrame, by: str) -> DataFrame:
        """Of every source the bucket in which the sum of sizes passes its rest, and the sum before it."""
        up_to = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = buckets.withColumn("upto", F.col("before") + F.sum("size").over(up_to))
        return (
            upto.where(F.col("upto") > F.col("rest"))
            .groupBy("source")
            .agg(F.min_by(F.struct(by, (F.col("upto") - F.col("size")).alias("before")), by).alias("edge"))
            .select(F.col("source").alias("at"), F.col(f"edge.{by}").alias("edge"), F.col("edge.before").alias("before"))
        )

    there = F.col("source").eqNullSafe(F.col("at"))
    coarse = sums.groupBy("source", "rest", "coarse").agg(F.sum("size").alias("size")).withColumn("before", F.lit(0).cast("long"))
    in_coarse = stage(edge(coarse, "coarse"), "mix-coarse")
    in_fine = stage(
        edge(sums.join(in_coarse, there & (F.col("coarse") == F.col("edge"))).drop("at", "edge"), "fine"), "mix-fine"
    )
    # Documents of the edge buckets, in order, each taken if it still fits.
    near = (
        rows.join(in_fine, there & (F.col("fine") == F.col("edge")))
        .groupBy("source", "rest", "before", "place")
        .agg(F.sum("size").alias("size"))
    )
    nothing = F.struct((F.col("rest") - F.col("before")).alias("left"), F.expr("cast(array() as array<bigint>)").alias("places"))

    def taken(so_far: Column, doc: Column) -> Column:
        more = F.struct(
            (so_far["left"] - doc["size"]).alias("left"), F.concat(so_far["places"], F.array(doc["place"])).alias("places")
        )
        return F.when(doc["size"] <= so_far["left"], more).otherwise(so_far)

    walked = (
        near.groupBy("source", "rest", "before")
        .agg(F.sort_array(F.collect_list(F.struct("place", "size"))).alias("docs"))
        .select(F.col("source").alias("walked"), F.aggregate("docs", nothing, taken).alias("walk"))
    )
    out = (
        state.join(in_fine.drop("before"), F.col("of").eqNullSafe(F.col("at")) & F.col("edge").isNotNull(), "left")
        .join(walked, F.col("of").eqNullSafe(F.col("walked")) & F.col("edge").isNotNull(), "left")
        .select(*state.columns, "edge", "walk.left", F.coalesce("walk.places", F.expr("cast(array() as array<bigint>)")).alias("places"))
    )
    return stage(out, "mix-round")


def _taken(docs: DataFrame, weights, total: float, cap: float, seed: int, key: str, text: str, source: str) -> DataFrame:
    """``doc`` (a row of ``docs``), ``size, source_size, target, repeats``."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        seeded_place(F.col(f"`{key}`"), F.col(f"`{text}`"), seed).alias("place"),
    )
    placed = stage(sized.select("source", "size", "place"), "mix-places")
    cuts = stage(source_cuts(placed, source_targets(placed, weights, total, cap)), "mix-cuts")
    cuts = cuts.withColumnRenamed("source", "of")
    inside = F.exists("spans", lambda s: (F.col("place") > s["start"]) & (F.col("place") <= s["end"]) & (F.col("size") <= s["limit"]))
    once_more = F.coalesce(inside | F.array_contains("places", F.col("place")), F.lit(False))
    joined = sized.join(cuts, F.col("source").eqNullSafe(F.col("of")))
    return joined.select(
        "doc", "size", "source_size", "target", (F.col("whole") + F.when(once_more, 1).otherwise(0)).alias("repeats")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total: float = TOTAL,
    cap: float = CAP,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``mix_size, mix_source_size, mix_target, mix_repeats``: how often the mix takes each row.

    A row's size is its number of words, 0 for a null text.  A null source is a source of its own, the last one.  Rows
    equal in key and text have one place in the seeded order and are taken alike.  An empty table gives an empty one.
    Columns of ``docs`` that have the names of the added ones are replaced.
    """
    added = {f"mix_{name}": F.col(name) for name in ("size", "source_size", "target", "repeats")}
    own = [c for c in docs.columns if c.lower() not in added]
    taken = _taken(docs, weights, total, cap, seed, key, text, source)
    return taken.select(*[F.col("doc")[c].alias(c) for c in own], *[column.alias(name) for name, column in added.items()])


def mixed_rows(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total: float = TOTAL,
    cap: float = CAP,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    taken = _taken(docs, weights, total, cap, seed, key, text, source).where("repeats > 0")
    copies = taken.select("doc", F.explode(F.expr("sequence(1, cast(repeats as int))")))
    return copies.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
