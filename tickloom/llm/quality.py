"""Quality by random-indexing word vectors and a two-layer network.

Words, with their case, and runs of digits and signs are hashed into a fixed
number of slots.  Every slot has a sparse random vector; a slot's word vector is
the sum of the random vectors of its neighbours over the whole corpus, put beside
what is random of its own.  A text is the mean and spread of its words' vectors
and how like neighbours are.  A network with one hidden layer, written in numpy,
turns that into a logit, and a temperature fitted on texts it has not seen makes
its probabilities honest.

The vectors come from all texts; their table has ``SLOTS`` rows whatever the
corpus.  The network is fitted on a bounded sample of labelled texts (``SAMPLE``
of each class).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.chunks import ChunkEncoder, give_back, slices, worker_encoder
from tickloom.llm.samples import labelled_sample

SLOTS, WIDTH, NONZERO, REACH = 1 << 14, 32, 4, 2
SEED = 9
#: Labelled texts of each class the network is fitted on, at most.
SAMPLE = 6000
HIDDEN, STEPS, PENALTY = 32, 400, 1e-4
SLICE = 1 << 20

_TOKEN = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+")
#: The same for pieces joined by NUL, which no piece holds.
_JOINED = re.compile(r"\0|[^\W\d_]+|\d+|(?:[^\w\s\0]|_)+")
#: Words pooled at a time, so that their vectors stay in the processor's cache.
POOLED = 4096


def _slots(text: str) -> list[int]:
    return [zlib.crc32(t.encode()) % SLOTS for t in _TOKEN.findall(text)]


def _slots_of_pieces(pieces: list[str]) -> list[bytes]:
    """``_slots`` of each piece, by one search over all of them."""
    tokens = _JOINED.findall("\0".join([*pieces, ""]))
    crc = zlib.crc32
    codes = np.array([crc(t.encode()) % SLOTS for t in tokens], np.uint16)
    ends = np.flatnonzero(np.array([t == "\0" for t in tokens], bool)).tolist()
    data = codes.tobytes()
    return [data[2 * a : 2 * b] for a, b in zip([0, *(e + 1 for e in ends)], ends)]


def slot_encoder() -> ChunkEncoder:
    """Texts to slots."""
    return worker_encoder("slots", lambda: ChunkEncoder(_slots_of_pieces, _slots, np.uint16))


def random_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of every slot the places that are not 0 in its random vector, and their signs."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((SLOTS, WIDTH)), axis=1)[:, :NONZERO]
    return places.astype(np.int32), rng.choice(np.array([-1, 1], np.int32), (SLOTS, NONZERO))


def neighbour_sums(docs: DataFrame, text: str = "text") -> DataFrame:
    """``slot, d0, d1, ...``: sums of the random vectors of all neighbours up to ``REACH`` words away, over all texts."""
    names = [f"d{i}" for i in range(WIDTH)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, (places, signs) = slot_encoder(), random_vectors()
        sums = np.zeros(SLOTS * WIDTH, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                lengths, slots = encode(part.column("text"))
                slots, owner = slots.astype(np.int32), np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
                for step in range(1, REACH + 1):
                    same = owner[step:] == owner[:-step]
                    left, right = slots[:-step][same], slots[step:][same]
                    for word, other in ((left, right), (right, left)):
                        cells = (word[:, None] * np.int32(WIDTH) + places[other]).ravel()
                        sums += np.bincount(cells, signs[other].ravel(), minlength=len(sums)).astype(np.int64)
            give_back()
        table = sums.reshape(SLOTS, WIDTH)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), *(pa.array(table[used, i]) for i in range(WIDTH))], ["slot", *names]
        )

    schema = ", ".join(["slot long", *(f"{n} long" for n in names)])
    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, schema)
    return counted.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Slots by twice the width: the neighbours' direction, without what all words share, and the slot's own vector."""
    table = neighbour_sums(docs, text).toArrow()
    sums = np.zeros((SLOTS, WIDTH))
    slots = np.asarray(table["slot"])
    sums[slots] = np.column_stack([np.asarray(table[f"d{i}"]) for i in range(WIDTH)]) if len(slots) else 0
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = sums / np.maximum(size, 1)
    unit -= (unit * size).sum(axis=0) / max(1.0, size.sum())
    places, signs = random_vectors()
    own = np.zeros((SLOTS, WIDTH))
    np.put_along_axis(own, places.astype(np.int64), signs / np.sqrt(NONZERO), axis=1)
    return np.concatenate([unit, own], axis=1).astype(np.float32)


FEATURES = 4 * WIDTH + 4


def pooled(vectors: np.ndarray, lengths: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text; an empty text's row is 0.

    A text's equal words are counted first, so each adds its vector once; the vectors of a few thousand words are held
    at a time, however long a text is.
    """
    out = np.zeros((len(lengths), FEATURES), np.float32)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    n = lengths[full].astype(np.float32)
    starts = (np.cumsum(lengths) - lengths)[full]
    # Texts by different words and how often each stands in them.
    place = np.repeat(np.arange(len(full)) * SLOTS, lengths[full]) + slots
    if len(full) * SLOTS < 1 << 31:
        place = place.astype(np.int32)
    place.sort()
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    counts = np.diff(np.append(first, len(place))).astype(np.float32)
    place = place[first]
    different, owner = place % SLOTS, place // SLOTS
    bounds = np.searchsorted(owner, np.arange(len(full) + 1)).tolist()
    # Sums and sums of squares by one product for each text.
    both = np.concatenate([vectors, vectors * vectors], axis=1)
    sums = np.zeros((len(full), 4 * WIDTH), np.float32)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        for at in range(a, b, POOLED):
            some = slice(at, min(at + POOLED, b))
            sums[i] += counts[some] @ both[different[some]]
    sums /= n[:, None]
    mean, square = sums[:, : 2 * WIDTH], sums[:, 2 * WIDTH :]
    spread = np.sqrt(np.maximum(square - mean * mean, 0))
    repeated = np.concatenate(([0.0], slots[1:] == slots[:-1]))
    likeness = np.zeros(len(slots))
    for at in range(0, len(slots), POOLED):
        words = vectors[slots[at : at + POOLED + 1]]
        likeness[at + 1 : at + POOLED + 1] = np.einsum("ij,ij->i", words[1:], words[:-1])
    repeated[starts], likeness[starts] = 0, 0  # a text's first word has none before it
    scalars = [np.add.reduceat(x, starts) / n for x in (repeated, likeness)]
    fresh = np.diff(bounds) / n
    out[full] = np.column_stack([mean, spread, *scalars, fresh, np.log1p(n)])
    return out


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the logit."""

    center: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.center) / self.scale @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x.astype(np.float64)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def gradients(parameters: list[np.ndarray], z: np.ndarray, w: np.ndarray, t: np.ndarray) -> list[np.ndarray]:
    """Of the weighted log loss with a small penalty on the weights: first layer, its bias, second layer, its bias."""
    first, bias, second, offset = parameters
    hidden = np.maximum(z @ first + bias, 0)
    error = w * (_sigmoid(hidden @ second + offset) - t)
    back = np.outer(error, second) * (hidden > 0)
    return [z.T @ back + PENALTY * first, back.sum(axis=0), hidden.T @ error + PENALTY * second, error.sum()]


def fit_network(x: np.ndarray, y: np.ndarray, weight: np.ndarray, unseen: np.ndarray) -> Network:
    """Full-batch Adam on the rows not ``unseen``; the temperature is the one with the least log loss on the others."""
    rng = np.random.default_rng(SEED)
    x = x.astype(np.float64)
    train = ~unseen if (~unseen).any() else np.ones(len(y), bool)
    center, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-6
    z, t = ((x - center) / scale)[train], y[train]
    w = weight[train] / weight[train].sum()
    parameters = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.array(float(np.log((w @ t + 1e-3) / (w @ (1 - t) + 1e-3)))),
    ]
    mean, square = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, STEPS + 1):
        for i, g in enumerate(gradients(parameters, z, w, t)):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            parameters[i] = parameters[i] - 0.02 * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-9)
    network = Network(center, scale, parameters[0], parameters[1], parameters[2], float(parameters[3]))
    if unseen.any():
        logits, own = network.logits(x[unseen]), weight[unseen]

        def loss(temperature: float) -> float:
            p = np.clip(_sigmoid(logits / temperature), 1e-9, 1 - 1e-9)
            return float(-(own * (y[unseen] * np.log(p) + (1 - y[unseen]) * np.log(1 - p))).sum())

        network.temperature = float(min(np.exp(np.linspace(-1.5, 2.5, 161)), key=loss))
    return network


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network | None

    def score(self, lengths: np.ndarray, slots: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.ones(len(lengths))
        return self.network.probabilities(pooled(self.vectors, lengths, slots))


def fit_quality(
    docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", sample: int = SAMPLE, key: str = "doc_id",
    text: str = "text",
) -> QualityModel:
    """Word vectors from all of ``docs``, a network from at most ``sample`` labelled rows of each class not ``held_out``.

    Without labelled rows of both classes there is no network, and every text counts as good.
    """
    vectors = word_vectors(docs, text)
    rows, sizes = labelled_sample(docs, labels, label, held_out, sample, key, text)
    known = docs.sparkSession.sparkContext.broadcast(vectors)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                x = pooled(known.value, *slot_encoder()(part.column("text")))
                yield pa.RecordBatch.from_pydict(
                    {"key": part.column("key"), "label": part.column("label"), "x": pa.array(list(x), pa.list_(pa.float32()))}
                )
            give_back()

    seen = rows.select(F.col("key").cast("string").alias("key"), "label", "text").mapInArrow(
        measured, "key string, label int, x array<float>"
    )
    seen = seen.orderBy("key").toArrow()
    y = np.asarray(seen["label"], dtype=float)
    if not len(y) or y.min() == y.max():
        return QualityModel(vectors, None)
    x = np.asarray(seen["x"].combine_chunks().flatten()).reshape(len(y), FEATURES)
    share = {c: sizes.get(c, 1) / max(1, (y == c).sum()) for c in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    unseen = np.array([zlib.crc32(b"unseen" + k.encode()) % 5 == 0 for k in seen["key"].to_pylist()])
    return QualityModel(vectors, fit_network(x, y, weight, unseen))


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", name: str = "quality_score") -> DataFrame:
    """``docs`` with the column ``name``: the probability, from 0 to 1, that the whole text is good.

    A null text is an empty one.  A column of that name is replaced.
    """
    docs = docs.drop(name)
    known, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)
    names = [*docs.columns, name]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE):
                scores = known.value.score(*slot_encoder()(part.column(at)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names)
            give_back()

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
