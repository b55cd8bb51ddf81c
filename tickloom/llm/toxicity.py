"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, marks removed, letters of other scripts that
look Latin and digits or signs that stand for letters replaced, everything else
a space.  An entry of the lexicon is a word or the beginning of words, with a
weight; phrases that contain an entry but are no offence are exceptions and take
its match away.  The weights found in a text, with and without regard to its
length, give the score.

The lexicon, its weights and the exceptions are learned from a bounded sample of
labelled texts (``SAMPLE`` of each class): an entry is kept if it is far more
frequent among the toxic ones and stands there between different words, so that
the rare words of a toxic text that was copied many times don't count.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.chunks import forget_encoders, slices
from tickloom.llm.samples import labelled_sample

#: Labelled rows of each class that a lexicon is learned from, at most.
SAMPLE = 5000
#: Toxic texts an entry must be found in, and how much likelier it must be there (natural log).
SUPPORT, LEAST_WEIGHT, MOST_WEIGHT = 3, 1.5, 6.0
#: Candidates looked at, the most frequent ones, and lengths of beginnings.
CANDIDATES = 50_000
SHORTEST, LONGEST = 4, 10
#: Clean texts that make a phrase an exception.
EXCEPTION_TEXTS = 3

# What is written in place of Latin letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "и": "u", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ӏ": "l", "ԛ": "q", "ԝ": "w", "ь": "b",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "σ": "o",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ɑ": "a", "ɡ": "g",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}

#: Signs in place of letters: before a letter, or between two where they also end sentences and cells.
_SIGN = re.compile(r"[@$](?=\w)|(?<=\w)[!|](?=\w)")


def _folded_char(c: str) -> str:
    """A letter a-z, other letters without marks, or a space."""
    low = c.lower()
    plain = "".join(x for x in unicodedata.normalize("NFKD", low) if not unicodedata.combining(x))
    out = "".join(LOOKALIKES.get(x, x) for x in plain)
    return out if out.isalpha() else " "


class _Folding(dict):
    """Filled as characters are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        hidden = unicodedata.combining(c) or unicodedata.category(c) == "Cf"
        self[code] = out = DIGITS.get(c) or ("" if hidden else _folded_char(c))
        return out


_folding = _Folding()


def folded_words(text: str) -> list[str]:
    """Words of a-z and letters that have no Latin likeness; marks and invisible characters go without a trace."""
    if "@" in text or "$" in text or "!" in text or "|" in text:
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return text.translate(_folding).split()


@dataclass
class Lexicon:
    """Entries end in a space if they are whole words.  ``curve``: offset, slopes of weight and of weight by length."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (-3.0, 1.0, 1.0)

    def __post_init__(self):
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            # Entries that differ in i and l alone are one, of the greater weight.
            for entry, weight in sorted(self.weights.items(), key=lambda e: e[1]):
                self._automaton.add_word(_one_stroke(" " + entry), (False, len(entry) + 1, weight))
            for phrase in self.exceptions:
                self._automaton.add_word(_one_stroke(f" {phrase} "), (True, len(phrase) + 2, 0.0))
            self._automaton.make_automaton()
        return self._automaton

    def matches(self, words: list[str]) -> list[tuple[int, float]]:
        """Place and weight of every entry found, but for those inside an exception."""
        if not words or not (self.weights or self.exceptions):
            return []
        found, free = [], []
        for end, (exception, length, weight) in self.automaton().iter(_one_stroke(f" {' '.join(words)} ")):
            if exception:
                free.append((end - length + 1, end))
            else:
                found.append((end - length + 1, end, weight))
        if not free:
            return [(a, w) for a, _, w in found]
        free.sort()
        starts, reach = [x for x, _ in free], list(accumulate((y for _, y in free), max))
        inside = ((a, b, bisect_right(starts, a)) for a, b, _ in found)
        return [(f[0], f[2]) for f, (_, b, i) in zip(found, inside) if not (i and b <= reach[i - 1])]

    def features(self, words: list[str]) -> tuple[float, float]:
        weight = sum(w for _, w in self.matches(words))
        return math.log1p(weight), math.log1p(100 * weight / (len(words) + 20))

    def score(self, words: list[str]) -> float:
        offset, slope, by_length = self.curve
        total, dense = self.features(words)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, offset + slope * total + by_length * dense))))


def _one_stroke(line: str) -> str:
    """l and i are one letter to the automaton: 1, ! and | stand for either."""
    return line.replace("l", "i")


def _parts(word: str) -> list[str]:
    """Beginnings of the word, and the word itself."""
    return [*(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)), word + " "] if len(word) >= 3 else []


def _neighbourhoods(words: list[str]) -> Iterator[tuple[str, str, str]]:
    return zip(["", *words], words, [*words[1:], ""])


def _rough_counts(rows: DataFrame) -> DataFrame:
    """``part, toxic, clean``: neighbourhoods of each part, those of one text counted once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            counts = ({}, {})
            for label in (0, 1):
                seen, parts = Counter(), counts[label]
                for text, own in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                    if own == label:
                        seen.update(w for _, w, _ in set(_neighbourhoods(folded_words(text))))
                for word, n in seen.items():
                    for p in _parts(word):
                        parts[p] = parts.get(p, 0) + n
            clean, toxic = counts
            found = [*toxic, *(p for p in clean if p not in toxic)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found, pa.string()),
                    *(pa.array([c.get(p, 0) for p in found], pa.int64()) for c in (toxic, clean)),
                ],
                ["part", "toxic", "clean"],
            )

    counted = rows.select("text", "label").mapInArrow(count, "part string, toxic long, clean long")
    return counted.groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _exact_counts(rows: DataFrame, among: set[str]) -> DataFrame:
    """``part, toxic, clean, texts``: different neighbourhoods of these parts, and toxic texts that hold them."""
    wanted = rows.sparkSession.sparkContext.broadcast(among)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            found = set()
            for i, text in enumerate(batch.column("text").to_pylist()):
                label, name = batch.column("label")[i].as_py(), batch.column("name")[i].as_py()
                for before, word, after in _neighbourhoods(folded_words(text)):
                    for p in _parts(word):
                        if p in wanted.value:
                            found.add((p, label, zlib.crc32(f"{before} {word} {after}".encode()), name))
            columns = list(zip(*found)) or [[], [], [], []]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "label", "place", "name"]
            )

    found = rows.select("text", "label", F.xxhash64("text").alias("name")).mapInArrow(
        find, "part string, label int, place long, name long"
    )

    def different(column: str, label: int) -> Column:
        return F.count_distinct(F.when(F.col("label") == label, F.col(column)))

    return found.groupBy("part").agg(
        different("place", 1).alias("toxic"), different("place", 0).alias("clean"), different("name", 1).alias("texts")
    )


def _chosen(counts: list[tuple[str, int, int, int]], n_toxic: int, n_clean: int, candidates: int) -> dict[str, float]:
    """Entries and weights from ``part, toxic, clean, texts``; the sums are of words in toxic and in clean texts.

    The log likelihood ratio says how far a part's share of the toxic words is from chance; it must be below one in ten
    for all candidates together.  The surest part comes first, and parts that begin with it or that it begins with go.
    """
    share = n_toxic / (n_toxic + n_clean)
    sure = []
    for part, a, b, texts in counts:
        weight = math.log((a + 0.5) / n_toxic) - math.log((b + 0.5) / n_clean)
        ratio = a * math.log(a / (share * (a + b))) if a else 0.0
        ratio += b * math.log(b / ((1 - share) * (a + b))) if b else 0.0
        if texts >= SUPPORT and weight >= LEAST_WEIGHT and ratio >= math.log(10 * candidates):
            sure.append((-ratio, -len(part), part, min(weight, MOST_WEIGHT)))
    out: dict[str, float] = {}
    beginnings: set[str] = set()
    for _, _, part, weight in sorted(sure):
        if part not in beginnings and not any(part[:n] in out for n in range(SHORTEST, len(part))):
            out[part] = weight
            beginnings.update(part[:n] for n in range(SHORTEST, len(part) + 1))
    return out


def _exceptions(sample: DataFrame, lexicon: Lexicon) -> list[str]:
    """Phrases of two words around a match that only clean texts have."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            found: Counter = Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words = folded_words(text)
                starts, at = {}, 0
                for i, w in enumerate(words):
                    starts[at], at = i, at + len(w) + 1
                own = set()
                for place, _ in lexicon.matches(words):
                    i = starts[place]
                    own.update(" ".join(words[a : a + 2]) for a in (i - 1, i) if a >= 0 and a + 2 <= len(words))
                found.update((p, label) for p in own)
            yield pa.RecordBatch.from_pydict(
                {"phrase": pa.array([k[0] for k in found], pa.string()), "label": pa.array([k[1] for k in found], pa.int32()),
                 "n": pa.array(list(found.values()), pa.int64())}
            )

    counted = sample.select("text", "label").mapInArrow(phrases, "phrase string, label int, n long")
    clean = F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0))
    toxic = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0))
    kept = counted.groupBy("phrase").agg(clean.alias("clean"), toxic.alias("toxic"))
    rows = kept.where((F.col("clean") >= EXCEPTION_TEXTS) & (F.col("toxic") == 0)).orderBy(F.desc("clean"), "phrase")
    return [r[0] for r in rows.limit(CANDIDATES).collect()]


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, with a small penalty so that classes that part cleanly stay finite."""
    a = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(a.shape[1]), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (weight * (p - y)) + penalty @ beta
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + penalty, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def fit_lexicon(
    docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", sample: int = SAMPLE, key: str = "doc_id",
    text: str = "text",
) -> Lexicon:
    """Learns a lexicon from at most ``sample`` labelled rows of each class that are not ``held_out``.

    Without labelled rows of both classes, or without a word that tells them apart, the lexicon is empty and every score
    is low.
    """
    rows, sizes = labelled_sample(docs, labels, label, held_out, sample, key, text)
    words = F.size(F.split("text", r"\s+"))
    totals = {r[0]: (r[1], r[2]) for r in rows.groupBy("label").agg(F.count("*"), F.sum(words)).collect()}
    if len(totals) < 2:
        return Lexicon({})
    (n_clean, clean_words), (n_toxic, toxic_words) = totals[0], totals[1]
    likelier = (F.col("toxic") + 0.5) / toxic_words >= math.exp(LEAST_WEIGHT) * (F.col("clean") + 0.5) / clean_words
    rough = _rough_counts(rows).where((F.col("toxic") >= SUPPORT) & likelier).orderBy(F.desc("toxic"), "part")
    candidates = {r[0] for r in rough.select("part").limit(CANDIDATES).collect()}
    counts = [tuple(r) for r in _exact_counts(rows, candidates).collect()] if candidates else []
    lexicon = Lexicon(_chosen(counts, toxic_words, clean_words, max(1, len(candidates))))
    if not lexicon.weights:
        return lexicon
    lexicon.exceptions = _exceptions(rows, lexicon)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            found = [lexicon.features(folded_words(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"label": batch.column("label"), "a": pa.array([f[0] for f in found], pa.float64()),
                 "b": pa.array([f[1] for f in found], pa.float64())}
            )

    seen = rows.select("label", "text").mapInArrow(measured, "label int, a double, b double").toArrow()
    y = np.asarray(seen["label"], dtype=float)
    x = np.column_stack([np.asarray(seen["a"]), np.asarray(seen["b"])])
    weight = np.where(y == 1, sizes.get(1, 1) / n_toxic, sizes.get(0, 1) / n_clean)
    lexicon.curve = _fit_curve(x, y, weight * len(y) / weight.sum())
    return lexicon


def score_texts(docs: DataFrame, lexicon: Lexicon, text: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with the column ``name``, from 0 to 1, from the whole text; a null text is an empty one.

    A column of that name is replaced.
    """
    docs = docs.drop(name)
    known, at = docs.sparkSession.sparkContext.broadcast(lexicon), docs.columns.index(text)
    names = [*docs.columns, name]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            for part in slices(batch, text):
                texts = pc.fill_null(part.column(at), "").to_pylist()
                scores = [known.value.score(folded_words(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names)

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
