"""License scan: ordered signature rules over the words of whole texts.

A text is lower-cased (A-Z) and becomes its words, one space between them.  One
pass of an Aho-Corasick automaton finds the plain texts that gate the rules; the
regular expressions of a rule run only around the places where a gate of theirs
stands, as far as a match can reach, which gives the matches of a run over the
whole text.  What the rules find are intervals of words.  An interval inside
another one of the same or a stronger priority is suppressed, so ``general public
license`` inside a notice of the lesser one says nothing.

Phrases (``BASE``) are searched beside the rules, and nothing suppresses them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.chunks import slices
from tickloom.llm.license_rules import REACH, RULES, Rule

# The phrases that are always labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
BASE_CONFIDENCE = 0.95

_WORD = np.zeros(256, np.uint8)
_WORD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_WORD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_WORD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_WORD[128:] = np.arange(128, 256)
_WORD[_WORD == 0] = ord(" ")
_TABLE = _WORD.tobytes()


class Detection(NamedTuple):
    """Words ``first`` to ``first + words - 1``, by rule number ``rule``."""

    first: int
    words: int
    rule: int


def word_line(text: str) -> tuple[str, int]:
    """The words of a text with one space before, between and after them, and their number.

    Nothing is made for each word, so a very long text takes a few times its size.
    """
    raw = text.encode().translate(_TABLE)
    if b"  " in raw:
        line = np.frombuffer(raw, np.uint8)
        space = line == 32
        raw = line[np.concatenate(([True], ~(space[1:] & space[:-1])))].tobytes()
    raw = raw.strip(b" ")
    return (f" {raw.decode()} ", raw.count(b" ") + 1) if raw else (" ", 0)


class _Scanner:
    """Rules with the automaton of their gates."""

    def __init__(self, rules: list[Rule], base: dict[str, str]):
        import ahocorasick

        self.rules, self.base = rules, base
        self.phrases = [f" {phrase} " for phrase in base]
        texts = sorted({t for rule in rules for t in (*rule.gates, *rule.needs)} | set(self.phrases))
        number = {t: i for i, t in enumerate(texts)}
        self.gates = [[number[t] for t in rule.gates] for rule in rules]
        self.needs = [[number[t] for t in rule.needs] for rule in rules]
        self.gated = defaultdict(list)
        for r, gates in enumerate(self.gates):
            for g in gates:
                self.gated[g].append(r)
        self.phrase_numbers = [number[p] for p in self.phrases]
        self.automaton = ahocorasick.Automaton()
        for text, i in number.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()

    def places(self, line: str) -> dict[int, list[int]]:
        """Last characters of every gate, need and phrase in the line."""
        found = defaultdict(list)
        for end, i in self.automaton.iter(line):
            found[i].append(end)
        return found

    def matches(self, line: str, places: dict[int, list[int]]) -> list[tuple[int, int, int]]:
        """(start, end, rule) in characters of all rules."""
        out = []
        for r in sorted({r for i in places for r in self.gated.get(i, ())}):
            marks = [p for g in self.gates[r] for p in places.get(g, ())]
            if self.needs[r]:
                # Every match holds one of each; the rarer ones say where to look.
                marks = min(marks, [p for n in self.needs[r] for p in places.get(n, ())], key=len)
            for a, b in _windows(sorted(marks), line):
                out += [(m.start(), m.end(), r) for m in self.rules[r].pattern.finditer(line, a, b)]
        return out


def _windows(marks: list[int], line: str) -> Iterator[tuple[int, int]]:
    """Parts of the line, from a space to behind one, that hold all a match around a mark can hold."""
    first = last = None
    for mark in marks:
        if last is not None and mark - REACH <= last:
            last = mark + REACH
            continue
        if last is not None:
            yield _whole(first, last, line)
        first, last = mark - REACH, mark + REACH
    if last is not None:
        yield _whole(first, last, line)


def _whole(a: int, b: int, line: str) -> tuple[int, int]:
    a = line.rfind(" ", 0, a + 1) if a > 0 else 0
    b = line.find(" ", b) + 1 if b < len(line) else len(line)
    return max(a, 0), b or len(line)


def _word_numbers(line: str, starts: Iterable[int]) -> list[int]:
    """Numbers of the words that begin at the given ascending characters."""
    out, at, number = [], 0, -1
    for start in starts:
        number += line.count(" ", at, start)
        at = start
        out.append(number)
    return out


def unsuppressed(found: list[tuple[int, int, int]], rules: list[Rule]) -> list[tuple[int, int, int]]:
    """Intervals (start, end, rule) that lie in no other one of the same or a stronger priority.

    Of equal intervals of one priority the first rule's stays.
    """
    ends: dict[int, int] = {}
    kept = []
    for start, end, r in sorted(set(found), key=lambda f: (f[0], -f[1], rules[f[2]].priority, f[2])):
        mine = rules[r].priority
        if all(end > reached for priority, reached in ends.items() if priority <= mine):
            kept.append((start, end, r))
        ends[mine] = max(end, ends.get(mine, -1))
    return kept


@cache
def _scanner() -> _Scanner:
    return _Scanner(RULES, BASE)


def scan_text(text: str) -> tuple[int, list[tuple[int, str]], list[Detection]]:
    """Number of words, (word, label) of every base phrase, and the detections that nothing suppresses."""
    scanner = _scanner()
    line, words = word_line(text)
    places = scanner.places(line)
    if not places:
        return words, [], []
    phrases = sorted(
        (end - len(phrase) + 2, label)
        for phrase, i, label in zip(scanner.phrases, scanner.phrase_numbers, scanner.base.values())
        for end in places.get(i, ())
    )
    base = list(zip(_word_numbers(line, [start for start, _ in phrases]), [label for _, label in phrases]))
    kept = unsuppressed(scanner.matches(line, places), scanner.rules)
    numbers = _word_numbers(line, [start for start, _, _ in kept])
    return words, base, [Detection(n, line.count(" ", a, b) + 1, r) for n, (a, b, r) in zip(numbers, kept)]


SCANNED = (
    "n_words long, base array<struct<first: long, label: string>>, "
    "detections array<struct<first: long, words: long, label: string, rule: string, confidence: double>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_type = pa.list_(pa.struct([("first", pa.int64()), ("label", pa.string())]))
    found_type = pa.list_(
        pa.struct([("first", pa.int64()), ("words", pa.int64()), ("label", pa.string()), ("rule", pa.string()), ("confidence", pa.float64())])
    )
    for batch in batches:
        for part in slices(batch, "text"):
            words, base, found = [], [], []
            for text in part.column("text"):
                n, phrases, detections = scan_text(text.as_py() or "")
                words.append(n)
                base.append([{"first": first, "label": label} for first, label in phrases])
                found.append(
                    [
                        {"first": d.first, "words": d.words, "label": RULES[d.rule].label, "rule": RULES[d.rule].name, "confidence": RULES[d.rule].confidence}
                        for d in detections
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(words, pa.int64()), pa.array(base, base_type), pa.array(found, found_type)],
                ["key", "n_words", "base", "detections"],
            )


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, base, detections`` of every row; other columns are left out.

    Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became lower case, counted from 0; a null text
    is empty.  ``base`` has the first word and label of every place where a phrase of ``BASE`` stands, ``detections``
    first word, number of words, label, rule and confidence of what the rules found, suppressed ones left out.  Rows are
    scanned where they are, each on its own, so null and repeated keys are rows like any other.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_scan, f"key {kind}, {SCANNED}").withColumnRenamed("key", key)


def license_labels(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Labels and score of scanned rows.

    ``n_base``, ``first_word`` and ``last_word`` count and bound the base places (null without one); ``base_labels`` and
    ``labels`` are distinct, sorted and joined by commas, and empty without any.  ``score`` is 0 without labels, else one
    less the product, over the labels, of one less the label's best confidence.
    """
    places = F.transform("base", lambda b: b["first"])
    base = F.transform("base", lambda b: b["label"])
    sure = F.concat(
        F.transform("base", lambda b: F.struct(b["label"].alias("label"), F.lit(BASE_CONFIDENCE).alias("confidence"))),
        F.transform("detections", lambda d: F.struct(d["label"].alias("label"), d["confidence"].alias("confidence"))),
    )
    labels = F.array_distinct(F.transform("sure", lambda s: s["label"]))
    doubt = F.aggregate(
        F.col("names"),
        F.lit(1.0),
        lambda left, name: left
        * (1.0 - F.array_max(F.transform(F.filter("sure", lambda s: s["label"] == name), lambda s: s["confidence"]))),
    )
    return (
        scanned.withColumn("sure", F.array_distinct(sure))
        .withColumn("names", F.array_sort(labels))
        .select(
            key,
            "n_words",
            F.size("base").cast("long").alias("n_base"),
            F.array_min(places).alias("first_word"),
            F.array_max(places).alias("last_word"),
            F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
            F.array_join("names", ",").alias("labels"),
            (1.0 - doubt).alias("score"),
        )
    )
