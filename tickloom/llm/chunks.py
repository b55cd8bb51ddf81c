"""Whole texts to integer ids by way of their distinct words.

A text is cut before every white-space character that follows a word, each
distinct piece of a batch is encoded once, and the ids of the texts are gathered
from the pieces with numpy.  Invented or natural, a corpus repeats its words, so
this is several times faster than encoding text after text.

The cut is exact for encoders that never look across the border between a word
and the white space after it, which holds for the pre-tokenizers of byte-level
BPE, for word BPE and for word hashing.  Texts in which that can't be told by a
pattern (runs of white space, control characters, Unicode spaces, the opening of
a special token) are encoded whole, so results never differ.
"""

from __future__ import annotations

import ctypes
import json
import re
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; the arrays made for them are some ten times as large.
SLICE_BYTES = 2 << 20

#: Pieces and words remembered by a worker process, each in two generations of this many; an entry takes some 200 bytes.
#: Where plain words are taken apart by Arrow, they make up most of what is remembered.
REMEMBERED, WORDS_REMEMBERED, PLAIN_REMEMBERED = 300_000, 100_000, 200_000

_WHOLE = (
    r"[ \n][ \n]|<\||[\x{0}-\x{9}\x{b}-\x{1f}\x{7f}-\x{a0}]"
    r"|[\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}]"
)

#: Encodes many pieces in one call: the ids of each, as bytes of the encoder's type.
Encode = Callable[[list[str]], list[bytes]]


class Recent:
    """What was encoded lately.

    A piece is kept when it comes for the third time, by a small table of counters; so the many pieces that are met
    only once or twice take no memory and push nothing out.  Kept pieces stand in two generations, of which the older
    one goes when the newer is full.
    """

    def __init__(self, encode: Encode, most: int = REMEMBERED):
        self.encode, self.most = encode, most
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.met = bytearray(1 << 22)

    def __call__(self, pieces: list[str]) -> list[bytes]:
        if len(self.kept) >= self.most:
            self.kept, self.old, self.met = {}, self.kept, bytearray(len(self.met))
        kept, old, met, mask = self.kept, self.old, self.met, len(self.met) - 1
        out = list(map(kept.get, pieces))
        missing = [i for i, known in enumerate(out) if known is None]
        if old:
            for i in missing:
                if pieces[i] in old:
                    out[i] = kept[pieces[i]] = old[pieces[i]]
            missing = [i for i in missing if out[i] is None]
        if missing:
            for i, ids in zip(missing, self.encode([pieces[i] for i in missing]), strict=True):
                out[i] = ids
                p = pieces[i]
                at = hash(p) & mask
                if met[at] < 2:
                    met[at] += 1
                else:
                    kept[p] = ids
        return out


class ChunkEncoder:
    """``encode`` turns pieces into ids; ``whole`` takes one text that can't be cut.

    A piece starts with the space or line feed before its word, but for a text's first one.
    """

    def __init__(
        self, encode: Encode, whole: Callable[[str], Sequence[int]], dtype=np.uint32, plain: PlainPieces | None = None
    ):
        self.dtype, self.whole, self.plain = np.dtype(dtype), whole, plain
        # Keys have lost the space they were cut at; a line feed stays, and a first piece is marked by a carriage return.
        self.recent = Recent(
            lambda keys: encode([k[1:] if k[:1] == "\r" else k if k[:1] == "\n" else " " + k for k in keys]),
            WORDS_REMEMBERED if plain else REMEMBERED,
        )

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids per text, and all ids, one text after the other.  A null text has none."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not len(texts):
            return np.zeros(0, np.int64), np.zeros(0, self.dtype)
        odd = np.asarray(pc.match_substring_regex(texts, _WHOLE))
        cut = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        lists = pc.split_pattern(pc.replace_substring(cut, "\n", " \n"), " ")
        pieces, bounds = lists.flatten(), np.concatenate(([0], np.cumsum(pc.list_value_length(lists)))).astype(np.int64)
        coded = pieces.dictionary_encode()
        first = pieces.take(pa.array(bounds[:-1])).dictionary_encode()
        order = np.array(coded.indices, dtype=np.int64)
        order[bounds[:-1]] = len(coded.dictionary) + np.asarray(first.indices, dtype=np.int64)
        sizes, known = self._encoded(coded.dictionary, ["\r" + k for k in first.dictionary.to_pylist()])
        starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        ids = gather(known, starts, sizes)
        ends = np.concatenate(([0], np.cumsum(sizes)))[bounds]
        lengths = np.diff(ends)
        if odd.any():
            lengths, ids = self._with_whole(texts, np.flatnonzero(odd), lengths, ids, ends)
        return lengths, ids

    def _encoded(self, pieces: pa.Array, opening: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each of the pieces and then of those that open a text, and all these ids in that order."""
        taken = self.plain.found(pieces) if self.plain else np.zeros(len(pieces), bool)
        rest = pieces.filter(pa.array(~taken)) if taken.any() else pieces
        encoded = self.recent(rest.to_numpy(zero_copy_only=False).tolist() + opening)
        sizes = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded)) // self.dtype.itemsize
        ids = np.frombuffer(b"".join(encoded), dtype=self.dtype)
        if not taken.any():
            return sizes, ids
        plain_sizes, plain_ids = self.plain(pieces.filter(pa.array(taken)))
        # Both kinds in the order of the pieces.
        of_plain = np.concatenate((taken, np.zeros(len(opening), bool)))
        starts, both = np.empty(len(of_plain), np.int64), np.empty(len(of_plain), np.int64)
        both[of_plain], both[~of_plain] = plain_sizes, sizes
        starts[of_plain] = np.cumsum(plain_sizes) - plain_sizes
        starts[~of_plain] = len(plain_ids) + np.cumsum(sizes) - sizes
        return both, gather(np.concatenate((plain_ids, ids)), starts, both)

    def _with_whole(self, texts, odd, lengths, ids, ends):
        parts, last, lengths = [], 0, lengths.copy()
        for i in odd:
            own = np.asarray(self.whole(texts[int(i)].as_py()), dtype=self.dtype)
            parts += [ids[last : ends[i]], own]
            last, lengths[i] = ends[i], len(own)
        return lengths, np.concatenate([*parts, ids[last:]])


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[starts[i] : starts[i] + sizes[i]]`` of all i, one after the other."""
    total = int(sizes.sum())
    if not total:
        return flat[:0]
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    at += np.arange(total)
    return flat[at]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of ``column``, each of whole rows."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    if not len(sizes):
        return
    part = np.cumsum(sizes) // most
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    for a, b in zip(starts, [*starts[1:], len(sizes)]):
        yield batch.slice(a, b - a)
    # What the slices needed goes back to the system, not to Arrow's reserve.
    pa.default_memory_pool().release_unused()


class PlainWords:
    """What a pre-tokenizer makes of a space, letters and at most one mark after them, without calling it.

    It is asked once for each letter and each mark.  Letters that it keeps together between two others stay together in
    any word, as pre-tokenizers go by classes of characters; all else is left to it.
    """

    SHAPE = re.compile(r" ([^\W\d_]+)([,.;:!?]?)").fullmatch

    def __init__(self, split):
        def tokens(text: str) -> list[str]:
            return [t for t, _ in split.pre_tokenize_str(text)]

        start, self.marks = tokens(" ab"), {}
        self.usable = len(start) == 1 and start[0].endswith("ab")
        if not self.usable:
            return
        self.before = start[0][:-2]
        for mark in ",.;:!?":
            found = tokens(f" ab{mark}")
            if len(found) == 2 and found[0] == start[0]:
                self.marks[mark] = found[1]
        before = self.before

        class Letters(dict):
            """A letter as it stands in tokens, or a NUL where it doesn't stand in a word."""

            def __missing__(self, code: int) -> str:
                found = tokens(f" a{chr(code)}a")
                whole = len(found) == 1 and found[0].startswith(f"{before}a") and found[0].endswith("a")
                self[code] = out = found[0][len(before) + 1 : -1] if whole else "\0"
                return out

        self.letters = Letters()

    def __call__(self, piece: str) -> tuple[str, ...] | None:
        """The one or two tokens of a piece, None where the pre-tokenizer has to see it."""
        shape = self.SHAPE(piece) if self.usable else None
        if shape is None:
            return None
        letters, mark = shape.groups()
        letters = letters.translate(self.letters)
        if "\0" in letters:
            return None
        word = self.before + letters
        if not mark:
            return (word,)
        return (word, self.marks[mark]) if mark in self.marks else None


class PlainPieces:
    """Pieces of Latin letters with at most one mark after them, found and taken apart by Arrow; each word of a call goes
    through the model once, however it is written and marked.

    A letter takes part if the normalizer makes one letter of it, as Arrow does, that ``PlainWords`` knows.
    """

    MARKS = ",.;:!?"

    def __init__(self, normalize: Callable[[str], str], split: PlainWords, modelled: Encode):
        self.lower = normalize(" aA") == " aa"
        letters = [c for c in map(chr, range(0x41, 0x250)) if c.isalpha()] if split.usable else []
        lowered = pc.utf8_lower(pa.array(letters, pa.string())).to_pylist() if self.lower else letters
        fits = [
            c for c, low in zip(letters, lowered) if normalize(f" a{c}a") == f" a{low}a" and split.letters[ord(low)] != "\0"
        ]
        marks = [m for m in self.MARKS if m in split.marks and normalize(f" ab{m}") == f" ab{m}"] if fits else []
        feed = "\n?" if normalize("\nab") == " ab" else ""
        self.shape = f"^{feed}[{''.join(fits)}]+{f'[{"".join(marks)}]?' if marks else ''}$" if fits else None
        self.strips = "\n" + "".join(marks)
        self.mark_ids = modelled([split.marks[m] for m in marks])
        self.words = Recent(
            lambda words: modelled([split.before + (w if w.isascii() else w.translate(split.letters)) for w in words]),
            PLAIN_REMEMBERED,
        )
        # By its last byte, the number of a piece's mark; 0 for none.
        self.mark_of = np.zeros(256, np.int64)
        self.mark_of[[ord(m) for m in marks]] = np.arange(len(marks)) + 1

    def found(self, pieces: pa.Array) -> np.ndarray:
        """Which of the pieces, without the space they begin with, have this form."""
        if self.shape is None:
            return np.zeros(len(pieces), bool)
        return np.asarray(pc.match_substring_regex(pieces, self.shape))

    def __call__(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each of such pieces, and all ids."""
        marks = self.mark_of[np.frombuffer(pc.binary_slice(pieces.cast(pa.binary()), -1).buffers()[2], np.uint8, len(pieces))]
        words = pc.utf8_trim(pieces, self.strips)
        coded = (pc.utf8_lower(words) if self.lower else words).dictionary_encode()
        known = [b"", *self.mark_ids, *self.words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        # A piece is its word and then its mark.
        parts = np.stack((1 + len(self.mark_ids) + np.asarray(coded.indices, np.int64), marks), axis=1)
        ids = gather(np.frombuffer(b"".join(known), np.uint32), starts[parts].ravel(), sizes[parts].ravel())
        return sizes[parts].sum(axis=1), ids


def ascii_normalizer(normalizer: dict | None) -> Callable[[str], str] | None:
    """What a normalizer makes of an ASCII piece whose only white space is its first character, without calling it.

    ``normalizer`` is its description in the tokenizer's file.  None where it holds a step not known here.
    """
    if normalizer is None:
        return str
    steps = normalizer.get("normalizers", [normalizer])
    lower = space = False
    for step in steps:
        if step["type"] == "Lowercase":
            lower = True
        elif step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " ":
            space = True
        elif step["type"] not in ("NFC", "NFD", "NFKC", "NFKD"):  # these leave ASCII alone
            return None

    def normalized(piece: str) -> str:
        piece = " " + piece[1:] if space else piece
        return piece.lower() if lower else piece

    return normalized


_held: dict[object, ChunkEncoder] = {}


def worker_encoder(name: object, make: Callable[[], ChunkEncoder]) -> ChunkEncoder:
    """The encoder ``make`` gives, kept by the worker process until another one is asked for.

    The stages of a pipeline run in the same processes; what the encoders of all of them remember would add up.
    """
    if name not in _held:
        forget_encoders()
        _held[name] = make()
    return _held[name]


def forget_encoders() -> None:
    """Gives back the memory of this worker's encoders, for tasks that need none."""
    _held.clear()
    give_back()


#: Linux's C library keeps what is freed between pieces in use until it is told to give it back; others have no such call.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Memory that this worker no longer uses goes back to the system, for the executor's other processes."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def token_encoder(path: str, plain: bool = False) -> ChunkEncoder:
    """Ids of the tokenizer in the file ``path`` without special tokens, as ``encode(text).ids`` has them.

    Pieces go through the library's own normalizer, pre-tokenizer and model, many
    in a call; what ``encode`` adds to that is offsets.

    With ``plain`` the name of a special token in a text is text like any other and never gives that token's id.
    """
    return worker_encoder((path, plain), lambda: _token_encoder(path, plain))


def _token_encoder(path: str, plain: bool) -> ChunkEncoder:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    normal, split, model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model

    def modelled(new: list[str]) -> list[bytes]:
        if normal is None:
            return [array("I", [t.id for t in model.tokenize(w)]).tobytes() for w in new]
        # A normalizer makes one word of several pieces; each goes through the model once.
        found = {w: array("I", [t.id for t in model.tokenize(w)]).tobytes() for w in dict.fromkeys(new)}
        return [found[w] for w in new]

    words = Recent(modelled, WORDS_REMEMBERED)

    by_ascii = ascii_normalizer(json.loads(tokenizer.to_str())["normalizer"]) if normal else None

    def normalized(pieces: list[str]) -> list[str]:
        if normal is None:
            return pieces
        if by_ascii is None:
            return by_library(pieces)
        rest = iter(by_library([p for p in pieces if not p.isascii()]))
        return [by_ascii(p) if p.isascii() else next(rest) for p in pieces]

    def by_library(pieces: list[str]) -> list[str]:
        joined = normal.normalize_str("".join(pieces))
        parts = [" " + p for p in joined.split(" ")[1:]]
        return parts if len(parts) == len(pieces) else [normal.normalize_str(p) for p in pieces]

    plain_words = PlainWords(split)

    def encode(pieces: list[str]) -> list[bytes]:
        inner = [len(p) > 1 and p[0] in " \n" for p in pieces]
        if not all(inner):
            # What opens or ends a text (no white space before it, or nothing after) can't stand among others.
            rest = iter(encode([p for p, i in zip(pieces, inner) if i]))
            return [next(rest) if i else alone(p) for p, i in zip(pieces, inner)]
        if not pieces:
            return []
        pieces = normalized(pieces)
        parted = [plain_words(p) for p in pieces]
        rest = iter(pre_tokenized([p for p, w in zip(pieces, parted) if w is None]))
        known = words([w for parts in parted if parts for w in parts])
        at, out = 0, []
        for parts in parted:
            if parts is None:
                out.append(next(rest))
            elif len(parts) == 1:
                out.append(known[at])
                at += 1
            else:
                out.append(known[at] + known[at + 1])
                at += 2
        return out

    def pre_tokenized(pieces: list[str]) -> list[bytes]:
        if not pieces:
            return []
        found = split.pre_tokenize_str("".join(pieces))
        different = {w: i for i, w in enumerate(dict.fromkeys([w for w, _ in found]))}
        encoded = words(list(different))
        known = [encoded[different[w]] for w, _ in found]
        # Words of each piece: those that start before its end.
        ends = np.searchsorted([span[0] for _, span in found], np.cumsum(list(map(len, pieces)))).tolist()
        return [known[a] if b - a == 1 else b"".join(known[a:b]) for a, b in zip([0, *ends], ends)]

    def alone(piece: str) -> bytes:
        text = normal.normalize_str(piece) if normal else piece
        return b"".join(words([w for w, _ in split.pre_tokenize_str(text)]))

    def whole(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    pieces = PlainPieces(normal.normalize_str, plain_words, modelled) if normal else None
    return ChunkEncoder(encode, whole, plain=pieces)
