"""Token ids of whole texts by the tokenizers library, each distinct stretch of a text encoded once.

Both vocabularies part a text at white space before any merge: no token goes on
from another character into white space. So a text is a sequence of stretches (a
word, for the byte vocabulary with the white space before it), and a stretch has
the same ids wherever it stands. A worker keeps the ids of the stretches it has seen
in arrays sorted by code, with the bytes, which are compared at every hit; they are
dropped at a bound, which changes no result. A row
with rarer kinds of white space, or with what may be a special token's string (which
the library takes as that token), is one stretch.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from .words import Words, _gaps, byte_codes, same_bytes

#: Distinct stretches, their bytes and their ids kept at most by a Python worker: some 70 MB.
KEPT, KEPT_BYTES, KEPT_IDS = 1_000_000, 12_000_000, 4_000_000
END_ID = 1
WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"
PLAIN_SPACE = _gaps((0x20, 0x0A, 0x0D, 0x09))
# First bytes of white space outside PLAIN_SPACE, and what may follow them.
_RARE = _gaps((0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3))
# White space, Latin letters, closing marks: the library's own patterns cut such a stretch exactly there.
_SIMPLE = re.compile("([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _printable() -> dict[int, int]:
    """Byte to character of byte-level vocabularies: printable ones stand for themselves, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


_SHOWN = _printable()


def _special_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that hold ``<|``, with which every special token of the vocabularies begins."""
    at = np.flatnonzero(data[:-1] == 0x3C) if len(data) else np.zeros(0, np.int64)
    at = at[data[at + 1] == 0x7C]
    return np.unique(np.searchsorted(offsets, at, "right") - 1)


def _rare_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(_RARE[data])
    if not len(at):
        return at
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = padded[at], padded[at + 1], padded[at + 2]
    rare = (
        (a < 0x20)
        | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
        | ((a == 0xE1) & (b == 0x9A))
        | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
        | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
        | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    )
    return np.unique(np.searchsorted(offsets, at[rare], "right") - 1)


def _extended(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """The array with values from a place on, in a larger one where they do not fit."""
    if at + len(values) > len(array):
        array = np.concatenate([array, np.zeros(max(at + len(values) - len(array), len(array) // 2), array.dtype)])
    array[at : at + len(values)] = values
    return array


class Encoder:
    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(name))
        self.model = self.tokenizer.model
        self.words_only = name == WORD_VOCABULARY
        self.reset()

    def reset(self):
        self.marks: dict[str, list[int]] = {}
        self.codes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.bounds = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64)
        self.text, self.places = np.zeros(1 << 18, np.uint8), np.zeros(1 << 12, np.int64)
        self.known = 0

    # -- stretches -------------------------------------------------------
    def stretches(self, texts: pa.Array):
        """Bytes, starts, ends, codes of the stretches of a column, and their bounds by row."""
        words = Words(texts, gaps=PLAIN_SPACE, seed=3)
        start, end, code, offsets = words.start, words.end, words.code, words.offsets
        first = words.first
        rare = np.union1d(_rare_rows(words.data, offsets), _special_rows(words.data, offsets))
        if self.words_only and not len(rare):
            return words.data, start, end, code, first
        row = np.repeat(np.arange(len(offsets) - 1), words.counts)
        if not self.words_only:
            before = np.concatenate([[0], end[:-1]]) if len(end) else end
            start = np.maximum(before, offsets[:-1][row])
            last = np.maximum(offsets[:-1], np.where(words.counts > 0, end[np.maximum(first[1:], 1) - 1], 0)) if len(end) else offsets[:-1]
            tail = np.flatnonzero(last < offsets[1:])  # white space at the end of a row
            start, end = np.concatenate([start, last[tail]]), np.concatenate([end, offsets[1:][tail]])
            row = np.concatenate([row, tail])
        if len(rare):
            keep = ~np.isin(row, rare)
            start = np.concatenate([start[keep], offsets[:-1][rare]])
            end = np.concatenate([end[keep], offsets[1:][rare]])
            row = np.concatenate([row[keep], rare])
        order = np.lexsort((start, row))
        start, end, row = start[order], end[order], row[order]
        return words.data, start, end, byte_codes(words.data, start, end, 3), np.searchsorted(row, np.arange(len(offsets)))

    # -- ids -------------------------------------------------------------
    def _merged(self, part: str) -> list[int]:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(_SHOWN)
        return [t.id for t in self.model.tokenize(part)]

    def _simple(self, found) -> list[int]:
        """The ids of a simple stretch, by the library's merges over what its patterns cut it into."""
        space, letters, marks = found.groups()
        if self.words_only:
            ids = self._merged(letters.lower())
        elif space == " ":
            blank = chr(_SHOWN[32])
            shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(_SHOWN)
            ids = [t.id for t in self.model.tokenize(blank + shown)]
        else:
            ids = self._merged(letters)
            if space:
                ids = self._mark(chr(_SHOWN[10])) + ids
        return ids + self._mark(marks) if marks else ids

    def _mark(self, part: str) -> list[int]:
        if part not in self.marks:
            self.marks[part] = [t.id for t in self.model.tokenize(part)]
        return self.marks[part]

    def _learn(self, stretches: list[bytes]) -> None:
        """Ids of more stretches, numbered on from ``known``."""
        ids, other = [], []
        for number, stretch in enumerate(stretches):
            text = stretch.decode("utf-8", "replace")
            found = _SIMPLE.fullmatch(text)
            if found:
                ids.append(self._simple(found))
            else:
                ids.append(None)
                other.append((number, text))
        for (number, _), e in zip(other, self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False)):
            ids[number] = e.ids
        size, text = np.array([len(i) for i in ids], np.int64), np.frombuffer(b"".join(stretches), np.uint8)
        old, self.known = self.known, self.known + len(ids)
        self.bounds = _extended(self.bounds, old + 1, self.bounds[old] + np.cumsum(size))
        self.places = _extended(self.places, old + 1, self.places[old] + np.cumsum([len(x) for x in stretches]))
        self.flat = _extended(self.flat, int(self.bounds[old]), np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum())))
        self.text = _extended(self.text, int(self.places[old]), text)

    def numbers(self, data, start, end, code) -> np.ndarray:
        """The number under which each stretch's ids are kept until the next call."""
        if self.known > KEPT or self.bounds[self.known] > KEPT_IDS or self.places[self.known] > KEPT_BYTES:
            self.reset()
        if not len(start):
            return np.zeros(0, np.int64)
        raw = data.tobytes()
        _, one, which = np.unique(code, return_index=True, return_inverse=True)
        if not same_bytes(data, start, end, data, start[one[which]], end[one[which]]).all():  # equal codes of different stretches
            seen: dict[bytes, int] = {}
            which = np.array([seen.setdefault(raw[s:e], len(seen)) for s, e in zip(start.tolist(), end.tolist())])
            one = np.unique(which, return_index=True)[1]
        start, end, code = start[one], end[one], code[one]
        number, hit = np.full(len(one), -1), np.zeros(len(one), bool)
        if len(self.codes):
            place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[place] == code
            slot = self.slots[place[hit]]
            same = same_bytes(data, start[hit], end[hit], self.text[: self.places[self.known]], self.places[slot], self.places[slot + 1])
            number[np.flatnonzero(hit)[same]] = slot[same]
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self.known + np.arange(len(new))
            self._learn([raw[s:e] for s, e in zip(start[new].tolist(), end[new].tolist())])
            free = new[~hit[new]]  # a code that is taken stays with the stretch that has it
            codes, first = np.unique(code[free], return_index=True)
            place = np.searchsorted(self.codes, codes)
            self.codes = np.insert(self.codes, place, codes)
            self.slots = np.insert(self.slots, place, number[free[first]])
        return number[which]

    def documents(self, texts: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by the end id, and the bounds of the texts."""
        data, start, end, code, first = self.stretches(texts)
        numbers = self.numbers(data, start, end, code)
        size = self.bounds[numbers + 1] - self.bounds[numbers]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.bounds[numbers] - ends[:-1], size) + np.arange(ends[-1])]
        upto = ends[first]
        if end_id is None:
            return ids, upto
        out = np.full(len(ids) + len(texts), end_id, np.uint32)
        moved = upto + np.arange(len(upto))
        inside = np.ones(len(out), bool)
        inside[moved[1:] - 1] = False
        out[inside] = ids
        return out, moved


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """This worker's encoder of a vocabulary file."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]
