"""Token counts of documents under edits, re-encoding only what an edit touches.

A document's leaves are its stretches (white space and the word after it), whose token
counts add up to the document's, as no token goes on from a word into white space. Over
the leaves stands a segment tree of two sums, bytes and tokens. An edit (byte bounds in
the text as it then is, and what replaces them) is found by descending the byte sums; the
leaves it touches and one unharmed neighbour on either side are cut anew and encoded, put
back into the same leaves, and the sums above them updated. The neighbours are the
context: with them, the places where the region meets the rest are stretch bounds before
and after the edit.

Defined cases: a null or empty text has no tokens and no edits, though an insertion into an
empty text counts; rarer white space or what may begin a special token, in a text or a
replacement, makes the document one leaf, which stays exact; bounds beyond the text are cut to it; an edit that splits a
character is read with the replacement mark; rows that repeat are each counted; null
doc_ids are carried; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .encoding import BYTE_VOCABULARY, _rare_rows, encoder
from .shared import by_size, map_arrow, record, texts_of

Edit = tuple[int, int, bytes]

# An address is looked for around each "@", so that no run without one is tried from its every place.
_AT = re.compile(rb"@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._+-")
_URL = re.compile(rb"https?://[^\s<>]+")
# A run of number characters is taken whole, then cut to begin (but for a plus) and end with a digit.
_NUMBER = re.compile(rb"[0-9 ().+-]{8,}")
_STRETCH = re.compile(rb"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
_COUNTED = pa.schema(
    [("doc_id", pa.int64()), ("tokens_before", pa.int64()), ("tokens_after", pa.int64()), ("n_edits", pa.int64()), ("n_reencoded", pa.int64()), ("n_leaves", pa.int64())]
)


def _addresses(text: bytes) -> Iterator[tuple[int, int]]:
    """Mail addresses: what may stand before an "@" back to the last one's end, and the domain behind it."""
    done = 0
    for found in _AT.finditer(text):
        start = found.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            done = found.end()
            yield start, done


def _numbers(text: bytes) -> Iterator[tuple[int, int]]:
    """Runs of eight characters or more of digits and their marks, from a digit or the plus before it to a digit."""
    for run in _NUMBER.finditer(text):
        for part in re.finditer(rb"\+?[0-9][0-9 ().-]*", run[0]):
            length = len(part[0].rstrip(b" ().-"))
            if length - part[0].startswith(b"+") >= 8:
                yield run.start() + part.start(), run.start() + part.start() + length


#: Personal data and addresses, and what stands in for them, those named first before the others.
REDACTIONS = (
    (_addresses, b"<email>"),
    (lambda text: (m.span() for m in _URL.finditer(text)), b"<url>"),
    (_numbers, b"<number>"),
)


def redactions(text: bytes) -> list[Edit]:
    """All that is found and meets nothing found before it, last first, so that bounds stay true while edits are applied."""
    taken: list[Edit] = []
    for find, instead in REDACTIONS:
        starts, free = [s for s, _, _ in taken], []
        for start, end in find(text):
            at = bisect_left(starts, end)  # of those taken, which meet no other, the last that begins before the end
            if not at or taken[at - 1][1] <= start:
                free.append((start, end, instead))
        taken = sorted(taken + free)
    return taken[::-1]


class CountTree:
    """A document's stretches under a segment tree of bytes and tokens."""

    def __init__(self, stretches: list[bytes], tokens: list[int], tokenizer):
        self.tokenizer = tokenizer
        self.leaves = list(stretches) or [b""]
        self.width = 1 << max(0, (len(self.leaves) - 1).bit_length())
        self.bytes = self._tree([len(s) for s in self.leaves])
        self.tokens = self._tree(list(tokens) or [0])
        self.reencoded = 0

    def _tree(self, values: list[int]) -> list[int]:
        level = np.zeros(self.width, np.int64)
        level[: len(values)] = values
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
        return [0, *np.concatenate(levels[::-1]).tolist()]  # node 1 is the root, i has children 2i and 2i + 1

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> bytes:
        return b"".join(self.leaves)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the byte, and the bytes before that leaf."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if place - before >= self.bytes[node]:
                before += self.bytes[node]
                node += 1
        return node - self.width, before

    def _set(self, leaf: int, text: bytes, tokens: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.width
        more_bytes, more_tokens = len(text) - self.bytes[node], tokens - self.tokens[node]
        while node:
            self.bytes[node] += more_bytes
            self.tokens[node] += more_tokens
            node //= 2

    def _count(self, parts: list[bytes]) -> list[int]:
        self.reencoded += len(parts)
        texts = [p.decode("utf-8", "replace") for p in parts]
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def edit(self, start: int, end: int, replacement: bytes) -> None:
        size = self.bytes[1]
        start = min(max(start, 0), size)
        end = min(max(end, start), size)
        if not size:
            low, high, before = 0, 0, 0
        else:
            low, before = self._leaf_at(min(start, size - 1))
            if before:  # one unharmed leaf to the left; empty ones hold no byte
                low, before = self._leaf_at(before - 1)
            last, begin = self._leaf_at(min(max(end, start + 1) - 1, size - 1))
            after = begin + len(self.leaves[last])
            high = self._leaf_at(after)[0] if after < size else last
        region = b"".join(self.leaves[low : high + 1])
        region = region[: start - before] + replacement + region[end - before :]
        if _odd(replacement) or _odd(region):
            low, high = 0, len(self.leaves) - 1
            whole = self.text()
            region = whole[:start] + replacement + whole[end:]
            parts = [region]
        else:
            parts = _STRETCH.findall(region)
        counts = self._count(parts)
        room = high - low + 1
        if len(parts) > room:  # the last leaf takes the rest
            parts[room - 1 :] = [b"".join(parts[room - 1 :])]
            counts[room - 1 :] = [sum(counts[room - 1 :])]
        for k in range(room):
            self._set(low + k, parts[k] if k < len(parts) else b"", counts[k] if k < len(parts) else 0)


def _odd(text: bytes) -> bool:
    data = np.frombuffer(text, np.uint8)
    return b"<|" in text or bool(len(_rare_rows(data, np.array([0, len(data)]))))


def _counter(vocabulary: str, find: Callable[[bytes], list[Edit]]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            own = encoder(vocabulary)
            data, start, end, code, first = own.stretches(part.column("text"))
            numbers = own.numbers(data, start, end, code)
            sizes = own.bounds[numbers + 1] - own.bounds[numbers]
            sums = np.concatenate([[0], np.cumsum(sizes)])
            before = sums[first[1:]] - sums[first[:-1]]
            after, edits, again = before.copy(), np.zeros(len(before), np.int64), np.zeros(len(before), np.int64)
            for i, text in enumerate(part.column("text").to_pylist()):
                text = (text or "").encode()
                todo = find(text)
                if not todo:
                    continue
                a, b = int(first[i]), int(first[i + 1])
                pieces = [data[s:e].tobytes() for s, e in zip(start[a:b].tolist(), end[a:b].tolist())]
                tree = CountTree(pieces, sizes[a:b].tolist(), own.tokenizer)
                for s, e, instead in todo:
                    tree.edit(s, e, instead)
                after[i], edits[i], again[i] = tree.total, len(todo), tree.reencoded
            yield record(
                _COUNTED, doc_id=part.column("doc_id"), tokens_before=before, tokens_after=after, n_edits=edits, n_reencoded=again, n_leaves=np.diff(first)
            )

    return count


def edited_counts(docs: DataFrame, find: Callable[[bytes], list[Edit]] = redactions, vocabulary=BYTE_VOCABULARY) -> DataFrame:
    """One row per document: doc_id, tokens_before, tokens_after, n_edits, n_reencoded, n_leaves.

    ``find`` gives a text's edits in the order they are applied.
    """
    ddl = "doc_id long, tokens_before long, tokens_after long, n_edits long, n_reencoded long, n_leaves long"
    return map_arrow(texts_of(docs), _counter(vocabulary, find), ddl)
