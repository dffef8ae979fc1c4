"""Benchmark items found in documents: BM25 over an inverted index of the items, block-max WAND, then overlap.

Items are indexed by word (ASCII letters lowered, ASCII punctuation parts words), an item
longer than a passage as equal parts of at most a passage's words. A word's BM25 weight in
an item is dealt to the parts by its count in each; a posting's impact is that weight as a
share of the part's own, so a score is the weighted share of a part that a passage holds,
and one threshold fits items of any length. What holds the threshold's share of a whole
item holds it of one part at least, and a part that is copied lies in two passages in a
row, so one of them holds half of it wherever it stands. Terms' counts are of the whole
benchmark table. Postings lie in part order in blocks, each with its greatest impact.

Every document is cut into overlapping passages, and each passage is a query for all
parts at or above the threshold. Per passage the block maxima of its words are summed
first, for all blocks at once; if no block can reach the threshold, none of its parts
can. The other passages are searched by block-max WAND. What is retrieved is verified on
the words around the passage, as many on each side as the item has (``AROUND`` at least):
runs of ``GRAM`` words of the question and of the answer must be there, ``OVERLAP`` of
each. The score reported is that of the best part.

An item's answer is what follows its last question mark, or else its last sentence; the
question is the rest. An item of one sentence is both.

The index goes to the tasks in parts of at most ``PART_BYTES`` of item text, one pass over
the documents for each part, so no broadcast grows with the benchmark.

Defined cases: null or empty texts hold nothing and are found nowhere; items that repeat
are each reported; null ids are carried; empty tables give no rows; other columns are not
read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_size, map_arrow, record, rows_of, texts_of
from .words import PUNCTUATION, Words

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, GRAM = 0.5, 0.5, 3
PASSAGE, STRIDE, AROUND = 64, 32, 64
#: Passages whose bounds are summed at once: sums stay short and exact in a document of any length.
CHUNK = 1024
BLOCK, MOST_BLOCKS = 8, 32
PART_BYTES = 16 << 20

_PARTING = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
        ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("first_word", pa.int64()),
    ]
)
_DDL = "doc_id long, text_hash long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def question_and_answer(text: str) -> tuple[str, str]:
    head, mark, tail = text.rpartition("?")
    if mark and tail.strip():
        return head + mark, tail
    ends = [m.end() for m in re.finditer(r"[.!?](?=\s)", text.rstrip())]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, text)


def _grams(code: np.ndarray, size: int) -> np.ndarray:
    """Codes of all runs of ``size`` words, or of all words if fewer."""
    if not len(code):
        return code
    size = min(size, len(code))
    out = np.zeros(len(code) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + code[k : len(code) - size + 1 + k]
    return out


def _word_codes(texts: list[str]) -> list[np.ndarray]:
    words = Words(pa.array(texts, pa.string()), PUNCTUATION, lower=True)
    return [words.code[a:b] for a, b in zip(words.first[:-1], words.first[1:])]


class Index:
    """``items``: (item_id, text, {word code: items that hold it}); the counts are of the whole benchmark."""

    def __init__(self, items: list, total: int, mean_length: float, gram=GRAM):
        self.ids = [i for i, _, _ in items]
        codes = _word_codes([t for _, t, _ in items])
        parts = [question_and_answer(t) for _, t, _ in items]
        self.gram = gram
        self.questions = [np.unique(_grams(c, gram)) for c in _word_codes([q for q, _ in parts])]
        self.answers = [np.unique(_grams(c, gram)) for c in _word_codes([a for _, a in parts])]
        self.sizes = [(min(gram, len(a)), min(gram, len(b))) for a, b in zip(_word_codes([q for q, _ in parts]), _word_codes([a for _, a in parts]))]
        self.lengths = [len(c) for c in codes]
        self.item, rows, terms, impacts = [], [], [], []  # item: of each part
        for number, (code, (_, _, counts)) in enumerate(zip(codes, items)):
            distinct, which, tf = np.unique(code, return_inverse=True, return_counts=True)
            df = np.array([counts[int(c)] for c in distinct], float)
            idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
            weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(code) / mean_length))
            for held in np.array_split(which, max(1, -(-len(code) // PASSAGE))):
                own, times = np.unique(held, return_counts=True)
                share = weight[own] * (times / tf[own])
                rows.append(np.full(len(own), len(self.item)))
                terms.append(distinct[own])
                impacts.append(share / share.sum() if len(share) else share)
                self.item.append(number)
        row, term, impact = np.concatenate(rows), np.concatenate(terms), np.concatenate(impacts)
        self.terms, which = np.unique(term, return_inverse=True)
        order = np.lexsort((row, which))
        self.row, self.impact, which = row[order], impact[order], which[order]
        self.first = np.searchsorted(which, np.arange(len(self.terms) + 1))
        self.most = np.array([self.impact[a:b].max() for a, b in zip(self.first[:-1], self.first[1:])])
        self.block = max(BLOCK, -(-len(self.item) // MOST_BLOCKS))
        self.rows, self.weights = self.row.tolist(), self.impact.tolist()  # lists for the search's single steps
        self.maxima = np.zeros((len(self.terms), -(-len(self.item) // self.block)), np.float32)
        np.maximum.at(self.maxima, (which, self.row // self.block), self.impact)

    def search(self, terms: np.ndarray, least: float) -> list[tuple[int, float]]:
        """All parts scoring ``least`` or more, by block-max WAND over the terms' postings."""
        out, slack = [], least - 1e-9
        rows, weights = self.rows, self.weights
        blocks = self.maxima[terms].sum(axis=0)
        if blocks.max(initial=0) < slack - 1e-4:  # single precision
            return out
        cursors = [[rows[a], a, b, t] for t, a, b in zip(terms.tolist(), self.first[terms].tolist(), self.first[terms + 1].tolist())]
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += self.most[c[3]]
                if bound >= slack:
                    pivot = k
                    break
            if pivot is None:
                break
            part = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == part:
                pivot += 1
            block = part // self.block
            if blocks[block] < slack - 1e-4 or sum(self.maxima[[c[3] for c in cursors[: pivot + 1]], block].tolist()) < slack - 1e-4:
                # No part from here to the block's end, or to the next list's part, can reach it.
                ahead = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.item)
                target = max(part + 1, min((block + 1) * self.block, ahead))
            elif cursors[0][0] == part:
                score = math.fsum(weights[c[1]] for c in cursors[: pivot + 1])
                if score >= slack:
                    out.append((part, score))
                target = part + 1
            else:
                target = part
            for c in cursors[: pivot + 1]:
                if c[0] < target:
                    c[1] = bisect_left(rows, target, c[1], c[2])
                    c[0] = rows[c[1]] if c[1] < c[2] else -1
            cursors = [c for c in cursors if c[1] < c[2]]
        return out

    def overlaps(self, item: int, code: np.ndarray) -> tuple[float, float]:
        """Shares of the question's and the answer's word runs found among ``code``."""
        got = []
        for own, size in zip((self.questions[item], self.answers[item]), self.sizes[item]):
            got.append(float(np.isin(own, _grams(code, size)).mean()) if len(own) and len(code) >= size else 0.0)
        return got[0], got[1]


def _passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end of all passages of rows whose words lie between ``first`` bounds."""
    counts = np.diff(first)
    number = np.where(counts > 0, np.maximum(1, -(-(counts - PASSAGE) // STRIDE) + 1), 0)
    row = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    begin = first[:-1][row] + nth * STRIDE
    return row, begin, np.minimum(begin + PASSAGE, first[1:][row])


def find_in_words(index: Index, words: Words, least: float, overlap: float) -> list[tuple]:
    """(row, item, score, question overlap, answer overlap, first word) of all that is verified; the best passage of each pair."""
    place = np.searchsorted(index.terms, words.code)
    known = np.flatnonzero(index.terms[np.minimum(place, len(index.terms) - 1)] == words.code)
    term = place[known]
    row, begin, end = _passages(words.first)
    a, b = np.searchsorted(known, begin), np.searchsorted(known, end)
    # A passage is whole strides of its row; a word counts once in each.
    of = np.searchsorted(words.first, known, "right") - 1
    strides = np.concatenate([[0], np.cumsum(-(-words.counts // STRIDE))])
    stride = strides[of] + (known - words.first[of]) // STRIDE
    once = np.unique(stride * len(index.terms) + term)
    low = strides[row] + (begin - words.first[:-1][row]) // STRIDE
    high = strides[row] + -(-(end - words.first[:-1][row]) // STRIDE)
    bounds = np.searchsorted(once // len(index.terms), np.arange(strides[-1] + 1))
    bound = np.zeros(len(row), np.float32)
    for at in range(0, len(row), CHUNK):  # passages lie in the order of their words
        low_, high_ = bounds[low[at : at + CHUNK]], bounds[high[at : at + CHUNK]]
        x, y = int(low_[0]), int(high_.max())
        sums = np.zeros((y - x + 1, index.maxima.shape[1]))
        np.cumsum(index.maxima[once[x:y] % len(index.terms)], axis=0, dtype=np.float64, out=sums[1:])
        bound[at : at + CHUNK] = (sums[high_ - x] - sums[low_ - x]).max(axis=1, initial=0)
    open_ = np.flatnonzero(bound >= least - 0.02)
    best: dict = {}
    for k in open_.tolist():
        r, scores = int(row[k]), {}
        for part, score in index.search(np.unique(term[a[k] : b[k]]), least):
            item = index.item[part]
            scores[item] = max(score, scores.get(item, 0))
        for item, score in scores.items():
            if score <= best.get((r, item), (0,))[0]:
                continue
            around = max(AROUND, index.lengths[item])
            low = max(int(words.first[r]), int(begin[k]) - around)
            high = min(int(words.first[r + 1]), int(end[k]) + around)
            question, answer = index.overlaps(item, words.code[low:high])
            if question >= overlap and answer >= overlap:
                best[r, item] = (score, question, answer, int(begin[k] - words.first[r]))
    return [(r, item, *rest) for (r, item), rest in best.items()]


def _finder(index, least: float, overlap: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for part in by_size(batches, limit=1 << 19):
            words = Words(part.column("text"), PUNCTUATION, lower=True)
            found = find_in_words(own, words, least, overlap)
            rows = pa.array([f[0] for f in found], pa.int64())
            values = list(zip(*found)) if found else [()] * 6
            yield record(
                _FOUND, doc_id=part.column("doc_id").take(rows), text_hash=part.column("text_hash").take(rows), item_id=[own.ids[i] for i in values[1]],
                score=list(values[2]), question_overlap=list(values[3]), answer_overlap=list(values[4]), first_word=list(values[5]),
            )

    return find


def contaminated(docs: DataFrame, benchmark: DataFrame, least=THRESHOLD, overlap=OVERLAP, part_bytes=PART_BYTES) -> DataFrame:
    """One row per document and item found in it, verified; text_hash tells documents of equal doc_id apart."""
    spark = docs.sparkSession
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = F.filter(F.split(F.translate("text", upper, lower), _PARTING), lambda w: w != "")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).withColumn("terms", terms)
    items = items.where(F.size("terms") > 0)
    whole = items.agg(F.count("*").alias("n"), F.avg(F.size("terms")).alias("mean"), F.sum(F.octet_length("text")).alias("bytes")).first()
    out = spark.createDataFrame([], _DDL)
    if not whole["n"]:
        return out
    parts = -(-whole["bytes"] // part_bytes)
    known = F.xxhash64("item_id", "text")
    held = items.select(known.alias("of"), F.explode(F.array_distinct("terms")).alias("term"), F.lit(1).alias("one"))
    counts = items.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    held = held.dropDuplicates(["of", "term"]).join(counts, "term").groupBy("of").agg(F.map_from_entries(F.collect_list(F.struct("term", "df"))).alias("counts"))
    counted = items.withColumn("of", known).join(held, "of").select("item_id", "text", "counts", F.pmod("of", F.lit(parts)).alias("part"))
    rows = texts_of(docs).withColumn("text_hash", F.xxhash64("text"))
    for part in range(parts):
        own = []
        for r in counted.where(F.col("part") == part).sort("item_id", "text").collect():  # at most part_bytes or so of text
            names = list(r["counts"])
            own.append((r["item_id"], r["text"], {int(c[0]): r["counts"][w] for c, w in zip(_word_codes(names), names)}))
        if own:
            index = spark.sparkContext.broadcast(Index(own, whole["n"], whole["mean"]))
            out = out.unionByName(map_arrow(rows, _finder(index, least, overlap), _DDL))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no item is found, all columns kept."""
    found = contaminated(docs, benchmark, **options).select(F.struct("doc_id", "text_hash").alias("found")).distinct()
    rows = rows_of(docs)
    match = F.col("doc_id").eqNullSafe(F.col("found.doc_id")) & F.col("text_hash").eqNullSafe(F.col("found.text_hash"))
    return rows.join(found, match, "left_anti").select("document.*")
