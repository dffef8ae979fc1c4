"""Language of a text by a string kernel: presence of n-grams, Nyström landmarks, kernel ridge regression.

The blended-spectrum presence kernel of two texts is the number of byte n-grams (one to
``ORDER`` bytes, ASCII letters lowered, each text between two spaces) that both hold,
divided by the geometric mean of how many each holds. ``LANDMARKS`` texts of the learned
documents stand for all: with K the kernel among them, a text's features are its kernel
with the landmarks times K^(-1/2). One ridge regression per language against the rest is
solved from the sums of products of features. As both steps are linear, they fold into
one matrix from n-grams to languages, and texts are scored by a batch's presence matrix
times it.

Learned documents: those with a language whose crc32(doc_id as text) modulo 5 is not 0,
about ``SAMPLE`` of each language chosen by a hash of doc_id, each text once. Predictions
see the text alone. The score is the winner's share after a softmax of the regressions.

Defined cases: a null text or one without a letter is ``und`` with score 0; without a
learned language every text is; a null doc_id is held out; rows that repeat are rated
each; ties go to the language that sorts first; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_size, lists, map_arrow, record, saved, texts_of
from .words import LOWER

ORDER, LANDMARKS, SAMPLE = 3, 160, 1_000
RIDGE, SHARPNESS = 1e-3, 6.0
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
_GRAMS = pa.schema([("lang", pa.string()), ("text_hash", pa.int64()), ("grams", pa.list_(pa.int32()))])
_PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _offsets(order: int) -> list[int]:
    """Where the n-grams of each length begin in one numbering."""
    return [sum(256**k for k in range(1, n)) for n in range(1, order + 1)]


def gram_numbers(texts: pa.Array, order=ORDER):
    """(row, number) of every n-gram of every text, one pair of arrays for each length."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    spaced = np.full(len(data) + 2 * len(size), 0x20, np.int32)  # each text between two spaces
    row = np.repeat(np.arange(len(size)), size + 2)
    inside = np.ones(len(spaced), bool)
    edge = offsets[:-1] + 2 * np.arange(len(size))
    inside[edge] = inside[edge + size + 1] = False
    spaced[inside] = LOWER[data]
    number = np.zeros(len(spaced), np.int32)
    for n, base in enumerate(_offsets(order), 1):
        number = number[: len(spaced) - n + 1] * 256 + spaced[n - 1 :]
        same = row[: len(row) - n + 1] == row[n - 1 :]
        yield row[: len(row) - n + 1][same], number[same] + base


def _gram_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in by_size(batches):
        n = part.num_rows
        row, number = (np.concatenate(x) for x in zip(*gram_numbers(part.column("text"))))
        pair = np.unique(row.astype(np.int64) << 32 | number)
        bounds = np.searchsorted(pair >> 32, np.arange(n + 1))
        yield record(
            _GRAMS, lang=part.column("lang"), text_hash=part.column("text_hash"), grams=lists((pair & 0xFFFFFFFF).astype(np.int32), bounds, pa.int32())
        )


class Kernel:
    """The landmarks' n-grams, and the map from presence to features."""

    def __init__(self, landmarks: list[np.ndarray]):
        self.numbers = np.unique(np.concatenate(landmarks))
        self.presence = np.zeros((len(self.numbers), len(landmarks)), np.float32)
        for k, grams in enumerate(landmarks):
            self.presence[np.searchsorted(self.numbers, grams), k] = 1 / np.sqrt(len(grams))
        among = np.stack([self.of(g) for g in landmarks])
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        values = np.maximum(values, 1e-6 * values[-1])
        self.root = vectors / np.sqrt(values) @ vectors.T

    def of(self, grams: np.ndarray) -> np.ndarray:
        """The kernel of a text, given its n-grams, with each landmark."""
        place = np.minimum(np.searchsorted(self.numbers, grams), len(self.numbers) - 1)
        return self.presence[place[self.numbers[place] == grams]].sum(axis=0, dtype=np.float64) / np.sqrt(max(1, len(grams)))

    def features(self, grams: np.ndarray) -> np.ndarray:
        return self.of(grams) @ self.root


class Classifier:
    """n-gram numbers and a weight per language; ``scores`` is one matrix product a batch."""

    def __init__(self, languages: list[str], numbers: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.languages, self.numbers = languages, numbers
        self.weights, self.bias = weights.astype(np.float32), bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        table = self._table()
        present = np.zeros((len(texts), len(self.numbers) + 1), np.float32)
        held = np.zeros(len(texts))
        for row, number in gram_numbers(texts):
            present[row, table[number]] = 1
            held += self._distinct(row, number, len(texts))
        present = present[:, :-1]  # the last column is every n-gram no landmark has
        return present @ self.weights / np.sqrt(np.maximum(held, 1))[:, None] + self.bias

    def _table(self) -> np.ndarray:
        """From n-gram number to column, made once in a worker."""
        if getattr(self, "_places", None) is None:
            self._places = np.full(_offsets(ORDER + 1)[-1], len(self.numbers), np.int32)
            self._places[self.numbers] = np.arange(len(self.numbers))
            self._seen = np.zeros(_offsets(ORDER + 1)[-1], np.int32)
        return self._places

    def _distinct(self, row, number, n) -> np.ndarray:
        """How many distinct n-grams each row has: the last row that wrote a number's place owns it, row by row."""
        out = np.zeros(n)
        bounds = np.searchsorted(row, np.arange(n + 1)).tolist()
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            own = number[a:b]
            self._seen[own] = np.arange(1, b - a + 1)
            out[i] = (self._seen[own] == np.arange(1, b - a + 1)).sum()
        return out

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}


def _products(kernel: Kernel, languages: list[str]):
    schema = pa.schema([("products", pa.binary())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = kernel.root.shape[0] + 1
        total = np.zeros((wide, wide + len(languages)))
        for batch in batches:
            for lang, grams in zip(batch.column("lang").to_pylist(), batch.column("grams")):
                own = np.concatenate([kernel.features(grams.values.to_numpy()), [1.0]])
                target = np.array([1.0 if lang == x else -1.0 for x in languages])
                total += np.outer(own, np.concatenate([own, target]))
        yield record(schema, products=[total.tobytes()])

    return add


def held_out_fold() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def train(docs: DataFrame, sample=SAMPLE, landmarks=LANDMARKS) -> Classifier | None:
    learned = texts_of(docs, F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null").where(~held_out_fold())
    counts = {r["lang"]: r["n"] for r in learned.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000))
    share = F.element_at(F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(int(min(1.0, sample / counts[k]) * 1_000_000)))]), F.col("lang"))
    chosen = learned.where(draw < share).select("lang", "text", F.xxhash64("text").alias("text_hash"))
    chosen = chosen.groupBy("text_hash", "lang").agg(F.first("text").alias("text"))
    grams = saved(map_arrow(chosen.select("lang", "text_hash", "text"), _gram_sets, "lang string, text_hash long, grams array<int>"), "grams")
    each = -(-landmarks // len(languages))
    long_enough = grams.where(F.size("grams") > 8)
    own = []
    for lang in languages:  # bounded: ``landmarks`` rows in all
        own += long_enough.where(F.col("lang") == lang).orderBy("text_hash").limit(each).collect()
    if not own:
        return None
    kernel = Kernel([np.array(r["grams"], np.int64) for r in own])
    sums = sum(np.frombuffer(r["products"]) for r in map_arrow(grams.repartition(8), _products(kernel, languages), "products binary").collect())
    wide = kernel.root.shape[0] + 1
    sums = sums.reshape(wide, wide + len(languages))
    left = sums[:, :wide] + RIDGE * np.diag([sums[-1, wide - 1]] * (wide - 1) + [0.0])
    solved = np.linalg.solve(left + 1e-9 * np.eye(wide), sums[:, wide:])
    return Classifier(languages, kernel.numbers, kernel.presence @ (kernel.root @ solved[:-1]), solved[-1])


def _predictor(model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for part in by_size(batches, limit=1 << 19):
            for at in range(0, part.num_rows, 256):
                rows = part.slice(at, 256)
                value = own.scores(rows.column("text"))
                best = value.argmax(axis=1)
                share = np.exp(SHARPNESS * (value - value.max(axis=1, keepdims=True)))
                share = 1 / share.sum(axis=1)
                known = rows.column("lettered").to_numpy(zero_copy_only=False)
                names = [own.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)]
                yield record(_PREDICTED, doc_id=rows.column("doc_id"), held_out=rows.column("held_out"), lang_pred=names, score=np.where(known, share, 0.0))

    return predict


def predict(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = texts_of(docs).select("doc_id", "text", held_out_fold().alias("held_out"), lettered.alias("lettered"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # n-grams of the landmarks times languages
    return map_arrow(rows, _predictor(shared), "doc_id long, held_out boolean, lang_pred string, score double")
