"""Severity of toxic language by a cumulative-link ordinal regression on marker words.

Learned from ``labels`` (doc_id, toxic 0/1), at most about ``SAMPLE`` labelled documents,
chosen by a hash of doc_id; texts that repeat count once. Words (ASCII letters lowered,
ASCII punctuation parts words) whose share among toxic documents is well above that among
others, by odds and by a likelihood-ratio test, are markers: sparse 0/1 features.

Labels tell toxic from not; grades are derived: 0 is not toxic, and toxic documents are
1, 2 or 3 by terciles of how many markers they hold. The model has one weight vector and
three ordered thresholds: P(grade >= k) = sigmoid(w.x - threshold_k). Expected severity is
the sum of the three. A document is toxic if P(grade >= 1) is one half or more.

What reaches the driver is bounded by parameters: at most ``MOST_MARKERS`` word codes,
and the markers of the sampled documents. Scoring is one pass over whole texts.

Defined cases: null or empty texts have no markers and the lowest severity; labels that
are null or contradict another row of the same doc_id count by the greater; without a
usable label or marker every document has severity 0 and is not toxic; rows that repeat
are scored each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_size, lists, map_arrow, record, saved, texts_of
from .words import PUNCTUATION, Words

SAMPLE, MOST_MARKERS = 20_000, 5_000
LEAST_DOCUMENTS, LEAST_LOG_ODDS, LEAST_RATIO = 4, 2.0, 20.0
GRADES = 3
PENALTY, STEPS = 2e-5, 1500

_MARKED = pa.schema([("text_hash", pa.int64()), ("toxic", pa.int32()), ("codes", pa.list_(pa.int64()))])
_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()), ("p_toxic", pa.float64()), ("toxic", pa.bool_())]
)
_SCORED_DDL = "doc_id long, text_hash long, severity double, grade int, p_toxic double, toxic boolean"


def _row_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts, PUNCTUATION, lower=True)
    return np.repeat(np.arange(len(texts)), words.counts), words.code


def _distinct_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in by_size(batches):
        row, code = _row_words(part.column("text"))
        order = np.lexsort((code, row))
        row, code = row[order], code[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
        bounds = np.searchsorted(row[first], np.arange(part.num_rows + 1))
        yield record(_MARKED, text_hash=part.column("text_hash"), toxic=part.column("toxic"), codes=lists(code[first].view(np.int64), bounds, pa.int64()))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class OrdinalModel:
    """Marker codes, their weights, ordered thresholds."""

    def __init__(self, codes=(), weights=(), thresholds=()):
        self.codes = np.asarray(codes, np.uint64)
        self.weights, self.thresholds = np.asarray(weights, float), np.asarray(thresholds, float)

    def score(self, texts: pa.Array) -> np.ndarray:
        """P(grade >= k) for k = 1.. of each text."""
        n = len(texts)
        if not len(self.codes):
            return np.zeros((n, GRADES))
        row, code = _row_words(texts)
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = self.codes[place] == code
        pair = np.unique(row[hit] * len(self.codes) + place[hit])
        total = np.bincount(pair // len(self.codes), self.weights[pair % len(self.codes)], n)
        return sigmoid(total[:, None] - self.thresholds)


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, width: int, penalty=PENALTY, steps=STEPS):
    """Weights and thresholds that minimise the mean negative log-likelihood plus an L2 penalty, by Adam.

    ``rows``, ``columns``: where the sparse 0/1 matrix has ones. Thresholds stay ordered:
    the first is free, the next add exponentials.
    """
    n = len(grades)
    weights = np.zeros(width)
    free = np.concatenate([[2.0], np.full(GRADES - 1, -1.0)])
    moment = [np.zeros(width), np.zeros(width), np.zeros(GRADES), np.zeros(GRADES)]
    for step in range(1, steps + 1):
        gaps = np.exp(free[1:])
        thresholds = free[0] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(rows, weights[columns], n)
        at_least = np.concatenate([np.ones((n, 1)), sigmoid(score[:, None] - thresholds), np.zeros((n, 1))], axis=1)
        high, low = at_least[np.arange(n), grades], at_least[np.arange(n), grades + 1]
        chance = np.maximum(high - low, 1e-12)
        up, down = high * (1 - high) / chance / n, low * (1 - low) / chance / n
        slope = -(up - down)  # of the loss, by the score
        by_weight = np.bincount(columns, slope[rows], width) + penalty * weights
        by_threshold = np.bincount(grades, up, GRADES + 1)[1:] - np.bincount(grades + 1, down, GRADES + 2)[1 : GRADES + 1]
        by_free = np.concatenate([[by_threshold.sum()], [by_threshold[k + 1 :].sum() * gaps[k] for k in range(GRADES - 1)]])
        for value, slope_of, k in ((weights, by_weight, 0), (free, by_free, 2)):
            moment[k] += 0.1 * (slope_of - moment[k])
            moment[k + 1] += 0.01 * (slope_of**2 - moment[k + 1])
            value -= 0.1 * (moment[k] / (1 - 0.9**step)) / (np.sqrt(moment[k + 1] / (1 - 0.99**step)) + 1e-9)
    return weights, free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])


def grades_of(toxic: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """0 for documents not toxic; toxic ones 1 to 3 by terciles of their markers."""
    held = hits[toxic > 0]
    low, high = np.quantile(held, [1 / 3, 2 / 3]) if len(held) else (0, 0)
    return np.where(toxic > 0, 1 + (hits > low) + (hits > high), 0).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, sample=SAMPLE) -> OrdinalModel:
    given = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = sample / max(1, given.count())
    if share < 1:
        given = given.where(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1_000_000)) < int(share * 1_000_000))
    # About ``sample`` rows of two numbers at most.
    known = texts_of(docs).join(F.broadcast(given), "doc_id").where("text is not null")
    known = known.select(F.xxhash64("text").alias("text_hash"), "text", "toxic").groupBy("text_hash").agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    marked = saved(map_arrow(known, _distinct_codes, "text_hash long, toxic int, codes array<long>"), "labelled")
    totals = marked.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    bad = float(totals["toxic"] or 0)
    good = float(totals["n"]) - bad
    if not bad or not good:
        return OrdinalModel()
    counts = marked.select("toxic", F.explode("codes").alias("code")).groupBy("code").agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (bad + 1) / ((F.col("b") + 0.5) / (good + 1)))
    expected = (F.col("a") + F.col("b")) * (bad / (bad + good))
    other = (F.col("a") + F.col("b")) * (good / (bad + good))
    ratio = 2 * (F.col("a") * F.log(F.col("a") / expected) + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / other)).otherwise(0.0))
    chosen = counts.where(F.col("a") >= LEAST_DOCUMENTS).withColumn("odds", odds).withColumn("ratio", ratio)
    chosen = chosen.where((F.col("odds") >= LEAST_LOG_ODDS) & (F.col("ratio") >= LEAST_RATIO)).orderBy(F.desc("ratio"), "code").limit(MOST_MARKERS)
    codes = np.sort(np.array([r["code"] for r in chosen.select("code").collect()], np.int64).view(np.uint64))
    if not len(codes):
        return OrdinalModel()
    markers = F.array(*[F.lit(int(c)) for c in codes.view(np.int64)])
    rows = marked.select("text_hash", "toxic", F.array_intersect("codes", markers).alias("codes")).orderBy("text_hash").collect()
    toxic = np.array([r["toxic"] for r in rows])
    hits = np.array([len(r["codes"]) for r in rows])
    flat_codes = np.array([c for r in rows for c in r["codes"]], np.int64).view(np.uint64)
    weights, thresholds = fit_ordinal(np.repeat(np.arange(len(rows)), hits), np.searchsorted(codes, flat_codes), grades_of(toxic, hits), len(codes))
    return OrdinalModel(codes, weights, thresholds)


def _scorer(model: OrdinalModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            at_least = model.score(part.column("text"))
            yield record(
                _SCORED, doc_id=part.column("doc_id"), text_hash=part.column("text_hash"), severity=at_least.sum(axis=1),
                grade=(at_least >= 0.5).sum(axis=1).astype(np.int32), p_toxic=at_least[:, 0], toxic=at_least[:, 0] >= 0.5,
            )

    return score


def severity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """One row per document: doc_id, text_hash, severity (expected grade), grade, p_toxic, toxic."""
    rows = texts_of(docs).withColumn("text_hash", F.xxhash64("text"))
    return map_arrow(rows, _scorer(model), _SCORED_DDL)


def _keeper(model: OrdinalModel):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            yield part.filter(pa.array(model.score(part.column("text"))[:, 0] < 0.5))

    return keep


def without_toxic(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The documents that are not toxic, all columns kept; one pass, no shuffle."""
    return map_arrow(docs, _keeper(model), docs.schema)
