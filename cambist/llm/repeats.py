"""Passages that repeat across or within documents, found by seed and extend, and their removal.

1. Texts with the same words are one class; a text that others repeat in full is all
   repeat, so copies never meet again below.
2. Seeds: winnowing picks in every ``window`` consecutive words at least one run of
   ``SEED`` words, by its code alone, so two equal windows pick equal anchors at equal
   places. Anchors that stand in one place only are dropped by an aggregate and a join
   on the anchor.
3. Extension: from each shared anchor, both ways over the text as far as a window can
   reach with the anchor in it. Windows (all of them that hold a shared anchor) are
   counted by a 128-bit code of their words; one that stands in two places is repeated,
   and runs of repeated windows are the maximal repeats, exactly as an extension of each
   pair of places would find them, without forming the pairs.
4. A word is removed if a repeated window covers it.

Counts are combined before each shuffle, so an anchor or passage of a third of all
documents is a few rows per task.

Defined cases: null or empty text has no words; texts shorter than a window have no
repeats; repeated rows repeat each other; equal doc_ids are separate rows, known by
their words; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_size, flat, lists, map_arrow, record, rows_of, saved, texts_of
from .words import Words

WINDOW, SEED = 35, 12
_LONGS = pa.list_(pa.int64())
_INTS = pa.list_(pa.int32())
_SCANNED = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("whole", pa.string()), ("anchors", _LONGS), ("places", _INTS)]
)
_SCANNED_DDL = "doc_id long, text_hash long, text_key long, n_words long, k1 long, k2 long, whole string, anchors array<long>, places array<int>"
_WINDOWS = pa.schema([("cid", pa.int64()), ("place", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())])
_EMPTY = sha256(b"").hexdigest()


def _digests(words: Words) -> list[bytes]:
    """A digest of each row's words, joined by one space."""
    text, edges = words.joined()
    return [sha256(text[a:b]).digest() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def _whole_codes(digests: list[bytes]) -> np.ndarray:
    """The first 16 bytes of each digest as two numbers: texts with the same words, and no others, share them."""
    return np.frombuffer(b"".join(d[:16] for d in digests), "<i8").reshape(-1, 2)


def anchors(words: Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and codes of the seeds winnowing picks: the least of each window's, the rightmost of equals."""
    at, code = words.windows(seed)
    span = window - seed + 1
    if len(at) < span:
        return at[:0], code[:0]
    # The least over span codes, by doubling: blocks of a power of two overlap. Places break ties.
    best = np.arange(len(code))
    width = 1
    while 2 * width <= span:
        best = _lesser(code, best[:-width], best[width:])
        width *= 2
    if width < span:
        best = _lesser(code, best[: len(best) - (span - width)], best[span - width :])
    inside = at[span - 1 :] - at[: len(at) - span + 1] == span - 1  # all seeds of one window of one row
    row = np.repeat(np.arange(len(words.first) - 1), words.counts)
    inside &= row[at[span - 1 :]] == row[at[: len(at) - span + 1]]
    picked = np.unique(best[inside])
    return at[picked], code[picked]


def _lesser(code, left, right):
    return np.where(code[right] <= code[left], right, left)


def _scanner(window: int, seed: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            words = Words(part.column("text"))
            digests = _digests(words)
            keys = _whole_codes(digests)
            place, code = anchors(words, window, seed)
            bounds = np.searchsorted(place, words.first)
            whole = [d.hex() for d in digests]
            start = np.repeat(words.first[:-1], np.diff(bounds))
            yield record(
                _SCANNED, doc_id=part.column("doc_id"), text_hash=part.column("text_hash"), text_key=part.column("text_key"), n_words=words.counts, k1=keys[:, 0], k2=keys[:, 1], whole=whole,
                anchors=lists(code.view(np.int64), bounds, pa.int64()), places=lists((place - start).astype(np.int32), bounds, pa.int32()),
            )

    return scan


def _extender(window: int, seed: int):
    """Windows of a text that hold a shared anchor: class, place, code."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            words = Words(part.column("text"))
            same = _same(words, part)
            anchor, bounds = flat(part.column("places"))
            row = np.repeat(np.arange(part.num_rows), np.diff(bounds))
            keep = same[row]
            at, row = anchor[keep].astype(np.int64) + words.first[:-1][row[keep]], row[keep]
            low = np.maximum(at - (window - seed), words.first[:-1][row])
            high = np.minimum(at, words.first[1:][row] - window)
            mark = np.zeros(len(words.start) + 1, np.int64)
            good = low <= high
            np.add.at(mark, low[good], 1)
            np.add.at(mark, high[good] + 1, -1)
            start = np.flatnonzero(np.cumsum(mark) > 0)
            owner = np.searchsorted(words.first, start, "right") - 1
            yield record(
                _WINDOWS, cid=part.column("cid").to_numpy()[owner], place=(start - words.first[owner]).astype(np.int32),
                w1=words.runs(start, start + window, 11).view(np.int64), w2=words.runs(start, start + window, 12).view(np.int64),
            )

    return extend


def _same(words: Words, part: pa.RecordBatch) -> np.ndarray:
    """Rows whose words are the class's: a doc_id may stand at several texts."""
    keys = _whole_codes(_digests(words))
    return (keys[:, 0] == part.column("k1").to_numpy()) & (keys[:, 1] == part.column("k2").to_numpy())


def covered(words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of a text's words windows at ``starts`` cover."""
    mark = np.zeros(words + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, np.minimum(starts + window, words), -1)
    return np.cumsum(mark[:-1]) > 0


def _remover(window: int, with_text: bool):
    fields = [("cid", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int32()))]
    schema = pa.schema(fields + [("kept_text", pa.string())] * with_text)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            words = Words(part.column("text"))
            rows = np.flatnonzero(_same(words, part)).tolist()
            place, bounds = flat(part.column("starts"))
            out = {name: [] for name in schema.names}
            gone = np.zeros(len(words.start), bool)
            for i in rows:
                a, n = int(words.first[i]), int(words.counts[i])
                gone[a : a + n] = covered(n, place[bounds[i] : bounds[i + 1]], window)
            kept, bytes_of = words.joined(np.flatnonzero(~gone))
            for i in rows:
                a, n = int(words.first[i]), int(words.counts[i])
                own = gone[a : a + n]
                out["cid"].append(part.column("cid")[i].as_py())
                out["n_removed"].append(int(own.sum()))
                out["kept_sha256"].append(sha256(kept[bytes_of[i] : bytes_of[i + 1]]).hexdigest())
                out["spans"].append(np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))).tolist())
                if with_text:
                    out["kept_text"].append(_without(words, i, own))
            yield record(schema, **out)

    return remove


def _without(words: Words, row: int, gone: np.ndarray) -> str:
    """A row's own text without the removed words and the white space after each."""
    begin, end = int(words.offsets[row]), int(words.offsets[row + 1])
    keep = np.ones(end - begin, bool)
    starts = words.start[words.first[row] : words.first[row + 1]]
    nexts = np.concatenate([starts[1:], [end]])
    for s, e in zip(starts[gone].tolist(), nexts[gone].tolist()):
        keep[s - begin : e - begin] = False
    return words.data[begin:end][keep].tobytes().decode("utf-8", "replace").rstrip()


def repeats(docs: DataFrame, window=WINDOW, seed=SEED, with_text=False) -> tuple[DataFrame, DataFrame]:
    """Rows of documents (doc_id, n_words, k1, k2, whole), and what becomes of each text of which something goes.

    The latter by (k1, k2): n_removed, kept_sha256, spans (word bounds of the maximal
    repeats) and, if asked for, kept_text. Texts not listed keep everything.
    """
    hashed = texts_of(docs).withColumn("text_hash", F.xxhash64("text")).withColumn("text_key", F.xxhash64(F.lit(1), "text"))
    scanned = map_arrow(hashed, _scanner(window, seed), _SCANNED_DDL)
    scanned = saved(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")  # fixed by the write
    classes = (
        scanned.where(F.col("n_words") >= window)
        .groupBy("k1", "k2")
        .agg(
            F.count("*").alias("copies"), F.min("row").alias("cid"), F.first("n_words").alias("n_words"),
            F.min_by("doc_id", "row").alias("of"), F.min_by("text_hash", "row").alias("of_hash"),
        )
    )
    classes = saved(classes, "classes")
    # One row of each class: the anchors of copies are the same.
    one = scanned.select(F.col("row").alias("cid"), "anchors", "places").join(classes.select("cid"), "cid", "left_semi")
    found = one.select("cid", F.explode(F.arrays_zip("anchors", "places")).alias("x")).select("cid", F.col("x.anchors").alias("anchor"), F.col("x.places").alias("place"))
    # Written first, so that the join's sides are plain exchanges and a hot anchor's can be split.
    shared = saved(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "shared")
    seeds = found.join(shared, "anchor", "left_semi").groupBy("cid").agg(F.collect_set("place").alias("places"))
    owners = classes.select("cid", "k1", "k2", "of", "of_hash", "copies").join(seeds, "cid")
    texts = texts_of(docs).withColumn("text_hash", F.xxhash64("text"))
    owned = texts.join(owners, F.col("text_hash").eqNullSafe(F.col("of_hash")) & F.col("doc_id").eqNullSafe(F.col("of")))
    owned = owned.select("cid", "text", "k1", "k2", "copies", "places")
    if not scanned.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        owned = owned.dropDuplicates(["cid"])  # the very same row more than once
    owned = saved(owned, "owned")
    # Found twice, for the count and for the join: writing them would take more than the texts.
    windows = map_arrow(owned.select("cid", "text", "k1", "k2", "places"), _extender(window, seed), "cid long, place int, w1 long, w2 long")
    codes = saved(windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2"), "codes")
    starts = windows.join(codes, ["w1", "w2"], "left_semi").groupBy("cid").agg(F.collect_set("place").alias("starts"))
    ddl = "cid long, n_removed long, kept_sha256 string, spans array<int>" + ", kept_text string" * with_text
    partly = map_arrow(owned.where("copies = 1").join(starts, "cid").select("cid", "text", "k1", "k2", "starts"), _remover(window, with_text), ddl)
    partly = classes.select("cid", "k1", "k2").join(partly, "cid").drop("cid")
    none = [F.lit("").alias("kept_text")] * with_text
    wholly = classes.where("copies > 1").select(
        "k1", "k2", F.col("n_words").alias("n_removed"), F.lit(_EMPTY).alias("kept_sha256"), F.array(F.lit(0), F.col("n_words").cast("int")).alias("spans"), *none
    )
    return scanned.select("doc_id", "text_hash", "text_key", "n_words", "k1", "k2", "whole"), partly.unionByName(wholly)


def removal_report(docs: DataFrame, window=WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, spans."""
    rows, changed = repeats(docs, window)
    return rows.join(changed, ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<int>")).alias("spans"),
    )


def without_repeats(docs: DataFrame, window=WINDOW) -> DataFrame:
    """The documents with repeated passages cut out of their texts, all columns kept; ``n_chars`` follows the text.

    A text of which nothing goes stays as it is, byte for byte.
    """
    rows, changed = repeats(docs, window, with_text=True)
    by_text = rows.where("n_words > 0").select("text_hash", "text_key", "k1", "k2").distinct().join(changed.select("k1", "k2", "kept_text"), ["k1", "k2"])
    new = by_text.select(F.struct("text_hash", "text_key").alias("of"), "kept_text")
    match = (F.col("text_hash") == F.col("of.text_hash")) & (F.col("text_key") == F.col("of.text_key"))
    joined, kept = rows_of(docs).join(new, match, "left"), F.col("kept_text")
    columns = {"text": F.coalesce(kept, F.col("document.text").cast("string"))}
    if "n_chars" in docs.columns:
        own = F.col("document.n_chars")
        columns["n_chars"] = F.when(kept.isNull(), own).otherwise(F.length(kept).cast(docs.schema["n_chars"].dataType))
    return joined.select(*[columns.get(c, F.col(f"document.`{c}`")).alias(c) for c in docs.columns])
