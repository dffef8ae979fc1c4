"""Best-fit packing, importance resampling and vector codes, against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cambist.llm import best_fit, codebooks, importance
from cambist.llm.encoding import WORD_VOCABULARY, vocabulary_path

TOKENIZER = Tokenizer.from_file(vocabulary_path(WORD_VOCABULARY))


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return crc32(np.array(ids, "<u4").tobytes())


# -- best fit ------------------------------------------------------------
@given(st.lists(st.integers(1, 49), max_size=300), st.integers(1, 12))
@settings(max_examples=100, deadline=None)
def test_each_item_goes_to_the_fullest_open_sequence_it_fits(lengths, limit):
    """Against a list of open sequences, searched one by one."""
    own, open_, closed = best_fit.OpenSequences(50, limit), {}, []
    for i, length in enumerate(lengths):
        want = []
        fits = [f for f, _ in open_.values() if f >= length]
        if fits:
            target = min(fits)
        else:
            if len(open_) == limit:
                fullest = min(f for f, _ in open_.values())
                want.append(fullest)
            target = 50
        got = own.place(length, (i, length))
        for number, items in got:
            closed.append(items)
            open_.pop(number, None)
        held = {n: sum(x for _, x in items) for n, items in own.held.items()}
        new = next(((n, items) for n, items in [*own.held.items(), *got] if (i, length) in items))
        assert 50 - (sum(x for _, x in new[1]) - length) == target
        if want:
            assert 50 - sum(x for _, x in got[0][1]) == want[0]
        open_ = {n: (50 - size, own.held[n]) for n, size in held.items()}
        assert len(open_) <= limit and all(f > 0 for f, _ in open_.values())
    placed = [x for items in closed for x in items] + [x for _, _, items in own.rest() for x in items]
    assert sorted(placed) == list(enumerate(lengths))
    assert all(sum(x for _, x in items) <= 50 for items in closed)


def test_best_fit_packing(spark, documents):
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "x", "yz"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 40, 150])))) for i in range(400)]
    rows += [(None, "no id"), (3, None), (3, "twice"), (3, "twice"), (99, ""), (7, "long " * 2500), (8, "x" * 4000)]
    frame = documents(rows).repartition(6)
    pieces = best_fit.pack(frame, capacity=512, open_sequences=16).collect()
    sequences, texts = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        texts[p.doc_id].append((p.piece, p.start, p.length, p.ids_crc32))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at and length > 0
            at += length
        assert at <= 512
    want = defaultdict(list)
    for doc_id, text in rows:
        ids = ids_of(text)
        want[doc_id] += [(k, s, len(ids[s : s + 512]), crc(ids[s : s + 512])) for k, s in enumerate(range(0, len(ids), 512))]
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}
    total = sum(p.length for p in pieces)
    assert len(sequences) <= 1.04 * total / 512 + 1
    assert best_fit.pack(documents([])).count() == 0


# -- importance ----------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = ["", None, " - ", "A", "The cat's 9 lives", "ÄÖ äö  ß—x\x7fy\x00z", "don't_stop `now` {a}", "日本 語。x", "a " * 40, "one\ntwo\tthree four"]


def features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


@given(st.lists(st.one_of(st.sampled_from(TEXTS), st.text(alphabet="aB9 é-\n_'\x7f日", max_size=40)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_spans_are_all_runs_of_words(texts):
    words, rows, found = importance.codes([(t or "").encode() for t in texts])
    for i, text in enumerate(texts):
        own, runs = features(text)
        assert words[i] == len(own) and sorted(found[rows == i].tolist()) == sorted(crc32(r.encode()) for r in runs)


def test_codes_of_long_words():
    text = " ".join(["x" * n for n in (47, 48, 49, 5000)] + ["end"])
    _, _, found = importance.codes([text.encode()])
    assert sorted(found.tolist()) == sorted(crc32(r.encode()) for r in features(text)[1])


def brute_scores(rows, target, percent, min_words, buckets):
    source, wanted = Counter(), Counter()
    bucket = lambda f: crc32(f.encode()) % buckets
    for _, text in rows:
        source.update(map(bucket, features(text)[1]))
    for text in target:
        wanted.update(map(bucket, features(text)[1]))
    s_all, t_all, out = sum(source.values()), sum(wanted.values()), []
    for doc_id, text in rows:
        words, runs = features(text)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in map(bucket, runs))
        h = int(sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words), len(runs), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], math.inf if r[0] is None else r[0], -r[3], -r[2]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return out


def test_importance_scores(spark, documents):
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choice(["red", "blue", "Sum", "x2", "é", "if", "-"]) for _ in range(rnd.randint(0, 60)))) for i in range(120)]
    rows += [(200 + i, t) for i, t in enumerate(TEXTS)] + [(5, rows[5][1]), (5, rows[5][1]), (None, "no id here " * 9)]
    target = ["red sum sum x2", None, "", "if é if", "red red red"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string").withColumn("n_words", F.lit("x"))
    docs = documents(rows).repartition(5)
    got = importance.scores(docs, frame, percent=30, min_words=20, buckets=50).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want = brute_scores(rows, target, 30, 20, 50)
    assert sorted((key(r) for r in got.collect())) == sorted(key(r) for r in want)
    drawn = importance.resampled(docs, frame, percent=30, min_words=20, buckets=50)
    assert drawn.columns == docs.columns and sorted(map(str, (r.doc_id for r in drawn.collect()))) == sorted(str(r[0]) for r in want if r[5])
    empty = importance.scores(documents([]), frame.limit(0))
    assert empty.count() == 0 and importance.resampled(documents([]), frame).count() == 0


# -- vector codes --------------------------------------------------------
def brute_codes(rows, entries, rounds=4, parts=4):
    kept = [(i, [math.floor(1024 * x) if abs(x) < 1e15 else int(x) * 1024 for x in v], label) for i, v, label in rows]
    kept.sort(key=lambda r: (math.inf if r[0] is None else r[0], r[1]))
    size = len(kept[0][1]) // parts
    cut = [[v[p * size : (p + 1) * size] for _, v, _ in kept] for p in range(parts)]
    books = [[list(v) for v in part[:entries]] for part in cut]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(p, v)[1] for v in cut[p]]
            for k in range(len(books[p])):
                mine = [v for v, o in zip(cut[p], own) if o == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[nearest(p, v) for v in cut[p]] for p in range(parts)]
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    total, errors = Counter(), [sum(found[p][n][0] for p in range(parts)) for n in range(len(kept))]
    for (_, _, label), e in zip(kept, errors):
        total[label] += e
    return sorted(
        (str(i), "".join(f"{found[p][n][1]:02x}" for p in range(parts)), errors[n], total[label], digest) for n, (i, _, label) in enumerate(kept)
    )


VECTORS = "vec_id long, embedding array<double>, label int, code string, _label string, places string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", "z") for i, v, label in rows], VECTORS)


@pytest.mark.parametrize("entries", [3, 16])
def test_vector_codes(spark, entries):
    rnd = np.random.default_rng(entries)
    rows = [(int(i), rnd.normal(size=8).tolist(), None if i % 5 == 0 else int(i % 3)) for i in rnd.permutation(150)]
    rows += [(4, rows[0][1], 1), (4, rows[0][1], 1), (None, [0.5] * 8, 2), (900, [-0.25] * 8, None), (901, [1e-9, -1e-9] * 4, 0)]
    odd = [(-1, None, 1), (-2, [], 1), (-3, [1.0, None] * 4, 1), (-4, [float("nan")] * 8, 1), (-5, [float("inf")] * 8, 1), (902, [1.0] * 4, 1), (903, [1.0] * 3, 1)]
    got = codebooks.compressed(vector_frame(spark, rows + odd).repartition(4), entries=entries)
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect())
    assert got == brute_codes(rows, entries)


def test_vectors_of_any_size(spark):
    """Components beyond 64 bits: exact codebooks and codes; what leaves a long is null."""
    rows = [(i, [float(i % 3), 1e6 * i, -3e17, 1e40 * (i % 2)], i % 2) for i in range(9)]
    got = codebooks.compressed(vector_frame(spark, rows), entries=2).collect()
    want = brute_codes(rows, 2)
    assert sorted((str(r.vec_id), r.code, r.codebooks_sha256) for r in got) == [(i, c, d) for i, c, _, _, d in want]
    assert sorted((str(r.vec_id), r.error) for r in got) == [(i, e if e < 1 << 63 else None) for i, _, e, _, _ in want]


def test_vector_codes_of_nothing(spark):
    assert codebooks.compressed(vector_frame(spark, [])).count() == 0
    assert codebooks.compressed(vector_frame(spark, [(1, None, 1)])).count() == 0


@given(st.integers(-(2**200), 2**200))
@settings(max_examples=200, deadline=None)
def test_limbs(total):
    assert sum(x << (40 * i) for i, x in enumerate(codebooks.limbs(total))) == total
    assert all(abs(x) < 1 << 41 for x in codebooks.limbs(total))
