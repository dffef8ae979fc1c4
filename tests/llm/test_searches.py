"""Near copies, repeats, benchmark items, greatest products, licenses, against brute force."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cambist.llm import components, decontamination, licenses, mtree, near_duplicates, repeats

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = SPLIT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def groups(rows, size, percent=80):
    """(doc_id, set size, smallest doc_id reachable) of every row, sorted, and how many documents are left of them."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    members = sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)
    return members, len({find(i) for i, s in enumerate(sets) if s}) + sum(not s for s in sets)


def varied(rnd, base, changes):
    words = base.split()
    for _ in range(changes):
        words[rnd.randrange(len(words))] = f"z{rnd.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, documents, size):
    rnd = random.Random(size)
    rows = []
    for k in range(25):
        base = " ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.randint(5, 80)))
        rows += [(len(rows) + i, varied(rnd, base, rnd.randint(0, 5))) for i in range(rnd.randint(1, 4))]
    rows += [(500, ""), (501, None), (502, " \n"), (503, "One"), (504, "one"), (None, "one"), (None, "alone here now"), (2, rows[7][1].upper()), (503, "One"), (505, "y " * 20000)]
    got = near_duplicates.near_duplicates(documents(rows), size)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == groups(rows, size)[0]
    kept = near_duplicates.one_of_each(documents(rows), size)
    assert kept.columns == documents(rows).columns
    assert kept.count() == groups(rows, size)[1]


def test_a_large_group_of_near_copies(spark, documents, monkeypatch):
    """Nodes stay larger than a leaf, so pivots and blocks decide."""
    monkeypatch.setattr(near_duplicates, "SMALL", 8)
    monkeypatch.setattr(near_duplicates, "BLOCK_BYTES", 10_000)
    monkeypatch.setattr(near_duplicates, "DEPTH", 2)
    rnd = random.Random(1)
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(i, varied(rnd, base, rnd.randint(0, 9))) for i in range(160)]
    got = near_duplicates.near_duplicates(documents(rows), 2)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == groups(rows, 2)[0]


def common_phrases(rnd, n):
    """Texts that share many of few phrases, each pair less than the threshold, and hold words of their own."""
    phrases = [f"of{i} the{i} and{i}" for i in range(40)]
    return [" ".join(rnd.sample(phrases, 22) + [f"own{k}x{i}" for i in range(12)]) for k in range(n)]


def test_unlike_classes_that_share_values_are_no_group(spark, documents, monkeypatch):
    """Three levels of branches leave them in nodes larger than a leaf; more part them."""
    monkeypatch.setattr(near_duplicates, "SMALL", 12)
    monkeypatch.setattr(near_duplicates, "FEW_ROWS", 60, raising=False)
    rows = list(enumerate(common_phrases(random.Random(4), 500)))
    _, classes = near_duplicates.classes_of(documents(rows), 2)
    seeds, large = near_duplicates._leaves(classes, 80)
    assert large is None or large.select("cid").distinct().count() < 50
    sizes = {r.node: r["count"] for r in seeds.groupBy("node").count().collect()}
    assert max(sizes.values(), default=0) <= 60


def test_groups_amid_unlike_classes(spark, documents, monkeypatch):
    """Cores of large nodes are groups, what is beside them in a node is compared with them and branches on."""
    monkeypatch.setattr(near_duplicates, "SMALL", 8)
    monkeypatch.setattr(near_duplicates, "FEW_ROWS", 20, raising=False)
    monkeypatch.setattr(near_duplicates, "BLOCK_BYTES", 10_000)
    monkeypatch.setattr(near_duplicates, "BLOCK_SETS", 50)
    rnd = random.Random(6)
    texts = common_phrases(rnd, 120)
    texts += [varied(rnd, texts[k], rnd.randint(1, 9)) for k in (0, 1) for _ in range(60)]
    texts += [varied(rnd, t, 3) for t in texts[2:12]]
    rows = list(enumerate(texts))
    found = near_duplicates._leaves(near_duplicates.classes_of(documents(rows), 2)[1], 80)[1]
    assert {r.core for r in found.select("core").distinct().collect()} == {True, False}
    got = near_duplicates.near_duplicates(documents(rows), 2)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == groups(rows, 2)[0]


def test_sketches_compared_one_by_one_or_all_at_once():
    random_ = np.random.default_rng(5)
    values = random_.integers(0, 1 << 32, (60, near_duplicates.PLACES)).astype(np.uint32)
    for i in range(1, 60):  # between some, just as many places differ as may
        keep = random_.random(near_duplicates.PLACES) < random_.choice([0.4, 0.6, 0.7])
        values[i, keep] = values[random_.integers(0, i), keep]
    sketch, n = near_duplicates.sketches(values), random_.integers(80, 130, 60)
    a, b = (x.ravel() for x in np.indices((60, 60)))
    one = near_duplicates._alike(sketch[a], sketch[b], n[a], n[b], 80).reshape(60, 60)
    signs = near_duplicates._signs(sketch)
    assert (near_duplicates._all_alike(signs, signs, n, n, 80) == one).all() and 60 < one.sum() < 3000


def test_links_of_pairs_alike_by_sketch(monkeypatch):
    """One by one or by matrices, the same components as without sketches."""
    random_ = np.random.default_rng(9)
    bases = random_.integers(0, 1 << 63, (6, 60)).astype(np.uint64)
    sets = [np.unique(np.concatenate([bases[k % 6][:-m], random_.integers(0, 1 << 63, m).astype(np.uint64)])) for k, m in enumerate(random_.integers(1, 9, 90))]
    sketch, comp = near_duplicates.sketches(near_duplicates.minwise(sets)), np.arange(90) % 45

    def parts(*sketch):
        links = near_duplicates._linked(sets, comp, 80, *sketch)
        _, root = near_duplicates._spanning([*comp.tolist(), *(comp[a] for a, _ in links)], [*comp.tolist(), *(comp[b] for _, b in links)])
        return len(links), [[root(c) for c in comp.tolist()].index(root(c)) for c in comp.tolist()]

    expected = parts()
    assert 20 < expected[0] < 45
    for few in (0, 1 << 14):
        monkeypatch.setattr(near_duplicates, "FEW_PAIRS", few)
        assert parts(sketch) == expected


def test_thousands_of_short_classes_below_the_threshold_take_little_memory():
    random_ = np.random.default_rng(3)
    base = np.arange(22, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base, random_.integers(100, 4000, 8).astype(np.uint64)])) for _ in range(5000)]
    for a, b in ((10, 4990), (4990, 2500), (7, 8)):  # linked across places far apart
        sets[b] = sets[a].copy()
        sets[b][-1] = 10_000 + b
    kind = pa.list_(pa.struct([("cid", pa.int64()), ("comp", pa.int64()), ("codes", pa.binary())]))
    members = pa.array([[{"cid": i, "comp": i + 7, "codes": s.tobytes()} for i, s in enumerate(sets)]], kind)
    tracemalloc.start()
    (out,) = near_duplicates._linker(80)(iter([pa.record_batch([members], ["members"])]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = {(r["a"], r["b"]) for r in out.to_pylist()}
    assert len(got) == 3 and (7, 8) in got and {x for pair in got for x in pair} == {7, 8, 10, 2500, 4990}
    assert peak < 200 << 20


def test_near_duplicates_of_nothing(spark, documents):
    assert near_duplicates.near_duplicates(documents([])).count() == 0
    assert near_duplicates.one_of_each(documents([])).count() == 0
    assert near_duplicates.one_of_each(documents([(1, None), (1, None), (2, "a")])).count() == 3


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (200, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# -- repeats ---------------------------------------------------------------
def removal(rows, window):
    words = [SPLIT.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return sorted(out, key=str)


def test_repeats(spark, documents):
    rnd = random.Random(5)
    passages = [" ".join(f"p{rnd.randrange(50)}" for _ in range(n)) for n in (34, 35, 36, 50, 120)]
    rows = []
    for k in range(40):
        parts = [" ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(0, 40))) for _ in range(4)]
        for p in rnd.sample(passages, rnd.randint(0, 3)):
            parts.insert(rnd.randrange(len(parts)), p)
        rows.append((k, ("\n" if k % 2 else "  ").join(parts)))
    rows += [(90, None), (91, ""), (92, "short"), (93, "a " * 200), (None, rows[3][1]), (None, None), (5, rows[9][1]), (94, rows[11][1]), (94, rows[11][1]), (95, " ".join(f"u{i}" for i in range(30000)))]
    got = repeats.removal_report(documents(rows))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == removal(rows, 35)
    cut = repeats.without_repeats(documents(rows))
    assert cut.columns == documents(rows).columns and cut.count() == len(rows)
    whole = {sha: None for _, _, _, sha in removal(rows, 35)}
    assert {sha256(" ".join(SPLIT.findall(r.text or "")).encode()).hexdigest() for r in cut.collect()} == set(whole)
    assert all(r.n_chars == len(r.text) for r in cut.where("text is not null").collect())


def test_repeats_of_nothing(spark, documents):
    assert repeats.removal_report(documents([])).count() == 0
    assert repeats.without_repeats(documents([])).count() == 0


# -- benchmark items ---------------------------------------------------------
def index_of(items):
    codes = decontamination._word_codes([t for _, t in items])
    df = Counter(int(c) for code in codes for c in set(code.tolist()))
    counted = [(i, t, {int(c): df[int(c)] for c in code}) for (i, t), code in zip(items, codes)]
    return decontamination.Index(counted, len(items), np.mean([len(c) for c in codes]))


def test_search_finds_all_above_the_threshold():
    rnd = random.Random(2)
    items = [(k, " ".join(f"w{int(rnd.expovariate(0.03))}" for _ in range(rnd.randint(3, 30)))) for k in range(300)]
    index = index_of(items)
    for _ in range(150):
        terms = np.unique([rnd.randrange(len(index.terms)) for _ in range(rnd.randint(1, 60))])
        scores = Counter()
        for t in terms.tolist():
            for p in range(index.first[t], index.first[t + 1]):
                scores[int(index.row[p])] += float(index.impact[p])
        for least in (0.2, 0.5):
            want = {i: s for i, s in scores.items() if s >= least}
            got = dict(index.search(terms, least))
            assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)


def benchmark_rows(rnd, n):
    return [(k, " ".join(f"q{rnd.randrange(4000)}" for _ in range(20)).capitalize() + f"? Answer a{k} b{k} c{k} d{k}.") for k in range(n)]


def test_contaminated(spark, documents):
    rnd = random.Random(6)
    items = benchmark_rows(rnd, 50)
    rows = [(k, " ".join(f"q{rnd.randrange(4000)}" for _ in range(rnd.randint(0, 300)))) for k in range(60)]
    planted = {(100 + k, k) for k in range(50)}
    rows += [(100 + k, f"{rows[k][1]}\n{text.upper()} {rows[k + 1][1]}") for k, text in items]
    rows += [(200, items[0][1].split("?")[0]), (201, None), (202, ""), (None, items[1][1]), (203, items[2][1]), (203, items[2][1]), (203, "clean"), (204, "q1 " * 20000)]
    bench = spark.createDataFrame(items + [(70, None), (71, ""), (None, items[3][1])], "item_id long, text string").withColumn("doc_id", F.lit("x"))
    for options in ({}, {"part_bytes": 1500}):
        got = [(r.doc_id, r.item_id) for r in decontamination.contaminated(documents(rows), bench, **options).collect()]
        assert sorted(got, key=str) == sorted([*planted, (None, 1), (203, 2), (203, 2), (103, None)], key=str)
    left = decontamination.without_contaminated(documents(rows), bench)
    assert left.columns == documents(rows).columns
    assert sorted(r.doc_id for r in left.collect()) == [*range(60), 200, 201, 202, 203, 204]


@pytest.mark.parametrize("size", [64, 100, 150, 300, 1000])
def test_long_items_are_found_at_any_offset(size):
    rnd = random.Random(size)
    word = lambda: f"w{int(rnd.paretovariate(0.7)) % 9000}"
    items = [(k, " ".join(word() for _ in range(size)) + "? " + " ".join(f"a{k}x{i}" for i in range(size // 4))) for k in range(6)]
    items += [(10 + k, " ".join(word() for _ in range(20))) for k in range(30)]
    index, texts = index_of(items), []
    for offset in (0, 1, 15, 16, 17, 31, 40, 500):
        texts += [" ".join([word() for _ in range(offset)] + [t] + [word() for _ in range(70)]) for _, t in items[:6]]
    cut = [t[: len(t) // 5] for _, t in items[:6]]  # the answer is missing
    words = decontamination.Words(pa.array(texts + cut), decontamination.PUNCTUATION, lower=True)
    found = decontamination.find_in_words(index, words, decontamination.THRESHOLD, decontamination.OVERLAP)
    assert sorted((r, i) for r, i, *_ in found if i < 6) == [(r, r % 6) for r in range(len(texts))]
    assert all(q == a == 1.0 for _, i, _, q, a, _ in found if i < 6)


def test_what_holds_the_threshold_of_a_long_item_holds_it_of_a_part():
    rnd = random.Random(4)
    items = [(k, " ".join(f"w{int(rnd.expovariate(0.01))}" for _ in range(rnd.randint(65, 400)))) for k in range(40)]
    codes = decontamination._word_codes([t for _, t in items])
    index, df = index_of(items), Counter(int(c) for code in codes for c in set(code.tolist()))
    mean = np.mean([len(c) for c in codes])
    for number, code in enumerate(codes):
        distinct, tf = np.unique(code, return_counts=True)
        n = np.array([df[int(c)] for c in distinct])
        weight = np.log(1 + (40 - n + 0.5) / (n + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(code) / mean))
        for _ in range(20):
            held = np.array([rnd.random() < 0.55 for _ in distinct])
            if weight[held].sum() >= 0.5 * weight.sum():
                got = index.search(np.searchsorted(index.terms, distinct[held]), 0.5)
                assert number in {index.item[p] for p, _ in got}


def test_an_item_at_the_end_of_a_document_of_millions_of_words():
    """Half of an item, just at the threshold, behind words whose running sums reach some ten thousand."""
    index = index_of([(0, " ".join(f"w{i}" for i in range(60)))])
    stride = " ".join(["u"] * 19 + [f"w{i}" for i in range(13)])  # two of them hold 26 of 60 words
    text = " ".join([stride] * 160_000) + " u" * 64 + " " + " ".join(f"w{i}" for i in range(30))
    words = decontamination.Words(pa.array([text]), decontamination.PUNCTUATION, lower=True)
    found = decontamination.find_in_words(index, words, 0.5, 0.4)
    assert [(r, i) for r, i, *_ in found] == [(0, 0)] and found[0][2] == pytest.approx(0.5)


def test_contaminated_by_nothing(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(documents([(1, "a")]), none).count() == 0
    assert decontamination.without_contaminated(documents([(1, "a"), (2, None)]), none).count() == 2
    assert decontamination.contaminated(documents([]), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0


# -- greatest products -------------------------------------------------------
def test_greatest_products(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE", 200)
    monkeypatch.setattr(mtree, "QUERIES_PER_BLOCK", 3)
    random_ = np.random.default_rng(4)
    centres = random_.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.05 * random_.normal(size=8)).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one common vector
    rows += [(2000, None), (2001, []), (2002, [1.0, None] * 4), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (2050, [0.5, 0.5]), (2051, [1.0, -1.0]), (None, rows[3][1]), (50, rows[4][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit("x")).withColumn("dim", F.lit("y"))
    got = {}
    for r in mtree.greatest_products(frame).collect():
        got.setdefault((r.query_id), []).append((r.rank, r.vec_id, r.score))
    valid = [(n, i, np.floor(256 * np.array(v))) for n, (i, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all()]
    want = {}
    for n, i, q in valid:
        if i is not None and i % 50 == 0:
            scores = sorted((-int(q @ v), -1 if j is None else j, j) for m, j, v in valid if m != n and len(v) == len(q))
            want.setdefault(i, []).extend((k + 1, j, -s) for k, (s, _, j) in enumerate(scores[:5]))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}


def test_bounds_avoid_distances():
    random_ = np.random.default_rng(1)
    vectors = np.floor(256 * np.concatenate([c + 0.01 * random_.normal(size=(300, 6)) for c in random_.normal(size=(10, 6))]))
    tree = mtree.MTree(vectors, np.arange(3000), np.arange(3000))
    tree.search(vectors[::100], np.arange(0, 3000, 100), 5)
    assert tree.computed < 0.6 * 30 * 3000


def test_products_of_nothing(spark):
    assert mtree.greatest_products(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# -- licenses ------------------------------------------------------------------
def test_longest_increasing():
    rnd = random.Random(3)
    for _ in range(100):
        values = [rnd.randrange(20) for _ in range(rnd.randrange(12))]
        best = [1] * len(values)
        for i in range(len(values)):
            best[i] = 1 + max([best[j] for j in range(i) if values[j] < values[i]], default=0)
        got = [values[i] for i in licenses.longest_increasing(values)]
        assert len(got) == max(best, default=0) and got == sorted(set(got))


def test_alignment_is_an_alignment():
    rnd = random.Random(3)
    for _ in range(200):
        a, b = ([rnd.choice("abcdefgh") for _ in range(rnd.randrange(15))] for _ in range(2))
        got = licenses.patience_align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x < y and v < w for (x, v), (y, w) in zip(got, got[1:]))
    assert licenses.patience_align(list("xabcx"), list("abc")) == [(1, 0), (2, 1), (3, 2)]


def test_license_scan(spark, documents):
    filler = " ".join(f"w{i}" for i in range(700))
    texts = {k: f"{filler} the the license {t.upper()}\n{filler}" for k, t in enumerate(licenses.TEMPLATES.values())}
    rows = [*texts.items(), (50, filler), (51, None), (52, ""), (53, "Released under the MIT License. " * 3), (None, "Licensed under CC BY-NC 4.0"), (54, "Licensed under a BY 3.0 of mine")]
    got = {(r.doc_id, r.license) for r in licenses.license_scan(documents(rows)).collect()}
    names = list(licenses.TEMPLATES)
    assert {(k, names[k]) for k in range(len(names))} <= got
    assert {g for g in got if g[0] is None or g[0] >= 50} == {(53, "MIT"), (None, "CC-BY-NC-4.0")}
    assert licenses.license_scan(documents([])).count() == 0
