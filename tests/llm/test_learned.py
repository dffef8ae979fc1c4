"""Severity, language and the pipeline, by held-out documents and planted cases."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cambist.llm import language, toxicity
from cambist.llm.shared import saved

BAD = [f"vile{k}" for k in range(8)]


def toxic_corpus(rnd, n):
    rows = []
    for i in range(n):
        words = [f"w{int(rnd.expovariate(0.02))}" for _ in range(rnd.randint(3, 60))]
        bad = i % 5 == 0
        for _ in range(rnd.randint(1, 6) * bad):
            words.insert(rnd.randrange(len(words)), rnd.choice(BAD).upper() + "!")
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_severity(spark, documents):
    rnd = random.Random(1)
    rows = toxic_corpus(rnd, 900)
    docs = documents([(i, t) for i, t, _ in rows] + [(2000, None), (2001, ""), (None, "vile1 vile2 vile3"), (3, rows[5][1]), (2002, "w1 " * 20000 + "vile2")])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows[:600]] + [(None, 0, 1), (700, None, None), (1, 1, rows[1][2])], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    got = [r for r in toxicity.severity(docs, model).collect()]
    assert len(got) == docs.count()
    held = [r for r in got if r.doc_id is not None and 600 <= r.doc_id < 900]
    assert np.mean([r.toxic == (r.doc_id % 5 == 0) for r in held]) > 0.97
    one = {r.doc_id: r for r in got if r.doc_id in (2000, 2001, 2002, None)}
    assert not one[2000].toxic and one[2000].severity == one[2001].severity < 0.5 and one[2002].toxic and one[None].toxic
    assert one[None].severity > one[2002].severity
    left = toxicity.without_toxic(docs, model)
    assert left.columns == docs.columns and left.count() == sum(not r.toxic for r in got)


def test_severity_without_labels(spark, documents):
    docs = documents([(1, "a"), (2, None)])
    for rows in ([], [(1, 1, 0)], [(1, 1, 1), (2, 1, 0)]):
        model = toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
        assert [(r.severity, r.toxic) for r in toxicity.severity(docs, model).collect()] == [(0.0, False)] * 2


def test_ordinal_fit_orders_grades():
    random_ = np.random.default_rng(0)
    hits = random_.integers(0, 8, 600)
    rows = np.repeat(np.arange(600), hits)
    columns = np.concatenate([random_.permutation(8)[:h] for h in hits])
    grades = np.minimum(hits // 2, 3)
    weights, thresholds = toxicity.fit_ordinal(rows, columns, grades, 8)
    score = np.bincount(rows, weights[columns], 600)
    expected = toxicity.sigmoid(score[:, None] - thresholds).sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.95 and (np.diff(thresholds) > 0).all() and (weights > 0).all()


SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["shr", "upf", "och"], "cc": ["éa", "ñu", "ió"]}


def test_language(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(400):
        lang = sorted(SYLLABLES)[i % 3]
        text = " ".join("".join(rnd.choices(SYLLABLES[lang], k=3)) for _ in range(rnd.randint(2, 30)))
        rows.append((i, text, None if i % 40 == 0 else lang, "s"))
    rows += [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "123 ?!", "aa", "s"), (None, "kalomi kaka", "aa", "s"), (3, "kalo", "aa", "s"), (903, "kamilo " * 20000, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("score", F.lit("x")).withColumn("text_hash", F.lit("y"))
    got = language.predict(docs, language.train(docs, landmarks=30)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None) and by[None].held_out
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert np.mean([r.lang_pred == sorted(SYLLABLES)[r.doc_id % 3] for r in held]) > 0.97
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (900, 901, 902)) and by[903].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got)
    blind = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predict(blind, language.train(blind)).collect()} == {"und"}
    assert language.predict(docs.limit(0), language.train(docs.limit(0))).count() == 0


def test_language_does_not_see_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lied = docs.withColumn("lang", F.when(language.held_out_fold(), F.lit("xx")).otherwise(F.col("lang")))
    assert language.predict(docs, language.train(docs)).exceptAll(language.predict(lied, language.train(lied))).count() == 0


# -- the pipeline ---------------------------------------------------------------
def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_repeats", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(spark, docs, sf_dir), name)
        if name == "packing":
            assert out.select("doc_id").distinct().count() == docs.count()
        else:
            assert out.columns == docs.columns and out.schema == docs.schema
            assert out.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
            assert out.count() > 0.7 * docs.count()
            docs = out


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_one_of_each(texts, size=5, percent=80):
    """Ids that stay: the smallest of each component of documents whose shingles are alike, and all without words."""
    sets, root = {}, {}
    for i, text in texts.items():
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        runs = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)] if len(words) >= size else [tuple(words)] * bool(words)
        sets[i], root[i] = set(runs), i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i for i in sets if find(i) == i}


def brute_kept_words(texts, window=35):
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    count = Counter(tuple(w[k : k + window]) for w in words.values() for k in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        gone = {k + x for k in range(len(w) - window + 1) if count[tuple(w[k : k + window])] > 1 for x in range(window)}
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def test_stages_against_brute_force(spark, sf_dir):
    """Near copies, repeats and packing of the whole table; benchmark items by their verbatim passages."""
    stages, docs = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = lambda frame: {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}
    before = texts(docs)
    kept = saved(stages["near_duplicates"](spark, docs, sf_dir), "kept")
    assert texts(kept) == {i: before[i] for i in brute_one_of_each(before)} and kept.count() < docs.count()
    cut = saved(stages["substring_repeats"](spark, docs, sf_dir), "cut")
    after, want = texts(cut), brute_kept_words(before)
    assert {i: WORD.findall(t or "") for i, t in after.items()} == want
    changed = {i for i in before if len(want[i]) < len(WORD.findall(before[i] or ""))}
    assert changed and all(after[i] == before[i] for i in before if i not in changed)
    clean = texts(stages["decontamination"](spark, docs, sf_dir))
    items = [" ".join(WORD.findall(r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    whole = {i for i, t in before.items() if any(x in " ".join(WORD.findall((t or "").lower())) for x in items)}
    assert whole and not whole & set(clean) and all(before[i] == t for i, t in clean.items())
    pieces = stages["packing"](spark, docs, sf_dir).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("want")).collect()
    assert len(pieces) == len(before) and all(r.n == r.want for r in pieces)


def test_severity_of_documents_it_was_not_trained_on(spark, sf_dir):
    """Held out: four fifths of the labels are learned from, the rest are graded."""
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/{n}.parquet") for n in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    graded = toxicity.severity(docs, toxicity.train(docs, labels.where(~fold))).select("doc_id", "toxic").withColumnRenamed("toxic", "found")
    got = graded.join(labels.where(fold).dropna(), "doc_id").groupBy("toxic").agg(F.avg(F.col("found").cast("int")).alias("share"), F.count("*").alias("n")).collect()
    share = {r.toxic: r.share for r in got}
    assert share[1] > 0.85 and share[0] < 0.01, got


def test_stages_take_odd_tables(spark, tmp_path):
    rnd = random.Random(9)
    text = " ".join(f"w{i}" for i in range(90))
    rows = [(1, text), (2, text), (None, None), (None, text + " more"), (3, ""), (4, " ".join(f"v{rnd.randrange(999)}" for _ in range(40))), (4, "other words")]
    frame = spark.createDataFrame([(i, t, None, None, None, "e") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, place string")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "v1 v2")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs, n in ((frame, 5), (frame.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = saved(stage(spark, docs, str(tmp_path)), name)
            if name != "packing":
                assert docs.columns == frame.columns
            if name == "decontamination":
                assert docs.count() == n


def test_registered():
    from cambist.llm.queries import ORACLES, QUERIES

    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
