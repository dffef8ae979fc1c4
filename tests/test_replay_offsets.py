"""Replay of part of the log, runs of offsets, kept metrics, as-of by sorting, later pages."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from messages import bronze, message
from pyspark.sql import functions as F
from test_publish import at, date, files, rows

from cambist.operators import asof, offsets
from cambist.plans import reports
from cambist.sources.silver_store import SilverStore
from cambist.streaming.progress import KeptProgress, read_progress
from cambist.streaming.silver import apply_batch


def keyed(spark, messages):
    return bronze(spark, messages).withColumn("message_key", F.get_json_object("value", "$.after.payment_id"))


@pytest.mark.parametrize("by_key", [False, True])
def test_replay_changes_the_keys_of_its_messages_alone(spark, tmp_path, by_key):
    log = [
        message("c", 100, payment_id=1, created_at=at(0)),
        message("u", 101, payment_id=1, status="captured", created_at=at(0)),
        message("c", 102, payment_id=2, created_at=at(1)),
        message("u", 103, payment_id=2, status="refunded", created_at=at(4)),
        message("c", 104, payment_id=3, created_at=at(2)),
    ]
    right = keyed(spark, log)
    # A decoder that took the fourth message's row for another payment's, and the second for the newest.
    wrong = log[:1] + [message("u", 900, payment_id=1, status="failed", created_at=at(0)), log[2], message("u", 103, payment_id=7, created_at=at(4)), log[4]]
    store, path = SilverStore(spark, str(tmp_path / "silver")).create(), str(tmp_path / "published")
    apply_batch(store, bronze(spark, wrong), "q", 0)
    store.publish_changes(path)
    assert rows(store, path)[1][0] == "failed" and 7 in rows(store, path)
    before = files(path)
    days = store.replay(right, F.col("offset").isin(1, 3), path, keyed=by_key)
    assert days == {date(0), date(1), date(4)}
    want = {1: ("captured", date(0)), 2: ("refunded", date(4)), 3: ("authorized", date(2))}
    assert rows(store, path) == want
    assert files(path)["created_date=2026-01-03"] == before["created_date=2026-01-03"]
    assert {r.payment_id: r.payment_status for r in store.current().collect()} == {i: s for i, (s, _) in want.items()}
    assert store.publish_changes(path) == set()
    apply_batch(store, bronze(spark, [message("u", 105, payment_id=3, status="captured", created_at=at(2))]), "q", 1)
    assert store.publish_changes(path) == {date(2)} and rows(store, path)[3][0] == "captured"


def test_superseded_folders_are_not_read(spark, tmp_path, monkeypatch):
    store = SilverStore(spark, str(tmp_path / "silver")).create()
    for batch in range(3):
        apply_batch(store, bronze(spark, [message("u", 100 + batch, status=f"s{batch}")]), "q", batch)
    with monkeypatch.context() as m:
        m.setattr("cambist.sources.silver_store.remove_folder", lambda path: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.compact()
    assert store.batches() == {("created", 0), ("folded", 1), ("q", 2)}
    assert [r.payment_status for r in store.current().collect()] == ["s2"]
    apply_batch(store, bronze(spark, [message("u", 200, status="s3")]), "q", 3)
    store.compact()
    assert store.batches() == {("created", 0), ("folded", 2), ("q", 3)} == store._folders()


def test_metrics_are_kept_once_a_batch(spark, tmp_path):
    store = SilverStore(spark, str(tmp_path / "silver")).create()
    assert store.metrics().count() == 0 and store.offsets().count() == 0
    for batch, log in ((0, [message(), "bad"]), (1, [None]), (0, [message(), "bad", None])):
        apply_batch(store, bronze(spark, log), "q", batch)
    got = {(r.query_id, r.batch_id): (r.messages, r.decoded, r.quarantined, r.tombstones, r.reconciles) for r in store.metrics().collect()}
    assert got == {("q", 0): (3, 1, 1, 1, True), ("q", 1): (1, 0, 0, 1, True)}


def test_progress_of_a_batch_is_one_file(spark, tmp_path):
    class Progress:
        id, batchId, timestamp, numInputRows, durationMs = "q", 4, "2026-01-01T00:00:00Z", 7, {"triggerExecution": 12}

    kept = KeptProgress(str(tmp_path / "progress"))
    assert read_progress(spark, kept.folder).count() == 0
    kept.keep(Progress)
    Progress.numInputRows = 9
    kept.keep(Progress)
    Progress.batchId, Progress.numInputRows = 5, 0  # nothing was read
    kept.keep(Progress)
    assert [(r.query_id, r.batch_id, r.input_rows, r.duration_ms) for r in read_progress(spark, kept.folder).collect()] == [("q", 4, 9, 12)]


@pytest.mark.parametrize("bits", [2, 20])
def test_offset_runs_merge_to_the_log(spark, monkeypatch, bits):
    monkeypatch.setattr(offsets, "BLOCK_BITS", bits)
    rnd = random.Random(bits)
    batches = [[("t", p, o) for p in (0, 1) for o in range(60) if rnd.random() < 0.6 for _ in range(rnd.choice([1, 1, 2]))] for _ in range(3)]
    batches[2] = [r for r in batches[2] if r[1] == 0]
    frames = [spark.createDataFrame([*b, ("t", 0, None)], "topic string, partition int, offset long") for b in batches]
    runs = None
    for f in frames:
        own = offsets.offset_runs(f)
        runs = own if runs is None else runs.unionByName(own)
    read = [r for b in batches for r in b]
    cover = {r.partition: (r.first_offset, r.last_offset, r.missing_offsets, r.repeated_records) for r in offsets.coverage(runs).collect()}
    gaps = {(r.partition, o) for r in offsets.gap_list(runs).collect() for o in range(r.first_missing, r.last_missing + 1)}
    for p in (0, 1):
        held = [o for _, q, o in read if q == p]
        missing = set(range(min(held), max(held))) - set(held)
        assert cover[p] == (min(held), max(held), len(missing), len(held) - len(set(held)))
        assert {o for q, o in gaps if q == p} == missing
    empty = offsets.offset_runs(frames[0].limit(0))
    assert offsets.coverage(empty).count() == offsets.gap_list(empty).count() == 0


def test_asof_by_sorting_equals_the_calendar(spark):
    rnd, first = random.Random(3), dt.date(2025, 12, 20)
    rates = [(first + dt.timedelta(days=rnd.randint(0, 100)), "usd" if rnd.random() < 0.9 else "EUR", c, Decimal(rnd.randint(-1, 300)) / 100) for c in ("eur", "GBP", "chf") for _ in range(14)]
    facts = [(i, rnd.choice(["EUR", "eur", "GBP", "USD", "XYZ", None]), None if i % 17 == 0 else first + dt.timedelta(days=rnd.randint(-20, 180))) for i in range(300)]
    r = spark.createDataFrame(rates, "rate_date date, base_currency string, currency string, rate decimal(18,8)")
    f = spark.createDataFrame(facts, "payment_id long, currency string, payment_date date").withColumn("_code", F.lit("x")).withColumn("_day", F.lit("y"))
    want = asof.asof_rate(f.drop("_code", "_day"), r)
    key = lambda row: (row.payment_id, row.currency, str(row.payment_date), str(row.rate), str(row.published_on))
    for block in (1, 40, 10_000):
        got = asof.asof_carried(f, r, block_rows=block)
        assert got.columns == [*f.columns, "rate", "published_on"]
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    none = r.where("rate > 1000")
    assert all(row.rate is None or row.currency == "USD" for row in asof.asof_carried(f, none).collect())


def test_asof_by_sorting_exchanges_facts_once(spark):
    f = spark.range(10).selectExpr("id AS payment_id", "'EUR' AS currency", "date'2026-01-01' AS payment_date")
    r = spark.createDataFrame([(dt.date(2026, 1, 1), "USD", "EUR", Decimal("0.9"))], "rate_date date, base_currency string, currency string, rate decimal(18,8)")
    plan = asof.asof_carried(f, r)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(_code" in line and "_salt" in line]
    assert len(wide) == 1


def test_pages_follow_each_other(spark):
    rows = [(dt.date(2026, 1, d), 1, c, 1, Decimal("1.00"), Decimal("1.00"), 1) for d in range(1, 6) for c in ("EUR", "USD")]
    gold = spark.createDataFrame(
        rows, "revenue_date date, merchant_id long, currency string, payment_count long, gross_amount decimal(22,2), average_amount decimal(12,2), distinct_shoppers long"
    )
    seen, after = [], None
    for n in (3, 3, 3, 1):
        page = reports.merchant_revenue(gold, 1, dt.date(2026, 1, 1), dt.date(2026, 1, 31), limit=3, after=after)
        got = [(r.revenue_date, r.currency) for r in page.days.collect()]
        assert len(got) == n and page.total_days == 10 and page.truncated == (n == 3)
        seen += got
        after = page.next_after
    assert after is None and seen == [(r[0], r[2]) for r in rows]
    for wrong in ("EUR", (1, "EUR"), (dt.date(2026, 1, 1),), (dt.date(2026, 1, 1), None)):
        with pytest.raises(reports.InvalidArgument):
            reports.merchant_revenue(gold, 1, dt.date(2026, 1, 1), dt.date(2026, 1, 31), after=wrong)


def caches(spark):
    """Bytes of what is cached now, by id."""
    return {kept.id(): kept.memSize() + kept.diskSize() for kept in spark.sparkContext._jsc.sc().getRDDStorageInfo()}


def test_batches_keep_raw_values_of_quarantined_messages_alone(spark, tmp_path, monkeypatch):
    """Raw messages of 8 kB each are not cached, but for those that quarantine takes."""
    good = [message("c", 100 + i, payment_id=i, note=random.Random(i).randbytes(4_000).hex()) for i in range(200)]
    bad = ['{"op":"c"', "nothing", message("x", 900), message("c", 901, payment_id=None)]
    before, during = caches(spark), {}
    append = SilverStore.append_changes
    monkeypatch.setattr(SilverStore, "append_changes", lambda *args: (during.update(caches(spark)), append(*args)))
    store = SilverStore(spark, str(tmp_path / "silver")).create()
    counts = apply_batch(store, bronze(spark, [*good, *bad, None, "null"]), "q", 0)
    assert counts == {"batch_id": 0, "messages": 206, "decoded": 200, "quarantined": 4, "tombstones": 2}
    assert sorted(r.payment_id for r in store.current().collect()) == list(range(200))
    assert sorted((r.value, r.offset) for r in store.quarantined().collect()) == sorted(zip(bad, range(200, 204), strict=True))
    assert 0 < sum(size for kept, size in during.items() if kept not in before) < 400_000 < sum(map(len, good)) / 2
