"""Current state from changes: collapse, merge, change log, compaction, streams."""

from __future__ import annotations

import json
import uuid

import pytest
from messages import bronze, envelope, message
from hypothesis import given, settings
from hypothesis import strategies as st

from cambist.operators.collapse import current_rows, latest_change_per_key, live_rows, newest_per_key, state_rows
from cambist.operators.decode import decoded_changes
from cambist.operators.merge import merge_changes
from cambist.schemas import PAYMENTS
from cambist.sources.change_log import FileLogSource, KafkaSource, bronze_stream, to_bronze
from cambist.sources.silver_store import SilverStore
from cambist.streaming.bronze import run_bronze
from cambist.streaming.silver import apply_batch, run_silver

SCENARIOS = {
    "update applies": ([[("c", 100, "authorized")], [("u", 200, "refunded")]], "refunded"),
    "delete removes": ([[("c", 100, "authorized")], [("d", 200, "authorized")]], None),
    "stale update is ignored": (
        [[("c", 100, "authorized")], [("u", 300, "refunded")], [("u", 100, "authorized")]], "refunded"),
    "several in one batch": ([[("c", 100, "authorized"), ("u", 300, "refunded"), ("u", 200, "captured")]], "refunded"),
    "insert then delete in one batch": ([[("c", 100, "authorized"), ("d", 200, "authorized")]], None),
    "delete of unseen row": ([[("d", 500, "authorized")]], None),
    "snapshot read": ([[("r", 1, "authorized")]], "authorized"),
    "identical batch twice": ([[("c", 100, "captured")], [("c", 100, "captured")]], "captured"),
    "stale delete": ([[("c", 100, "authorized")], [("u", 300, "refunded")], [("d", 200, "authorized")]], "refunded"),
    "no resurrection": ([[("c", 100, "authorized")], [("d", 200, "authorized")], [("c", 100, "authorized")]], None),
    "bad messages": ([[("c", 100, "authorized"), "not json at all", None]], "authorized"),
}


def batch(spark, events):
    return bronze(spark, [message(e[0], e[1], status=e[2]) if isinstance(e, tuple) else e for e in events])


def statuses(frame):
    return {r.payment_id: r.payment_status for r in frame.collect()}


def expected(status):
    return {} if status is None else {1001: status}


def new_store(spark, tmp_path):
    return SilverStore(spark, str(tmp_path / uuid.uuid4().hex)).create()


@pytest.mark.parametrize("name", SCENARIOS)
def test_merge(spark, name):
    batches, status = SCENARIOS[name]
    state = spark.createDataFrame([], PAYMENTS.state_schema)
    for events in batches:
        state = merge_changes(state, state_rows(decoded_changes(batch(spark, events)), PAYMENTS))
    assert statuses(live_rows(state, PAYMENTS)) == expected(status)


@pytest.mark.parametrize("name", SCENARIOS)
def test_change_log(spark, tmp_path, name):
    batches, status = SCENARIOS[name]
    store = new_store(spark, tmp_path)
    for i, events in enumerate(batches):
        apply_batch(store, batch(spark, events), "q", i)
    assert statuses(store.current()) == expected(status)
    store.compact()
    assert statuses(store.current()) == expected(status)


def test_literal_clauses(spark):
    """The unguarded form: a stale delete removes the row, and a stale insert brings it back."""

    def run(batches):
        target = spark.createDataFrame([], PAYMENTS.silver_schema)
        for events in batches:
            changes = state_rows(decoded_changes(batch(spark, events)), PAYMENTS)
            target = merge_changes(target, changes, strict=False)
        return statuses(target)

    for name in ("update applies", "delete removes", "stale update is ignored", "delete of unseen row", "snapshot read"):
        batches, status = SCENARIOS[name]
        assert run(batches) == expected(status), name
    assert run(SCENARIOS["stale delete"][0]) == {}
    assert run(SCENARIOS["no resurrection"][0]) == {1001: "authorized"}


def test_missing_log_position_falls_back_to_time_then_arrival(spark):
    early, late = 1767225600000, 1767225600001
    events = [envelope("u", None, status="late", ts_ms=late), envelope("u", None, status="early", ts_ms=early)]
    assert statuses(current_rows(decoded_changes(bronze(spark, map(json.dumps, events))), PAYMENTS)) == {1001: "late"}
    tied = [message("u", 100, status="first"), message("u", 100, status="second")]
    assert statuses(current_rows(decoded_changes(bronze(spark, tied)), PAYMENTS)) == {1001: "second"}
    mixed = [message("u", 5, status="placed"), message("u", None, status="unplaced", ts_ms=late)]
    assert statuses(current_rows(decoded_changes(bronze(spark, mixed)), PAYMENTS)) == {1001: "placed"}


def test_rows_are_kept_apart_and_tombstones_left_out(spark):
    decoded = decoded_changes(bronze(spark, [message(payment_id=1), message(payment_id=2), None]))
    assert latest_change_per_key(decoded, PAYMENTS).count() == 2


def test_any_split_order_and_repetition_gives_the_same_state(spark, tmp_path):
    event = st.tuples(st.integers(1, 4), st.sampled_from("curd"), st.integers(1, 8))

    @settings(max_examples=15, deadline=None)
    @given(st.lists(event, min_size=1, max_size=20), st.randoms(use_true_random=False))
    def check(events, random):
        texts = [message(op, lsn, payment_id=key, status=f"{op}{lsn}") for key, op, lsn in dict.fromkeys(events)]
        # one change per (key, position): the log never holds two
        texts = list({(json.loads(t)["source"]["lsn"], (json.loads(t)["after"] or json.loads(t)["before"])["payment_id"]): t
                      for t in texts}.values())
        whole = statuses(current_rows(decoded_changes(bronze(spark, texts)), PAYMENTS))
        shuffled = texts + random.sample(texts, len(texts) // 2)
        random.shuffle(shuffled)
        cut = random.randint(0, len(shuffled))
        store = new_store(spark, tmp_path)
        for i, part in enumerate((shuffled[:cut], shuffled[cut:])):
            apply_batch(store, bronze(spark, part), "q", i)
            if random.random() < 0.5:
                store.compact()
        assert statuses(store.current()) == whole

    check()


def test_retried_batch_does_not_duplicate(spark, tmp_path):
    store = new_store(spark, tmp_path)
    for _ in range(2):
        apply_batch(store, bronze(spark, [message(), "not json at all"]), "q", 0)
    assert store.changes().count() == 1 and store.quarantined().count() == 1
    metrics = apply_batch(store, bronze(spark, [message(), "not json at all", None]), "q", 1)
    assert metrics == {"batch_id": 1, "messages": 3, "decoded": 1, "quarantined": 1, "tombstones": 1}


def test_compaction_drops_no_late_batch_and_no_delete(spark, tmp_path):
    store = new_store(spark, tmp_path)
    apply_batch(store, bronze(spark, [message(payment_id=i) for i in range(50)]), "a", 0)
    apply_batch(store, bronze(spark, [message("u", 200, payment_id=7, status="refunded")]), "a", 1)
    apply_batch(store, bronze(spark, [message("d", 300, payment_id=8)]), "b", 0)
    store.compact()
    apply_batch(store, bronze(spark, [message("u", 60, payment_id=9)]), "b", 1)
    store.compact()
    apply_batch(store, bronze(spark, [message("u", 50, payment_id=8)]), "b", 2)
    got = statuses(store.current())
    assert len(got) == 49 and got[7] == "refunded" and 8 not in got


def test_compaction_removes_what_it_folded(spark, tmp_path):
    store = new_store(spark, tmp_path)
    for batch in range(5):
        apply_batch(store, bronze(spark, [message(payment_id=batch)]), "q", batch)
    assert store.compact() == 4 and len(store.batches()) <= 3
    assert ("q", 4) in store.batches() and ("q", 3) not in store.batches()
    assert store.compact() == 0
    apply_batch(store, bronze(spark, [message("u", 500, payment_id=0, status="refunded")]), "q", 5)
    store.compact()
    assert {q for q, _ in store.batches()} == {"folded", "q", "created"} - ({"created"} - {q for q, _ in store.batches()})
    assert statuses(store.current()) == {0: "refunded", **{i: "authorized" for i in range(1, 5)}}


def test_interrupted_compaction_changes_nothing(spark, tmp_path):
    store = new_store(spark, tmp_path)
    for batch, status in enumerate(("authorized", "captured", "refunded")):
        apply_batch(store, bronze(spark, [message("u", 100 + batch, status=status)]), "q", batch)
    # Folded, and the job died before the folders went.
    store.state().write.parquet(store.batch_folder(store.changes_path(), "folded", 1))
    assert statuses(store.current()) == {1001: "refunded"}
    store.compact()
    assert statuses(store.current()) == {1001: "refunded"}


def test_collapse_limits_each_key_before_the_shuffle(spark):
    changes = spark.createDataFrame([], PAYMENTS.state_schema)
    plan = newest_per_key(changes, PAYMENTS.key)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_publish_partitions_by_creation_day(spark, tmp_path):
    store = new_store(spark, tmp_path)
    next_day = 1767225600000000 + 86_400_000_000
    apply_batch(store, bronze(spark, [message(payment_id=1), message(payment_id=2, created_at=next_day)]), "q", 0)
    target = str(tmp_path / "published")
    for _ in range(2):
        store.publish(target)
    days = spark.read.parquet(target).groupBy("created_date").count().collect()
    assert sorted((str(r.created_date), r["count"]) for r in days) == [("2026-01-01", 1), ("2026-01-02", 1)]


def log_records(spark, messages, start=0):
    rows = [(b"k", bytearray(m.encode()) if m else None, PAYMENTS.topic, 0, start + i) for i, m in enumerate(messages)]
    frame = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    return frame.selectExpr("*", "timestamp'2026-01-01 00:00:00' AS timestamp")


def test_streams_drain_resume_and_survive_a_checkpoint_reset(spark, tmp_path):
    log, bronze_path = str(tmp_path / "log"), str(tmp_path / "bronze")
    store = SilverStore(spark, str(tmp_path / "silver"))
    seen = []

    def run(checkpoint="silver"):
        source = FileLogSource(log, max_files_per_trigger=1)
        run_bronze(source.stream(spark, PAYMENTS.topic), bronze_path, str(tmp_path / "_bronze"))
        run_silver(bronze_stream(spark, bronze_path, 1), store, str(tmp_path / f"_{checkpoint}"), seen.append)

    log_records(spark, [message("c", 100), message("c", 101, payment_id=2), None, "not json at all"]).coalesce(1).write.parquet(log)
    run()
    assert statuses(store.current()) == {1001: "authorized", 2: "authorized"}
    log_records(spark, [message("u", 300, status="refunded"), message("d", 301, payment_id=2)], 4).coalesce(1).write.mode("append").parquet(log)
    run()
    assert statuses(store.current()) == {1001: "refunded"}
    assert spark.read.parquet(bronze_path).count() == 6
    assert sum(m["messages"] for m in seen) == 6
    run("silver_again")  # everything is read a second time
    assert sum(m["messages"] for m in seen) == 12
    assert statuses(store.current()) == {1001: "refunded"}
    assert store.quarantined().count() == 1
    rebuilt = current_rows(decoded_changes(spark.read.parquet(bronze_path)), PAYMENTS)
    assert statuses(rebuilt) == {1001: "refunded"}


def test_bronze_keeps_messages_verbatim(spark):
    row = to_bronze(log_records(spark, [" {broken"])).first()
    assert row.value == " {broken" and row.message_key == "k" and row.ingested_at is not None
    assert to_bronze(log_records(spark, ["x"])).columns == [
        "value", "message_key", "topic", "partition", "offset", "kafka_timestamp", "ingested_at"
    ]


def test_kafka_options():
    assert KafkaSource("broker:9092").options("cdc.public.payments") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "cdc.public.payments",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "100000",
        "failOnDataLoss": "false",
    }
