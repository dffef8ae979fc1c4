"""Publishing only the days that change."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from messages import NEW_YEAR_MICROS, bronze, message

from cambist.plans import facts
from cambist.sources import layers
from cambist.sources.silver_store import DAY, SilverStore
from cambist.streaming.silver import apply_batch

DAY_MICROS = 86_400_000_000


def at(day):
    """The new year's first instant plus days."""
    return NEW_YEAR_MICROS + day * DAY_MICROS


def date(day):
    return dt.date(2026, 1, 1) + dt.timedelta(days=day)


@pytest.fixture
def published(spark, tmp_path):
    """A store with five payments on days 0, 0, 1, 2 and without a day, published."""
    store, path = SilverStore(spark, str(tmp_path / "silver")).create(), str(tmp_path / "published")
    days = {1: at(0), 2: at(0), 3: at(1), 4: at(2), 5: "unreadable"}
    apply_batch(store, bronze(spark, [message("c", 100 + i, payment_id=i, created_at=d) for i, d in days.items()]), "q", 0)
    assert store.publish_changes(path) is None
    return store, path


def files(path):
    """Names of the data files by partition folder."""
    return {f: sorted(n for n in os.listdir(f"{path}/{f}") if n.endswith(".parquet")) for f in layers.child_folders(path)}


def rows(store, path):
    return {r.payment_id: (r.payment_status, r[DAY]) for r in store.live(path).collect()}


def test_only_touched_days_are_rewritten(spark, published):
    store, path = published
    before = files(path)
    changes = [
        message("u", 200, payment_id=3, status="captured", created_at=at(5)),  # moved from day 1, which is left empty
        message("d", 201, payment_id=1, created_at=at(0)),  # deleted on day 0
        message("c", 202, payment_id=6, created_at=at(6)),  # new
        message("u", 99, payment_id=4, status="failed", created_at=at(2)),  # older than what is there
    ]
    apply_batch(store, bronze(spark, changes), "q", 1)
    assert store.publish_changes(path) == {date(0), date(1), date(5), date(6)}
    after = files(path)
    assert rows(store, path) == {2: ("authorized", date(0)), 3: ("captured", date(5)), 4: ("authorized", date(2)), 5: ("authorized", None), 6: ("authorized", date(6))}
    untouched = [f"{DAY}=2026-01-03", f"{DAY}={layers.NO_DAY}"]
    assert all(after[f] == before[f] for f in untouched) and f"{DAY}=2026-01-02" not in after
    assert after[f"{DAY}=2026-01-01"] != before[f"{DAY}=2026-01-01"]
    # A late change does not bring the deleted payment back, nor does publishing again.
    apply_batch(store, bronze(spark, [message("u", 150, payment_id=1, created_at=at(0))]), "q", 2)
    assert store.publish_changes(path) == set() == store.publish_changes(path)
    assert 1 not in rows(store, path)
    # The one without a day gets one.
    apply_batch(store, bronze(spark, [message("u", 300, payment_id=5, created_at=at(2))]), "q", 3)
    assert store.publish_changes(path) == {None, date(2)}
    assert rows(store, path)[5] == ("authorized", date(2)) and f"{DAY}={layers.NO_DAY}" not in files(path)


def test_rows_are_read_of_touched_days_and_keys_alone_elsewhere(spark, published, monkeypatch):
    store, path = published
    opened = []
    whole = layers.read_days
    monkeypatch.setattr("cambist.sources.silver_store.read_days", lambda *a: opened.append(whole(*a)) or opened[-1])
    apply_batch(store, bronze(spark, [message("u", 200, payment_id=4, status="captured", created_at=at(2))]), "q", 1)
    store.publish_changes(path)
    (read,) = opened
    assert {f.split(f"{DAY}=")[1].split("/")[0] for f in read.inputFiles()} <= {"2026-01-03"}
    plan = store.published(path).select("payment_id", "cdc_lsn")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<payment_id:bigint,cdc_lsn:bigint>" in plan


def test_a_publication_cut_short_is_made_whole(spark, published, monkeypatch):
    store, path = published
    apply_batch(store, bronze(spark, [message("u", 200, payment_id=2, status="captured", created_at=at(3))]), "q", 1)

    def dies(frame, target, column):
        layers.remove_folder(layers.day_folder(target, column, date(0)))
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr("cambist.sources.silver_store.replace_partitions", dies)
        with pytest.raises(RuntimeError):
            store.publish_changes(path)
    assert 1 not in rows(store, path)  # the day is gone with the job
    assert store.publish_changes(path) is None  # from the changes, all of it
    assert rows(store, path) == {i: (s, d) for i, s, d in [(1, "authorized", date(0)), (2, "captured", date(3)), (3, "authorized", date(1)), (4, "authorized", date(2)), (5, "authorized", None)]}
    assert store.publish_changes(path) == set()


def test_compaction_does_not_publish_again(spark, published):
    store, path = published
    for batch in (1, 2):
        apply_batch(store, bronze(spark, [message("u", 200 + batch, payment_id=2, status="captured", created_at=at(0))]), "q", batch)
    store.publish_changes(path)
    before = files(path)
    assert store.compact() == 2
    assert store.publish_changes(path) == set() and files(path) == before
    # What was folded before it was published is published with the fold.
    for batch in (3, 4):
        apply_batch(store, bronze(spark, [message("u", 300 + batch, payment_id=4, status="refunded", created_at=at(2))]), "q", batch)
    store.compact()
    assert store.publish_changes(path) == {date(2)} and rows(store, path)[4][0] == "refunded"


def test_day_runs():
    days = [date(i) for i in (0, 1, 2, 5, 6, 40, 90)]
    assert facts.day_runs([]) == [] and facts.day_runs(days[:1]) == [(date(0), date(0))]
    assert facts.day_runs(days) == [(date(0), date(2)), (date(5), date(6)), (date(40), date(40)), (date(90), date(90))]
    assert facts.day_runs(days, most=2) == [(date(0), date(40)), (date(90), date(90))]
    assert facts.day_runs(days, most=1) == [(date(0), date(90))]


def test_folders_of_nothing(spark, tmp_path):
    assert layers.child_folders(str(tmp_path / "none")) == [] and layers.get_text(str(tmp_path / "none")) is None
    layers.put_text(str(tmp_path / "a" / "note"), "x")
    layers.put_text(str(tmp_path / "a" / "note"), "y")
    assert layers.get_text(str(tmp_path / "a" / "note")) == "y" and os.listdir(tmp_path / "a") == ["note"]
    layers.remove_file(str(tmp_path / "a" / "note"))
    layers.remove_file(str(tmp_path / "a" / "note"))
    assert not layers.exists(str(tmp_path / "a" / "note"))
