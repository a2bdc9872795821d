"""Repeats of records that landed on earlier days."""

from __future__ import annotations

import pytest

from tallyhouse.sinks import landed_ids
from tallyhouse.sinks.landed_ids import LandedIds
from tests.rows import many, transactions

DAYS = ["2025-06-21", "2025-06-22", "2025-06-23"]


@pytest.fixture
def landed(spark, tmp_path):
    """Three days of a thousand ids each: t0 …, t1000 …, t2000 …"""
    store = LandedIds(str(tmp_path / "landed"))
    for i, day in enumerate(DAYS):
        store.record(many(spark, 1000, transaction_id=f"concat('t', id + {1000 * i})"), day)
    return store


def ids(df):
    return sorted((r.transaction_id for r in df.collect()), key=repr)


def test_unseen_drops_exactly_what_landed_before(spark, landed):
    rows = transactions(spark, *[{"transaction_id": t} for t in ("t5", "t5", "t1500", "new", None, None, "t2999", "t3000")])
    assert ids(landed.unseen(rows, "2025-06-24")) == sorted(["new", None, None, "t3000"], key=repr)
    # Of the same day and of later days nothing counts, so that a day can be run again.
    assert ids(landed.unseen(rows, "2025-06-22")) == sorted(["t1500", "new", None, None, "t2999", "t3000"], key=repr)
    assert landed.unseen(rows, "2025-06-21").count() == 8


def test_only_hit_days_are_read(spark, landed):
    rows = transactions(spark, {"transaction_id": "t1001"})
    read = {f for f in landed.repeats(rows, "2025-06-24").inputFiles() if "/ids/" in f}
    assert read and all("date=2025-06-22" in f for f in read)
    assert landed.repeats(transactions(spark, {"transaction_id": "unheard-of"}), "2025-06-24") is None


def test_filters_miss_nothing_and_pass_little(spark, landed):
    same = landed.candidates(many(spark, 3000), "2025-06-24").collect()
    pairs = {(r.transaction_id, str(r.date)) for r in same}
    assert {(f"t{i}", DAYS[i // 1000]) for i in range(3000)} <= pairs
    assert len(pairs) < 3000 * 1.1
    others = landed.candidates(many(spark, 3000, transaction_id="concat('x', id)"), "2025-06-24")
    assert others.count() < 3000 * 3 * 0.03


def test_days_of_different_size_are_probed_alike(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed_ids, "BITS_PER_ID", 400)  # 1,000 ids take 16 blocks
    store = LandedIds(str(tmp_path / "sizes"))
    for n, day in ((3, DAYS[0]), (1000, DAYS[1]), (0, DAYS[2])):
        store.record(many(spark, n, transaction_id=f"concat('n{n}-', id)"), day)
    rows = transactions(spark, *[{"transaction_id": t} for t in ("n3-2", "n1000-999", "n1000-1000")])
    assert ids(store.unseen(rows, "2025-06-24")) == ["n1000-1000"]


def test_recording_again_replaces_the_day(spark, landed):
    landed.record(transactions(spark, {"transaction_id": "other"}), DAYS[0])
    rows = transactions(spark, {"transaction_id": "t5"}, {"transaction_id": "other"})
    assert ids(landed.unseen(rows, "2025-06-24")) == ["t5"]


def test_nothing_landed_yet(spark, tmp_path):
    rows = transactions(spark, {"transaction_id": "a"})
    assert LandedIds(str(tmp_path / "none")).unseen(rows, "2025-06-24").count() == 1
