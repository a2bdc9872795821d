"""Records of multi-line JSON files, split over tasks, against Python's own parser."""

from __future__ import annotations

import json
import random

import pytest

from tallyhouse.sources import transactions as S
from tallyhouse.sources.json_records import json_records
from tests.test_sources import put, record

NASTY = ['a } b', '},{', '}, {"x": 1}, {', 'quote " and \\ back', '\\', '"}', '{}', "line\nbreak } {", "]", "[{", "é} 中"]


def draw_records(n=400, seed=3):
    draw = random.Random(seed)
    return [record(transaction_id=f"t{i}", location=draw.choice(NASTY) if i % 7 == 0 else "Norfield") for i in range(n)]


@pytest.fixture
def split_small(spark):
    """Splits of 2 KB, as if files were very long."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def rows(df):
    return sorted((r.transaction_id, r.amount, r.location) for r in df.collect())


@pytest.mark.parametrize("layout", ["one line", "indented", "lines", "objects in a row"])
@pytest.mark.parametrize("nasty", [False, True])
def test_every_layout_is_read_by_many_tasks(spark, tmp_path, split_small, layout, nasty):
    records = draw_records() if nasty else [record(transaction_id=f"t{i}") for i in range(400)]
    text = {
        "one line": json.dumps(records, ensure_ascii=False),
        "indented": json.dumps(records, indent=2),
        "lines": "".join(json.dumps(r) + "\n" for r in records),
        "objects in a row": "".join(json.dumps(r) for r in records),
    }[layout]
    put(tmp_path / "x.json", text)
    df = S.read_transactions(spark, str(tmp_path))
    assert rows(df) == sorted((r["transaction_id"], r["amount"], r["location"]) for r in records)
    assert df.where("is_corrupt").isEmpty()
    assert json_records(spark, str(tmp_path)).rdd.getNumPartitions() > 1


BROKEN = {
    "no value": '{"transaction_id": "bad", "amount": }',
    "open string": '{"transaction_id": "bad, "amount": 1}',
    "open string, indented": '{\n "transaction_id": "bad,\n "amount": 1\n}',
    "junk": "{ 4111111111111234 }",
}


@pytest.mark.parametrize("broken", sorted(BROKEN))
def test_a_broken_record_spoils_only_itself(spark, tmp_path, split_small, broken):
    good = [json.dumps(record(transaction_id=f"t{i}")) for i in range(60)]
    put(tmp_path / "x.json", "[" + ",".join([*good[:30], BROKEN[broken], *good[30:]]) + "]")
    df = S.read_transactions(spark, str(tmp_path)).cache()
    ids = {r.transaction_id for r in df.where("NOT is_corrupt").collect()}
    lost = {"t29"} if broken == "junk" else set()  # junk that is no record's start clings to the record before it
    assert {f"t{i}" for i in range(60)} - lost <= ids
    assert df.count() <= 61


def test_a_file_cut_short_does_not_give_a_wrong_record(spark, tmp_path):
    whole = json.dumps([record(transaction_id="a"), record(transaction_id="b", amount=59.95)])
    put(tmp_path / "x.json", whole[: whole.rindex("59.95") + 2])  # … "amount": 59
    found = S.read_transactions(spark, str(tmp_path)).collect()
    assert sorted((r.transaction_id or "", r.is_corrupt) for r in found) in ([("", True), ("a", False)], [("a", False)])
    assert all(r.amount != 59 for r in found)


def test_nested_values_do_not_end_a_record(spark, tmp_path):
    put(tmp_path / "x.json", [{**record(transaction_id="a"), "extra": {"x": {"y": 1}, "z": 2}, "location": "after"}, record(transaction_id="b")])
    assert [(r[0], r[2]) for r in rows(S.read_transactions(spark, str(tmp_path)))] == [("a", "after"), ("b", "Norfield")]


def test_files_without_records(spark, tmp_path):
    for name, text in (("a", ""), ("b", "[]"), ("c", " \n ")):
        put(tmp_path / f"{name}.json", text)
    assert S.read_transactions(spark, str(tmp_path)).isEmpty()
    put(tmp_path / "d.json", "this is not JSON")
    assert [r.is_corrupt for r in S.read_transactions(spark, str(tmp_path)).collect()] == [True]


def test_the_reader_agrees_with_sparks_own(spark, tmp_path):
    put(tmp_path / "x.json", json.dumps([record(transaction_id=f"t{i}", amount=i / 7) for i in range(50)] + [record(amount="bad"), record(timestamp=None)], indent=1))
    own = spark.read.schema(S.TRANSACTION_SCHEMA).option("multiLine", True).option("timestampFormat", S.TIMESTAMP_FORMAT).option("timeZone", "UTC").json(str(tmp_path))
    ours = S.read_transactions(spark, str(tmp_path)).drop("is_corrupt")
    assert sorted(map(str, ours.collect())) == sorted(map(str, own.collect()))
