"""Ranges of times over a zone map of landed files."""

from __future__ import annotations

import json

import pytest

from tallyhouse.sources.zone_map import files_in_range, read_mapped_range, write_zone_map
from tests.test_sources import ids, put, record


def land(root, day, *times):
    put(root / f"year=2025/month=06/day={day:02}/a.json", json.dumps([record(transaction_id=f"{day}-{i}", timestamp=t) for i, t in enumerate(times)]))


@pytest.fixture
def landing(spark, tmp_path):
    """Days 1 to 9; what landed on day 9 happened on day 2 as well."""
    root = tmp_path / "raw"
    for day in range(1, 10):
        land(root, day, f"2025-06-{day:02}T10:00:00Z", None, *(["2025-06-02T23:59:59Z"] if day == 9 else []))
    write_zone_map(spark, str(root), str(tmp_path / "zones"))
    return root, str(tmp_path / "zones")


def days(files):
    return sorted(int(f.split("day=")[1][:2]) for f in files)


def test_late_records_are_found_and_other_files_are_not_read(spark, landing):
    root, zones = landing
    found = read_mapped_range(spark, str(root), zones, "2025-06-02", "2025-06-03")
    assert ids(found) == ["2-0", "3-0", "9-2"]
    assert days(found.inputFiles()) == [2, 3, 9]
    assert {(r.year, r.month) for r in found.collect()} == {(2025, 6)}


def test_files_that_the_map_does_not_know_are_read(spark, landing):
    root, zones = landing
    land(root, 20, "2025-06-02T00:00:00Z")
    assert days(files_in_range(spark, str(root), zones, "2025-06-02", "2025-06-02")) == [2, 9, 20]
    write_zone_map(spark, str(root), zones, landed=[str(root / "year=2025/month=06/day=20")])
    assert days(files_in_range(spark, str(root), zones, "2025-06-05", "2025-06-05")) == [5]
    assert ids(read_mapped_range(spark, str(root), zones, "2025-06-02", "2025-06-02")) == ["2-0", "20-0", "9-2"]


def test_no_file_in_range_and_no_map(spark, landing, tmp_path):
    root, zones = landing
    assert read_mapped_range(spark, str(root), zones, "2024-01-01", "2024-01-02").collect() == []
    found = read_mapped_range(spark, str(root), str(tmp_path / "none"), "2025-06-01", "2025-06-01")
    assert ids(found) == ["1-0"] and len(found.inputFiles()) == 9


def test_files_that_went_are_left_out(spark, landing):
    root, zones = landing
    (root / "year=2025/month=06/day=02/a.json").unlink()
    assert ids(read_mapped_range(spark, str(root), zones, "2025-06-02", "2025-06-02")) == ["9-2"]
