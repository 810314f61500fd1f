"""Tables in segments: versions, ranges, merges, and what a write touches."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cardlens.schema import FRAUD_TRANSACTION, STRING, KeyedTable
from cardlens.schema import DOUBLE
from cardlens.sinks import segments
from cardlens.sinks.segments import ConcurrentWrite, DataFile, Manifest, Segment, SegmentTable, overlapping
from cardlens.workspace import snapshot
from tests.test_sinks import history

PAIRS = KeyedTable(name="pairs", fields={"k": STRING, "v": DOUBLE}, key=("k",), newest=("v",), partition="bucket")


def pairs(spark, rows):
    return spark.createDataFrame(list(rows), "k string, v double")


def content(df):
    return sorted((r.k or "", r.v) for r in df.collect())


def files_of(manifest):
    return {f.path for s in manifest.segments for f in s.files}


@pytest.fixture
def small_files(monkeypatch):
    monkeypatch.setattr(segments, "MAX_RECORDS_PER_FILE", 100)


def numbered(spark, low, high, value):
    return spark.range(low, high).select(F.format_string("%06d", "id").alias("k"), F.lit(float(value)).alias("v"))


def test_the_last_write_of_a_key_wins(spark, tmp_path):
    """Against a dictionary, over many random writes with merges in between."""
    rnd, stored, want = random.Random(4), SegmentTable(spark, PAIRS, str(tmp_path), fan=3), {}
    for i in range(9):
        batch = {f"{rnd.randrange(60):03d}": float(i) for _ in range(rnd.choice([1, 5, 40]))}
        want.update(batch)
        stored.upsert(pairs(spark, batch.items()))
        assert content(stored.read()) == sorted(want.items())
    assert len(stored.manifest().segments) < 9
    stored.compact(everything=True)
    assert len(stored.manifest().segments) == 1 and content(stored.read()) == sorted(want.items())


def test_within_a_write_the_newest_row_wins(spark, tmp_path):
    stored = SegmentTable(spark, PAIRS, str(tmp_path))
    stored.upsert(pairs(spark, [("a", 1.0), ("a", 3.0), ("a", 2.0), ("b", None)]))
    assert content(stored.read().fillna(-1.0)) == [("a", 3.0), ("b", -1.0)]


def test_a_write_rewrites_nothing_and_a_merge_only_what_overlaps(spark, tmp_path, small_files):
    stored = SegmentTable(spark, PAIRS, str(tmp_path))
    before = files_of(stored.upsert(numbered(spark, 0, 10_000, 1)))
    assert len(before) >= 100
    after = files_of(stored.upsert(numbered(spark, 5_000, 5_100, 2)))  # one in a hundred keys
    assert before <= after
    merged = files_of(stored.compact(everything=True))
    assert len(before - merged) < 0.1 * len(before) and before - merged
    assert stored.read().count() == 10_000 and stored.read().where("v = 2").count() == 100
    assert stored.read().select("k").distinct().count() == 10_000


def test_scattered_keys_cost_no_rewrite_until_a_merge_is_due(spark, tmp_path, small_files):
    stored = SegmentTable(spark, PAIRS, str(tmp_path), fan=4)
    base = files_of(stored.upsert(numbered(spark, 0, 10_000, 1)))
    for value in (2, 3, 4, 5):
        stored.upsert(numbered(spark, 0, 10_000, value).where("CAST(k AS INT) % 100 = 7"))
    assert base <= files_of(stored.manifest())  # four small segments were merged with each other, not with the base
    assert [s.rows for s in stored.manifest().segments] == [10_000, 100]
    assert stored.read().where("v = 5").count() == 100 and stored.read().count() == 10_000


def test_readers_see_one_version(spark, tmp_path):
    stored = SegmentTable(spark, PAIRS, str(tmp_path))
    stored.upsert(pairs(spark, [("a", 1.0)]))
    old = stored.read()
    stored.upsert(pairs(spark, [("a", 2.0), ("b", 1.0)]))
    stored.compact(everything=True)
    assert content(old) == content(stored.read(1)) == [("a", 1.0)]
    assert content(stored.read()) == [("a", 2.0), ("b", 1.0)] and stored.versions() == [1, 2, 3]


def test_a_write_that_fails_leaves_the_table(spark, tmp_path, monkeypatch):
    stored = SegmentTable(spark, PAIRS, str(tmp_path))
    stored.upsert(pairs(spark, [("a", 1.0)]))
    with monkeypatch.context() as patch:
        patch.setattr(SegmentTable, "_commit", lambda self, manifest: (_ for _ in ()).throw(OSError("store is down")))
        with pytest.raises(OSError):
            stored.upsert(pairs(spark, [("a", 2.0)]))
    assert content(stored.read()) == [("a", 1.0)]
    stored.upsert(pairs(spark, [("a", 2.0)]))
    assert content(stored.read()) == [("a", 2.0)]


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    one, two = (SegmentTable(spark, PAIRS, str(tmp_path)) for _ in range(2))
    one.upsert(pairs(spark, [("a", 1.0)]))
    seen = two.manifest()
    one.upsert(pairs(spark, [("b", 1.0)]))
    monkeypatch.setattr(two, "manifest", lambda version=None: seen)
    with pytest.raises(ConcurrentWrite):
        two.upsert(pairs(spark, [("c", 1.0)]))
    assert content(one.read()) == [("a", 1.0), ("b", 1.0)]


def test_vacuum_removes_what_no_kept_version_needs(spark, tmp_path):
    stored = SegmentTable(spark, PAIRS, str(tmp_path))
    for value in (1.0, 2.0, 3.0):
        stored.upsert(pairs(spark, [("a", value), ("b", value)]))
    stored.compact(everything=True)
    gone = stored.vacuum()
    assert gone == 3 and stored.versions() == [4] and content(stored.read()) == [("a", 3.0), ("b", 3.0)]
    left = [f for _, _, names in os.walk(f"{tmp_path}/pairs/data") for f in names if f.endswith(".parquet")]
    assert len(left) == len(files_of(stored.manifest()))


def test_rows_without_key_are_one_only_if_equal(spark, tmp_path):
    stored = SegmentTable(spark, PAIRS, str(tmp_path))
    for _ in range(2):
        stored.upsert(pairs(spark, [(None, 1.0), (None, 1.0), (None, 2.0), ("a", 1.0)]))
    assert content(stored.read()) == [("", 1.0), ("", 2.0), ("a", 1.0)]


def test_keys_with_time_lie_apart_by_day(spark, tmp_path):
    stored = SegmentTable(spark, FRAUD_TRANSACTION, str(tmp_path))
    stored.upsert(history(spark, ("9", "2020-01-01 10:00:00", "a", 1.0), ("1", "2020-01-01 11:00:00", "b", 2.0)))
    stored.upsert(history(spark, ("1", "2020-01-02 10:00:00", "c", 3.0), ("9", "2020-01-02 10:00:00", "d", 3.0)))
    plan = stored.read()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and stored.read().count() == 4  # the days' files need no comparison
    stored.upsert(history(spark, ("1", "2020-01-02 10:00:00", "e", 9.0)))
    assert sorted(r.trans_num for r in stored.read().collect()) == ["a", "b", "d", "e"]


def test_empty_writes_and_tables(spark, tmp_path):
    stored = SegmentTable(spark, PAIRS, str(tmp_path))
    assert stored.read().count() == 0 and stored.versions() == [] and stored.compact(everything=True) == Manifest()
    stored.upsert(pairs(spark, []))
    assert stored.read().count() == 0 and stored.versions() == []


def test_ranges_against_all_pairs():
    rnd = random.Random(1)
    for _ in range(300):
        spans = [sorted((rnd.randrange(40), rnd.randrange(40))) for _ in range(rnd.randint(0, 12))]
        files = [DataFile(str(i), 1, ((True, a),), ((True, b),)) for i, (a, b) in enumerate(spans)]
        some, others = files[: len(files) // 2], files[len(files) // 2 :]
        meets = {f.path for f in some if any(f.low <= o.high and o.low <= f.high for o in others)}
        mixed, clear = overlapping(some, others)
        assert {f.path for f in mixed} == meets and len(mixed) + len(clear) == len(some)


def test_manifest_text_round_trip():
    manifest = Manifest(3, (Segment((DataFile("data/x", 2, ((False, ""), (True, 5)), ((True, "é"), (True, 7))),)),))
    assert Manifest.parse(manifest.text()) == manifest


def test_a_write_and_a_merge_shuffle_rows_once(spark, tmp_path, monkeypatch):
    """Copies of a key meet in the shuffle that makes the ranges; none is sorted or moved a second time."""
    stored, plans, write = SegmentTable(spark, PAIRS, str(tmp_path)), [], segments.latest_in_ranges

    def noted(*args):
        made = write(*args)
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        return made

    monkeypatch.setattr(segments, "latest_in_ranges", noted)
    first = numbered(spark, 0, 1_000, 1).unionByName(numbered(spark, 500, 700, 2))
    stored.upsert(snapshot(first).where("k IS NOT NULL"))
    stored.upsert(numbered(spark, 600, 1_200, 3))
    stored.compact(everything=True)
    assert len(plans) == 3 and all(p.count("Exchange ") == 1 and p.count("Sort [") == 1 and "Join" not in p for p in plans)
    values = {int(r.k): r.v for r in stored.read().collect()}
    assert values == {i: 3.0 if i >= 600 else 2.0 if i >= 500 else 1.0 for i in range(1_200)}


def test_a_read_compares_keys_alone(spark, tmp_path):
    stored = SegmentTable(spark, PAIRS, str(tmp_path))
    stored.upsert(numbered(spark, 0, 100, 1))
    stored.upsert(numbered(spark, 50, 150, 2))
    rows = stored.read().select("k")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "ReadSchema: struct<k:string,v:double>" not in plan
    assert rows.distinct().count() == rows.count() == 150


def test_segments_are_written_small(spark, tmp_path):
    stored = SegmentTable(spark, PAIRS, str(tmp_path))
    made = files_of(stored.upsert(numbered(spark, 0, 100, 1)))
    assert made and all(path.endswith(".zstd.parquet") for path in made) and stored.read().count() == 100


def test_a_large_merge_goes_range_by_range(spark, tmp_path, small_files, monkeypatch):
    """Every row of a key is in one range, those without key in the first; no write of the merge has all rows."""
    stored, sizes, write = SegmentTable(spark, PAIRS, str(tmp_path)), [], SegmentTable._write

    def noted(table, rows, newest):
        sizes.append(rows.count())
        return write(table, rows, newest)

    stored.upsert(numbered(spark, 0, 1_000, 1).unionByName(pairs(spark, [(None, 5.0), (None, 6.0)])), compact=False)
    stored.upsert(numbered(spark, 400, 1_400, 2).unionByName(pairs(spark, [(None, 5.0)])), compact=False)
    before = content(stored.read())
    monkeypatch.setattr(segments, "MERGE_ROWS", 300)
    monkeypatch.setattr(SegmentTable, "_write", noted)
    files = stored.compact(everything=True).segments[0].files
    assert len(sizes) > 3 and sum(sizes) <= 2_003 and max(sizes) < 900
    assert content(stored.read()) == before and len(before) == 1_402
    assert all(a.high < b.low for a, b in zip(files, files[1:]))


def test_a_large_merge_of_keys_with_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "MERGE_ROWS", 1)
    stored = SegmentTable(spark, FRAUD_TRANSACTION, str(tmp_path))
    days = [("1", f"2020-01-0{d} 10:00:00", "a", 1.0) for d in range(1, 6)] + [("2", None, "c", 1.0)]
    for amount in (1.0, 2.0, 3.0):
        stored.upsert(history(spark, *[(c, t, n, amount) for c, t, n, _ in days[int(amount) - 1 :]]), compact=False)
    stored.compact(everything=True)
    found = sorted((str(r.trans_time), r.amt) for r in stored.read().collect())
    assert found == sorted([*[(f"2020-01-0{d} 10:00:00", min(d, 3.0)) for d in range(1, 6)], *[("None", a) for a in (1.0, 2.0, 3.0)]])


def test_ranges_of_a_merge(monkeypatch):
    """Each has a file that begins in it, also where many files begin with one key."""
    monkeypatch.setattr(segments, "MERGE_ROWS", 10)
    made = lambda *lows: [DataFile(str(i), 6, ((True, low),), ((True, "z"),)) for i, low in enumerate(lows)]
    assert segments._passes([]) == [] and segments._passes(made("a", "a", "a", "a")) == [(None, None)]
    assert segments._passes(made("a", "a", "a", "b", "b", "b", "c")) == [(None, "b"), ("b", "c"), ("c", None)]
