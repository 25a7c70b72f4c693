"""What a run puts on the disk besides its tables: what it leaves, and large writes in rounds."""

import re
import time
from datetime import date, timedelta
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_buckets import table
from test_pipeline import contents, land

from orderlake.contract import ORDER_ITEMS, Layout, TableContract
from orderlake.plans import pipeline
from orderlake.plans.change_capture import capture_changes
from orderlake.session import apply_settings, shared_directory
from orderlake.sources import (
    Staging, buckets, logged_dates, pointer, read_log, read_table, replace_keys, rounds, rows_of, write_buckets, write_log,
)


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(p) for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*")}


def gone(paths, seconds=20):
    """Whether files go soon; Spark deletes them beside other work."""
    until = time.time() + seconds
    while any(map(Path.exists, map(Path, paths))) and time.time() < until:
        time.sleep(0.2)
    return not any(map(Path.exists, map(Path, paths)))


def test_shuffle_files_go_when_their_plan_has_ended(spark, tmp_path):
    apply_settings(spark)
    before = shuffle_files(spark)
    rolled = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    rolled.write.parquet(str(tmp_path / "t"))  # `rolled` is still referred to, so no garbage collection would free them
    assert gone(shuffle_files(spark) - before)
    assert rolled.count() == 7 and sum(r["n"] for r in rolled.collect()) == sum(r["n"] for r in rolled.collect()) == 499500


def test_tables_are_stored_in_the_denser_format(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    assert all(".zstd." in p.name for p in (tmp_path / "t").glob("*.parquet"))


def staged(spark):
    return [p.name for p in Path(shared_directory(spark).removeprefix("file:")).glob("staged-*")]


def test_staged_rows_go_with_their_block(spark):
    with Staging(spark) as stage:
        kept = stage(spark.range(3).selectExpr("id", "if(id = 1, null, 'x') as t"), [spark.sql("select 'y' as t, 9L as id")])
        assert rows(kept) == [(0, "x"), (1, None), (2, "x"), (9, "y")] and stage(spark.range(0)).isEmpty()
        assert len(staged(spark)) == 1
    with pytest.raises(ValueError), Staging(spark) as stage:
        stage(spark.range(1))
        raise ValueError
    assert not staged(spark)


def test_buckets_are_grouped_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(buckets, "round_rows", lambda spark: 10)
    assert rounds(spark, {}) == [[]]
    assert rounds(spark, {"a": 4, "c": 1, "b": 6, "d": 99, "e": 1}) == [["a", "b"], ["c"], ["d"], ["e"]]


def written_by(location, number):
    """The jobs that wrote a version of a table."""
    files = Path(location).glob(f"orderlake_version={number}/*/*.parquet")
    return {re.search(r"part-\d+-([0-9a-f-]{36})", p.name).group(1) for p in files}


def test_many_buckets_are_replaced_in_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "round_rows", lambda spark: 4)
    location = str(tmp_path / "t")
    data = [(None if i == 3 else f"k{i}", i, f"b{i % 5}") for i in range(15)]
    write_buckets(table(spark, *data), location)
    keys = spark.createDataFrame([(None,), ("k5",), ("k6",), ("k9",), ("new",)], "k string")
    with Staging(spark) as stage:
        assert rows(rows_of(spark, location, keys, stage)) == rows(rows_of(spark, location, keys))
    # k5 gets other rows, the NULL key keeps its bucket, k6 and k9 go, one comes into a bucket that is there and one into its own
    replace_keys(table(spark, ("k5", 50, "b0"), ("k5", 51, "b0"), (None, 30, "b3"), ("new", 1, "b2"), ("new", 2, "n")), location, keys)
    left = [(k, v) for k, v, _ in data if k not in (None, "k5", "k6", "k9")]
    assert rows(read_table(spark, location)) == sorted([*left, ("k5", 50), ("k5", 51), (None, 30), ("new", 1), ("new", 2)], key=repr)
    assert len(written_by(location, 2)) > 1


def test_a_write_that_breaks_off_between_rounds_changes_nothing(spark, tmp_path):
    location = str(tmp_path / "t")
    write_buckets(table(spark, ("a", 1, "x"), ("b", 2, "y")), location)

    def parts():
        yield table(spark, ("b", 3, "y"))
        raise OSError("broke off")

    with pytest.raises(OSError):
        write_buckets(table(spark, ("a", 9, "x")), location, ["x", "y"], parts())
    assert rows(read_table(spark, location)) == [("a", 1), ("b", 2)]
    assert write_buckets(table(spark, ("c", 5, "x")), location, ["x", "y"]).rows == 1
    assert rows(read_table(spark, location)) == [("c", 5)]


def test_a_log_batch_in_parts_is_finished_with_the_last_one(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    change = lambda k, op: spark.createDataFrame([(k, op)], "k string, Op string")
    broken = change("c", "I").withColumn("k", F.raise_error(F.lit("broke off")).cast("string"))
    with pytest.raises(Exception, match="broke off"):
        write_log(change("a", "I"), layout, "t", "2026-01-01", [change("b", "D"), broken])
    assert logged_dates(spark, layout, "t") == []
    assert write_log(change("a", "I"), layout, "t", "2026-01-01", [change("b", "D"), change("c", "I")]) == {"I": 2, "D": 1}
    assert rows(read_log(spark, layout, "t")) == [("a", "I"), ("b", "D"), ("c", "I")]


@pytest.mark.parametrize("contract", [TableContract("t", ("k", "n")), TableContract("t", together=("k",)), TableContract("t")])
def test_the_parts_of_a_step_are_the_step(spark, contract):
    """Keys of another type in the snapshot before, NULL keys and, without keys, copies."""
    now = [(None if i % 7 == 0 else i % 10, i, float(i)) for i in range(0, 40)]
    before = [(None if i % 7 == 0 else i % 10, i, -0.0 if i == 20 else float(i % 30)) for i in range(5, 45)]
    again = [] if contract.keys else [now[-1], now[-1], now[0]]
    a = spark.createDataFrame(now + again, "k int, n int, v double")
    b = spark.createDataFrame(before, "k bigint, n bigint, v double")
    whole = capture_changes(a, b, contract, "2026-01-02").drop("cdc_processed_at")
    parts = [capture_changes(a, b, contract, "2026-01-02", part=(i, 3)).drop("cdc_processed_at").collect() for i in range(3)]
    changes = [r for part in parts for r in part]
    assert all(parts) and len({r["cdc_seq"] for r in changes}) == len(changes)
    assert {len(r["cdc_seq"]) for r in changes} == {35}
    short = lambda found: sorted(((*r[:4], r["cdc_snapshot_dt"]) for r in found), key=repr)
    assert short(changes) == short(whole.collect())
    first = [r for i in range(3) for r in capture_changes(a, None, contract, "2026-01-02", part=(i, 3)).collect()]
    assert sorted(map(repr, (r[:4] for r in first))) == sorted(map(repr, (r[:4] for r in capture_changes(a, None, contract, "2026-01-02").collect())))


def test_runs_in_rounds_equal_runs_without(spark, tmp_path, monkeypatch):
    moved = lambda i: date(2023, 1, 3) + timedelta(days=i * 2 - (i == 45) * 40)
    found = []
    for name in ("rounds", "once"):
        layout = Layout(str(tmp_path / name), bucket_rows=8)
        if name == "rounds":
            monkeypatch.setattr(buckets, "ROUND_ROWS", 5)
        else:
            monkeypatch.undo()
        for dt, some in (("2023-05-01", {"keep": lambda i: i < 50}), ("2023-05-02", {"keep": lambda i: i not in (20, 41), "price": lambda i: 10.0 + i + i % 5, "when": moved})):
            land(spark, layout, dt, **some)
            report = pipeline.run_pipeline(spark, layout)
        tables = [layout.current("order_items"), layout.current("order_item_options"), layout.fact("order_line_items"), layout.fact("orders")]
        log = read_log(spark, layout, ORDER_ITEMS.name).drop("cdc_seq", "cdc_processed_at")
        found.append([report, [rows(read_table(spark, t)) for t in tables], contents(spark, layout), rows(log)])
        jobs = [len(written_by(t, pointer(spark, t).number)) for t in tables]
        assert all(n > 1 for n in jobs) if name == "rounds" else jobs == [1, 1, 1, 1]
        assert not staged(spark)
    assert found[0] == found[1]
