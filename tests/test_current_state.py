"""Collapse of keyed and multiset logs, whole and incremental, and the replication feed."""

from helpers import rows

from orderlake.contract import ORDER_ITEM_OPTIONS, ORDER_ITEMS
from orderlake.plans.current_state import at_most_once, collapse, collapse_keyed, collapse_onto
from orderlake.streaming import adapt_change_feed

HEADERS = "Op string, cdc_seq string, cdc_commit_ts string, cdc_snapshot_dt string, cdc_processed_at string"


def keyed(spark, *data):
    return spark.createDataFrame(
        [(o, l, p, op, f"{seq:035d}", "t", "d", "n") for o, l, p, op, seq in data],
        f"order_id string, lineitem_id string, item_price double, {HEADERS}",
    )


def bag(spark, *data):
    return spark.createDataFrame([(o, "1", n, op, "0", "t", "d", "n") for o, n, op in data],
                                 f"order_id string, lineitem_id string, option_name string, {HEADERS}")


def test_latest_change_wins(spark):
    log = keyed(spark, ("a", "1", 1.0, "I", 1), ("a", "1", 2.0, "U", 2), ("a", "1", 3.0, "U", 3), ("b", "1", 9.0, "I", 1))
    assert rows(collapse(log, ORDER_ITEMS)) == [("a", "1", 3.0), ("b", "1", 9.0)]


def test_deleted_rows_disappear_and_may_return(spark):
    log = keyed(spark, ("a", "1", 1.0, "I", 1), ("a", "1", 1.0, "D", 2),
                ("b", "1", 1.0, "I", 1), ("b", "1", 1.0, "D", 2), ("b", "1", 5.0, "I", 3))
    assert rows(collapse(log, ORDER_ITEMS)) == [("b", "1", 5.0)]


def test_null_keys_and_unknown_ops(spark):
    log = keyed(spark, (None, "1", 1.0, "I", 1), (None, "1", 2.0, "U", 2), ("z", "1", 1.0, None, 1))
    assert rows(collapse_keyed(log, ["order_id", "lineitem_id"])) == [(None, "1", 2.0)]


def test_ties_on_sequence_are_settled_by_values(spark):
    data = [("a", "1", float(p), "U", 1) for p in range(20)]
    for arrangement in (data, data[::-1]):
        assert rows(collapse(keyed(spark, *arrangement).repartition(3), ORDER_ITEMS)) == [("a", "1", 19.0)]


def test_multiset_net_count(spark):
    log = bag(spark, ("a", "x", "I"), ("a", "x", "I"), ("a", "x", "D"), ("a", None, "I"), ("a", None, "I"), ("b", "y", "I"), ("b", "y", "D"))
    out = collapse(log, ORDER_ITEM_OPTIONS)
    assert rows(out) == rows(spark.createDataFrame([("a", "1", "x"), ("a", "1", None), ("a", "1", None)], "o string, l string, n string"))


def test_dt_column_of_the_stored_log_is_not_source_data(spark):
    from pyspark.sql import functions as F
    log = keyed(spark, ("a", "1", 1.0, "I", 1)).withColumn("dt", F.lit("2026-01-01"))
    assert collapse(log, ORDER_ITEMS).columns == ["order_id", "lineitem_id", "item_price"]


def test_incremental_collapse_equals_whole(spark):
    old = keyed(spark, ("a", "1", 1.0, "I", 1), ("b", "1", 2.0, "I", 1), ("c", "1", 3.0, "I", 1), (None, "1", 3.0, "I", 1), (None, None, 3.0, "I", 1))
    new = keyed(spark, ("a", "1", 1.5, "U", 2), ("b", "1", 2.0, "D", 2), ("d", "1", 4.0, "I", 2), (None, "1", None, "U", 2), (None, None, 3.0, "D", 2))
    whole = collapse(old.unionAll(new), ORDER_ITEMS)
    assert rows(collapse_onto(collapse(old, ORDER_ITEMS), new, ORDER_ITEMS)) == rows(whole)

    old = bag(spark, *[("a", "x", "I")] * 3, *[("a", None, "I")] * 2, ("c", "z", "I"), ("c", "z", "I"))
    new = bag(spark, ("a", "x", "D"), ("b", "y", "I"), ("a", None, "D"), ("a", None, "D"), (None, None, "I"), ("b", "w", "I"), ("b", "w", "D"))
    whole = collapse(old.unionAll(new), ORDER_ITEM_OPTIONS)
    assert rows(collapse_onto(collapse(old, ORDER_ITEM_OPTIONS), new, ORDER_ITEM_OPTIONS)) == rows(whole)


def test_feed_headers_map_to_log_headers(spark):
    feed = spark.createDataFrame(
        [("a", "1", 1.0, "I", "001", "t1"), ("a", "1", 2.0, "U", "002", "t2"), ("a", "1", 3.0, "U", "003", "t3"), ("b", "1", 3.0, "D", "004", "t3")],
        "ORDER_ID string, LINEITEM_ID string, ITEM_PRICE double, AR_H_OPERATION string, AR_H_CHANGE_SEQ string, AR_H_COMMIT_TIMESTAMP string",
    )
    log = adapt_change_feed(feed)
    assert log.columns == ["order_id", "lineitem_id", "item_price", "Op", "cdc_seq", "cdc_commit_ts"]
    assert rows(collapse(log, ORDER_ITEMS)) == [("a", "1", 3.0)]


def test_feed_adapter_takes_a_stream(spark, tmp_path):
    feed = spark.createDataFrame([("a", "1", 1.0, "I", "001", "t1"), ("a", "1", 2.0, "U", "002", "t2")],
                                 "ORDER_ID string, LINEITEM_ID string, ITEM_PRICE double, AR_H_OPERATION string, AR_H_CHANGE_SEQ string, AR_H_COMMIT_TIMESTAMP string")
    feed.write.parquet(f"{tmp_path}/feed")
    stream = adapt_change_feed(spark.readStream.schema(feed.schema).parquet(f"{tmp_path}/feed"))
    assert stream.isStreaming
    run = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").format("parquet").start(f"{tmp_path}/log")
    run.awaitTermination(60)
    assert rows(collapse(spark.read.parquet(f"{tmp_path}/log"), ORDER_ITEMS)) == [("a", "1", 2.0)]


def test_a_log_of_single_changes_needs_no_shuffle(spark):
    old = keyed(spark, ("a", "1", 1.0, "I", 1), ("b", "1", 2.0, "I", 1), (None, "1", 3.0, "I", 1), ("z", "1", 3.0, "D", 1))
    new = keyed(spark, ("a", "1", 1.5, "U", 2), ("b", "1", 2.0, "D", 2), ("d", "1", 4.0, "I", 2), (None, "1", None, "U", 2))
    assert at_most_once(old, ORDER_ITEMS) and at_most_once(new, ORDER_ITEMS) and not at_most_once(old.unionAll(new), ORDER_ITEMS)
    known = collapse(old, ORDER_ITEMS, once=True)
    assert "Exchange" not in known._jdf.queryExecution().executedPlan().toString()
    assert rows(known) == rows(collapse(old, ORDER_ITEMS))
    assert rows(collapse_onto(known, new, ORDER_ITEMS, once=True)) == rows(collapse(old.unionAll(new), ORDER_ITEMS))

    first = bag(spark, ("a", "x", "I"), ("a", "x", "I"), ("a", None, "I"))
    assert at_most_once(first, ORDER_ITEM_OPTIONS) and rows(collapse(first, ORDER_ITEM_OPTIONS, once=True)) == rows(collapse(first, ORDER_ITEM_OPTIONS))
    for other in ("D", None):
        assert not at_most_once(first.unionAll(bag(spark, ("a", "x", other))), ORDER_ITEM_OPTIONS)
