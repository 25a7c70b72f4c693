"""All jobs in order, in one application.

Each stage writes its table and the next one reads it back, so lineage is cut on
storage that every node reaches and a lost executor costs at most one stage's work.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import (
    AT_RISK_DAYS,
    CONTRACTS,
    DATE_DIM,
    DORMANT_DAYS,
    LOGGED,
    LOOKBACK_MONTHS,
    ORDER_ITEM_OPTIONS,
    ORDER_ITEMS,
    OUTLIER_REVENUE,
    PERIOD_DAYS,
    Layout,
    TableContract,
)
from ..functions import day_of, month_of
from ..operators import net_rows
from ..session import durable
from ..sources import (
    BUCKET,
    Staging,
    base_date,
    in_buckets,
    is_bucketed,
    logged_dates,
    names,
    new_bucket,
    pending_pairs,
    place,
    pointer,
    read_buckets,
    read_history,
    read_log,
    read_snapshot,
    read_table,
    replace_keys,
    resolve_pair,
    round_rows,
    rounds,
    rows_of,
    sizes,
    snapshot_dates,
    table_exists,
    with_bucket,
    write_base,
    write_buckets,
    write_log,
    write_table,
)
from ..streaming.late_orders import refresh_daily_value
from . import calendar as cal
from . import commerce, customers
from .change_capture import capture_changes
from .current_state import as_inserts, at_most_once, collapse, collapse_onto
from .revenue import known_customers, line_item_facts, order_facts, regular

LINES, ORDERS = "order_line_items", "orders"
#: Parts in which a large step is logged, at most: each reads both snapshots, and shuffles its share of them.
LOG_PARTS = 4
MARTS = (
    "customer_clv_daily", "clv_trends", "sales_daily", "customer_rfm", "customer_clv_tiers", "churn_indicators",
    "loyalty_impact", "location_performance", "discount_effectiveness",
)


def log_snapshot(
    spark: SparkSession, layout: Layout, contract: TableContract, current: str, previous: str | None
) -> dict[str, int]:
    now = read_snapshot(spark, layout, current, contract.name)
    before = read_snapshot(spark, layout, previous, contract.name) if previous else None
    # the first snapshot is compared with nothing, so its rows are not shuffled
    parts = min(LOG_PARTS, -(-(now.count() + before.count()) // round_rows(spark)) or 1) if previous else 1
    changes, *more = (capture_changes(now, before, contract, current, part=(i, parts)) for i in range(parts))
    return write_log(changes, layout, contract.name, current, more)


def log_pending(spark: SparkSession, layout: Layout, tables=tuple(LOGGED)) -> dict[str, dict[str, dict[str, int]]]:
    """Log every snapshot after the last logged one, step by step."""
    available = snapshot_dates(spark, layout)

    def log_table(table: str) -> dict[str, dict[str, int]]:
        pairs = pending_pairs(available, logged_dates(spark, layout, table))
        return {current: log_snapshot(spark, layout, LOGGED[table], current, previous) for current, previous in pairs}

    return dict(zip(tables, _side_by_side(log_table, tables)))


def log_pair(
    spark: SparkSession, layout: Layout, current: str | None = None, previous: str | None = None, tables=tuple(LOGGED)
) -> dict[str, dict[str, int]]:
    """Log one chosen pair of snapshots (default: the last two)."""
    _open_run(spark, layout)
    current, previous = resolve_pair(snapshot_dates(spark, layout), current, previous)
    return {t: log_snapshot(spark, layout, CONTRACTS[t], current, previous) for t in tables if t in LOGGED}


def refresh_current(
    spark: SparkSession, layout: Layout, tables=tuple(LOGGED), after: str | None = None
) -> dict[str, int | None]:
    """Row counts of the current tables, None for one that had no change.

    Collapses the whole log, or with ``after`` only the batches later than that onto the
    buckets they touch.
    """
    _open_run(spark, layout)
    chosen = [t for t in tables if t in LOGGED]
    return dict(zip(chosen, _side_by_side(lambda t: _refresh_table(spark, layout, LOGGED[t], after), chosen)))


def compact_log(spark: SparkSession, layout: Layout, tables=tuple(LOGGED)) -> dict[str, int]:
    """Sum up all finished batches of each log in a base, so that a whole collapse reads it and later batches. Returns row counts."""

    def compact(table: str) -> int:
        last = logged_dates(spark, layout, table)[-1]
        if base_date(spark, layout, table) == last:
            return read_history(spark, layout, table).count()
        return write_base(as_inserts(read_history(spark, layout, table), LOGGED[table]), layout, table, last)

    chosen = [t for t in tables if t in LOGGED]
    return dict(zip(chosen, _side_by_side(compact, chosen)))


def _side_by_side(job: Callable, items: Iterable, at_once: int = 4) -> list:
    """Results of ``job`` for each item; submitted together, so that small jobs do not leave executors idle."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(job, items))


def _refresh_table(spark: SparkSession, layout: Layout, contract: TableContract, after: str | None) -> int | None:
    location, together = layout.current(contract.name), list(contract.together)
    if not is_bucketed(spark, location):
        after = None
    log = read_history(spark, layout, contract.name) if after is None else read_log(spark, layout, contract.name, after=after)
    size = log.count()  # from the files' footers
    if after is not None and not size:
        return None
    fresh = new_bucket(logged_dates(spark, layout, contract.name)[-1], together, size, layout.bucket_rows)
    once = at_most_once(log, contract)  # looks at the keys alone; where it holds, whole rows are not shuffled to find the newest
    if after is None:
        return write_buckets(collapse(log, contract, once).withColumn(BUCKET, fresh), location).rows
    with Staging(spark) as stage:
        now = pointer(spark, location)
        placed = stage(place(read_buckets(spark, location, at=now), log.select(*together).distinct(), fresh))
        touched, batch = names(placed), with_bucket(log, placed)
        held = {b: now.buckets[b][1] for b in touched if b in now.buckets}
        groups = [touched]
        if size + sum(held.values()) > round_rows(spark):
            batch = stage(batch, by=BUCKET)
            new = sizes(batch)
            groups = rounds(spark, {b: new.get(b, 0) + held.get(b, 0) for b in touched})

        def state(group: list[str]) -> DataFrame:
            changes = batch if len(groups) == 1 else in_buckets(batch, group)
            if not held.keys() & set(group):  # none of these orders was there before
                return collapse(changes, contract, once)
            return collapse_onto(read_buckets(spark, location, group, now), changes, contract, once)

        parts = map(state, groups)
        return write_buckets(next(parts), location, touched, parts).rows


def refresh_calendar(spark: SparkSession, layout: Layout, start: str | None = None, end: str | None = None) -> int:
    """Whole years around the orders of the latest snapshot, with that snapshot's holidays."""
    latest, _ = resolve_pair(snapshot_dates(spark, layout))
    holidays = cal.typed_holidays(read_snapshot(spark, layout, latest, DATE_DIM.name))
    items = read_snapshot(spark, layout, latest, ORDER_ITEMS.name)
    first, last = cal.whole_years(cal.date_bounds(items, "creation_time_utc"), start, end)
    return write_table(cal.date_dim(cal.days(spark, first, last), holidays), layout.current(DATE_DIM.name))


def refresh_facts(spark: SparkSession, layout: Layout, outlier_threshold: float = OUTLIER_REVENUE) -> dict[str, int]:
    """All facts anew, in the buckets of the current order items."""
    _open_run(spark, layout)
    items = _in_buckets(spark, layout.current(ORDER_ITEMS.name))
    options = read_table(spark, layout.current(ORDER_ITEM_OPTIONS.name))
    made = line_item_facts(items, options, outlier_threshold)
    with Staging(spark) as stage:
        # beyond a round the shuffles of the join are freed before the rows are dealt by bucket
        if items.count() > round_rows(spark):
            made = stage(made)
        lines = write_buckets(made, layout.fact(LINES))
    facts = order_facts(read_buckets(spark, layout.fact(LINES)), outlier_threshold, [BUCKET])
    return {LINES: lines.rows, ORDERS: write_buckets(facts, layout.fact(ORDERS)).rows}


def _in_buckets(spark: SparkSession, location: str) -> DataFrame:
    """A table with its BUCKET; one that was written as plain files is a single bucket."""
    if is_bucketed(spark, location):
        return read_buckets(spark, location)
    return read_table(spark, location).withColumn(BUCKET, F.lit("all"))


@dataclass(frozen=True)
class Touched:
    """What a batch changed: the first day of its orders and the months (yyyy-MM) of their lines, before or after it."""

    first_day: date | None = None
    months: frozenset[str] = frozenset()


def update_facts(
    spark: SparkSession, layout: Layout, after: str, outlier_threshold: float = OUTLIER_REVENUE
) -> tuple[dict[str, int], Touched | None]:
    """Facts of the orders that log batches later than ``after`` changed; all others keep their rows, buckets without any keep their files.

    Returns row counts and what changed (None, with all facts made anew, where a table is not in buckets yet).
    """
    items_at, options_at = layout.current(ORDER_ITEMS.name), layout.current(ORDER_ITEM_OPTIONS.name)
    lines_at, orders_at = layout.fact(LINES), layout.fact(ORDERS)
    if not all(is_bucketed(spark, at) for at in (items_at, options_at, lines_at, orders_at)):
        return refresh_facts(spark, layout, outlier_threshold), None
    _open_run(spark, layout)
    with Staging(spark) as stage:
        changed = stage(_changed_orders(spark, layout, after))
        if changed.isEmpty():
            return {LINES: pointer(spark, lines_at).rows, ORDERS: pointer(spark, orders_at).rows}, Touched()
        # of the old facts a single column is looked at
        wanted = ((items_at, stage), (options_at, stage), (lines_at, None), (orders_at, None))
        items, options, old_lines, old_orders = _side_by_side(lambda job: rows_of(spark, job[0], changed, job[1]), wanted)
        lines = stage(line_item_facts(items, options.drop(BUCKET), outlier_threshold), by=BUCKET)
        orders = stage(order_facts(lines, outlier_threshold, [BUCKET]), by=BUCKET)
        days = old_orders.select("order_date").unionAll(orders.select("order_date"))
        moments = old_lines.select("creation_time_utc").unionAll(lines.select("creation_time_utc"))
        touched = Touched(days.agg(F.min("order_date")).first()[0], _months(moments.select(month_of(day_of("creation_time_utc")))))
        written = _side_by_side(lambda job: replace_keys(*job, changed), ((lines, lines_at), (orders, orders_at)))
        return {LINES: written[0].rows, ORDERS: written[1].rows}, touched


def _months(months: DataFrame) -> frozenset[str]:
    return frozenset(r[0] for r in months.distinct().collect())


def _changed_orders(spark: SparkSession, layout: Layout, after: str) -> DataFrame:
    logs = (read_log(spark, layout, t, after=after).select("order_id") for t in LOGGED)
    return reduce(DataFrame.unionAll, logs).distinct()


def refresh_marts(
    spark: SparkSession,
    layout: Layout,
    as_of: date | None = None,
    batch_min: date | None = None,
    lookback_months: int = LOOKBACK_MONTHS,
    at_risk_days: int = AT_RISK_DAYS,
    dormant_days: int = DORMANT_DAYS,
    period_days: int = PERIOD_DAYS,
    side_by_side: int = 4,
    months: Collection[str] | None = None,
    marts: Collection[str] | None = None,
) -> dict[str, int]:
    """All nine marts, or the chosen ``marts``.

    Without ``batch_min`` the daily value and its trends are rebuilt whole, without ``months`` (those with changed lines or
    calendar days) the daily sales. Trends without the daily value come whole from the orders.
    """
    unknown = set(marts or ()) - set(MARTS)
    if unknown:
        raise ValueError(f"no such marts: {sorted(unknown)}")
    chosen = set(MARTS if marts is None else marts)
    orders = read_table(spark, layout.fact(ORDERS))
    lines = read_table(spark, layout.fact(LINES))
    calendar = read_table(spark, layout.current(DATE_DIM.name))
    named = known_customers(orders)
    dated = named.select("user_id", "order_revenue", "order_date")
    end = as_of or dated.agg(F.max("order_date")).first()[0]
    daily = layout.mart("customer_clv_daily")

    def value() -> dict[str, int]:
        trends_at, since = layout.mart("clv_trends"), None
        if "customer_clv_daily" not in chosen:
            floor = dated.agg(F.min("order_date")).first()[0] or end
            cal.require_every_day(calendar, floor, end)
            return {"clv_trends": _write_trends(customers.trends_from_spans(customers.value_spans(dated, floor, end)), trends_at)}
        with Staging(spark) as stage:
            refreshed = refresh_daily_value(spark, daily, dated, calendar, batch_min, end, stage)
            done = {"customer_clv_daily": refreshed["rows"]}
            if "clv_trends" not in chosen:
                return done
            trends = customers.trends_from_spans(refreshed["spans"])
            if not refreshed["whole"]:
                if is_bucketed(spark, trends_at):
                    since = f"{refreshed['floor']:%Y-%m}"
                else:
                    trends = customers.value_trends(read_table(spark, daily))
            return done | {"clv_trends": _write_trends(trends, trends_at, since)}

    def single(name: str, mart: Callable[[], DataFrame]) -> tuple[tuple[str, ...], Callable[[], dict[str, int]]]:
        return (name,), lambda: {name: write_table(mart(), layout.mart(name))}

    # all need only the facts
    jobs = [
        (("customer_clv_daily", "clv_trends"), value),
        (("sales_daily",), lambda: {"sales_daily": _refresh_sales(spark, lines, calendar, layout.mart("sales_daily"), months)}),
        single("customer_rfm", lambda: customers.recency_frequency_monetary(dated, end, lookback_months)),
        single("customer_clv_tiers", lambda: customers.value_tiers(named)),
        single("churn_indicators", lambda: customers.churn_indicators(dated, end, at_risk_days, dormant_days, period_days)),
        single("loyalty_impact", lambda: customers.loyalty_impact(named)),
        single("location_performance", lambda: commerce.location_performance(regular(orders))),
        single("discount_effectiveness", lambda: commerce.discount_effectiveness(regular(orders))),
    ]
    asked = [job for made, job in jobs if chosen.intersection(made)]
    return reduce(dict.__or__, _side_by_side(lambda job: job(), asked, side_by_side), {})


def _refresh_sales(spark: SparkSession, lines: DataFrame, calendar: DataFrame, location: str, months: Collection[str] | None) -> int:
    """Daily sales with a bucket for each month, of ``months`` only if given."""
    now = pointer(spark, location)
    sold = regular(lines)
    if months is not None and now:
        if not months:
            return now.rows
        sold = sold.filter(month_of(day_of("creation_time_utc")).isin(*months))
    sales = commerce.sales_daily(sold, calendar)
    return write_buckets(sales.withColumn(BUCKET, month_of("order_date")), location, months if now else None).rows


def _write_trends(trends: DataFrame, location: str, since: str | None = None) -> int:
    """Daily totals with a bucket for each month; ``trends`` are all, or those from ``since`` (yyyy-MM) on if given."""
    replaced = None if since is None else [month for month in pointer(trends.sparkSession, location).buckets if month >= since]
    return write_buckets(trends.withColumn(BUCKET, month_of("clv_date")), location, replaced).rows


def run_pipeline(
    spark: SparkSession,
    layout: Layout,
    as_of: date | None = None,
    full: bool = False,
    outlier_threshold: float = OUTLIER_REVENUE,
    calendar_start: str | None = None,
    calendar_end: str | None = None,
    marts: Collection[str] | None = None,
    **thresholds: int,
) -> dict:
    """Snapshots to marts: all, or the chosen ``marts``. A run with other marts than the last one rebuilds everything.

    After a finished run the current tables take in only the new log batches, facts only the orders in
    them, and the marts kept by month only the months they touch. ``full``, the first run, and a run
    after one that broke off start from the whole log: a broken one may have replaced the
    facts which say where the deleted orders were.
    """
    only = {} if marts is None else {"marts": sorted(marts)}
    parameters = repr(sorted({**thresholds, **only, "outlier_threshold": outlier_threshold}.items()))
    report: dict = {"log": log_pending(spark, layout)}
    done = None if full else _finished_through(spark, layout, parameters)
    if done and any(dt <= done for batches in report["log"].values() for dt in batches):
        done = None  # a step that the tables already hold was logged anew
    calendar_at = layout.current(DATE_DIM.name)
    known_days = durable(read_table(spark, calendar_at)) if done else None
    report["current"] = refresh_current(spark, layout, after=done)
    report["date_dim"] = refresh_calendar(spark, layout, calendar_start, calendar_end)
    batch_min = months = None
    if done is None:
        report["facts"] = refresh_facts(spark, layout, outlier_threshold)
    else:
        report["facts"], touched = update_facts(spark, layout, done, outlier_threshold)
        if touched:
            # with no change at all the mart only has to reach the new as_of
            batch_min = touched.first_day or date.max
            days = net_rows([(read_table(spark, calendar_at), F.lit(1)), (known_days, F.lit(-1))], known_days.columns)
            months = touched.months | _months(days.select(month_of("date_key")))
    report["marts"] = refresh_marts(spark, layout, as_of, batch_min, months=months, marts=marts, **thresholds)
    _record(spark, layout, logged_dates(spark, layout, ORDER_ITEMS.name)[-1], True, parameters)
    return report


def _finished_through(spark: SparkSession, layout: Layout, parameters: str | None = None) -> str | None:
    """Last log batch the marts contain, or None if a run is open, there was none, or it had other ``parameters``."""
    if not table_exists(spark, f"{layout.progress}/_SUCCESS"):
        return None
    last = read_table(spark, layout.progress).first()
    same = parameters is None or last.asDict().get("parameters") == parameters
    return last["through"] if last["finished"] and same else None


def _open_run(spark: SparkSession, layout: Layout) -> None:
    """Note that log, tables or facts are about to change apart from the marts.

    Every job that changes them says so, also when called alone: until a whole run has
    finished again, nobody can tell from the facts which days the marts are missing.
    """
    if _finished_through(spark, layout) is not None:
        _record(spark, layout, "", False, "")


def _record(spark: SparkSession, layout: Layout, through: str, finished: bool, parameters: str) -> None:
    values = {"through": through, "finished": finished, "parameters": parameters}
    row = spark.range(1).select(*(F.lit(v).alias(n) for n, v in values.items()))
    row.write.mode("overwrite").parquet(layout.progress)
