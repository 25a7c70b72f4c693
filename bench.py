"""Time the headline queries and the whole pipeline; print one JSON line.

Queries run on the given tables, whole. Marts read facts that were written to storage
once, as their jobs do; writing those facts is timed too. ``BENCH_SF_DIR`` and
``BENCH_CPUS`` choose data and threads.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from orderlake.contract import LOGGED, Layout  # noqa: E402
from orderlake.plans import calendar as cal  # noqa: E402
from orderlake.plans import commerce, customers, pipeline, reports  # noqa: E402
from orderlake.plans.revenue import known_customers, line_item_facts, order_facts, regular  # noqa: E402
from orderlake.session import build_session, shared_directory  # noqa: E402
from orderlake.sources import read_table, write_table  # noqa: E402
from orderlake.streaming import refresh_daily_value  # noqa: E402
from registry import star_schema as star  # noqa: E402
from registry.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WHOLE_QUERIES = (
    "row_hash", "cdc_baseline", "cdc_keyed_diff", "cdc_multiset_diff", "collapse_keyed", "collapse_multiset",
    "collapse_incremental", "adapt_change_feed", "date_dim", "clv_daily_full",
)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action, runs=2):
        """Best of ``runs``: the first one also compiles the generated code."""
        taken = []
        for _ in range(runs):
            started = time.perf_counter()
            result = action()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(min(taken), 3)
        return result

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    run(QUERIES["cdc_op_counts"](spark, SF_DIR))  # start-up is not part of any query
    for name in WHOLE_QUERIES:
        timed(name, lambda n=name: run(QUERIES[n](spark, SF_DIR)))

    # facts once, then every mart and its reports from storage
    lake = Layout(f"{shared_directory(spark)}/bench-{uuid.uuid4().hex}")
    lines, orders = lake.fact("order_line_items"), lake.fact("orders")
    items, options = lake.current("order_items"), lake.current("order_item_options")
    write_table(star.order_items(spark, SF_DIR), items)
    write_table(star.order_item_options(spark, SF_DIR), options)
    line_items = line_item_facts(read_table(spark, items), read_table(spark, options), star.LINE_OUTLIER)
    timed("line_item_facts", lambda: write_table(line_items, lines))
    timed("order_facts", lambda: write_table(order_facts(read_table(spark, lines), star.ORDER_OUTLIER), orders))
    facts = read_table(spark, orders)
    named, sold = known_customers(facts), regular(read_table(spark, lines))
    first, as_of = star.order_days(spark, SF_DIR)
    calendar = star.calendar(spark, SF_DIR)
    daily = lake.mart("customer_clv_daily")
    dated = named.select("user_id", "order_revenue", "order_date")
    late = dated.filter(F.col("order_date") < F.lit(date(as_of.year, 1, 1)))
    timed("clv_daily_backfill", lambda: refresh_daily_value(spark, daily, late, calendar))
    result = timed(
        "clv_daily_incremental", lambda: refresh_daily_value(spark, daily, dated, calendar, date(as_of.year, 1, 1))
    )
    marts = {
        "clv_trends": lambda: customers.value_trends(read_table(spark, daily)),
        "customer_clv_tiers": lambda: customers.value_tiers(named),
        "customer_rfm": lambda: customers.recency_frequency_monetary(dated, as_of),
        "churn_indicators": lambda: customers.churn_indicators(dated, as_of),
        "sales_daily": lambda: commerce.sales_daily(sold, calendar),
        "loyalty_impact": lambda: customers.loyalty_impact(named),
        "location_performance": lambda: commerce.location_performance(regular(facts)),
        "discount_effectiveness": lambda: commerce.discount_effectiveness(regular(facts)),
    }
    for name, mart in marts.items():
        timed(name, lambda n=name, m=mart: write_table(m(), lake.mart(n)))
    sales, churn = read_table(spark, lake.mart("sales_daily")), read_table(spark, lake.mart("churn_indicators"))
    timed("report_monthly_revenue", lambda: run(reports.monthly_revenue(sales)))
    timed("report_sales_kpis", lambda: run(reports.sales_kpis(sales)))
    timed("report_churn_kpis", lambda: run(reports.churn_kpis(churn)))
    timed("report_at_risk", lambda: run(reports.at_risk_customers(churn)))

    # the pipeline on two snapshots: the orders up to the last year, then all of them
    root = Layout(f"{shared_directory(spark)}/bench-{uuid.uuid4().hex}")
    land(spark, root, "2001-01-01", before=f"{as_of.year}-01-01")
    timed("pipeline_first_run", lambda: pipeline.run_pipeline(spark, root, outlier_threshold=star.ORDER_OUTLIER), 1)
    land(spark, root, "2001-08-02")
    timed("pipeline_second_run", lambda: pipeline.run_pipeline(spark, root, outlier_threshold=star.ORDER_OUTLIER), 1)

    print(json.dumps({
        "metric": "total wall-clock of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(SF_DIR).name.removeprefix("sf"), "cpus": int(CPUS),
        "clv_daily_rows_per_sec": round(result["rows"] / seconds["clv_daily_incremental"]),
    }))
    spark.stop()


def land(spark, layout: Layout, dt: str, before: str = "9999") -> None:
    items = star.order_items(spark, SF_DIR).filter(F.col("creation_time_utc") < before)
    options = star.order_item_options(spark, SF_DIR).join(items.select("order_id", "lineitem_id"), ["order_id", "lineitem_id"], "left_semi")
    for name, df in zip(LOGGED, (items, options)):
        df.write.parquet(layout.snapshot(dt, name))
    star.holidays(spark, SF_DIR).select("DATE_KEY", "IS_HOLIDAY", "HOLIDAY_NAME").write.parquet(layout.snapshot(dt, "date_dim"))


if __name__ == "__main__":
    main()
