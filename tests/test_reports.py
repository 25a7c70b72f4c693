from datetime import date

from helpers import rows

from orderlake.plans import reports


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_missing_tiers_states_and_segments_are_shown(spark):
    tiers = spark.createDataFrame([("a", 5.0, 1, 1, "High")], "user_id string, total_clv double, total_orders bigint, clv_quintile int, clv_tier string")
    assert listed(reports.tier_rollup(tiers)) == [("High", 1, 5.0), ("Medium", None, None), ("Low", None, None)]
    assert listed(reports.clv_kpis(tiers)) == [(1, 5.0, 5.0, 1)]
    churn = spark.createDataFrame([("a", 3, "Active", False), ("b", 50, "At Risk", True), ("c", 46, "At Risk", True)],
                                  "user_id string, days_since_last_order int, churn_status string, at_risk boolean")
    assert listed(reports.churn_kpis(churn)) == [("Active", 1, 46.0), ("At Risk", 2, 46.0), ("Dormant", 0, 46.0)]
    loyalty = spark.createDataFrame([("Loyalty", 4, 2.0, 1.0, 0.5)], "segment string, customers bigint, avg_clv double, avg_order_value double, repeat_rate double")
    assert listed(reports.loyalty_comparison(loyalty)) == [("Loyalty", 4, 2.0, 1.0, 0.5), ("Non-Loyalty", None, None, None, None)]


def test_histogram_edges(spark):
    churn = spark.createDataFrame([(d,) for d in (0, 7, 8, 364, 365, 366)], "days_since_last_order int")
    assert listed(reports.churn_histogram(churn)) == [(1, 0, 7, 2), (2, 8, 8, 1), (52, 364, 364, 1), (53, 365, 366, 2)]


def test_at_risk_list_is_longest_first_and_whole_by_default(spark):
    churn = spark.createDataFrame([("b", 60, True), ("a", 60, True), ("c", 90, True), ("d", 10, False)], "user_id string, days_since_last_order int, at_risk boolean")
    churn = churn.selectExpr("*", "date'2023-01-01' as last_order_date", "1L as total_orders", "1D as avg_gap_days", "1D as spend_change_pct", "'x' as churn_status")
    assert [r.user_id for r in reports.at_risk_customers(churn, 2).collect()] == ["c", "a"]
    assert [r.user_id for r in reports.at_risk_customers(churn).collect()] == ["c", "a", "b"]
    assert listed(reports.at_risk_total(churn)) == [(3,)]


def test_segments_and_sample(spark):
    rfm = spark.createDataFrame([(f"u{i}", 1, 1.0, "VIP" if i % 3 else "Churn Risk", 10) for i in range(9)],
                                "user_id string, frequency bigint, monetary double, rfm_segment string, rfm_score int")
    assert listed(reports.segment_counts(rfm)) == [("VIP", 6), ("Churn Risk", 3)]
    assert listed(reports.rfm_kpis(rfm)) == [(9, 6, 3, 10.0)]
    picked = rows(reports.rfm_sample(rfm, 4))
    assert len(picked) == 4 and picked == rows(reports.rfm_sample(rfm.repartition(3), 4)) and picked != rows(reports.rfm_sample(rfm, 4, seed="2"))


def test_sales_reports(spark):
    sales = spark.createDataFrame(
        [(date(2023, 1, 1), "r1", "Food", 10.0, True), (date(2023, 1, 1), "r1", "Drink", 5.0, True), (date(2023, 1, 2), "r2", "Food", 1.0, False),
         (date(2023, 2, 3), "r2", None, 3.0, False), (date(2030, 2, 3), "r2", "Food", 100.0, None)],
        "order_date date, restaurant_id string, item_category string, revenue double, is_holiday boolean")
    assert listed(reports.monthly_revenue(sales)) == [(date(2023, 1, 1), 16.0), (date(2023, 2, 1), 3.0), (date(2030, 2, 1), 100.0)]
    assert listed(reports.sales_kpis(sales)) == [(119.0, 2, 2, 4)]
    assert rows(reports.holiday_effect(sales)) == [("Holiday", True, 15.0), ("Non-holiday", False, 2.0)]
    assert listed(reports.top_categories(sales, 1)) == [("Food", 111.0)]


def test_locations_and_discounts(spark):
    locations = spark.createDataFrame([("restaurant-1", 1, 10.0, 5.0), ("restaurant-2", 2, 4.0, 2.0)], "restaurant_id string, revenue_rank int, total_revenue double, avg_order_value double")
    assert listed(reports.location_kpis(locations)) == [(2, 10.0, 3.5, 14.0)]
    assert listed(reports.top_locations(locations, 1).select("label", "revenue_rank")) == [("restaura", 1)]
    discounts = spark.createDataFrame([("Full-price", False, 3, 30.0, 30.0, 0.0)], "segment string, is_discounted boolean, orders bigint, total_gross_revenue double, total_net_revenue double, total_discount double")
    assert listed(reports.discount_kpis(discounts)) == [(0, 3, 0.0)]
    assert rows(reports.gross_and_net(discounts)) == [("Full-price", "Gross", 30.0), ("Full-price", "Net", 30.0)]
