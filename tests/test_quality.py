"""Checks on deliberately broken stars."""

from datetime import date

from pyspark.sql import functions as F
from small import activity, deal, shipment, star

from tradeledger.operators import quality


def found(df):
    return {
        (r["check"], r["table_name"], r["column_name"]): (r["observed"], r["passed"])
        for r in df.collect()
    }


def operator(id, territory="T1", distributor=None):
    return {"operator_id": id, "operator_name": id, "territory_id": territory,
            "primary_distributor_id": distributor}


def test_empty_tables_are_issues(spark):
    counts = found(quality.dq_row_counts(star(spark, shipments=[shipment("2024-01-06")])))
    assert counts[("row_count", "shipments", None)] == (1.0, True)
    assert counts[("row_count", "products", None)] == (0.0, False)
    assert len(counts) == 9


def test_nulls(spark):
    s = star(spark, shipments=[shipment("2024-01-06", net=None), shipment("2024-01-06")])
    assert found(quality.dq_nulls(s))[("nulls", "shipments", "net_sales")] == (1.0, False)


def test_orphans_with_and_without_null_keys(spark):
    s = star(
        spark,
        territories=[{"territory_id": "T1", "territory_name": "x", "region": "N", "state": "A"}],
        operators=[operator("O1"), operator("O2", "T9"), operator("O3", None)],
        sf_activities=[activity("a", account_id=None), activity("b", account_id="gone")],
    )
    orphans = found(quality.dq_fk_orphans(s))
    assert orphans[("fk_orphans", "operators", "territory_id")] == (1.0, False)
    assert orphans[("fk_orphans", "sf_activities", "account_id")] == (1.0, False)
    assert orphans[("fk_orphans", "shipments", "product_id")] == (0.0, True)
    missing = found(quality.dq_fk_left_join(s))
    assert missing[("fk_missing", "operators", "territory_id")] == (2.0, False)


def test_dates(spark):
    s = star(spark, shipments=[shipment("2014-12-27"), shipment("2024-01-06")])
    ranges = found(quality.dq_date_ranges(s, first=date(2015, 1, 1), last=date(2025, 12, 31)))
    assert ranges[("first_date", "shipments", "week_ending")] == (20141227.0, False)
    assert ranges[("last_date", "shipments", "week_ending")] == (20240106.0, True)
    bounds = found(quality.dq_date_bounds(s))
    assert bounds[("date_bounds", "shipments", "week_ending")] == (1.0, False)
    assert found(quality.dq_date_ranges(s))[("first_date", "shipments", "week_ending")][1]


def test_bands(spark):
    deals = [deal("1", amount=300_000), deal("2", amount=1, stage="Closed Lost")]
    s = star(spark, sf_opportunities=deals, shipments=[shipment("2024-01-06", discounts=30)])
    assert found(quality.dq_win_rate_band(s)) == {
        ("win_rate_band", "sf_opportunities", "stage"): (50.0, True)}
    assert found(quality.dq_win_rate_band(s, 60, 70)) == {
        ("win_rate_band", "sf_opportunities", "stage"): (50.0, False)}
    assert found(quality.dq_net_pct_band(s)) == {
        ("net_pct_band", "shipments", "net_sales"): (70.0, False)}
    assert found(quality.dq_avg_deal_band(s)) == {
        ("avg_deal_band", "sf_opportunities", "amount"): (300_000.0, False)}
    assert found(quality.dq_deal_amount_range(s)) == {
        ("deal_amount_range", "sf_opportunities", "amount"): (1.0, False)}


def test_amounts(spark):
    s = star(
        spark,
        shipments=[
            shipment("2024-01-06", discounts=20),
            shipment("2024-01-06", returns=6),
            shipment("2024-01-06", net=101),
            shipment("2024-01-06", quantity=-1),
            shipment("2024-01-06", discounts=15, returns=5),
        ],
    )
    caps = found(quality.dq_rate_caps(s))
    assert caps[("discount_cap", "shipments", "discounts")] == (1.0, False)
    assert caps[("return_cap", "shipments", "returns")] == (1.0, False)
    assert caps[("negative", "shipments", "quantity")] == (1.0, False)
    assert caps[("negative", "shipments", "net_sales")] == (0.0, True)
    assert found(quality.dq_net_le_gross(s)) == {
        ("net_le_gross", "shipments", "net_sales"): (1.0, False)}


def test_duplicate_keys(spark):
    s = star(spark, shipments=[shipment("2024-01-06", id="s1")] * 3 + [shipment("2024-01-06", id="s2")])
    keys = found(quality.dq_pk_unique(s))
    assert keys[("pk_unique", "shipments", "shipment_id")] == (2.0, False)
    assert keys[("pk_unique", "products", "product_id")] == (0.0, True)


def test_fanout(spark):
    s = star(spark, sf_opportunities=[deal("1"), deal("2"), deal("3", owner="R2")])
    fanout = found(quality.dq_join_fanout(s))
    assert fanout[("join_fanout_max", "sf_opportunities", "owner_id")] == (2.0, False)
    assert fanout[("join_fanout_mean", "sf_opportunities", "owner_id")] == (1.5, True)


def test_quantity_outliers(spark):
    product = [{"product_id": "P1", "product_name": "x", "category": "Dairy"}]
    quantities = [10, 11, 12, 13, 14, 100]
    s = star(
        spark, products=product,
        shipments=[shipment("2024-01-06", quantity=q) for q in quantities],
    )
    result = {r["check"]: r for r in quality.dq_quantity_iqr(s).collect()}
    assert result["quantity_iqr"]["observed"] == 1.0 and not result["quantity_iqr"]["passed"]
    assert (result["quantity_iqr"]["lower"], result["quantity_iqr"]["upper"]) == (7.5, 17.5)
    assert result["quantity_cap"]["upper"] == 37.5
    flagged = quality.flag_quantity_outliers(s).filter(F.col("iqr_outlier")).collect()
    assert [r["quantity"] for r in flagged] == [100]
    assert quality.flag_quantity_outliers(s).count() == len(quantities)


def test_issue_summary(spark):
    s = star(spark, shipments=[shipment("2024-01-06", id="s1", net=None)])
    summary = quality.dq_issue_summary(s).first()
    assert not summary["all_passed"]
    assert "nulls shipments.net_sales" in summary["issues"]
    assert summary["issue_count"] == len(summary["issues"].split("; "))
    assert summary["checks"] == quality.quality_report(s).count()
