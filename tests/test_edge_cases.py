"""Empty dimensions, gaps, NULLs, zeros and ties, on hand-made stars."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from small import activity, deal, rows, shipment, star

from tradeledger.functions import dates, kpis
from tradeledger.operators.ranking import with_rank
from tradeledger.plans import crm, dashboard, shipments, territory

TERRITORIES = [
    {"territory_id": "T1", "territory_name": "North", "region": "N", "state": "AA"},
    {"territory_id": "T2", "territory_name": "South", "region": "S", "state": "BB"},
]


def distributor(id, territory="T1", name=None, kind="National"):
    return {
        "distributor_id": id,
        "distributor_name": name or f"Dist {id}",
        "distributor_type": kind,
        "territory_id": territory,
    }


def rep(id, tier="Senior", territory="T1", quota=1000):
    return {
        "rep_id": id, "rep_name": f"Rep {id}", "rep_tier": tier,
        "territory_id": territory, "quota_annual": quota,
    }


def test_distributor_without_shipments_or_territory(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        distributors=[distributor("D1"), distributor("D2", territory=None)],
        shipments=[shipment("2024-01-06")],
    )
    cards = {r["distributor_id"]: r for r in shipments.kpi_distributor_scorecards(s).collect()}
    assert cards["D2"]["active_operators"] == 0
    assert cards["D2"]["net_sales"] is None
    assert cards["D2"]["region"] is None
    view = rows(shipments.vw_distributor_scorecard(s), "distributor_id", "year", "month")
    assert sorted(view, key=str) == [("D1", 2024, 1), ("D2", None, None)]
    regions = dict(rows(dashboard.dash_region_sales(s)))
    assert regions == {"N": Decimal("100.00"), "Unknown": Decimal("0.00")}
    bars = dict(rows(dashboard.dash_margin_bar(s), "distributor_id", "bar_width"))
    assert bars == {"D1": 100.0, "D2": 0.0}


def test_growth_over_a_missing_year(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        distributors=[distributor("D1")],
        shipments=[
            shipment("2020-02-01", gross=100),
            shipment("2022-02-05", gross=300),
            shipment("2023-02-04", gross=150),
        ],
    )
    growth = {r["year"]: r for r in shipments.kpi_yoy_growth(s).collect()}
    assert growth[2022]["prior_year"] is None and growth[2022]["yoy_growth"] is None
    assert growth[2023]["yoy_growth"] == -50.0
    assert rows(shipments.readme_yoy_total(s)) == [(2023, -50.0)]
    one_year = rows(shipments.q01_distributor_yoy(s, year=2023))
    assert one_year == [("Dist D1", "National", 2023, Decimal("150.00"), Decimal("300.00"), -50.0)]


def test_same_named_distributors_stay_apart(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        distributors=[distributor("D1", name="Twin"), distributor("D2", name="Twin")],
        shipments=[shipment("2023-02-04", "D1"), shipment("2024-02-03", "D2")],
    )
    assert [r["prior_year"] for r in shipments.kpi_yoy_growth(s).collect()] == [None, None]


def test_zero_prior_year_and_zero_gross(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        distributors=[distributor("D1")],
        shipments=[shipment("2022-02-05", gross=0), shipment("2023-02-04", gross=10)],
    )
    growth = {r["year"]: r["yoy_growth"] for r in shipments.kpi_yoy_growth(s).collect()}
    assert growth == {2022: None, 2023: None}
    zero = star(spark, shipments=[shipment("2022-02-05", gross=0)])
    assert rows(shipments.readme_net_sales_margin(zero), "margin_pct") == [(None,)]


def test_latest_total_growth_skips_the_running_year(spark):
    s = star(
        spark,
        shipments=[
            shipment("2022-12-31", gross=100),
            shipment("2023-12-30", gross=110),
            shipment("2024-03-02", gross=5),
        ],
    )
    assert rows(shipments.yoy_total_latest(s)) == [
        (2023, Decimal("110.00"), Decimal("100.00"), 10.0)
    ]


def test_deals_and_activities_do_not_multiply(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        sales_reps=[rep("R1")],
        sf_opportunities=[deal("1", amount=700), deal("2", amount=300, stage="Closed Lost")],
        sf_activities=[activity("a"), activity("b", kind="Meeting"), activity("c", kind="Site Visit")],
    )
    r = crm.kpi_rep_rankings(s).first()
    assert (r["opportunities"], r["won"], r["lost"], r["activities"]) == (2, 1, 1, 3)
    assert r["revenue"] == Decimal("700.00")
    assert (r["win_rate"], r["quota_attainment"], r["activities_per_opp"]) == (50.0, 70.0, 1.5)
    q = crm.q05_activity_revenue(s).first()
    assert (q["calls"], q["meetings"], q["site_visits"]) == (1, 1, 1)
    assert q["revenue_per_activity"] == 233.33
    by_year = crm.vw_rep_performance(s).first()
    assert (by_year["year"], by_year["total_revenue"], by_year["total_activities"]) == (
        2024, Decimal("700.00"), 3)


def test_reps_with_only_one_side_or_none(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        sales_reps=[rep("R1"), rep("R2"), rep("R3", territory=None), rep("R4", tier=None),
                    rep("R5", tier="Director")],
        sf_opportunities=[deal("1", owner="R2", amount=50)],
        sf_activities=[activity("a", owner="R1")],
    )
    ranked = {r["rep_id"]: r for r in crm.kpi_rep_rankings(s).collect()}
    assert set(ranked) == {"R1", "R2", "R3"}
    assert ranked["R1"]["revenue"] == 0 and ranked["R1"]["win_rate"] is None
    assert ranked["R1"]["activities_per_opp"] is None
    assert ranked["R2"]["activities"] == 0
    assert ranked["R3"]["avg_deal"] is None and ranked["R3"]["territory_name"] is None
    assert len(rows(crm.an_rep_summary(s))) == 5
    assert rows(crm.q02_rep_win_rate(s), "rep_name") == [("Rep R2",)]
    assert rows(crm.kpi_activity_correlation(s), "rep_id") == [("R1",)]
    view = {r["rep_id"]: r for r in crm.vw_rep_performance(s).collect()}
    assert view["R1"]["year"] is None and view["R1"]["total_activities"] == 0


def test_deal_without_close_date_matches_no_activity(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        sales_reps=[rep("R1")],
        sf_opportunities=[deal("1", close=None)],
        sf_activities=[activity("a", day=None), activity("b")],
    )
    assert rows(crm.vw_rep_performance(s), "year", "total_opportunities", "total_activities") == [
        (None, 1, 0)
    ]


def test_ties_at_the_cut_go_to_the_lower_id(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        sales_reps=[rep("R3"), rep("R1"), rep("R2")],
        sf_opportunities=[deal(r, owner=r, amount=10) for r in ("R1", "R2", "R3")],
    )
    assert rows(crm.q02_rep_win_rate(s, n=2), "rep_name") == [("Rep R1",), ("Rep R2",)]


def test_quota_of_one_year(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        sales_reps=[rep("R1", quota=1000)],
        sf_opportunities=[deal("1", amount=500), deal("2", amount=800, close="2023-05-01")],
    )
    assert rows(crm.kpi_rep_rankings(s), "quota_attainment") == [(130.0,)]
    assert rows(crm.kpi_rep_rankings(s, year=2024), "quota_attainment") == [(50.0,)]


def test_territory_without_anything(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        operators=[{"operator_id": "O1", "operator_name": "x", "territory_id": "T1"}],
        sales_reps=[rep("R1"), rep("R2")],
        sf_accounts=[{"account_id": "A1", "operator_id": "O1", "account_name": "x"}],
        sf_opportunities=[deal("1", amount=40), deal("2", amount=60)],
        shipments=[shipment("2024-01-06"), shipment("2024-01-13")],
    )
    ranking = rows(territory.q08_territory_ranking(s))
    assert ranking[0] == ("North", "N", "AA", 1, 2, Decimal("200.00"), 100.0)
    assert ranking[1] == ("South", "S", "BB", 0, 0, Decimal("0.00"), 0.0)
    heat = {r["territory_id"]: r for r in territory.kpi_territory_heatmap(s).collect()}
    assert heat["T1"]["revenue_won"] == Decimal("100.00") and heat["T1"]["opportunities"] == 2
    assert heat["T2"]["net_sales"] is None and heat["T2"]["revenue_won"] == 0


def test_trailing_year_ends_at_as_of(spark):
    s = star(
        spark,
        territories=TERRITORIES,
        distributors=[distributor("D1"), distributor("D2")],
        shipments=[
            shipment("2022-12-31", operator="old"),
            shipment("2023-06-03", operator="O1"),
            shipment("2024-01-06", operator="O2", gross=50),
            shipment("2024-06-01", "D2", operator="late"),
        ],
    )
    result = rows(shipments.q04_active_operators(s, as_of=date(2024, 1, 6)))
    assert result == [("Dist D1", "National", 2, 1, 2, Decimal("150.00"), 75.0)]


def test_null_keys_keep_their_amounts(spark):
    s = star(spark, shipments=[shipment(None), shipment("2024-01-06")])
    months = dict(rows(shipments.kpi_monthly_trends(s), "month", "net_sales"))
    assert months == {None: Decimal("100.00"), "2024-01": Decimal("100.00")}


def test_empty_star(spark):
    s = star(spark)
    summary = crm.kpi_executive_summary(s).first()
    assert summary["total_shipments"] == 0 and summary["total_net_sales"] is None
    assert summary["win_rate"] is None and summary["pipeline_value"] == 0
    assert rows(crm.q06_pipeline_by_stage(s)) == []


@pytest.mark.parametrize(
    "day, saturday",
    [("2024-01-06", "2024-01-06"), ("2024-01-07", "2024-01-13"), ("2024-01-05", "2024-01-06")],
)
def test_week_ending(spark, day, saturday):
    got = spark.range(1).select(dates.week_ending(F.lit(date.fromisoformat(day)))).first()[0]
    assert got == date.fromisoformat(saturday)


def test_halves_round_away_from_zero(spark):
    got = spark.range(1).select(
        kpis.half_up(F.lit(2.675), 2), kpis.half_up(F.lit(-0.25), 1), kpis.percent(F.lit(1), F.lit(0))
    ).first()
    assert tuple(got) == (2.68, -0.3, None)


def test_quotients_round_once(spark):
    """2.674999999 is below the half, 310528.845 is the half itself."""
    got = spark.range(1).select(
        kpis.half_up(F.lit(2.674999999), 2),
        kpis.ratio(F.lit(1242115.38).cast("decimal(18,2)"), F.lit(4), 2),
    ).first()
    assert tuple(got) == (2.67, 310528.85)


def test_rank_with_many_ties(spark):
    """A third of the rows share one value; numbers are still 1..n in order."""
    n = 3000
    df = spark.range(n).select(
        (F.col("id") * 100).alias("id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
        .otherwise((F.col("id") % 101 - 40) * 1000).alias("v"),
    )
    got = [tuple(r) for r in with_rank(df.repartition(8), "v", "id").select("rank", "v", "id").collect()]
    low = -(10**9)
    expected = sorted(((r["v"], r["id"]) for r in df.collect()), key=lambda p: (-(low if p[0] is None else p[0]), p[1]))
    assert sorted(got) == [(i + 1, v, k) for i, (v, k) in enumerate(expected)]


def test_rank_of_texts_and_of_nothing(spark):
    df = spark.createDataFrame([("R10", 5), ("R2", 5), ("A1", 9), (None, 5)], "id string, v int")
    got = [tuple(r) for r in with_rank(df, "v", "id").orderBy("rank").collect()]
    assert got == [(1, "A1", 9), (2, None, 5), (3, "R10", 5), (4, "R2", 5)]
    assert with_rank(df.limit(0), "v", "id").count() == 0


def test_building_the_leaderboard_starts_no_job(spark, fixture_star):
    from tradeledger.plans import dashboard

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    dashboard.dash_rep_leaderboard(fixture_star).explain()
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("other", "")


def test_a_year_filters_every_fact(spark):
    """A distributor, a rep and a territory have nothing in 2024."""
    s = star(
        spark,
        territories=[{"territory_id": t, "territory_name": t, "region": "West"} for t in ("T1", "T2")],
        distributors=[
            {"distributor_id": d, "distributor_name": d, "distributor_type": "National", "territory_id": "T1"}
            for d in ("D1", "D2")
        ],
        operators=[{"operator_id": o, "operator_name": o, "territory_id": t} for o, t in (("O1", "T1"), ("O2", "T2"))],
        sales_reps=[
            {"rep_id": r, "rep_name": r, "rep_tier": "Senior", "territory_id": "T1", "quota_annual": 2000}
            for r in ("R1", "R2")
        ],
        sf_accounts=[{"account_id": a, "operator_id": o} for a, o in (("A1", "O1"), ("A2", "O2"))],
        sf_opportunities=[
            deal("1", owner="R1", close="2024-02-01"),
            deal("2", owner="R1", close="2023-02-01"),
            deal("3", owner="R2", account="A2", close="2023-03-01"),
            deal("4", owner="R2", account="A2", stage="Proposal", close="2024-03-01"),
        ],
        sf_activities=[activity("1", day="2024-01-02"), activity("2", day="2023-01-02")],
        shipments=[
            shipment("2024-01-06", "D1", "O1"), shipment("2023-01-07", "D1", "O1"),
            shipment("2023-01-07", "D2", "O2"),
        ],
    )
    rankings = crm.kpi_rep_rankings(s, year=2024)
    assert rows(rankings, "rep_id", "opportunities", "activities", "activities_per_opp") == [
        ("R1", 1, 1, 1.0), ("R2", 1, 0, 0.0)
    ]
    heat = {r["territory_id"]: r for r in territory.kpi_territory_heatmap(s, year=2024).collect()}
    assert (heat["T1"]["opportunities"], heat["T1"]["revenue_won"]) == (1, 1000)
    assert (heat["T2"]["net_sales"], heat["T2"]["opportunities"], heat["T2"]["revenue_won"]) == (None, 1, 0)
    view = shipments.vw_distributor_scorecard(s, year=2024)
    assert rows(view, "distributor_id", "year") == [("D1", 2024)]
    performed = crm.vw_rep_performance(s, year=2023)
    assert sorted(rows(performed, "rep_id", "year", "total_activities")) == [("R1", 2023, 1), ("R2", 2023, 0)]
    summary = crm.kpi_executive_summary(s, year=2024).first()
    assert (summary["total_shipments"], summary["won_deals"], summary["pipeline_value"]) == (1, 1, 1000)
    assert rows(crm.kpi_pipeline_health(s, year=2023)) == []
