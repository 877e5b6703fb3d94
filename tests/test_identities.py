"""Sums over any grain equal the total, and related counts add up."""

import random

import pytest
from pyspark.sql import functions as F
from small import shipment, star

from tradeledger.operators import preagg
from tradeledger.plans import crm, shipments, territory


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


@pytest.fixture(scope="module")
def summary(fixture_star):
    return crm.kpi_executive_summary(fixture_star).first()


def test_net_sales_over_any_grain(fixture_star, summary):
    expected = summary["total_net_sales"]
    assert total(shipments.kpi_monthly_trends(fixture_star), "net_sales") == expected
    assert total(shipments.kpi_yoy_growth(fixture_star), "net_sales") == expected
    assert total(shipments.kpi_distributor_scorecards(fixture_star), "net_sales") == expected
    assert total(territory.kpi_territory_heatmap(fixture_star), "net_sales") == expected
    assert total(shipments.vw_distributor_scorecard(fixture_star), "net_sales") == expected


def test_margin_and_gross(fixture_star, summary):
    assert total(shipments.kpi_monthly_trends(fixture_star), "gross_margin") == summary["gross_margin"]
    assert total(shipments.an_monthly_trend(fixture_star), "gross_sales") == summary["total_gross_sales"]


def test_deals_add_up(fixture_star, summary):
    stages = crm.kpi_pipeline_health(fixture_star)
    assert total(stages, "value") == summary["pipeline_value"]
    open_deals = total(stages, "count")
    assert summary["won_deals"] + summary["lost_deals"] + open_deals == summary["total_opportunities"]


def test_rep_revenue_is_not_multiplied(fixture_star):
    """Revenue per rep adds up to the revenue of deals owned by a listed rep."""
    reps = crm.an_rep_summary(fixture_star)
    owned = fixture_star.sf_opportunities.join(
        fixture_star.sales_reps, F.col("owner_id") == F.col("rep_id"), "left_semi"
    )
    won = owned.filter(F.col("stage") == "Closed Won")
    assert total(reps, "total_revenue") == total(won, "amount")
    assert total(reps, "won_deals") == won.count()


def test_territory_counts(fixture_star):
    frame = territory.vw_territory_summary(fixture_star)
    assert total(frame, "total_operators") == fixture_star.operators.count()
    assert total(frame, "total_reps") == fixture_star.sales_reps.count()
    assert total(frame, "total_distributors") == fixture_star.distributors.count()


def test_prior_year_is_last_years_net(fixture_star):
    rows = shipments.an_yoy_growth(fixture_star).collect()
    net = {(r["distributor_id"], r["year"]): r["total_net_sales"] for r in rows}
    assert len(net) == len(rows)
    for r in rows:
        assert r["prior_year_sales"] == net.get((r["distributor_id"], r["year"] - 1))


def test_distinct_counts_match_count_distinct(fixture_star):
    names = ("active_operators", "products_sold", "active_distributors")
    ours = preagg.shipments_by(fixture_star, "year", distinct=names).select("year", *names)
    plain = fixture_star.shipments.groupBy(F.year("week_ending").alias("year")).agg(
        *[F.count_distinct(preagg.DISTINCTS[n]).alias(n) for n in names]
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_any_grain_matches_plain_python(spark):
    """Random shipments with NULL and repeated keys, against dictionaries."""
    draw = random.Random(7)
    many = [
        shipment(
            draw.choice(["2023-12-30", "2024-01-06", "2024-02-03", None]),
            distributor=draw.choice(["D1", "D1", "D2", None]),
            operator=draw.choice(["O1", "O2", "O3", None]),
            product=draw.choice(["P1", "P2", None]),
            gross=draw.randint(0, 50),
        )
        for _ in range(150)
    ]
    names = ("active_operators", "products_sold", "active_distributors")
    for keys in ((), ("distributor_id",), ("distributor_id", "product_id")):
        expected = {}
        for row in many:
            group = expected.setdefault(
                tuple(row[k] for k in keys), [0, 0, *(set() for _ in names)]
            )
            group[0] += 1
            group[1] += row["net_sales"]
            for seen, name in zip(group[2:], names):
                seen.add(row[preagg.DISTINCTS[name]])
        result = preagg.shipments_by(star(spark, shipments=many), *keys, distinct=names)
        got = {
            tuple(r[k] for k in keys): [r["shipment_count"], r["net_sales"], *(r[n] for n in names)]
            for r in result.collect()
        }
        assert got == {
            k: [g[0], g[1], *(len(seen - {None}) for seen in g[2:])] for k, g in expected.items()
        }


def test_win_rate_all_stays_a_percentage(fixture_star):
    rates = crm.an_rep_summary(fixture_star).select("win_rate_all").dropna().collect()
    assert rates and all(0 <= r[0] <= 100 for r in rates)


def test_fixture_amounts_have_whole_cents(fixture_star, spark, sf_dir):
    """The cents arithmetic of the fixtures rests on two-decimal inputs."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for column in ("l_extendedprice", "l_discount", "l_tax"):
        off = F.abs(F.col(column) * 100 - F.rint(F.col(column) * 100))
        assert lines.agg(F.max(off)).first()[0] < 1e-6
