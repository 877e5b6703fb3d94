"""Merged states against figures taken from the rows."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F
from small import rows, shipment, star

from tradeledger.operators import quality, states
from tradeledger.operators.preagg import shipments_by
from tradeledger.operators.ranking import with_rank
from tradeledger.plans import dashboard, shipments


@pytest.fixture(scope="module")
def cube(fixture_star):
    return states.sales_cube(fixture_star)


def test_slices_of_the_cube_are_the_reports(cube, fixture_star):
    wanted = rows(dashboard.dash_region_sales(fixture_star, year=2000), "region", "net_sales")
    found = rows(states.cube_slice(cube, "region", year=2000), "region", "net_sales")
    assert sorted(found) == sorted(r for r in wanted if r[1])
    scorecards = shipments.kpi_distributor_scorecards(fixture_star, year=2000, distributor_type="National")
    wanted = rows(scorecards, "distributor_id", "net_sales", "total_units")
    found = rows(states.cube_slice(cube, "distributor_id", year=2000, distributor_type="National"),
                 "distributor_id", "net_sales", "quantity")
    assert sorted(found) == sorted(r for r in wanted if r[2])
    (total,) = rows(states.cube_slice(cube), "net_sales", "shipment_count")
    assert total == rows(shipments_by(fixture_star), "net_sales", "shipment_count")[0]
    with pytest.raises(ValueError, match="no rows by"):
        states.cube_slice(cube.limit(1), "no_such_key")


def text_star(spark, n=400):
    rng = np.random.default_rng(5)
    made = [
        shipment(f"202{i % 3}-0{1 + i % 9}-04", distributor=f"D{i % 4}", operator=f"OP-{rng.integers(60):06d}",
                 product=f"P{i % 5}", quantity=int(rng.integers(1, 500)))
        for i in range(n)
    ]
    return star(
        spark, shipments=made,
        operators=[{"operator_id": f"OP-{i:06d}", "operator_name": "x"} for i in range(60)],
        distributors=[{"distributor_id": f"D{i}", "distributor_name": "d", "distributor_type": "AB"[i % 2]} for i in range(4)],
        products=[{"product_id": f"P{i}", "product_name": "p", "category": "XY"[i % 2] if i < 4 else None} for i in range(5)],
    )


def test_bitmaps_count_text_ids_exactly(spark):
    s = text_star(spark)
    found = states.active_operators(states.operator_states(s), "year", "distributor_type")
    of = s.shipments.join(s.distributors.select("distributor_id", "distributor_type"), "distributor_id")
    wanted = of.groupBy(F.year("week_ending").alias("year"), "distributor_type").agg(F.countDistinct("operator_id"))
    assert sorted(rows(found)) == sorted(rows(wanted))
    (one,) = rows(states.active_operators(states.operator_states(s), year=2021, distributor_type="A"))
    assert one[0] == {tuple(r)[:2]: r[2] for r in wanted.collect()}[2021, "A"]


def test_quartiles_of_any_span_keep_the_rank_error(spark):
    s = text_star(spark, 3000)
    kept = states.quantity_states(s)
    whole = states.within_rank_error(states.quantity_quartiles(kept, s.products), quality.quantity_histogram(s))
    assert sorted(str(r[0]) for r in rows(whole)) == ["None", "X", "Y"] and all(r[2] for r in rows(whole))
    first, last = date(2021, 3, 1), date(2021, 6, 30)
    within = s.shipments.filter(F.col("week_ending").between(first, last))
    some = type(s)(spark, {"shipments": lambda: within, "products": lambda: s.products})
    part = states.quantity_quartiles(kept, s.products, first, last)
    found = states.within_rank_error(part, quality.quantity_histogram(some))
    assert all(r[2] for r in rows(found)) and sum(r[1] for r in rows(found)) == some.shipments.count()


def test_ties_of_text_ids_are_spread(spark):
    """A third of all ids begin alike and share one value."""
    made = [(f"REP-{i:06d}", 7 if i % 3 == 0 else i) for i in range(3000)] + [(None, 7)]
    df = spark.createDataFrame(made, "id string, v int").repartition(5)
    found = with_rank(df, "v", "id").collect()
    wanted = sorted(made, key=lambda r: (-r[1], r[0] is not None, r[0] or ""))
    assert [(r["id"], r["v"]) for r in sorted(found, key=lambda r: r["rank"])] == wanted
    from tradeledger.operators import ranking

    sizes = df.filter("v = 7").groupBy(ranking._id_part(df, "id")).count().collect()
    assert len(sizes) > 100 and max(r["count"] for r in sizes) < 100
