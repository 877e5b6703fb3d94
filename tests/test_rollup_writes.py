"""What a roll-up's write shuffles, and what an append leaves alone."""

import os

from small import frame, rows, shipment, star

from tradeledger.operators import preagg
from tradeledger.sources import sinks, snapshots

KEYS = ("month_start", "distributor_id", "operator_id")


def loads(path):
    return {n: sorted(os.listdir(f"{path}/{n}")) for n in ("rollup_by_operator", "rollup_by_product")}


def sums(star_):
    return sorted(rows(preagg.shipments_by(star_, *KEYS), *KEYS, "quantity", "net_sales", "shipment_count"), key=repr)


def test_a_rollup_is_shuffled_once(spark):
    s = star(spark, shipments=[shipment("2024-01-06"), shipment("2024-02-10", operator=None)])
    for name in preagg.ROLLUPS:
        plan = sinks._rollup_layout(s, name)._jdf.queryExecution().executedPlan().toString()
        (exchange,) = [line for line in plan.split("\n") if "Exchange" in line]
        assert "rangepartitioning(month_start" in exchange


def test_an_append_adds_its_own_sums_and_reads_back_as_a_rebuild(spark, tmp_path):
    path, whole = str(tmp_path / "wh"), str(tmp_path / "whole")
    first = [shipment("2024-01-06", quantity=3), shipment("2024-01-13", operator=None), shipment("2024-02-10", product="P2")]
    more = [shipment("2024-01-20", quantity=None), shipment("2024-01-20", operator=None), shipment("2024-01-06", operator="O2")]
    sinks.write_star(star(spark, shipments=first), path, rollups=True)
    before = loads(path)
    sinks.append_shipments(spark, frame(spark, "shipments", *more), path, "more")
    current = snapshots.current(spark, path)
    for name in before:
        old, new = current.tables[name]
        assert not old.without and f"load={old.load}" in before[name], "no stored month is written anew"
        added = snapshots.Snapshot(path, 1, {name: (new,)}).read(spark, name)
        assert added.agg({"shipment_count": "sum"}).first()[0] == len(more)
    sinks.write_star(star(spark, shipments=first + more), whole, rollups=True)
    assert sums(sinks.open_star(spark, path, rollups=True)) == sums(sinks.open_star(spark, whole, rollups=True))
    sinks.append_shipments(spark, frame(spark, "shipments", *more[:1]), path, "anew", replace_years=True)
    sinks.write_star(star(spark, shipments=more[:1]), whole, rollups=True)
    assert sums(sinks.open_star(spark, path, rollups=True)) == sums(sinks.open_star(spark, whole, rollups=True))
