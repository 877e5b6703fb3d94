"""CSV export to warehouse to products, and what goes wrong on the way."""

import json
import os
import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from small import frame, rows, shipment, star

from tradeledger.operators import preagg, quality
from tradeledger.plans import crm, publish, shipments, territory
from tradeledger.sources import sinks, snapshots, tables
from tradeledger.sources.schemas import TABLES


def as_export(fixture_star, spark):
    """The fixture star with text keys and ids, as an export has them."""
    frames = {}
    for name, schema in TABLES.items():
        df = fixture_star.table(name)
        if name == "shipments":
            df = df.withColumn(
                "shipment_id",
                F.concat_ws("-", "operator_id", "product_id", "shipment_date", "gross_sales"),
            )
        frames[name] = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return frames


@pytest.fixture(scope="module")
def export(spark, fixture_star, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("export"))
    for name, df in as_export(fixture_star, spark).items():
        path = f"{root}/{tables.EXPORT_LAYOUT[name]}"
        df.write.option("header", True).csv(path)
    return root


@pytest.fixture(scope="module")
def warehouse(spark, export, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warehouse"))
    publish.load_warehouse(spark, export, path)
    return path


def text(df):
    """Rows as comparable text; keys are text in an export, numbers in the fixtures."""
    return sorted(str(tuple(str(v) for v in r)) for r in df.collect())


def test_export_reads_back_typed(spark, export, fixture_star):
    star = tables.read_export(spark, export)
    for name, schema in TABLES.items():
        df = star.table(name)
        assert [(f.name, f.dataType) for f in df.schema.fields] == [
            (f.name, f.dataType) for f in schema.fields
        ]
        assert df.count() == fixture_star.table(name).count()


def test_warehouse_is_partitioned_and_gives_the_same_reports(spark, warehouse, fixture_star):
    (load,) = os.listdir(f"{warehouse}/shipments")
    years = {d for d in os.listdir(f"{warehouse}/shipments/{load}/rejected=false") if d.startswith("year=")}
    expected = fixture_star.lean_shipments.select(F.year("week_ending")).distinct().count()
    assert len(years) == expected
    stored = sinks.open_star(spark, warehouse)
    for report in (
        shipments.kpi_monthly_trends, shipments.kpi_distributor_scorecards,
        crm.kpi_executive_summary, territory.kpi_territory_heatmap,
    ):
        assert text(report(stored)) == text(report(fixture_star))


@pytest.mark.parametrize(
    "report",
    [
        shipments.an_yoy_growth, shipments.an_monthly_trend, shipments.kpi_distributor_scorecards,
        shipments.vw_distributor_scorecard, shipments.q04_active_operators, shipments.q09_top_products,
        shipments.shipment_monthly_summary, shipments.readme_net_sales_margin,
        crm.kpi_executive_summary, territory.vw_territory_summary,
    ],
)
def test_rollups_answer_like_the_rows(spark, warehouse, report):
    plain = sinks.open_star(spark, warehouse)
    rolled = sinks.open_star(spark, warehouse, rollups=True)
    assert text(report(rolled)) == text(report(plain))


@pytest.mark.parametrize(
    "report",
    [
        shipments.q01_distributor_yoy, shipments.kpi_monthly_trends,
        shipments.kpi_distributor_scorecards, territory.kpi_territory_heatmap,
    ],
)
def test_rollups_answer_for_a_year(spark, warehouse, report):
    plain = report(sinks.open_star(spark, warehouse), year=2000)
    rolled = report(sinks.open_star(spark, warehouse, rollups=True), year=2000)
    assert text(rolled) == text(plain)
    assert not any("/shipments/" in f for f in rolled.inputFiles())


def test_rollups_step_aside_for_part_of_a_month(spark, warehouse):
    period = (date(2000, 1, 5), date(2000, 2, 29))
    plain = preagg.shipments_by(sinks.open_star(spark, warehouse), "year", period=period)
    rolled = preagg.shipments_by(
        sinks.open_star(spark, warehouse, rollups=True), "year", period=period
    )
    assert text(rolled) == text(plain)


def test_rollup_reports_do_not_read_shipment_rows(spark, warehouse):
    rolled = sinks.open_star(spark, warehouse, rollups=True)
    for report in (shipments.kpi_distributor_scorecards, shipments.an_monthly_trend):
        files = report(rolled).inputFiles()
        assert files and not any("/shipments/" in f for f in files)


def test_a_year_opens_only_its_partitions(spark, warehouse):
    stored = sinks.open_star(spark, warehouse)
    plan = plan_of(shipments.kpi_monthly_trends(stored, year=2000))
    assert re.search(r"PartitionFilters: \[[^]]*isnotnull\(year", plan)
    assert "(year#" in plan and ">= 2000" in plan and "<= 2000" in plan
    assert "GreaterThanOrEqual(week_ending,2000-01-01)" in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_zip_codes_keep_their_zeros(spark, tmp_path):
    row = {"operator_id": "O1", "operator_name": "x", "zip_code": "01234"}
    path = str(tmp_path / "operators.csv")
    frame(spark, "operators", row).write.option("header", True).csv(path)
    assert rows(tables.read_table(spark, "operators", path), "zip_code") == [("01234",)]


def test_reordered_columns_are_refused(spark, tmp_path):
    path = str(tmp_path / "territories.csv")
    df = spark.createDataFrame([("x", "T1", "N", "AA", "UTC")],
                               "territory_name string, territory_id string, region string,"
                               " state string, timezone string")
    df.write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header|schema"):
        tables.read_table(spark, "territories", path).collect()


def test_missing_shipments(spark, tmp_path):
    path = str(tmp_path / "nothing.csv")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_shipments(spark, path)
    with pytest.warns(UserWarning, match="no shipments"):
        assert tables.read_shipments(spark, path, missing_ok=True).count() == 0


def test_yearly_files_equal_the_combined_one(spark, tmp_path):
    s = star(spark, shipments=[shipment("2023-12-30", id="a"), shipment("2024-01-06", id="b")])
    sinks.write_csv_by_year(s.shipments, str(tmp_path))
    yearly = tables.read_shipments(spark, f"{tmp_path}/by_year/year=*")
    combined = tables.read_shipments(spark, f"{tmp_path}/all")
    assert sorted(rows(yearly)) == sorted(rows(combined)) == sorted(rows(s.shipments))
    assert sorted(os.listdir(tmp_path / "by_year"))[-2:] == ["year=2023", "year=2024"]


def test_json_products_are_arrays_in_order(spark, tmp_path):
    path = str(tmp_path / "product.json")
    many = spark.range(1000).selectExpr("id AS k", "CAST(id AS DECIMAL(18,2)) / 4 AS v", "CAST(NULL AS INT) AS n")
    sinks.write_json(many.repartition(7).orderBy(F.desc("k")), path)
    found = json.loads((tmp_path / "product.json").read_text())
    assert [r["k"] for r in found] == list(range(999, -1, -1))
    assert found[0] == {"k": 999, "v": 249.75, "n": None}
    assert tables.read_product(spark, path, many.schema).dtypes == many.dtypes
    assert sorted(rows(tables.read_product(spark, path, many.schema))) == sorted(rows(many))
    sinks.write_json(many.filter("k < 0"), path)
    assert json.loads((tmp_path / "product.json").read_text()) == []
    assert os.listdir(tmp_path) == ["product.json"] or set(os.listdir(tmp_path)) == {"product.json", ".product.json.crc"}
    assert tables.read_product(spark, str(tmp_path / "none.json"), many.schema) is None
    assert tables.read_product(spark, str(tmp_path / "none"), many.schema) is None


def test_json_lines_are_read_in_their_latest_version(spark, tmp_path):
    path = str(tmp_path / "lines")
    df = spark.createDataFrame([("a", Decimal("1.50"), None)], "k string, v decimal(18,2), n int")
    sinks.write_json_lines(df, path)
    sinks.write_json_lines(df.union(df), path)
    found = tables.read_product(spark, path, df.schema)
    assert rows(found) == [("a", Decimal("1.50"), None)] * 2


def test_a_product_that_fails_leaves_the_former_one(spark, tmp_path):
    path = str(tmp_path / "product.json")
    sinks.write_json(spark.range(3), path)
    with pytest.raises(Exception, match="half-way"):
        sinks.write_json(spark.range(9).select(failing("id")), path)
    assert [r["id"] for r in json.loads((tmp_path / "product.json").read_text())] == [0, 1, 2]


def test_kpi_card_is_one_object(spark, tmp_path, fixture_star):
    path = str(tmp_path / "card.json")
    sinks.write_kpi_card(path, shipments.shipment_totals(fixture_star), crm.deal_totals(fixture_star))
    assert len(json.loads((tmp_path / "card.json").read_text())) == 15
    assert tables.read_product(spark, path, publish.product_schema(spark, "executive_summary")).count() == 1


def failing(column):
    return F.when(F.col(column) >= 8, F.raise_error(F.lit("half-way"))).otherwise(F.col(column)).alias(column)


def test_summaries_replace_stale_ones(spark, tmp_path):
    path = str(tmp_path / "summary")
    sinks.write_summary(spark.range(5), path)
    before = sinks.read_summary(spark, path)
    sinks.write_summary(spark.range(2), path)
    assert sinks.read_summary(spark, path).count() == 2
    assert before.count() == 5
    with pytest.raises(Exception, match="half-way"):
        sinks.write_summary(spark.range(9).select(failing("id")), path)
    assert sinks.read_summary(spark, path).count() == 2


def two_weeks():
    return [shipment("2023-12-30", id="a", net=70), shipment("2024-01-06", id="b", net=80), shipment("2024-02-10", id="c", net=90)]


def totals(star_):
    return sorted(rows(preagg.shipments_by(star_, "month_start"), "month_start", "net_sales", "shipment_count"))


def test_a_load_that_fails_half_way_leaves_the_former_version(spark, tmp_path):
    path = str(tmp_path / "wh")
    sinks.write_star(star(spark, shipments=two_weeks()), path, rollups=True)
    opened = sinks.open_star(spark, path)
    broken = star(spark, shipments=two_weeks()[:1])
    bad = broken.shipments.withColumn("quantity", F.raise_error(F.lit("half-way")).cast("int"))
    loaders = {n: lambda n=n: broken.table(n) for n in TABLES} | {"shipments": lambda: bad}
    with pytest.raises(Exception, match="half-way"):
        sinks.write_star(type(broken)(spark, loaders), path, rollups=True)
    assert sinks.open_star(spark, path).shipments.count() == opened.shipments.count() == 3
    assert len(os.listdir(f"{path}/territories")) == 2
    sinks.write_star(star(spark, shipments=two_weeks()[:2]), path, rollups=True)
    assert opened.shipments.count() == 3, "a reader keeps to its version"
    assert sinks.open_star(spark, path).shipments.count() == 2
    assert totals(sinks.open_star(spark, path, rollups=True, version=1)) == totals(opened)
    gone = snapshots.remove_unused(spark, path, keep=1)
    assert [g for g in gone if g.startswith("shipments/load=000001")]
    assert sinks.open_star(spark, path).shipments.count() == 2


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    one = snapshots.Writer(spark, str(tmp_path))
    two = snapshots.Writer(spark, str(tmp_path))
    one.put("t", spark.range(1))
    two.put("t", spark.range(2))
    one.commit()
    with pytest.raises(RuntimeError, match="another version"):
        two.commit()
    assert snapshots.current(spark, str(tmp_path)).read(spark, "t").count() == 1


def files_of(path, year):
    found = set()
    for folder, _, names in os.walk(f"{path}/shipments"):
        if folder.endswith(f"year={year}"):
            found |= {f"{folder}/{n}" for n in names if n.endswith(".parquet")}
    return found


def test_appended_and_replaced_years_equal_a_rebuild(spark, tmp_path):
    path, whole = str(tmp_path / "wh"), str(tmp_path / "whole")
    sinks.write_star(star(spark, shipments=two_weeks()), path, rollups=True)
    untouched = files_of(path, 2023)
    more = [shipment("2024-01-13", id="d", net=5), shipment("2025-03-08", id="e", net=7)]
    sinks.append_shipments(spark, frame(spark, "shipments", *more), path, "first")
    again = sinks.append_shipments(spark, frame(spark, "shipments", *more), path, "first")
    assert again.version == 2
    sinks.write_star(star(spark, shipments=two_weeks() + more), whole, rollups=True)
    for rollups in (False, True):
        assert totals(sinks.open_star(spark, path, rollups)) == totals(sinks.open_star(spark, whole, rollups))
    anew = [shipment("2024-05-11", id="f", net=1)]
    sinks.append_shipments(spark, frame(spark, "shipments", *anew), path, "2024 anew", replace_years=True)
    kept = [two_weeks()[0], more[1], *anew]
    sinks.write_star(star(spark, shipments=kept), whole, rollups=True)
    for rollups in (False, True):
        assert totals(sinks.open_star(spark, path, rollups)) == totals(sinks.open_star(spark, whole, rollups))
    assert files_of(path, 2023) == untouched
    plan = plan_of(sinks.open_star(spark, path).shipments)
    (filters,) = re.findall(r"PartitionFilters: (.*?), PushedFilters", plan)
    assert "load#" in filters and "year#" in filters, "replaced parts are not opened"


def test_rejected_lines_are_put_aside(spark, tmp_path):
    path, export = str(tmp_path / "wh"), tmp_path / "shipments.csv"
    header = ",".join(TABLES["shipments"].names)
    good = "S1,2024-01-02,2024-01-06,D1,O1,P1,3,10.00,0.00,0.00,10.00,5.00"
    bad = "S2,not a day,2024-01-06,D1,O1,P1,3,10.00,0.00,0.00,10.00,5.00"
    short = "S3,2024-01-02"
    export.write_text("\n".join([header, good, bad, short, ""]))
    loaded = star(spark)
    loaders = {n: lambda n=n: loaded.table(n) for n in TABLES}
    loaders["shipments"] = lambda: tables.read_shipments(spark, str(export), keep_rejected=True)
    sinks.write_star(type(loaded)(spark, loaders), path, rollups=True)
    found = sinks.open_star(spark, path)
    assert rows(found.shipments, "shipment_id") == [("S1",)]
    assert set(found.shipments.columns) == set(TABLES["shipments"].names)
    assert {r["line"] for r in sinks.rejected_lines(spark, path).collect()} == {bad, short}
    assert all(r["file"].endswith("shipments.csv") for r in sinks.rejected_lines(spark, path).collect())
    stored = {(r["check"], r["table_name"]): r["observed"] for r in sinks.stored_checks(spark, path).collect()}
    assert stored["row_count", "shipments"] == 1 and stored["nulls", "shipments"] == 0
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        tables.read_shipments(spark, str(export)).collect()


def test_stored_checks_are_those_of_a_scan_and_save_it(spark, warehouse):
    opened = sinks.open_star(spark, warehouse, rollups=True)
    stored = sinks.stored_checks(spark, warehouse)
    scanned = quality.run_checks(opened, quality.declared_checks())
    assert text(quality.judged(stored)) == text(scanned)
    known = quality.quality_report(opened, stored=stored)
    assert text(known) == text(quality.quality_report(opened))


def test_tables_added_to_are_scanned_again(spark, tmp_path):
    path = str(tmp_path / "wh")
    sinks.write_star(star(spark, shipments=two_weeks()), path, rollups=True)
    sinks.append_shipments(spark, frame(spark, "shipments", shipment("2024-01-13", id="d")), path, "x")
    report = publish.check_warehouse(spark, path)
    (count,) = report.filter("check = 'row_count' AND table_name = 'shipments'").collect()
    assert count["observed"] == 4
    assert "shipments" not in {r["table_name"] for r in sinks.stored_checks(spark, path).collect()}


def test_views(spark, fixture_star):
    tables.register_views(fixture_star, prefix="t_")
    count = spark.sql("SELECT count(*) FROM t_operators").first()[0]
    assert count == tables.read_view(spark, "t_operators").count() == fixture_star.operators.count()


def test_full_run(spark, export, tmp_path, monkeypatch):
    def broken(star):
        raise ValueError("no such report")

    monkeypatch.setitem(publish.PRODUCTS, "broken", broken)
    with pytest.warns(UserWarning, match="broken was not written"):
        report = publish.run_all(spark, export, str(tmp_path / "wh"), str(tmp_path / "out"))
    assert report.columns[0] == "check" and report.count() > 40
    unpublished = report.filter("check = 'published' AND NOT passed").collect()
    assert [r["table_name"] for r in unpublished] == ["broken"]
    published = {f for f in os.listdir(tmp_path / "out") if f.endswith(".json")}
    names = {"executive_summary", *publish.PRODUCTS, *publish.EXPORTED_SUMMARIES} - {"broken"}
    assert published == {f"{n}.json" for n in names}
    for name in names:
        schema = publish.product_schema(spark, name)
        found = tables.read_product(spark, str(tmp_path / "out" / f"{name}.json"), schema)
        assert found.count() > 0 and found.dtypes == spark.createDataFrame([], schema).dtypes
        assert json.loads((tmp_path / "out" / f"{name}.json").read_text())


def test_hot_group_rollup(spark):
    """A third of all shipments on one operator and product changes nothing."""
    many = [
        shipment("2024-01-06", distributor=f"D{i % 3}",
                 operator="hot" if i % 3 == 0 else f"O{i}",
                 product="hot" if i % 3 == 0 else f"P{i % 50}")
        for i in range(600)
    ]
    s = star(spark, shipments=many)
    result = {
        r["distributor_id"]: r
        for r in preagg.shipments_by(
            s, "distributor_id", distinct=("active_operators", "products_sold")
        ).collect()
    }
    assert sum(r["shipment_count"] for r in result.values()) == 600
    assert (result["D0"]["active_operators"], result["D0"]["products_sold"]) == (1, 1)
    assert result["D1"]["active_operators"] == 200
    assert date(2024, 1, 6) == s.shipments.first()["week_ending"]


def test_command_line(spark, export, tmp_path, capsys):
    from tradeledger.__main__ import main

    warehouse, products = str(tmp_path / "wh"), str(tmp_path / "out")
    assert main(["load", export, warehouse], spark) == 0
    assert main(["publish", warehouse, products], spark) == 0
    assert main(["check", warehouse], spark) == 1
    printed = capsys.readouterr().out
    assert "ok   row_count shipments" in printed
    assert "FAIL return_cap shipments.returns" in printed
