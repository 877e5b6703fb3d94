"""The star seen through the order-processing test tables (see FIXTURES.md).

Every rule is a SQL expression over the given Parquet files. Money is exact
before anything is multiplied.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.functions import dates
from tradeledger.sources.schemas import LOST, STAGE_PROBABILITY, TABLES, WON
from tradeledger.star import Star

# Types of the stored tables, given so that no file is opened to infer them.
STORED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}

# Fixed values, in the order the fixture rules number them.
LEAD_SOURCES = (
    "Trade Show", "Referral", "Cold Call", "Website",
    "Partner", "LinkedIn", "Industry Event", "Existing Customer",
)
LOSS_REASONS = (
    "Price", "Competitor", "No Decision", "Budget Constraints",
    "Changed Requirements", "Poor Fit", "Timing",
)
OPEN_STAGE_BY_PRIORITY = {
    "1": "Negotiation", "2": "Proposal", "3": "Needs Analysis",
    "4": "Qualification", "5": "Prospecting",
}
ACTIVITY_TYPES = {
    "click": "Call", "view": "Email", "purchase": "Meeting",
    "signup": "Site Visit", "error": "Follow-up",
}


def star(spark: SparkSession, sf_dir: str) -> Star:
    tables = _Tables(spark, sf_dir)
    return Star(
        spark,
        {
            "territories": tables.territories,
            "distributors": tables.distributors,
            "operators": tables.operators,
            "products": tables.products,
            "sales_reps": tables.sales_reps,
            "sf_accounts": tables.accounts,
            "sf_opportunities": tables.opportunities,
            "sf_activities": tables.activities,
            "shipments": tables.shipments,
        },
        lean_shipments=tables.lean_shipments,
        shipments_near=tables.shipments_near,
        deals_near=tables.deals_near,
    )


class _Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(STORED[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- dimensions -------------------------------------------------------

    def territories(self) -> DataFrame:
        rows = self.read("nation").join(
            self.read("region"), F.expr("n_regionkey = r_regionkey")
        )
        return _shaped(
            rows,
            "territories",
            territory_id="n_nationkey",
            territory_name="n_name",
            region="r_name",
            state="n_name",
        )

    def distributors(self) -> DataFrame:
        return _shaped(
            self.read("supplier"),
            "distributors",
            distributor_id="s_suppkey",
            distributor_name="s_name",
            distributor_type="elt(CAST(s_suppkey % 3 + 1 AS INT), 'National', 'Regional', 'Specialty')",
            territory_id="s_nationkey",
        )

    def operators(self) -> DataFrame:
        suppliers = self.read("supplier").selectExpr("nullif(count(*), 0)")
        return _shaped(
            self.read("customer").withColumn("n_suppliers", suppliers.scalar()),
            "operators",
            operator_id="c_custkey",
            operator_name="c_name",
            operator_type="c_mktsegment",
            territory_id="c_nationkey",
            annual_revenue_tier="CASE WHEN c_acctbal < 2500 THEN 'Small'"
            " WHEN c_acctbal < 5000 THEN 'Medium' WHEN c_acctbal < 7500 THEN 'Large'"
            " ELSE 'Enterprise' END",
            primary_distributor_id="IF(c_custkey % 10 = 0, NULL, c_custkey % n_suppliers)",
        )

    def products(self) -> DataFrame:
        return _shaped(
            self.read("part"),
            "products",
            product_id="p_partkey",
            product_name="p_name",
            brand="p_brand",
            category="p_type",
            subcategory="CAST(p_size AS STRING)",
            standard_price="CAST(p_retailprice AS DECIMAL(12,2))",
            cost="CAST(p_retailprice AS DECIMAL(12,2)) * (55 + p_partkey % 21) * 0.01BD",
        )

    def _with_rep_count(self, rows: DataFrame) -> DataFrame:
        """How many reps there are, as ``n_reps``: a scalar subquery, NULL instead of 0."""
        reps = self.read("events").selectExpr("nullif(count(DISTINCT user_id), 0)")
        return rows.withColumn("n_reps", reps.scalar())

    def sales_reps(self) -> DataFrame:
        active = self.read("events").selectExpr("user_id AS c_custkey").distinct()
        return _shaped(
            self.read("customer").join(active, "c_custkey", "left_semi"),
            "sales_reps",
            rep_id="c_custkey",
            rep_name="c_name",
            territory_id="c_nationkey",
            rep_tier="CASE c_custkey % 5 WHEN 0 THEN 'Director' WHEN 1 THEN 'Junior'"
            " ELSE 'Senior' END",
            quota_annual="500000 + (c_custkey * 7919) % 1000001",
        )

    # ---- CRM --------------------------------------------------------------

    def accounts(self) -> DataFrame:
        return _shaped(
            self._with_rep_count(self.read("customer").filter("c_custkey % 5 <> 0")),
            "sf_accounts",
            account_id="c_custkey",
            operator_id="c_custkey",
            owner_id="c_custkey % n_reps",
        )

    def opportunities(self) -> DataFrame:
        return self._opportunities(self.read("orders"))

    def deals_near(self, first: date, last: date) -> DataFrame:
        """A deal closes 7 to 66 days after its order."""
        ordered = F.col("o_orderdate")
        earliest, after = (F.lit(d).cast("timestamp_ntz") for d in (first - timedelta(days=66), last - timedelta(days=6)))
        near = (ordered >= earliest) & (ordered < after)
        return self._opportunities(self.read("orders").filter(near))

    def _opportunities(self, orders: DataFrame) -> DataFrame:
        open_stage = _case("left(o_orderpriority, 1)", OPEN_STAGE_BY_PRIORITY)
        rows = self._with_rep_count(orders.filter("o_custkey % 5 <> 0")).selectExpr(
            "*",
            "CAST(o_orderdate AS DATE) AS created",
            f"CASE o_orderstatus WHEN 'F' THEN '{WON}' WHEN 'P' THEN '{LOST}'"
            f" WHEN 'O' THEN {open_stage} END AS stage",
        )
        return _shaped(
            rows,
            "sf_opportunities",
            opportunity_id="o_orderkey",
            account_id="o_custkey",
            stage="stage",
            amount="CAST(o_totalprice AS DECIMAL(12,2))",
            probability=_case("stage", STAGE_PROBABILITY),
            close_date="date_add(created, CAST(7 + o_orderkey % 60 AS INT))",
            created_date="created",
            owner_id="(o_custkey + IF(o_orderkey % 10 = 0, 1, 0)) % n_reps",
            lead_source=f"elt(CAST(o_orderkey % 8 + 1 AS INT), {_texts(LEAD_SOURCES)})",
            loss_reason=f"IF(stage = '{LOST}' AND o_orderkey % 8 <> 7,"
            f" elt(CAST(o_orderkey % 7 + 1 AS INT), {_texts(LOSS_REASONS)}), NULL)",
        )

    def activities(self) -> DataFrame:
        return _shaped(
            self.read("events"),
            "sf_activities",
            activity_id="event_id",
            account_id="IF(user_id % 5 <> 0, user_id, NULL)",
            owner_id="user_id",
            activity_type=_case("event_type", ACTIVITY_TYPES),
            activity_date="date_add(DATE'1995-01-01', CAST(event_id % 2400 AS INT))",
            duration_minutes="CAST(floor(value) AS INT)",
        )

    # ---- shipments --------------------------------------------------------

    def lean_shipments(self) -> DataFrame:
        return _shipments(self.read("lineitem"), with_operator=False)

    def shipments(self) -> DataFrame:
        return self._with_operators(self.read("lineitem"))

    def shipments_near(self, first: Column, last: Column, first_day: Column, operators: bool) -> DataFrame:
        """Lines shipped from the first day of the first week on; later weeks are filtered afterwards."""
        lines = self.read("lineitem").filter(F.col("l_shipdate") >= first_day.cast("timestamp_ntz"))
        lines = lines.filter(F.col("l_shipdate") < F.date_add(last, 1).cast("timestamp_ntz"))
        return self._with_operators(lines) if operators else _shipments(lines, with_operator=False)

    def _with_operators(self, lines: DataFrame) -> DataFrame:
        """An order names the operator, so this one joins the orders.

        A line whose order is missing is kept, with no operator.
        """
        orders = self.read("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
        return _shipments(
            lines.join(orders, "l_orderkey", "left"), with_operator=True
        )


def _shipments(rows: DataFrame, with_operator: bool) -> DataFrame:
    """Amounts are worked out in whole cents and become decimals at the end.

    The stored prices and rates have two decimals, so the nearest integer of a
    hundredfold is exactly the amount in cents or the rate in percent. A
    percentage of cents rounds halves away from zero.
    """

    def percent_of_gross(rate: str) -> str:
        return f"(gross * {rate} + IF(gross * {rate} < 0, -50, 50)) DIV 100"

    rates = rows.selectExpr(
        "*",
        "CAST(l_shipdate AS DATE) AS shipment_date",
        "CAST(rint(l_extendedprice * 100) AS BIGINT) AS gross",
        "CAST(rint(l_discount * 100) AS BIGINT) AS discount_rate",
        "IF(l_returnflag = 'R', CAST(rint(l_tax * 100) AS BIGINT), 0) AS return_rate",
    )
    cents = rates.selectExpr(
        "*",
        f"{percent_of_gross('discount_rate')} AS discount",
        f"{percent_of_gross('return_rate')} AS returned",
        f"{percent_of_gross('(55 + l_partkey % 21)')} AS cost",
    )

    def money(amount: str) -> str:
        return f"CAST(CAST({amount} AS DECIMAL(18,0)) * 0.01BD AS DECIMAL(18,2))"

    return cents.withColumn("week_ending", dates.week_ending("shipment_date")).selectExpr(
        "CAST(NULL AS STRING) AS shipment_id",
        "shipment_date",
        "week_ending",
        "l_suppkey AS distributor_id",
        *(["o_custkey AS operator_id"] if with_operator else []),
        "l_partkey AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        f"{money('gross')} AS gross_sales",
        f"{money('discount')} AS discounts",
        f"{money('returned')} AS returns",
        f"{money('gross - discount - returned')} AS net_sales",
        f"{money('cost')} AS cost_of_goods",
    )


def _texts(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(key: str, table: dict) -> str:
    arms = " ".join(f"WHEN '{name}' THEN {value!r}" for name, value in table.items())
    return f"CASE {key} {arms} END"


def _shaped(rows: DataFrame, table: str, **columns: str) -> DataFrame:
    """The canonical columns in order; those the fixtures lack are typed NULLs.

    Keys keep the fixtures' integer type.
    """
    selected = []
    for field in TABLES[table].fields:
        value = columns.get(field.name, "NULL")
        if value == "NULL" or not field.name.endswith("_id"):
            value = f"CAST({value} AS {field.dataType.simpleString()})"
        selected.append(f"{value} AS {field.name}")
    return rows.selectExpr(*selected)
