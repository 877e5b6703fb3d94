"""The star as SQL over the test tables, written from FIXTURES.md alone."""

from __future__ import annotations

import re

_MONEY = "DECIMAL(18,2)"
_REPS = "(SELECT COUNT(DISTINCT user_id) FROM events)"
_GROSS = "CAST(l_extendedprice AS DECIMAL(12,2))"


def _share(rate: str) -> str:
    return f"CAST({_GROSS} * CAST({rate} AS DECIMAL(4,2)) AS {_MONEY})"


_SHIPPED = "CAST(l_shipdate AS DATE)"

# The labels in the CASE arms are those FIXTURES.md lists.
TABLES = {
    "territories": """
        SELECT n_nationkey AS territory_id, n_name AS territory_name,
               r_name AS region, n_name AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "distributors": """
        SELECT s_suppkey AS distributor_id, s_name AS distributor_name,
               CASE s_suppkey % 3 WHEN 0 THEN 'National' WHEN 1 THEN 'Regional'
                    ELSE 'Specialty' END AS distributor_type,
               s_nationkey AS territory_id
        FROM supplier""",
    "operators": """
        SELECT c_custkey AS operator_id, c_name AS operator_name, c_mktsegment AS operator_type,
               c_nationkey AS territory_id,
               CASE WHEN c_acctbal < 2500 THEN 'Small' WHEN c_acctbal < 5000 THEN 'Medium'
                    WHEN c_acctbal < 7500 THEN 'Large' ELSE 'Enterprise' END AS annual_revenue_tier,
               CASE WHEN c_custkey % 10 <> 0
                    THEN c_custkey % (SELECT COUNT(*) FROM supplier) END AS primary_distributor_id
        FROM customer""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand,
               p_type AS category, CAST(p_size AS VARCHAR) AS subcategory,
               CAST(p_retailprice AS DECIMAL(12,2)) AS standard_price,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(55 + p_partkey % 21 AS DECIMAL(3,0))
                    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS cost
        FROM part""",
    "sales_reps": """
        SELECT c_custkey AS rep_id, c_name AS rep_name, c_nationkey AS territory_id,
               CASE c_custkey % 5 WHEN 0 THEN 'Director' WHEN 1 THEN 'Junior'
                    ELSE 'Senior' END AS rep_tier,
               CAST(500000 + (c_custkey * 7919) % 1000001 AS DECIMAL(18,2)) AS quota_annual
        FROM customer WHERE c_custkey IN (SELECT user_id FROM events)""",
    "sf_accounts": f"""
        SELECT c_custkey AS account_id, c_custkey AS operator_id, c_custkey % {_REPS} AS owner_id
        FROM customer WHERE c_custkey % 5 <> 0""",
    "sf_opportunities": f"""
        SELECT o_orderkey AS opportunity_id, o_custkey AS account_id,
               CASE o_orderstatus WHEN 'F' THEN 'Closed Won' WHEN 'P' THEN 'Closed Lost'
                    WHEN 'O' THEN CASE LEFT(o_orderpriority, 1)
                         WHEN '1' THEN 'Negotiation' WHEN '2' THEN 'Proposal'
                         WHEN '3' THEN 'Needs Analysis' WHEN '4' THEN 'Qualification'
                         WHEN '5' THEN 'Prospecting' END END AS stage,
               CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'P' THEN 0
                    WHEN 'O' THEN CASE LEFT(o_orderpriority, 1)
                         WHEN '1' THEN 80 WHEN '2' THEN 60 WHEN '3' THEN 40
                         WHEN '4' THEN 25 WHEN '5' THEN 10 END END AS probability,
               CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
               CAST(o_orderdate AS DATE) AS created_date,
               CAST(CAST(o_orderdate AS DATE) + CAST(7 + o_orderkey % 60 AS INT) AS DATE) AS close_date,
               (o_custkey + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END) % {_REPS} AS owner_id,
               CASE o_orderkey % 8 WHEN 0 THEN 'Trade Show' WHEN 1 THEN 'Referral'
                    WHEN 2 THEN 'Cold Call' WHEN 3 THEN 'Website' WHEN 4 THEN 'Partner'
                    WHEN 5 THEN 'LinkedIn' WHEN 6 THEN 'Industry Event'
                    ELSE 'Existing Customer' END AS lead_source,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 8 <> 7 THEN
                    CASE o_orderkey % 7 WHEN 0 THEN 'Price' WHEN 1 THEN 'Competitor'
                         WHEN 2 THEN 'No Decision' WHEN 3 THEN 'Budget Constraints'
                         WHEN 4 THEN 'Changed Requirements' WHEN 5 THEN 'Poor Fit'
                         ELSE 'Timing' END END AS loss_reason
        FROM orders WHERE o_custkey % 5 <> 0""",
    "sf_activities": """
        SELECT event_id AS activity_id,
               CASE WHEN user_id % 5 <> 0 THEN user_id END AS account_id,
               user_id AS owner_id,
               CASE event_type WHEN 'click' THEN 'Call' WHEN 'view' THEN 'Email'
                    WHEN 'purchase' THEN 'Meeting' WHEN 'signup' THEN 'Site Visit'
                    WHEN 'error' THEN 'Follow-up' END AS activity_type,
               CAST(DATE '1995-01-01' + CAST(event_id % 2400 AS INT) AS DATE) AS activity_date,
               CAST(floor(value) AS INT) AS duration_minutes
        FROM events""",
    "shipments": f"""
        SELECT l_suppkey AS distributor_id, o_custkey AS operator_id, l_partkey AS product_id,
               {_SHIPPED} AS shipment_date,
               CAST({_SHIPPED} + CAST(6 - dayofweek({_SHIPPED}) AS INT) AS DATE) AS week_ending,
               CAST(l_quantity AS INT) AS quantity,
               CAST({_GROSS} AS {_MONEY}) AS gross_sales,
               {_share('l_discount')} AS discounts,
               CASE WHEN l_returnflag = 'R' THEN {_share('l_tax')}
                    ELSE CAST(0 AS {_MONEY}) END AS returns,
               CAST({_GROSS} AS {_MONEY}) - {_share('l_discount')}
                 - CASE WHEN l_returnflag = 'R' THEN {_share('l_tax')}
                        ELSE CAST(0 AS {_MONEY}) END AS net_sales,
               {_share('(55 + l_partkey % 21) / 100.0')} AS cost_of_goods
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
}


def with_tables(sql: str) -> str:
    """Put the star tables the statement mentions in front of it."""
    used = [name for name in TABLES if re.search(rf"\b{name}\b", sql)]
    head = ",\n".join(f"{name} AS ({TABLES[name]})" for name in used)
    return f"WITH {head}\n{sql.strip()}"


# ---- number shapes both engines agree on ----------------------------------

def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def rounded(value: str, digits: int) -> str:
    # eight places absorb the binary error of a quotient, so exact halves are seen as such
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def ratio(num: str, den: str, digits: int | None = None, scale: str = "1.0") -> str:
    quotient = f"(CAST({scale} AS DOUBLE) * {dbl(num)} / NULLIF({dbl(den)}, 0))"
    return quotient if digits is None else rounded(quotient, digits)


def pct(num: str, den: str, digits: int = 1) -> str:
    return ratio(num, den, digits, "100.0")
