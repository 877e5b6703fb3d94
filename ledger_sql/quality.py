"""SQL for the quality checks."""

from __future__ import annotations

from ledger_sql.tables import dbl, pct, ratio

QUALITY: dict[str, str] = {}

_TABLES = (
    "territories", "distributors", "operators", "products", "sales_reps",
    "sf_accounts", "sf_opportunities", "sf_activities", "shipments",
)
_REQUIRED = (
    ("distributors", "distributor_name"), ("operators", "operator_name"),
    ("products", "product_name"), ("sales_reps", "rep_name"),
    ("sf_opportunities", "stage"), ("shipments", "net_sales"),
)
_DATED = (
    ("sf_opportunities", "close_date"), ("sf_activities", "activity_date"),
    ("shipments", "week_ending"),
)
_PARENTS = {
    "territory_id": "territories", "primary_distributor_id": "distributors",
    "distributor_id": "distributors", "operator_id": "operators",
    "product_id": "products", "account_id": "sf_accounts",
}
_REFERENCES = (
    ("operators", "territory_id"), ("operators", "primary_distributor_id"),
    ("sf_accounts", "operator_id"), ("sf_opportunities", "account_id"),
    ("sf_activities", "account_id"), ("shipments", "distributor_id"),
    ("shipments", "operator_id"), ("shipments", "product_id"),
)
_KEYS = {
    "territories": "territory_id", "distributors": "distributor_id",
    "operators": "operator_id", "products": "product_id", "sales_reps": "rep_id",
    "sf_accounts": "account_id", "sf_opportunities": "opportunity_id",
    "sf_activities": "activity_id",
    "shipments": "shipment_date, distributor_id, operator_id, product_id",
}
_FANOUT = (
    ("operators", "territory_id"), ("sales_reps", "territory_id"),
    ("distributors", "territory_id"), ("shipments", "operator_id"),
    ("sf_accounts", "operator_id"), ("sf_opportunities", "account_id"),
    ("sf_opportunities", "owner_id"), ("sf_activities", "owner_id"),
)


def _check(
    name: str, table: str, column: str | None, value: str,
    lower: float | None = None, upper: float | None = None, where: str = "",
) -> str:
    """One result row from an aggregate of a table or derived table."""
    low = "CAST(NULL AS DOUBLE)" if lower is None else dbl(str(lower))
    high = "CAST(NULL AS DOUBLE)" if upper is None else dbl(str(upper))
    source = where or f"FROM {table}"
    shown = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    tests = ["o IS NOT NULL"]
    tests += [] if lower is None else [f"o >= {lower}"]
    tests += [] if upper is None else [f"o <= {upper}"]
    return f"""SELECT '{name}' AS "check", '{table}' AS table_name, {shown} AS column_name,
        o AS observed, {low} AS lower, {high} AS upper,
        COALESCE({' AND '.join(tests)}, FALSE) AS passed
        FROM (SELECT {dbl(value)} AS o {source})"""


def _all(checks: list[str]) -> str:
    return "\nUNION ALL\n".join(checks)


def _count(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


_row_counts = [_check("row_count", t, None, "COUNT(*)", lower=1) for t in _TABLES]
_nulls = [_check("nulls", t, c, _count(f"{c} IS NULL"), upper=0) for t, c in _REQUIRED]
_dates = [
    _check(name, t, c, f"CAST(strftime({fn}({c}), '%Y%m%d') AS BIGINT)")
    for t, c in _DATED
    for name, fn in (("first_date", "MIN"), ("last_date", "MAX"))
]
_bounds = [
    _check("date_bounds", t, c,
           _count(f"{c} NOT BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'"), upper=0)
    for t, c in _DATED
]
_win_band = _check(
    "win_rate_band", "sf_opportunities", "stage",
    pct(_count("stage = 'Closed Won'"), _count("stage IN ('Closed Won', 'Closed Lost')")), 25, 55)
_net_band = _check("net_pct_band", "shipments", "net_sales",
                   pct("SUM(net_sales)", "SUM(gross_sales)"), 80, 100)
_deal_band = _check(
    "avg_deal_band", "sf_opportunities", "amount",
    ratio("SUM(amount) FILTER (WHERE stage = 'Closed Won')",
          "COUNT(amount) FILTER (WHERE stage = 'Closed Won')", 2), 5000, 200000)
_net_gross = _check("net_le_gross", "shipments", "net_sales", _count("net_sales > gross_sales"), upper=0)
_net_identity = _check("net_identity", "shipments", "net_sales",
                       _count("net_sales <> gross_sales - discounts - returns"), upper=0)
_caps = [
    _check("discount_cap", "shipments", "discounts",
           _count("discounts > gross_sales * CAST(0.15 AS DECIMAL(5,4))"), upper=0),
    _check("return_cap", "shipments", "returns",
           _count("returns > gross_sales * CAST(0.05 AS DECIMAL(5,4))"), upper=0),
] + [
    _check("negative", "shipments", c, _count(f"{c} < 0"), upper=0)
    for c in ("quantity", "gross_sales", "discounts", "returns", "net_sales")
]
_amounts = _check("deal_amount_range", "sf_opportunities", "amount",
                  _count("amount NOT BETWEEN 5000 AND 500000"), upper=0)


def _orphan(name: str, table: str, column: str, nulls: bool) -> str:
    parent = _PARENTS[column]
    key = _KEYS[parent]
    lost = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
    if not nulls:
        lost += f" AND c.{column} IS NOT NULL"
    return _check(name, table, column, "COUNT(*)", upper=0, where=f"FROM {table} c WHERE {lost}")


_fk = [_orphan("fk_orphans", t, c, False) for t, c in _REFERENCES]
_pk = [
    _check("pk_unique", t, k.replace(", ", "+"), "COALESCE(SUM(n - 1), 0)", upper=0,
           where=f"FROM (SELECT COUNT(*) AS n FROM {t} GROUP BY {k})")
    for t, k in _KEYS.items()
]

QUALITY["dq_row_counts"] = _all(_row_counts)
QUALITY["dq_nulls"] = _all(_nulls)
QUALITY["dq_fk_orphans"] = _all(_fk)
QUALITY["dq_fk_left_join"] = _all(
    [
        _orphan("fk_missing", t, c, True)
        for t, c in (("operators", "territory_id"), ("sf_accounts", "operator_id"),
                     ("sf_opportunities", "account_id"))
    ]
)
QUALITY["dq_date_ranges"] = _all(_dates)
QUALITY["dq_win_rate_band"] = _win_band
QUALITY["dq_net_pct_band"] = _net_band
QUALITY["dq_avg_deal_band"] = _deal_band
QUALITY["dq_summary_stats"] = _all(
    [
        _check("total_net_sales", "shipments", "net_sales", "SUM(net_sales)"),
        _check("total_shipments", "shipments", None, "COUNT(*)"),
        _check("active_operators", "shipments", "operator_id", "COUNT(DISTINCT operator_id)"),
        _check("won_value", "sf_opportunities", "amount",
               "COALESCE(SUM(amount) FILTER (WHERE stage = 'Closed Won'), 0)"),
        _check("open_opportunities", "sf_opportunities", "stage",
               _count("stage NOT IN ('Closed Won', 'Closed Lost')")),
    ]
)
QUALITY["dq_net_le_gross"] = _net_gross
QUALITY["dq_net_identity"] = _net_identity
QUALITY["dq_date_bounds"] = _all(_bounds)
QUALITY["dq_rate_caps"] = _all(_caps)
QUALITY["dq_deal_amount_range"] = _amounts
QUALITY["dq_pk_unique"] = _all(_pk)
QUALITY["dq_join_fanout"] = _all(
    [
        _check(f"join_fanout_{kind}", t, c, value, upper=upper,
               where=f"FROM (SELECT COUNT(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})")
        for t, c in _FANOUT
        for kind, value, upper in (("max", "MAX(n)", 1), ("mean", ratio("SUM(n)", "COUNT(n)", 2), None))
    ]
)

_MARKS = """(SELECT p.category, quantile_cont(s.quantity, 0.25) AS q1,
        quantile_cont(s.quantity, 0.5) AS q2, quantile_cont(s.quantity, 0.75) AS q3
    FROM shipments s LEFT JOIN products p ON p.product_id = s.product_id GROUP BY p.category)"""
_FENCES = f"""(SELECT category, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high,
        3.0 * q2 AS cap FROM {_MARKS})"""
_OUTLIERS = f"""(SELECT f.category, f.low, f.high, f.cap,
        {_count('s.quantity < f.low OR s.quantity > f.high')} AS outliers,
        {_count('s.quantity > f.cap')} AS capped
    FROM shipments s LEFT JOIN products p ON p.product_id = s.product_id
    JOIN {_FENCES} f ON f.category IS NOT DISTINCT FROM p.category GROUP BY 1, 2, 3, 4)"""
QUALITY["dq_quantity_flags"] = f"""
    SELECT COALESCE(p.category, 'Unknown') AS category, COUNT(*) AS shipments,
           {_count('s.quantity < f.low OR s.quantity > f.high')} AS iqr_outliers,
           {_count('s.quantity > f.cap')} AS above_cap, {dbl('SUM(s.quantity)')} AS quantity,
           SUM(CASE WHEN s.quantity > f.cap THEN f.cap ELSE {dbl('s.quantity')} END) AS capped_quantity
    FROM shipments s LEFT JOIN products p ON p.product_id = s.product_id
    LEFT JOIN {_FENCES} f ON f.category IS NOT DISTINCT FROM p.category GROUP BY 1"""
QUALITY["dq_quantity_iqr"] = f"""
    SELECT 'quantity_iqr' AS "check", 'shipments' AS table_name,
           'quantity/' || COALESCE(category, 'Unknown') AS column_name, {dbl('outliers')} AS observed,
           {dbl('low')} AS lower, {dbl('high')} AS upper, outliers = 0 AS passed
    FROM {_OUTLIERS}
    UNION ALL
    SELECT 'quantity_cap', 'shipments', 'quantity/' || COALESCE(category, 'Unknown'),
           {dbl('capped')}, CAST(NULL AS DOUBLE), {dbl('cap')}, capped = 0
    FROM {_OUTLIERS}"""

_EVERYTHING = _all(
    _row_counts + _nulls + _bounds + [_win_band, _net_band, _deal_band, _net_identity, _net_gross]
    + _caps + [_amounts] + _fk + _pk
)
QUALITY["dq_issue_summary"] = f"""
    SELECT COUNT(*) AS checks, {_count('NOT passed')} AS issue_count,
           bool_and(passed) AS all_passed,
           COALESCE(string_agg("check" || ' ' || concat_ws('.', table_name, column_name), '; '
               ORDER BY "check" || ' ' || concat_ws('.', table_name, column_name))
               FILTER (WHERE NOT passed), '') AS issues
    FROM ({_EVERYTHING})"""

QUALITY["dq_while_writing"] = "\nUNION ALL\n".join(
    f"SELECT * FROM ({QUALITY[name]})"
    for name in (
        "dq_row_counts", "dq_nulls", "dq_date_bounds", "dq_win_rate_band", "dq_net_pct_band", "dq_avg_deal_band",
        "dq_net_identity", "dq_net_le_gross", "dq_rate_caps", "dq_deal_amount_range",
    )
)
