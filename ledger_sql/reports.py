"""SQL for the reports."""

from __future__ import annotations

from ledger_sql.tables import dbl, pct, ratio, rounded

YEAR = 2000

# Deal sums per group, every measure the reports need.
_DEALS = """
    COUNT(*) AS opportunities,
    COUNT(*) FILTER (WHERE stage = 'Closed Won') AS won,
    COUNT(*) FILTER (WHERE stage = 'Closed Lost') AS lost,
    COALESCE(SUM(amount) FILTER (WHERE stage = 'Closed Won'), 0) AS revenue,
    COUNT(amount) FILTER (WHERE stage = 'Closed Won') AS priced_wins"""

_ACTS = """
    COUNT(*) AS activities,
    COUNT(*) FILTER (WHERE activity_type = 'Call') AS calls,
    COUNT(*) FILTER (WHERE activity_type = 'Meeting') AS meetings,
    COUNT(*) FILTER (WHERE activity_type = 'Site Visit') AS site_visits"""

_OPEN = "stage NOT IN ('Closed Won', 'Closed Lost')"
_MONTH = "strftime(week_ending, '%Y-%m')"


def _reps(
    directors: bool = False, where: str = "TRUE", territory: str = "LEFT", region: str | None = None,
    acts: str = "TRUE",
) -> str:
    keep = "TRUE" if directors else "r.rep_tier <> 'Director'"
    if region:
        keep += f" AND t.region = '{region}'"
    return f"""(
        SELECT r.rep_id, r.rep_name, r.rep_tier, r.quota_annual, t.territory_name, t.region,
               COALESCE(d.opportunities, 0) AS opportunities, COALESCE(d.won, 0) AS won,
               COALESCE(d.lost, 0) AS lost, COALESCE(d.revenue, 0) AS revenue,
               {ratio('d.revenue', 'd.priced_wins', 2)} AS avg_deal,
               COALESCE(a.activities, 0) AS activities, COALESCE(a.calls, 0) AS calls,
               COALESCE(a.meetings, 0) AS meetings, COALESCE(a.site_visits, 0) AS site_visits
        FROM sales_reps r
        {territory} JOIN territories t ON t.territory_id = r.territory_id
        LEFT JOIN (SELECT owner_id, {_DEALS} FROM sf_opportunities WHERE {where}
                   GROUP BY owner_id) d ON d.owner_id = r.rep_id
        LEFT JOIN (SELECT owner_id, {_ACTS} FROM sf_activities WHERE {acts}
                   GROUP BY owner_id) a
               ON a.owner_id = r.rep_id
        WHERE {keep})"""


_RANKINGS = f"""
    SELECT rep_id, rep_name, rep_tier, territory_name, region, {dbl('quota_annual')} AS quota_annual,
           opportunities, won, lost, {pct('won', 'won + lost')} AS win_rate,
           {dbl('revenue')} AS revenue, avg_deal,
           {pct('revenue', 'quota_annual')} AS quota_attainment,
           activities, {ratio('activities', 'opportunities', 1)} AS activities_per_opp
    FROM """


def _yearly_by_distributor(year: int | None = None, extra: str = "") -> str:
    only = "" if year is None else f"AND c.year = {year}"
    return f"""(
        SELECT c.year, d.distributor_name, d.distributor_type, c.net_sales,
               p.net_sales AS prior
        FROM (SELECT distributor_id, CAST(YEAR(week_ending) AS INT) AS year, SUM(net_sales) AS net_sales
              FROM shipments GROUP BY ALL) c
        JOIN distributors d ON d.distributor_id = c.distributor_id
        LEFT JOIN (SELECT distributor_id, CAST(YEAR(week_ending) AS INT) AS year, SUM(net_sales) AS net_sales
                   FROM shipments GROUP BY ALL) p
               ON p.distributor_id = c.distributor_id AND p.year = c.year - 1
        WHERE TRUE {only} {extra})"""


def _growth(year: int | None = None, extra: str = "") -> str:
    return f"""
    SELECT year, distributor_name, distributor_type, {dbl('net_sales')} AS net_sales,
           {dbl('prior')} AS prior_year, {pct('net_sales - prior', 'prior')} AS yoy_growth
    FROM {_yearly_by_distributor(year, extra)}"""


_TRAILING = """(SELECT * FROM shipments WHERE week_ending >=
    (SELECT MAX(week_ending) - INTERVAL 12 MONTH FROM shipments))"""


def _scorecards(where: str = "TRUE", keep: str = "TRUE") -> str:
    return f"""(
        SELECT d.distributor_id, d.distributor_name, d.distributor_type, t.region,
               COALESCE(s.active_operators, 0) AS active_operators,
               COALESCE(s.products_sold, 0) AS products_sold, s.total_units,
               s.net_sales, s.gross_sales, {pct('s.returns', 's.gross_sales', 2)} AS return_rate,
               s.net_sales - s.cogs AS gross_margin
        FROM distributors d
        LEFT JOIN territories t ON t.territory_id = d.territory_id
        LEFT JOIN (SELECT distributor_id, COUNT(DISTINCT operator_id) AS active_operators,
                          COUNT(DISTINCT product_id) AS products_sold, SUM(quantity) AS total_units,
                          SUM(net_sales) AS net_sales, SUM(gross_sales) AS gross_sales,
                          SUM(returns) AS returns, SUM(cost_of_goods) AS cogs
                   FROM shipments WHERE {where} GROUP BY distributor_id) s
               ON s.distributor_id = d.distributor_id
        WHERE {keep})"""


def _scorecard_report(where: str = "TRUE", keep: str = "TRUE") -> str:
    return f"""
    SELECT distributor_id, distributor_name, distributor_type, region, active_operators,
           products_sold, {dbl('total_units')} AS total_units, {dbl('net_sales')} AS net_sales,
           {dbl('gross_sales')} AS gross_sales, return_rate, {dbl('gross_margin')} AS gross_margin
    FROM {_scorecards(where, keep)}""".replace(dbl("total_units"), "CAST(total_units AS BIGINT)")


def _members(table: str, name: str) -> str:
    return f"""LEFT JOIN (SELECT territory_id, COUNT(*) AS {name} FROM {table}
                          GROUP BY territory_id) USING (territory_id)"""


def _sales(where: str = "TRUE") -> str:
    return f"""LEFT JOIN (SELECT o.territory_id, SUM(s.net_sales) AS net_sales
                          FROM shipments s JOIN operators o ON o.operator_id = s.operator_id
                          WHERE {where} GROUP BY o.territory_id) USING (territory_id)"""


def _territory_deals(where: str = "TRUE") -> str:
    return f"""
    LEFT JOIN (SELECT o.territory_id, COUNT(*) AS opportunities,
                      COALESCE(SUM(q.amount) FILTER (WHERE q.stage = 'Closed Won'), 0) AS revenue_won
               FROM sf_opportunities q JOIN sf_accounts a ON a.account_id = q.account_id
               JOIN operators o ON o.operator_id = a.operator_id
               WHERE {where} GROUP BY o.territory_id) USING (territory_id)"""


def _heatmap(where: str = "TRUE", keep: str = "TRUE", deals: str = "TRUE") -> str:
    return f"""(
        SELECT territory_id, territory_name, region, state, COALESCE(n_operators, 0) AS operators,
               COALESCE(n_reps, 0) AS reps, net_sales,
               COALESCE(opportunities, 0) AS opportunities, COALESCE(revenue_won, 0) AS revenue_won
        FROM territories {_members('operators', 'n_operators')} {_members('sales_reps', 'n_reps')}
             {_sales(where)} {_territory_deals(deals)}
        WHERE {keep})"""


def _heatmap_report(where: str = "TRUE", keep: str = "TRUE", deals: str = "TRUE") -> str:
    return f"""
    SELECT territory_id, territory_name, region, state, operators, reps,
           {dbl('net_sales')} AS net_sales, opportunities, {dbl('revenue_won')} AS revenue_won
    FROM {_heatmap(where, keep, deals)}"""


def _stages(where: str = "TRUE") -> str:
    return f"""(
    SELECT stage, COUNT(*) AS n, SUM(amount) AS value, AVG(probability) AS avg_probability,
           SUM(amount * probability * CAST(0.01 AS DECIMAL(3,2))) AS weighted
    FROM sf_opportunities WHERE {_OPEN} AND {where} GROUP BY stage)"""


_STAGES = _stages()

_MONTHS = """
    SELECT {columns} FROM (
        SELECT strftime(week_ending, '%Y-%m') AS month, SUM(net_sales) AS net,
               CAST(SUM(quantity) AS BIGINT) AS units,
               COUNT(DISTINCT operator_id) AS active_operators,
               SUM(net_sales) - SUM(cost_of_goods) AS margin
        FROM shipments WHERE {where} GROUP BY 1)"""


def _months(columns: str, where: str = "TRUE") -> str:
    return _MONTHS.format(columns=columns, where=where)


def _deal_totals(where: str = "TRUE") -> str:
    return f"""(
    SELECT COUNT(*) AS total_opportunities,
           COUNT(*) FILTER (WHERE stage = 'Closed Won') AS won_deals,
           COUNT(*) FILTER (WHERE stage = 'Closed Lost') AS lost_deals,
           COALESCE(SUM(amount) FILTER (WHERE stage = 'Closed Won'), 0) AS revenue_won,
           COUNT(amount) FILTER (WHERE stage = 'Closed Won') AS priced_wins,
           COALESCE(SUM(amount) FILTER (WHERE {_OPEN}), 0) AS pipeline_value
    FROM sf_opportunities WHERE {where})"""


_DEAL_TOTALS = _deal_totals()

_WIN = "COALESCE(win_rate, 0)"


def _compact(value: str, plain: str, prefix: str = "") -> str:
    """The B / M / K tiers as text."""
    v = f"CAST({value} AS DECIMAL(38,8))"

    def tier(power: int, digits: int, unit: str) -> str:
        part = f"CAST({v} AS DOUBLE) / 1e{power}"
        shown = f"CAST(ROUND(CAST({part} AS DECIMAL(38,8)), {digits}) AS DECIMAL(38,{digits}))"
        return f"CAST({shown} AS VARCHAR) || '{unit}'"

    return f"""'{prefix}' || CASE WHEN {v} >= 1000000000 THEN {tier(9, 2, 'B')}
        WHEN {v} >= 1000000 THEN {tier(6, 2, 'M')} WHEN {v} >= 1000 THEN {tier(3, 1, 'K')}
        ELSE {plain} END"""


def _compact_money(value: str) -> str:
    cents = f"CAST(CAST(ROUND(CAST({value} AS DECIMAL(38,8)), 2) AS DECIMAL(38,2)) AS VARCHAR)"
    return _compact(value, cents, "$")


def _compact_count(value: str) -> str:
    return _compact(value, f"CAST({value} AS VARCHAR)")


def _percent_text(value: str) -> str:
    return f"CAST(CAST(ROUND(CAST({value} AS DECIMAL(38,8)), 1) AS DECIMAL(38,1)) AS VARCHAR) || '%'"


def _printed(sql: str, columns: str, money: str = "", percent: str = "") -> str:
    """A report with its money and percent columns as text."""
    shown = []
    for c in columns.split():
        if c in money.split():
            shown.append(f"'$' || format('{{:,.2f}}', COALESCE({c}, 0)) AS {c}")
        elif c in percent.split():
            shown.append(f"format('{{:.1f}}%', {c}) AS {c}")
        else:
            shown.append(c)
    return f"SELECT {', '.join(shown)} FROM ({sql}) report"


def _top(sql: str, order: str, n: int) -> str:
    return f"{sql} ORDER BY {order} LIMIT {n}"


REPORTS: dict[str, str] = {}

# ---- analyst queries ------------------------------------------------------

REPORTS["q01_distributor_yoy"] = f"""
    SELECT distributor_name, distributor_type, year, {dbl('net_sales')} AS current_year_sales,
           {dbl('prior')} AS prior_year_sales, {pct('net_sales - prior', 'prior')} AS yoy_growth
    FROM {_yearly_by_distributor(YEAR)}"""

REPORTS["q02_rep_win_rate"] = f"""
    SELECT rep_name, rep_tier, territory_name, opportunities AS total_opportunities, won, lost,
           {pct('won', 'won + lost')} AS win_rate_pct, {dbl('revenue')} AS revenue_won
    FROM {_reps(territory='INNER')} WHERE opportunities > 0
    ORDER BY revenue DESC NULLS LAST, rep_id LIMIT 20"""

REPORTS["q03_lead_source_deals"] = f"""
    SELECT lead_source, opportunities AS total_deals, won AS won_deals,
           {pct('won', 'opportunities')} AS win_rate,
           {ratio('revenue', 'priced_wins', 2)} AS avg_deal_size, {dbl('revenue')} AS total_revenue
    FROM (SELECT lead_source, {_DEALS} FROM sf_opportunities
          WHERE stage IN ('Closed Won', 'Closed Lost') GROUP BY lead_source)"""

REPORTS["q04_active_operators"] = f"""
    SELECT d.distributor_name, d.distributor_type, s.active_operators, s.unique_products,
           s.total_units, {dbl('s.net')} AS net_sales,
           {ratio('s.net', 's.active_operators', 2)} AS revenue_per_operator
    FROM (SELECT distributor_id, COUNT(DISTINCT operator_id) AS active_operators,
                 COUNT(DISTINCT product_id) AS unique_products,
                 CAST(SUM(quantity) AS BIGINT) AS total_units, SUM(net_sales) AS net
          FROM {_TRAILING} GROUP BY distributor_id) s
    JOIN distributors d ON d.distributor_id = s.distributor_id"""

REPORTS["q05_activity_revenue"] = f"""
    SELECT rep_name, activities AS total_activities, calls, meetings, site_visits,
           {dbl('revenue')} AS revenue, {ratio('revenue', 'activities', 2)} AS revenue_per_activity
    FROM {_reps()} WHERE activities > 0
    ORDER BY revenue DESC NULLS LAST, rep_id LIMIT 20"""

REPORTS["q06_pipeline_by_stage"] = f"""
    SELECT stage, n AS opportunity_count, {dbl('value')} AS pipeline_value,
           {rounded('avg_probability', 0)} AS avg_probability, {dbl('weighted')} AS weighted_value,
           {pct('value', f'(SELECT SUM(amount) FROM sf_opportunities WHERE {_OPEN})')} AS pct_of_pipeline
    FROM {_STAGES}"""

_Q07 = f"""month, {dbl('net')} AS net_sales, units, active_operators,
    {dbl('margin')} AS gross_margin, {pct('margin', 'net')} AS margin_pct"""
REPORTS["q07_monthly_sales_trend"] = _top(_months(_Q07), "month DESC NULLS LAST", 24)

REPORTS["q08_territory_ranking"] = f"""
    SELECT territory_name, region, state, operators, reps,
           COALESCE({dbl('net_sales')}, 0) AS net_sales,
           COALESCE({ratio('net_sales', 'reps', 2)}, 0) AS sales_per_rep
    FROM {_heatmap()}"""

REPORTS["q09_top_products"] = f"""
    SELECT p.product_name, p.brand, p.category, p.subcategory, s.units_sold,
           {dbl('s.net')} AS net_sales, {dbl('s.net - s.cogs')} AS gross_margin,
           {pct('s.net - s.cogs', 's.net')} AS margin_pct
    FROM (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS units_sold, SUM(net_sales) AS net,
                 SUM(cost_of_goods) AS cogs FROM shipments GROUP BY product_id) s
    JOIN products p ON p.product_id = s.product_id
    ORDER BY s.net DESC NULLS LAST, s.product_id LIMIT 25"""

REPORTS["q10_loss_reasons"] = f"""
    SELECT COALESCE(loss_reason, 'Unknown') AS loss_reason, COUNT(*) AS lost_deals,
           {dbl('SUM(amount)')} AS lost_revenue,
           {pct('COUNT(*)', "(SELECT COUNT(*) FROM sf_opportunities WHERE stage = 'Closed Lost')")}
             AS pct_of_losses,
           {ratio('SUM(amount)', 'COUNT(amount)', 2)} AS avg_deal_size
    FROM sf_opportunities WHERE stage = 'Closed Lost' GROUP BY 1"""

_MONTH_NET = """(SELECT CAST(YEAR(week_ending) AS INT) AS y, CAST(MONTH(week_ending) AS INT) AS m, SUM(net_sales) AS net
                 FROM shipments GROUP BY 1, 2)"""
REPORTS["q11_seasonality"] = f"""
    SELECT m AS month_num, monthname(make_date(2000, m, 1)) AS month_name,
           {rounded(ratio('SUM(net)', 'COUNT(net)'), 2)} AS avg_monthly_sales,
           {pct(ratio('SUM(net)', 'COUNT(net)'),
                f"(SELECT {ratio('SUM(net)', 'COUNT(net)')} FROM {_MONTH_NET})")} AS seasonality_index
    FROM {_MONTH_NET} GROUP BY m"""

# ---- views ----------------------------------------------------------------

def _scorecard_view(keep: str = "TRUE") -> str:
    return f"""
    SELECT d.distributor_id, d.distributor_name, d.distributor_type, t.region, s.year, s.month,
           COALESCE(s.active_operators, 0) AS active_operators,
           COALESCE(s.products_sold, 0) AS products_sold, s.total_units,
           {dbl('s.gross')} AS gross_sales, {dbl('s.net')} AS net_sales,
           {dbl('s.back')} AS total_returns, {dbl('s.net - s.cogs')} AS gross_margin
    FROM distributors d
    LEFT JOIN territories t ON t.territory_id = d.territory_id
    LEFT JOIN (SELECT distributor_id, CAST(YEAR(week_ending) AS INT) AS year, CAST(MONTH(week_ending) AS INT) AS month,
                      COUNT(DISTINCT operator_id) AS active_operators,
                      COUNT(DISTINCT product_id) AS products_sold,
                      CAST(SUM(quantity) AS BIGINT) AS total_units, SUM(gross_sales) AS gross,
                      SUM(net_sales) AS net, SUM(returns) AS back, SUM(cost_of_goods) AS cogs
               FROM shipments GROUP BY 1, 2, 3) s ON s.distributor_id = d.distributor_id
    WHERE {keep}"""


REPORTS["vw_distributor_scorecard"] = _scorecard_view()

REPORTS["vw_rep_performance"] = f"""
    SELECT r.rep_id, r.rep_name, r.rep_tier, t.territory_name, t.region, d.year,
           COALESCE(d.opportunities, 0) AS total_opportunities, COALESCE(d.won, 0) AS won_deals,
           COALESCE(d.lost, 0) AS lost_deals, {pct('d.won', 'd.opportunities')} AS win_rate_all,
           COALESCE({dbl('d.revenue')}, 0) AS total_revenue,
           {ratio('d.revenue', 'd.priced_wins', 2)} AS avg_deal_size,
           COALESCE(a.activities, 0) AS total_activities
    FROM sales_reps r
    LEFT JOIN territories t ON t.territory_id = r.territory_id
    LEFT JOIN (SELECT owner_id, CAST(YEAR(close_date) AS INT) AS year, {_DEALS} FROM sf_opportunities
               GROUP BY 1, 2) d ON d.owner_id = r.rep_id
    LEFT JOIN (SELECT owner_id, CAST(YEAR(activity_date) AS INT) AS year, COUNT(*) AS activities
               FROM sf_activities GROUP BY 1, 2) a
           ON a.owner_id = d.owner_id AND a.year = d.year"""

REPORTS["vw_pipeline_health"] = f"""
    SELECT strftime(created_date, '%Y-%m') AS period, stage, COUNT(*) AS opportunity_count,
           {dbl('SUM(amount)')} AS pipeline_value, AVG(probability) AS avg_probability,
           {dbl('SUM(amount * probability * CAST(0.01 AS DECIMAL(3,2)))')} AS weighted_pipeline
    FROM sf_opportunities WHERE {_OPEN} GROUP BY 1, 2"""

REPORTS["vw_territory_summary"] = f"""
    SELECT territory_id, territory_name, region, state,
           COALESCE(n_operators, 0) AS total_operators, COALESCE(n_reps, 0) AS total_reps,
           COALESCE(n_distributors, 0) AS total_distributors,
           {dbl('net_sales')} AS total_net_sales, COALESCE(opportunities, 0) AS total_opportunities
    FROM territories {_members('operators', 'n_operators')} {_members('sales_reps', 'n_reps')}
         {_members('distributors', 'n_distributors')} {_sales()} {_territory_deals()}"""

# ---- summary tables -------------------------------------------------------

_YEARLY = """(SELECT distributor_id, CAST(YEAR(week_ending) AS INT) AS year, SUM(net_sales) AS net,
                     CAST(SUM(quantity) AS BIGINT) AS units,
                     COUNT(DISTINCT operator_id) AS active_operators
              FROM shipments GROUP BY 1, 2)"""
REPORTS["an_yoy_growth"] = f"""
    SELECT c.year, c.distributor_id, {dbl('c.net')} AS total_net_sales, c.units AS total_quantity,
           c.active_operators, {dbl('p.net')} AS prior_year_sales,
           {pct('c.net - p.net', 'p.net', 2)} AS yoy_growth_pct
    FROM {_YEARLY} c
    LEFT JOIN {_YEARLY} p ON p.distributor_id = c.distributor_id AND p.year + 1 = c.year"""

REPORTS["an_rep_summary"] = f"""
    SELECT rep_id, rep_name, rep_tier, territory_name, region,
           opportunities AS total_opportunities, won AS won_deals, lost AS lost_deals,
           {pct('won', 'opportunities')} AS win_rate_all, {dbl('revenue')} AS total_revenue,
           avg_deal AS avg_deal_size, activities AS total_activities
    FROM {_reps(directors=True)}"""

REPORTS["an_monthly_trend"] = f"""
    SELECT strftime(week_ending, '%Y-%m') AS month, {dbl('SUM(net_sales)')} AS net_sales,
           {dbl('SUM(gross_sales)')} AS gross_sales, {dbl('SUM(returns)')} AS returns,
           CAST(SUM(quantity) AS BIGINT) AS quantity,
           COUNT(DISTINCT operator_id) AS active_operators,
           COUNT(DISTINCT distributor_id) AS active_distributors,
           COUNT(DISTINCT product_id) AS products_sold
    FROM shipments GROUP BY 1"""

# ---- KPI products ---------------------------------------------------------

def _executive_summary(sold: str = "TRUE", deals: str = "TRUE") -> str:
    return f"""
    SELECT {dbl('s.net')} AS total_net_sales, {dbl('s.gross')} AS total_gross_sales,
           {dbl('s.net - s.cogs')} AS gross_margin, {pct('s.net - s.cogs', 's.net')} AS margin_pct,
           s.total_units, s.total_operators, s.total_distributors, s.total_shipments,
           o.total_opportunities, o.won_deals, o.lost_deals,
           {pct('o.won_deals', 'o.won_deals + o.lost_deals')} AS win_rate,
           {dbl('o.revenue_won')} AS revenue_won,
           {ratio('o.revenue_won', 'o.priced_wins', 2)} AS avg_deal_size,
           {dbl('o.pipeline_value')} AS pipeline_value
    FROM (SELECT SUM(net_sales) AS net, SUM(gross_sales) AS gross, SUM(cost_of_goods) AS cogs,
                 CAST(SUM(quantity) AS BIGINT) AS total_units,
                 COUNT(DISTINCT operator_id) AS total_operators,
                 COUNT(DISTINCT distributor_id) AS total_distributors,
                 COUNT(*) AS total_shipments FROM shipments WHERE {sold}) s, {_deal_totals(deals)} o"""


REPORTS["kpi_executive_summary"] = _executive_summary()

REPORTS["kpi_yoy_growth"] = _growth()
REPORTS["kpi_distributor_scorecards"] = _scorecard_report()
REPORTS["kpi_rep_rankings"] = _RANKINGS + _reps()
REPORTS["kpi_territory_heatmap"] = _heatmap_report()

def _pipeline_health(where: str = "TRUE") -> str:
    return f"""
    SELECT stage, n AS count, {dbl('value')} AS value, avg_probability,
           {dbl('weighted')} AS weighted_value FROM {_stages(where)}"""


REPORTS["kpi_pipeline_health"] = _pipeline_health()

REPORTS["kpi_monthly_trends"] = _months(
    f"month, {dbl('net')} AS net_sales, units, active_operators, {dbl('margin')} AS gross_margin"
)

def _activity_correlation(**reps: str) -> str:
    return f"""
    SELECT rep_id, rep_name, activities AS total_activities, calls, meetings, site_visits,
           {dbl('revenue')} AS revenue FROM {_reps(**reps)} WHERE activities > 0"""


REPORTS["kpi_activity_correlation"] = _activity_correlation()

# ---- other documented queries ---------------------------------------------

REPORTS["readme_net_sales_margin"] = f"""
    SELECT {dbl('SUM(net_sales)')} AS total_net_sales,
           {dbl('SUM(gross_sales - cost_of_goods)')} AS gross_margin,
           {pct('SUM(gross_sales - cost_of_goods)', 'SUM(gross_sales)', 2)} AS margin_pct
    FROM shipments"""

REPORTS["readme_win_rate"] = f"""
    SELECT {pct('won_deals', 'won_deals + lost_deals', 2)} AS win_rate FROM {_DEAL_TOTALS}"""

_YEARS = """(SELECT CAST(YEAR(week_ending) AS INT) AS year, SUM(net_sales) AS net, MAX(MONTH(week_ending)) AS last
             FROM shipments GROUP BY 1)"""
REPORTS["readme_yoy_total"] = f"""
    SELECT c.year, {pct('c.net - p.net', 'p.net', 2)} AS yoy_growth_pct
    FROM {_YEARS} c JOIN {_YEARS} p ON p.year + 1 = c.year"""

REPORTS["yoy_total_latest"] = f"""
    SELECT c.year, {dbl('c.net')} AS net_sales, {dbl('p.net')} AS prior_year,
           {pct('c.net - p.net', 'p.net')} AS yoy_growth
    FROM {_YEARS} c JOIN {_YEARS} p ON p.year + 1 = c.year
    WHERE c.last = 12 ORDER BY c.year DESC LIMIT 1"""

REPORTS["shipment_monthly_summary"] = f"""
    SELECT CAST(YEAR(week_ending) AS INT) AS year, CAST(MONTH(week_ending) AS INT) AS month, COUNT(*) AS shipment_count,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity, {dbl('SUM(gross_sales)')} AS gross_sales,
           {dbl('SUM(net_sales)')} AS net_sales, {dbl('SUM(returns)')} AS returns,
           COUNT(DISTINCT operator_id) AS active_operators,
           COUNT(DISTINCT distributor_id) AS active_distributors
    FROM shipments GROUP BY 1, 2"""

# ---- dashboard roll-ups ---------------------------------------------------

def _region_sales(where: str = "TRUE") -> str:
    return f"""
    SELECT COALESCE(region, 'Unknown') AS region, COALESCE({dbl('SUM(net_sales)')}, 0) AS net_sales
    FROM {_scorecards(where)} GROUP BY 1"""


def _top_distributors(where: str = "TRUE") -> str:
    return f"""
    SELECT distributor_id, distributor_name, LEFT(distributor_name, 15) AS label,
           {dbl('net_sales')} AS net_sales
    FROM {_scorecards(where)} c ORDER BY c.net_sales DESC NULLS LAST, distributor_id LIMIT 8"""


def _top_reps(**reps: str) -> str:
    return f"""
    SELECT rep_name, COALESCE(territory_name, 'N/A') AS territory_name, revenue, win_rate,
           CASE WHEN {_WIN} >= 40 THEN 'success' ELSE 'warning' END AS win_band, won
    FROM ({_RANKINGS} {_reps(**reps)}) ORDER BY revenue DESC NULLS LAST, rep_id LIMIT 5"""


REPORTS["dash_region_sales"] = _region_sales()
REPORTS["dash_top_distributors"] = _top_distributors()
REPORTS["dash_top_reps"] = _top_reps()

REPORTS["dash_yoy_top"] = f"""
    SELECT distributor_name, distributor_type, net_sales, yoy_growth,
           CASE WHEN COALESCE(yoy_growth, 0) >= 0 THEN 'success' ELSE 'danger' END AS band
    FROM ({_growth(YEAR)}) ORDER BY net_sales DESC NULLS LAST, distributor_name LIMIT 5"""

def _leaderboard(**reps: str) -> str:
    return f"""
    SELECT ROW_NUMBER() OVER (ORDER BY revenue DESC NULLS LAST, rep_id) AS rank,
           ROW_NUMBER() OVER (ORDER BY revenue DESC NULLS LAST, rep_id) <= 3 AS top_three,
           rep_id, rep_name, COALESCE(rep_tier, 'N/A') AS rep_tier,
           COALESCE(territory_name, 'N/A') AS territory_name, revenue, win_rate,
           CASE WHEN {_WIN} >= 40 THEN 'success' WHEN {_WIN} >= 25 THEN 'warning'
                ELSE 'danger' END AS win_band,
           won, opportunities, avg_deal, quota_attainment,
           CASE WHEN COALESCE(quota_attainment, 0) >= 100 THEN 'success'
                ELSE 'warning' END AS quota_band,
           activities
    FROM ({_RANKINGS} {_reps(**reps)})"""


REPORTS["dash_rep_leaderboard"] = _leaderboard()

REPORTS["dash_region_rollup"] = f"""
    SELECT COALESCE(region, 'Unknown') AS region, COUNT(*) AS territories,
           COALESCE({dbl('SUM(net_sales)')}, 0) AS net_sales,
           CAST(SUM(operators) AS BIGINT) AS operators
    FROM {_heatmap()} GROUP BY 1"""

REPORTS["dash_top_territories"] = f"""
    SELECT territory_name, state, region, COALESCE({dbl('net_sales')}, 0) AS net_sales,
           operators, reps
    FROM {_heatmap()} h ORDER BY h.net_sales DESC NULLS LAST, territory_id LIMIT 10"""

REPORTS["dash_pipeline_funnel"] = f"""
    SELECT stage, n AS count, {dbl('value')} AS value,
           {pct('value', 'MAX(value) OVER ()', 2)} AS pct_of_largest
    FROM {_STAGES}"""

REPORTS["dash_pipeline_totals"] = f"""
    SELECT COALESCE({dbl('SUM(value)')}, 0) AS total_value,
           COALESCE({dbl('SUM(weighted)')}, 0) AS weighted_value,
           COALESCE(CAST(SUM(n) AS BIGINT), 0) AS open_count
    FROM {_STAGES}"""

REPORTS["dash_stage_share"] = f"""
    SELECT stage, {pct('value', 'SUM(value) OVER ()')} AS pct_of_pipeline FROM {_STAGES}"""

def _distributor_totals(keep: str = "TRUE") -> str:
    return f"""
    SELECT COUNT(*) AS distributors, COALESCE({dbl('SUM(net_sales)')}, 0) AS net_sales,
           CAST(SUM(active_operators) AS BIGINT) AS operators_served,
           MAX(products_sold) AS max_products
    FROM {_scorecards(keep=keep)}"""


REPORTS["dash_distributor_totals"] = _distributor_totals()

def _rep_totals(**reps: str) -> str:
    return f"""
    SELECT COUNT(*) AS reps,
           {ratio(f'SUM(CAST({_WIN} AS DECIMAL(18,1)))', 'COUNT(*)', 1)} AS avg_win_rate,
           {ratio('SUM(CAST(COALESCE(avg_deal, 0) AS DECIMAL(18,2)))', 'COUNT(*)', 2)} AS avg_deal,
           COALESCE(CAST(SUM(activities) AS BIGINT), 0) AS total_activities
    FROM ({_RANKINGS} {_reps(**reps)})"""


REPORTS["dash_rep_totals"] = _rep_totals()

def _win_rate_by_tier(**reps: str) -> str:
    return f"""
    SELECT COALESCE(rep_tier, 'Unknown') AS rep_tier, COUNT(*) AS reps,
           {ratio(f'SUM(CAST({_WIN} AS DECIMAL(18,1)))', 'COUNT(*)', 2)} AS avg_win_rate
    FROM ({_RANKINGS} {_reps(**reps)}) GROUP BY 1"""


REPORTS["dash_win_rate_by_tier"] = _win_rate_by_tier()

_BAR = ratio("COALESCE(gross_margin, 0)", "COALESCE(NULLIF(net_sales, 0), 1)", 2, "300.0")


def _margin_bar(keep: str = "TRUE") -> str:
    return f"""
    SELECT distributor_id, distributor_name, {pct('gross_margin', 'net_sales', 2)} AS margin_pct,
           LEAST(100.0::DOUBLE, {_BAR}) AS bar_width
    FROM {_scorecards(keep=keep)}"""


REPORTS["dash_margin_bar"] = _margin_bar()

def _distributor_cards(keep: str = "TRUE") -> str:
    return f"""
    SELECT distributor_id, distributor_name,
           distributor_type || ' / ' || COALESCE(region, 'N/A') AS subtitle,
           {_compact_money('COALESCE(net_sales, 0)')} AS net_sales,
           {_compact_count('active_operators')} AS operators,
           {_compact_count('products_sold')} AS products,
           {_percent_text('COALESCE(return_rate, 0)')} AS return_rate,
           {_compact_money('COALESCE(gross_margin, 0)')} AS margin
    FROM {_scorecards(keep=keep)}"""


REPORTS["dash_distributor_cards"] = _distributor_cards()

def _headline_cards(sold: str = "TRUE", deals: str = "TRUE") -> str:
    return f"""
    SELECT {_compact_money('s.net')} AS total_net_sales, {_compact_count('s.units')} AS total_units,
           {_compact_count('s.ops')} AS active_operators,
           {_percent_text(pct('o.won_deals', 'o.won_deals + o.lost_deals'))} AS win_rate,
           {_compact_money(ratio('o.revenue_won', 'o.priced_wins', 2))} AS avg_deal_size,
           {_compact_money('o.pipeline_value')} AS pipeline_value
    FROM (SELECT SUM(net_sales) AS net, CAST(SUM(quantity) AS BIGINT) AS units,
                 COUNT(DISTINCT operator_id) AS ops FROM shipments WHERE {sold}) s, {_deal_totals(deals)} o"""


REPORTS["dash_headline_cards"] = _headline_cards()

# ---- promised metrics -----------------------------------------------------

REPORTS["win_rate_trend_monthly"] = f"""
    SELECT strftime(close_date, '%Y-%m') AS month,
           COUNT(*) FILTER (WHERE stage = 'Closed Won') AS won,
           COUNT(*) FILTER (WHERE stage = 'Closed Lost') AS lost,
           {pct("COUNT(*) FILTER (WHERE stage = 'Closed Won')", 'COUNT(*)')} AS win_rate
    FROM sf_opportunities WHERE stage IN ('Closed Won', 'Closed Lost') GROUP BY 1"""

REPORTS["deal_velocity"] = f"""
    SELECT q.stage, COALESCE(o.annual_revenue_tier, 'Unknown') AS revenue_tier,
           COUNT(q.close_date - q.created_date) AS deals,
           {ratio('SUM(q.close_date - q.created_date)', 'COUNT(q.close_date - q.created_date)', 1)}
             AS avg_days
    FROM sf_opportunities q
    LEFT JOIN sf_accounts a ON a.account_id = q.account_id
    LEFT JOIN operators o ON o.operator_id = a.operator_id
    GROUP BY 1, 2"""

REPORTS["activity_revenue_corr"] = f"""
    SELECT COUNT(*) AS reps,
           ROUND(corr({dbl('activities')}, {dbl('revenue')}), 6) AS correlation
    FROM {_reps()} WHERE activities > 0"""

# ---- slice filters of the dashboards --------------------------------------

_IN_YEAR = f"YEAR(week_ending) = {YEAR}"
REPORTS["slice_scorecards_year_type"] = _scorecard_report(_IN_YEAR, "distributor_type = 'National'")
REPORTS["slice_scorecard_view_region"] = _scorecard_view(f"t.region = 'ASIA' AND s.year = {YEAR}")
_CLOSED_IN_YEAR = f"YEAR(close_date) = {YEAR}"
_ACTED_IN_YEAR = f"YEAR(activity_date) = {YEAR}"
REPORTS["slice_heatmap_year_region"] = _heatmap_report(_IN_YEAR, "region = 'EUROPE'", _CLOSED_IN_YEAR)
REPORTS["slice_rankings_year_region"] = _RANKINGS + _reps(
    where=_CLOSED_IN_YEAR, region="AMERICA", acts=_ACTED_IN_YEAR
)
REPORTS["slice_rep_performance_year"] = REPORTS["vw_rep_performance"] + f" WHERE d.year = {YEAR}"
REPORTS["slice_executive_summary_year"] = _executive_summary(_IN_YEAR, _CLOSED_IN_YEAR)
REPORTS["slice_pipeline_year"] = _pipeline_health(_CLOSED_IN_YEAR)
REPORTS["slice_headline_cards_year"] = _headline_cards(_IN_YEAR, _CLOSED_IN_YEAR)
REPORTS["slice_region_sales_year"] = _region_sales(_IN_YEAR)
REPORTS["slice_top_distributors_year"] = _top_distributors(_IN_YEAR)
REPORTS["slice_top_reps_year"] = _top_reps(where=_CLOSED_IN_YEAR, acts=_ACTED_IN_YEAR)
REPORTS["slice_distributor_totals_type"] = _distributor_totals("distributor_type = 'Regional'")
REPORTS["slice_distributor_cards_type"] = _distributor_cards("distributor_type = 'Specialty'")
REPORTS["slice_margin_bar_type"] = _margin_bar("distributor_type = 'National'")
REPORTS["slice_leaderboard_region"] = _leaderboard(region="ASIA")
REPORTS["slice_rep_totals_region"] = _rep_totals(region="EUROPE")
REPORTS["slice_win_rate_tier_region"] = _win_rate_by_tier(region="AFRICA")
REPORTS["slice_activity_correlation_region"] = _activity_correlation(region="AMERICA")
REPORTS["slice_yoy_region"] = _growth(
    YEAR, "AND d.territory_id IN (SELECT territory_id FROM territories WHERE region = 'ASIA')"
)
REPORTS["slice_monthly_trends_year"] = _months(
    f"month, {dbl('net')} AS net_sales, units, active_operators, {dbl('margin')} AS gross_margin",
    _IN_YEAR,
)

# ---- printed forms --------------------------------------------------------

_PRINTED = {
    "q01_distributor_yoy": (
        "distributor_name distributor_type year current_year_sales prior_year_sales yoy_growth",
        "current_year_sales prior_year_sales", "yoy_growth"),
    "q02_rep_win_rate": (
        "rep_name rep_tier territory_name total_opportunities won lost win_rate_pct revenue_won",
        "revenue_won", ""),
    "q03_lead_source_deals": (
        "lead_source total_deals won_deals win_rate avg_deal_size total_revenue",
        "avg_deal_size total_revenue", ""),
    "q04_active_operators": (
        "distributor_name distributor_type active_operators unique_products total_units"
        " net_sales revenue_per_operator", "net_sales revenue_per_operator", ""),
    "q05_activity_revenue": (
        "rep_name total_activities calls meetings site_visits revenue revenue_per_activity",
        "revenue", ""),
    "q06_pipeline_by_stage": (
        "stage opportunity_count pipeline_value avg_probability weighted_value pct_of_pipeline",
        "pipeline_value weighted_value", "pct_of_pipeline"),
    "q07_monthly_sales_trend": (
        "month net_sales units active_operators gross_margin margin_pct",
        "net_sales gross_margin", "margin_pct"),
    "q08_territory_ranking": (
        "territory_name region state operators reps net_sales sales_per_rep",
        "net_sales sales_per_rep", ""),
    "q09_top_products": (
        "product_name brand category subcategory units_sold net_sales gross_margin margin_pct",
        "net_sales gross_margin", "margin_pct"),
    "q10_loss_reasons": (
        "loss_reason lost_deals lost_revenue pct_of_losses avg_deal_size",
        "lost_revenue", "pct_of_losses"),
    "q11_seasonality": (
        "month_num month_name avg_monthly_sales seasonality_index", "avg_monthly_sales", ""),
}
for _key, (_columns, _money, _percent) in _PRINTED.items():
    REPORTS[f"display_{_key}"] = _printed(REPORTS[_key], _columns, _money, _percent)

# ---- sources and sinks ----------------------------------------------------

# What goes through a file comes back unchanged, so the SQL reads the tables.


# Columns by table: what is added up for numbers (n) and dates (d); texts and ids (t) are measured.
_COLUMNS = {
    "territories": "territory_id:t territory_name:t region:t state:t",
    "distributors": "distributor_id:t distributor_name:t distributor_type:t territory_id:t",
    "products": "product_id:t product_name:t brand:t category:t subcategory:t standard_price:n cost:n",
    "sales_reps": "rep_id:t rep_name:t territory_id:t rep_tier:t quota_annual:n",
    "operators": "operator_id:t operator_name:t operator_type:t territory_id:t annual_revenue_tier:t",
    "sf_accounts": "account_id:t operator_id:t owner_id:t",
    "sf_opportunities": "opportunity_id:t account_id:t stage:t amount:n probability:n close_date:d created_date:d"
    " owner_id:t lead_source:t loss_reason:t",
    "sf_activities": "activity_id:t account_id:t owner_id:t activity_type:t activity_date:d duration_minutes:n",
    "shipments": "shipment_date:d week_ending:d distributor_id:t operator_id:t product_id:t quantity:n gross_sales:n"
    " discounts:n returns:n net_sales:n cost_of_goods:n",
}


def _profiles(*names: str) -> str:
    rows = []
    for table in names:
        for column, kind in (c.split(":") for c in _COLUMNS[table].split()):
            total = {
                "n": f"CAST(SUM(CAST({column} AS DECIMAL(28,2))) AS DOUBLE)",
                "d": f"CAST(SUM({column} - DATE '1970-01-01') AS DOUBLE)",
                "t": "CAST(0 AS DOUBLE)",
            }[kind]
            chars = f"COALESCE(SUM(LENGTH(CAST({column} AS VARCHAR))), 0)" if kind == "t" else "0"
            rows.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, COUNT(*) AS row_count,"
                f" COUNT({column}) AS value_count, COALESCE({total}, 0) AS total, CAST({chars} AS BIGINT) AS chars FROM {table}"
            )
    return "\nUNION ALL\n".join(rows)


REPORTS["read_master"] = _profiles("territories", "distributors", "products", "sales_reps", "operators")
REPORTS["read_crm"] = _profiles("sf_accounts", "sf_opportunities", "sf_activities")
REPORTS["read_shipments"] = f"""
    SELECT CAST(YEAR(week_ending) AS INT) AS year, COUNT(*) AS shipment_count,
           CAST(SUM(quantity) AS BIGINT) AS quantity, {dbl('SUM(gross_sales)')} AS gross_sales,
           {dbl('SUM(net_sales)')} AS net_sales, COUNT(DISTINCT operator_id) AS active_operators
    FROM shipments GROUP BY 1"""
REPORTS["write_csv_by_year"] = REPORTS["read_shipments"]
REPORTS["write_star"] = _profiles(*_COLUMNS)
REPORTS["read_json_product"] = REPORTS["kpi_monthly_trends"]
REPORTS["write_rollups"] = REPORTS["kpi_distributor_scorecards"]
REPORTS["write_summary"] = f"""
    SELECT 'analytics_yoy_growth' AS summary, COUNT(*) AS row_count, {dbl('SUM(net)')} AS sales,
           CAST(SUM(active_operators) AS BIGINT) AS counted FROM {_YEARLY}
    UNION ALL
    SELECT 'analytics_rep_summary', COUNT(*), {dbl('SUM(revenue)')}, CAST(SUM(activities) AS BIGINT)
    FROM {_reps(directors=True)}
    UNION ALL
    SELECT 'analytics_monthly_trend', COUNT(*), {dbl('SUM(net)')}, CAST(SUM(products) AS BIGINT)
    FROM (SELECT {_MONTH} AS month, SUM(net_sales) AS net, COUNT(DISTINCT product_id) AS products
          FROM shipments GROUP BY 1)"""
REPORTS["write_json"] = REPORTS["kpi_territory_heatmap"]
REPORTS["append_shipments"] = REPORTS["read_shipments"]
REPORTS["append_rollups"] = REPORTS["kpi_distributor_scorecards"]
_SPOILED = {
    "shipments": "quantity = 50", "sf_opportunities": "stage = 'Closed Lost'", "sales_reps": "rep_tier = 'Director'",
}
REPORTS["read_rejected"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, COUNT(*) - COUNT(CASE WHEN {bad} THEN 1 END) AS good,
        COUNT(CASE WHEN {bad} THEN 1 END) AS rejected, COUNT(CASE WHEN {bad} THEN 1 END) AS with_text,
        COUNT(CASE WHEN {bad} THEN 1 END) AS with_file FROM {name}"""
    for name, bad in ((n, _SPOILED.get(n, "FALSE")) for n in _COLUMNS)
)
REPORTS["state_cube"] = f"""
    SELECT CAST(GROUPING(s.distributor_id, distributor_type, region, YEAR(week_ending)) AS INT) AS slice_id,
           s.distributor_id, distributor_type, region, CAST(YEAR(week_ending) AS INT) AS year,
           CAST(SUM(quantity) AS BIGINT) AS quantity, {dbl('SUM(gross_sales)')} AS gross_sales,
           {dbl('SUM(net_sales)')} AS net_sales, {dbl('SUM(returns)')} AS returns, COUNT(*) AS shipment_count
    FROM shipments s JOIN distributors d ON d.distributor_id = s.distributor_id
    LEFT JOIN territories t ON t.territory_id = d.territory_id
    GROUP BY GROUPING SETS (
        (s.distributor_id, distributor_type, region, YEAR(week_ending)), (s.distributor_id, distributor_type, region),
        (distributor_type, region, YEAR(week_ending)), (distributor_type, region),
        (distributor_type, YEAR(week_ending)), (distributor_type), (region, YEAR(week_ending)), (region),
        (YEAR(week_ending)), ())"""
REPORTS["state_operators"] = """
    SELECT CAST(YEAR(week_ending) AS INT) AS year, distributor_type, COUNT(DISTINCT s.operator_id) AS active_operators
    FROM shipments s JOIN distributors d ON d.distributor_id = s.distributor_id
    JOIN operators o ON o.operator_id = s.operator_id
    GROUP BY 1, 2"""
REPORTS["state_quantities"] = """
    SELECT category, COUNT(quantity) AS n, TRUE AS within
    FROM shipments s LEFT JOIN products p ON p.product_id = s.product_id
    WHERE quantity IS NOT NULL GROUP BY category"""
REPORTS["write_kpi_card"] = REPORTS["kpi_executive_summary"]
REPORTS["read_view"] = """
    SELECT t.region, o.annual_revenue_tier, COUNT(*) AS operators
    FROM operators o JOIN territories t ON t.territory_id = o.territory_id
    GROUP BY t.region, o.annual_revenue_tier"""
