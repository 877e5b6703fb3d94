"""Data-quality checks. Every check is one row of a common result frame.

Checks that are aggregates of one table are declared as data and evaluated
together: however many of them look at a table, it is scanned once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions import kpis
from tradeledger.sources.schemas import PRIMARY_KEYS, TABLES
from tradeledger.star import Star

RESULT = ("check", "table_name", "column_name", "observed", "lower", "upper", "passed")

# Required columns, key references and accepted ranges.
REQUIRED = (
    ("distributors", "distributor_name"),
    ("operators", "operator_name"),
    ("products", "product_name"),
    ("sales_reps", "rep_name"),
    ("sf_opportunities", "stage"),
    ("shipments", "net_sales"),
)
FOREIGN_KEYS = (
    ("operators", "territory_id", "territories", "territory_id"),
    ("operators", "primary_distributor_id", "distributors", "distributor_id"),
    ("sf_accounts", "operator_id", "operators", "operator_id"),
    ("sf_opportunities", "account_id", "sf_accounts", "account_id"),
    ("sf_activities", "account_id", "sf_accounts", "account_id"),
    ("shipments", "distributor_id", "distributors", "distributor_id"),
    ("shipments", "operator_id", "operators", "operator_id"),
    ("shipments", "product_id", "products", "product_id"),
)
LOAD_FOREIGN_KEYS = (
    ("operators", "territory_id", "territories", "territory_id"),
    ("sf_accounts", "operator_id", "operators", "operator_id"),
    ("sf_opportunities", "account_id", "sf_accounts", "account_id"),
)
DATED = (
    ("sf_opportunities", "close_date"),
    ("sf_activities", "activity_date"),
    ("shipments", "week_ending"),
)
FANOUT_KEYS = (
    ("operators", "territory_id"),
    ("sales_reps", "territory_id"),
    ("distributors", "territory_id"),
    ("shipments", "operator_id"),
    ("sf_accounts", "operator_id"),
    ("sf_opportunities", "account_id"),
    ("sf_opportunities", "owner_id"),
    ("sf_activities", "owner_id"),
)
FIRST_DAY, LAST_DAY = date(2015, 1, 1), date(2025, 12, 31)
WIN_RATE_BAND = (25.0, 55.0)
NET_PCT_BAND = (80.0, 100.0)
AVG_DEAL_BAND = (5_000.0, 200_000.0)
DEAL_AMOUNT_RANGE = (5_000, 500_000)
DISCOUNT_CAP, RETURN_CAP = "0.15", "0.05"


@dataclass(frozen=True)
class Check:
    """An aggregate of one table and the range it has to lie in.

    ``counts_rows`` marks one that counts a row without any value as well.
    """

    name: str
    table: str
    column: str | None
    value: Callable[[], Column]
    lower: float | None = None
    upper: float | None = None
    reads_operator: bool = False
    counts_rows: bool = False


def run_checks(star: Star, checks: Iterable[Check]) -> DataFrame:
    """Evaluate checks with one pass over each table they mention."""
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    return union(_run_on(star, table, group) for table, group in by_table.items())


def _run_on(star: Star, table: str, checks: list[Check]) -> DataFrame:
    rows = star.table(table)
    if table == "shipments" and not any(c.reads_operator for c in checks):
        rows = star.lean_shipments
    wide = rows.agg(
        *[c.value().cast("double").alias(f"v{i}") for i, c in enumerate(checks)]
    )
    results = [
        F.struct(
            F.lit(c.name).alias("check"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).cast("string").alias("column_name"),
            F.col(f"v{i}").alias("observed"),
            F.lit(c.lower).cast("double").alias("lower"),
            F.lit(c.upper).cast("double").alias("upper"),
        )
        for i, c in enumerate(checks)
    ]
    return judged(wide.select(F.inline(F.array(*results))))


def judged(results: DataFrame) -> DataFrame:
    """A check passes when it observed something and that lies in its range."""
    at_least = F.coalesce(F.col("observed") >= F.col("lower"), F.col("lower").isNull())
    at_most = F.coalesce(F.col("observed") <= F.col("upper"), F.col("upper").isNull())
    passed = F.col("observed").isNotNull() & at_least & at_most
    return results.withColumn("passed", passed).select(*RESULT)


def union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---- declared checks ------------------------------------------------------

def row_count_checks() -> list[Check]:
    return [Check("row_count", t, None, lambda: F.count(F.lit(1)), lower=1, counts_rows=True) for t in TABLES]


def null_checks() -> list[Check]:
    return [
        Check("nulls", t, c, lambda c=c: F.count_if(F.col(c).isNull()), upper=0, counts_rows=True)
        for t, c in REQUIRED
    ]


def date_range_checks(
    first: date | None = None, last: date | None = None
) -> list[Check]:
    """Earliest and latest day as yyyymmdd; without bounds any day passes."""
    low = None if first is None else float(first.strftime("%Y%m%d"))
    high = None if last is None else float(last.strftime("%Y%m%d"))
    checks = []
    for table, column in DATED:
        checks.append(
            Check("first_date", table, column, lambda c=column: _day_number(F.min(c)), lower=low)
        )
        checks.append(
            Check("last_date", table, column, lambda c=column: _day_number(F.max(c)), upper=high)
        )
    return checks


def _day_number(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_bound_checks(first: date = FIRST_DAY, last: date = LAST_DAY) -> list[Check]:
    def outside(column: str) -> Column:
        return F.count_if(~F.col(column).between(F.lit(first), F.lit(last)))

    return [Check("date_bounds", t, c, lambda c=c: outside(c), upper=0) for t, c in DATED]


def win_rate_checks(lower: float = WIN_RATE_BAND[0], upper: float = WIN_RATE_BAND[1]) -> list[Check]:
    rate = lambda: kpis.win_rate(kpis.won_deals(), kpis.lost_deals())
    return [Check("win_rate_band", "sf_opportunities", "stage", rate, lower, upper)]


def net_pct_checks(lower: float = NET_PCT_BAND[0], upper: float = NET_PCT_BAND[1]) -> list[Check]:
    share = lambda: kpis.percent(F.sum("net_sales"), F.sum("gross_sales"))
    return [Check("net_pct_band", "shipments", "net_sales", share, lower, upper)]


def avg_deal_checks(lower: float = AVG_DEAL_BAND[0], upper: float = AVG_DEAL_BAND[1]) -> list[Check]:
    def mean() -> Column:
        won_amount = F.when(kpis.is_won(), F.col("amount"))
        return kpis.ratio(F.sum(won_amount), F.count(won_amount), 2)

    return [Check("avg_deal_band", "sf_opportunities", "amount", mean, lower, upper)]


def net_identity_checks() -> list[Check]:
    """Net is gross less discounts and returns."""
    differs = lambda: F.count_if(F.col("net_sales") != kpis.net_sales())
    return [Check("net_identity", "shipments", "net_sales", differs, upper=0)]


def net_le_gross_checks() -> list[Check]:
    over = lambda: F.count_if(F.col("net_sales") > F.col("gross_sales"))
    return [Check("net_le_gross", "shipments", "net_sales", over, upper=0)]


def rate_cap_checks(discount: str = DISCOUNT_CAP, returns: str = RETURN_CAP) -> list[Check]:
    def over(column: str, cap: str) -> Column:
        return F.count_if(F.col(column) > F.col("gross_sales") * F.lit(cap).cast("decimal(5,4)"))

    amounts = ("quantity", "gross_sales", "discounts", "returns", "net_sales")
    checks = [
        Check("discount_cap", "shipments", "discounts", lambda: over("discounts", discount), upper=0),
        Check("return_cap", "shipments", "returns", lambda: over("returns", returns), upper=0),
    ]
    checks += [
        Check("negative", "shipments", c, lambda c=c: F.count_if(F.col(c) < 0), upper=0)
        for c in amounts
    ]
    return checks


def deal_amount_checks(
    lower: int = DEAL_AMOUNT_RANGE[0], upper: int = DEAL_AMOUNT_RANGE[1]
) -> list[Check]:
    outside = lambda: F.count_if(~F.col("amount").between(lower, upper))
    return [Check("deal_amount_range", "sf_opportunities", "amount", outside, upper=0)]


def summary_stat_checks() -> list[Check]:
    return [
        Check("total_net_sales", "shipments", "net_sales", lambda: F.sum("net_sales")),
        Check("total_shipments", "shipments", None, lambda: F.count(F.lit(1))),
        Check(
            "active_operators", "shipments", "operator_id",
            lambda: F.count_distinct("operator_id"), reads_operator=True,
        ),
        Check("won_value", "sf_opportunities", "amount", kpis.revenue_won),
        Check("open_opportunities", "sf_opportunities", "stage", lambda: F.count_if(kpis.is_open())),
    ]


# ---- the checks as reports ------------------------------------------------

def dq_row_counts(star: Star) -> DataFrame:
    return run_checks(star, row_count_checks())


def dq_nulls(star: Star) -> DataFrame:
    return run_checks(star, null_checks())


def dq_date_ranges(star: Star, first: date | None = None, last: date | None = None) -> DataFrame:
    return run_checks(star, date_range_checks(first, last))


def dq_date_bounds(star: Star, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    return run_checks(star, date_bound_checks(first, last))


def dq_win_rate_band(
    star: Star, lower: float = WIN_RATE_BAND[0], upper: float = WIN_RATE_BAND[1]
) -> DataFrame:
    return run_checks(star, win_rate_checks(lower, upper))


def dq_net_pct_band(
    star: Star, lower: float = NET_PCT_BAND[0], upper: float = NET_PCT_BAND[1]
) -> DataFrame:
    return run_checks(star, net_pct_checks(lower, upper))


def dq_avg_deal_band(
    star: Star, lower: float = AVG_DEAL_BAND[0], upper: float = AVG_DEAL_BAND[1]
) -> DataFrame:
    return run_checks(star, avg_deal_checks(lower, upper))


def dq_net_identity(star: Star) -> DataFrame:
    return run_checks(star, net_identity_checks())


def dq_net_le_gross(star: Star) -> DataFrame:
    return run_checks(star, net_le_gross_checks())


def dq_rate_caps(star: Star, discount: str = DISCOUNT_CAP, returns: str = RETURN_CAP) -> DataFrame:
    return run_checks(star, rate_cap_checks(discount, returns))


def dq_deal_amount_range(
    star: Star, lower: int = DEAL_AMOUNT_RANGE[0], upper: int = DEAL_AMOUNT_RANGE[1]
) -> DataFrame:
    return run_checks(star, deal_amount_checks(lower, upper))


def dq_summary_stats(star: Star) -> DataFrame:
    return run_checks(star, summary_stat_checks())


# ---- references between tables --------------------------------------------

def _child(star: Star, table: str, column: str) -> DataFrame:
    if table == "shipments" and column != "operator_id":
        return star.lean_shipments
    return star.table(table)


def _orphans(star: Star, reference: tuple[str, str, str, str], name: str, nulls: bool) -> DataFrame:
    """Rows whose key has no parent.

    Child keys are counted first, so the anti join sees each key once and a
    key with very many rows costs no more than any other.
    """
    table, column, parent, parent_key = reference
    rows = _child(star, table, column).select(F.col(column).alias("k"))
    if not nulls:
        rows = rows.filter(F.col("k").isNotNull())
    counted = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    parents = star.table(parent).select(F.col(parent_key).alias("p"))
    lost = counted.join(parents, F.col("k") == F.col("p"), "left_anti")
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("observed")
    return lost.agg(total).select(
        F.lit(name).alias("check"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        "observed",
        F.lit(None).cast("double").alias("lower"),
        F.lit(0.0).alias("upper"),
    )


def _fact_orphans(star: Star, references: list[tuple[str, str, str, str]], name: str) -> DataFrame:
    """Several references of the shipments in one pass over them.

    Each shipment gives a (column, key) row for each reference; these are counted in the map
    tasks, so what is shuffled is keys and not shipments.
    """
    def pair(column: str, key: str) -> Column:
        return F.struct(F.lit(column).alias("c"), F.col(key).cast("string").alias("k"))

    rows = star.shipments.select(F.inline(F.array(*[pair(column, column) for _, column, _, _ in references])))
    counted = rows.filter(F.col("k").isNotNull()).groupBy("c", "k").agg(F.count(F.lit(1)).alias("n"))
    parents = union(
        star.table(parent).select(F.lit(column).alias("c"), F.col(key).cast("string").alias("k"))
        for _, column, parent, key in references
    )
    lost = counted.join(parents, ["c", "k"], "left_anti")
    wide = lost.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("c") == column, F.col("n"))), F.lit(0)).cast("double").alias(column)
            for _, column, _, _ in references
        ]
    )
    results = [
        F.struct(
            F.lit(name).alias("check"),
            F.lit("shipments").alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col(column).alias("observed"),
            F.lit(None).cast("double").alias("lower"),
            F.lit(0.0).alias("upper"),
        )
        for _, column, _, _ in references
    ]
    return wide.select(F.inline(F.array(*results)))


def dq_fk_orphans(star: Star) -> DataFrame:
    """Eight references; a NULL key refers to nothing and is not an orphan."""
    of_fact = [r for r in FOREIGN_KEYS if r[0] == "shipments"]
    others = [_orphans(star, r, "fk_orphans", nulls=False) for r in FOREIGN_KEYS if r[0] != "shipments"]
    return judged(union([*others, _fact_orphans(star, of_fact, "fk_orphans")]))


def dq_fk_left_join(star: Star) -> DataFrame:
    """Three references where a NULL key counts as an orphan too."""
    return judged(union(_orphans(star, r, "fk_missing", nulls=True) for r in LOAD_FOREIGN_KEYS))


# ---- keys -----------------------------------------------------------------

def dq_pk_unique(star: Star, keys: Mapping[str, tuple[str, ...]] = PRIMARY_KEYS) -> DataFrame:
    """Rows beyond the first per key, per table."""

    def surplus(table: str, columns: tuple[str, ...]) -> DataFrame:
        rows = star.table(table)
        if table == "shipments" and "operator_id" not in columns:
            rows = star.lean_shipments
        counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        return counted.agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("double").alias("observed")
        ).select(
            F.lit("pk_unique").alias("check"),
            F.lit(table).alias("table_name"),
            F.lit("+".join(columns)).alias("column_name"),
            "observed",
            F.lit(None).cast("double").alias("lower"),
            F.lit(0.0).alias("upper"),
        )

    return judged(union(surplus(t, c) for t, c in keys.items()))


def dq_join_fanout(star: Star) -> DataFrame:
    """How many rows one key value brings into a join: the most and the mean.

    A maximum above 1 means that joining the raw table on this key repeats
    the rows of the other side, so it has to be summed first.
    """

    def fanout(table: str, column: str) -> DataFrame:
        rows = _child(star, table, column).select(F.col(column).alias("k"))
        counted = (
            rows.filter(F.col("k").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        )
        both = counted.agg(
            F.max("n").cast("double").alias("most"),
            kpis.ratio(F.sum("n"), F.count("n"), 2).alias("mean"),
        )

        def row(name: str, value: str, upper: float | None) -> Column:
            return F.struct(
                F.lit(name).alias("check"),
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.col(value).alias("observed"),
                F.lit(None).cast("double").alias("lower"),
                F.lit(upper).cast("double").alias("upper"),
            )

        pair = F.array(row("join_fanout_max", "most", 1.0), row("join_fanout_mean", "mean", None))
        return both.select(F.inline(pair))

    return judged(union(fanout(t, c) for t, c in FANOUT_KEYS))


# ---- quantity outliers ----------------------------------------------------

def quantity_histogram(star: Star) -> DataFrame:
    """Shipments per category and quantity.

    Shipments shrink to counts per product and quantity before the product is
    looked up; everything after this works on the histogram. Shipments without a
    product, and products without a category, are those of the NULL category.
    """
    per_product = star.lean_shipments.groupBy("product_id", "quantity").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        per_product.filter(F.col("quantity").isNotNull())
        .join(star.products.select("product_id", "category"), "product_id", "left")
        .groupBy("category", "quantity")
        .agg(F.sum("n").alias("n"))
    )


def quantity_fences(histogram: DataFrame) -> DataFrame:
    """Quartile fences and three times the median, per category, exact.

    The percentile weighs each quantity by its count, so it keeps one entry
    per distinct quantity and not one per shipment.
    """
    marks = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    q = F.percentile(F.col("quantity"), marks, F.col("n"))
    spread = F.col("q")[2] - F.col("q")[0]
    return histogram.groupBy("category").agg(q.alias("q")).select(
        "category",
        (F.col("q")[0] - 1.5 * spread).alias("low_fence"),
        (F.col("q")[2] + 1.5 * spread).alias("high_fence"),
        (3.0 * F.col("q")[1]).alias("cap"),
    )


def dq_quantity_iqr(star: Star) -> DataFrame:
    """Per category: shipments outside the fences, and above the cap."""
    histogram = quantity_histogram(star)
    fences = quantity_fences(histogram)
    outside = ~F.col("quantity").between(F.col("low_fence"), F.col("high_fence"))
    fences = fences.withColumnRenamed("category", "fenced")
    per_category = (
        histogram.join(fences, F.col("category").eqNullSafe(F.col("fenced")))
        .groupBy("category", "low_fence", "high_fence", "cap")
        .agg(
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers"),
            F.sum(F.when(F.col("quantity") > F.col("cap"), F.col("n")).otherwise(0)).alias("capped"),
        )
    )
    label = F.concat(F.lit("quantity/"), F.coalesce("category", F.lit("Unknown")))
    nothing = F.lit(None).cast("double")

    def row(name: str, value: str, low: Column, high: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            F.lit("shipments").alias("table_name"),
            label.alias("column_name"),
            F.col(value).cast("double").alias("observed"),
            low.alias("lower"),
            high.alias("upper"),
            (F.col(value) == 0).alias("passed"),
        )

    return per_category.select(
        F.inline(
            F.array(
                row("quantity_iqr", "outliers", F.col("low_fence"), F.col("high_fence")),
                row("quantity_cap", "capped", nothing, F.col("cap")),
            )
        )
    )


def flag_quantity_outliers(star: Star) -> DataFrame:
    """Every shipment with its category, the two outlier flags and ``capped_quantity``.

    Fences are attached to the products, one row each, and shipments meet them in
    one join on the product; no shuffle goes by category, which a third of the rows may
    share. A shipment without a product takes the fences of the NULL category, a scalar.
    """
    return _flagged(star.shipments, star)


def _flagged(shipments: DataFrame, star: Star) -> DataFrame:
    fences = quantity_fences(quantity_histogram(star))
    marks = F.struct("low_fence", "high_fence", "cap")
    by_category = fences.select(F.col("category").alias("fenced"), marks.alias("marks"))
    unknown = fences.filter(F.col("category").isNull()).agg(F.max(marks)).scalar()
    products = star.products.select("product_id", "category")
    products = products.join(by_category, F.col("category").eqNullSafe(F.col("fenced")), "left")
    rows = shipments.join(products.select("product_id", "category", "marks"), "product_id", "left")
    rows = rows.withColumn("marks", F.coalesce("marks", unknown))
    quantity, cap = F.col("quantity"), F.col("marks.cap")
    return rows.select(
        *shipments.columns,
        "category",
        (~quantity.between(F.col("marks.low_fence"), F.col("marks.high_fence"))).alias("iqr_outlier"),
        (quantity > cap).alias("above_cap"),
        F.when(quantity > cap, cap).otherwise(quantity.cast("double")).alias("capped_quantity"),
    )


def dq_quantity_flags(star: Star) -> DataFrame:
    """The flags summed by category; the counts of all categories add up to the shipments."""
    return _flagged(star.lean_shipments, star).groupBy(F.coalesce("category", F.lit("Unknown")).alias("category")).agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count_if("iqr_outlier").alias("iqr_outliers"),
        F.count_if("above_cap").alias("above_cap"),
        F.sum(F.col("quantity").cast("double")).alias("quantity"),
        F.sum("capped_quantity").alias("capped_quantity"),
    )


# ---- everything -----------------------------------------------------------

def declared_checks(first: date = FIRST_DAY, last: date = LAST_DAY) -> list[Check]:
    """The checks that are aggregates of one table and can find an issue."""
    return (
        row_count_checks()
        + null_checks()
        + date_bound_checks(first, last)
        + win_rate_checks()
        + net_pct_checks()
        + avg_deal_checks()
        + net_identity_checks()
        + net_le_gross_checks()
        + rate_cap_checks()
        + deal_amount_checks()
    )


def quality_report(
    star: Star,
    first: date = FIRST_DAY,
    last: date = LAST_DAY,
    keys: Mapping[str, tuple[str, ...]] = PRIMARY_KEYS,
    stored: DataFrame | None = None,
) -> DataFrame:
    """All checks that can find an issue, with one pass over each table for
    the declared ones. Join fan-out is a property of the joins, not a fault of
    the data, and is reported separately.

    ``stored`` are declared checks found while the tables were written, with the standard
    days; only tables without any there are scanned for them."""
    declared = declared_checks(first, last)
    if stored is None:
        frames = [run_checks(star, declared)]
    else:
        known = {r[0] for r in stored.select("table_name").distinct().collect()}  # at most nine
        rest = [c for c in declared if c.table not in known]
        frames = [judged(stored)] + ([run_checks(star, rest)] if rest else [])
    return union([*frames, dq_fk_orphans(star), dq_pk_unique(star, keys)])


def dq_issue_summary(
    star: Star,
    first: date = FIRST_DAY,
    last: date = LAST_DAY,
    keys: Mapping[str, tuple[str, ...]] = PRIMARY_KEYS,
) -> DataFrame:
    """One row: how many checks ran, how many failed, which, and the verdict.

    The list has at most one entry per declared check.
    """
    failed = ~F.col("passed")
    place = F.concat_ws(".", "table_name", "column_name")
    issue = F.when(failed, F.concat_ws(" ", "check", place))
    return quality_report(star, first, last, keys).agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(failed).alias("issue_count"),
        F.every("passed").alias("all_passed"),
        F.array_join(F.sort_array(F.collect_list(issue)), "; ").alias("issues"),
    )
