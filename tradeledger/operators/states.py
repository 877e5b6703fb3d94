"""Stored aggregates that can be merged over any span: a cube, quantile sketches, sets of ids as bitmaps.

Sums add up over months, but quartiles and distinct counts don't. Here a month keeps a state that
does: a KLL sketch of quantities for each product, and a bitmap of operators for each kind of
distributor. A report over a year, a region or a type merges states and reads no shipment.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.operators.preagg import SUMS, shipments_by
from tradeledger.operators.ranking import with_rank
from tradeledger.star import Star

# Size of a quantile sketch; ranks of merged sketches are off by about RANK_ERROR at most.
SKETCH_SIZE = 400
RANK_ERROR = 0.02
QUARTILES = (0.25, 0.5, 0.75)

CUBE_KEYS = ("distributor_id", "distributor_type", "region", "year")
_WHO = ("distributor_id", "distributor_type", "region")
CUBE_SETS: tuple[tuple[str, ...], ...] = (
    (*_WHO, "year"), _WHO,
    ("distributor_type", "region", "year"), ("distributor_type", "region"),
    ("distributor_type", "year"), ("distributor_type",),
    ("region", "year"), ("region",),
    ("year",), (),
)


def _distributors(star: Star) -> DataFrame:
    places = star.territories.select("territory_id", "region")
    return star.distributors.join(places, "territory_id", "left").select(*_WHO)


# ---- every slice of a page --------------------------------------------------

def sales_cube(star: Star) -> DataFrame:
    """Shipment sums for every slice that the pages offer, from one pass over the shipments.

    ``slice_id`` says which of CUBE_KEYS a row is summed over, so a NULL region and all regions
    are told apart. Rows are summed by distributor and year before they meet a dimension.
    """
    sold = shipments_by(star, "distributor_id", "year")
    rows = _distributors(star).join(sold, "distributor_id")
    sets = [[F.col(k) for k in keys] for keys in CUBE_SETS]
    return rows.groupingSets(sets, *CUBE_KEYS).agg(
        F.grouping_id().cast("int").alias("slice_id"), *[F.sum(c).alias(c) for c in (*SUMS, "shipment_count")]
    )


def slice_id(keys: tuple[str, ...]) -> int:
    """The number that rows grouped by ``keys`` have."""
    return sum(0 if k in keys else 1 << (len(CUBE_KEYS) - 1 - i) for i, k in enumerate(CUBE_KEYS))


def cube_slice(
    cube: DataFrame, *by: str, year: int | None = None, distributor_type: str | None = None, region: str | None = None
) -> DataFrame:
    """The cube's rows by ``by`` (``distributor_id``, ``distributor_type``, ``region``, ``year``) under filters."""
    wanted = {"year": year, "distributor_type": distributor_type, "region": region}
    keys = {*by, *(k for k, v in wanted.items() if v is not None)}
    if "distributor_id" in keys:
        keys |= set(_WHO)
    ordered = tuple(k for k in CUBE_KEYS if k in keys)
    if ordered not in CUBE_SETS or not keys <= {*CUBE_KEYS}:
        raise ValueError(f"the cube has no rows by {sorted(keys)}")
    rows = cube.filter(F.col("slice_id") == slice_id(ordered))
    for key, value in wanted.items():
        if value is not None:
            rows = rows.filter(F.col(key) == value)
    return rows.select(*by, *SUMS, "shipment_count")


# ---- quartiles ---------------------------------------------------------------

def quantity_states(star: Star) -> DataFrame:
    """(month_start, product_id, n, sketch): the quantities of each product and month.

    A shipment without a quantity counts nowhere.
    """
    rows = star.lean_shipments.filter(F.col("quantity").isNotNull()).select(
        F.trunc("week_ending", "month").alias("month_start"), "product_id", F.col("quantity").cast("long").alias("q")
    )
    return rows.groupBy("month_start", "product_id").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("q", F.lit(SKETCH_SIZE)).alias("sketch")
    )


def quantity_quartiles(
    states: DataFrame, products: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Quartiles and fences by category over whole months, from the states.

    Each quartile is a quantity whose rank is off by RANK_ERROR at most (see the tests); with up to
    SKETCH_SIZE quantities in a category it is exact. A product that is unknown, or has no category, is
    of the NULL category.
    """
    if first is not None:
        states = states.filter(F.col("month_start") >= F.trunc(F.lit(first), "month"))
    if last is not None:
        states = states.filter(F.col("month_start") <= F.lit(last))
    rows = states.join(products.select("product_id", "category"), "product_id", "left")
    merged = rows.groupBy("category").agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    q = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(x)).alias(f"q{i}") for i, x in enumerate(QUARTILES, 1)]
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    return merged.select("category", "n", *q).select(
        "*", (F.col("q1") - spread).alias("low_fence"), (F.col("q3") + spread).alias("high_fence")
    )


def within_rank_error(quartiles: DataFrame, histogram: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """(category, n, within): whether every quartile's exact rank is near enough.

    ``histogram`` counts quantities by category (see ``quality.quantity_histogram``). The ranks of a
    quantity are those from the share below it to the share up to it.
    """
    joined = histogram.withColumnRenamed("n", "times").join(
        quartiles.withColumnRenamed("category", "of"), F.col("category").eqNullSafe(F.col("of"))
    )

    def share(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("times")).otherwise(0)) / F.sum("times")

    near = F.lit(True)
    for i, x in enumerate(QUARTILES, 1):
        below, upto = share(F.col("quantity") < F.col(f"q{i}")), share(F.col("quantity") <= F.col(f"q{i}"))
        near = near & (below <= x + error) & (upto >= x - error)
    return joined.groupBy("category", "n").agg(near.alias("within"))


# ---- distinct counts -----------------------------------------------------------

def operator_numbers(star: Star) -> DataFrame:
    """(operator_id, number): a number for each operator; ids that are numbers keep theirs."""
    ids = star.operators.select("operator_id").filter(F.col("operator_id").isNotNull())
    if isinstance(ids.schema["operator_id"].dataType, T.IntegralType):
        return ids.withColumn("number", F.col("operator_id").cast("long"))
    ranked = with_rank(ids.distinct().withColumn("__same", F.lit(0)), "__same", "operator_id", "number")
    return ranked.select("operator_id", F.col("number").cast("long").alias("number"))


def operator_states(star: Star) -> DataFrame:
    """(month_start, distributor_type, region, bucket, operators): the operators that bought, as bitmaps.

    A bitmap holds 32,768 numbers in 4 KB, so a month's state is bounded by the operators there
    are, not by the shipments. Operators that no table knows are left out.
    """
    met = shipments_by(star, "month_start", "distributor_id", "operator_id").select(
        "month_start", "distributor_id", "operator_id"
    )
    rows = met.join(operator_numbers(star), "operator_id").join(_distributors(star), "distributor_id")
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return rows.groupBy("month_start", "distributor_type", "region", bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("operators")
    )


def active_operators(
    states: DataFrame, *by: str, year: int | None = None, distributor_type: str | None = None, region: str | None = None
) -> DataFrame:
    """Exact distinct operators by any of ``year``, ``month_start``, ``distributor_type``, ``region``, under filters."""
    rows = states.withColumn("year", F.year("month_start"))
    for key, value in (("year", year), ("distributor_type", distributor_type), ("region", region)):
        if value is not None:
            rows = rows.filter(F.col(key) == value)
    merged = rows.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("operators")).alias("n"))
    return merged.groupBy(*by).agg(F.sum("n").alias("active_operators"))


STATES = {"cube": sales_cube, "quantities": quantity_states, "operators": operator_states}
