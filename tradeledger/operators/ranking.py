"""Running numbers over a whole frame without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts of a doubling of the value, and ids that stand together among equal values.
STEPS = 64
IDS = 1 << 16
# Ranges of text ids are set by so many ids, drawn by their hash.
TEXT_RANGES = 200


def with_rank(df: DataFrame, value: str, id_column: str, name: str = "rank") -> DataFrame:
    """``row_number()`` by descending value, then ascending id.

    A window without partitions would sort everything in one task. Here rows fall
    into parts by fixed functions of value and id: a class of values (logarithmic
    steps), a value, and a range of ids. A row's number is its place in its part plus
    the sizes of the parts before it; those come from counts, whose windows see one row
    for each class, or for each part of one class. So many equal values are
    spread by their ids. NULL values come last, NULL ids first. ``id_column`` is unique.
    """
    ids = _id_part(df, id_column)
    parts = df.select(value_class(value).alias("__class"), F.col(value).alias("__value"), ids.alias("__ids"))
    counts = parts.groupBy("__class", "__value", "__ids").agg(F.count(F.lit(1)).alias("__n"))
    earlier = (Window.unboundedPreceding, -1)
    in_class = Window.partitionBy("__class").orderBy(F.desc_nulls_last("__value"), F.asc_nulls_first("__ids"))
    within = counts.withColumn("__within", F.sum("__n").over(in_class.rowsBetween(*earlier)))
    classes = counts.groupBy("__class").agg(F.sum("__n").alias("__n"))
    by_class = Window.orderBy(F.desc("__class")).rowsBetween(*earlier)
    before = classes.select(F.col("__class").alias("__c"), F.sum("__n").over(by_class).alias("__before"))
    starts = within.join(before, F.col("__class") == F.col("__c")).select(
        F.col("__value").alias("__v"),
        F.col("__ids").alias("__i"),
        (F.coalesce("__within", F.lit(0)) + F.coalesce("__before", F.lit(0))).alias("__start"),
    )
    place = F.row_number().over(Window.partitionBy(value, "__part").orderBy(F.asc_nulls_first(id_column)))
    placed = df.withColumn("__part", ids).withColumn("__place", place)
    joined = placed.join(
        starts, F.col(value).eqNullSafe(F.col("__v")) & F.col("__part").eqNullSafe(F.col("__i"))
    )
    return joined.withColumn(name, F.col("__start") + F.col("__place")).select(name, *df.columns)


def value_class(value: str) -> Column:
    """A number that never falls when the value rises; the lowest for NULL."""
    x = F.col(value).cast("double")
    step = F.floor(F.log2(F.abs(x) + 1) * STEPS).cast("int")
    return F.when(x >= 0, step).when(x < 0, -step - 1).otherwise(F.lit(-(1 << 31) + 1))


def _id_part(df: DataFrame, id_column: str) -> Column:
    """Ranges of ids in their order: of numbers by division, of texts between ids drawn from the frame.

    Text ids often begin alike, so fixed prefixes would put all in one range. The bounds are
    literals; which ids were drawn changes the ranges' sizes, never a rank.
    """
    if isinstance(df.schema[id_column].dataType, T.IntegralType):
        return F.floor(F.col(id_column) / IDS).cast("string").cast("long")
    ids = df.select(id_column).filter(F.col(id_column).isNotNull())
    drawn = ids.orderBy(F.xxhash64(id_column), id_column).limit(TEXT_RANGES).collect()
    bounds = sorted({r[0] for r in drawn}, key=lambda x: x.encode())
    if not bounds:
        return F.lit(0)
    return F.when(
        F.col(id_column).isNotNull(),
        F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound <= F.col(id_column))),
    )
