"""Canonical types of the nine star tables. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Deal stages and their probabilities.
WON = "Closed Won"
LOST = "Closed Lost"
STAGE_PROBABILITY = {
    "Prospecting": 10,
    "Qualification": 25,
    "Needs Analysis": 40,
    "Proposal": 60,
    "Negotiation": 80,
    "Closed Won": 100,
    "Closed Lost": 0,
}

DIRECTOR = "Director"


def _schema(spec: str) -> T.StructType:
    kinds = {
        "str": T.StringType(),
        "date": T.DateType(),
        "int": T.IntegerType(),
        "bool": T.BooleanType(),
        "money": MONEY,
    }
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        required = kind.endswith("!")
        fields.append(T.StructField(name, kinds[kind.rstrip("!")], not required))
    return T.StructType(fields)


TABLES: dict[str, T.StructType] = {
    "territories": _schema(
        "territory_id str!, territory_name str!, region str!, state str!, timezone str"
    ),
    "distributors": _schema(
        "distributor_id str!, distributor_name str!, distributor_type str,"
        " headquarters_state str, territory_id str, active_since date"
    ),
    "operators": _schema(
        "operator_id str!, operator_name str!, operator_type str, cuisine_type str,"
        " city str, state str, county str, zip_code str, territory_id str,"
        " opening_date date, annual_revenue_tier str, primary_distributor_id str"
    ),
    "products": _schema(
        "product_id str!, product_name str!, brand str, category str, subcategory str,"
        " unit_of_measure str, standard_price money, cost money, active int"
    ),
    "sales_reps": _schema(
        "rep_id str!, rep_name str!, email str, hire_date date, territory_id str,"
        " manager_id str, quota_annual money, rep_tier str"
    ),
    "sf_accounts": _schema(
        "account_id str!, operator_id str!, account_name str!, account_type str,"
        " industry str, owner_id str, created_date date, last_activity_date date,"
        " account_status str"
    ),
    "sf_opportunities": _schema(
        "opportunity_id str!, account_id str!, opportunity_name str!, stage str,"
        " amount money, probability int, close_date date, created_date date,"
        " owner_id str, lead_source str, product_interest str, competitor str,"
        " loss_reason str"
    ),
    "sf_activities": _schema(
        "activity_id str!, account_id str, opportunity_id str, owner_id str!,"
        " activity_type str, activity_date date, duration_minutes int, subject str,"
        " outcome str, next_steps str"
    ),
    "shipments": _schema(
        "shipment_id str!, shipment_date date!, week_ending date!, distributor_id str!,"
        " operator_id str!, product_id str!, quantity int, gross_sales money,"
        " discounts money, returns money, net_sales money, cost_of_goods money"
    ),
}

DIMENSIONS = ("territories", "distributors", "products", "sales_reps", "operators")
CRM = ("sf_accounts", "sf_opportunities", "sf_activities")
FACT = "shipments"

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "territories": ("territory_id",),
    "distributors": ("distributor_id",),
    "operators": ("operator_id",),
    "products": ("product_id",),
    "sales_reps": ("rep_id",),
    "sf_accounts": ("account_id",),
    "sf_opportunities": ("opportunity_id",),
    "sf_activities": ("activity_id",),
    "shipments": ("shipment_id",),
}
