"""Small hand-made stars."""

from datetime import date
from decimal import Decimal

from tradeledger.sources.schemas import TABLES
from tradeledger.star import Star


def frame(spark, table, *rows):
    """Rows given as dicts; columns not named are NULL."""
    schema = TABLES[table]
    data = []
    for row in rows:
        unknown = set(row) - set(schema.names)
        assert not unknown, unknown
        data.append(tuple(_typed(row.get(f.name), f) for f in schema.fields))
    loose = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(data, loose)


def _typed(value, field):
    if value is None:
        return None
    kind = field.dataType.typeName()
    if kind == "decimal":
        return Decimal(str(value)).quantize(Decimal("0.01"))
    if kind == "date" and isinstance(value, str):
        return date.fromisoformat(value)
    return value


def star(spark, **tables):
    return Star.of(spark, **{name: frame(spark, name, *rows) for name, rows in tables.items()})


def shipment(week, distributor="D1", operator="O1", product="P1", **values):
    gross = values.pop("gross", 100)
    discounts = values.pop("discounts", 0)
    returns = values.pop("returns", 0)
    return {
        "shipment_id": values.pop("id", None),
        "shipment_date": week,
        "week_ending": week,
        "distributor_id": distributor,
        "operator_id": operator,
        "product_id": product,
        "quantity": values.pop("quantity", 1),
        "gross_sales": gross,
        "discounts": discounts,
        "returns": returns,
        "net_sales": values.pop("net", gross - discounts - returns),
        "cost_of_goods": values.pop("cost", 60),
    }


def deal(id, owner="R1", stage="Closed Won", amount=1000, account="A1", **values):
    return {
        "opportunity_id": id,
        "account_id": account,
        "owner_id": owner,
        "stage": stage,
        "amount": amount,
        "probability": values.pop("probability", 100),
        "created_date": values.pop("created", "2024-01-01"),
        "close_date": values.pop("close", "2024-02-01"),
        **values,
    }


def activity(id, owner="R1", kind="Call", day="2024-01-15", **values):
    return {
        "activity_id": id,
        "owner_id": owner,
        "activity_type": kind,
        "activity_date": day,
        **values,
    }


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return [tuple(r) for r in picked.collect()]
