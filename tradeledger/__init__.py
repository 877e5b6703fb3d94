"""Commercial reporting over CRM and shipment data, as Spark DataFrame jobs."""

from tradeledger.star import Star

__all__ = ["Star"]
