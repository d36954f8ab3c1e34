"""Retail analytics on PySpark: raw tables -> cleaned -> star schema -> business marts."""

from shopledger.lakehouse import Lakehouse, dataset

__all__ = ["Lakehouse", "dataset"]
