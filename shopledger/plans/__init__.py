"""Importing this package registers every dataset."""

from shopledger.plans import alternative, gold, marts, silver

__all__ = ["alternative", "gold", "marts", "silver"]
