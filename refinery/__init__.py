"""Refinery: split raw (bronze) tables into accepted and quarantined rows by
declared rules, enrich them, and keep type-1 / type-2 histories, all as
Spark DataFrame plans."""

from refinery.operators.quality import (
    ForeignKey,
    Predicate,
    Timestamps,
    UniqueKey,
    split,
    tag,
)

__all__ = ["ForeignKey", "Predicate", "Timestamps", "UniqueKey", "split", "tag"]
