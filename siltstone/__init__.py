"""Security-log lakehouse on PySpark: raw logs -> parsed columns -> event classes."""

from siltstone.plans.spec import (
    Field,
    Flow,
    GoldSpec,
    Ingest,
    Lookup,
    LookupSource,
    SilverSpec,
    load_flow,
)

__all__ = [
    "Field",
    "Flow",
    "GoldSpec",
    "Ingest",
    "Lookup",
    "LookupSource",
    "SilverSpec",
    "load_flow",
]
