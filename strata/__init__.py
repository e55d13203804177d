"""Strata: layered data refinement on PySpark DataFrames and Structured Streaming."""

from strata import sources
from strata.functions import fmt
from strata.operators import (
    clean,
    columns,
    footers,
    ledger,
    lineage,
    lookup,
    preview,
    profile,
    quality,
    report,
    runs,
    schema,
    states,
)
from strata.plans import layers, metrics
from strata.sources import tables
from strata.streaming import claims, incremental, seen

__all__ = [
    "claims",
    "clean",
    "columns",
    "fmt",
    "footers",
    "incremental",
    "layers",
    "ledger",
    "lineage",
    "lookup",
    "metrics",
    "preview",
    "profile",
    "quality",
    "report",
    "runs",
    "schema",
    "seen",
    "sources",
    "states",
    "tables",
]
