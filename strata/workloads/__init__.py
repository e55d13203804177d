"""Workload queries over the given tables, one or more per operator."""

from strata.workloads import cleaning, intake, layering, records, storage
from strata.workloads.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "cleaning", "intake", "layering", "records", "storage"]
