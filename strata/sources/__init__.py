"""Sources: input files and layer tables."""

from strata.sources.files import is_json, name_is_valid, read_csv, read_json, read_source, validate_names

__all__ = ["is_json", "name_is_valid", "read_csv", "read_json", "read_source", "validate_names"]
