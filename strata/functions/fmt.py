"""Display formatting as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display zone, patterns and texts of the reports.
DISPLAY_ZONE = "Asia/Kolkata"
DISPLAY_SUFFIX = " IST"
DISPLAY_PATTERN = "dd MMM yyyy, hh:mm:ss a"
RECORD_PATTERN = "yyyy-MM-dd HH:mm:ss"
MISSING = "Not available"

_ZONED = r"\d{1,2}:\d{2}.*([A-Za-z]|[+-]\d{2}:?\d{2})$"


def utc_clock(text: Column) -> Column:
    """Parse text as UTC wall-clock time: zoned text is shifted, naive text taken as it is.

    Neither branch depends on the session time zone; unreadable text gives null.
    """
    shifted = F.convert_timezone(None, F.lit("UTC"), F.try_to_timestamp(text))
    return F.when(text.rlike(_ZONED), shifted).otherwise(text.try_cast("timestamp_ntz"))


def display_clock(clock: Column, tz: str = DISPLAY_ZONE, pattern: str = DISPLAY_PATTERN) -> Column:
    """Show a UTC wall-clock (``timestamp_ntz``) column in another zone."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(tz), clock), pattern)


def display_ts(
    text: Column, tz: str = DISPLAY_ZONE, suffix: str = DISPLAY_SUFFIX, missing: str = MISSING
) -> Column:
    """Show a text time in ``tz``; empty gives ``missing``, unreadable text stays."""
    shown = F.concat(display_clock(utc_clock(text), tz), F.lit(suffix))
    return F.coalesce(F.nullif(F.coalesce(shown, text), F.lit("")), F.lit(missing))


def status(state: Column) -> Column:
    """Lower-cased state; null or empty gives ``unknown``."""
    return F.lower(F.coalesce(F.nullif(state, F.lit("")), F.lit("unknown")))


def label(key: Column) -> Column:
    """Snake-case key to title words: ``rows_after`` → ``Rows After``."""
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


def thousands(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(number, 0)


def duration(start: Column, end: Column) -> Column:
    """Seconds between two epoch-second columns as ``"%.2f sec"``."""
    return F.format_string("%.2f sec", (end - start).cast("double"))


def run_name(run_id: Column, position: Column) -> Column:
    """Friendly run name from the id prefix and the 1-based list position."""
    kind = (
        F.when(run_id.startswith("manual__"), "Manual Run ")
        .when(run_id.startswith("scheduled__"), "Scheduled Run ")
        .otherwise("Pipeline Run ")
    )
    return F.concat(kind, position.cast("string"))


def _quoted(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(text.contains("'") & ~text.contains('"'), double).otherwise(single)


def text_list(items: Column) -> Column:
    """Show an array of texts as ``['a', 'b']``."""
    shown = F.transform(items, lambda item: F.coalesce(_quoted(item), F.lit("None")))
    return F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))


def schema_list(fields: Column) -> Column:
    """Show an array of (name, type) as ``[{'name': 'a', 'type': 'LongType()'}]``."""
    shown = F.transform(
        fields,
        lambda field: F.concat(
            F.lit("{'name': "), _quoted(field["name"]), F.lit(", 'type': "), _quoted(field["type"]), F.lit("}")
        ),
    )
    return F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))
