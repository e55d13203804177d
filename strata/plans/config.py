"""What a refinement run does, with the default rules."""

from __future__ import annotations

from dataclasses import dataclass

from strata.operators.clean import FILL_NUMBER, FILL_STRING
from strata.operators.columns import ARTIFACTS


@dataclass(frozen=True)
class FlagRule:
    """Append column ``target``: ``then`` where ``source`` equals ``equals``, else ``otherwise``."""

    source: str
    target: str
    equals: object
    then: str
    otherwise: str
    label: str | None = None


# The default enrichment rule.
DEFAULT_RULE = FlagRule(
    source="Survived",
    target="SurvivalStatus",
    equals=1,
    then="Survived",
    otherwise="Did not survive",
    label="Survival Status Added",
)


@dataclass(frozen=True)
class LayerConfig:
    """Rules of a run. Each rule applies only where its column exists."""

    artifacts: tuple[str, ...] = ARTIFACTS
    fill_string: str = FILL_STRING
    fill_number: float = FILL_NUMBER
    rules: tuple[FlagRule, ...] = (DEFAULT_RULE,)
    partition_by: str | None = "Pclass"
    key: str | None = "PassengerId"
    fmt: str = "parquet"
    # JSON sources hold one object per line.
    lines: bool = False
    # Malformed source rows fail the run, or are kept and counted ("keep").
    malformed: str = "fail"
    # Find repeated rows by their hashes first; for large inputs in which few different rows repeat.
    screen_duplicates: bool = False
    # Leave out rows that an earlier batch of the same stream had; for appended batches only.
    across_batches: bool = False
    # Gather partition values before a partitioned write, at the cost of a shuffle.
    # None leaves it to the number of values found.
    rebalance: bool | None = None
