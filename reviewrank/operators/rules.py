"""Weighted rules with reason codes."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewrank.functions.expr import add, np_round, number_or_zero
from reviewrank.schema import require_columns


@dataclass(frozen=True)
class Rule:
    """Fires where ``column`` reaches ``limit``, or equals it if ``exact``."""

    code: str
    weight: float
    column: str
    limit: float
    exact: bool = False

    def hit(self, df: DataFrame) -> Column:
        value = number_or_zero(df, self.column)  # missing or unreadable counts as 0
        return value == self.limit if self.exact else value >= self.limit


# The rules in order, with weights and default limits.
RULES = (
    Rule("HIGH_PROVIDER_RELATIVE_COST", 0.30, "provider_paid_zscore", 3.0),
    Rule("EXCESS_UNITS", 0.20, "units", 20),
    Rule("POSSIBLE_DUPLICATE", 0.25, "duplicate_indicator", 1, exact=True),
    Rule("HIGH_PROVIDER_UTILIZATION", 0.15, "provider_claim_count_30d", 40),
    Rule("HIGH_BENEFICIARY_UTILIZATION", 0.10, "beneficiary_claim_count_30d", 12),
)


def rules_with(**limits: float) -> tuple[Rule, ...]:
    """The rules with other limits, given by column."""
    unknown = set(limits) - {rule.column for rule in RULES}
    if unknown:
        raise ValueError(f"no rule reads {sorted(unknown)}")
    return tuple(replace(rule, limit=limits.get(rule.column, rule.limit)) for rule in RULES)


def score_rules(featured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``rule_score`` in [0, 1] and ``rule_reason_codes``, in one projection."""
    require_columns(featured, [rule.column for rule in rules], "the rules lack columns")
    if not math.isclose(sum(rule.weight for rule in rules), 1.0, abs_tol=1e-8):
        raise ValueError("rule weights must sum to 1")
    hits = [(rule, rule.hit(featured)) for rule in rules]
    total = add([F.when(hit, F.lit(rule.weight)).otherwise(0.0) for rule, hit in hits], F.lit(0.0))
    bounded = F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0))
    codes = F.array_compact(F.array(*[F.when(hit, F.lit(rule.code)) for rule, hit in hits]))
    return featured.withColumns({"rule_score": np_round(bounded, 6), "rule_reason_codes": codes})
