"""Rule sets as data, compiled to column expressions.

A rule set is a list of groups. Within a group the first matching rule counts,
groups add up. Points are whole hundredths, so thresholds compare exactly; the
score column is ``points / 100``. The expressions look at one row only and work
the same on a batch and on a stream.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Merchant categories treated as risky.
RISKY = ("GAMBLING", "CRYPTO")
RISKY_WITH_WIRE = ("GAMBLING", "CRYPTO", "WIRE_TRANSFER")
# Merchant categories the record knows.
CATEGORIES = ("RETAIL", "GROCERY", "RESTAURANT", "ONLINE", "TRAVEL", "ENTERTAINMENT", "UTILITIES", "HEALTHCARE",
              "GAMBLING", "CRYPTO", "WIRE_TRANSFER")
# Lowest points of each level, highest level first.
LEVELS = (("CRITICAL", 70), ("HIGH", 50), ("MEDIUM", 30))
LOWEST_LEVEL = "LOW"
LEVEL_ORDER = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


@dataclass(frozen=True)
class Rule:
    points: int
    test: Callable[[], Column]


@dataclass(frozen=True)
class RuleSet:
    name: str
    groups: tuple[tuple[Rule, ...], ...]
    decision: int = 50

    def points(self) -> Column:
        return reduce(lambda a, b: a + b, (_first_match(g) for g in self.groups))


def _first_match(group: tuple[Rule, ...]) -> Column:
    chain = F
    for rule in group:
        chain = chain.when(rule.test(), F.lit(rule.points))
    return chain.otherwise(F.lit(0))


def over(limit: float) -> Callable[[], Column]:
    return lambda: F.col("amount") > limit


def flagged(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def foreign_over(limit: float) -> Callable[[], Column]:
    return lambda: F.col("is_international") & (F.col("amount") > limit)


def category_in(categories: tuple[str, ...]) -> Callable[[], Column]:
    return lambda: F.col("merchant_category").isin(*categories)


def column_over(name: str, limit: float, absolute: bool = False) -> Callable[[], Column]:
    return lambda: (F.abs(F.col(name)) if absolute else F.col(name)) > limit


def weekend_over(limit: float) -> Callable[[], Column]:
    return lambda: F.col("is_weekend") & (F.col("amount") > limit)


NIGHT = (Rule(15, flagged("is_suspicious_hour")),)


def stream_rules(max_amount: float = 5000, international_factor: float = 1.0, decision: int = 50) -> RuleSet:
    return RuleSet("stream", (
        (Rule(40, over(10000)), Rule(30, over(max_amount))),
        (Rule(round(20 * international_factor), foreign_over(1000)),),
        NIGHT,
        (Rule(25, category_in(RISKY_WITH_WIRE)),),
        (Rule(10, weekend_over(2000)),),
    ), decision)


BATCH = RuleSet("batch", (
    (Rule(40, column_over("amount_zscore", 3, absolute=True)),),
    (Rule(20, over(5000)), Rule(10, over(1000))),
    (Rule(15, flagged("is_international")),),
    (Rule(20, category_in(RISKY)),),
    NIGHT,
))
CLOUD = RuleSet("cloud", (
    (Rule(50, over(10000)), Rule(30, over(5000)), Rule(15, over(2000))),
    (Rule(30, category_in(RISKY)),),
    NIGHT,
    (Rule(25, foreign_over(1000)),),
    (Rule(20, column_over("amount_to_balance_ratio", 0.8)),),
))
NOTEBOOK = RuleSet("notebook", (
    (Rule(50, over(10000)), Rule(30, over(5000))),
    (Rule(30, category_in(RISKY)),),
    NIGHT,
    (Rule(20, foreign_over(1000)),),
))


def level(points: Column, levels: tuple[tuple[str, int], ...] = LEVELS) -> Column:
    chain = F
    for name, lowest in levels:
        chain = chain.when(points >= lowest, F.lit(name))
    return chain.otherwise(F.lit(LOWEST_LEVEL))


def level_rank(name: Column) -> Column:
    """1 for the most severe level; unknown values sort last."""
    position = F.array_position(F.array(*[F.lit(x) for x in LEVEL_ORDER]), name).cast("int")
    return F.when(position > 0, position).otherwise(F.lit(len(LEVEL_ORDER)))


def reasons(tests: list[tuple[Callable[[], Column], Column]]) -> Column:
    """Texts of all tests that hold, in order."""
    return F.array_compact(F.array(*[F.when(test(), text) for test, text in tests]))


def apply(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Adds ``score_points``, ``fraud_score``, ``risk_level``, ``is_fraud_predicted``, ``alert_required``."""
    scored = df.withColumn("score_points", rules.points())
    points = F.col("score_points")
    return scored.withColumns({
        "fraud_score": points / F.lit(100),
        "risk_level": level(points),
        "is_fraud_predicted": points >= rules.decision,
        "alert_required": level(points).isin("HIGH", "CRITICAL"),
    })
