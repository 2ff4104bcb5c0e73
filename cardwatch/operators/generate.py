"""Synthetic labelled transactions, generated on the executors.

Every draw is a function of (row id, seed), taken from slices of a hash, so a
recomputed partition yields the same rows again, whatever its order. The ids come from any
table, e.g. ``spark.range(n)`` or the keys of an existing one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions import times
from cardwatch.functions.numbers import whole_div

# City and country list.
PLACES = (("Paris", "FR"), ("London", "GB"), ("New York", "US"), ("Tokyo", "JP"), ("Singapore", "SG"), ("Dubai", "AE"),
          ("Sydney", "AU"), ("Berlin", "DE"))
# Mean and deviation of ordinary amounts per category.
ORDINARY = (("GROCERY", 85, 45), ("RESTAURANT", 45, 30), ("RETAIL", 150, 100), ("ONLINE", 120, 80),
            ("TRAVEL", 450, 300), ("ENTERTAINMENT", 65, 40), ("UTILITIES", 120, 50), ("HEALTHCARE", 200, 150))
# Fraud patterns and their amount range.
CLOUD_PATTERNS = (("high_amount", 5000, 20000), ("risky_merchant", 1000, 8000), ("velocity_abuse", 100, 500),
                  ("geo_anomaly", 500, 3000), ("card_testing", 0.5, 5))
CARD_PATTERNS = (("very_high_amount", 5000, 20000), ("suspicious_international", 1000, 4000),
                 ("gambling_crypto", 500, 5500), ("night", 500, 2500), ("card_testing", 0.5, 10.5))
FAR_COUNTRIES = ("NG", "RU", "CN", "BR")

_DIGITS, _STEPS = 6, 16 ** 6


class Draws:
    """Numbered uniform draws in [0, 1) for a row."""

    def __init__(self, row_id: Column, seed: int):
        self.row_id, self.seed = row_id, seed

    def uniform(self, k: int) -> Column:
        block, part = divmod(k, 5)
        digest = F.md5(F.concat_ws(":", self.row_id.cast("string"), F.lit(str(self.seed)), F.lit(str(block))))
        digits = F.substring(digest, 1 + part * _DIGITS, _DIGITS)
        return F.conv(digits, 16, 10).cast("bigint") / F.lit(_STEPS)

    def below(self, k: int, n: int) -> Column:
        """A whole number from 0 to n - 1."""
        return F.floor(self.uniform(k) * n).cast("int")

    def between(self, k: int, low: float | Column, high: float | Column) -> Column:
        return low + self.uniform(k) * (high - low)

    def normal(self, k: int) -> Column:
        """Standard normal from the draws k and k + 1 (Box-Muller)."""
        radius = F.sqrt(-2 * F.log(1 - self.uniform(k)))
        return radius * F.cos(2 * F.pi() * self.uniform(k + 1))


def _at(values: Sequence, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def transactions(ids: DataFrame, id_column: str = "id", fraud_rate: float = 0.03, seed: int = 42,
                 end_ms: int = 1_704_067_200_000, span_ms: int = times.DAY_MS, customers: int = 5000,
                 merchants: int = 500, cloud: bool = True) -> DataFrame:
    """One labelled transaction per id; ``cloud`` chooses between the two families of fraud patterns.

    A row counts as international when its country is not the home country of its customer.
    """
    row = Draws(F.col(id_column), seed)
    patterns = CLOUD_PATTERNS if cloud else CARD_PATTERNS
    n = len(patterns)
    drawn = ids.select(
        F.col(id_column).alias("_id"),
        (row.uniform(0) < fraud_rate).alias("is_fraud"), row.below(1, n).alias("_pattern"),
        row.below(2, customers).alias("_customer"), row.below(3, merchants).alias("_merchant"),
        row.below(4, len(ORDINARY)).alias("_category"), row.below(5, len(PLACES)).alias("_place"),
        row.normal(6).alias("_normal"), row.uniform(8).alias("_u"), row.uniform(9).alias("_v"),
        (F.lit(end_ms) - F.floor(row.uniform(10) * span_ms)).alias("_time"), row.below(11, 5).alias("_hour"),
        row.below(12, 4).alias("_channel"), row.below(13, 2).alias("_card"), row.below(14, 3).alias("_currency"),
        row.between(15, 100, 15000).alias("_balance"), row.below(16, 5000).alias("_device"))
    fraud, pattern = F.col("is_fraud"), F.col("_pattern")
    kind = F.when(fraud, _at([p[0] for p in patterns], pattern))
    low, high = (_at([float(p[i]) for p in patterns], pattern) for i in (1, 2))
    usual = F.greatest(_at([float(c[1]) for c in ORDINARY], F.col("_category"))
                       + F.col("_normal") * _at([float(c[2]) for c in ORDINARY], F.col("_category")), F.lit(1.0))
    cents = F.round(F.when(fraud, low + F.col("_u") * (high - low)).otherwise(usual) * 100).cast("bigint")
    risky = kind.isin("risky_merchant", "gambling_crypto")
    home = Draws(F.col("_customer"), seed + 1).below(0, len(PLACES))
    country = F.when(kind == "geo_anomaly", _at(FAR_COUNTRIES, F.floor(F.col("_v") * 4).cast("int"))).otherwise(
        _at([p[1] for p in PLACES], F.col("_place")))
    abroad = country != _at([p[1] for p in PLACES], home)
    at_night = whole_div(F.col("_time"), F.lit(times.DAY_MS)) * times.DAY_MS + F.col("_hour") * times.HOUR_MS
    time = F.when(kind == "night", at_night).otherwise(F.col("_time"))
    category = (F.when(risky, F.when(F.col("_v") < 0.5, "GAMBLING").otherwise("CRYPTO"))
                .when(kind == "suspicious_international", "TRAVEL").when(kind == "night", "ATM")
                .otherwise(_at([c[0] for c in ORDINARY], F.col("_category"))))
    channel = (F.when(kind.isin("card_testing", "very_high_amount"), "ONLINE").when(kind == "night", "ATM")
               .otherwise(_at(("ONLINE", "POS", "ATM", "MOBILE"), F.col("_channel"))))
    return drawn.select(
        F.concat(F.lit("TX"), time, F.lit("-"), F.col("_id")).alias("transaction_id"),
        F.concat(F.lit("CUST"), F.lpad(F.col("_customer").cast("string"), 6, "0")).alias("customer_id"),
        F.concat(F.lit("MERCH"), F.lpad(F.col("_merchant").cast("string"), 5, "0")).alias("merchant_id"),
        (cents / F.lit(100)).alias("amount"), _at(("EUR", "USD", "GBP"), F.col("_currency")).alias("currency"),
        F.when(kind == "night", "WITHDRAWAL").otherwise("PURCHASE").alias("transaction_type"),
        channel.alias("channel"), _at([p[0] for p in PLACES], F.col("_place")).alias("location"),
        F.concat(F.lit("DEV"), F.col("_device")).alias("device_id"),
        F.lit(None).cast("string").alias("ip_address"), time.alias("timestamp_ms"),
        _at(("CREDIT", "DEBIT"), F.col("_card")).alias("card_type"),
        F.coalesce(kind.isin("geo_anomaly", "suspicious_international") | abroad, abroad).alias("is_international"),
        category.alias("merchant_category"), F.round("_balance", 2).alias("previous_balance"), fraud.alias("is_fraud"),
        country.alias("country"), kind.alias("fraud_type"), cents.alias("amount_cents"))
