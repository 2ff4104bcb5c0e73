"""Sessions of a stream with the rows of each category, in a state of one entry per category and open session.

A session window can keep any category only as one list entry a row. Here the state of a customer holds, for each open
session, its bounds, sums, first and last place, and one count for each category seen, so it does not grow with the
rows of a session. The rows of a micro-batch arrive in Arrow batches and are combined into pieces before they meet the
open sessions.

A session is closed, and handed on, when the watermark reaches its end; rows that come after the end of the session
they would open are late and dropped. Null categories are a category; rows of equal time are ordered by transaction.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardwatch.functions import numbers
from cardwatch.streaming.source import ARRIVAL

CLOSED = "customer_id string, closed string"
CLOSED_SESSION = ("struct<first_us: bigint, last_us: bigint, row_count: bigint, cents: bigint, first_place: string, "
                  "last_place: string, categories: array<struct<category: string, row_count: bigint>>>")
OPEN = "sessions string"

#: A piece of a session: first and last time, rows, cents, [time, id, place] of its first and last row, [category, rows] pairs.
Piece = list[Any]


def _text(value: Any) -> str | None:
    return None if value is None or value != value else value


def pieces(rows: pd.DataFrame, gap_us: int, after_us: int | None = None) -> list[Piece]:
    """The rows of one customer, combined as far as they lie within the gap of each other; without those whose session
    would have ended by ``after_us``.

    Plain lists: a customer has few rows, and each data frame operation costs more than all of them.
    """
    columns = [rows[c].tolist() for c in ("us", "transaction_id", "location", "merchant_category", "amount_cents")]
    found = [(us, _text(row_id), _text(place), _text(kind), cents) for us, row_id, place, kind, cents in zip(*columns)
             if after_us is None or us + gap_us > after_us]
    found.sort(key=_edge)
    out: list[Piece] = []
    for us, row_id, place, kind, cents in found:
        if out and us - out[-1][1] <= gap_us:
            last = out[-1]
            last[1], last[2], last[3], last[5] = us, last[2] + 1, last[3] + cents, [us, row_id, place]
            last[6][kind] = last[6].get(kind, 0) + 1
        else:
            out.append([us, us, 1, cents, [us, row_id, place], [us, row_id, place], {kind: 1}])
    for piece in out:
        piece[6] = [[kind, n] for kind, n in piece[6].items()]
    return out


def _edge(row: list) -> tuple:
    return (row[0], row[1] is not None, row[1] or "")


def merged(found: list[Piece], gap_us: int) -> list[Piece]:
    """Pieces joined where one begins within the gap of the one before."""
    out: list[Piece] = []
    for piece in sorted(found, key=lambda p: p[0]):
        if out and piece[0] <= out[-1][1] + gap_us:
            last = out[-1]
            counts = {k: n for k, n in last[6]}
            for k, n in piece[6]:
                counts[k] = counts.get(k, 0) + n
            out[-1] = [last[0], max(last[1], piece[1]), last[2] + piece[2], last[3] + piece[3],
                       min(last[4], piece[4], key=_edge), max(last[5], piece[5], key=_edge), [[k, n] for k, n in counts.items()]]
        else:
            out.append(piece)
    return out


def _step(gap_ms: int):
    gap_us = gap_ms * 1000

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        now = json.loads(state.get[0]) if state.exists else []
        for rows in batches:
            now = merged(now + pieces(rows, gap_us, watermark * 1000), gap_us)
        closed = [p for p in now if p[1] + gap_us <= watermark * 1000]
        left = [p for p in now if p[1] + gap_us > watermark * 1000]
        if left:
            state.update((json.dumps(left),))
            end_ms = min(p[1] for p in left) // 1000 + gap_ms
            state.setTimeoutTimestamp(max(end_ms - 1, watermark + 1))
        elif state.exists:
            state.remove()
        if closed:
            told = [{"first_us": p[0], "last_us": p[1], "row_count": p[2], "cents": p[3], "first_place": p[4][2],
                     "last_place": p[5][2], "categories": [{"category": k, "row_count": n} for k, n in sorted(
                         p[6], key=lambda e: (e[0] is None, e[0] or ""))]} for p in closed]
            yield pd.DataFrame({"customer_id": [key[0]], "closed": [json.dumps(told)]})
    return step


def sessions(df: DataFrame, time: str = ARRIVAL, gap_ms: int = 600_000) -> DataFrame:
    """Closed sessions per customer of a stream with a watermark on ``time``; the columns of ``windows.sessions``."""
    rows = df.select("customer_id", time, F.unix_micros(time).alias("us"), "transaction_id", "location", "merchant_category",
                     F.coalesce(numbers.CENTS, F.lit(0)).alias(numbers.CENTS)).where(F.col(time).isNotNull())
    closed = rows.groupBy("customer_id").applyInPandasWithState(
        _step(gap_ms), CLOSED, OPEN, "append", GroupStateTimeout.EventTimeTimeout)
    closed = closed.select("customer_id", F.explode(F.from_json("closed", f"array<{CLOSED_SESSION}>")).alias("_s")).select(
        "customer_id", "_s.*")
    start, end = F.timestamp_micros("first_us"), F.timestamp_micros(F.col("last_us") + gap_ms * 1000)
    return closed.select(
        "customer_id", start.alias("session_start"), end.alias("session_end"), F.col("row_count").alias("session_tx_count"),
        numbers.money(F.col("cents")).alias("session_total_amount"), F.col("first_place").alias("first_location"),
        F.col("last_place").alias("last_location"), F.col("categories").alias("merchant_categories"),
        (F.col("first_place") != F.col("last_place")).alias("has_location_change"),
        ((F.unix_millis(end) - F.unix_millis(start)) / F.lit(60_000)).alias("session_duration_minutes"))
