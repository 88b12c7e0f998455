"""Sliding-window rate limit over a request log.

A client may have ``limit`` accepted requests in any ``window``; a request
exactly one window old still counts, and a denied request leaves no trace.
Because denials feed back into later decisions, a window frame cannot answer
this; the decisions of a client form a chain in time.

The chain is cut where it can be cut exactly.  Time is divided into slots of
one window.  If a slot and the one before it hold at most ``limit`` requests
together, every request of the slot is accepted whatever happened earlier, so
the state at its end is known from the slot alone and a new, independent run
can start there.  Only a stretch that stays near the limit without a break is
walked in order, over distinct instants (copies of an instant are counted
before they are moved) and with at most ``limit`` remembered instants.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.scalars import epoch_seconds, micros
from millrace.schemas import RATE_LIMIT_PER_WINDOW, RATE_WINDOW_SECONDS

UNKNOWN_CLIENT = "unknown"


class AcceptedWindow:
    """Accepted requests of one client inside the trailing window."""

    def __init__(self, limit: int, window_us: int, instants: list[tuple[int, int]] | None = None):
        self.limit = limit
        self.window_us = window_us
        self.instants = deque(instants or [])
        self.size = sum(n for _, n in self.instants)

    @property
    def newest(self) -> int:
        """The last accepted instant; far in the past when there is none."""
        return self.instants[-1][0] if self.instants else -(2**62)

    def offer(self, at_us: int, n: int) -> tuple[int, int]:
        """Offer ``n`` requests at one instant; (requests before, accepted)."""
        oldest = at_us - self.window_us
        while self.instants and self.instants[0][0] < oldest:
            self.size -= self.instants.popleft()[1]
        before = self.size
        accepted = min(n, max(0, self.limit - before))
        if accepted:
            self.instants.append((at_us, accepted))
            self.size += accepted
        return before, accepted


def _runs(moments: DataFrame, limit: int, window_us: int) -> DataFrame:
    """Give each instant its run; a run's first slot may only warm up the state."""
    slots = moments.groupBy("_client", "_slot").agg(F.sum("n").alias("_load"))
    by_client = Window.partitionBy("_client").orderBy("_slot")
    follows = F.coalesce(F.lag("_slot").over(by_client) == F.col("_slot") - 1, F.lit(False))
    previous = F.when(follows, F.lag("_load").over(by_client)).otherwise(0)
    opens = (F.col("_load") + previous <= limit) | ~follows
    numbered = (
        slots.withColumn("_shared", opens & follows)
        .withColumn("_opens", opens.cast("int"))
        .withColumn("_run", F.sum("_opens").over(by_client.rowsBetween(Window.unboundedPreceding, 0)))
    )
    # A shared slot ends one run (and is answered there) and warms up the next.
    placed = F.when(
        F.col("_shared"),
        F.array(
            F.struct((F.col("_run") - 1).alias("run"), F.lit(True).alias("answer")),
            F.struct(F.col("_run").alias("run"), F.lit(False).alias("answer")),
        ),
    ).otherwise(F.array(F.struct(F.col("_run").alias("run"), F.lit(True).alias("answer"))))
    homes = numbered.select("_client", "_slot", F.explode(placed).alias("_h")).select(
        "_client", "_slot", "_h.run", "_h.answer"
    )
    return moments.join(homes, ["_client", "_slot"]).drop("_slot")


def decide_run(
    window: AcceptedWindow, at: np.ndarray, n: np.ndarray, before: np.ndarray, accepted: np.ndarray
) -> None:
    """Fill in the decisions of consecutive instants of one client.

    While the window is full nothing can be accepted before its oldest
    instant leaves, so a saturated stretch is crossed in jumps.
    """
    i, end = 0, len(at)
    while i < end:
        before[i], accepted[i] = window.offer(int(at[i]), int(n[i]))
        i += 1
        if window.size >= window.limit and i < end:
            free = window.instants[0][0] + window.window_us
            if at[i] <= free:
                full = i + int(np.searchsorted(at[i:], free, side="right"))
                before[i:full] = window.limit
                i = full


def _walk(limit: int, window_us: int):
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, window = None, None
        for batch in batches:
            at, n = batch["_us"].to_numpy(), batch["n"].to_numpy()
            clients, numbers = batch["_client"].to_numpy(), batch["run"].to_numpy()
            before, accepted = np.zeros(len(at), "int64"), np.zeros(len(at), "int64")
            changes = (clients[1:] != clients[:-1]) | (numbers[1:] != numbers[:-1])
            starts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(at)]
            for low, high in zip(starts, starts[1:]):
                if high > low:
                    if (clients[low], numbers[low]) != current:
                        current, window = (clients[low], numbers[low]), AcceptedWindow(limit, window_us)
                    decide_run(window, at[low:high], n[low:high], before[low:high], accepted[low:high])
            out = batch[["_client", "_us"]].assign(before=before, accepted=accepted)
            yield out[batch["answer"] & (accepted > 0)]

    return walk


def rate_limit(
    log: DataFrame,
    limit: int = RATE_LIMIT_PER_WINDOW,
    window_seconds: int = RATE_WINDOW_SECONDS,
    client: str = "client_id",
    ts: str = "ts",
    tie: str = "request_id",
) -> DataFrame:
    """Add ``allowed``, ``remaining`` and ``reset`` to each request.

    Requests of one instant are decided in ``tie`` order; ``tie`` is unique.
    ``remaining`` is what is left after the request, ``reset`` the epoch second
    one window later.  The limit is global per client.  A request without a
    time cannot be judged and is not allowed.
    """
    if limit < 1 or window_seconds < 1:
        raise ValueError("limit and window must be positive")
    window_us = window_seconds * 1_000_000
    requests = log.withColumn("_client", F.coalesce(F.col(client), F.lit(UNKNOWN_CLIENT))).withColumn(
        "_us", micros(ts)
    )
    # Grouped by the slot as well, so that both uses below share one shuffle.
    slot = F.floor(F.col("_us") / window_us).cast("long")
    moments = (
        requests.select("_client", "_us", slot.alias("_slot"))
        .filter(F.col("_slot").isNotNull() & F.col("_us").isNotNull())
        .groupBy("_client", "_us", "_slot")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    decided = (
        _runs(moments, limit, window_us)
        .select("_client", "run", "_us", "n", "answer")
        .repartition("_client", "run")
        .sortWithinPartitions("_client", "run", "_us")
        .mapInPandas(_walk(limit, window_us), "_client string, _us long, before long, accepted long")
    )
    # Only the first ``limit`` requests of an instant can be accepted; the rank
    # filter is applied before the shuffle, so a burst of copies stays small.
    instant = Window.partitionBy("_client", "_us").orderBy(tie)
    candidates = (
        requests.select("_client", "_us", tie)
        .withColumn("_rank", F.row_number().over(instant))
        .filter(F.col("_rank") <= limit)
    )
    accepted = (
        candidates.join(decided, ["_client", "_us"])
        .filter(F.col("_rank") <= F.col("accepted"))
        .select("_client", "_us", tie, (limit - F.col("before") - F.col("_rank")).alias("_left"))
    )
    return (
        requests.join(accepted, ["_client", "_us", tie], "left")
        .withColumns(
            {
                "allowed": F.col("_left").isNotNull(),
                "remaining": F.coalesce(F.col("_left"), F.lit(0)).cast("long"),
                "reset": epoch_seconds(ts) + F.lit(window_seconds).cast("long"),
            }
        )
        .select(*log.columns, "allowed", "remaining", "reset")
    )
