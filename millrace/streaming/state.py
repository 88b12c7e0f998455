"""Keyed state: job life cycle, rate limit, alerts.

Every key has a state of its own in the state store, and timers that end it:
what the watermark has passed for good is dropped.  A batch reads and writes
the states of the keys it touches and no others, so its cost does not grow
with the number of live keys.  Jobs, of which there are many with few events
each, share keys (``JobLife``).  Stateful processors need the RocksDB store
(``conf.CLUSTER``; ``source.drain`` sees to it).

Rows reach a processor unordered and are put in order of time first.  A row
that arrives in a later batch than a row of its key with a later time is late:
it does not change decisions already made.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.scalars import micros
from millrace.operators.metrics import Trigger, breached, trigger_table
from millrace.operators.ratelimit import UNKNOWN_CLIENT, AcceptedWindow, decide_run
from millrace.schemas import JOB_TIMEOUT_SECONDS, RATE_LIMIT_PER_WINDOW, RATE_WINDOW_SECONDS
from millrace.streaming.source import event_time


# How long a finished job is remembered for events that follow, and one that was never started.
KEEP_FINISHED_SECONDS = 86_400
KEEP_PENDING_SECONDS = 7 * 86_400

# Steps by which the other metrics must be ahead before one without points counts as silent.
SILENT_STEPS = 2

# Keys that the jobs are dealt to, and jobs in one entry of the store; the first is fixed for a checkpoint's life.
BUCKETS = 512
PIECE_JOBS = 256

# Absent numbers travel as sentinels: null-free columns are cheap in pandas.
_NEVER = -(2**62)
# Where no job is, nothing wakes.
_ASLEEP = 2**62


def without_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows that no stateful operator can place; for the dead letters."""
    return events.filter(F.col(ts).isNull())


def _sorted(frames: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(frames), ignore_index=True).sort_values(by, kind="stable")


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


_FACTS = (
    "status string, progress_percentage double, started_us long, completed_us long, "
    "duration_seconds double, error_message string, timed_out boolean, events long"
)
_JOB_OUTPUT = f"job_id string, {_FACTS}"
# The jobs of a piece, column by column.
_PIECE = ", ".join(
    f"{name} array<{kind}>"
    for name, kind in (f.split() for f in f"job_id string, spot int, {_FACTS}, last_us long, last_seq int".split(", "))
)
_NEW_JOB = ("pending", 0.0, _NEVER, _NEVER, -1.0, "", False, 0, _NEVER, -1)


def _apply_event(job: tuple, us: int, seq: int, event: str, error: str | None, limit_us: int) -> tuple:
    """The job after one event; an event older than the last one changes nothing."""
    status, progress, started, completed, duration, message, timed_out, n, last_us, last_seq = job
    if (us, seq) < (last_us, last_seq):
        return job
    if event == "started":
        status, started, timed_out = "processing", us, False
    elif event in ("completed", "failed"):
        status, completed = event, us
        if event == "completed":
            progress = 100.0
        else:
            message = error or ""
        if started != _NEVER:
            duration = (us - started) / 1e6
            timed_out = us - started > limit_us
    return status, progress, started, completed, duration, message, timed_out, n + 1, us, seq


class JobLife(StatefulProcessor):
    """Jobs from their first event until a while after their last, many of them to a key.

    A call, and each access to the store, costs about a millisecond whatever it
    moves, so jobs are dealt to buckets by hash, and a bucket's jobs to pieces
    that double in number as it grows.  A batch reads and writes the pieces of
    the jobs it touches, ``PIECE_JOBS`` jobs each on average at most; the one
    timer of a bucket wakes the pieces in which something is due.
    """

    def __init__(self, limit_us: int, keep_us: int, wait_us: int):
        self.limit_us, self.keep_us, self.wait_us = limit_us, keep_us, wait_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "jobs long, timer long, wakes array<long>")
        self.pieces = handle.getMapState("pieces", "piece int", _PIECE)

    def _wakes_at(self, job: tuple) -> int:
        """When, in event time, something happens to the job by itself."""
        if job[0] == "pending":
            return job[8] + self.wait_us
        if job[0] == "processing" and not job[6]:
            return job[2] + self.limit_us
        return job[8] + self.keep_us

    def _opened(self) -> tuple[int, int, list[int]]:
        """The jobs of the bucket, its timer and when each of its pieces wakes."""
        known = self.head.get()
        return (known[0], known[1], list(known[2])) if known else (0, _NEVER, [_ASLEEP])

    def _read(self, piece: int, wakes: list[int]) -> dict:
        """The piece's jobs, each with its place: ``{job_id: (spot, job)}``."""
        if wakes[piece] == _ASLEEP:  # a job always wakes some time, so there is none
            return {}
        names, spots, *facts = self.pieces.getValue((piece,))
        return dict(zip(names, zip(spots, zip(*facts))))

    def _write(self, piece: int, jobs: dict, wakes: list[int]) -> None:
        if jobs:
            spots, facts = zip(*jobs.values())
            self.pieces.updateValue((piece,), (list(jobs), list(spots), *map(list, zip(*facts))))
        elif wakes[piece] != _ASLEEP:
            self.pieces.removeKey((piece,))
        wakes[piece] = min((self._wakes_at(job) for _, job in jobs.values()), default=_ASLEEP)

    def _close(self, count: int, timer: int, wakes: list[int], fired: int | None = None) -> None:
        """Store the head and see that the timer is that of the first to wake; Spark ends the one that ``fired``."""
        first = min(wakes)
        due = _NEVER if first == _ASLEEP else max(first // 1000, fired or _NEVER) + 1
        if due != timer:
            if timer not in (_NEVER, fired):
                self.handle.deleteTimer(timer)
            if due != _NEVER:
                self.handle.registerTimer(due)
        if due == _NEVER:
            self.head.clear()
        else:
            self.head.update((count, due, wakes))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        events = {}
        for f in rows:
            columns = (f[c].tolist() for c in ("job_id", "spot", "us", "seq", "event", "error_message"))
            for job_id, spot, *event in zip(*columns):
                events.setdefault((job_id, spot), []).append(event)
        count, timer, wakes = self._opened()
        read, out = {}, {}
        for (job_id, spot), its in events.items():
            piece = spot % len(wakes)
            if piece not in read:
                read[piece] = self._read(piece, wakes)
            jobs = read[piece]
            count += job_id not in jobs
            _, job = jobs.get(job_id, (spot, _NEW_JOB))
            for us, seq, event, error in sorted(its, key=lambda e: (e[0], e[1], e[2] or "", e[3] or "")):
                job = _apply_event(job, us, seq, event, error, self.limit_us)
            jobs[job_id], out[job_id] = (spot, job), job
        if count > len(wakes) * PIECE_JOBS:
            read = self._split(count, read, wakes)
        for piece, jobs in read.items():
            self._write(piece, jobs, wakes)
        self._close(count, timer, wakes)
        yield _job_rows(out)

    def _split(self, count: int, read: dict[int, dict], wakes: list[int]) -> dict[int, dict]:
        """All jobs of the bucket in twice as many pieces or more; those ``read`` are newer than the store's."""
        old = [read[piece] if piece in read else self._read(piece, wakes) for piece in range(len(wakes))]
        while count > len(wakes) * PIECE_JOBS:
            wakes += [_ASLEEP] * len(wakes)
        out = {piece: {} for piece in range(len(wakes))}
        for jobs in old:
            for job_id, (spot, job) in jobs.items():
                out[spot % len(wakes)][job_id] = spot, job
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now_us, fired = timerValues.getCurrentWatermarkInMs() * 1000, expiredTimerInfo.getExpiryTimeInMs()
        count, timer, wakes = self._opened()
        if timer != fired:
            return
        out = {}
        for piece in [i for i, wake in enumerate(wakes) if wake < now_us]:
            jobs = self._read(piece, wakes)
            for job_id, (spot, job) in list(jobs.items()):
                if self._wakes_at(job) >= now_us:
                    continue
                if job[0] == "processing" and not job[6]:
                    out[job_id] = job = (*job[:6], True, *job[7:])
                    jobs[job_id] = spot, job
                else:
                    del jobs[job_id]
                    count -= 1
            self._write(piece, jobs, wakes)
        self._close(count, timer, wakes, fired)
        if out:
            yield _job_rows(out)


def _job_rows(jobs: dict) -> pd.DataFrame:
    return pd.DataFrame([(job_id, *job[:8]) for job_id, job in jobs.items()], columns=_names(_JOB_OUTPUT))


def job_lifecycle(
    events: DataFrame,
    delay: str,
    limit_seconds: int = JOB_TIMEOUT_SECONDS,
    keep_seconds: int = KEEP_FINISHED_SECONDS,
    keep_pending_seconds: int = KEEP_PENDING_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """State of each job after every batch that changed it.

    ``events`` is ``(job_id, ts, event, seq, error_message)``.  A started job
    without a finish is marked ``timed_out`` once the watermark is
    ``limit_seconds`` past its start.  A finished or timed-out job is forgotten
    ``keep_seconds`` after its last event, a pending one ``keep_pending_seconds``
    after it; events that come later still start a history of their own.  Events
    without a time have no place in a history: they are left out here, and
    ``without_time`` gives them to whoever keeps the dead letters.  Jobs are dealt
    to ``buckets`` keys, the most tasks that can share a batch.
    """
    life = JobLife(*(n * 1_000_000 for n in (limit_seconds, keep_seconds, keep_pending_seconds)))
    known = events.filter(F.col("ts").isNotNull()).select("job_id", "ts", "event", "seq", "error_message")
    spot = F.pmod(F.xxhash64("job_id", F.lit(1)), F.lit(2**31)).cast("int")
    bucket = F.pmod(F.xxhash64("job_id"), F.lit(buckets)).cast("int")
    timed = event_time(known, "ts", delay).withColumns({"us": micros("ts"), "spot": spot, "bucket": bucket})
    changed = timed.groupBy("bucket").transformWithStateInPandas(life, _JOB_OUTPUT, "update", "EventTime")

    def moment(us: str) -> Column:
        return F.timestamp_micros(F.nullif(F.col(us), F.lit(_NEVER))).cast("timestamp_ntz")

    return changed.select(
        "job_id", "status", "progress_percentage",
        moment("started_us").alias("started_at"), moment("completed_us").alias("completed_at"),
        F.nullif(F.col("duration_seconds"), F.lit(-1.0)).alias("duration_seconds"),
        F.nullif(F.col("error_message"), F.lit("")).alias("error_message"),
        "timed_out", "events",
    )


RATE_OUTPUT = "request_id long, client_id string, ts_us long, allowed boolean, remaining long, reset long"

# Rows of a sorted run in one entry of the store, and runs merged at once.
PIECE_ROWS = 1000
FAN = 16


class Sorted:
    """Puts rows of any number in order while holding few: sorted runs go to the store in pieces and are merged from there.

    A level holds fewer than ``FAN`` runs; more become one run of the next
    level.  So there are ``FAN`` runs for each power of it, and a merge holds
    one piece of each.
    """

    def __init__(self, store):
        self.store, self.next, self.levels, self.held, self.most_held = store, 0, [], 0, 0

    def add(self, us: np.ndarray, ids: np.ndarray, level: int = 0) -> None:
        order = np.lexsort((ids, us))
        self._place(iter([(us[order], ids[order])]), level)

    def _place(self, sorted_parts: Iterator[tuple], level: int) -> None:
        run, pieces = self.next, 0
        self.next += 1
        for us, ids in sorted_parts:
            for at in range(0, len(us), PIECE_ROWS):
                part = slice(at, at + PIECE_ROWS)
                self.store.updateValue((run, pieces), (us[part].tolist(), ids[part].tolist()))
                pieces += 1
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((run, pieces))
        if len(self.levels[level]) == FAN:
            runs, self.levels[level] = self.levels[level], []
            self._place(self._merged(runs), level + 1)

    def _take(self, run: int, piece: int) -> tuple[np.ndarray, np.ndarray]:
        us, ids = self.store.getValue((run, piece))
        self.store.removeKey((run, piece))
        return np.array(us, "int64"), np.array(ids, "int64")

    def _merged(self, runs: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cursors = [[run, 1, pieces, *self._take(run, 0)] for run, pieces in runs if pieces]
        while cursors:
            self.held = sum(len(c[3]) for c in cursors)
            self.most_held = max(self.most_held, self.held)
            # Everything up to the least last row of the pieces at hand can go.
            us, ids = min((c[3][-1], c[4][-1]) for c in cursors)
            taken, left = [], []
            for c in cursors:
                first, last = (int(np.searchsorted(c[3], us, side)) for side in ("left", "right"))
                end = first + int(np.searchsorted(c[4][first:last], ids, "right"))
                taken.append((c[3][:end], c[4][:end]))
                c[3], c[4] = c[3][end:], c[4][end:]
                if not len(c[3]) and c[1] < c[2]:
                    c[3], c[4] = self._take(c[0], c[1])
                    c[1] += 1
                if len(c[3]):
                    left.append(c)
            cursors = left
            at, names = (np.concatenate(x) for x in zip(*taken))
            order = np.lexsort((names, at))
            yield at[order], names[order]

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from self._merged([run for level in self.levels for run in level])
        self.levels = []


class Limiter(StatefulProcessor):
    """One list of accepted instants per client, read once a batch and appended to."""

    def __init__(self, limit: int, window_us: int):
        self.limit, self.window_us = limit, window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.accepted = handle.getListState("accepted", "at_us long, n long")
        self.runs = handle.getMapState("runs", "run int, piece int", "us array<long>, ids array<long>")

    def _in_order(self, frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Times and ids of the frames' rows in parts, in order; one frame is sorted as it is."""
        first, many = None, None
        for frame in frames:
            arrays = frame["us"].to_numpy(), frame["request_id"].to_numpy()
            if first is None:
                first = arrays
                continue
            if many is None:
                many = Sorted(self.runs)
                many.add(*first)
            many.add(*arrays)
        if many is not None:
            yield from many.rows()
        elif first is not None:
            order = np.lexsort((first[1], first[0]))
            yield first[0][order], first[1][order]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = [tuple(x) for x in self.accepted.get()]
        window = AcceptedWindow(self.limit, self.window_us, known)
        for at, ids in self._in_order(rows):
            one, before, accepted = np.ones(len(at), "int64"), np.zeros(len(at), "int64"), np.zeros(len(at), "int64")
            decide_run(window, np.maximum(at, window.newest), one, before, accepted)
            yield pd.DataFrame(
                {
                    "request_id": ids,
                    "client_id": key[0],
                    "ts_us": at,
                    "allowed": accepted > 0,
                    "remaining": np.maximum(0, self.limit - before - accepted),
                    "reset": at // 1_000_000 + self.window_us // 1_000_000,
                }
            )
        now = [(int(t), int(n)) for t, n in window.instants]
        if known and now[: len(known)] == known:
            if len(now) > len(known):
                self.accepted.appendList(now[len(known) :])
        elif now:
            self.accepted.put(now)
        if now and (not known or now[-1][0] != known[-1][0]):
            self.handle.registerTimer((now[-1][0] + self.window_us) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Instants the watermark has left a window behind count for nobody."""
        newest = max((t for t, _ in self.accepted.get()), default=_NEVER)
        if newest < timerValues.getCurrentWatermarkInMs() * 1000 - self.window_us:
            self.accepted.clear()
        return iter(())


def rate_limit_stream(
    log: DataFrame, delay: str, limit: int = RATE_LIMIT_PER_WINDOW, window_seconds: int = RATE_WINDOW_SECONDS
) -> DataFrame:
    """Decide each request as it arrives; at most ``limit`` instants per client.

    A late request is judged at the newest accepted time of its client.  A
    request without a time is not allowed, as in the batch.
    """
    named = log.withColumn("client_id", F.coalesce("client_id", F.lit(UNKNOWN_CLIENT)))
    known = named.filter(F.col("ts").isNotNull()).withColumn("request_id", F.col("request_id").cast("long"))
    timed = event_time(known.select("request_id", "client_id", "ts"), "ts", delay).withColumn("us", micros("ts"))
    limiter = Limiter(limit, window_seconds * 1_000_000)
    decided = timed.groupBy("client_id").transformWithStateInPandas(limiter, RATE_OUTPUT, "append", "EventTime")
    nothing = F.lit(None).cast("long")
    refused = without_time(named).select(
        F.col("request_id").cast("long").alias("request_id"), "client_id", nothing.alias("ts_us"),
        F.lit(False).alias("allowed"), F.lit(0).cast("long").alias("remaining"), nothing.alias("reset"),
    )
    return decided.unionByName(refused)


ALERT_OUTPUT = "metric string, threshold double, action string, at_us long, since_us long, length long, peak double"
_ALERT_STATE = "first long, last long, length long, peak double"


def step_means(points: DataFrame, delay: str, step_seconds: int = 60) -> DataFrame:
    """Points ``(metric, ts, value)`` averaged per metric and closed time step."""
    slot = F.window("ts", f"{step_seconds} seconds").alias("_w")
    steps = event_time(points, "ts", delay).groupBy("metric", slot).agg(F.avg("value").alias("mean"))
    number = F.floor(F.unix_micros("_w.start") / (step_seconds * 1_000_000)).cast("long")
    return steps.select("metric", number.alias("step"), "mean")


def alert_stream(
    steps: DataFrame, triggers: Sequence[Trigger], step_seconds: int = 60, silent_steps: int = SILENT_STEPS
) -> DataFrame:
    """Open an alert when a breach has lasted long enough, resolve it at its end.

    ``steps`` is the stream of ``step_means`` rows, read back from the sink
    they were written to (an aggregation cannot feed a state function within
    one query).  A rule sees one row per step; a step without points ends a
    breach: at the metric's next point, or once the others are ``silent_steps``
    past it.
    """
    step_us = step_seconds * 1_000_000
    ends = F.timestamp_seconds((F.col("step") + 1) * step_seconds)
    timed = event_time(steps.withColumn("at", ends), "at", f"{silent_steps * step_seconds} seconds")
    rules = trigger_table(steps.sparkSession, triggers)
    judged = timed.join(rules, "metric").withColumn("breached", breached(F.col("mean")))

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        metric, _, threshold, needed = key
        run = tuple(state.get) if state.exists else None
        out = []

        def report(action: str, first: int, last: int, length: int, peak: float) -> None:
            out.append((metric, threshold, action, (last + 1) * step_us, first * step_us, length, peak))

        if state.hasTimedOut:
            if run[2] >= needed:
                report("resolve", *run)
            state.remove()
            yield pd.DataFrame(out, columns=_names(ALERT_OUTPUT))
            return
        for row in _sorted(frames, ["step"]).itertuples(index=False):
            if run is not None and (not row.breached or row.step != run[1] + 1):
                if run[2] >= needed:
                    report("resolve", *run)
                run = None
            if not row.breached:
                continue
            if run is None:
                run = (int(row.step), int(row.step), 1, float(row.mean))
            else:
                run = (run[0], int(row.step), run[2] + 1, max(run[3], float(row.mean)))
            if run[2] == needed:
                report("open", *run)
        if run is None:
            state.remove()
        else:
            state.update(run)
            due = (run[1] + 2) * step_seconds * 1000  # the end of the next step
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=_names(ALERT_OUTPUT))

    return judged.groupBy("metric", "op", "threshold", "steps").applyInPandasWithState(
        follow, ALERT_OUTPUT, _ALERT_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
