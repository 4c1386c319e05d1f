"""Long-running jobs followed until they end or their caller gives up."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docmill import rules
from docmill.operators.jobs import STATE_RANK, TERMINAL

#: Jobs are dealt into this many shards, which are the keys of the state.
SHARDS = 4096

_STATE = (
    "job_id array<string>, created_ms array<long>, last_ms array<long>, "
    "ended_ms array<long>, ended_rank array<int>, reported array<boolean>, timer_ms long"
)
OUTPUT = "job_id string, verdict string, waited_ms long, http_status long"
_OUTCOME = {STATE_RANK[status]: status for status in TERMINAL}


class _JobTracker(StatefulProcessor):
    """Reports each job once: its first end within the wait, else a timeout.

    A verdict is held until the watermark has passed it, when no earlier event can
    come any more; so it depends neither on micro-batches nor on the order of arrival.
    A job's state goes away once the retention after its last event has passed.

    A key is a shard of jobs. Its state is read and written as a whole and has one timer,
    at the next time at which something is due, so a job costs no calls of its own.
    """

    def __init__(self, max_wait_ms: int, retention_ms: int) -> None:
        self.max_wait_ms, self.retention_ms = max_wait_ms, retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("jobs", _STATE)

    def _load(self) -> tuple[dict[str, list], int | None]:
        """Per job: created, last, ended, its rank, whether it is reported; and the timer."""
        found = self.state.get()
        if found is None:
            return {}, None
        *columns, timer = found
        return {job: list(facts) for job, *facts in zip(*columns, strict=True)}, timer

    def _save(self, known: dict[str, list], timer: int | None, earliest: int, passed: int | None = None) -> None:
        """Write the shard, and move its timer to what is due next, not before ``earliest``."""
        if timer is not None and timer != passed:
            self.handle.deleteTimer(timer)
        if not known:
            self.state.clear()
            return
        following = max(earliest, min(self._next(facts) for facts in known.values()))
        self.handle.registerTimer(following)
        columns = [list(column) for column in zip(*known.values(), strict=True)]
        self.state.update((list(known), *columns, following))

    def _due(self, created: int, ended: int | None) -> int:
        deadline = created + self.max_wait_ms
        return deadline if ended is None else min(ended, deadline)

    def _next(self, facts: list) -> int:
        created, last, ended, _, reported = facts
        due = self._due(created, ended)
        return max(due, last) + self.retention_ms if reported else due

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        known, timer = self._load()
        for batch in rows:  # one Arrow batch at a time, whatever the key's rows are
            for job, at, status in zip(*(batch[c].tolist() for c in ("job_id", "at_ms", "status")), strict=True):
                facts = known.get(job)
                if facts is None:
                    facts = known[job] = [at, at, None, None, False]
                elif at < facts[0]:
                    facts[0] = at
                elif at > facts[1]:
                    facts[1] = at
                if status in TERMINAL:
                    rank = STATE_RANK[status]
                    if facts[2] is None or (at, rank) < (facts[2], facts[3]):
                        facts[2:4] = at, rank
        self._save(known, timer, 0)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        known, timer = self._load()
        expired = expiredTimerInfo.getExpiryTimeInMs()
        if timer != expired:
            return  # the shard's timer has moved
        now = max(expired, timerValues.getCurrentWatermarkInMs())
        told, kept = [], {}
        for job, facts in known.items():
            created, _, ended, rank, reported = facts
            due = self._due(created, ended)
            if not reported and due <= now:
                in_time = ended is not None and ended <= created + self.max_wait_ms
                told.append((job, _OUTCOME[rank] if in_time else "timeout", due - created, None if in_time else 504))
                facts[4] = True
            elif reported and self._next(facts) <= now:
                continue
            kept[job] = facts
        # what was told now is forgotten at a later time at the earliest
        self._save(kept, timer, now + 1, passed=expired)
        if told:
            names = [column.split()[0] for column in OUTPUT.split(", ")]
            out = pd.DataFrame(told, columns=names)
            out["http_status"] = out["http_status"].astype("Int64")
            yield out

    def close(self) -> None:
        pass


def job_tracker(
    events: DataFrame,
    max_wait_ms: int,
    retention_ms: int = rules.JOB_RETENTION_MS,
    delay: str = "10 minutes",
    shards: int = SHARDS,
) -> DataFrame:
    """One row per job (job_id, ts, status): how and when waiting for it ended.

    The session's state store must be the RocksDB one (``docmill.session.tune``). A task
    holds one of ``shards`` shards of the jobs at a time; a checkpoint keeps their number.
    """
    return (
        events.withWatermark("ts", delay)
        .withColumns({"at_ms": F.unix_millis("ts"), "_shard": F.pmod(F.xxhash64("job_id"), F.lit(shards))})
        .filter(F.col("at_ms").isNotNull())
        .groupBy("_shard")
        .transformWithStateInPandas(
            statefulProcessor=_JobTracker(max_wait_ms, retention_ms),
            outputStructType=OUTPUT,
            outputMode="Append",
            timeMode="EventTime",
        )
    )


_WAITING = "reported boolean"


class _LiveTracker(StatefulProcessor):
    """Reports each job once by the clock: its end when it arrives, a timeout when its wait is over.

    A job's state lives as long as its wait and the retention after its last event; then the
    state store drops it by itself, and the same id is a new job.
    """

    def __init__(self, max_wait_ms: int, retention_ms: int) -> None:
        self.max_wait_ms, self.retention_ms = max_wait_ms, retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("waiting", _WAITING, self.max_wait_ms + self.retention_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        known = self.state.exists()
        reported = known and bool(self.state.get()[0])
        end = None
        for batch in rows:
            ends = batch[batch["status"].isin(TERMINAL)]
            for found in zip(ends["at_ms"], ends["status"].map(STATE_RANK), ends["status"], strict=True):
                end = found if end is None else min(end, found)
        self.state.update((reported or end is not None,))
        if reported:
            return
        if end is not None:
            yield self._row(key, end[2])
        elif not known:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.max_wait_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists() and not self.state.get()[0]:
            self.state.update((True,))
            yield self._row(key, "timeout")

    def _row(self, key, verdict: str) -> pd.DataFrame:
        status = pd.array([504 if verdict == "timeout" else None], dtype="Int64")
        return pd.DataFrame({"job_id": [key[0]], "verdict": [verdict], "http_status": status})

    def close(self) -> None:
        pass


def live_job_tracker(
    events: DataFrame, max_wait_ms: int, retention_ms: int = rules.JOB_RETENTION_MS
) -> DataFrame:
    """One row per job (job_id, ts, status) for callers who wait now: waits go by the clock.

    Use ``job_tracker`` where results must not depend on when events are read. The state
    has a time to live, which needs no watermark. Run it with a processing-time trigger:
    with ``availableNow`` Spark goes on for ever, waiting for the clock.
    """
    return (
        events.withColumn("at_ms", F.unix_millis("ts"))
        .groupBy("job_id")
        .transformWithStateInPandas(
            statefulProcessor=_LiveTracker(max_wait_ms, retention_ms),
            outputStructType="job_id string, verdict string, http_status long",
            outputMode="Append",
            timeMode="ProcessingTime",
        )
    )
