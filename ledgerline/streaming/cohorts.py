"""Cohorts of loans on unbounded input, in any order of months: the outcomes of the batch form, each told once.

A loan's months wait in its state until the watermark passes them and are judged in order then, so that a month may come
after later ones. An event-time timer stands for each month that waits, and for the month after the last one judged: that
month's absence ends what is open. A cohort is open for ``window`` months at most; a loan that is heard of no more leaves
no state behind."""

from __future__ import annotations

import calendar
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import scalars as S
from ..plans.cube import is_active_loan
from ..plans.transitions import KEY, THRESHOLD, WINDOW
from .joins import month_start

OUTCOME = ", ".join(f"{k} string" for k in KEY) + ", kind string, month int, upb long, status string"
#: The state store that timers and maps need.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def states(loans: DataFrame, view: str = "latest", delay: str = "62 days") -> DataFrame:
    """A row for each version of a loan's month, with its rank and its event time. Null parts of the key become empty."""
    state = [F.coalesce(is_active_loan(), F.lit(False)).alias("active"), F.coalesce("current_upb_cents", F.lit(0)).cast("long").alias("upb"), F.col("days_delinquent").cast("int").alias("days"), (F.trim(F.coalesce("modification_program", F.lit(""))) != "").alias("modified")]
    rank = F.concat_ws("\x1f", *(F.coalesce(F.col(c), F.lit("")) for c in ("as_of_timestamp", "publication_date", "source_file")), F.format_string("%020d", F.coalesce("source_row", F.lit(0)).cast("long")))
    out = loans.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in KEY), month_start(F.col("report_period")).alias("at"), S.month_index(F.col("report_period")).cast("int").alias("month"), rank.alias("rank"), *state)
    return out.where("at is not null").withWatermark("at", delay)


def start_of(month: int) -> int:
    """Milliseconds of a month's first moment; ``month`` counts 12 a year, January of year y being 12 y + 1."""
    return calendar.timegm(((month - 1) // 12, (month - 1) % 12 + 1, 1, 0, 0, 0)) * 1000


def month_at(millis: int) -> int:
    day = datetime.fromtimestamp(millis // 1000, UTC)
    return day.year * 12 + day.month


class Cohorts(StatefulProcessor):
    """Months that wait, the last one judged, and the cohorts that are open, of one loan."""

    def __init__(self, last_ranks: bool, threshold: int, window: int):
        self.last_ranks, self.threshold, self.window = last_ranks, threshold, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "month int", "rank string, active boolean, upb long, days int, modified boolean")
        self.last = handle.getValueState("last", "month int, active boolean, days int, modified boolean")
        self.open = handle.getMapState("open", "kind string, month int", "upb long")

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self.last.update((initialState.last_month, initialState.active, initialState.days, initialState.modified))
        for c in initialState.open or ():
            self.open.updateValue((c["kind"], c["month"]), (c["upb"],))
        self.handle.registerTimer(start_of(initialState.last_month + 1))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        judged = self.last.get()[0] if self.last.exists() else None
        best: dict[int, tuple] = {}
        for r in rows:
            if judged is None or r.month > judged:
                new = (r["rank"], r.active, r.upb, r.days, r.modified)
                best[r.month] = self._better(best.get(r.month), new)
        for month, new in best.items():
            old = tuple(self.waiting.getValue((month,))) if self.waiting.containsKey((month,)) else None
            self.waiting.updateValue((month,), self._better(old, new))
            self.handle.registerTimer(start_of(month))
        return iter(())

    def _better(self, old: tuple | None, new: tuple) -> tuple:
        return new if old is None or (new[0] > old[0]) == self.last_ranks else old

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        # All that the watermark has passed, as timers set here fire only with a later batch.
        now = max(month_at(expiredTimerInfo.getExpiryTimeInMs()), month_at(max(0, timerValues.getCurrentWatermarkInMs())))
        last = tuple(self.last.get()) if self.last.exists() else None
        cohorts = {tuple(k): v[0] for k, v in self.open.iterator()}
        done: list[tuple[str, int, int, str]] = []
        ready = sorted((k[0], tuple(v)) for k, v in self.waiting.iterator() if k[0] <= now)
        for month, (_, active, upb, days, modified) in ready:
            near = last is not None and last[0] == month - 1
            for (kind, start), balance in list(cohorts.items()):
                status = self._status(near and active, days, month - start)
                if status:
                    done.append((kind, start, balance, status))
                    self._close(cohorts, kind, start)
            if near and active and last[1]:
                hits = {"cure": last[2] is not None and last[2] >= self.threshold and days == 0, "modification": modified and not last[3]}
                for kind in (k for k, hit in hits.items() if hit):
                    cohorts[kind, month] = upb
                    self.open.updateValue((kind, month), (upb,))
            last = (month, active, days, modified)
            self.waiting.removeKey((month,))
        if last is not None and last[0] < now:  # the month after it never came
            for (kind, start), balance in list(cohorts.items()):
                done.append((kind, start, balance, "censored"))
                self._close(cohorts, kind, start)
            self.last.clear()
        elif ready:
            self.last.update(last)
            self.handle.registerTimer(start_of(last[0] + 1))
        for kind, start, balance, status in done:
            yield Row(**dict(zip(KEY, key)), kind=kind, month=start, upb=balance, status=status)

    def _status(self, seen: bool, days: int | None, age: int) -> str | None:
        if not seen or days is None:
            return "censored"
        if days >= self.threshold:
            return "redefault"
        return "complete" if age >= self.window else None

    def _close(self, cohorts: dict, kind: str, start: int) -> None:
        del cohorts[kind, start]
        self.open.removeKey((kind, start))

    def close(self) -> None:
        pass


def frontier_states(frontier: DataFrame, view: str = "latest") -> DataFrame:
    """One view of the frontier that ``incremental.TransitionStore`` keeps, as the state that a stream starts from."""
    own = F.filter("open", lambda c: c["view"] == view)
    opened = F.transform(own, lambda c: F.struct(c["kind"].alias("kind"), c["month"].cast("int").alias("month"), c["upb"].cast("long").alias("upb")))
    state = F.col(view)
    return frontier.select(*(F.coalesce(F.col(k), F.lit("")).alias(k) for k in KEY), F.col("month").cast("int").alias("last_month"), F.coalesce(state["active"], F.lit(False)).alias("active"), state["days"].cast("int").alias("days"), F.coalesce(state["modified"], F.lit(False)).alias("modified"), opened.alias("open"))


def outcomes(stream: DataFrame, view: str = "latest", initial: DataFrame | None = None, threshold: int = THRESHOLD, window: int = WINDOW) -> DataFrame:
    """The outcome of each cohort that starts in ``stream`` (of ``states``) or is open in ``initial`` (of ``frontier_states``).

    The session needs the state store ``PROVIDER`` (see ``started``). Of several versions of a month the last in rank counts,
    in the original view the first, as long as the watermark hasn't passed the month; rows of months that were judged
    are left out. Key: a loan, whose rows are few; cohorts still open have no row yet."""
    grouped = stream.groupBy(*KEY)
    return grouped.transformWithState(Cohorts(view == "latest", threshold, window), OUTCOME, "Append", "EventTime", initialState=None if initial is None else initial.groupBy(*KEY))


def started(writer, spark) -> StreamingQuery:
    """Starts a ``writeStream`` with the state store that it needs; the session's own setting stays as it was."""
    name, needed = PROVIDER
    own = spark.conf.get(name, None)
    spark.conf.set(name, needed)
    try:
        return writer.start()
    finally:
        if own is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, own)
