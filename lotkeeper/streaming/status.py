"""Availability of every ad as keyed stream state.

Each ad keeps its last decisive status, the times of its run of failed checks and its last check. A batch reads and writes
the state of its own ads only; the table is never read again. With timers, an ad that stays unavailable without news for
so many days of event time is closed. Probes of an ad are put in order within a batch; a probe that is older than
the ad's last one is reported with the status as it is and changes nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from lotkeeper import fixed_values as fv
from lotkeeper.functions import times as K

#: Failed checks in a row that confirm an ad as unavailable, and days after which an unavailable ad is closed.
IN_A_ROW, CLOSE_DAYS = 3, 14
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times are microseconds in the state and between Spark and Python, which no time zone of a worker can shift.
_STATE = "status string, run array<bigint>, checked_at bigint"
_DAY = 24 * 3600 * 1_000_000
OUTPUT = "ads_id bigint, checked_at bigint, detected_status string, status string, failing_since bigint, event string"
_OUT = Row("ads_id", "checked_at", "detected_status", "status", "failing_since", "event")

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class AdStatus(StatefulProcessor):
    """A row for every probe (event ``probe``) and one when an ad is closed (``closed``)."""

    def __init__(self, decisive: dict[str, str], in_a_row: int, close_days: int | None):
        self.decisive, self.in_a_row, self.close_days = decisive, in_a_row, close_days

    def init(self, handle) -> None:
        self.handle, self.ad, self.seeded = handle, handle.getValueState("ad", _STATE), None

    def _held(self) -> tuple:
        held = self.ad.get()
        return (held[0], list(held[1] or []), held[2]) if held is not None else (None, [], None)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        # of several rows of an ad, which come one after the other, the first counts
        if self.seeded != key and initialState.availability_status is not None:
            self.ad.update((initialState.availability_status, [], None))
        self.seeded = key

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        status, run, last = self._held()
        out = []
        # a probe without a time comes last
        for at, detected in sorted(((r.at, r.detected_status) for r in rows), key=lambda r: (r[0] is None, r[0] or 0)):
            if at is not None and (last is None or at >= last):
                last = at
                status = self.decisive.get(detected, status)
                run = [] if detected == "available" else [*run, at][-self.in_a_row:]
            out.append(_OUT(key[0], at, detected, status or "unknown", run[0] if len(run) == self.in_a_row else None, "probe"))
        self.ad.update((status, run, last))
        if self.close_days is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if status == "unavailable" and last is not None:
                self.handle.registerTimer((last + self.close_days * _DAY) // 1000)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        status, run, _ = self._held()
        due = expiredTimerInfo.getExpiryTimeInMs() * 1000
        since = run[0] if len(run) == self.in_a_row else None
        return iter([_OUT(key[0], due, None, status, since, "closed")])

    def close(self) -> None:
        pass


def stream_status(probes: DataFrame, initial: DataFrame | None = None, in_a_row: int = IN_A_ROW,
                  close_days: int | None = None, delay: str = "0 seconds") -> DataFrame:
    """Public status after every probe of a stream (ads_id, checked_at, detected_status), and since when an ad has failed
    its last ``in_a_row`` checks (null: it has not).

    ``initial`` (ads_id, availability_status) is what was known before. With ``close_days`` an ad that is unavailable
    and gets no probe for so long in event time gives one more row, at that time; probes later than ``delay`` behind the
    newest one are then dropped. Sessions need the state store in ``STATE_STORE`` and time zone UTC. For any split of
    ordered probes into batches the rows are those of ``running_status``, and the last row of every ad says what
    ``confirmed_unavailable`` says of all its checks.
    """
    time = F.col("checked_at").cast("timestamp")
    rows = probes.select(F.col("ads_id").cast("bigint"), time.alias("checked_at"), F.unix_micros(time).alias("at"), "detected_status")
    decisive = {s: ("available" if s == "available" else "unavailable") for s in ("available", *fv.GONE_STATUSES)}
    mode = "None" if close_days is None else "EventTime"
    if close_days is not None:
        rows = rows.withWatermark("checked_at", delay)
    known = None if initial is None else initial.select(
        F.col("ads_id").cast("bigint"), K.kept_status(F.col("availability_status")).alias("availability_status")).groupBy("ads_id")
    # plain rows: a data frame for every ad costs far more than its few probes
    found = rows.groupBy("ads_id").transformWithState(AdStatus(decisive, in_a_row, close_days), OUTPUT, "Update", mode, known)
    return found.withColumns({c: F.timestamp_micros(c) for c in ("checked_at", "failing_since")})
