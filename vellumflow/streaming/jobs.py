"""Job records as a stream: keyed state with an expiry, indexes kept up to date, staged processing with quarantine.

The batch operators in operators.state are the specification: fed with the same records, in any order and
repeated, the stream's last row of each job equals theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vellumflow.operators.state import ACTIVE, DONE, FAILED
from vellumflow.runtime import ship_package

EXPIRY_MS = 7 * 24 * 3600 * 1000
OUTPUT = "job_id string, status string, active_since timestamp, succeeded_at timestamp, failed boolean, expired boolean"
STATE = "status string, status_seq long, stop_seq long, last_seq long, last_us long, broken boolean, seqs array<long>, times array<long>"


def _micros(t: Any) -> int | None:
    return None if pd.isna(t) else pd.Timestamp(t).value // 1000


def _time(us: int | None) -> pd.Timestamp:
    return pd.NaT if us is None else pd.Timestamp(us * 1000)


def merge(state: tuple, rows: Iterator[tuple]) -> tuple:
    """State after rows (seq, status, index_error, micros). Rows may come late or twice: everything goes by seq.

    Of active rows only those after the last inactive one are kept, as the others can't matter any more.
    """
    status, status_seq, stop, last_seq, last_us, broken, seqs, times = state
    streak = dict(zip(seqs, times, strict=True))
    for seq, new, error, us in rows:
        if last_seq is None or seq > last_seq:
            last_seq, last_us = seq, us
        broken = broken or bool(error)
        if new is None:
            continue
        if status_seq is None or seq > status_seq:
            status, status_seq = new, seq
        if new in ACTIVE:
            if stop is None or seq > stop:
                streak[seq] = us
        elif stop is None or seq > stop:
            stop = seq
    streak = {s: t for s, t in streak.items() if stop is None or s > stop}
    order = sorted(streak)
    return status, status_seq, stop, last_seq, last_us, broken, order, [streak[s] for s in order]


def index_row(job: str, state: tuple, expired: bool = False) -> pd.DataFrame:
    status, _, _, _, last_us, broken, _, times = state
    known = [t for t in times if t is not None]
    since = min(known) if status in ACTIVE and known else None
    done = last_us if status in DONE and not broken else None
    return pd.DataFrame({"job_id": [job], "status": [status], "active_since": [_time(since)], "succeeded_at": [_time(done)], "failed": [bool(status in FAILED or broken)], "expired": [expired]})


def job_index_stream(records: DataFrame, expiry_ms: int = EXPIRY_MS) -> DataFrame:
    """A stream of index rows, one for each job touched by a batch; jobs silent for ``expiry_ms`` send a last row marked expired and are forgotten. Rows without a job or seq are left out."""
    ship_package(records.sparkSession)

    def step(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        empty = (None, None, None, None, None, False, [], [])
        if held.hasTimedOut:
            last = held.get
            held.remove()
            yield index_row(key[0], (*last[:6], list(last[6]), list(last[7])), True)
            return
        now = held.get if held.exists else empty
        now = (*now[:6], list(now[6]), list(now[7]))
        for f in frames:
            rows = ((int(s), None if pd.isna(a) else a, None if pd.isna(e) else e, _micros(t)) for s, a, e, t in zip(f["seq"], f["status"], f["index_error"], f["updated_at"], strict=True))
            now = merge(now, rows)
        held.update(now)
        held.setTimeoutDuration(expiry_ms)
        yield index_row(key[0], now)

    rows = records.select("job_id", "seq", "status", "index_error", "updated_at").where("job_id is not null and seq is not null")
    return rows.groupBy("job_id").applyInPandasWithState(step, OUTPUT, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)


def run_stage(stream: DataFrame, work: Callable[[DataFrame], DataFrame], good: str, bad: str, checkpoint: str, valid: Callable[[DataFrame], Any]) -> StreamingQuery:
    """One stage of a chain: rows that are valid are worked on and appended to ``good``, others go to ``bad`` with their batch; started again from its checkpoint it repeats nothing.

    Batches are written under their number, so one that runs twice overwrites itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            ok = valid(batch)
            work(batch.where(ok)).write.mode("overwrite").parquet(f"{good}/batch={number}")
            batch.where(~ok | ok.isNull()).write.mode("overwrite").parquet(f"{bad}/batch={number}")
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
