"""A fixed-window limiter by key, whose window opens with the first request after the last window's end."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

WINDOW_MS, MOST = 60_000, 60
OUT = "key string, ts_ms long, count long, allowed boolean, remaining long, retry_after long"


def step(ts: np.ndarray, resets: int, count: int, window: int, most: int) -> tuple[list[tuple[int, bool, int, int]], int, int]:
    """(count, allowed, remaining, seconds to wait) of requests in order of time; the state after them.

    A request beyond the limit counts, too.
    """
    out = []
    for t in ts.tolist():
        if resets <= t:
            resets, count = t + window, 0
        count += 1
        out.append((count, count <= most, max(0, most - count), max(1, -(-(resets - t) // 1000))))
    return out, resets, count


def _frame(key: str, ts: np.ndarray, rows: list) -> pd.DataFrame:
    c = list(zip(*rows)) if rows else [(), (), (), ()]
    return pd.DataFrame({"key": key, "ts_ms": ts, "count": c[0], "allowed": c[1], "remaining": c[2], "retry_after": c[3]})


def limited(requests: DataFrame, window: int = WINDOW_MS, most: int = MOST) -> DataFrame:
    """The same for a table of requests (key, ts_ms)."""

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        ts = np.sort(g["ts_ms"].to_numpy(np.int64))
        return _frame(key[0], ts, step(ts, -(1 << 62), 0, window, most)[0])

    return requests.select(F.col("key").cast("string"), "ts_ms").where("key is not null and ts_ms is not null").groupBy("key").applyInPandas(run, OUT)


def limited_stream(requests: DataFrame, window: int = WINDOW_MS, most: int = MOST) -> DataFrame:
    """The same for a stream; a key's state is dropped when its window has been over for a while."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        resets, count = state.get if state.exists else (-(1 << 62), 0)
        parts = [b["ts_ms"].to_numpy(np.int64) for b in batches]
        ts = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        rows, resets, count = step(ts, resets, count, window, most)
        state.update((resets, count))
        state.setTimeoutDuration(2 * window)
        yield _frame(key[0], ts, rows)

    keyed = requests.select(F.col("key").cast("string"), "ts_ms").where("key is not null and ts_ms is not null").groupBy("key")
    return keyed.applyInPandasWithState(run, OUT, "resets long, count long", "append", GroupStateTimeout.ProcessingTimeTimeout)
