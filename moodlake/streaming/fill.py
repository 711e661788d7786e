"""A daily series with its gaps filled as time goes on, from state kept per bucket of keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from moodlake.streaming.streams import with_event_time

_DAY_MS = 86_400_000
# Of each key the last value's day, the value and the last day given out; then the waiting observations by place of their key.
_STATE = "keys array<string>, seen array<long>, held array<double>, done array<long>, of array<int>, days array<long>, values array<double>"
_NEVER = -(1 << 62)
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def fill_stream(
    observed: DataFrame, keys: Sequence[str], day: str, value: str, lag: str, max_age: int | None = 7, default: float | None = None,
    buckets: int = 2048,
) -> DataFrame:
    """Every day from a key's first observation on, given out once the watermark has passed it:
    ``(keys, day, filled, age_days)`` in append mode, the values of ``as_of``.

    Keys are dealt over ``buckets`` groups, so that a batch has that many calls and timers at most; a stream that
    starts again must have the same number. The timer of a bucket fires at the end of every day, so a day without
    an observation is filled though no row of the key arrives. Observations wait in the state until their day is given out, in any order;
    of several for one day the largest counts, null values and days do not. A value older than ``max_age`` days is
    not carried: such days have ``default``, or no row without one, and then the key's state is freed
    until it is seen again. With ``max_age=None`` values never expire. The state holds the last
    value and the observations of the days within ``lag``.
    """
    keys = list(keys)
    rows = observed.filter(F.col(day).isNotNull() & F.col(value).isNotNull())
    kinds = T.StructType([T.StructField(k, rows.schema[k].dataType) for k in keys])
    rows = rows.select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"), F.to_json(F.struct(*keys), _JSON).alias("_key"),
        F.unix_date(day).cast("long").alias("_n"), F.col(value).cast("double").alias("_v"), F.col(day).alias("_ts"),
    )
    rows = with_event_time(rows, "_ts", lag)

    def days_of(seen: int, held: float, done: int, waiting: dict, mark: int) -> tuple[int, float, int, list, list, list]:
        """The state of a key after ``mark``, and the days, values and ages given out; takes them from ``waiting``."""
        days, filled, ages = [], [], []
        at = min(waiting) if done == _NEVER else done + 1
        while at < mark:
            if at in waiting:
                seen, held = at, waiting.pop(at)
            if max_age is None or at - seen <= max_age:
                days.append(at), filled.append(held), ages.append(at - seen)
            elif default is not None:
                days.append(at), filled.append(default), ages.append(None)
            else:
                # Nothing is given out before the key's next observation.
                at = min(waiting, default=mark) - 1
            done, at = at, at + 1
        return seen, held, done, days, filled, ages

    def fill(_: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        series: dict[str, tuple[int, float, int, dict]] = {}
        if state.exists:
            names, *last, of, days, values = state.get
            series = {k: (*x, {}) for k, *x in zip(names, *last)}
            for i, n, v in zip(of, days, values):
                series[names[i]][3][n] = v
        if not state.hasTimedOut:
            for frame in frames:
                for k, n, v in zip(frame["_key"].tolist(), frame["_n"].tolist(), frame["_v"].tolist()):
                    _, _, done, waiting = series.setdefault(k, (_NEVER, 0.0, _NEVER, {}))
                    if n > done:
                        waiting[n] = max(v, waiting.get(n, v))
        mark = max(0, state.getCurrentWatermarkMs()) // _DAY_MS
        out, left = ([], [], [], []), ([], [], [], [], [], [], [])
        for k, (seen, held, done, waiting) in series.items():
            seen, held, done, *found = days_of(seen, held, done, waiting, mark)
            for column, more in zip(out, ([k] * len(found[0]), *found)):
                column += more
            expired = default is None and max_age is not None and seen != _NEVER and mark - seen > max_age
            if waiting or not expired:
                order = sorted(waiting)
                for column, more in zip(left, ([k], [seen], [held], [done], [len(left[0])] * len(order), order, [waiting[n] for n in order])):
                    column += more
        if left[0]:
            state.update(left)
            state.setTimeoutTimestamp((mark + 1) * _DAY_MS)
        elif state.exists:
            state.remove()
        k, n, filled, ages = out
        yield pd.DataFrame({
            "_key": pd.Series(k, dtype=object), "_n": pd.Series(n, dtype="int64"), "filled": pd.Series(filled, dtype=float),
            "age_days": pd.Series(ages, dtype="Int64"),
        })

    schema = "_key string, _n long, filled double, age_days long"
    filled = rows.groupBy("_bucket").applyInPandasWithState(fill, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    filled = filled.withColumn("_key", F.from_json("_key", kinds, _JSON))
    days = F.date_from_unix_date(F.col("_n").cast("int")).alias(day)
    return filled.select(*[F.col("_key")[k].alias(k) for k in keys], days, "filled", F.col("age_days").cast("int").alias("age_days"))
