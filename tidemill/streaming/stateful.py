"""Streaming forms of the keyed-state operators.

Each processor is a ``StatefulProcessor`` for ``transformWithStateInPandas``, with state in the
RocksDB store (checkpointed with the query).  Keys are dealt to ``BUCKETS`` by their hash and a bucket
is the key of the state: the values of its keys are one compressed Arrow table, read and written once a
micro-batch.  So a micro-batch costs a few state calls a bucket, not a few a key, and the rows of all
keys of a bucket are evaluated at once: put in arrival order, each row against the one before it of
its key, the first against the stored value, which is exactly what the reference's per-record state
machine computes.  A state TTL (expire N ms after the last write) is kept a key: an expired value
is never read again, whether or not a batch ran in between, and a bucket whose keys are all
expired is the store's to remove (``ttlDurationMs``).  Sources bound the rows of a micro-batch (files
or offsets per trigger).

Where the values are whole records of very many keys (D1), a bucket's state is kept in ``parts``: a
micro-batch adds one table of the keys that it wrote, and ``MERGE`` tables of a level become one of the
next.  So what a stream writes grows with its rows (times the levels, a logarithm of the
micro-batches), not with its state times the micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

__all__ = ["DailyGate", "DailyLogin", "NewVisitorRepair", "Retract", "FirstSeen", "MonotoneLatest",
           "apply_processor", "DAY_MS", "KeyedProcessor"]

DAY_MS = 86_400_000
#: Buckets that keys are dealt to; fixed for the life of a query's checkpoint.
BUCKETS = 256
#: Parts of a level that are merged into one of the next.
MERGE = 8
_KEY, _BUCKET = "state_key", "state_bucket"


def _days(ms: pd.Series) -> pd.Series:
    """The UTC day of epoch ms, counted from 1970; missing where ``ms`` is."""
    return (ms // DAY_MS).astype("float64")


def _before(values: pd.Series, code: np.ndarray, state: np.ndarray) -> pd.Series:
    """Each row's value of the row before it of its key; the first row's is the stored one."""
    prev = values.groupby(code, sort=False).shift(1)
    first = ~pd.Series(code).duplicated().to_numpy()
    stored = pd.Series(state[code[first]], index=prev.index[first])
    prev[first] = stored.astype(prev.dtype) if prev.dtype != object else stored
    return prev


def _last(values: pd.Series, code: np.ndarray, n: int) -> np.ndarray:
    """The value of each key's last row; None where it is missing."""
    out = np.full(n, None, object)
    out[code] = values.astype(object).where(values.notna(), None).to_numpy()
    return out


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


class KeyedProcessor(StatefulProcessor):
    """Base: ``kind`` (Arrow type of a key's value), ``ttl_ms``, ``order`` and ``process(df, code, state) ->
    (out, new)``.  ``df`` has a bucket's rows in arrival order, ``code`` each row's key as a number,
    ``state`` and ``new`` the keys' values, None where there is none; a ``new`` of None writes nothing.
    ``parts``: whether a bucket's state is one table, or one a micro-batch, merged by levels."""

    kind = pa.string()
    order = "arrival"
    ttl_ms: int | None = None
    parts = False

    def init(self, handle) -> None:
        self._state = (handle.getMapState("parts", "part long", "level int, values binary", self.ttl_ms) if self.parts
                       else handle.getValueState("state", "values binary", self.ttl_ms))

    def process(self, df: pd.DataFrame, code: np.ndarray, state: np.ndarray):  # pragma: no cover - abstract
        raise NotImplementedError

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        df = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable").reset_index(drop=True)
        code, names = pd.factorize(df[_KEY])
        now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_ms else 0
        held = self._load(now)
        keys = pa.array(names, pa.string())
        given = np.full(len(names), None, object)
        for _, _, table in held:  # a later part's value replaces an earlier one's
            at = pc.index_in(table["key"], value_set=keys)
            given[at.drop_null().to_numpy()] = table["value"].filter(pc.is_valid(at)).to_numpy()
        out, new = self.process(df.drop(columns=[_KEY, _BUCKET]), code, given)
        if new is not None:
            self._store(held, keys, new, now)
        yield out

    def _load(self, now: int) -> list[tuple[int, int, pa.Table]]:
        """(number, level, table) of the parts, oldest first; a state of one table is one part."""
        if self.parts:
            packs = sorted((number, level, values) for (number,), (level, values) in self._state.iterator())
        else:
            state = self._state.get()
            packs = [] if state is None else [(0, 0, state[0])]
        held = [(number, level, pa.ipc.open_stream(bytes(values)).read_all()) for number, level, values in packs]
        alive = lambda t: t.filter(pc.greater(t["written"], now - self.ttl_ms)) if self.ttl_ms else t
        return [(number, level, alive(table)) for number, level, table in held]

    def _store(self, held: list[tuple[int, int, pa.Table]], keys: pa.Array, new: np.ndarray, now: int) -> None:
        wrote = np.array([v is not None for v in new], bool)
        if not wrote.any():
            return
        fresh = pa.table({"key": keys.filter(pa.array(wrote)), "value": pa.array(new[wrote].tolist(), self.kind),
                          "written": pa.array(np.full(int(wrote.sum()), now), pa.int64())})
        if not self.parts:
            stays = [t.filter(pc.invert(pc.is_in(t["key"], value_set=fresh["key"]))) for _, _, t in held]
            self._state.update((_packed(pa.concat_tables([*stays, fresh])),))
            return
        number, level, gone = held[-1][0] + 1 if held else 0, 0, []
        # Levels fall from the oldest part to the newest, so those of one level lie together.
        while len(held) >= MERGE - 1 and held[1 - MERGE][1] == level:
            fresh = pa.concat_tables([*[t for _, _, t in held[1 - MERGE:]], fresh])
            fresh = fresh.filter(pa.array(~pd.Series(fresh["key"].to_pandas()).duplicated(keep="last").to_numpy()))
            gone += [n for n, _, _ in held[1 - MERGE:]]
            held, level = held[:1 - MERGE], level + 1
        for n in gone:
            self._state.removeKey((n,))
        self._state.updateValue((number,), (level, _packed(fresh)))

    def close(self) -> None:
        pass


class DailyGate(KeyedProcessor):
    """``flag`` = 1 when the previous record of the key was on another
    date (or there is none).  State: last date, TTL 1 day by default."""

    kind = pa.float64()

    def __init__(self, ts: str = "ts", order: str = "arrival", flag: str = "uv_ct", only_fired: bool = False,
                 ttl_ms: int | None = DAY_MS):
        self.ts, self.order, self.flag, self.only_fired, self.ttl_ms = ts, order, flag, only_fired, ttl_ms

    def process(self, df, code, state):
        day = _days(df[self.ts])
        prev = _before(day, code, state)
        df[self.flag] = (prev.isna() | (day.notna() & (prev != day))).astype("int64")
        return (df[df[self.flag] == 1] if self.only_fired else df), _last(day, code, len(state))


class DailyLogin(KeyedProcessor):
    """Daily-unique login (``uu_ct``) and returning user (``back_ct``: at
    least ``back_days`` whole days since the last login date).  No TTL."""

    kind = pa.float64()

    def __init__(self, ts: str = "ts", order: str = "arrival", back_days: int = 8):
        self.ts, self.order, self.back_days = ts, order, back_days

    def process(self, df, code, state):
        day = _days(df[self.ts])
        prev = _before(day, code, state)
        uu = prev.isna() | (day.notna() & (prev != day))
        days = np.trunc((df[self.ts] - prev * DAY_MS) / DAY_MS)
        back = prev.notna() & uu & (days >= self.back_days)
        df["uu_ct"] = uu.astype("int64")
        df["back_ct"] = back.astype("int64")
        return df[(df["uu_ct"] == 1) | (df["back_ct"] == 1)], _last(day, code, len(state))


class NewVisitorRepair(KeyedProcessor):
    """The first record of a device fixes its first-visit date (its own
    date if ``is_new='1'``, else the day before); later ``is_new='1'`` records
    on other dates are corrected to ``'0'``.  TTL 10 s by default."""

    kind = pa.float64()

    def __init__(self, ts: str = "ts", order: str = "arrival", is_new: str = "is_new",
                 out: str = "is_new_fixed", ttl_ms: int | None = 10_000):
        self.ts, self.order, self.is_new, self.out, self.ttl_ms = ts, order, is_new, out, ttl_ms

    def process(self, df, code, state):
        day = _days(df[self.ts])
        own = day - (df[self.is_new] != "1")
        first = np.full(len(state), None, object)
        first[code[::-1]] = own.to_numpy()[::-1]  # the first row of a key is written last
        known = np.array([v is not None for v in state], bool)
        new = np.where(known, None, first)
        date = np.where(known, state, first)[code].astype("float64")
        df[self.out] = np.where((df[self.is_new] == "1") & (day != date), "0", df[self.is_new])
        return df, new


class Retract(KeyedProcessor):
    """On a repeated id emit the previous record again (``is_retract=1``), then the new one.
    State: last record, TTL 10 s.  A record is one string, so no long or decimal of it passes through
    a double."""

    def __init__(self, record: str = "record", order: str = "arrival", ttl_ms: int | None = 10_000, parts: bool = False):
        self.record, self.order, self.ttl_ms, self.parts = record, order, ttl_ms, parts

    def process(self, df, code, state):
        prev = _before(df[self.record], code, state)
        again = df.assign(**{self.record: prev, "is_retract": 1})[prev.notna()]
        return pd.concat([again, df.assign(is_retract=0)]).sort_index(kind="stable"), _last(df[self.record], code, len(state))


class FirstSeen(KeyedProcessor):
    """``is_first`` = the key (visitor id) was never seen before."""

    kind = pa.bool_()

    def __init__(self, order: str = "arrival", out: str = "is_first"):
        self.order, self.out = order, out

    def process(self, df, code, state):
        unseen = np.array([v is None for v in state], bool)
        df[self.out] = unseen[code] & ~pd.Series(code).duplicated().to_numpy()
        return df, np.where(unseen, True, None)


class MonotoneLatest(KeyedProcessor):
    """D3: pass a record only if its ``ts`` exceeds every earlier ``ts`` of the key.
    State: greatest ts seen, TTL 1 day."""

    kind = pa.int64()

    def __init__(self, ts: str = "ts_ms", order: str = "arrival", ttl_ms: int | None = DAY_MS):
        self.ts, self.order, self.ttl_ms = ts, order, ttl_ms

    def process(self, df, code, state):
        ts = df[self.ts]
        stored = np.array(state, "float64")  # NaN where there is none
        greatest = ts.groupby(code).cummax().groupby(code).ffill()
        prior = np.fmax(greatest.groupby(code).shift(1).to_numpy("float64"), stored[code])
        keep = np.isnan(prior) | (ts > prior)
        top = ts.groupby(code).max()  # by code
        return df[keep], np.array([s if pd.isna(t) else int(t) if s is None else max(int(t), int(s)) for t, s in zip(top, state)], object)


def apply_processor(stream: DataFrame, keys: list[str], processor: KeyedProcessor, output_schema: str,
                    output_mode: str = "append") -> DataFrame:
    """Key the stream and run ``processor`` over it with keyed state (in the RocksDB store, which
    ``jobs.start`` sets for the query)."""
    from ..session import ship_package

    ship_package(stream.sparkSession)
    if "arrival" in stream.columns and stream.schema["arrival"].dataType.simpleString() == "string":
        output_schema = output_schema.replace("arrival long", "arrival string")
    packed = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]), {"ignoreNullFields": "false"})
    dealt = stream.withColumn(_KEY, packed).withColumn(_BUCKET, F.pmod(F.xxhash64(_KEY), F.lit(BUCKETS)).cast("int"))
    return dealt.groupBy(_BUCKET).transformWithStateInPandas(processor, output_schema, output_mode,
                                                             "ProcessingTime" if processor.ttl_ms else "None")
