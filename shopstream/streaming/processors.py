"""State of devices for streams, a shard of devices at a time.

A processor's key is a shard, a fixed share of the devices, so that one call takes
the rows of many devices as one table and orders them in vectors. Their state is a
map: by device, by device and day, or by stretch of time, and a call touches only
the entries its rows fall on. Rows of a micro-batch reach a processor in no given
order. How many rows a shard has in a batch is bounded by the source's
per-trigger limit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shopstream.functions.times import DAY_MS

KEPT, LATE = "kept", "late"


def in_order(frames: Iterable[pd.DataFrame], *order: str) -> pd.DataFrame:
    """All rows of a shard, ordered; rows equal in all of ``order`` stay as they came."""
    frames = list(frames)
    rows = pd.concat(frames, ignore_index=True) if len(frames) != 1 else frames[0]
    return rows.sort_values(list(order), kind="stable", ignore_index=True)


class ShardProcessor(StatefulProcessor):
    def close(self) -> None:
        pass


class FirstDay(ShardProcessor):
    """Gives each row flagged new the day of its device's first such row, by arrival.

    Input rows: mid, arrival, day and what else is to be handed on. A device's day is kept for good.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = handle.getMapState("first_day", "mid STRING", "day STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = in_order(rows, "mid", "arrival")
        opening = rows.drop_duplicates("mid")
        known = {}
        for mid, day in zip(opening["mid"], opening["day"]):
            found = self._first.getValue((mid,))
            if found is None:
                self._first.updateValue((mid,), (day,))
            known[mid] = day if found is None else found[0]
        rows["first_day"] = rows["mid"].map(known)
        yield rows.drop(columns="shard")


class DayChange(ShardProcessor):
    """Passes the rows whose day differs from the one their device last had, by arrival.

    Input rows: mid, value, arrival, day. With ``ttl_ms`` the day is forgotten
    that long after it was written, by the wall clock.
    """

    def __init__(self, ttl_ms: int | None = None) -> None:
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getMapState("last_day", "mid STRING", "day STRING", self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = in_order(rows, "mid", "arrival")
        mids, days = rows["mid"].to_numpy(), rows["day"].to_numpy()
        first = np.r_[True, mids[1:] != mids[:-1]]
        before = np.r_[[None], days[:-1]]
        for at in np.flatnonzero(first).tolist():
            found = self._last.getValue((mids[at],))
            before[at] = found[0] if found else None
        opens = days != before
        last = np.r_[np.flatnonzero(first)[1:], len(rows)] - 1
        # Written on each opening, even if the days end where they began: that renews the expiry.
        for start, end in zip(np.flatnonzero(first).tolist(), last.tolist()):
            if opens[start:end + 1].any():
                self._last.updateValue((mids[start],), (days[end],))
        yield rows.loc[opens, ["mid", "value", "arrival", "day"]]


MIDS = pa.schema([("mid", pa.string())])


class FirstOfDay(ShardProcessor):
    """Passes each device's first row of a day, by arrival, and the rows that come after the day is forgotten as late.

    Input rows: mid, value, arrival, day, day_end, part. A day's devices are kept
    as one table for each ``part``, a fixed share of the shard's devices, so a call
    reads and writes as many entries as its rows have days and parts, not devices.
    They are kept until the watermark passes the day's end, told by a timer, so rows
    that are late themselves still count as long as their day is known.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._seen = handle.getMapState("devices", "day_end BIGINT, part INT", "mids BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        rows = in_order(rows, "mid", "day", "arrival")
        rows["kind"] = np.where(rows["day_end"] <= watermark, LATE, KEPT)
        first = ~rows.duplicated(["mid", "day"]) & (rows["kind"] == KEPT)
        for (end, part), mids in rows.loc[first].groupby(["day_end", "part"])["mid"]:
            entry = (int(end), int(part))
            found = self._seen.getValue(entry)
            known = [unpacked(bytes(found[0]))] if found else []
            again = mids.isin(known[0]["mid"]) if known else pd.Series(False, index=mids.index)
            first[mids.index[again]] = False
            if not again.all():
                self._seen.updateValue(entry, (packed(pd.concat([*known, mids[~again].to_frame()]), MIDS),))
        for end in rows.loc[first, "day_end"].unique().tolist():
            self._handle.registerTimer(end)
        yield rows.loc[first | (rows["kind"] == LATE), ["kind", "mid", "value", "arrival"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        for entry in [k for k in self._seen.keys() if k[0] <= end]:
            self._seen.removeKey(tuple(entry))
        yield pd.DataFrame(columns=["kind", "mid", "value", "arrival"])


PAGE = ["mid", "ts", "arrival", "value"]


def page_schema(kind: str) -> pa.Schema:
    position = pa.string() if kind == "STRING" else pa.int64()
    return pa.schema([("mid", pa.string()), ("ts", pa.int64()), ("arrival", position), ("value", pa.string())])


def packed(rows: pd.DataFrame, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_batch(pa.RecordBatch.from_pandas(rows[schema.names], schema, preserve_index=False))
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


class Bounce(ShardProcessor):
    """Passes entry pages that no page of their device follows within the gap, and late pages as such.

    Input rows: mid, value, arrival, ts, entry. Pages are kept by stretches of
    time at least as long as the gap, so new pages meet those of their own stretch
    and the two beside it, and no others. An entry page waits until a page follows
    it, or the watermark has passed its gap; the times of pages stay as long as an
    earlier page may still come. A shard has one timer, for the first page of it
    that waits or goes. A page is late if the watermark has passed it.
    """

    def __init__(self, gap_ms: int, kind: str = "BIGINT", stretch_ms: int = DAY_MS) -> None:
        self._gap, self._width, self._kind = gap_ms, max(1, gap_ms, stretch_ms), kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._pages = handle.getMapState("pages", "stretch BIGINT", "pages BINARY")
        self._next = handle.getValueState("next", "at BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        rows = pd.concat(list(rows), ignore_index=True)
        late = (rows["ts"] <= watermark) & (watermark > 0)  # zero: there is none yet
        yield self._out(rows[late], LATE)
        rows["value"] = rows["value"].where(rows["entry"], None)  # the text of other pages is of no use any more
        new = rows.loc[~late, PAGE]
        on = np.unique(new["ts"].to_numpy(dtype=np.int64) // self._width)
        due, at = self._settled(new, np.unique(np.r_[on - 1, on, on + 1]).tolist(), set(on.tolist()), watermark)
        self._wake(at, self._next.get()[0] if self._next.exists() else None)
        yield due

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        stretches = [k[0] for k in self._pages.keys()]
        begun = [x for x in stretches if x * self._width <= watermark]
        due, at = self._settled(pd.DataFrame(columns=PAGE), begun, set(begun), watermark)
        later = [x * self._width + self._gap for x in stretches if x * self._width > watermark]
        self._next.clear()
        self._wake(min([*later, *([] if at is None else [at])], default=None), None)
        yield due

    def _wake(self, at: int | None, before: int | None) -> None:
        """Sets the shard's timer to ``at`` unless it stands earlier already."""
        if at is not None and (before is None or at < before):
            if before is not None:
                self._handle.deleteTimer(before)
            self._handle.registerTimer(at)
            self._next.update((at,))

    def _out(self, rows: pd.DataFrame, kind: str) -> pd.DataFrame:
        out = rows[["mid", "value", "arrival", "ts"]].astype({"ts": "int64"} | ({"arrival": "int64"} if self._kind == "BIGINT" else {}))
        out.insert(0, "kind", kind)
        return out

    def _settled(self, new: pd.DataFrame, near: list[int], on: set[int], watermark: int) -> tuple[pd.DataFrame, int | None]:
        """The entry pages that are due, and when the next page of the stretches ``near`` will be due or go.

        What is left of the stretches goes back where it changed, and ``on`` in any case.
        """
        held = {}
        for stretch in near:
            found = self._pages.getValue((stretch,))
            if found is not None:
                held[stretch] = unpacked(bytes(found[0]))
        parts = [p for p in (new, *held.values()) if len(p)]
        if not parts:
            return self._out(pd.DataFrame(columns=PAGE), KEPT), None
        pages = in_order(parts, "mid", "ts", "arrival")
        mid, ts = pages["mid"].to_numpy(), pages["ts"].to_numpy(dtype=np.int64)
        waits = pages["value"].notna().to_numpy()
        followed = np.r_[(mid[1:] == mid[:-1]) & (ts[1:] - ts[:-1] < self._gap), False]
        due = waits & ~followed & (ts + self._gap <= watermark)
        left = waits & ~followed & ~due
        out = self._out(pages[due], KEPT)
        pages["value"] = pages["value"].where(left, None)
        stretches = ts // self._width
        stays = left | (ts > watermark)
        for stretch in set(np.unique(stretches[waits & ~left]).tolist()) | on:
            here = stays & (stretches == stretch)
            if here.any():
                self._pages.updateValue((stretch,), (packed(pages[here], page_schema(self._kind)),))
            elif stretch in held:
                self._pages.removeKey((stretch,))
        ends = np.where(left, ts + self._gap, (stretches + 1) * self._width)[stays]
        return out, int(ends.min()) if len(ends) else None
