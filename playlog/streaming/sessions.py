"""Sessions over a stream in which plays may come however late.

State is kept for each key and slot of time, a slot being as long as the gap: plays of one slot are always of one
session, and only neighbouring slots can be joined, so a late play looks at its own session's slots and no others. A
session that changes is given out again under its first play's time; if it has begun earlier or taken up another
session, what was given out under the old times is taken back. Slots never expire: they lie in RocksDB, in a row for each
block of ``BLOCK`` slots in which a key has played, so that a batch asks for a key's blocks and not for each slot. Checkpoints
of versions that kept a row for each slot are not taken over: replay the plays into a new one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.merge import append
from ..operators.sessions import GAP_MINUTES

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "artist_name string, started long, ended long, streams long, ms_played long, gone boolean"


#: Slots of a row of state, whose value has up to so many rows of six whole numbers.
BLOCK = 1024
_NONE = np.iinfo(np.int64).min


class Sessions(StatefulProcessor):
    """Turns a key's plays (micros, ms_played) into changes of its sessions."""

    def __init__(self, gap_micros: int):
        self.gap = gap_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        # rows of (slot, its first and last play, sums, and the start under which a session that begins here was given out)
        self.blocks = handle.getMapState("blocks", "block long", "slots binary")
        self.held: dict[int, dict[int, tuple]] = {}
        self.changed: set[int] = set()

    def close(self) -> None:
        pass

    def _block(self, block: int) -> dict[int, tuple]:
        """The slots of a block, which is read once for each call of a key."""
        if block not in self.held:
            found = np.frombuffer(self.blocks.getValue((block,))[0], np.int64).reshape(-1, 6).tolist() if self.blocks.containsKey((block,)) else []
            self.held[block] = {r[0]: (*r[1:5], None if r[5] == _NONE else r[5]) for r in found}
        return self.held[block]

    def _slot(self, slot: int) -> tuple | None:
        return self._block(slot // BLOCK).get(slot)

    def _put(self, slot: int, value: tuple) -> None:
        self._block(slot // BLOCK)[slot] = value
        self.changed.add(slot // BLOCK)

    def _store(self) -> None:
        for block in self.changed:
            rows = [(slot, *v[:4], _NONE if v[4] is None else v[4]) for slot, v in sorted(self.held[block].items())]
            self.blocks.updateValue((block,), (np.array(rows, np.int64).tobytes(),))
        self.held, self.changed = {}, set()

    def _chain(self, slot: int) -> list[tuple[int, tuple]]:
        """The slots of the session that ``slot`` belongs to, in order."""
        own = [(slot, self._slot(slot))]
        while (before := self._slot(own[0][0] - 1)) and own[0][1][0] - before[1] < self.gap:
            own.insert(0, (own[0][0] - 1, before))
        while (after := self._slot(own[-1][0] + 1)) and after[0] - own[-1][1][1] < self.gap:
            own.append((own[-1][0] + 1, after))
        return own

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        touched = set()
        for part in rows:
            micros, ms_played = part["micros"].to_numpy(np.int64), part["ms_played"].to_numpy(np.int64)
            if not len(micros):
                continue
            order = np.argsort(micros, kind="stable")
            micros, ms_played = micros[order], ms_played[order]
            slots, begins = np.unique(micros // self.gap, return_index=True)
            ends = np.append(begins[1:], len(micros))
            for slot, first, last, streams, ms in zip(*(c.tolist() for c in (slots, micros[begins], micros[ends - 1], ends - begins, np.add.reduceat(ms_played, begins))), strict=True):
                held = self._slot(slot)
                self._put(slot, (min(first, held[0]), max(last, held[1]), streams + held[2], ms + held[3], held[4]) if held else (first, last, streams, ms, None))
                touched.add(slot)
        out = []
        while touched:
            chain = self._chain(next(iter(touched)))
            touched -= {slot for slot, _ in chain}
            start = chain[0][1][0]
            for k, (slot, held) in enumerate(chain):
                given = start if k == 0 else None
                if held[4] is not None and held[4] != start:
                    out.append((key[0], held[4], None, None, None, True))
                if held[4] != given:
                    self._put(slot, (*held[:4], given))
            out.append((key[0], start, chain[-1][1][1], sum(h[2] for _, h in chain), sum(h[3] for _, h in chain), False))
        self._store()
        # a time that one session has left and another has taken is given out, not taken back
        kept = {r[1] for r in out if not r[5]}
        out = [r for r in out if not (r[5] and r[1] in kept)]
        frame = pd.DataFrame(out, columns=["artist_name", "started", "ended", "streams", "ms_played", "gone"])
        yield frame.astype({"ended": "Int64", "streams": "Int64", "ms_played": "Int64"})


def session_changes(events: DataFrame, key: str, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Changes of each key's sessions over streamed plays (``key``, played_at, ms_played); plays without a time have no session, and without a length are of length 0."""
    conf = events.sparkSession.conf
    if conf.get("spark.sql.streaming.stateStore.providerClass", None) != ROCKSDB:
        conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    plays = events.filter("played_at IS NOT NULL").select(F.col(key).cast("string").alias("artist_name"), F.unix_micros(F.col("played_at").cast("timestamp")).alias("micros"), F.coalesce(F.col("ms_played"), F.lit(0)).cast("long").alias("ms_played"))
    return plays.groupBy("artist_name").transformWithStateInPandas(Sessions(gap_minutes * 60_000_000), CHANGES, "Update", "None")


def keep_sessions(events: DataFrame, table: str, key: str, checkpoint: str, gap_minutes: int = GAP_MINUTES, available_now: bool = True) -> StreamingQuery:
    """Append the changes of sessions to ``table``, each with its batch; a batch that is replayed says the same again."""

    def add(batch: DataFrame, number: int) -> None:
        append(batch.withColumn("batch", F.lit(number).cast("long")), table)

    writer = session_changes(events, key, gap_minutes).writeStream.foreachBatch(add).outputMode("update").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 minutes")).start()


def current_sessions(changes: DataFrame, key: str) -> DataFrame:
    """The sessions that the changes add up to: the newest word on each (key, start), unless it was taken back."""
    last = changes.groupBy("artist_name", "started").agg(F.max(F.struct("batch", ~F.col("gone"), "ended", "streams", "ms_played", "gone")).alias("last"))
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return last.filter("NOT last.gone").select(F.col("artist_name").alias(key), at("started").alias("session_start"), at("last.ended").alias("session_end"), "last.streams", "last.ms_played")
