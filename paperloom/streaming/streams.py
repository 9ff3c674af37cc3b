"""Streams: windowed counts with watermarks, deduplication, keyed history and resumable batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from paperloom.functions import constants as K

#: White space as the plans' patterns have it.
WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, schema: str = EVENTS, pattern: str = "events.parquet") -> DataFrame:
    """A file stream of events with their times as instants."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, length: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; the same for a stream and a table."""
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    out = events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """A user's sessions: events with no longer gap between them."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def deduplicated(events: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """The first of each key within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there, into a table in memory (for tests and small results)."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream over what is there, into files; a restart goes on where it ended."""
    stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def after_turn(history: str, question: str | None, answer: str | None, limit: int = K.HISTORY_CHARS) -> str:
    """``folds.append_turn`` for one turn at a time."""

    def tail(text: str) -> str:
        s = " ".join(WHITE.split(text)).strip(" ")
        return "[...]" + s[-limit:] if len(s) > limit else s

    h, q, a = (" ".join(WHITE.split(x or "")).strip(" ") for x in (history, question, answer))
    if not q and not a:
        return tail(h)
    turn = f"س: {q} ج: {a}" if re.search(K.ARABIC_LETTER, q or a) else f"Q: {q} A: {a}"
    merged = f"{h} {turn}".strip(" ") if h else turn.strip(" ")
    return merged if len(merged) <= limit else tail("[...]" + merged[-max(250, int(limit * 0.6)) :])


def keyed_history(turns: DataFrame, limit: int = K.HISTORY_CHARS) -> DataFrame:
    """Each conversation's history as turns come (STA6): columns conv_id, turn, question, answer.

    Turns of one micro-batch are taken in order of ``turn``; the history is that of ``folds.chat_history``.
    """

    def update(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        history, n = state.get if state.exists else ("", 0)
        rows = pd.concat(list(batches)).sort_values("turn")
        for q, a in zip(rows["question"], rows["answer"], strict=True):
            history, n = after_turn(history, q, a, limit), n + 1
        state.update((history, n))
        yield pd.DataFrame({"conv_id": [key[0]], "n_turns": [n], "history": [history]})

    return turns.groupBy("conv_id").applyInPandasWithState(update, "conv_id long, n_turns long, history string", "history string, n long", "update", GroupStateTimeout.NoTimeout)


def _ms(ts: object) -> int:
    return int(pd.Timestamp(ts).value // 1_000_000)


class TurnsInOrder(StatefulProcessor):
    """Holds a conversation's turns until the watermark has passed them, then folds them in order.

    A turn waits in a list state under a timer at its own time.  When the timer fires no earlier turn can come
    any more, so all that are due are folded by (time, turn).  ``idle_ms`` after its last turn a conversation that
    waits for nothing is forgotten.
    """

    def __init__(self, limit: int, idle_ms: int) -> None:
        self.limit, self.idle_ms = limit, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ms long, turn long, question string, answer string")
        self.told = handle.getValueState("told", "history string, n long, last_ms long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        new = [(_ms(t), int(k), q or "", a or "") for pdf in rows for t, k, q, a in zip(pdf["ts"], pdf["turn"], pdf["question"], pdf["answer"], strict=True)]
        self.waiting.appendList(new)
        for ms in {r[0] for r in new}:
            self.handle.registerTimer(max(ms, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = expiredTimerInfo.getExpiryTimeInMs()
        rows = list(self.waiting.get()) if self.waiting.exists() else []
        due = sorted(tuple(r) for r in rows if r[0] <= now)
        history, n, last = self.told.get() if self.told.exists() else ("", 0, 0)
        if not due:
            if not rows and now >= last + self.idle_ms:
                self.told.clear()
            return
        rest = [tuple(r) for r in rows if r[0] > now]
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        for _, _, question, answer in due:
            history, n = after_turn(history, question, answer, self.limit), n + 1
        last = max(last, due[-1][0])
        self.told.update((history, n, last))
        self.handle.registerTimer(last + self.idle_ms)
        yield pd.DataFrame({"conv_id": [key[0]], "n_turns": [n], "history": [history]})

    def close(self) -> None:
        pass


def ordered_history(turns: DataFrame, late: str = "10 minutes", idle: str = "7 days", limit: int = K.HISTORY_CHARS) -> DataFrame:
    """Each conversation's history as its turns come, in whatever order and micro-batch (STA6): conv_id, ts, turn, question, answer.

    A turn may be ``late`` by so much; it is folded when the watermark has passed it, so the history is that of
    ``folds.chat_history`` for times that rise with the turns.  A row is given for each time at which turns were folded, of which the one of
    the highest ``n_turns`` is the latest.  Needs the state store of RocksDB.
    """
    watched = turns.select("conv_id", "ts", F.col("turn").cast("long").alias("turn"), "question", "answer").withWatermark("ts", late)
    processor = TurnsInOrder(limit, int(pd.Timedelta(idle).value // 1_000_000))
    return watched.groupBy("conv_id").transformWithStateInPandas(processor, "conv_id long, n_turns long, history string", "Append", "EventTime")


ROCKSDB = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
