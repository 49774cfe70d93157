"""Incremental counterparts of the ordered folds, on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files; sf_dir's events may be one file or a folder of them."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{sf_dir}/events.parquet*")


def windowed_counts(events: DataFrame, ts: str = "ts", size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    e = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return e.groupBy(F.window("_ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, key: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    e = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return e.groupBy(F.session_window("_ts", gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), "n")


PAIR = "source string, target string, us long"


def transitions(events: DataFrame) -> DataFrame:
    """Pairs of consecutive types of each stream, across micro-batches: the state is a stream's last event. events: (stream_id, us, event_type).

    Within a micro-batch events are ordered by (us, event_type); an event that comes after later ones were folded is placed where it came."""

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["us", "event_type"])
        out = []
        for us, kind in zip(rows["us"], rows["event_type"]):
            if last is not None and us > last[0]:
                out.append((last[1], kind, int(us - last[0])))
            last = (int(us), kind)
        state.update(last)
        yield pd.DataFrame(out, columns=["source", "target", "us"])

    from pyspark.sql.streaming.state import GroupStateTimeout

    return events.groupBy("stream_id").applyInPandasWithState(fold, PAIR, "us long, event_type string", "append", GroupStateTimeout.NoTimeout)


HISTORY = "us long, event_type string, previous string, before_previous string, recent long, recent_same long, is_bursty boolean, since_root double"


def history(events: DataFrame, window_us: int = 2_000_000, burst: int = 3) -> DataFrame:
    """transitions.history_state over a stream (stream_id, us, event_type): per event the two types before it, how many events of any and of its own
    type the window up to it holds, whether that is a burst, and the time since the stream's first event.

    The state of a stream is its first time, its last two types and the events of the window, no more. Within a micro-batch events are ordered
    by (us, event_type), and events at the same time count each other; a micro-batch must not go back behind the one before.
    """

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        first, before, times, kinds = state.get if state.exists else (None, [], [], [])
        before, times, kinds = list(before), list(times), list(kinds)
        rows = pd.concat(list(batches)).sort_values(["us", "event_type"])
        new_us, new_kind = [int(x) for x in rows["us"]], list(rows["event_type"])
        first = new_us[0] if first is None else first
        every, what = times + new_us, kinds + new_kind
        low, out, to = 0, [], 0
        counts: dict = {}
        for us, kind in zip(new_us, new_kind):
            while to < len(every) and every[to] <= us:
                counts[what[to]] = counts.get(what[to], 0) + 1
                to += 1
            while every[low] < us - window_us:
                counts[what[low]] -= 1
                low += 1
            n = to - low
            out.append((us, kind, before[-1] if before else None, before[-2] if len(before) > 1 else None, n, counts[kind], n >= burst, round((us - first) / 1e6, 6)))
            before = [*before[-1:], kind]
        state.update((first, before, every[low:], what[low:]))
        yield pd.DataFrame(out, columns=[f.split()[0] for f in HISTORY.split(", ")]).assign(stream_id=key[0])

    from pyspark.sql.streaming.state import GroupStateTimeout

    kind = dict(events.dtypes)["stream_id"]
    kept = "first long, before array<string>, times array<long>, kinds array<string>"
    return events.groupBy("stream_id").applyInPandasWithState(fold, f"{HISTORY}, stream_id {kind}", kept, "append", GroupStateTimeout.NoTimeout)


def run_to_files(stream: DataFrame, path: str) -> DataFrame:
    """Runs all there is, appends what comes out to a Parquet table under path and reads that."""
    q = stream.writeStream.format("parquet").outputMode("append").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def run_to_table(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Runs all there is and returns what came out, from a memory table; for results that fit the driver. run_to_files has no such bound."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
