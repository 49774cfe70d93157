"""Canonical event views over Parquet tables, and readers of the text formats event logs come in.

Canonical events have (stream_id, us, event_type): time is kept in whole microseconds, so that differences are exact.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STANDARD = T.StructType([T.StructField("timestamp", T.DoubleType()), T.StructField("stream_id", T.StringType()), T.StructField("event_type", T.StringType())])


def micros(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("stream_id"), micros("ts").alias("us"), "event_type")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("stream_id"), micros("o_orderdate").alias("us"), F.col("o_orderpriority").alias("event_type"))


# ---- text formats


def read_event_csv(spark: SparkSession, path: str, timestamp: str, stream_id: str, event_type: str) -> DataFrame:
    """Rows of a CSV file with a header; rows with a blank stream or type are dropped, then the time is cast and a bad one raises."""
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    missing = [c for c in (timestamp, stream_id, event_type) if c not in raw.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    rows = raw.select(F.trim(raw[timestamp]).alias("t"), F.trim(raw[stream_id]).alias("stream_id"), F.trim(raw[event_type]).alias("event_type"))
    rows = rows.where("coalesce(stream_id, '') <> '' and coalesce(event_type, '') <> ''")
    return rows.select(F.col("t").cast("double").alias("timestamp"), "stream_id", "event_type")


def read_standard_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows with the time as written, and one row (stream_count, event_count)."""
    raw = spark.read.csv(path, header=True)
    missing = [c for c in STANDARD.names if c not in raw.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    rows = raw.select(*[F.trim(raw[c]).alias(c) for c in STANDARD.names]).where("coalesce(stream_id, '') <> '' and coalesce(event_type, '') <> ''")
    return rows, rows.agg(F.count_distinct("stream_id").alias("stream_count"), F.count(F.lit(1)).alias("event_count"))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parse_list(text: Column) -> Column:
    """Items of ``"[a, b]"``: outer quotes and a pair of brackets stripped, what is blank between commas dropped, then each item's quotes
    stripped. A quoted blank stays, as an empty item."""
    bare = F.regexp_replace(stripped(F.coalesce(text, F.lit(""))), r'^"+|"+$', "")
    inner = F.when(bare.startswith("[") & bare.endswith("]") & (F.length(bare) > 1), F.substr(bare, F.lit(2), F.length(bare) - 2)).otherwise(bare)
    return F.transform(F.filter(F.split(inner, ","), lambda x: stripped(x) != ""), lambda x: F.regexp_replace(stripped(x), r"^['\"]+|['\"]+$", ""))


def to_float(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def explode_traces(traces: DataFrame, stream: str, types: str, intervals: str) -> DataFrame:
    """Events of traces held as two bracket lists, paired to the shorter one. Time is the running sum of the intervals from the second on;
    a blank type is no event but its interval counts."""
    pairs = traces.select(F.monotonically_increasing_id().alias("_trace"), F.col(stream).alias("stream_id"), parse_list(F.col(types)).alias("x"), F.transform(parse_list(F.col(intervals)), to_float).alias("d"))
    n = F.least(F.size("x"), F.size("d"))
    rows = pairs.where(n > 0).select("_trace", "stream_id", F.posexplode(F.arrays_zip(F.slice("x", 1, n).alias("event_type"), F.slice("d", 1, n).alias("gap"))).alias("pos", "e"))
    so_far = Window.partitionBy("_trace").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    time = F.sum(F.when(F.col("pos") > 0, F.col("e.gap")).otherwise(0.0)).over(so_far)
    return rows.select("stream_id", "pos", time.alias("timestamp"), F.col("e.event_type").alias("event_type")).where(stripped(F.col("event_type")) != "")


OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def trace_rows(spark: SparkSession, path: str) -> DataFrame:
    """(_row, BlockId, Features, TimeInterval) of a CSV file with a header; the stream's column may also be called block_id.

    A row with more cells than the header is malformed: its two lists are looked for between brackets in the cells beyond the header's, and a
    row without two is dropped.
    """
    names = spark.read.csv(path, header=True).columns
    lines = spark.read.text(path).withColumn("_row", F.monotonically_increasing_id())
    head = spark.read.text(path).first()
    cells = F.from_csv("value", F.lit(", ".join(f"`{c}` string" for c in [*names, "_over"])), {"escape": '"'})
    rows = lines.where((F.col("value") != F.lit(head[0] if head else "")) & (F.trim("value") != "")).withColumn("c", cells)
    own = lambda *c: F.coalesce(*[F.trim(F.col("c").getField(x)) for x in c if x in names], F.lit(""))
    over = F.array_join(F.slice(F.split("value", OUTSIDE_QUOTES), len(names) + 1, 1 << 20), ",")
    rows = rows.withColumn("lists", F.when(F.col("c").getField("_over").isNotNull(), F.regexp_extract_all(over, F.lit(r"(\[[^\]]*\])"), F.lit(1))))
    rows = rows.where("lists is null or size(lists) >= 2")
    pick = lambda i, c: F.when(F.col("lists").isNull(), own(c)).otherwise(F.get("lists", F.lit(i)))
    return rows.select("_row", own("BlockId", "block_id").alias("BlockId"), pick(0, "Features").alias("Features"), pick(1, "TimeInterval").alias("TimeInterval"))


def read_trace_csv(spark: SparkSession, path: str, max_streams: int | None = None) -> DataFrame:
    raw = trace_rows(spark, path).where("coalesce(trim(BlockId), '') <> ''")
    if max_streams is not None:
        raw = raw.orderBy("_row").limit(max_streams)
    return explode_traces(raw, "BlockId", "Features", "TimeInterval").select("timestamp", "stream_id", "event_type")


def read_json_dir(spark: SparkSession, path: str, pattern: str = "driver_*.json", prefix: str = "taxi_event_", max_streams: int | None = None) -> DataFrame:
    """Arrays of {time, TPP_attribute: {event_type}} in one file for each stream; event_type may stand at the top. Bad files give nothing."""
    kind = T.StructType([T.StructField("time", T.DoubleType()), T.StructField("event_type", T.StringType()), T.StructField("TPP_attribute", T.StructType([T.StructField("event_type", T.StringType())]))])
    raw = spark.read.schema(kind).option("pathGlobFilter", pattern).json(path, multiLine=True, mode="PERMISSIVE")
    raw = raw.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("stream_id"))
    code = F.coalesce(F.nullif(F.trim("TPP_attribute.event_type"), F.lit("")), F.nullif(F.trim("event_type"), F.lit("")))
    rows = raw.select(F.col("time").alias("timestamp"), "stream_id", F.concat(F.lit(prefix), code).alias("event_type")).where("timestamp is not null and event_type is not null")
    if max_streams is not None:
        rows = rows.join(F.broadcast(rows.select("stream_id").distinct().orderBy("stream_id").limit(max_streams)), "stream_id", "left_semi").select(*rows.columns)
    return rows


def read_gdelt_tsv(spark: SparkSession, path: str, min_events: int = 3, max_streams: int | None = None, max_events_per_stream: int | None = None) -> DataFrame:
    """Event records without a header: time in column 4, actors in 5 or 7 and 15 or 17, code in 26. A stream is a pair of actors."""
    raw = spark.read.text(path).withColumn("_row", F.monotonically_increasing_id()).select("_row", F.split("value", "\t").alias("c")).where(F.size("c") > 26)
    col = lambda i: F.element_at("c", i + 1)
    actor = lambda a, b, none: F.trim(F.when(col(a) != "", col(a)).when(col(b) != "", col(b)).otherwise(none))
    rows = raw.select("_row", F.trim(col(4)).try_cast("double").alias("timestamp"), actor(5, 7, "UNK1").alias("a"), actor(15, 17, "UNK2").alias("b"), F.trim(col(26)).alias("code"))
    rows = rows.where("timestamp is not null and a <> '' and b <> '' and code <> ''").select("_row", "timestamp", F.concat("a", F.lit("->"), "b").alias("stream_id"), F.concat(F.lit("cameo_"), "code").alias("event_type"))
    return top_events(keep_streams(rows, min_events, max_streams), max_events_per_stream, jitter=True)


def keep_streams(rows: DataFrame, min_events: int, max_streams: int | None = None) -> DataFrame:
    """Rows of streams with at least min_events rows, of the first max_streams such streams by name."""
    good = rows.groupBy("stream_id").count().where(F.col("count") >= min_events).select("stream_id")
    if max_streams is not None:
        good = good.orderBy("stream_id").limit(max_streams)
    return rows.join(good, "stream_id", "left_semi").select(*rows.columns)


def top_events(rows: DataFrame, most: int | None, jitter: bool = False) -> DataFrame:
    own = Window.partitionBy("stream_id").orderBy("timestamp", "_row")
    rows = rows.withColumn("_n", F.row_number().over(own) - 1)
    if most is not None:
        rows = rows.where(F.col("_n") < most)
    time = F.col("timestamp") + F.col("_n") * 1e-6 if jitter else F.col("timestamp")
    return rows.select(time.alias("timestamp"), "stream_id", "event_type")


@F.pandas_udf(T.StringType())
def format_timestamp(seconds: pd.Series) -> pd.Series:
    """Twelve significant digits without trailing zeros, as text; only files that must match byte for byte need it."""
    return seconds.map(lambda v: None if v is None or v != v else f"{v:.12g}")


def write_standard_csv(rows: DataFrame, path: str) -> None:
    rows.select(format_timestamp(F.col("timestamp").cast("double")).alias("timestamp"), "stream_id", "event_type").write.mode("overwrite").csv(path, header=True)


ADAPTERS = {"standard_csv": lambda s, p, **o: read_standard_csv(s, p)[0], "hdfs_event_traces": read_trace_csv, "taxi_pro": read_json_dir, "gdelt": read_gdelt_tsv}


def register_adapter(name: str, read) -> None:
    """A reader (spark, path, **options) -> (timestamp, stream_id, event_type) under a name of its own."""
    if name in ADAPTERS:
        raise ValueError(f"adapter {name!r} is there already")
    ADAPTERS[name] = read


def get_adapter(name: str):
    if name not in ADAPTERS:
        raise ValueError(f"unknown adapter {name!r}; there are {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[name]


# ---- generated streams

EVENT = "struct<event_id:bigint,timestamp:double,abstract_type:string,semantic_type:string,parent_id:bigint,root_id:bigint,relation_to_parent:string,delta_t_from_parent:double,regime:string,regime_params:map<string,double>,is_background:boolean,cascade_depth:int,mechanism_node_id:string,distractor_type:string>"
STREAM = (
    "stream_id string, domain string, topology string, mechanism_type string, primary_regime string, seed bigint, "
    "mechanism struct<nodes:array<struct<node_id:string,role:string,abstract_type:string>>,edges:array<struct<source:string,target:string,relation_type:string,regime:string,regime_params:map<string,double>>>>, "
    f"events array<{EVENT}>"
)


def read_streams(spark: SparkSession, path: str, schema: str = STREAM) -> DataFrame:
    """Streams from JSON lines; a missing path is an empty table."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def causal_events(streams: DataFrame) -> DataFrame:
    """(timestamp, stream_id, event_type) of the events that aren't background."""
    rows = streams.select("stream_id", F.explode("events").alias("e")).where(~F.coalesce(F.col("e.is_background"), F.lit(False)))
    return rows.select(F.col("e.timestamp").alias("timestamp"), "stream_id", F.col("e.abstract_type").alias("event_type"))
