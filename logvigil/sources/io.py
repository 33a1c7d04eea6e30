"""Reading and writing lines, JSON messages, topics, label files and the event store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .store import Store, append_stream


def read_syslog(spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None) -> DataFrame:
    """Raw lines as (value, ingest_ts), from files in batch or as they arrive."""
    if stream:
        r = spark.readStream.format("text")
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        lines = r.load(path)
    else:
        lines = spark.read.text(path)
    return lines.select("value", F.current_timestamp().alias("ingest_ts"))


# --- fixed values: forms of host log lines ---
SYSLOG_LINE = r"^([A-Z][a-z]{2} [ \d]\d \d{2}:\d{2}:\d{2}) (\S+) ([^\s\[:]+)(?:\[(\d+)\])?: (.*)$"
ACCESS_LINE = r'^(\S+) \S+ (\S+) \[([^\]]+)\] "(\S+) (\S+)[^"]*" (\d{3}) (\d+|-)(?: "([^"]*)" "([^"]*)")?$'
ERROR_LINE = r"^(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) \[(\w+)\] (\d+)#\d+: (.*)$"


def _parts(pattern: str, names: list[tuple[int, str]], col: str) -> list[Column]:
    hit = F.col(col).rlike(pattern)
    return [F.when(hit, F.nullif(F.regexp_extract(col, pattern, i), F.lit(""))).alias(n) for i, n in names]


def parse_host_lines(df: DataFrame, log_format: str, col: str = "value") -> DataFrame:
    """Fields of host log lines. ``log_format``: ``syslog`` or ``apache`` (access and error lines).
    Lines of another form have a null ``line_kind``."""
    c = F.col(col)
    if log_format == "syslog":
        kind = F.when(c.rlike(SYSLOG_LINE), "syslog")
        parts = _parts(SYSLOG_LINE, [(1, "logged_at"), (2, "host"), (3, "program"), (4, "pid"), (5, "message")], col)
        return df.select("*", kind.alias("line_kind"), *parts)
    if log_format != "apache":
        raise ValueError(f"unknown log format {log_format!r}")
    kind = F.when(c.rlike(ACCESS_LINE), "access").when(c.rlike(ERROR_LINE), "error")
    access = _parts(ACCESS_LINE, [(1, "client"), (4, "method"), (5, "url"), (6, "status"), (7, "bytes")], col)
    error = _parts(ERROR_LINE, [(2, "severity"), (4, "message")], col)
    at = F.when(c.rlike(ACCESS_LINE), F.regexp_extract(col, ACCESS_LINE, 3)).when(c.rlike(ERROR_LINE), F.regexp_extract(col, ERROR_LINE, 1))
    return df.select("*", kind.alias("line_kind"), at.alias("logged_at"), *access, *error)


def read_log_files(spark: SparkSession, path: str, log_format: str, stream: bool = False) -> DataFrame:
    return parse_host_lines(read_syslog(spark, path, stream), log_format)


def kafka_options(servers: str, topic: str, starting: str = "latest", group: str | None = None, max_offsets: int | None = None, batch: bool = False, **options: str) -> dict[str, str]:
    """The connector's options. A batch that starts at the latest offset would be empty, which is an error."""
    if batch and starting == "latest":
        raise ValueError("a batch read of a topic needs starting='earliest' or explicit offsets")
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **options}
    if group:
        opts["kafka.group.id"] = group
    if max_offsets and not batch:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    return opts


def kafka_events(spark: SparkSession, servers: str, topic: str, starting: str = "latest", group: str | None = None, max_offsets: int | None = None, batch: bool = False, **options: str) -> DataFrame:
    """A topic as (value, key, topic, partition, offset, timestamp). Offsets live in the query's
    checkpoint. Needs Spark's Kafka package on the class path. A batch needs a ``starting`` of its own."""
    opts = kafka_options(servers, topic, starting, group, max_offsets, batch, **options)
    reader = (spark.read if batch else spark.readStream).format("kafka").options(**opts)
    raw = reader.load()
    return raw.select(F.col("value").cast("string"), F.col("key").cast("string"), "topic", "partition", "offset", "timestamp")


def decode_json(df: DataFrame, schema: T.StructType | str, col: str = "value", on_error: str = "drop", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text to columns. Malformed messages are dropped (``"drop"``), kept with the text in
    ``_corrupt`` (``"keep"``) or are all that is returned (``"only"``, for a quarantine output).

    Only text that is no JSON object is malformed. Fields are read as text and then cast, so a number sent as
    text is read as well, and a field that cannot be of its type is null in a row that stays.
    """
    shape = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*[T.StructField(f.name, T.StringType()) for f in shape.fields], T.StructField("_corrupt", T.StringType())])
    out = df.withColumn("_j", F.from_json(col, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}))
    bad = F.col("_j").isNull() | F.col("_j._corrupt").isNotNull()

    def typed(f: T.StructField) -> Column:
        text = F.col(f"_j.`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            return text
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(text, f.dataType).alias(f.name)
        return text.try_cast(f.dataType).alias(f.name)

    if on_error == "drop":
        return out.filter(~bad).select(*keep, *[typed(f) for f in shape.fields])
    cols = [*[typed(f) for f in shape.fields], F.when(bad, F.col(col)).alias("_corrupt")]
    out = out.select(*keep, *cols, bad.alias("_bad"))
    return (out.filter("_bad") if on_error == "only" else out).drop("_bad")


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON text in ``value`` (UTF-8, nulls written), with an optional ``key``."""
    cols = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def json_sink(df: DataFrame, path: str | None = None, servers: str | None = None, topic: str | None = None, key: str | None = None, checkpoint: str | None = None, available_now: bool = False, interval: str = "1 second") -> StreamingQuery | None:
    """Write rows as JSON messages to text files or a topic, batch or stream. Keying a topic by
    entity keeps each entity's events in order in one partition. A stream runs on unless ``available_now``."""
    out = to_messages(df, key if topic else None)
    if df.isStreaming:
        w = out.writeStream.option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
        if topic:
            return w.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).start()
        return w.format("text").option("path", path).start()
    if topic:
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    else:
        out.write.mode("append").text(path)
    return None


def model_labels(spark: SparkSession, metadata: str | None = None, config: str | None = None) -> DataFrame:
    """(class_id, label) from a metadata file, else from the model's config file."""
    last: Exception | None = None
    for path in (metadata, config):
        if not path:
            continue
        try:
            raw = spark.read.text(path, wholetext=True)
            ids = F.from_json(F.get_json_object("value", "$.id2label"), "map<string,string>")
            out = raw.select(F.explode(ids).alias("k", "label")).select(F.col("k").cast("int").alias("class_id"), "label")
            if not out.isEmpty():
                return out
        except Exception as ex:  # a missing file: try the fallback
            last = ex
    raise FileNotFoundError("no label file could be read") from last


def index_append(df: DataFrame, path: str, checkpoint: str, day: Column | None = None, required: tuple[str, ...] = (), interval: str = "500 milliseconds", available_now: bool = False, on_batch: Callable[[int, int, int], None] | None = None) -> StreamingQuery:
    """Append a stream to the event store at ``path`` in small batches, each once, in parts by ``day``; read it with ``event_store``."""
    return append_stream(df, event_store(df.sparkSession, path, df.schema, day), checkpoint, required, interval=interval, available_now=available_now, on_batch=on_batch)


def event_store(spark: SparkSession, path: str, schema: T.StructType, day: Column | None = None) -> Store:
    return Store(spark, path, schema, day)


def deliver_alerts(df: DataFrame, callback: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False, interval: str = "15 seconds") -> StreamingQuery:
    """Hand every batch of new alerts to ``callback(batch, batch_id)``. Delivery itself (an HTTP
    call, say) belongs in a ``foreachPartition`` of the callback."""
    w = df.writeStream.foreachBatch(callback).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()
