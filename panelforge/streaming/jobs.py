"""Structured Streaming forms of the ingest steps. One function builds the source, so files and Kafka
differ in nothing else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from panelforge.session import scratch_path
from panelforge.sources import schemas
from panelforge.sources.readers import BAD


def kafka_lines(spark: SparkSession, servers: str, topic: str, per_trigger: int = 10_000, start: str = "latest") -> DataFrame:
    """Messages of a topic as (value, key, topic); rate limited. Needs the Kafka package on the class path."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", start).option("maxOffsetsPerTrigger", per_trigger).load()
    )
    return raw.select(F.col("value").cast("string").alias("value"), F.col("key").cast("string").alias("key"), "topic")


def file_lines(spark: SparkSession, path: str, topic: str, files_per_trigger: int = 4) -> DataFrame:
    """The same columns from a folder of JSON lines."""
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_trigger).text(path)
    return raw.select("value", F.lit(None).cast("string").alias("key"), F.lit(topic).alias("topic"))


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """Message columns under ``data`` beside the text; ``bad`` marks text that is no such message."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    data = F.from_json("value", f"{schema}, {BAD} string", options)
    out = lines.withColumn("data", data)
    return out.withColumn("bad", F.col("data").isNull() | F.col(f"data.{BAD}").isNotNull())


def bronze_rows(lines: DataFrame, topic: str, schema: str | None = None) -> DataFrame:
    """Valid messages with lineage and date columns."""
    now = F.current_timestamp()
    rows = parsed(lines, schema or schemas.topic_schema(topic)).filter(~F.col("bad")).select("data.*").drop(BAD)
    return rows.withColumns(
        {"_ingested_at": now, "_source": F.lit(topic), "_year": F.year(now), "_month": F.month(now), "_day": F.dayofmonth(now)}
    )


def to_bronze(rows: DataFrame, path: str, checkpoint: str, columns: list[str] | None = None, once: bool = False) -> StreamingQuery:
    """Append to a partitioned table, exactly once per checkpoint."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if columns:
        writer = writer.partitionBy(*columns)
    return (writer.trigger(availableNow=True) if once else writer).start()


def split_stream(
    lines: DataFrame, schema: str, good_path: str, bad_path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Valid messages and dead letters from one read of the source.

    The batch id names the folder of both outputs, so a repeated batch replaces itself.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        marked = parsed(batch, schema).persist()
        try:
            marked.filter(~F.col("bad")).select("data.*").drop(BAD).write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            letters = marked.filter("bad").select(
                F.col("topic").alias("original_topic"), F.col("key").alias("original_key"),
                F.col("value").alias("original_value"), F.lit("malformed JSON").alias("error"),
            )
            letters.write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
        finally:
            marked.unpersist()

    writer = lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def tumbling(rows: DataFrame, ts: str, minutes: int, keys: list[str], aggregates: list[Column], lateness: str = "10 minutes") -> DataFrame:
    """Aligned buckets with a watermark that bounds the state."""
    grouped = rows.withWatermark(ts, lateness).groupBy(F.window(ts, f"{minutes} minutes"), *keys).agg(*aggregates)
    return grouped.select(F.col("window.start").alias("time_bucket"), *keys, *[c for c in grouped.columns if c not in ("window", *keys)])


def first_within(rows: DataFrame, key: str, ts: str, memory: str = "30 days") -> DataFrame:
    """First message per key; a key is forgotten after ``memory``."""
    return rows.withWatermark(ts, memory).dropDuplicatesWithinWatermark([key])


def union_topics(streams: dict[str, DataFrame]) -> DataFrame:
    """Several topics as one stream of (topic, payload)."""
    parts = [s.select(F.lit(t).alias("topic"), F.col("value").alias("payload")) for t, s in streams.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def counts(lines: DataFrame, schema: str, name: str) -> tuple[DataFrame, str]:
    """Sent / failed counters attached to a stream; they appear in its progress under ``name``."""
    watched = parsed(lines, schema).observe(name, F.count(F.lit(1)).alias("sent"), F.count_if("bad").alias("failed"))
    return watched, name


def count_batches(lines: DataFrame, schema: str, path: str, checkpoint: str) -> StreamingQuery:
    """Sent / failed per micro-batch as a table of one row per batch: progress records are kept for the last
    batches only. A batch that runs again replaces its own row."""

    def save(batch: DataFrame, number: int) -> None:
        row = batch.agg(F.count(F.lit(1)).alias("sent"), F.count_if("bad").alias("failed"))
        row.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = parsed(lines, schema).writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows (or pre-aggregated groups of rows) that came after their bucket was closed, over the progress a finished query still keeps."""
    return sum(int(o["numRowsDroppedByWatermark"]) for p in query.recentProgress for o in p["stateOperators"])


def run_to_table(spark: SparkSession, stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a bounded stream to the end and return what it wrote."""
    root = scratch_path(spark, label)
    if mode == "append":
        query = to_bronze(stream, f"{root}/out", f"{root}/checkpoint", once=True)
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{root}/out")
    raise ValueError("only append output can be read back as a table")
