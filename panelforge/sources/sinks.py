"""Batch sinks on plain files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "append", rows_per_file: int = 4_000_000) -> None:
    """Partitioned Parquet. Rows are counted per partition value first; a value is then written by as many tasks as its rows
    need files of about ``rows_per_file``, so a small value is one file and a value with a third of the table is not one task.

    ``df`` is read twice (once for the counts). The writer of a row follows from its content, so a task that runs again deals
    its rows out alike; rows that are equal in every column share a writer.
    """
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    writers = counts.select(*[F.col(c).alias(f"_w_{c}") for c in columns], F.ceil(F.col("_n") / rows_per_file).cast("int").alias("_writers"))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    dealt = df.join(writers, same)
    content = [F.col(c) for c in df.columns if c not in columns]
    writer = F.pmod(F.xxhash64(*content), F.col("_writers")) if content else F.lit(0)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = dealt.withColumn("_writer", writer).repartition(tasks, *columns, "_writer")
    spread.select(*df.columns).write.mode(mode).partitionBy(*columns).parquet(path)


def create_table(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def create_empty(spark: SparkSession, path: str, schema: str, columns: list[str] | None = None) -> None:
    """Empty table unless there is one."""
    writer = spark.createDataFrame([], schema).write.mode("ignore")
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def upserted(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target after a merge: matched rows replaced, others added. Of several updates of one key the greatest row stands."""
    rest = [c for c in updates.columns if c not in keys]
    if rest:
        updates = updates.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_u")).select(*keys, "_u.*").select(*updates.columns)
    else:
        updates = updates.distinct()
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def write_merged_schema(df: DataFrame, old: DataFrame | None, path: str) -> None:
    """Overwrite with the union of both column sets; absent columns are null."""
    (df if old is None else old.unionByName(df, allowMissingColumns=True)).write.mode("overwrite").parquet(path)


def write_both(df: DataFrame, base: str) -> None:
    """The same table as ``base.csv`` and ``base.parquet``; the CSV is written from the finished Parquet."""
    df.write.mode("overwrite").parquet(base + ".parquet")
    df.sparkSession.read.parquet(base + ".parquet").write.mode("overwrite").option("header", True).csv(base + ".csv")


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def dead_letters(wrong: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """Malformed messages in the dead-letter layout."""
    return wrong.select(
        F.lit(topic).alias("original_topic"), (F.col(key) if key else F.lit(None)).cast("string").alias("original_key"),
        "original_value", "error",
    )


def schema_json(df: DataFrame) -> str:
    """The schema as text, for a registry or a later ``StructType.fromJson``."""
    return df.schema.json()
