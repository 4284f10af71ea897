"""Writers (S6-S14, S16, B4).

Writers that partition their output first ask for a rebalance on the partition columns: the
adaptive planner then gives small partitions one file together and splits a partition that is
too big over several tasks, so a hot hour or region is not written by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake import schemas
from cartlake.operators.envelope import landing_partitions
from cartlake.session import shared_dir
from cartlake.sources.readers import path_exists

KPI_PARTITIONS = ["year", "month", "day", "region"]
KPI_HOUR_PARTITIONS = ["year", "month", "day", "hour", "region"]


def rebalanced(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.hint("rebalance", *columns)


def land_raw(
    envelopes: DataFrame, path: str, entity: Column, clock: str = "event", by_hour: bool = True
) -> None:
    """Append envelopes as JSON under ``entity=/date=[/hour=]``.

    Store events land by event time, subscription and payment events by arrival, checkouts and
    carts by date only.
    """
    staged = landing_partitions(envelopes, clock).withColumn("entity", entity)
    columns = ["entity", "date", "hour"] if by_hour else ["entity", "date"]
    if not by_hour:
        staged = staged.drop("hour")
    rebalanced(staged, columns).write.mode("append").partitionBy(*columns).json(path)


def write_quarantine(rejected: DataFrame, path: str) -> None:
    """Append what could not be processed, with the reason."""
    rejected.write.mode("append").json(path)


def write_counted(df: DataFrame, write, what: str) -> dict:
    """Run a write and count its rows on the way; writing nothing is an error."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    rows = seen.get["rows"]
    if not rows:
        raise ValueError(f"{what}: nothing to write")
    return {"rows": rows}


def write_snapshot(df: DataFrame, path: str, date: str) -> dict:
    """Flattened export rows as snappy parquet under ``date=``."""
    dated = df.withColumn("date", F.lit(date))

    def write(out: DataFrame) -> None:
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy("date")
            .parquet(path)
        )

    return write_counted(rebalanced(dated, ["date"]), write, "snapshot")


def write_orders(df: DataFrame, path: str, date: str | None = None, records_per_file: int = 5_000_000) -> None:
    """Processed orders; with a date only that partition is replaced."""
    writer = df.hint("rebalance")
    if date is not None:
        writer = rebalanced(df.withColumn("date", F.lit(date)), ["date"])
    out = writer.write.mode("overwrite").option("maxRecordsPerFile", records_per_file)
    if date is not None:
        out = out.option("partitionOverwriteMode", "dynamic").partitionBy("date")
    out.parquet(path)


def write_subscription_orders(df: DataFrame, path: str, date: str) -> None:
    """Subscription orders by type and date in one pass; other dates stay."""
    rows = df.filter(F.col("is_subscription") & F.col("subscription_type").isNotNull())
    write_partitioned(rows.withColumn("date", F.lit(date)), path, ["subscription_type", "date"])


def with_kpi_partitions(hourly: DataFrame, by_hour: bool) -> DataFrame:
    parts = {
        "year": F.date_format("local_date", "yyyy"),
        "month": F.date_format("local_date", "MM"),
        "day": F.date_format("local_date", "dd"),
    }
    if by_hour:
        parts["hour"] = F.date_format("local_datetime", "HH")
    return hourly.withColumns(parts)


def write_kpi(
    hourly: DataFrame,
    path: str,
    start_date: str,
    end_date: str,
    output_format: str = "csv",
    by_hour: bool = False,
    manifest_path: str | None = None,
) -> dict:
    """Hourly table by local day and region; the range's partitions become those of this table.

    The table is computed once, to the shared folder; from there it is written, and its own
    partitions are the manifest's. Partitions of the range that it does not have are dropped.
    Returns what the manifest holds. An empty table is an error.
    """
    spark = hourly.sparkSession
    columns = KPI_HOUR_PARTITIONS if by_hour else KPI_PARTITIONS
    made = with_kpi_partitions(hourly, by_hour)
    stage = shared_dir(spark, "kpi")
    made.write.parquet(stage)
    made = spark.read.schema(made.schema).parquet(stage)
    staged = rebalanced(made, columns).sortWithinPartitions(*columns, "timestamp_utc")

    def write(out: DataFrame) -> None:
        writer = (
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns)
        )
        if output_format == "parquet":
            writer.option("compression", "snappy").parquet(path)
        else:
            writer.option("header", True).option("compression", "gzip").csv(path)

    info = write_counted(staged, write, "hourly table")
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in columns]).alias("folder")
    written = made.select(folder).distinct()
    _drop_stale(spark, path, written, start_date, end_date, output_format, by_hour, folder)
    manifest = written.agg(F.sort_array(F.collect_list("folder")).alias("partitions")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("written_at"),
        F.lit(info["rows"]).cast("bigint").alias("row_count"),
        F.lit(start_date).alias("start_date"),
        F.lit(end_date).alias("end_date"),
        "partitions",
        F.lit(output_format).alias("output_format"),
        F.lit(by_hour).alias("partition_by_hour"),
    )
    if manifest_path:
        manifest.write.mode("append").json(manifest_path)
    return {"row_count": info["rows"], "start_date": start_date, "end_date": end_date, "manifest": manifest}


def _drop_stale(spark, path, written, start_date, end_date, output_format, by_hour, folder) -> None:
    """Delete the partitions of the range that the run has not written; their names only are read."""
    day = F.concat_ws("-", "year", "month", "day")
    there = read_kpi(spark, path, output_format, by_hour).filter(day.between(start_date, end_date)).select(folder).distinct()
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for row in there.join(written, "folder", "left_anti").toLocalIterator():
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, row.folder), True)


def kpi_schema(by_hour: bool = False) -> T.StructType:
    """Columns of the written table: data first, then the partition columns."""
    columns = KPI_HOUR_PARTITIONS if by_hour else KPI_PARTITIONS
    data = [f for f in schemas.HOURLY_TABLE.fields if f.name not in columns]
    return T.StructType([*data, *[T.StructField(c, T.StringType()) for c in columns]])


def read_kpi(spark: SparkSession, path: str, output_format: str = "csv", by_hour: bool = False) -> DataFrame:
    reader = spark.read.schema(kpi_schema(by_hour))
    if output_format == "parquet":
        return reader.parquet(path)
    # a quoted empty field is an empty text, an unquoted one is a null
    return reader.option("header", True).option("emptyValue", "").option("nullValue", None).csv(path)


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """Parquet by partition columns; partitions without new rows stay as they are."""
    (
        rebalanced(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_state_table(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """State table bucketed and sorted by its key.

    Joins and look-ups by the key then read matching buckets without a shuffle of the table. One
    task per bucket writes it: repartitioning by the key gives each bucket a single file.
    """
    writer = (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
    )
    (writer.option("path", path) if path else writer).saveAsTable(name)


def export_report(df: DataFrame, path: str, file_format: str = "csv") -> None:
    """Finished report as CSV with a header or as JSON records."""
    writer = df.write.mode("overwrite")
    if file_format == "json":
        writer.json(path)
    elif file_format == "csv":
        writer.option("header", True).csv(path)
    else:
        raise ValueError(f"unknown report format: {file_format}")


def write_quality(result: DataFrame, path: str) -> None:
    """Quality documents under ``date=``."""
    dated = result.withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
    dated.write.mode("append").partitionBy("date").json(path)


def define_table(
    spark: SparkSession, name: str, schema: T.StructType, partitions: list[str], path: str, file_format: str = "parquet"
) -> None:
    """Drop and define an external partitioned table, then find its partitions."""
    data = [f for f in schema.fields if f.name not in partitions]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data)
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    parts = ", ".join(f"`{p}` {types.get(p, 'string')}" for p in partitions)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {parts}) USING {file_format} "
        f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")


def partition_values(spark: SparkSession, name: str) -> DataFrame:
    """Partitions a table knows, from the catalog alone."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def define_lake_tables(spark: SparkSession, root: str, database: str = "default") -> list[str]:
    """Raw order events, processed orders and curated subscription orders as tables.

    A part of the lake that does not exist yet is left out.
    """
    raw = T.StructType([*schemas.ENVELOPE.fields, T.StructField("hour", T.StringType()), T.StructField("date", T.StringType())])
    parts = {
        "raw_order_events": ("raw/entity=orders", raw, ["date", "hour"], "json"),
        "processed_orders": ("processed/orders_enriched", None, ["date"], "parquet"),
        "subscription_orders": ("curated/subscription_orders", None, ["subscription_type", "date"], "parquet"),
    }
    made = []
    for name, (folder, schema, partitions, file_format) in parts.items():
        path = f"{root.rstrip('/')}/{folder}"
        if path_exists(spark, path):
            known = schema if schema is not None else spark.read.parquet(path).schema
            define_table(spark, f"{database}.{name}", known, partitions, path, file_format)
            made.append(name)
    return made


def purge_expired(spark: SparkSession, path: str, before: str, dry_run: bool = True) -> list[str]:
    """Drop the ``date=`` folders older than a day; a dry run only lists them.

    Only folder names are looked at: one entry per date, whatever the size of the data.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    old = [p for p in found if p.getName().startswith("date=") and p.getName()[5:] < before]
    if not dry_run:
        for folder in old:
            fs.delete(folder, True)
    return sorted(p.getName() for p in old)
