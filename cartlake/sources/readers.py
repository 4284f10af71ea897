"""Readers (S1-S5, S15, S18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake import schemas
from cartlake.functions import numeric
from cartlake.functions.jsontext import parsed

LANDED = T.StructType([*schemas.ENVELOPE.fields, T.StructField(schemas.CORRUPT, T.StringType())])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any Hadoop file system exists."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_landed(
    spark: SparkSession, path: str, date: str | None = None, entity: str | None = None
) -> DataFrame:
    """Landed envelopes, of one date and entity if asked; both prune partitions."""
    schema = T.StructType(
        [
            *LANDED.fields,
            T.StructField("entity", T.StringType()),
            T.StructField("date", T.StringType()),
            T.StructField("hour", T.StringType()),
        ]
    )
    df = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    if date is not None:
        df = df.filter(F.col("date") == date)
    if entity is not None:
        df = df.filter(F.col("entity") == entity)
    return df


def read_order_payloads(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """Landed order events with the payload parsed into ``data`` (S1), ready for P2 and P3."""
    landed = read_landed(spark, path, date)
    return landed.withColumn("data", F.from_json("data", schemas.ORDER))


def read_transport_events(spark: SparkSession, path: str) -> DataFrame:
    """Captured transport events, one JSON object per line, malformed lines kept apart."""
    return (
        spark.read.schema(schemas.TRANSPORT_EVENT)
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def read_export(
    spark: SparkSession, path: str, schema: str = schemas.BULK_ORDER, keep_malformed: bool = False
) -> DataFrame:
    """JSONL export, plain or gzip by suffix; blank lines are skipped.

    Malformed lines are dropped, or kept with their text for the quarantine.
    """
    if keep_malformed:
        with_text = f"{schema}, {schemas.CORRUPT} string"
        return spark.read.schema(with_text).option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_snapshots(spark: SparkSession, path: str, date: str) -> DataFrame | None:
    """Snapshot rows of a date, None when the date was not exported (S3)."""
    target = f"{path.rstrip('/')}/date={date}"
    if not path_exists(spark, target):
        return None
    return spark.read.option("basePath", path).parquet(target)


def read_day(spark: SparkSession, events_path: str, snapshots_path: str, date: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Events and snapshots of a date; one may be missing, both missing is an error (S3)."""
    events = None
    if path_exists(spark, f"{events_path.rstrip('/')}/date={date}"):
        events = read_landed(spark, events_path, date)
    snapshots = read_snapshots(spark, snapshots_path, date)
    if events is None and snapshots is None:
        raise FileNotFoundError(f"no data for {date}")
    return events, snapshots


def read_orders_fact(spark: SparkSession, path: str) -> DataFrame:
    """Warehouse order facts."""
    return spark.read.schema(schemas.ORDERS_FACT).parquet(path)


def read_ads_fact(spark: SparkSession, path: str) -> DataFrame:
    """Warehouse ad facts."""
    return spark.read.schema(schemas.ADS_FACT).parquet(path)


def typed_fact(raw: DataFrame, schema: str) -> DataFrame:
    """The columns of a fact schema out of a table whose columns may be text.

    Text that should be a number is read as ``numeric.number`` does: null, blank and unreadable are 0. Other types
    are cast, and what can not be is null; a column that is not there is null. The casts are part of the scan's
    projection, so only the columns that a query uses are read. ``unreadable`` counts what was lost.
    """
    return raw.select(*[_typed(raw, f).alias(f.name) for f in _fields(schema)])


def unreadable(raw: DataFrame, schema: str) -> DataFrame:
    """``(column, lost)``: values of text, blanks left out, that are not of the type the schema names; one pass."""
    fields = [f for f in _fields(schema) if _is_text(raw, f)]
    lost = [F.count_if((F.trim(f.name) != "") & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in fields]
    if not fields:
        return raw.sparkSession.createDataFrame([], "column string, lost bigint")
    return raw.agg(*lost).unpivot([], [f.name for f in fields], "column", "lost")


def _fields(schema: str) -> list[T.StructField]:
    return T.StructType.fromDDL(schema).fields


def _is_text(raw: DataFrame, field: T.StructField) -> bool:
    wanted = not isinstance(field.dataType, T.StringType)
    return wanted and field.name in raw.columns and isinstance(raw.schema[field.name].dataType, T.StringType)


def _typed(raw: DataFrame, field: T.StructField) -> Column:
    if field.name not in raw.columns:
        return F.lit(None).cast(field.dataType)
    if _is_text(raw, field) and isinstance(field.dataType, T.DoubleType):
        return numeric.number(F.trim(field.name))
    return F.col(field.name).try_cast(field.dataType)


def read_fact_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: str, upper: str, partitions: int, **options: str
) -> DataFrame:
    """Warehouse facts over JDBC, read in ranges of a date or number column."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=options,
    )


def read_legacy_performance(spark: SparkSession, path: str) -> DataFrame:
    """Legacy nested performance payloads."""
    return spark.read.schema(schemas.LEGACY_PERFORMANCE).json(path)


def parse_legacy_performance(rows: DataFrame, column: str) -> DataFrame:
    """The same payloads held as text in a column."""
    return parsed(rows, F.col(column), schemas.LEGACY_PERFORMANCE, "p").select("p.*")


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "json",
    glob: str | None = None,
    files_per_trigger: int | None = None,
    bytes_per_trigger: str | None = None,
) -> DataFrame:
    """File stream with an explicit schema."""
    reader = spark.readStream.schema(schema).format(file_format)
    options = {
        "pathGlobFilter": glob,
        "maxFilesPerTrigger": files_per_trigger,
        "maxBytesPerTrigger": bytes_per_trigger,
    }
    for key, value in options.items():
        if value is not None:
            reader = reader.option(key, str(value))
    return reader.load(path)


def stream_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Transport events from a Kafka topic; needs the Kafka package on the cluster."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    parsed = F.from_json(F.col("value").cast("string"), schemas.TRANSPORT_EVENT)
    return raw.select(parsed.alias("e")).select("e.*")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected events waiting for a replay."""
    schema = T.StructType([*LANDED.fields, T.StructField("reason", T.StringType())])
    # the rejected text is data here, so the reader gets another name for its own bad lines
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", "_unreadable").json(path)
