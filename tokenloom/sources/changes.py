"""Change feeds: one row per change, with the row before and after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The columns of source rows that decide what a change affects.
IMAGE = (
    "id bigint, user_id bigint, app_code string, device_id string, adid string,"
    " create_time timestamp_ntz, tracker_name string, vt_type int, raw_value string,"
    " order_no string, user_order_id bigint, device_uuid string, product_id string, current_period int"
)
IMAGE_STRUCT = f"struct<{IMAGE.replace(', ', ',').replace(' ', ':')}>"
CHANGE_SCHEMA = f"source_table string, op string, ts timestamp_ntz, position bigint, before {IMAGE_STRUCT}, after {IMAGE_STRUCT}"
START_MODES = ("initial", "timestamp")


def change_image(**columns: Column) -> Column:
    """A row image; columns not given are NULL."""
    fields = StructType.fromDDL(IMAGE)
    return F.struct(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def scan_changes(
    spark: SparkSession,
    folder: str,
    tables: list[str] | None = None,
    mode: str = "initial",
    start_ms: int | None = None,
    zone: str = "Africa/Lagos",
    files_per_trigger: int = 1000,
) -> DataFrame:
    """A stream over a folder of change files (parquet, ``CHANGE_SCHEMA``)."""
    stream = (
        spark.readStream.schema(CHANGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("latestFirst", "false")
        .parquet(folder)
    )
    return select_changes(stream, tables, mode, start_ms, zone)


def scan_kafka_changes(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    mode: str = "timestamp",
    start_ms: int | None = None,
    per_trigger: int = 1_000_000,
    zone: str = "Africa/Lagos",
) -> DataFrame:
    """A stream over Debezium change records. The start time also moves the topic offsets, so
    older records are not read at all."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, mode, start_ms, per_trigger)).load()
    return debezium_changes(stream, zone)


def kafka_options(servers: str, topics: list[str], mode: str, start_ms: int | None, per_trigger: int) -> dict[str, str]:
    _check_mode(mode, start_ms)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "maxOffsetsPerTrigger": str(per_trigger),
    }
    if mode == "timestamp":
        return options | {"startingTimestamp": str(start_ms)}
    return options | {"startingOffsets": "earliest" if mode == "initial" else "latest"}


def debezium_changes(records: DataFrame, zone: str = "Africa/Lagos") -> DataFrame:
    """Debezium JSON in ``value`` to change rows; snapshot reads count as inserts."""
    sent = IMAGE_STRUCT.replace("timestamp_ntz", "string")
    payload = (
        f"struct<op:string,ts_ms:bigint,before:{sent},after:{sent},"
        "source:struct<table:string,pos:bigint>>"
    )
    body = F.from_json(F.col("value").cast("string"), f"payload {payload}")["payload"]
    parsed = records.select(body.alias("p"))
    return parsed.select(
        F.col("p.source.table").alias("source_table"),
        F.when(F.col("p.op") == "r", "c").otherwise(F.col("p.op")).alias("op"),
        start_time(F.col("p.ts_ms"), zone).alias("ts"),
        F.col("p.source.pos").alias("position"),
        _image("p.before", zone).alias("before"),
        _image("p.after", zone).alias("after"),
    )


def _image(sent: str, zone: str) -> Column:
    """A row image with its times read; no image stays NULL."""
    values = [
        sent_time(F.col(f"{sent}.{f.name}"), zone) if f.dataType.typeName() == "timestamp_ntz" else F.col(f"{sent}.{f.name}")
        for f in StructType.fromDDL(IMAGE)
    ]
    named = F.struct(*[value.cast(f.dataType).alias(f.name) for f, value in zip(StructType.fromDDL(IMAGE), values)])
    return F.when(F.col(sent).isNotNull(), named)


def sent_time(value: Column, zone: str) -> Column:
    """The wall-clock time that Debezium sends in one of its forms: a number is milliseconds, microseconds (from 15 digits on) or nanoseconds
    (from 18 on) of a clock without zone; text that ends in a zone is that moment, shown in ``zone``; other text is taken as it stands.
    What is none of these is NULL."""
    digits, text = F.char_length(F.ltrim(value, F.lit("-"))), F.trim(value)
    micros = F.when(digits >= 18, F.try_divide(value.try_cast("decimal(20,0)"), F.lit(1000)))
    micros = micros.when(digits >= 15, value.try_cast("decimal(20,0)")).otherwise(value.try_cast("decimal(20,0)") * 1000)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    counted = epoch + F.make_dt_interval(secs=F.try_divide(F.floor(micros), F.lit(1_000_000)).cast("decimal(18,6)"))
    moment = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_utc_timestamp(text.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz"))
    return (
        F.when(value.rlike("^-?[0-9]+$"), counted)
        .when(text.rlike("([Zz]|[+-][0-9]{2}:?[0-9]{2})$") & text.contains(":"), moment)
        .otherwise(text.try_cast("timestamp_ntz"))
    )


def select_changes(
    changes: DataFrame, tables: list[str] | None, mode: str, start_ms: int | None, zone: str
) -> DataFrame:
    """The changes of some tables from a start on."""
    _check_mode(mode, start_ms)
    if tables is not None:
        changes = changes.filter(F.col("source_table").isin(*tables))
    if mode == "timestamp":
        changes = changes.filter(F.col("ts") >= start_time(start_ms, zone))
    return changes


def start_time(start_ms: int | Column, zone: str) -> Column:
    """The wall-clock time in ``zone`` of an epoch millisecond."""
    start_ms = start_ms if isinstance(start_ms, Column) else F.lit(start_ms)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(secs=(start_ms.cast("decimal(18,3)") / 1000).cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def _check_mode(mode: str, start_ms: int | None) -> None:
    if mode not in START_MODES:
        raise ValueError(f"start mode must be one of {START_MODES}")
    if mode == "timestamp" and start_ms is None:
        raise ValueError("start mode timestamp needs start_ms")
