"""Queries for incremental CSV ingestion and the whole update.

Each writes given tables as CSV to the shared folder, streams them in, and reads
the bronze table back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.catalogue import sql
from monthfusion.catalogue.fusion import iso
from monthfusion.contracts import fused_columns
from monthfusion.plans.analogs import CONTRACT, all_sources, table
from monthfusion.plans.update import Update
from monthfusion.sources.csv_files import read_text
from monthfusion.sources.scratch import scratch_dir
from monthfusion.streaming.bronze import RESCUED, BronzeTable, Landing, run_ingest

EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value", "props")
IDS = {"event_id": "bigint", "user_id": "bigint"}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*EVENT_COLUMNS)


def _drop(rows: DataFrame, landing: str, delivery: str) -> None:
    """Deliver rows as CSV files into a landing folder."""
    rows.write.csv(f"{landing}/{delivery}", header=True)


def _bronze(spark: SparkSession, landing: str, **pinned: str) -> BronzeTable:
    return BronzeTable(spark, scratch_dir(spark, "bronze"), Landing("events", landing, pinned))


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    odd = F.col("event_id") % 2 == 1
    return rows.where(~odd), rows.where(odd)


def _loaded_in_two_runs(spark: SparkSession, first: DataFrame, second: DataFrame) -> BronzeTable:
    landing = scratch_dir(spark, "landing")
    bronze = _bronze(spark, landing, **IDS)
    _drop(first, landing, "first")
    run_ingest([bronze])
    _drop(second, landing, "second")
    run_ingest([bronze])
    return bronze


def bronze_stream_ingest(spark, sf_dir):
    """Two deliveries; a last run finds nothing new."""
    bronze = _loaded_in_two_runs(spark, *_halves(_events(spark, sf_dir)))
    run_ingest([bronze])
    return bronze.read().select(*EVENT_COLUMNS, "source_type")


def _turn_back(spark: SparkSession, folder: str, days: int) -> None:
    """Give the files of a delivery a time of change in the past, as copies with kept times have."""
    files = spark._jvm.org.apache.hadoop.fs
    place = files.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(place):
        if not status.getPath().getName().startswith(("_", ".")):
            system.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def bronze_backfill(spark, sf_dir):
    """The second delivery is older than the first, and compressed."""
    even, odd = _halves(_events(spark, sf_dir))
    landing = scratch_dir(spark, "landing")
    bronze = _bronze(spark, landing, **IDS)
    _drop(even, landing, "first")
    run_ingest([bronze])
    odd.write.csv(f"{landing}/second", header=True, compression="gzip")
    _turn_back(spark, f"{landing}/second", 10)
    run_ingest([bronze])
    run_ingest([bronze])
    return bronze.read().select(*EVENT_COLUMNS)


def bronze_header_by_name(spark, sf_dir):
    """Files of one batch with columns in opposite orders."""
    even, odd = _halves(_events(spark, sf_dir))
    landing = scratch_dir(spark, "landing")
    _drop(even, landing, "even")
    _drop(odd.select(*reversed(EVENT_COLUMNS)), landing, "odd")
    bronze = _bronze(spark, landing, **IDS)
    run_ingest([bronze])
    return bronze.read().select(*EVENT_COLUMNS)


def bronze_infer_types(spark, sf_dir):
    landing = scratch_dir(spark, "landing")
    _drop(iso_date(table(spark, sf_dir, "events")), landing, "all")
    bronze = _bronze(spark, landing)
    run_ingest([bronze])
    return bronze.column_types()


def iso_date(events: DataFrame) -> DataFrame:
    """Events with a date, and a flag beside the numbers."""
    return events.withColumns(
        {"day": F.to_date("ts"), "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "is_view": F.col("event_type") == "view"}
    )


def bronze_add_columns(spark, sf_dir):
    """The second delivery has one more column."""
    even, odd = _halves(_events(spark, sf_dir))
    bronze = _loaded_in_two_runs(spark, even.drop("props"), odd)
    return bronze.read().select("event_id", "props")


def bronze_rescued_data(spark, sf_dir):
    """The second delivery has text among the numbers of one column."""
    even, odd = _halves(_events(spark, sf_dir))
    text = F.when(F.col("event_id") % 10 == 1, F.concat(F.lit("about "), "event_id")).otherwise(F.col("value").cast("string"))
    bronze = _loaded_in_two_runs(spark, even, odd.withColumn("value", text))
    return bronze.read().select(
        "event_id", "value", F.get_json_object(RESCUED, "$.value").alias("rescued_value")
    )


def bronze_file_lineage(spark, sf_dir):
    """Rows per delivery with file name, size, change time and load time."""
    bronze = _loaded_in_two_runs(spark, *_halves(_events(spark, sf_dir)))
    delivery = F.element_at(F.split("source_file", "/"), -2)
    complete = F.col("source_file_size").isNotNull() & F.col("source_modification_time").isNotNull()
    return (
        bronze.read()
        .groupBy(delivery.alias("delivery"))
        .agg(
            F.count("*").alias("rows"),
            F.count_if(complete & F.col("ingested_at").isNotNull()).alias("complete"),
            F.count_distinct("ingested_at").alias("load_times"),
        )
    )


def bronze_changed_files(spark, sf_dir):
    """Files whose time of change differs from when they were loaded, and their rows."""
    even, odd = _halves(_events(spark, sf_dir))
    landing = scratch_dir(spark, "landing")
    bronze = _bronze(spark, landing, **IDS)
    _drop(even.repartition(3, "event_id"), landing, "first")
    _drop(odd, landing, "second")
    run_ingest([bronze])
    _turn_back(spark, f"{landing}/first", 1)
    run_ingest([bronze])
    changed = bronze.changed_files().select(F.element_at(F.split("path", "/"), -1).alias("name"), "batch_id")
    rows = bronze.read().select(F.element_at(F.split("source_file", "/"), -1).alias("name"))
    found = rows.join(changed, "name").groupBy("name").agg(F.count("*").alias("n"))
    return found.agg(F.count("*").alias("changed_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def _broken_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, whose texts have many lines, without the characters that CSV dialects escape differently."""
    text = F.translate(F.coalesce("text", F.lit("")), '"\\\r', "   ")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("> "), text, F.lit(" <")).alias("text"), "lang")


def csv_line_breaks(spark, sf_dir):
    """Text of several lines in quoted cells, by files as a whole folder."""
    folder = scratch_dir(spark, "broken-text")
    _broken_text(spark, sf_dir).write.csv(folder, header=True)
    return read_text(spark, folder).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")


def bronze_line_breaks(spark, sf_dir):
    """The same, streamed in two deliveries with columns in opposite orders."""
    rows, odd = _broken_text(spark, sf_dir), F.col("doc_id") % 2 == 1
    landing = scratch_dir(spark, "landing")
    bronze = _bronze(spark, landing, doc_id="bigint", text="string", lang="string")
    _drop(rows.where(odd), landing, "odd")
    run_ingest([bronze])
    _drop(rows.where(~odd).select(*reversed(rows.columns)), landing, "even")
    run_ingest([bronze])
    return bronze.read().select("doc_id", "text", "lang", F.col(RESCUED).alias("rescued"))


def _updated(spark: SparkSession, sf_dir: str, each: bool) -> DataFrame:
    """CSV files of the three slots in two deliveries, an update after the last or after each."""
    slots = {}
    for name, rows in all_sources(spark, sf_dir).items():
        slots[name] = rows.drop("source_file", "ingested_at").withColumnRenamed("Avian_Phylodiversity", "Avian Phylodiversity")
    landing = {name: scratch_dir(spark, f"landing-{name}") for name in slots}
    update = Update(spark, landing, scratch_dir(spark, "update"), CONTRACT)
    for delivery, months in (("first", "Month <= 6"), ("second", "Month > 6")):
        for name, rows in slots.items():
            columns = rows.columns if delivery == "first" else reversed(rows.columns)
            _drop(rows.where(months).select(*columns), landing[name], delivery)
        if each or delivery == "second":
            gold = update.run()
    lineage = [c for c in gold.columns if c.endswith("_source_file")]
    return iso(gold.drop(*lineage, "latest_ingested_at"))


def update_from_files(spark, sf_dir):
    """The whole update, from CSV files of the three slots to the fused table."""
    return _updated(spark, sf_dir, each=False)


def update_increments(spark, sf_dir):
    """The same in two updates, of which the second reads the second delivery only."""
    return _updated(spark, sf_dir, each=True)


QUERIES = {
    "bronze_stream_ingest": bronze_stream_ingest,
    "bronze_backfill": bronze_backfill,
    "bronze_header_by_name": bronze_header_by_name,
    "bronze_infer_types": bronze_infer_types,
    "bronze_add_columns": bronze_add_columns,
    "bronze_rescued_data": bronze_rescued_data,
    "bronze_file_lineage": bronze_file_lineage,
    "bronze_changed_files": bronze_changed_files,
    "csv_line_breaks": csv_line_breaks,
    "bronze_line_breaks": bronze_line_breaks,
    "update_from_files": update_from_files,
    "update_increments": update_increments,
}

_EVENTS = ", ".join(EVENT_COLUMNS)
_FUSED = ", ".join(
    f"strftime({c}, '%Y-%m-%d') AS {c}" if c == "observation_month" else c
    for c in fused_columns(CONTRACT)
    if c != "latest_ingested_at" and not c.endswith("_source_file")
)
# Spark's CSV reader gives the narrowest of int and bigint that holds all values.
_ID_TYPE = "CASE WHEN max({c}) > 2147483647 THEN 'bigint' ELSE 'int' END"


def _types_sql(*types: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {type_} AS data_type FROM events" for name, type_ in types
    )


def _fixed(type_: str) -> str:
    return f"CASE WHEN count(*) > 0 THEN '{type_}' END"


_BROKEN = """
    SELECT doc_id, '> ' || translate(coalesce(text, ''), '"' || chr(92) || chr(13), '   ') || ' <' AS text, lang"""

ORACLES = {
    "bronze_changed_files": "SELECT CAST(3 AS BIGINT) AS changed_files, count(*) AS rows FROM events WHERE event_id % 2 = 0",
    "csv_line_breaks": f"{_BROKEN} FROM documents",
    "bronze_line_breaks": f"{_BROKEN}, CAST(NULL AS VARCHAR) AS rescued FROM documents",
    "update_increments": f"{sql.gold()} SELECT {_FUSED} FROM gold",
    "bronze_stream_ingest": f"SELECT {_EVENTS}, 'events' AS source_type FROM events",
    "bronze_backfill": f"SELECT {_EVENTS} FROM events",
    "bronze_header_by_name": f"SELECT {_EVENTS} FROM events",
    "bronze_infer_types": _types_sql(
        ("event_id", _ID_TYPE.format(c="event_id")),
        ("ts", _fixed("timestamp")),
        ("user_id", _ID_TYPE.format(c="user_id")),
        ("event_type", _fixed("string")),
        ("value", _fixed("double")),
        ("props", _fixed("string")),
        ("day", _fixed("date")),
        ("is_view", _fixed("boolean")),
    ),
    "bronze_add_columns": "SELECT event_id, CASE WHEN event_id % 2 = 1 THEN props END AS props FROM events",
    "bronze_rescued_data": """
        SELECT event_id, CASE WHEN event_id % 10 <> 1 THEN value END AS value,
               CASE WHEN event_id % 10 = 1 THEN 'about ' || event_id END AS rescued_value
        FROM events""",
    "bronze_file_lineage": """
        SELECT CASE event_id % 2 WHEN 0 THEN 'first' ELSE 'second' END AS delivery,
               count(*) AS rows, count(*) AS complete, CAST(1 AS BIGINT) AS load_times
        FROM events GROUP BY 1""",
    "update_from_files": f"{sql.gold()} SELECT {_FUSED} FROM gold",
}
