"""One query per operator, each over the whole ``events`` table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.trips import (
    closing_line,
    dealt,
    event_lines,
    event_trips,
    events,
    flawed_lines,
    many_days,
    replay,
    slice_bounds,
    slices,
)
from catalog.windows import FARE_RANGE
from meterline.functions.clock import epoch_millis
from meterline.functions.codes import payment_type_name, rate_code_name, vendor_name
from meterline.operators.decode import decode
from meterline.functions.text import TRIP_DEBUG_FIELDS, trip_debug
from meterline.operators.hourly import hourly_fares, latest, overall_fare
from meterline.operators.load import describe_ddl, load_trips
from meterline.operators.parse import classify, parse_trips, reject_counts, rejects, trips
from meterline.operators.publish import publish_lines
from meterline.operators.window_apply import MEAN_FARE, apply_window
from meterline.plans.pipeline import (
    Outputs,
    await_all,
    fired_sink,
    start_applied,
    start_hourly,
    start_late_hourly,
    start_pipeline,
    start_refires,
    start_trips,
)
from meterline.plans.tables import load_table, publish_table, start_replay
from meterline.schemas import CSV_HEADER, CSV_TRIP, DECODED, HOURLY, LINE_FIELDS, TRIP
from meterline.session import scratch_dir
from meterline.sinks.access import indexed, lookup
from meterline.sinks.commits import read_committed
from meterline.sinks.keys import keyed, ledger, with_dense_ids
from meterline.sinks.latest import kept_rows, merge_new
from meterline.sinks.tables import (
    AUDIT_COLUMNS,
    TABLES,
    by_day,
    create_tables,
    hourly_sink,
    read_table,
    refresh_table,
    trip_sink,
    write_batch,
)
from meterline.sinks.topic import line_batches, line_files, message_files
from meterline.sources.files import line_file, message_stream
from meterline.streaming.moved import moved_state, open_windows
from meterline.streaming.progress import ProgressTable, counted, read_progress

Query = Callable[[SparkSession, str], DataFrame]

# The record time of the two-clocks queries lags the pickup by this much.
INGEST_LAG = "INTERVAL '90' MINUTE"
# Event ids with this remainder of 20 arrive one slice late in the lateness query.
TARDY = 7
# The lookups' day; trips before EARLY come in a batch of their own.
LOOKED_UP = datetime(2024, 1, 12, 6)
EARLY = datetime(2024, 1, 20)
# A watermark delay longer than a slice, so that no row of the slice before is late.
DELAY_DAYS = 11


def rounded(hourly: DataFrame) -> DataFrame:
    """Means to six digits, as the order of a distributed sum is not fixed.

    Nine digits first: a mean that ends in a five at the seventh digit would
    otherwise go up or down with the noise of its sum.
    """
    return hourly.withColumn("average_fare", F.round(F.round("average_fare", 9), 6))


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_trips(event_lines(events(spark, sf_dir)))


def ingested_lines(rows: DataFrame) -> DataFrame:
    return event_lines(rows).withColumn("timestamp", F.col("timestamp") + F.expr(INGEST_LAG))


def parse_trips_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_trips(flawed_lines(events(spark, sf_dir))).drop("timestamp")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(classify(flawed_lines(events(spark, sf_dir))))


def reject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rejects(classify(flawed_lines(events(spark, sf_dir))))
    return rows.select(
        F.col("value").alias("line"),
        "reason",
        F.col("timestamp").cast("timestamp_ntz").alias("record_time"),
    )


def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations forth and back: the reversed trip must give the negated seconds."""
    source = events(spark, sf_dir)
    there = event_trips(source)
    back = there.withColumns(
        {
            "pickup_datetime": F.col("dropoff_datetime"),
            "dropoff_datetime": F.col("pickup_datetime"),
        }
    )
    both = there.unionByName(back)
    parsed = parse_trips(publish_lines(both))
    return parsed.select("pickup_datetime", "dropoff_datetime", "trip_duration")


def pickup_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsed_events(spark, sf_dir)
    return parsed.groupBy(F.hour("pickup_datetime").alias("pickup_hour")).agg(
        F.count("*").alias("trip_count")
    )


def pickup_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_events(spark, sf_dir).select(
        "pickup_datetime", epoch_millis(F.col("pickup_datetime")).alias("pickup_millis")
    )


def name_counts(column: str, name: str, decoder: Callable) -> Query:
    """Trips per decoded name. Grouping by code first decodes a row per code, not per trip."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        counts = parsed_events(spark, sf_dir).groupBy(column).agg(F.count("*").alias("n"))
        return counts.groupBy(decoder(F.col(column)).alias(name)).agg(
            F.sum("n").alias("trip_count")
        )

    return query


def decoded_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(parsed_events(spark, sf_dir))


def hourly_fares_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hourly_fares(parsed_events(spark, sf_dir), "pickup_datetime"))


def hourly_fares_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ingested_lines(events(spark, sf_dir))
    return rounded(hourly_fares(parse_trips(lines), "timestamp"))


def hourly_fares_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means to the last bit, over rows that are dealt out anew."""
    dealt = parsed_events(spark, sf_dir).repartition(7)
    return hourly_fares(dealt, "pickup_datetime", exact=True)


def hourly_fares_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-clocks aggregate over a replay of the table, last emission per group."""
    source = events(spark, sf_dir)
    root = scratch_dir(spark, "stream")
    landing, table, checkpoint = (f"{root}/{part}" for part in ("landing", "hourly", "state"))

    def run() -> None:
        stream = message_stream(spark, landing)
        start_hourly(stream, hourly_sink(table), checkpoint, interval=None).awaitTermination()

    parts = slices(source, slice_bounds(source), F.col("ts"))
    replay((ingested_lines(part) for part in parts), landing, run)
    return rounded(latest(read_table(spark, table, HOURLY)))


def tardy_slices(spark: SparkSession, sf_dir: str, lines: Callable[[DataFrame], DataFrame]):
    """The table's lines in slices of time, one row in twenty a slice late."""
    source = events(spark, sf_dir)
    tardy, held = F.col("event_id") % 20 == TARDY, None
    for part in slices(source, slice_bounds(source), F.col("ts")):
        arriving = part.filter(~tardy)
        yield lines(dealt(arriving if held is None else arriving.unionByName(held)))
        held = part.filter(tardy)
    # The tardy rows of the last slice make a slice of their own.
    yield lines(dealt(held))


def fired_rows(purpose: str, **settings: int) -> Query:
    """Everything the lateness operator emits when rows come a slice late."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_dir(spark, purpose)
        landing, table, checkpoint = (f"{root}/{part}" for part in ("landing", "events", "state"))

        def run() -> None:
            start_late_hourly(
                message_stream(spark, landing),
                lambda frame, batch: write_batch(frame, table, batch),
                checkpoint,
                interval=None,
                **settings,
            ).awaitTermination()

        replay(tardy_slices(spark, sf_dir, event_lines), landing, run)
        return rounded(spark.read.parquet(table).drop("batch_id", "run_id"))

    return query


def hourly_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row per group of a change log with three growing versions of each."""
    parsed = event_trips(events(spark, sf_dir), "event_id")
    version = (F.col("event_id") % 3).cast("int")
    seen = parsed.withColumn("batch_id", F.explode(F.sequence(version, F.lit(2))))
    log = seen.groupBy(
        F.hour("pickup_datetime").alias("hour"),
        F.window("pickup_datetime", "1 hour").alias("window"),
        "batch_id",
    ).agg(F.avg("fare_amount").alias("average_fare"), F.count("*").alias("trip_count"))
    changes = log.select(
        "hour",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "average_fare",
        "trip_count",
        "batch_id",
    )
    return rounded(latest(changes))


def publish_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_lines(event_trips(events(spark, sf_dir)), always_fraction=True).select(
        F.col("value").alias("line")
    )


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_trips(publish_lines(event_trips(events(spark, sf_dir))))


def publish_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table published as text files, read as lines and parsed again."""
    path = scratch_dir(spark, "lines")
    publish_table(event_trips(events(spark, sf_dir)), lambda lines: line_files(lines, path))
    return parse_trips(line_file(spark, path)).drop("timestamp")


def overall_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(overall_fare(parsed_events(spark, sf_dir)))


def _stored(spark: SparkSession, path: str, schema) -> DataFrame:
    frame = read_table(spark, path, schema)
    return frame.drop(*AUDIT_COLUMNS)


def sink_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "raw")
    trip_sink(path, row_id=True, created_at=True)(parsed_events(spark, sf_dir).drop("timestamp"), 0)
    return _stored(spark, path, TRIP)


def sink_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "decoded")
    trip_sink(path)(decode(parsed_events(spark, sf_dir)), 0)
    return _stored(spark, path, DECODED)


def sink_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "hourly")
    hourly_sink(path)(hourly_fares(parsed_events(spark, sf_dir), "pickup_datetime"), 0)
    return rounded(_stored(spark, path, HOURLY))


def sink_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries, each with its own checkpoint and so the same batch numbers, fill one table."""
    source = events(spark, sf_dir)
    root = scratch_dir(spark, "runs")
    outputs = Outputs.below(root)
    for run in (0, 1):
        landing = f"{root}/landing{run}"
        message_files(event_lines(source.filter(F.col("event_id") % 2 == run)), landing)
        stream = message_stream(spark, landing)
        start_trips(stream, outputs, f"{root}/state{run}", interval=None).awaitTermination()
    return _stored(spark, f"{root}/taxi_trips", TRIP)


def whole_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All branches on a replay of flawed and late lines: rows and fare total of each table."""
    root = scratch_dir(spark, "pipeline")
    landing = f"{root}/landing"
    outputs = Outputs.below(root, months=many_days(events(spark, sf_dir)))

    def run() -> None:
        stream = message_stream(spark, landing)
        await_all(start_pipeline(stream, outputs, f"{root}/state", interval=None))

    replay(tardy_slices(spark, sf_dir, flawed_lines), landing, run)
    raw = read_table(spark, f"{root}/taxi_trips", TRIP)
    decoded = read_table(spark, f"{root}/yellow_taxi_stream", DECODED)
    fired = read_table(spark, f"{root}/hourly_aggregates", HOURLY)
    drops = read_table(spark, f"{root}/late_drops", HOURLY)
    rejected = spark.read.parquet(f"{root}/rejects")

    def report(name: str, frame: DataFrame, rows, fares) -> DataFrame:
        summary = frame.agg(rows.alias("row_count"), F.round(fares, 2).alias("fare_total"))
        return summary.select(F.lit(name).alias("table_name"), "row_count", "fare_total")

    fare = F.sum("fare_amount")
    total = F.sum(F.col("average_fare") * F.col("trip_count"))
    return (
        report("taxi_trips", raw, F.count("*"), fare)
        .unionByName(report("yellow_taxi_stream", decoded, F.count("*"), fare))
        .unionByName(report("hourly_aggregates", latest(fired), F.sum("trip_count"), total))
        .unionByName(report("emissions", fired, F.count("*"), total))
        .unionByName(report("late_drops", drops, F.sum("trip_count"), total))
        .unionByName(report("rejects", rejected, F.count("*"), F.lit(0.0)))
    )


def calendar_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickups on days that some months lack and at 24 o'clock, as they are parsed."""
    key = F.col("event_id")
    rows = events(spark, sf_dir).select("*", F.date_format("ts", "mm:ss").alias("rest"))
    day = F.format_string("%d-%02d-%02d", 2023 + key % 3, key % 12 + 1, 28 + key % 4)
    hour = F.when(key % 5 == 0, "24:00:00").otherwise(
        F.concat(F.format_string("%02d:", key % 24), "rest")
    )
    texts = event_trips(rows, F.concat_ws(" ", day, hour).alias("moment"))
    names = LINE_FIELDS.fieldNames()
    times = ("pickup_datetime", "dropoff_datetime")
    fields = [F.col("moment") if n in times else F.col(n).cast("string") for n in names]
    parsed = parse_trips(texts.select(F.concat_ws(",", *fields).alias("value")))
    return parsed.groupBy("pickup_datetime").agg(F.count("*").alias("trip_count"))


def debug_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of the text shown for each trip, read back."""
    shown = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in TRIP.fields if f.name in TRIP_DEBUG_FIELDS
    )
    texts = parsed_events(spark, sf_dir).select(trip_debug().alias("text"))
    return texts.select(F.from_json("text", shown).alias("shown")).select("shown.*")


def written_csv(spark: SparkSession, sf_dir: str, root: str) -> str:
    table = event_trips(events(spark, sf_dir)).toDF(*CSV_HEADER)
    table.write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(f"{root}/csv")
    return f"{root}/csv"


def load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table written as trip files, loaded, stored as a table and read back."""
    root = scratch_dir(spark, "load")
    stored = load_table(spark, written_csv(spark, sf_dir, root), f"{root}/table", CSV_TRIP)
    return stored.toDF(*(name.lower() for name in CSV_HEADER))


def load_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a declared schema: types are inferred from all rows."""
    root = scratch_dir(spark, "load")
    stored = load_table(spark, written_csv(spark, sf_dir, root), f"{root}/table")
    return stored.toDF(*(name.lower() for name in CSV_HEADER))


def loaded_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shown definition of the inferred table, with the number of values of each column."""
    loaded = load_trips(spark, written_csv(spark, sf_dir, scratch_dir(spark, "load")))
    kinds = dict(part.split(" ") for part in describe_ddl(loaded).split(","))
    counts = loaded.agg(*(F.count(name).alias(name) for name in kinds))
    wide = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(name.lower()).alias("column_name"),
                    F.lit(kind).alias("column_type"),
                    F.col(name).alias("value_count"),
                )
                for name, kind in kinds.items()
            )
        )
    )
    return counts.select(wide.alias("row")).select("row.*")


def published_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay of a stored table capped at half of its rows: lines reported and lines found."""
    root = scratch_dir(spark, "lines")
    event_trips(events(spark, sf_dir)).repartition(4).write.parquet(f"{root}/table")
    table = spark.read.parquet(f"{root}/table")
    reported = publish_table(table, lambda lines: line_files(lines, f"{root}/lines"), table.count() // 2)
    found = spark.read.text(f"{root}/lines").agg(
        F.count("*").alias("lines_found"), F.countDistinct("value").alias("distinct_lines")
    )
    return found.select(F.lit(reported).cast("long").alias("lines_reported"), "lines_found", "distinct_lines")


def table_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate keys and write times of a stored batch."""
    path = scratch_dir(spark, "raw")
    trip_sink(path, row_id=True, created_at=True)(parsed_events(spark, sf_dir).drop("timestamp"), 0)
    return spark.read.parquet(path).agg(
        F.count("*").alias("row_count"),
        F.countDistinct("id").alias("distinct_ids"),
        F.count("created_at").alias("write_times"),
    )


def created_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the three tables as the catalog sees them, created before they are filled."""
    root = scratch_dir(spark, "catalog")
    database = "meterline_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    try:
        create_tables(spark, root, database)
        create_tables(spark, root, database)
        parsed = parsed_events(spark, sf_dir).drop("timestamp")
        trip_sink(f"{root}/taxi_trips")(parsed, 0)
        trip_sink(f"{root}/yellow_taxi_stream")(decode(parsed), 0)
        hourly_sink(f"{root}/hourly_aggregates")(hourly_fares(parsed, "pickup_datetime"), 0)
        counts = None
        for name in TABLES:
            refresh_table(spark, f"{database}.{name}")
            count = spark.table(f"{database}.{name}").agg(F.count("*").alias("row_count"))
            row = count.select(F.lit(name).alias("table_name"), "row_count")
            counts = row if counts is None else counts.unionByName(row)
        counts.write.parquet(f"{root}/counts")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")  # the tables' files stay in the scratch folder
    return spark.read.parquet(f"{root}/counts")


def applied_window_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(apply_window(parsed_events(spark, sf_dir), "pickup_datetime"))


def applied_window_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The caller's mean of fares on a stream whose rows come a slice late: all emissions."""
    root = scratch_dir(spark, "applied")
    landing, table, checkpoint = (f"{root}/{part}" for part in ("landing", "events", "state"))

    def run() -> None:
        stream = message_stream(spark, landing)
        start_applied(
            stream, MEAN_FARE, lambda frame, batch: write_batch(frame, table, batch), checkpoint, interval=None
        ).awaitTermination()

    replay(tardy_slices(spark, sf_dir, event_lines), landing, run)
    return rounded(spark.read.parquet(table).drop("batch_id", "run_id"))


def applied_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another function of a caller's over the same replay, no row too late: the last emission of each window."""
    root = scratch_dir(spark, "applied")
    landing, table, checkpoint = (f"{root}/{part}" for part in ("landing", "events", "state"))

    def lines():
        yield from tardy_slices(spark, sf_dir, event_lines)
        yield closing_line(events(spark, sf_dir), timedelta(days=DELAY_DAYS + 1))

    def run() -> None:
        start_applied(
            message_stream(spark, landing),
            FARE_RANGE,
            lambda frame, batch: write_batch(frame, table, batch),
            checkpoint,
            interval=None,
            disorder_seconds=DELAY_DAYS * 86_400,
        ).awaitTermination()

    replay(lines(), landing, run)
    emitted = spark.read.parquet(table)
    columns = [name for name in emitted.columns if name not in ("hour", "window_start", "batch_id", "run_id")]
    last = emitted.groupBy("hour", "window_start").agg(F.max_by(F.struct(*columns), "batch_id").alias("last"))
    return last.select("hour", "window_start", "last.*").drop("kind")


def failing(sink: Callable, at: int) -> Callable:
    """The sink, failing when it is given batch ``at``."""

    def write(frame: DataFrame, batch_id: int) -> None:
        if batch_id == at:
            raise OSError("the disk is full")
        sink(frame, batch_id)

    return write


def atomic_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed rows of the tables after a batch that failed between two of them, after its repetition, and in the end."""
    source = events(spark, sf_dir)
    root = scratch_dir(spark, "atomic")
    outputs = Outputs.below(root, commits=True)
    broken = replace(outputs, decoded=failing(outputs.decoded, 1))
    kinds = {"taxi_trips": TRIP, "yellow_taxi_stream": DECODED, "rejects": T.StructType([T.StructField("reason", T.StringType())])}
    seen = f"{root}/seen"

    def run(targets: Outputs) -> None:
        start_trips(message_stream(spark, f"{root}/landing"), targets, f"{root}/state", interval=None).awaitTermination()

    def note(stage: str) -> None:
        for name, kind in kinds.items():
            rows = read_committed(spark, f"{root}/{name}", kind, outputs.commits)
            counts = rows.agg(F.count("*").alias("row_count"))
            counts.select(F.lit(stage).alias("stage"), F.lit(name).alias("table_name"), "row_count").write.mode("append").parquet(seen)

    parts = slices(source, slice_bounds(source), F.col("ts"))
    for number, part in enumerate(parts):
        message_files(flawed_lines(part), f"{root}/landing")
        if number == 1:
            try:
                run(broken)
            except StreamingQueryException:
                note("failed")
        run(outputs)
        if number:
            note("repeated" if number == 1 else "finished")
    return spark.read.parquet(seen)


def dense_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a table that two runs of two batches each fill, the last one written twice."""
    source = events(spark, sf_dir)
    root = scratch_dir(spark, "keys")
    table = f"{root}/taxi_trips"
    outputs = replace(Outputs.below(root), raw=keyed(table, trip_sink(table)))
    for run in (0, 1):
        for batch in (0, 1):
            message_files(event_lines(source.filter(F.col("event_id") % 4 == 2 * run + batch).repartition(3)), f"{root}/landing{run}")
            stream = message_stream(spark, f"{root}/landing{run}")
            start_trips(stream, outputs, f"{root}/state{run}", interval=None).awaitTermination()
    last = ledger(spark, table).orderBy(F.desc("first_id")).first()
    again = parse_trips(event_lines(source.filter(F.col("event_id") % 4 == 3).repartition(5))).drop("timestamp")
    write_batch(
        by_day(with_dense_ids(again, table, last["batch_id"], last["run_id"])), table, last["batch_id"], last["run_id"]
    )
    keys = spark.read.parquet(table)
    return keys.agg(
        F.count("*").alias("row_count"),
        F.countDistinct("id").alias("distinct_ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.countDistinct("run_id", "batch_id").alias("batches"),
    )


def late_log(spark: SparkSession, sf_dir: str, root: str, after: Callable[[], None]) -> str:
    """The change log of a replay whose rows come a slice late; ``after`` runs when a slice is in."""
    table = f"{root}/hourly_aggregates"
    sink = fired_sink(hourly_sink(table), hourly_sink(f"{root}/late_drops"))

    def run() -> None:
        start_late_hourly(message_stream(spark, f"{root}/landing"), sink, f"{root}/state", interval=None).awaitTermination()
        after()

    replay(tardy_slices(spark, sf_dir, event_lines), f"{root}/landing", run)
    return table


def merged_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept table of latest rows, merged from the log after each slice."""
    root = scratch_dir(spark, "merged")
    table = late_log(spark, sf_dir, root, lambda: merge_new(spark, f"{root}/hourly_aggregates"))
    return rounded(kept_rows(spark, table).drop("written_at", "batch_id"))


def hourly_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some hours of the day, and the windows of a day, from the kept table: rows, trips and files read."""
    root = scratch_dir(spark, "lookup")
    table = f"{root}/hourly_aggregates"
    parsed = parsed_events(spark, sf_dir)
    for batch, part in enumerate((F.col("pickup_datetime") < EARLY, F.col("pickup_datetime") >= EARLY)):
        hourly_sink(table)(hourly_fares(parsed.filter(part), "pickup_datetime"), batch)
        merge_new(spark, table)
    found = None
    wanted = [(f"hour {hour}", {"hour": hour}) for hour in (0, 8, 17)]
    wanted.append(("day", {"start": LOOKED_UP, "end": LOOKED_UP + timedelta(days=1)}))
    for name, keys in wanted:
        rows = kept_rows(spark, table, **keys)
        files = len(rows.inputFiles())
        row = rows.agg(F.count("*").alias("row_count"), F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trips"))
        row = row.select(F.lit(name).alias("wanted"), "row_count", "trips", F.lit(files).cast("long").alias("files_read"))
        found = row if found is None else found.unionByName(row)
    return found


def indexed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips of six hours, from the files that an index of pickup times names."""
    root = scratch_dir(spark, "indexed")
    table = f"{root}/taxi_trips"
    times = T.StructType([TRIP["pickup_datetime"], TRIP["fare_amount"]])
    sink = indexed(table, times, trip_sink(table))
    source = events(spark, sf_dir)
    for batch, part in enumerate(slices(source, slice_bounds(source), F.col("ts"))):
        sink(parse_trips(event_lines(part)).drop("timestamp"), batch)
    found = lookup(spark, table, TRIP, pickup_datetime=(LOOKED_UP, LOOKED_UP + timedelta(hours=6)))
    opened = found.rows.select(F.input_file_name().alias("file")).distinct().count()
    rows = found.rows.select("pickup_datetime", "dropoff_datetime", "fare_amount")
    few = found.files_read * 8 <= found.files and opened <= found.files_read
    return rows.withColumn("few_files", F.lit(few))


def resumed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a stored table, published by a query that failed after a batch was written and went on."""
    root = scratch_dir(spark, "replay")
    event_trips(events(spark, sf_dir)).repartition(8).write.parquet(f"{root}/table")
    write, left = line_batches(f"{root}/lines"), [1]

    def once_failing(lines: DataFrame, batch_id: int) -> None:
        write(lines, batch_id)
        if batch_id == 2 and left:
            raise OSError(f"the connection is gone, {left.pop()}")

    for _ in range(2):
        try:
            start_replay(
                spark, f"{root}/table", LINE_FIELDS, once_failing, f"{root}/state", files_per_batch=2
            ).awaitTermination()
        except StreamingQueryException:
            pass
    lines = spark.read.text(f"{root}/lines").select("value")
    return parse_trips(lines)


def progress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the queries of the whole pipeline reported of themselves over a replay, added up."""
    root = scratch_dir(spark, "progress")
    outputs = Outputs.below(root)
    table = ProgressTable(spark, f"{root}/progress")
    spark.streams.addListener(table)

    def run() -> None:
        stream = message_stream(spark, f"{root}/landing")
        start_trips(stream, outputs, f"{root}/trips", interval=None, name="trips", watch=True).awaitTermination()
        start_late_hourly(
            stream, fired_sink(outputs.hourly, outputs.dropped), f"{root}/hourly", interval=None, name="windows", watch=True
        ).awaitTermination()

    try:
        replay(tardy_slices(spark, sf_dir, flawed_lines), f"{root}/landing", run)
        # Events come to listeners some time after a query has ended.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(table)
    table.flush()
    return counted(read_progress(spark, f"{root}/progress"))


def moved_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All emissions of a stream that stops with 4 state partitions and goes on with 16."""
    root = scratch_dir(spark, "moved")
    table, moved = f"{root}/events", None
    for number, lines in enumerate(tardy_slices(spark, sf_dir, event_lines)):
        part = int(number >= 2)
        if number == 2:
            moved = moved_state(spark, f"{root}/state0")
        message_files(lines, f"{root}/landing{part}")
        start_late_hourly(
            message_stream(spark, f"{root}/landing{part}"),
            lambda frame, batch: write_batch(frame, table, batch),
            f"{root}/state{part}",
            interval=None,
            state_partitions=16 if part else 4,
            moved=moved,
        ).awaitTermination()
    return rounded(spark.read.parquet(table).drop("batch_id", "run_id"))


def windows_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that the stream of a replay holds when all rows are in."""
    root = scratch_dir(spark, "held")
    late_log(spark, sf_dir, root, lambda: None)
    return rounded(open_windows(spark, f"{root}/state"))


def hourly_fares_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replay from two sources, one of which brings half of the first slice and nothing more.

    Windows fire as they do from one source: an idle one does not hold the clock back.
    """
    root = scratch_dir(spark, "idle")
    table, odd = f"{root}/events", F.unix_micros("timestamp") % 2 == 1
    for number, lines in enumerate(tardy_slices(spark, sf_dir, event_lines)):
        if number:
            message_files(lines, f"{root}/busy")
        else:
            message_files(lines.filter(odd), f"{root}/idle")
            message_files(lines.filter(~odd), f"{root}/busy")
        both = message_stream(spark, f"{root}/busy").unionByName(message_stream(spark, f"{root}/idle"))
        start_late_hourly(
            both, lambda frame, batch: write_batch(frame, table, batch), f"{root}/state", interval=None
        ).awaitTermination()
    return rounded(spark.read.parquet(table).drop("batch_id", "run_id"))


def hourly_refires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every row that comes a slice late, besides those on time."""
    root = scratch_dir(spark, "refires")

    def run() -> None:
        stream = message_stream(spark, f"{root}/landing")
        start_refires(
            stream, f"{root}/events", f"{root}/state", interval=None, lateness_seconds=DELAY_DAYS * 86_400
        ).awaitTermination()

    replay(tardy_slices(spark, sf_dir, event_lines), f"{root}/landing", run)
    return rounded(spark.read.parquet(f"{root}/events").drop("batch_id", "run_id"))


QUERIES: dict[str, Query] = {
    "parse_trips": parse_trips_query,
    "reject_reasons": reject_reasons,
    "reject_lines": reject_lines,
    "trip_duration": trip_duration,
    "pickup_hour": pickup_hour,
    "pickup_millis": pickup_millis,
    "decode_vendor": name_counts("vendor_id", "vendor_name", vendor_name),
    "decode_rate": name_counts("rate_code_id", "rate_code_name", rate_code_name),
    "decode_payment": name_counts("payment_type", "payment_type_name", payment_type_name),
    "decoded_trips": decoded_trips,
    "hourly_fares_pickup": hourly_fares_pickup,
    "hourly_fares_ingest": hourly_fares_ingest,
    "hourly_fares_exact": hourly_fares_exact,
    "hourly_fares_stream": hourly_fares_stream,
    "hourly_fares_late": fired_rows("late"),
    "hourly_fares_delayed": fired_rows("delayed", disorder_seconds=DELAY_DAYS * 86_400),
    "hourly_fares_idle": hourly_fares_idle,
    "hourly_refires": hourly_refires,
    "hourly_latest": hourly_latest,
    "publish_lines": publish_lines_query,
    "publish_roundtrip": publish_roundtrip,
    "publish_files": publish_files,
    "overall_fare": overall_fares,
    "load_csv": load_csv,
    "load_csv_inferred": load_csv_inferred,
    "loaded_ddl": loaded_ddl,
    "published_count": published_count,
    "calendar_edges": calendar_edges,
    "debug_text": debug_text,
    "sink_raw": sink_raw,
    "sink_decoded": sink_decoded,
    "sink_hourly": sink_hourly,
    "sink_two_runs": sink_two_runs,
    "table_ids": table_ids,
    "created_tables": created_tables,
    "applied_window_udf": applied_window_udf,
    "applied_window_late": applied_window_late,
    "applied_window_stream": applied_window_stream,
    "whole_pipeline": whole_pipeline,
    "resumed_replay": resumed_replay,
    "progress_counts": progress_counts,
    "moved_windows": moved_windows,
    "windows_held": windows_held,
    "atomic_batches": atomic_batches,
    "dense_keys": dense_keys,
    "merged_latest": merged_latest,
    "hourly_lookup": hourly_lookup,
    "indexed_lookup": indexed_lookup,
}
