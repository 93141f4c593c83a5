"""Stand-in raw logs built from the driver's test tables.

The test-rig logs themselves are not available, so ``events`` plays the raw
log (R1/R2 in FIXTURES.md): every sensor column is *text*, exactly as a CSV
scan delivers it, and ``STEP`` is ``"0"`` for error events. This module only
shapes rows into that schema; coercion, cleaning, power features, indexing and
everything after are done by the library's operators on the result.

Sources of the sensor text: ``v`` = ``value`` as text, ``k`` = the ``k`` field
of the ``props`` JSON text (extracted as text, never parsed), ``u`` =
``user_id`` as text; from the fourth sensor on a number is scaled and shifted
by the sensor's own constants, so that no two sensors are equal. The global order is ``(ts, event_id)``; ``user_id`` is
the unit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigcast.constants import INTERIM_FEATURES
from rigcast.sources.workbook_writer import write_workbook

# sensor -> source letter (v, k or u); STEP is handled separately
SENSOR_SOURCE: dict[str, str] = {
    "M1 SPEED": "v", "M1 CURRENT": "u", "M1 TORQUE": "k",
    "D1 RPM": "k", "D1 CURRENT": "v", "D1 TORQUE": "u",
    "M2 RPM": "u", "M2 Amp": "k", "M2 Torque": "v",
    "CHARGE PT": "v", "CHARGE FLOW": "v",
    "M3 RPM": "k", "M3 Amp": "u", "M3 Torque": "k",
    "Servo PT": "u", "SERVO FLOW": "u",
    "M5 RPM": "v", "M5 Amp": "k", "M5 Torque": "u",
    "M6 RPM": "k", "M6 Amp": "v", "M6 Torque": "v",
    "M7 RPM": "u", "M7 Amp": "v", "M7 Torque": "k",
    "Vibration 1": "v", " Vibration 2": "k",
}
assert list(SENSOR_SOURCE) + ["STEP"] == INTERIM_FEATURES

EVENT_ORDER = ("ts", "event_id")


def _own_line(i: int) -> tuple[float, float]:
    """Factor and offset that tell sensor ``i`` from the others of its source (none for the first three)."""
    return (1 + i / 16, i * 3 / 8) if i > 2 else (1.0, 0.0)


def _own_text(text, i: int):
    a, b = _own_line(i)
    return text if a == 1.0 else F.coalesce((text.try_cast("double") * a + b).cast("string"), text)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_from_events(events: DataFrame) -> DataFrame:
    """Rows of ``events`` in the raw-log schema: order keys ``ts``,
    ``event_id``, unit ``UNIT`` and the 28 interim columns as text."""
    src = {
        "v": F.col("value").cast("string"),
        "k": F.get_json_object("props", "$.k"),
        "u": F.col("user_id").cast("string"),
    }
    step = F.when(F.col("event_type") == "error", F.lit("0")).otherwise(F.lit("1"))
    return events.select(
        "ts", "event_id", F.col("user_id").cast("int").alias("UNIT"),
        *[_own_text(src[s], i).alias(name) for i, (name, s) in enumerate(SENSOR_SOURCE.items())],
        step.alias("STEP"))


def raw_from_orders(orders: DataFrame) -> DataFrame:
    """Rows of ``orders`` as a raw log of another logger layout: unit
    ``o_custkey``, ``M1 SPEED`` = price text, ``DURATION`` = priority text."""
    return orders.select(F.col("o_custkey").cast("int").alias("UNIT"),
                         F.col("o_totalprice").cast("string").alias("M1 SPEED"),
                         F.col("o_orderpriority").alias("DURATION"), F.lit("1").alias("STEP"))


def raw_sql_columns() -> str:
    """The same shaping as SQL text (for the DuckDB oracle)."""
    src = {"v": "CAST(value AS VARCHAR)", "k": "json_extract_string(props, '$.k')",
           "u": "CAST(user_id AS VARCHAR)"}
    cols = []
    for i, (name, s) in enumerate(SENSOR_SOURCE.items()):
        a, b = _own_line(i)
        text = src[s] if a == 1.0 else f"coalesce(CAST(TRY_CAST({src[s]} AS DOUBLE) * {a!r} + {b!r} AS VARCHAR), {src[s]})"
        cols.append(f'{text} AS "{name}"')
    return ", ".join(["ts", "event_id", "CAST(user_id AS INTEGER) AS \"UNIT\"", *cols,
                      "CASE WHEN event_type = 'error' THEN '0' ELSE '1' END AS \"STEP\""])


def raw_file_names(events: DataFrame) -> DataFrame:
    """Stand-in raw-file names, one per (unit, event type):
    ``HYD<user_id padded to 6>-<event_type>_RAW.csv``."""
    return events.select(_file_name_col().alias("name")).distinct()


def _file_name_col():
    return F.concat(F.lit("HYD"), F.lpad(F.col("user_id").cast("string"), 6, "0"), F.lit("-"),
                    F.col("event_type"), F.lit("_RAW.csv"))


def _layouts(events: DataFrame) -> list[tuple[str, DataFrame]]:
    """Three header layouts: ``click`` files have the columns reversed plus a
    ``DURATION`` column, ``view`` files lack ``" Vibration 2"``, the rest use
    the configured order. Every event row lands in exactly one file."""
    raw = raw_from_events(events).withColumn("TIME", F.col("ts").cast("string"))
    named = raw.join(events.select("event_id", "event_type", _file_name_col().alias("name")), "event_id")
    std = ["TIME", *INTERIM_FEATURES]
    rev = ["DURATION", *reversed(INTERIM_FEATURES), "TIME"]
    nov2 = [c for c in std if c != " Vibration 2"]
    click = named.where(F.col("event_type") == "click").withColumn("DURATION", F.lit("1"))
    view = named.where(F.col("event_type") == "view")
    rest = named.where(~F.col("event_type").isin("click", "view"))
    return [("click", click.select("name", "ts", "event_id", *[F.col(f"`{c}`") for c in rev])),
            ("view", view.select("name", "ts", "event_id", *[F.col(f"`{c}`") for c in nov2])),
            ("rest", rest.select("name", "ts", "event_id", *[F.col(f"`{c}`") for c in std]))]


EMPTY_NAME = "HYD000000-0_RAW.csv"


def _note(spark: SparkSession, final: str) -> None:
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(final).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(Path(final + "/README.txt"))
    out.write(bytearray(b"not a raw file\n"))
    out.close()
    fs.create(Path(final + "/" + EMPTY_NAME)).close()


_PLAIN = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _write_files(lines: DataFrame, folder: str) -> None:
    """Text files of ``lines`` (``name, ts, event_id, layout, head, line``), written by the tasks that
    hold their rows: one shuffle for all files, and no work on the driver per file."""
    import pyarrow as pa
    from rigcast.sources.files import filesystem_of

    def write(batches):
        filesystem, place = filesystem_of(folder)
        now, out, done = None, None, 0
        try:
            for b in batches:
                for name, head, line in zip(*(b.column(c).to_pylist() for c in ("name", "head", "line"))):
                    if name != now:
                        if out is not None:
                            out.close()
                        now, out, done = name, filesystem.open_output_stream(f"{place}/{name}"), done + 1
                        out.write(head.encode() + b"\n")
                    out.write(line.encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_pydict({"files": [done]})

    _make_folder(lines.sparkSession, folder)
    body = lines.where(F.col("name").isNotNull()).repartition("name").sortWithinPartitions("name", "ts", "event_id")
    body.select("name", "head", "line").mapInArrow(write, "files long").agg(F.sum("files")).collect()


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def write_raw_csv_folder(events: DataFrame, folder: str) -> str:
    """Stand-in raw folder: one CSV per (unit, event type), rows in time order,
    plus one non-raw file and one empty raw file. Returns the folder."""
    lines = None
    for _, df in _layouts(events):
        columns = [c for c in df.columns if c not in ("name", "ts", "event_id")]
        text = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]), _PLAIN)
        part = df.select("name", "ts", "event_id", F.lit(",".join(columns)).alias("head"), text.alias("line"))
        lines = part if lines is None else lines.unionByName(part)
    _write_files(lines, folder)
    _note(events.sparkSession, folder)
    return folder


def write_raw_xlsx_folder(events: DataFrame, folder: str) -> str:
    """Stand-in raw folder of workbooks, one per (unit, event type), written by
    executor tasks (the rows of one workbook at a time): ``.xls`` for ``view`` files, else ``.xlsx``."""
    import pyarrow as pa

    def write(batches):
        def book(key, rows):
            name = key.replace("_RAW.csv", "_RAW.xls" if "-view_" in key else "_RAW.xlsx")
            write_workbook(rows, f"{folder}/{name}")

        now, rows, done = None, [], 0
        for b in batches:
            for name, cells, columns in zip(*(b.column(c).to_pylist() for c in ("name", "cells", "columns"))):
                if name != now:
                    if rows:
                        book(now, rows)
                    now, rows, done = name, [columns], done + 1
                rows.append(cells)
        if rows:
            book(now, rows)
        yield pa.RecordBatch.from_pydict({"files": [done]})

    _make_folder(events.sparkSession, folder)
    lines = None
    for _, df in _layouts(events):
        columns = [c for c in df.columns if c not in ("name", "ts", "event_id")]
        part = df.select("name", "ts", "event_id", F.array(*[F.col(f"`{c}`") for c in columns]).alias("cells"),
                         F.array(*[F.lit(c) for c in columns]).alias("columns"))
        lines = part if lines is None else lines.unionByName(part)
    body = lines.where(F.col("name").isNotNull()).repartition("name").sortWithinPartitions("name", "ts", "event_id")
    body.select("name", "cells", "columns").mapInArrow(write, "files long").agg(F.sum("files")).collect()
    return folder


def write_new_csvs(events: DataFrame, folder: str) -> str:
    """Stand-in new logs for prediction: one CSV per event type, in time order, with a header of their own."""
    raw = raw_from_events(events).withColumn("TIME", F.col("ts").cast("string")).withColumn("DURATION", F.lit("1"))
    named = raw.join(events.select("event_id", "event_type"), "event_id")
    body = named.repartition("event_type").sortWithinPartitions("event_type", "ts", "event_id")
    (body.select("event_type", "DURATION", *[F.col(f"`{c}`") for c in reversed(INTERIM_FEATURES)], "TIME").write.option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).partitionBy("event_type").csv(folder))
    return folder
