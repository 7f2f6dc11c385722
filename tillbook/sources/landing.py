"""CSV files into all-text raw tables.

A raw table is a folder of loads, each a Parquet folder split by ``load_status``: ``ok`` rows form the table,
``rejected`` rows are kept beside it with their source line. One pass over the files writes both, and a load appears in
the table by one rename.

Files are found by Spark's file stream over the folder they come from, run until nothing is new. Its checkpoint knows
which files were read; a load is a batch of it, named by the number of the batch, so one that died is written again under
its own name and never twice.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions import null_tokens
from tillbook.operators import row_counts
from tillbook.schemas import LINEAGE, LOADED_AT, RAW, TIMESTAMP, text_columns
from tillbook.sources import files
from tillbook.sources.layers import Layers

_LINE, _STATUS, _LOAD = "_source_line", "load_status", "load"
_FILE, _BLOCK, _ROW = LINEAGE.names
_OK, _REJECTED = "ok", "rejected"

# By default a stream passes over files a week older than the newest it has seen, such as restored ones.
_ANY_AGE = {"maxFileAge": "36500d"}

# The file dialect. A header line, commas, optional double quotes that are doubled to escape them,
# blanks around fields dropped.
CSV_DIALECT = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}

STRICT, LENIENT = "strict", "lenient"


def _stamp(load_ts: datetime | None) -> Column:
    return F.localtimestamp() if load_ts is None else F.lit(load_ts).cast(TIMESTAMP)


def _publish(df: DataFrame, layers: Layers, table: str, load: str) -> None:
    """Write a load out of sight, then move it into the table; a load that is there already stays."""
    arriving = f"{layers.raw(table)}/_arriving/{load}"  # readers pass over names that begin like this
    df.write.mode("overwrite").partitionBy(_STATUS).parquet(arriving)
    files.move(df.sparkSession, arriving, f"{layers.raw(table)}/{_LOAD}={load}")


def read_csv(
    spark: SparkSession,
    table: str,
    path: str | Sequence[str],
    on_error: str = STRICT,
    multi_line: bool = False,
    stream: bool = False,
) -> DataFrame:
    """The text columns of ``table`` from CSV files, with the file, its block, and the line of each row that does not fit (lenient).

    ``strict`` fails on the first row with too few or too many fields. Column pruning is off for this read: with
    it Spark would not look at fields it does not need, and miss such rows. ``multi_line`` allows line breaks inside
    quotes, at the price that a file can no longer be split. A ``stream`` takes one path and sees each file once.
    """
    columns = text_columns(table)
    line = T.StructField(_LINE, T.StringType())
    schema = T.StructType([*(T.StructField(name, T.StringType()) for name in columns), line])
    mode = {STRICT: "FAILFAST", LENIENT: "PERMISSIVE"}[on_error]
    reader = spark.readStream.options(**_ANY_AGE) if stream else spark.read
    if stream and files.is_file(spark, path):  # a stream is over a folder or a pattern: that of this name alone
        folder, slash, name = path.rpartition("/")
        path = folder + slash + "{" + re.sub(r"([\\{}\[\]*?,])", r"\\\1", name) + "}"
    rows = (
        reader.schema(schema)
        .options(**CSV_DIALECT, mode=mode, columnNameOfCorruptRecord=_LINE, multiLine=multi_line, columnPruning=False)
        .csv(path)
    )
    texts = (null_tokens(F.col(name)).alias(name) for name in columns)
    place = F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK)
    return rows.select(*texts, _LINE, *place)


def load_csv(
    spark: SparkSession,
    layers: Layers,
    table: str,
    path: str | Sequence[str],
    on_error: str = STRICT,
    load_ts: datetime | None = None,
    multi_line: bool = False,
    force: bool = False,
) -> None:
    """Append CSV files to a raw table. ``strict`` loads all rows or none, ``lenient`` sets misfits aside.

    Each path (a file, a folder or a pattern) has a register of its own: files of it that were loaded before are passed
    over unless ``force`` is set, which loads all of them and leaves the register as it is. A file that has changed
    under its old name counts as loaded. Files of a load that failed are tried again by the next load of that path.
    """
    status = F.when(F.col(_LINE).isNull(), _OK).otherwise(_REJECTED)

    def stamped(rows: DataFrame) -> DataFrame:
        # lines of a block are read one after the other
        return rows.withColumns({LOADED_AT: _stamp(load_ts), _STATUS: status, _ROW: F.monotonically_increasing_id()})

    if force:
        _publish(stamped(read_csv(spark, table, path, on_error, multi_line)), layers, table, uuid.uuid4().hex)
        return
    for one in [path] if isinstance(path, str) else path:
        name = hashlib.md5(files.qualified(spark, one).encode(), usedforsecurity=False).hexdigest()
        rows = read_csv(spark, table, one, on_error, multi_line, stream=True)
        (
            rows.writeStream.foreachBatch(
                lambda batch, number, name=name: _publish(stamped(batch), layers, table, f"{name}-{number}")
            )
            .option("checkpointLocation", f"{layers.raw(table)}/_landed/{name}")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )


def insert_rows(
    spark: SparkSession,
    layers: Layers,
    table: str,
    rows: Sequence[Mapping[str, str | None]],
    load_ts: datetime | None = None,
) -> None:
    """Append literal rows to a raw table; columns a row does not name are NULL, the load stamp fills itself."""
    schema = T.StructType([field for field in RAW[table] if field.name != LOADED_AT])
    values = [tuple(row.get(name) for name in schema.names) for row in rows]
    append_raw(spark.createDataFrame(values, schema).withColumn(LOADED_AT, _stamp(load_ts)), layers, table)


def append_raw(df: DataFrame, layers: Layers, table: str) -> None:
    """Append a DataFrame that has the raw table's columns, load stamp included."""
    nothing = {field.name: F.lit(None).cast(field.dataType) for field in LINEAGE}
    accepted = {_LINE: F.lit(None).cast("string"), **nothing, _STATUS: F.lit(_OK)}
    _publish(df.select(*RAW[table].names).withColumns(accepted), layers, table, uuid.uuid4().hex)


def create_raw(spark: SparkSession, layers: Layers, table: str) -> None:
    """Create or empty a raw table; what was landed before is forgotten, too."""
    files.remove(spark, layers.raw(table))
    append_raw(spark.createDataFrame([], RAW[table]), layers, table)


def _stored(spark: SparkSession, layers: Layers, table: str, status: str, stream: bool = False) -> DataFrame:
    """Rows of one status, which is a folder, so others are not opened."""
    more = [T.StructField(name, T.StringType()) for name in (_LINE, _LOAD, _STATUS)]
    reader = spark.readStream.options(**_ANY_AGE) if stream else spark.read
    rows = reader.schema(T.StructType([*RAW[table].fields, *LINEAGE.fields, *more])).parquet(layers.raw(table))
    return rows.filter(F.col(_STATUS) == status)


def _names(table: str, lineage: bool) -> list[str]:
    return RAW[table].names + (LINEAGE.names if lineage else [])


def read_raw(spark: SparkSession, layers: Layers, table: str, lineage: bool = False) -> DataFrame:
    """The accepted rows of all loads so far; rejected ones are not opened.

    ``lineage`` adds the file, the block of it and the place of each row; all NULL for rows that came from no file.
    """
    return _stored(spark, layers, table, _OK).select(*_names(table, lineage))


def read_rejects(spark: SparkSession, layers: Layers, table: str) -> DataFrame:
    """The rows a lenient load set aside, with the line and the file they came from."""
    return _stored(spark, layers, table, _REJECTED).select(*RAW[table].names, _LINE, _FILE)


def stream_raw(spark: SparkSession, layers: Layers, table: str, lineage: bool = False) -> DataFrame:
    """The accepted rows as a stream: each run of a query sees those of the loads since its last one."""
    return _stored(spark, layers, table, _OK, stream=True).select(*_names(table, lineage))


def audit(spark: SparkSession, layers: Layers) -> DataFrame:
    """``(tbl, rows)`` of the three raw tables."""
    return row_counts({table: read_raw(spark, layers, table) for table in RAW})

