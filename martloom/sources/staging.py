"""Raw CSV read once: rows as Parquet, cells that do not parse in quarantine, counts of both.

Reading CSV is permissive: a cell that does not parse becomes null. ``stage_raw`` reads
a table's files once and writes its rows to columnar files, where later reads take
single columns. In the same pass every row gets the list of its rejected cells, with
their text; rows that have any lie in a partition of their own, so that the quarantine
is read without the others; and rows, nulls and rejects are counted.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.schemas import RAW_SCHEMAS, is_key
from martloom.sources.readers import CSV_FORMAT, plain_lines, whole_number

# Names beside the columns of raw tables, none of which starts with an underscore.
RECORD, REJECTS, FILE, BLOCK, REJECTED = "_record", "_rejects", "_file", "_block", "_rejected"
_REJECTS_TYPE = "array<struct<column:string,cell:string,reason:string>>"
QUARANTINE = "table_name string, file string, block_start long, record string, column string, cell string, reason string"
# Tables staged at the same time.
TABLES_AT_ONCE = 4


def _read_types(name: str) -> T.StructType:
    """Layout in which cells are read: keys as text, other columns as they are."""
    fields = RAW_SCHEMAS[name].fields
    return T.StructType([T.StructField(f.name, T.StringType() if is_key(f.name) else f.dataType) for f in fields])


def _rejects(name: str, typed: list[str], keys: list[str]) -> Column:
    """The rejected cells of a row, with why: ``type``, ``key``, or ``columns`` for a row of another width."""

    def cell(column: str, text: Column, reason: str, lost: Column) -> Column:
        entry = F.struct(F.lit(column).alias("column"), text.alias("cell"), F.lit(reason).alias("reason"))
        return F.when(lost, entry)

    texts = ", ".join(f"{c} string" for c in RAW_SCHEMAS[name].names)
    cells = F.from_csv(F.col(RECORD), texts, dict(CSV_FORMAT))
    found = [
        cell(c, cells[c], "type", F.col(RECORD).isNotNull() & F.col(c).isNull() & cells[c].isNotNull()) for c in typed
    ]
    found += [cell(c, F.col(c), "key", F.col(c).isNotNull() & F.expr(whole_number(c)).isNull()) for c in keys]
    named = F.array_compact(F.array(*found)).cast(_REJECTS_TYPE)
    width = F.array(
        F.struct(F.lit(None).cast("string").alias("column"), F.col(RECORD).alias("cell"), F.lit("columns").alias("reason"))
    ).cast(_REJECTS_TYPE)
    return F.when((F.size(named) == 0) & F.col(RECORD).isNotNull(), width).otherwise(named)


def read_checked(spark: SparkSession, name: str, path: str | list[str], escaped: bool = True) -> DataFrame:
    """The rows of ``read_raw`` from CSV, and of each: ``_rejects``, ``_record``, ``_file``, ``_block``.

    ``_rejects`` lists its cells that did not parse; ``_record`` is the line as it stands in
    the file (put together again where only keys were rejected), null if nothing was.
    Write the frame whole: Spark parses, and so checks, only cells that are asked for.
    """
    read_as = _read_types(name)
    raw = (
        spark.read.schema(T.StructType([*read_as.fields, T.StructField(RECORD, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", RECORD)
        .options(**CSV_FORMAT)
        .csv(path)
    )
    keys = [c for c in read_as.names if is_key(c)]
    texts = [f.name for f in read_as.fields if isinstance(f.dataType, T.StringType) and f.name not in keys]
    typed = [c for c in read_as.names if c not in keys and c not in texts]
    line = F.to_csv(F.struct(*read_as.names), dict(CSV_FORMAT))
    checked = raw.withColumns(
        {
            REJECTS: _rejects(name, typed, keys),
            FILE: F.col("_metadata.file_path"),
            BLOCK: F.col("_metadata.file_block_start"),
        }
    ).withColumn(RECORD, F.when(F.size(REJECTS) > 0, F.coalesce(F.col(RECORD), line)))
    if escaped:
        checked = checked.withColumns({c: plain_lines(c) for c in texts})
    columns = [whole_number(c) if c in keys else c for c in read_as.names]
    return checked.selectExpr(*columns, RECORD, REJECTS, FILE, BLOCK)


@dataclass(frozen=True)
class Staged:
    """What was staged of one table: its rows, rows with a rejected cell, nulls of each column."""

    name: str
    rows: int
    rejected: int
    nulls: Mapping[str, int]


def _folder(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def stage_raw(spark: SparkSession, name: str, path: str | list[str], folder: str, escaped: bool = True) -> Staged:
    """Write a raw CSV table below ``folder`` as Parquet, in one pass over its files."""
    seen = Observation()
    columns = RAW_SCHEMAS[name].names
    checked = read_checked(spark, name, path, escaped).withColumn(REJECTED, F.size(REJECTS) > 0)
    watched = checked.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(REJECTED).alias("rejected"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )
    watched.write.mode("overwrite").partitionBy(REJECTED).parquet(_folder(folder, name))
    found = seen.get
    return Staged(name, found["rows"], found["rejected"], {c: found[f"null_{c}"] for c in columns})


def _stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    kept = [f if not is_key(f.name) else T.StructField(f.name, T.LongType()) for f in RAW_SCHEMAS[name].fields]
    added = T.StructType.fromDDL(f"{RECORD} string, {REJECTS} {_REJECTS_TYPE}, {FILE} string, {BLOCK} long, {REJECTED} boolean")
    return spark.read.schema(T.StructType([*kept, *added.fields])).parquet(_folder(folder, name))


def read_staged(spark: SparkSession, folder: str, name: str, with_rejected: bool = True) -> DataFrame:
    """The rows of a staged table as ``read_raw`` gives them; without those in quarantine on request."""
    stored = _stored(spark, folder, name)
    kept = stored if with_rejected else stored.where(f"NOT {REJECTED}")
    return kept.select(*RAW_SCHEMAS[name].names)


def quarantine(spark: SparkSession, folder: str, names: Iterable[str]) -> DataFrame:
    """Every rejected cell of staged tables, with its file, the file part it was read in, and its whole line."""
    cells = [
        _stored(spark, folder, name)
        .where(REJECTED)
        .select(FILE, BLOCK, RECORD, F.explode(REJECTS).alias("r"))
        .select(
            F.lit(name).alias("table_name"),
            F.col(FILE).alias("file"),
            F.col(BLOCK).alias("block_start"),
            F.col(RECORD).alias("record"),
            "r.column",
            "r.cell",
            "r.reason",
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, cells) if cells else spark.createDataFrame([], QUARANTINE)


def stage_snapshot(
    spark: SparkSession, paths: Mapping[str, str], folder: str, names: Iterable[str] | None = None
) -> tuple[dict[str, DataFrame], list[Staged]]:
    """Stage the CSV tables of a resolved snapshot, several at a time; their frames, and what was counted."""
    wanted = list(names or paths)
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        done = list(pool.map(lambda name: stage_raw(spark, name, paths[name], folder), wanted))
    return {name: read_staged(spark, folder, name) for name in wanted}, done


def staging_report(spark: SparkSession, staged: Iterable[Staged]) -> DataFrame:
    """``table_name, column, rows, nulls, rejected_rows`` of every staged column."""
    rows = [(s.name, column, s.rows, nulls, s.rejected) for s in staged for column, nulls in s.nulls.items()]
    return spark.createDataFrame(rows, "table_name string, column string, rows long, nulls long, rejected_rows long")
