"""Catalog tables: namespaces, ingest with lineage columns, sinks, files and previews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("source", "bronze", "silver", "gold")


# Stored tables are written once and read a few times; zstd takes half of the default's bytes for texts like these.
CODECS = {"parquet": {"compression": "zstd"}}


class SchemaMismatch(ValueError):
    """A frame does not have the columns of the table it should replace."""


def create_namespace(spark: SparkSession, name: str, location: str | None = None, use: bool = False) -> str:
    """Make sure a database exists (at a shared location, if given) and optionally make it current."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    if use:
        spark.catalog.setCurrentDatabase(name)
    return name


def create_layers(spark: SparkSession, folder: str, prefix: str = "") -> dict[str, str]:
    """The layer databases, each in its own folder; returns the database name per layer."""
    return {layer: create_namespace(spark, f"{prefix}{layer}", f"{folder}/{layer}") for layer in LAYERS}


def with_lineage(scan: DataFrame) -> DataFrame:
    """Add the path of the file a row came from and the time of the query.

    ``scan`` must read files directly (a path or a file-backed table).
    """
    return scan.select(
        "*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("ingested_at")
    )


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns at ingest; a value that does not fit becomes null, not an error."""
    casts = {name: F.col(name).try_cast(kind) for name, kind in types.items() if name in df.columns}
    return df.withColumns(casts) if casts else df


def save(df: DataFrame, table: str, fmt: str = "parquet") -> DataFrame:
    """Replace a table, whatever its schema was, and return the stored one."""
    df.write.format(fmt).options(**CODECS.get(fmt, {})).mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
    return df.sparkSession.table(table)


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


SAME = "same"


def schema_verdicts(old: T.StructType, new: T.StructType) -> list[tuple[str, str | None, str | None, str]]:
    """(column, old type, new type, verdict) of every column of either schema: same, moved, retyped, dropped or added."""
    before, after = dict(_shape(old)), dict(_shape(new))
    rows = []
    for name, kind in before.items():
        now = after.get(name)
        at_home = name in after and old.names.index(name) == new.names.index(name)
        verdict = "dropped" if now is None else "retyped" if now != kind else SAME if at_home else "moved"
        rows.append((name, kind, now, verdict))
    return rows + [(name, None, kind, "added") for name, kind in after.items() if name not in before]


def checked_overwrite(df: DataFrame, table: str, fmt: str = "parquet") -> DataFrame:
    """Replace the rows of a table if its schema stays as it is, and tell the verdict per column; create it if absent.

    The rows are first written to a staging table beside it, which then takes its name: a refused or failed write leaves the old
    table whole, and ``df`` may read the table it replaces. Verdicts other than "same" mean that nothing was changed.
    """
    spark = df.sparkSession
    old = spark.table(table).schema if spark.catalog.tableExists(table) else df.schema
    rows = schema_verdicts(old, df.schema)
    verdicts = spark.createDataFrame(rows, "column_name string, old_type string, new_type string, verdict string")
    if any(row[-1] != SAME for row in rows):
        return verdicts
    staging, retired = f"{table}__new", f"{table}__old"
    for leftover in (staging, retired):  # of a run that failed half-way
        if leftover == retired and spark.catalog.tableExists(retired) and not spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {retired} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {leftover}")
    df.write.format(fmt).options(**CODECS.get(fmt, {})).saveAsTable(staging)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {retired}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {retired}")
    return verdicts


def save_same_schema(df: DataFrame, table: str, fmt: str = "parquet") -> DataFrame:
    """Replace the rows of a table only if names and types stay as they are; create it if absent."""
    bad = checked_overwrite(df, table, fmt).where(F.col("verdict") != SAME).collect()  # one row per column
    if bad:
        raise SchemaMismatch(f"{table}: {', '.join(f'{r.column_name} {r.verdict}' for r in bad)}")
    return df.sparkSession.table(table)


def ingest(
    spark: SparkSession,
    name: str,
    source: str,
    target: str,
    types: Mapping[str, str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Copy one source table to ``{name}_bronze`` with lineage columns and the given number types."""
    rows = with_lineage(spark.table(f"{source}.{name}"))
    return save(typed(rows, types or {}), f"{target}.{name}_bronze", fmt)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; types are inferred (one more pass) unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


# Rows a schema is inferred from, and the share of a column's values in them that a type must fit.
SAMPLE_ROWS = 10_000
FITTING = 0.9
GUESSED_TYPES = ("bigint", "double", "boolean", "date", "timestamp")
_REJECTED = "_rejected_"


def guessed_schema(text: DataFrame, rows: int = SAMPLE_ROWS, fitting: float = FITTING) -> T.StructType:
    """A type per text column from the first rows: the first of ``GUESSED_TYPES`` that nearly all their values fit.

    Values that do not fit are left to the reader's rejects; a column without values in the sample stays text.
    """
    counted = [F.count(c).alias(f"{c}:any") for c in text.columns]
    for c in text.columns:
        counted += [F.count(F.expr(f"try_cast(`{c}` as {kind})")).alias(f"{c}:{kind}") for kind in GUESSED_TYPES]
    found = text.limit(rows).agg(*counted).first()

    def kind(c: str) -> str:
        n = found[f"{c}:any"]
        return next((k for k in GUESSED_TYPES if n and found[f"{c}:{k}"] >= fitting * n), "string")

    return T.StructType([T.StructField(c, T._parse_datatype_string(kind(c))) for c in text.columns])


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """CSV as (rows, rejects); every record is read and lands in exactly one of them.

    Without a ``schema``, names come from the header and types from a bounded sample (see ``guessed_schema``). A reject
    keeps its record as ``record`` and a ``reason``: the number of fields, or each column whose text does not read as its type.
    """
    reader = spark.read.option("header", header)
    if schema is None:
        schema = guessed_schema(reader.csv(path))
    marked = T.StructType([*schema.fields, T.StructField(_REJECTED, T.StringType())])
    kept = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REJECTED}
    # Always true, and reads every column: a scan of some columns would not see misfits in the others.
    whole = F.hash(*schema.names) >= -(1 << 31)
    read = reader.options(**kept).schema(marked).csv(path)
    texts = ", ".join(f"`{c}` string" for c in (*schema.names, _REJECTED))
    rejects = read.where(F.col(_REJECTED).isNotNull() & whole).select(
        F.col(_REJECTED).alias("record"), F.from_csv(_REJECTED, texts, kept).alias("_fields")
    )
    wrong = []
    for f in schema.fields:
        value = F.col(f"_fields.`{f.name}`")
        misfit = value.isNotNull() & value.try_cast(f.dataType).isNull()
        wrong.append(F.when(misfit, F.concat(F.lit(f"{f.name}: "), value, F.lit(f" is no {f.dataType.simpleString()}"))))
    uneven = F.col(f"_fields.{_REJECTED}").isNotNull()
    reason = F.when(uneven, F.lit(f"not {len(schema)} fields")).otherwise(F.concat_ws("; ", *wrong))
    return read.where(F.col(_REJECTED).isNull() & whole).drop(_REJECTED), rejects.select("record", reason.alias("reason"))


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first rows, for display; along ``order`` if given (a bounded top-n, not a sort)."""
    return (df.orderBy(*order) if order else df).limit(n)


def column_listing(frames: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, position (from 1), column_name, column_type of every column of the named frames."""
    rows = [
        (name, i, column, kind) for name, df in frames.items() for i, (column, kind) in enumerate(column_types(df), start=1)
    ]
    spark = next(iter(frames.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, column_type string")


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """Column names with their types."""
    return _shape(df.schema)


def shape(df: DataFrame) -> tuple[int, int]:
    """Row count and column count."""
    return df.count(), len(df.columns)
