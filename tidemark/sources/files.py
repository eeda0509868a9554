"""CSV, JSON and Parquet in; versioned Parquet tables out."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from tidemark import schema as S
from tidemark.functions import sqltext as sql

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INTEGER = r"^[+-]?\d+$"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False, key: str = S.KEY
) -> DataFrame:
    """Header CSV whose missing-value tokens become NULL.

    With a schema the columns are cast to it and no extra pass is made. Without one a
    single aggregate decides every column's type: whole numbers are BIGINT (DOUBLE
    when values are missing), other numbers DOUBLE, the rest STRING.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    # The header is read alone: every data column then comes in as text.
    names = reader.csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = reader.schema(text).csv(path)
    tokens = ", ".join(map(sql.text, S.NA_TOKENS))
    clean = raw.select(*[
        F.expr(f"CASE WHEN {sql.name(n)} NOT IN ({tokens}) THEN {sql.name(n)} END AS {sql.name(n)}") for n in names
    ])
    if schema is not None:
        wanted = {f.name: f.dataType for f in schema}
        return clean.select(
            *[F.col(f"`{n}`").try_cast(wanted[n]).alias(n) if n in wanted else F.col(f"`{n}`") for n in names]
        )
    types = _column_types(clean, key)
    return clean.select(*[F.expr(f"try_cast({sql.name(n)} AS {types[n]}) AS {sql.name(n)}") for n in names])


def _column_types(clean: DataFrame, key: str) -> dict[str, str]:
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(clean.columns):
        column = sql.name(name)
        aggs += [
            F.expr(f"count({column}) AS n{i}"),
            F.expr(f"count_if({column} RLIKE {sql.text(_NUMBER)}) AS d{i}"),
            F.expr(f"count_if({column} RLIKE {sql.text(_INTEGER)} AND try_cast({column} AS BIGINT) IS NOT NULL) AS i{i}"),
        ]
    row = clean.agg(*aggs).first()
    types = {}
    for i, name in enumerate(clean.columns):
        present = row[f"n{i}"]
        if row[f"i{i}"] == present and (present == row["rows"] or name == key):
            types[name] = "bigint"
        elif name == key:
            types[name] = "string"  # a key is never rounded to a DOUBLE
        elif row[f"d{i}"] == present:
            types[name] = "double"
        else:
            types[name] = "string"
    return types


def read_table(spark: SparkSession, path: str, hint: str = "run the step that writes it first") -> DataFrame:
    """Parquet table; a missing one raises ``FileNotFoundError`` with guidance."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no table at {path}: {hint}") from error
        raise


def column_names(spark: SparkSession, path: str) -> list[str]:
    """Names from the file footers; no data is scanned."""
    return read_table(spark, path).columns


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a table written by :func:`write_splits`; other splits are not read."""
    return read_table(spark, path).where(F.col(S.SPLIT) == split)


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_splits(df: DataFrame, path: str) -> str:
    """One table, a folder per split, the key kept so that rows need no positions."""
    df.write.mode("overwrite").partitionBy(S.SPLIT).parquet(path)
    return path


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON records with known fields typed and the others kept in ``extras``.

    Values that do not fit a field's type become NULL and their fields are listed in
    ``misfits``, which the row rules report.
    """
    as_text = spark.read.text(path)
    return parse_records(as_text, schema)


def parse_records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Same over a frame with a ``value`` column of JSON text (batch or stream)."""
    parsed = lines.select(F.from_json("value", "map<string,string>").alias("fields"))
    known = [f.name for f in schema]
    typed = [F.col("fields").getItem(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    extras = F.map_filter("fields", lambda k, _: ~k.isin(*known)).alias("extras")
    misfits = F.array_compact(F.array(*[
        F.when(F.col("fields")[f.name].isNotNull() & F.col("fields")[f.name].try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema
    ])).cast("array<string>")
    return parsed.select(*typed, extras, misfits.alias("misfits"))


# ------------------------------------------------------------------ Hadoop file system


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a completed write is at ``path`` (its ``_SUCCESS`` marker is there)."""
    system, target = _file_system(spark, posixpath.join(path, "_SUCCESS"))
    return bool(system.exists(target))


def unless_exists(spark: SparkSession, path: str, build) -> DataFrame:
    """Resume: read a finished table, or build and write it."""
    if not table_exists(spark, path):
        write_table(build(), path)
    return spark.read.parquet(path)


class VersionedTable:
    """A table whose content can be replaced while it is being read.

    Every version is a folder of its own, numbered; the highest one whose write was
    completed is in force. A reader keeps its version, a failed write changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[str]:
        """Completed versions, oldest first."""
        system, target = _file_system(self.spark, self.root)
        if not system.exists(target):
            return []
        names = [status.getPath().getName() for status in system.listStatus(target)]
        return [n for n in sorted(names) if table_exists(self.spark, f"{self.root}/{n}")]

    def read(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"no version of {self.root} yet: write one first")
        return self.spark.read.parquet(f"{self.root}/{versions[-1]}")

    def write(self, df: DataFrame, partition_by: str | None = None) -> str:
        versions = self.versions()
        number = int(versions[-1].split("-")[0]) + 1 if versions else 0
        path = f"{self.root}/{number:08d}-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        return path


def append_column(table: VersionedTable, name: str, column: Column) -> DataFrame:
    """Replace a column computed from the row itself: one projection, nothing is shuffled."""
    fresh = table.read().drop(name).withColumn(name, column)
    table.write(fresh, S.SPLIT if S.SPLIT in fresh.columns else None)
    return table.read()


def append_score(table: VersionedTable, scores: DataFrame, score: str = S.SCORE, key: str = S.KEY) -> DataFrame:
    """Replace a table's score column by scores computed elsewhere, matched by key."""
    fresh = table.read().drop(score).join(scores.select(key, score), key, "left")
    partition = S.SPLIT if S.SPLIT in fresh.columns else None
    table.write(fresh, partition)
    return table.read()
