"""Parquet and CSV tables, and intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


# Codec of what is written here: names, texts and hex digests take a third less than with the default one.
CODEC = "zstd"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", dealt: bool = False) -> None:
    """Write Parquet.

    With partition columns the rows are rebalanced on them first: each folder gets few, large files,
    and AQE splits a folder that holds far more rows than the others over several tasks. Rows that are
    ``dealt`` so already, read from such folders, are written where they are.
    """
    if partition_by and not dealt:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    df.write.mode(mode).partitionBy(*partition_by).parquet(path, compression=CODEC)


# Doubled quotes, blanks kept, and NULL spelled apart from the empty string (as PostgreSQL's text form does).
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# A single CSV file is for small reports: one task writes it.
SINGLE_FILE_ROWS = 100_000
# Other exports are cut into files of so many rows: a file with line breaks in its texts is read by one task.
CSV_FILE_ROWS = 250_000


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write CSV that ``read_csv`` gives back unchanged, except that a text of a backslash and N is NULL.

    Export a written table rather than a query, so that CSV and Parquet agree and nothing runs twice.
    ``single_file`` funnels everything through one task, so it refuses more than ``SINGLE_FILE_ROWS`` rows.
    """
    if single_file:
        if df.limit(SINGLE_FILE_ROWS + 1).count() > SINGLE_FILE_ROWS:
            raise ValueError(f"a single CSV file is for at most {SINGLE_FILE_ROWS} rows; export several files")
        df = df.coalesce(1)
    df.write.mode("overwrite").options(maxRecordsPerFile=CSV_FILE_ROWS, **CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """An exported table, every column as text."""
    texts = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    options = CSV_OPTIONS | {"emptyValue": "", "enforceSchema": "false", "multiLine": "true"}
    return spark.read.schema(texts).options(**options).csv(path)


# ---- intermediate tables ----------------------------------------------------------------

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a plain local session may go without; it gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(prefix="tallystone-", ignore_cleanup_errors=True)
    return _local_folders[app].name


def _width(df: DataFrame) -> Column:
    """Estimated size of a row in memory: text bytes plus 16 per field."""
    texts = [f.name for f in df.schema.fields if f.dataType == T.StringType()]
    return sum((F.coalesce(F.octet_length(name), F.lit(0)) for name in texts), F.lit(16 * len(df.columns))).cast("bigint")


class Staged:
    """A table written to the shared folder, whose size can be asked for before it is broadcast."""

    def __init__(self, df: DataFrame, whole: Staged | None = None, measured: Observation | None = None, path: str | None = None):
        self.df = df
        self._whole = whole
        self._measured = measured
        self._path = path

    @cached_property
    def _sizes(self) -> dict:
        if self._measured is not None:
            return self._measured.get
        return self.df.agg(F.sum(_width(self.df)).alias("bytes"), F.count(F.lit(1)).alias("rows")).first().asDict()

    @cached_property
    def bytes(self) -> int:
        """Estimated size in memory. Known from the write if it was measured, else one small job on the written table."""
        return self._whole.bytes if self._whole is not None else self._sizes["bytes"] or 0

    @cached_property
    def rows(self) -> int:
        return self._whole.rows if self._whole is not None else self._sizes["rows"] or 0

    def select(self, *columns) -> Staged:
        """Fewer columns of the same rows; the whole table's size is taken as an upper bound."""
        return Staged(self.df.select(*columns), self._whole or self)

    def remove(self) -> None:
        """Remove the files before the application ends; DataFrames that read them end with them."""
        if self._path is not None:
            remove_folder(self.df.sparkSession, self._path)


_marked: set[str] = set()


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tallystone/{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def remove_folder(spark: SparkSession, path: str) -> None:
    system, jvm_path = _file_system(spark, path)
    system.delete(jvm_path, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, jvm_path = _file_system(spark, path)
    return system.exists(jvm_path)


def release_staged(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application now; DataFrames that read them end with it."""
    remove_folder(spark, _application_folder(spark))


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of finished shuffles removed now.

    Spark removes them as soon as the driver has forgotten the query; a driver with memory to spare collects that late.
    """
    spark._jvm.System.gc()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; the application's folder there goes when its driver ends, also after a failure."""
    folder = _application_folder(spark)
    if folder not in _marked:
        system, jvm_path = _file_system(spark, folder)
        system.mkdirs(jvm_path)
        system.deleteOnExit(jvm_path)
        _marked.add(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def observe_size(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, whose number and size are counted on the way by whatever runs them first."""
    measured = Observation()
    return df.observe(measured, F.sum(_width(df)).alias("bytes"), F.count(F.lit(1)).alias("rows")), measured


def stage(df: DataFrame, label: str, measured: bool = False) -> Staged:
    """Write a DataFrame to the shared folder once and read it back.

    For results with several consumers: the work runs once, later plans prune columns and
    push filters into the Parquet scan, and a lost executor costs no recomputation. ``measured`` counts
    rows and bytes with the write, for lookups whose size decides how they are joined.
    """
    path = scratch_path(df.sparkSession, label)
    sizes = None
    if measured:
        df, sizes = observe_size(df)
    df.write.parquet(path, compression=CODEC)
    return Staged(df.sparkSession.read.schema(df.schema).parquet(path), measured=sizes, path=path)
