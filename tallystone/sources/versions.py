"""A versioned table set: a reload becomes visible as a whole, after its checks, or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallystone.sources.tables import exists, read_table, remove_folder, write_table

_LOG = "versions"


class VersionFolder(Mapping):
    """The folder of a version while it is being written; a mapping of the tables written so far.

    Tables go into it as they are built.

    ``stamps`` names the column that a table's rows get their load time in. What ``measures`` gives for a
    table is counted by the write itself; ``metrics`` holds the results by table.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partition_by: Mapping[str, Sequence[str]] | None = None,
        stamps: Mapping[str, str] | None = None,
        measures: Callable[[str, DataFrame], Sequence[Column]] | None = None,
    ):
        self.spark, self.path = spark, path
        self._partition_by, self._stamps, self._measures = partition_by or {}, stamps or {}, measures
        self._written: dict[str, DataFrame] = {}
        self._observed: dict[str, Observation] = {}

    def write(self, name: str, df: DataFrame, dealt: bool = False) -> DataFrame:
        """Write a table, once, and return it as it is read from there, without its load time.

        ``dealt``: its rows come from files of one partition each.
        """
        columns, path = df.columns, f"{self.path}/{name}"
        measures = self._measures(name, df) if self._measures else []
        if measures:
            self._observed[name] = Observation()
            df = df.observe(self._observed[name], *measures)
        if name in self._stamps:
            df = df.withColumn(self._stamps[name], F.current_timestamp())
        write_table(df, path, self._partition_by.get(name, ()), mode="errorifexists", dealt=dealt)
        self._written[name] = read_table(self.spark, path)
        return self._written[name].select(*columns)

    def __getitem__(self, name: str) -> DataFrame:
        return self._written[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._written)

    def __len__(self) -> int:
        return len(self._written)

    @property
    def metrics(self) -> dict[str, dict]:
        """What was counted, by table."""
        return {name: observed.get for name, observed in self._observed.items()}


# What is published: the tables in order, or a function that writes them into the version's folder.
Publishable = Mapping[str, DataFrame] | Callable[[VersionFolder], None]


def publish(
    spark: SparkSession,
    root: str,
    tables: Publishable,
    check: Callable[[VersionFolder], None],
    partition_by: Mapping[str, Sequence[str]] | None = None,
    keep_versions: int | None = None,
    stamps: Mapping[str, str] | None = None,
    measures: Callable[[str, DataFrame], Sequence[Column]] | None = None,
) -> str:
    """Write all tables to a new version folder, check what was written, then switch to it.

    The switch is one record appended to the version log. When a write or a check fails nothing is
    appended, the new folder is removed, and readers keep the previous version. One writer at a time:
    a publication during which another one was recorded is refused. With ``keep_versions`` the folders of
    older versions are removed after the switch; readers of those must have ended.
    """
    if keep_versions is not None and keep_versions < 1:
        raise ValueError("keep_versions must be at least 1: the version just published")
    version = uuid.uuid4().hex
    before = _last(spark, root)
    folder = VersionFolder(spark, f"{root}/{version}", partition_by, stamps, measures)
    try:
        if callable(tables):
            tables(folder)
        else:
            for name, table in tables.items():
                folder.write(name, table)
        check(folder)
        if _last(spark, root) != before:
            raise RuntimeError(f"another version was published under {root} meanwhile")
    except BaseException:
        remove_folder(spark, f"{root}/{version}")
        raise
    sequence = (before or (0,))[0] + 1
    record = spark.range(1).select(F.lit(sequence).alias("sequence"), F.lit(version).alias("version"))
    record.withColumn("published_at", F.current_timestamp()).write.mode("append").parquet(f"{root}/{_LOG}")
    if keep_versions is not None:
        log = _log(spark, root)
        for row in log.filter(F.col("sequence") <= sequence - keep_versions).select("version").distinct().collect():
            remove_folder(spark, f"{root}/{row.version}")
    return version


def current_folder(spark: SparkSession, root: str) -> str | None:
    """The folder of the published version, if there is one."""
    last = _last(spark, root)
    return None if last is None else f"{root}/{last[1]}"


def current_tables(spark: SparkSession, root: str, names: Sequence[str], missing_ok: bool = False) -> dict[str, DataFrame]:
    """The published tables, or none when nothing has been published yet.

    With ``missing_ok`` a table that the current version lacks is left out.
    """
    folder = current_folder(spark, root)
    if folder is None:
        return {}
    present = [name for name in names if not missing_ok or exists(spark, f"{folder}/{name}")]
    return {name: read_table(spark, f"{folder}/{name}") for name in present}


def _log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("sequence int, version string").parquet(f"{root}/{_LOG}")


def _last(spark: SparkSession, root: str) -> tuple[int, str] | None:
    try:
        row = _log(spark, root).orderBy(F.desc("sequence"), "version").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if row is None else (row.sequence, row.version)
