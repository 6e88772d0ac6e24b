"""Running this subpackage's Arrow functions on executors that do not have the package installed."""

from __future__ import annotations

import ctypes
import inspect
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

_shipped: dict[str, tempfile.TemporaryDirectory] = {}
_forgetters: list[Callable[[], None]] = []


def ship(spark: SparkSession) -> None:
    """Hand the package's source files to the executors, once per application, as ``--py-files`` would."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.TemporaryDirectory(prefix="tallystone-", ignore_cleanup_errors=True)
    archive = Path(folder.name) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped[application] = folder


def forgets(function: Callable[[], None]) -> Callable[[], None]:
    """Register what empties a module's caches; called at the end of every Python task of this package."""
    _forgetters.append(function)
    return function


def trim() -> None:
    """Hand freed memory back to the system; the allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if give_back is not None:
        give_back(0)


def release() -> None:
    """Empty a Python worker's caches: workers live on for the next stages, beside a full JVM heap."""
    for function in _forgetters:
        function()
    trim()


def map_in_arrow(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """``DataFrame.mapInArrow`` for a function that uses this package."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in function(batches):
                yield batch
                trim()
        finally:
            release()

    return df.mapInArrow(run, schema)


def per_group(spark: SparkSession, function: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """A function for ``applyInArrow``, of one table or two, that uses this package."""
    ship(spark)
    if len(inspect.signature(function).parameters) == 2:

        def run_two(left: pa.Table, right: pa.Table) -> pa.Table:
            try:
                return function(left, right)
            finally:
                release()

        return run_two

    def run_one(table: pa.Table) -> pa.Table:
        try:
            return function(table)
        finally:
            release()

    return run_one
