"""Session plumbing that every operator shares: where scratch tables go and how Python code reaches executors."""

from __future__ import annotations

import atexit
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

if TYPE_CHECKING:
    import pandas as pd
    from pyspark.sql.types import DataType

_OWN_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session leaves it unset and driver and executors are one process (tests, a laptop) a local
    temporary folder stands in; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = f"file://{tempfile.mkdtemp(prefix='quarry-')}"
        spark.sparkContext.setCheckpointDir(_OWN_DIRS[app])
    return _OWN_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; it is removed when the driver ends."""
    path = f"{scratch_root(spark)}/quarry-{uuid.uuid4().hex}-{name}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may be gone already; the folder is scratch space
        pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again: the lineage ends there and losing an
    executor costs nothing that was written."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`stored`, with the table's path, so that rounds can :func:`remove` what their successors replaced."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def unused(stem: str, columns: list[str]) -> str:
    """A column name that ``columns`` do not hold, in any case."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def numbered(df: DataFrame, keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """With the columns that an operator does not read named by their places, so that no name clashes with its own and
    none has signs that Python functions cannot be given; ``toDF(*names)`` brings the names back."""
    return df.toDF(*(n if n in keep else f"x{i}" for i, n in enumerate(df.columns)))


def quoted(name: str) -> str:
    """A column name as an expression, dots and backticks in it included."""
    return "`" + name.replace("`", "``") + "`"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quarry-ship-")) / "quarry_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, os.path.join(root.name, source.relative_to(root)))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def give_back() -> None:
    """Return freed memory to the system at a task's end: its Python worker lives on, idle, while others run beside it."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def in_slices(batches: Iterator, rows: int = 256) -> Iterator:
    """Arrow batches a few rows at a time, so that few texts are Python strings or copied at once, and memory given
    back behind the last."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    batch = None  # noqa: F841 - it holds the last rows
    give_back()


def column_in_slices(function: Callable[[pd.Series], pd.Series], kind: DataType, rows: int = 64):
    """A pandas function of one column that gets a few rows at a time: what it makes of a row, such as a parsed page, is
    many times the row."""
    import pandas as pd
    from pyspark.sql import functions as F

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            for at in range(0, len(values), rows):
                yield function(values.iloc[at : at + rows])
        values = None  # noqa: F841 - it holds the last rows
        give_back()

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, kind)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
