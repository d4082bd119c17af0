"""What the operators of this package share."""

from __future__ import annotations

import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylog.session import cut_lineage, shared_path

__all__ = [
    "ASCII_SPACE",
    "boxed",
    "cut_lineage",
    "discard",
    "free_shuffles",
    "hold",
    "quoted",
    "shared_path",
    "small_batches",
    "table",
]

# The white space that separates words, U+0020 and U+0009 to U+000D.
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def boxed(df: DataFrame, name: str = "row") -> Column:
    """All columns of a row as one struct, so that derived columns can't clash with them."""
    return F.struct(*[quoted(c) for c in df.columns]).alias(name)


def small_batches(df: DataFrame) -> DataFrame:
    """The same table, in a session that sends rows to Python in batches of 4 MB rather than 64.

    A batch is held several times over: as rows, as columns, and on the Python side. Texts are long, and a row
    is a batch of its own if need be.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20)
    return df


def discard(df: DataFrame) -> None:
    """Deletes a table of ``cut_lineage`` once nothing is computed from it any more."""
    spark = df.sparkSession
    folders = {path.rsplit("/", 1)[0] for path in df.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def free_shuffles(df: DataFrame) -> DataFrame:
    """The same stored table; shuffles that only led to it can go now.

    Spark deletes shuffle files when the driver's garbage collector finds that no plan refers to them. A driver that does little seldom
    collects, so the executors' disks would hold the shuffles of all steps at once.
    """
    for _ in range(2):  # what the first round frees refers to the shuffles
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
    return df


_held: dict[str, Callable[[], None]] = {}


def hold(name: str, release: Callable[[], None]) -> None:
    """Says that a task now works for operator ``name``, whose memory ``release`` gives back.

    Python workers outlive tasks and serve one operator after the other; each keeps the tables of one only.
    """
    if name not in _held:
        for other in list(_held):
            _held.pop(other)()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _held[name] = release
