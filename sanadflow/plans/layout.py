"""Partition layout and lineage: spreading work over the cores, cutting plans safely."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BROADCAST, BROADCAST_KNOWN = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def tasks(spark: SparkSession, per_core: int = 2) -> int:
    """Partitions for a CPU-heavy stage: those set for shuffles, or ``per_core`` for each core if that is more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism * per_core)


def spread(scan: DataFrame, per_core: int = 2) -> DataFrame:
    """Repartition a scan that has fewer partitions than the cluster has cores.

    For CPU-heavy stages over tables that arrive in few files. A number given to
    ``repartition`` is kept by AQE, which would otherwise coalesce small but expensive
    partitions. Larger tables keep their partitions and are not moved. Only for plans
    without a shuffle: asking others for their partitions would run them.
    """
    if scan.rdd.getNumPartitions() >= scan.sparkSession.sparkContext.defaultParallelism:
        return scan
    return scan.repartition(tasks(scan.sparkSession, per_core))


def spread_by(df: DataFrame, *keys: str, per_core: int = 2) -> DataFrame:
    """Hash partitions by ``keys`` in a number that AQE keeps; a following aggregation or join by them reuses it."""
    return df.repartition(tasks(df.sparkSession, per_core), *keys)


def checkpoint_dir(spark: SparkSession) -> str:
    """Make sure that ``checkpoint()`` has a folder all executors share, and return it.

    The cluster's ``spark.checkpoint.dir`` wins. A local folder is set only where the session names
    none and all of it runs on this machine, as in tests; it is removed when Python ends.
    On a cluster a session without a shared folder is an error, as every machine would write to its own disk.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="sanadflow-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder; survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def cleaning(spark: SparkSession) -> Iterator[None]:
    """Shuffles made for what is written inside go as soon as it is written."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@contextmanager
def by_true_size(spark: SparkSession) -> Iterator[None]:
    """Tables that are joined inside go to all tasks only if they are known to be small, by what was moved of them; the
    session's threshold stays. Spark's estimates beforehand are the compressed size of a stored table, whatever is
    exploded from it, so the driver would gather tables many times over the threshold. What is returned lazily is not
    inside: it needs a hint."""
    before, known = spark.conf.get(BROADCAST), spark.conf.get(BROADCAST_KNOWN, None)
    spark.conf.set(BROADCAST_KNOWN, before if known is None else known)
    spark.conf.set(BROADCAST, "-1")
    try:
        yield
    finally:
        spark.conf.set(BROADCAST, before)
        spark.conf.unset(BROADCAST_KNOWN) if known is None else spark.conf.set(BROADCAST_KNOWN, known)


def stored(df: DataFrame) -> DataFrame:
    """Like :func:`cut`, as a parquet table in the same shared folder: smaller, and readers
    take only the columns they need. Shuffles that were made for it go as soon as it is written.
    Its folder is new for each call; :func:`clear_stored` removes all of them."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with cleaning(df.sparkSession):
        df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Paths of the tables that are stored and not yet removed, in their order.
_written: list[str] = []


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def alone_stored(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, stored; the tables that it stored on its way are removed then. Nothing else may read them."""
    start = len(_written)
    out = stored(make())
    for path in _written[start:-1]:
        _remove(spark, path)
    del _written[start:-1]
    return out


def unstored(*tables: DataFrame) -> None:
    """Remove tables that :func:`stored` gave. Nothing may read them afterwards."""
    for df in tables:
        gone = {Path(x.removeprefix("file:")).parent.name for x in df.inputFiles()}
        for path in [x for x in _written if Path(x).name in gone]:
            _remove(df.sparkSession, path)
            _written.remove(path)


def clear_stored(spark: SparkSession) -> int:
    """Remove the tables that :func:`stored` has left in this session's folder, and return their number. For between
    queries: what still reads one of them fails afterwards."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        return 0
    here = sc._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
    files = here.getFileSystem(sc._jsc.hadoopConfiguration())
    left = [f.getPath() for f in files.listStatus(here) if f.getPath().getName().startswith("table-")] if files.exists(here) else []
    for path in left:
        files.delete(path, True)
    _written.clear()
    return len(left)


def hash128(col: Column, name: str = "h") -> list[Column]:
    """Two independently seeded 64-bit hashes of ``col``, as ``{name}1`` and ``{name}2``.

    A pair of them stands for the value in shuffles; at 10^12 distinct values the
    chance of any collision is about 10^-15.
    """
    return [F.xxhash64(F.lit(17), col).alias(f"{name}1"), F.xxhash64(F.lit(8191), col).alias(f"{name}2")]
