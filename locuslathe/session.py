"""Session building and the helpers every operator shares for cutting lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "locuslathe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for: UTC, ANSI, AQE with skew handling.

    ``master`` and ``conf`` override; on a cluster both normally come from spark-submit.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for k, v in (defaults | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only where unset on a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="locuslathe-ckpt-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` by a reliable checkpoint, so that a lost executor costs no recomputation from the start."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Folders of the tables that ``write_through`` wrote and that still lie there, oldest first.
_TABLES: dict[str, SparkSession] = {}


def write_through(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the checkpoint folder and read again.

    For rows that are read several times: compressed, and readers take only the columns they need. The table is removed
    by ``release``, at the end of the ``temporary_tables`` around, or when the Python process ends. The shuffles that made
    it go as soon as it is written.
    """
    spark = df.sparkSession
    path = _own(spark)
    with _dropping_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._locuslathe_table = path
    return out


@contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _own(spark: SparkSession) -> str:
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    if not _TABLES:
        atexit.register(_remove_all)
    _TABLES[path] = spark
    return path


def scratch_folder(spark: SparkSession) -> str:
    """A new place in the checkpoint folder for files; it goes as the tables of ``write_through`` do."""
    return _own(spark)


def release(*tables: DataFrame | None) -> None:
    """Remove what ``write_through`` wrote for these; nothing may read them any more. Others are left alone."""
    for t in tables:
        path = getattr(t, "_locuslathe_table", None)
        if path in _TABLES:
            _remove(_TABLES.pop(path), path)


@contextmanager
def temporary_tables() -> Iterator[None]:
    """Tables that operators write inside are removed at the end; results must be written or collected before it."""
    before = set(_TABLES)
    try:
        yield
    finally:
        for path in [p for p in _TABLES if p not in before]:
            _remove(_TABLES.pop(path), path)


def _remove_all() -> None:
    for path in list(_TABLES):
        _remove(_TABLES.pop(path), path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended before; the folder is its user's
        pass


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, or ``stem`` with underscores in front, whichever no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def spread_scan(df: DataFrame) -> DataFrame:
    """``df``, a plain scan, in at least as many partitions as there are cores.

    For costly work per row over a few small files. A scan that already has enough splits, as any large one, is left as
    it is, so nothing is shuffled then.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
