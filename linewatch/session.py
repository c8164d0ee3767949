"""Session settings, the shared checkpoint folder and staged frames."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning is what keeps hot keys and wrong size guesses harmless, so
# it is stated here instead of relying on a cluster's defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "linewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for reliable checkpoints, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a local
    session falls back to a folder beside the warehouse; on a cluster the warehouse
    must then be on shared storage, since each executor would write a ``file:``
    folder on its own disk.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if _own_disk(spark, named) and not context.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to shared storage: {named} is a folder of each machine")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def _own_disk(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


_STAGED: list[tuple[SparkSession, str]] = []


def staging_folder(spark: SparkSession) -> str:
    """A new folder's path in the shared checkpoint folder; it goes with :func:`drop_staged`."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    _STAGED.append((spark, path))
    return path


def staged(*frames: DataFrame, **options: str) -> DataFrame | list[DataFrame]:
    """The frames written once to the shared checkpoint folder and read back.

    For frames that several later steps read: they scan the columns they need
    instead of repeating the work, and a lost executor repeats only a scan.
    Several frames are written side by side. ``options`` are the writer's. The
    folders go when the interpreter ends, or with :func:`drop_staged`.
    """
    spark = frames[0].sparkSession

    def write(df: DataFrame) -> DataFrame:
        path = staging_folder(spark)
        df.write.options(**options).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    if len(frames) == 1:
        return write(frames[0])
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(write, frames))


def drop_staged(spark: SparkSession) -> None:
    """Removes what :func:`staged` has written in this session; frames on it can't be read again."""
    for _, folder in [e for e in _STAGED if e[0] is spark]:
        drop_folder(spark, folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Removes one folder that :func:`staging_folder` has named."""
    _STAGED[:] = [e for e in _STAGED if e[1] != folder]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _drop_all() -> None:
    for spark in {id(s): s for s, _ in _STAGED}.values():
        with contextlib.suppress(Exception):  # a stopped session has no file system any more
            if spark.sparkContext._jsc:
                drop_staged(spark)


atexit.register(_drop_all)
