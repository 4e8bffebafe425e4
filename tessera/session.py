"""Session builder and table loader.

Configuration targets a cluster first: AQE (coalescing, skew join),
UTC session time, ANSI semantics.  Shuffle partitions and the checkpoint
folder are read from the existing session when they are set, so a cluster
configuration is never overwritten; local defaults apply only when unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        configure(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder.master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEM", "16g"))
               .config("spark.sql.shuffle.partitions",
                       str(shuffle_partitions or int(cpus)))
               .config("spark.sql.files.maxPartitionBytes", str(64 << 20)))
    if os.environ.get("TESSERA_CHECKPOINT_DIR"):
        builder = builder.config("spark.checkpoint.dir", os.environ["TESSERA_CHECKPOINT_DIR"])
    elif (master or "local").startswith("local"):  # a cluster must name a shared folder itself
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessera-ckpt-"))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Apply defaults only where the session leaves a key unset."""
    for k, v in _DEFAULTS.items():
        if k == "spark.ui.enabled":
            continue  # static conf; set at build time only
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - read-only or unknown key: keep the session's value
            pass
    try:
        checkpoint_dir(spark)
    except RuntimeError:
        raise
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (e.g. remote clients)
        pass


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system).  Only when it is unset, as in local tests, a scratch folder
    is created and registered.
    """
    path = spark.sparkContext.getCheckpointDir()
    if path:
        return path
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage cuts and scratch "
                               "tables must survive executor loss")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")  # local runs and tests only
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet at ``path``, or None when nothing was written there yet; any
    other read error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return None


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Typed Parquet scan of one driver table (filters and projections push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [load_table(spark, sf_dir, n) for n in names]
