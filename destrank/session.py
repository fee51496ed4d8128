"""Session helper and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on. Time zone is pinned so that day strings
# cut from timestamps never depend on the machine; adaptive
# execution re-plans joins from measured sizes and splits skewed partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce small shuffle outputs to the advisory partition size rather
    # than to the default parallelism: on a large cluster the latter turns
    # small stages (place-level tables) into thousands of tiny tasks.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.ui.enabled": "false",
    # Python call-site capture for error messages costs two gateway calls
    # per Column function; plans here are built from many such calls.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "destrank",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    ``master`` and ``shuffle_partitions`` are left to the cluster unless
    given, which is what tests and local runs do.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Runtime settings also apply when the session already existed.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor
    can reach; it is read from the session and never replaced. Only when
    nothing is configured and the master is local (tests, a laptop) a
    fresh folder is made; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        # A machine-local folder is useless to executors on other hosts.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    target = configured or tempfile.mkdtemp(prefix="destrank-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def checkpoint_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoint ``df`` to the shared folder and count its rows in the
    same job (an observation), so the count costs no extra pass."""
    saved, rows, _ = checkpoint_measured(df)
    return saved, rows


def checkpoint_measured(df: DataFrame) -> tuple[DataFrame, int, int]:
    """Like :func:`checkpoint_counted`, also observing an approximate
    size in bytes: string and binary lengths plus 8 bytes per other value."""
    ensure_checkpoint_dir(df.sparkSession)
    widths = [
        F.coalesce(F.octet_length(F.col(name)), F.lit(0)) if dtype in ("string", "binary") else F.lit(8)
        for name, dtype in df.dtypes
    ]
    row_bytes = sum(widths[1:], widths[0]) if widths else F.lit(0)
    obs = Observation(f"rows-{uuid.uuid4().hex}")
    saved = df.observe(obs, F.count(F.lit(1)).alias("n"), F.sum(row_bytes.cast("long")).alias("b")).checkpoint()
    got = obs.get
    return saved, int(got["n"]), int(got["b"] or 0)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/destrank-{name}-{uuid.uuid4().hex}"
