"""Session helpers: a local session for tests and the bench, and the shared folder for
lineage cuts, stream checkpoints and written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the engine relies on. AQE re-plans joins from runtime sizes (a join side is
# broadcast only when its measured size is under the threshold) and splits skewed
# shuffle partitions; UTC and ANSI make results comparable with the SQL oracle.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "gridspark", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("GRIDSPARK_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the engine's SQL settings on an existing session (runtime-settable ones only)."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local master without the setting gets a fresh temporary folder, as in tests;
    a cluster without it is an error, because a machine-local folder is not shared.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext use the setting only
        if not d:
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster") from None
        return d.rstrip("/")
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="gridspark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder name under the shared folder."""
    path = f"{shared_dir(spark)}/gridspark/{name}-{uuid.uuid4().hex}"
    _handed_out(spark).append(path)
    return path


def _handed_out(spark: SparkSession) -> list[str]:
    sc = spark.sparkContext
    if not hasattr(sc, "_gridspark_scratch"):
        sc._gridspark_scratch = []
    return sc._gridspark_scratch


def scratch_mark(spark: SparkSession) -> int:
    """Marks the scratch folders handed out so far, for ``drop_scratch``."""
    return len(_handed_out(spark))


def drop_scratch(spark: SparkSession, since: int, keep: int = 0) -> int:
    """Delete the scratch folders handed out after the mark ``since`` but the newest ``keep`` of them; how many there
    were. For a run that owns them and has written what it returns; nothing lazy may read them any more."""
    held = _handed_out(spark)
    gone = held[since: len(held) - keep]
    for path in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    held[since: len(held) - keep] = []
    return len(gone)


# Input bytes that one shuffle partition is planned for; AQE joins partitions that turn out small.
PARTITION_BYTES = 64 << 20


def size_shuffles(spark: SparkSession, *paths: str) -> None:
    """Raise ``spark.sql.shuffle.partitions`` to what the files under ``paths`` call for. It is never lowered, and inputs
    that the setting already suits leave it alone."""
    size = 0
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        size += where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    wanted = -(-size // PARTITION_BYTES)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions", "200")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per session), so tasks can
    import it wherever the driver runs and without an install on the cluster."""
    sc = spark.sparkContext
    if getattr(sc, "_gridspark_shipped", False):
        return
    folder = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="gridspark-ship-"), "gridspark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(folder):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.join("gridspark", os.path.relpath(full, folder)))
    sc.addPyFile(out)  # served by the driver; the file itself is not read by executors
    sc._gridspark_shipped = True


def size_in_bytes(text: str) -> int:
    """A Spark size setting (``10485760``, ``10485760b``, ``128m``, ``1g``) in bytes;
    negative values (a disabled threshold) stay negative."""
    t = str(text).strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(float(t[:-1]) * units[t[-1]]) if t and t[-1] in units else int(t)
