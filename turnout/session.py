"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on.  AQE re-plans joins from
# runtime sizes (a join side becomes a broadcast only after its measured size
# is under the threshold) and splits skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when the join feeds an aggregate or
    # window on the same key (one activity or member may hold a third of the rows)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # delete reliable checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def builder(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "turnout"):
    b = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    return (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.driver.memory", os.environ.get("TURNOUT_DRIVER_MEMORY", "8g")))


def get_session(master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession:
    spark = builder(master, shuffle_partitions).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def apply_settings(spark: SparkSession) -> None:
    """Switch on, in a session made elsewhere, the runtime settings that keep a
    hot key splittable.  Sizes and partition counts stay the session's own."""
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(k, DEFAULT_CONF[k])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster the operator names it in ``spark.checkpoint.dir`` (a shared
    file system); a temporary folder is only made when nothing is configured
    and the master is local (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - not readable through the session conf
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage): "
                               "models and checkpoints are written there")
        conf_dir = tempfile.mkdtemp(prefix="turnout-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``turnout`` importable in the Python workers (the Arrow-batched
    page helpers run there): zip the package once per application and hand it
    to ``addPyFile``, which distributes it to every executor."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    folder = tempfile.mkdtemp(prefix="turnout-py-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    out = os.path.join(folder, "turnout.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, dirnames, files in os.walk(pkg_dir):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for f in files:
                if f.endswith((".py", ".csv")):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over the session's shuffle partitions, for a step that costs
    far more than its input's bytes tell (small files, or files of one kind of rows, would
    go to one task).  Rows are dealt in turn, so equal or null keys do not meet."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder.  It lives until
    ``cleanup`` or the end of the Python process, as results read from it lazily."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_at_exit)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def cleanup(spark: SparkSession) -> int:
    """Delete the scratch folders made so far; call it when the results that
    were read from them have been written.  Returns the number deleted."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and not spark.sparkContext._jsc.sc().isStopped():
        cleanup(spark)
