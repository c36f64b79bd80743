"""Session helpers.

`get_session` builds a session with the settings every job here relies on
(AQE, UTC, Arrow); on a cluster the session usually exists already and is
only read.  `shared_dir` hands out folders under the cluster's shared
checkpoint directory, so written snapshots and streaming checkpoints live
where every executor (and a restarted driver) can see them.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that shape plans.  Partition counts stay the caller's business:
# a cluster sets them for its own data volume, tests set them to the cores.
_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Static settings: only effective when the session is first built.
_STATIC_CONF = {
    # Python call-site capture costs several JVM round trips per Column call
    # while plans are built; it only decorates error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "offerframe") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**_SQL_CONF, **_STATIC_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for key, value in _SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench: local mode, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("offerframe-local")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.default.parallelism", str(cores))
    )
    for key, value in {**_SQL_CONF, **_STATIC_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that their Python workers need no installation of it."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        root = Path(__file__).resolve().parent
        name = Path(tempfile.mkdtemp(prefix="offerframe-code-"), f"{root.name}.zip")
        with zipfile.ZipFile(name, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        sc.addPyFile(str(name))


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session first (`spark.checkpoint.dir` or one set on the
    context).  Only when neither is set and the master is local (tests) a
    fresh scratch folder is created and registered, so later calls agree;
    on a cluster an unset folder is an error, never a machine-local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the SQL conf is visible
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    conf_dir = None
    try:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        conf_dir = None
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        except Exception:
            master = ""
        if not master.startswith("local"):
            # A machine-local folder is invisible to other executors.
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        conf_dir = tempfile.mkdtemp(prefix="offerframe-ckpt-")
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def ensure_local_parent(path: str) -> None:
    """Create the parent of a plain local path (Spark creates the rest)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
    if path.startswith("/"):
        os.makedirs(os.path.dirname(path.rstrip("/")) or "/", exist_ok=True)
