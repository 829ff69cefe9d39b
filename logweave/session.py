"""Session helpers: UTC pinning and the shared scratch folder.

Every directory this library writes (staged log batches, streaming
checkpoints, sink tables) lives under the session's ``spark.checkpoint.dir``,
which on a cluster names a shared file system.  Only when it is unset (local
tests) do we create one of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: Names of zones that are UTC all year.
UTC_NAMES = {"UTC", "GMT", "Z", "UCT", "Zulu", "Universal", "Greenwich", "Etc/UTC", "Etc/GMT", "Etc/UCT", "Etc/Zulu", "Etc/Universal", "+00:00", "GMT+0", "GMT0"}


def require_utc(spark: SparkSession) -> None:
    """Results are defined in UTC; window boundaries depend on the zone. The session is the caller's, so it isn't changed."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone is {zone}; set it to UTC")


def scratch_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a temporary one only for a local master."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not is_local(sc.master):
            raise ValueError(f"master {sc.master}: set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="logweave-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def is_local(master: str) -> bool:
    """One process: executors share the driver's own folders (not so with local-cluster)."""
    return master == "local" or master.startswith("local[")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder for one run (no cleanup by deletion)."""
    return f"{scratch_root(spark)}/logweave/{name}-{uuid.uuid4().hex[:12]}"


def local_session(app: str = "logweave", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench: local mode, UI off, UTC, AQE on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # PySpark 4 captures the Python call site of every Column function
        # (~2 ms each); the codec builds hundreds of them per plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
