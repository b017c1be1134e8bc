"""Session construction and the shared scratch area.

Scratch data (stream checkpoints, round-trip tables, summaries) always goes
under the cluster's checkpoint directory, which on a real cluster is a shared
file system. A private temporary folder is only created when the session has
none configured and runs in a single process, as in tests; on a cluster that
would lose files silently, so there it is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", app: str = "opslens",
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library assumes.

    AQE stays on (runtime coalescing and skew splitting), the UI stays off,
    times are UTC so both engines in the oracle see the same wall clock.
    """
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _private_folder(master: str) -> str:
    """A temporary folder for a single-process session; an error anywhere else."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master!r}")
    return tempfile.mkdtemp(prefix="opslens-ckpt-")


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint directory; a fresh local one only if unset and not on a cluster."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder under Spark Connect") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(configured or _private_folder(sc.master))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the checkpoint directory."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
