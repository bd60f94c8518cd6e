"""Session construction and shared scratch locations.

Object-store endpoints, credentials and similar settings come in through ``conf``
(or the cluster's spark-defaults); nothing is hard-coded here.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Defaults every job in this library relies on. Callers may override any of them.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "terrace", conf: Mapping[str, str] | None = None,
                  master: str | None = None) -> SparkSession:
    """Create (or reuse) a SparkSession with the library defaults plus ``conf``.

    ``conf`` carries everything site-specific, e.g. ``spark.hadoop.fs.s3a.endpoint``,
    ``spark.hadoop.fs.s3a.path.style.access`` or a credentials provider class.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate(), merged)


def configure(spark: SparkSession, conf: Mapping[str, str] | None = None) -> SparkSession:
    """Apply the library's runtime SQL defaults (plus ``conf``) to a running session.

    Static settings of an existing session cannot change; only ``spark.sql.*`` runtime
    settings are applied.
    """
    merged = dict(DEFAULT_CONF)
    merged.update(conf or {})
    for key, value in merged.items():
        if key.startswith("spark.sql.") and not key.startswith("spark.sql.warehouse"):
            try:
                spark.conf.set(key, value)
            except AnalysisException as error:
                if "CANNOT_MODIFY" not in str(error):  # a static setting of a running session stays
                    raise
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (e.g. a Spark Connect client)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    return sc is not None and sc.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster-wide checkpoint folder (``spark.checkpoint.dir``).

    Only a local session without one gets a private folder; on a cluster an unset
    checkpoint directory is an error, because lineage must be cut on shared storage.
    """
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="terrace-ckpt-"))
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder next to the checkpoint directory (shared storage).

    Used for written intermediate tables and round-trip outputs; never a machine-local
    temporary folder unless the session itself is local.
    """
    # The SparkContext's checkpoint folder is per application (it appends an id to
    # spark.checkpoint.dir), so everything one application writes stays together.
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/terrace-{name}/{uuid.uuid4().hex}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    return path
