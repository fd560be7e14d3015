"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps dates stable; a JSON object that repeats a key keeps the last value;
# AQE re-plans joins and partition counts from the sizes it sees at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "broadsheet", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder below the shared storage the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        raise ValueError(f"set {CHECKPOINT_DIR} to storage that every executor can reach, or pass a path")
    return f"{root.rstrip('/')}/{name}"
