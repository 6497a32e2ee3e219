"""Session settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings the operators depend on for correct results.
REQUIRED_CONF = {
    # All event-time logic (windows, ISO text, date partitions) is UTC.
    "spark.sql.session.timeZone": "UTC",
    # JSON with a repeated key keeps the last value instead of failing to parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A map built with a repeated key keeps the last value too (labelmap and label overlays).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Runtime re-planning: coalesce small shuffles, split skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings in ``REQUIRED_CONF`` to an existing session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "celltide", checkpoint_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the required settings.

    ``spark.checkpoint.dir`` comes from the cluster's configuration or from
    ``checkpoint_dir``; operations that need the shared folder fail without it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return configure(builder.getOrCreate())
