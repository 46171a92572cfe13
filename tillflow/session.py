"""Session settings for local runs and the ones the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillflow.functions.clock import use_utc

# Bytes of a method above which the JVM's compiler leaves it alone.
COMPILED_BYTES = 8000


def prepare(spark: SparkSession) -> SparkSession:
    """What the jobs rely on, in any session: UTC, and no code that stays interpreted.

    Whole-stage code puts all rules of a row into one method; above the limit
    it is given up for operators whose expressions are split into methods.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))
    return use_utc(spark)


def local_session(cpus: int | str = "*", app: str = "tillflow", memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and measurements.

    On a cluster the session is given; partition counts are then left to
    adaptive execution and to the settings of that cluster.
    """
    cores = str(cpus)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.stopTimeout", "60s")
        .getOrCreate()
    )
