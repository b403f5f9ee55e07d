"""Session building and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tallyspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans expect. Settings of a running session are kept."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; only where none is set (tests, one machine) a temporary one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    named = named or tempfile.mkdtemp(prefix="tallyspark-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows of df, written once to the shared checkpoint folder, so that no later loss of an executor recomputes them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """The rows of df over as many partitions as there are cores or shuffle partitions: few bytes whose work per row is heavy, which would else be joined in one task."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
