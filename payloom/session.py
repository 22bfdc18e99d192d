"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # call-site capture costs milliseconds for each Column of a wide projection
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "payloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    A folder of this machine is used only when the setting is absent and the master
    is local, as in tests.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="payloom-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Store a frame in the work folder and read it back: it is computed once."""
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def compiled_in_pieces(df: DataFrame) -> DataFrame:
    """The frame, in a session that keeps generated methods small enough to be compiled.

    The JVM never compiles a method above 8 000 bytes.  Spark fuses the expressions of a text
    into longer ones; above this limit it runs them operator by operator, in small methods.
    """
    df.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return df
