"""Session settings the engine relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SESSION_SETTINGS = {
    # All timestamps are UTC; formatting functions follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of voiding the record.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings; cluster sizing is left to the session's owner."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    A cluster names it in ``spark.checkpoint.dir``. Only a single-machine
    session (tests, bench) may fall back to a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="tracewaste-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Every later reader prunes columns of the written copy instead of deriving
    the rows again, and a lost executor costs a re-read only.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_rows(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """:func:`write_table`, and how many rows were written, counted on the way."""
    seen = Observation()
    table = write_table(df.observe(seen, F.count("*").alias("n")), name)
    return table, seen.get["n"]
