"""Landed pages as a stream of candidate calls.

Normalisation keeps no state, so the batch expressions run unchanged.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tracewaste.operators.normalize import normalize_records
from tracewaste.schemas import PAGES
from tracewaste.session import prepare_session
from tracewaste.sources.pages import parse_pages, page_ordinal, unwrap_records


def stream_page_files(spark: SparkSession, path: str) -> DataFrame:
    """New page files of a folder, one response per file."""
    prepare_session(spark)
    files = spark.readStream.format("text").option("wholetext", True).load(path)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1)
    return files.select(page_ordinal(name.try_cast("bigint")), F.col("value").alias("body"))


def stream_page_table(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a page table, by default all at once."""
    prepare_session(spark)
    reader = spark.readStream.schema(PAGES)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def stream_candidates(pages: DataFrame, provider: str, ingest_time: datetime) -> DataFrame:
    """Candidate calls of a stream of pages."""
    return normalize_records(
        unwrap_records(parse_pages(pages, provider), provider), provider, ingest_time
    )


def write_candidates(candidates: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the candidates to a parquet table, taking all pages that are there now."""
    return (
        candidates.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
