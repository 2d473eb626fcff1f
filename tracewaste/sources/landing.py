"""Landed pages filed by the time of their records, so that a time bound leaves files unread.

A provider's API takes the bounds and answers with the records inside. Landed pages carry their records'
times inside the JSON, where no scan can see them; filing reads each page once, when it lands, and puts
its oldest and newest record time beside it and the newest one's date into the folder name.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewaste.functions.times import iso_text, parse_iso, to_utc
from tracewaste.functions.values import at
from tracewaste.sources.pages import parse_pages
from tracewaste.sources.windows import TIME_FIELD

# Times are whole microseconds, of which Parquet keeps ranges that a scan can skip by.
FILED = "page_idx BIGINT, body STRING, oldest_us BIGINT, newest_us BIGINT, dt DATE"
# Pages that no bound may leave out: with a record without a readable time, without an ordinal, unreadable.
OPEN_DATE = "9999-12-31"
OPEN_US = 2**62
SECOND_US = 1_000_000


def filed_pages(pages: DataFrame, provider: str) -> DataFrame:
    """Pages with the time of their oldest and newest record and the date ``dt`` they are filed under."""
    parsed = parse_pages(pages, provider, keep_body=True)
    field = f"$.{TIME_FIELD[provider]}"
    times = F.transform("items", lambda rec: parse_iso(iso_text(at(rec, field))))
    is_open = F.col("page_idx").isNull() | (F.size("times") == 0) | F.exists("times", lambda t: t.isNull())
    newest = F.array_max("times")
    return parsed.withColumn("times", times).select(
        "page_idx",
        "body",
        F.when(is_open, F.lit(-OPEN_US)).otherwise(F.unix_micros(F.array_min("times"))).alias("oldest_us"),
        F.when(is_open, F.lit(OPEN_US)).otherwise(F.unix_micros(newest)).alias("newest_us"),
        F.when(is_open, F.lit(OPEN_DATE).cast("date")).otherwise(F.to_date(newest)).alias("dt"),
    )


def file_pages(pages: DataFrame, provider: str, path: str) -> None:
    """Append pages to the filed table at ``path``; a day of any size is spread over as many files as it needs."""
    filed = filed_pages(pages, provider)
    filed.repartitionByRange("dt", "page_idx").write.mode("append").partitionBy("dt").parquet(path)


def read_filed_pages(
    spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """``(page_idx, body)`` of the filed pages that may hold records inside the bounds.

    The date prunes folders, the times skip row groups. Pages that hold no record inside are not read, so
    they count as not fetched; the bounds still apply to the records, as they do for any pages.
    """
    pages = spark.read.schema(FILED).parquet(path)
    # Two of the formats compare whole seconds.
    if since is not None:
        moment = to_utc(since).replace(microsecond=0)
        pages = pages.filter((F.col("dt") >= F.lit(moment.date())) & (F.col("newest_us") >= _micros(moment)))
    if until is not None:
        pages = pages.filter(F.col("oldest_us") < _micros(to_utc(until).replace(microsecond=0)) + SECOND_US)
    return pages.select("page_idx", "body")


def _micros(moment: datetime) -> int:
    return int(moment.timestamp()) * SECOND_US
