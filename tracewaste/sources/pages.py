"""Landed API responses: readers, unwrapping to records, and the page ledger.

A page is one API response of one provider, kept as JSON text with its ordinal
``page_idx``. Three landing layouts are read; for large imports prefer the
table or the line layout, since one file per response means many small files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewaste.functions.values import at, elements, is_string, is_truthy, whole_number

PROVIDERS = ("helicone", "langfuse", "langsmith")
PAGE_SIZE = 100

# An arrival ordinal is the page's, then the position in the page, then (for nested formats) that in the
# record, as one number. An array has fewer than 2**31 elements, and any page ordinal has room above.
POSITION_BITS = 31
ORDINAL = "decimal(38,0)"


def check_provider(provider: str) -> str:
    if provider not in PROVIDERS:
        raise ValueError(f"unknown provider {provider!r}; expected one of {', '.join(PROVIDERS)}")
    return provider


def page_ordinal(ordinal: Column) -> Column:
    """A page's ordinal; none if it is missing or negative, which rejects the page's records."""
    return F.when(ordinal >= 0, ordinal).alias("page_idx")


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """One file per response; the last number in the file name is the page ordinal."""
    files = spark.read.text(path, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1)
    return files.select(
        page_ordinal(name.try_cast("bigint")), F.col("value").alias("body")
    )


def read_page_lines(spark: SparkSession, path: str) -> DataFrame:
    """One response per line, as ``{"page_idx": n, "body": {...}}``; splittable at any size.

    ``body`` may be the response itself or its JSON text.
    """
    line = F.try_parse_json("value")
    parsed = spark.read.text(path).select(line.alias("line"))
    body = at(F.col("line"), "$.body")
    return parsed.select(
        page_ordinal(F.try_variant_get("line", "$.page_idx", "bigint")),
        F.when(is_string(body), F.try_variant_get(body, "$", "string"))
        .otherwise(F.to_json(body))
        .alias("body"),
    )


def read_page_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table with the columns ``page_idx`` and ``body``."""
    return spark.read.format(fmt).load(path).select("page_idx", "body")


def _page_elements(provider: str, body: Column) -> Column:
    if provider == "helicone":
        # Either an envelope or a bare list. An envelope without a list holds no records.
        listed = F.coalesce(elements(body, "$.data"), elements(body))
    else:
        listed = elements(body, "$.data" if provider == "langfuse" else "$.runs")
    return F.coalesce(listed, F.expr("CAST(array() AS ARRAY<VARIANT>)"))


def parse_pages(pages: DataFrame, provider: str, keep_body: bool = False) -> DataFrame:
    """Pages with their parsed ``doc``, element array and row count.

    Text that is not JSON becomes a NULL document without rows, not a failed job; a page without an
    ordinal keeps its records, or an empty one, which are rejected with that reason.
    """
    check_provider(provider)
    kept = ["page_idx", "body"] if keep_body else ["page_idx"]
    parsed = pages.select(*kept, F.try_parse_json("body").alias("doc"))
    found = _page_elements(provider, F.col("doc"))
    # A page without an ordinal keeps one empty record at least, so that it is reported.
    lost = F.col("page_idx").isNull() & (F.size("items") == 0)
    return (
        parsed.withColumn("items", found)
        .withColumn("n_rows", F.size("items").cast("bigint"))
        .withColumn("items", F.when(lost, F.expr("array(CAST(NULL AS VARIANT))")).otherwise(F.col("items")))
    )


def is_last_page(provider: str, page_size: int) -> Column:
    """Whether a paging client would stop after this parsed page."""
    doc, n_rows = F.col("doc"), F.col("n_rows")
    short = n_rows < page_size
    if provider == "helicone":
        return short
    if provider == "langfuse":
        # Pages count from one on the wire; the ordinal here keeps that numbering.
        total = F.coalesce(whole_number(at(doc, "$.meta.totalPages")), F.lit(0))
        return short | ((total != 0) & (F.col("page_idx") >= total))
    following = at(doc, "$.cursors.next")
    return (n_rows == 0) | ~(is_string(following) & is_truthy(following))


def page_ledger(parsed: DataFrame, provider: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """``(page_idx, n_rows, is_stop)``: the paging loop's stop conditions as data."""
    return parsed.select(
        "page_idx", "n_rows", is_last_page(provider, page_size).alias("is_stop")
    )


def truncate_pages(parsed: DataFrame, provider: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Keep the pages a paging client would have fetched: up to the first stop page, included."""
    stop = (
        page_ledger(parsed, provider, page_size)
        .filter("is_stop")
        .agg(F.min("page_idx").alias("stop_idx"))
    )
    # One scalar from a global aggregate; no stop page means every page counts.
    return parsed.filter(
        F.col("page_idx") <= F.coalesce(stop.scalar(), F.lit(2**63 - 1))
    )


def arrival_ordinal(page_idx: Column, position: Column) -> Column:
    """Arrival ordinal of an element of a page; what is nested in it follows by its own position."""
    place = page_idx.cast("decimal(19,0)") * 2**POSITION_BITS + position
    return (place * 2**POSITION_BITS).cast(ORDINAL)


def nested_ordinal(record: Column, position: Column) -> Column:
    """Arrival ordinal of an element nested in the record with ordinal ``record``."""
    return (record + position).cast(ORDINAL)


def interleaved(ordinal: Column, sources: int, number: int) -> Column:
    """Ordinals of the ``number``-th of several sources, unique across them and in each source's own order.

    Two sources have room for any page ordinal; for many, one beyond the layout's 38 digits is none.
    """
    scaled = F.try_multiply(ordinal, F.lit(sources).cast("decimal(10,0)"))
    return F.try_add(scaled, F.lit(number).cast("decimal(10,0)")).cast(ORDINAL)


def unwrap_records(parsed: DataFrame, provider: str) -> DataFrame:
    """One row per page element, with its arrival ordinal.

    The element arrays are exploded by position, so no sort or shuffle is needed
    to number the rows. The outer form keeps Spark from adding a size check below
    the parse, which would parse every page a second time.
    """
    exploded = parsed.select("page_idx", F.posexplode_outer("items").alias("pos", "rec")).filter("pos IS NOT NULL")
    return exploded.select(
        F.lit(provider).alias("provider_src"),
        "page_idx",
        arrival_ordinal(F.col("page_idx"), F.col("pos")).alias("src_seq"),
        "rec",
    )


def repeated_pages(pages: DataFrame) -> DataFrame:
    """(page_idx, n) of the ordinals that several landed pages carry."""
    return (
        pages.filter("page_idx IS NOT NULL")
        .groupBy("page_idx")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )


def without_repeats(pages: DataFrame) -> DataFrame:
    """One page of each ordinal, the first by the digest of its text; pages without one all stay."""
    first = W.partitionBy("page_idx").orderBy(F.sha2(F.coalesce("body", F.lit("")), 256))
    ranked = pages.filter("page_idx IS NOT NULL").withColumn("nth", F.row_number().over(first))
    return ranked.filter("nth = 1").drop("nth").unionByName(pages.filter("page_idx IS NULL"))


def sum_responses(responses: DataFrame, column: str = "body") -> DataFrame:
    """Accepted and rejected totals over a log of delivery responses; missing counts are 0."""
    doc = F.try_parse_json(column)

    def total(field: str) -> Column:
        counted = F.coalesce(whole_number(at(F.col("doc"), f"$.{field}")), F.lit(0))
        return F.coalesce(F.sum(counted), F.lit(0)).alias(field)

    return responses.select(doc.alias("doc")).agg(total("accepted"), total("rejected"))

