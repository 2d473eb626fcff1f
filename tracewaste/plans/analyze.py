"""Landed pages to events, summary and delivery batches."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewaste.operators.catalog import synthetic_catalog
from tracewaste.operators.chunks import CHUNK_SIZE, delivery_chunks
from tracewaste.operators.normalize import calls_of, normalize_records, rejected_of
from tracewaste.operators.rules import Rule
from tracewaste.operators.sessions import session_count, session_rank
from tracewaste.plans.replay import replay
from tracewaste.plans.summary import summary_row
from tracewaste.session import prepare_session, write_table
from tracewaste.sources.pages import (
    PAGE_SIZE,
    check_provider,
    interleaved,
    is_last_page,
    parse_pages,
    sum_responses,
    unwrap_records,
    without_repeats,
)
from tracewaste.sources.windows import top_level_runs, within_bounds


@dataclass(frozen=True)
class Source:
    """Pages of one provider and the bounds to import them with."""

    pages: DataFrame
    provider: str
    since: datetime | None = None
    until: datetime | None = None
    page_size: int = PAGE_SIZE
    stop_at_last_page: bool = False
    top_level_only: bool = False
    drop_repeated_pages: bool = False


@dataclass(frozen=True)
class Result:
    """What an import found; ``pages_beyond_stop`` is 0 unless a source was cut at its last page."""

    calls: DataFrame
    rejected: DataFrame
    events: DataFrame
    summary: DataFrame
    payloads: DataFrame | None
    pages_beyond_stop: int = 0


def _parsed_pages(source: Source) -> DataFrame:
    pages = without_repeats(source.pages) if source.drop_repeated_pages else source.pages
    return parse_pages(pages, check_provider(source.provider))


def _bounded_records(source: Source, parsed: DataFrame) -> DataFrame:
    records = unwrap_records(parsed, source.provider)
    records = within_bounds(records, source.provider, source.since, source.until)
    return top_level_runs(records) if source.top_level_only else records


def import_source(source: Source, ingest_time: datetime) -> tuple[DataFrame, dict[str, int]]:
    """Written candidate calls of one source, and its page and record counts.

    The counts and the stop page are observed while the candidates are written, so
    the pages are parsed once. Every landed page counts, unless the source is to be
    cut at the page where a paging client would have stopped: then the written table
    is filtered, and only the records of the pages before are counted again.
    """
    page_facts, record_facts = Observation(), Observation()
    placed = F.col("page_idx").isNotNull()
    parsed = _parsed_pages(source).withColumn(
        "is_stop", is_last_page(source.provider, source.page_size)
    )
    observed = parsed.observe(
        page_facts,
        F.min(F.when(F.col("is_stop"), F.col("page_idx"))).alias("stop_page"),
        F.max("page_idx").alias("last_page"),
        F.count(F.when(placed & (F.col("n_rows") > 0), 1)).alias("pages_fetched"),
    )
    records = _bounded_records(source, observed).observe(
        record_facts, F.count(F.when(placed, 1)).alias("fetched_traces")
    )
    table = write_table(
        normalize_records(records, source.provider, ingest_time), f"{source.provider}-candidates"
    )
    seen = page_facts.get
    counts = {
        "fetched_traces": record_facts.get["fetched_traces"],
        "pages_fetched": seen["pages_fetched"],
        "pages_beyond_stop": 0,
    }
    stop = seen["stop_page"]
    if not source.stop_at_last_page or stop is None or seen["last_page"] <= stop:
        return table, counts
    kept = parsed.filter(F.col("page_idx") <= stop)
    pages = kept.agg(F.count_if(F.col("n_rows") > 0).alias("n")).first()["n"]
    return table.filter((F.col("page_idx") <= stop) | F.col("page_idx").isNull()), {
        "fetched_traces": _bounded_records(source, kept).count(),
        "pages_fetched": pages,
        "pages_beyond_stop": counts["pages_fetched"] - pages,
    }


def _analyze(
    spark: SparkSession,
    sources: Sequence[Source],
    project: str,
    config: dict[str, Any] | None,
    catalog: DataFrame | None,
    rules: dict[str, Rule] | None,
    dry_run: bool,
    out: str | None,
    chunk_size: int,
    ingest_time: datetime | None,
    run_id: str | None,
    responses: DataFrame | None,
) -> Result:
    if not dry_run and not out:
        raise ValueError("an output path is required when dry_run=False")
    prepare_session(spark)
    moment = ingest_time or datetime.now(timezone.utc)
    tables, counts = [], Counter()
    for number, source in enumerate(sources):
        table, facts = import_source(source, moment)
        counts.update(facts)
        if len(sources) > 1:
            table = table.withColumn("src_seq", interleaved(F.col("src_seq"), len(sources), number))
            beyond = F.when(
                F.col("page_idx").isNotNull() & F.col("src_seq").isNull(), F.lit("page_ordinal_too_large")
            )
            table = table.withColumn("skip_reason", F.coalesce("skip_reason", beyond))
        tables.append(table)
    candidates = reduce(DataFrame.unionByName, tables)
    calls, rejected = calls_of(candidates), rejected_of(candidates)
    prices = synthetic_catalog(spark) if catalog is None else catalog
    events = write_table(replay(calls, prices, project, config, rules), "events")
    payloads = None
    if not dry_run:
        chunks = delivery_chunks(events, session_rank(calls), project, chunk_size)
        payloads = deliver(chunks, out, project, run_id or uuid.uuid4().hex)
    delivered = None if responses is None else sum_responses(responses)
    summary = summary_row(events, session_count(calls), counts, dry_run, delivered)
    return Result(calls, rejected, events, summary, payloads, counts["pages_beyond_stop"])


# A marker's layout. Spark's readers pass over folders that begin with an underscore.
MARKS = "project STRING, run STRING, attempt STRING, n_chunks BIGINT, marked_us BIGINT"
BATCHES = "chunk_id BIGINT, n BIGINT, body STRING, project STRING, run STRING, attempt STRING"
MARK_FOLDER = "_committed"


def _commit(chunks: DataFrame, out: str, project: str, run_id: str, attempt: str, n_chunks: int) -> None:
    """The marker that makes an attempt the run's delivery; written last, beside earlier ones."""
    marked = int(datetime.now(timezone.utc).timestamp() * 1_000_000)
    row = [(project, run_id, attempt, n_chunks, marked)]
    chunks.sparkSession.createDataFrame(row, MARKS).coalesce(1).write.mode("append").json(f"{out}/{MARK_FOLDER}")


def deliver(chunks: DataFrame, out: str, project: str, run_id: str) -> DataFrame:
    """The batches of one run of one project, written under ``out`` and read back.

    Each attempt has a folder of its own, ``out/project=…/run=…/attempt=…``. Its marker follows once all
    its files are there, so a run that is repeated, also with fewer batches or none, replaces its earlier
    delivery at once, and one that fails half-way leaves it standing. Other runs and projects stay.
    """
    attempt, seen = uuid.uuid4().hex, Observation()
    (
        chunks.withColumns({"project": F.lit(project), "run": F.lit(run_id), "attempt": F.lit(attempt)})
        .observe(seen, F.count("*").alias("n"))
        .write.mode("append")
        .partitionBy("project", "run", "attempt")
        .json(out)
    )
    _commit(chunks, out, project, run_id, attempt, seen.get["n"])
    return delivered(chunks.sparkSession, out, project, run_id).select(*chunks.columns)


def delivered(spark: SparkSession, out: str, project: str | None = None, run_id: str | None = None) -> DataFrame:
    """The batches of committed runs: of each run those of its last marked attempt."""
    marks = spark.read.schema(MARKS).json(f"{out}/{MARK_FOLDER}")
    batches = spark.read.schema(BATCHES).json(out)
    for name, value in (("project", project), ("run", run_id)):
        if value is not None:
            marks, batches = marks.filter(F.col(name) == value), batches.filter(F.col(name) == value)
    last = W.partitionBy("project", "run").orderBy(F.desc("marked_us"), F.desc("attempt"))
    current = marks.withColumn("nth", F.row_number().over(last)).filter("nth = 1")
    return batches.join(current.select("project", "run", "attempt"), ["project", "run", "attempt"], "left_semi")


def analyze(
    spark: SparkSession,
    pages: DataFrame,
    provider: str,
    project: str,
    since: datetime | None = None,
    until: datetime | None = None,
    config: dict[str, Any] | None = None,
    catalog: DataFrame | None = None,
    rules: dict[str, Rule] | None = None,
    dry_run: bool = False,
    out: str | None = None,
    chunk_size: int = CHUNK_SIZE,
    ingest_time: datetime | None = None,
    page_size: int = PAGE_SIZE,
    stop_at_last_page: bool = False,
    top_level_only: bool = False,
    drop_repeated_pages: bool = False,
    run_id: str | None = None,
    responses: DataFrame | None = None,
) -> Result:
    """Find wasted spend in one provider's landed pages.

    Without ``catalog`` the synthetic example prices apply. A dry run writes no
    batches; otherwise they go to ``out`` as JSON, partitioned by project, run and attempt;
    repeating a ``run_id`` replaces that run's batches for readers of :func:`delivered`. ``responses`` is a log of
    answers to delivered batches, whose accepted and rejected counts the summary sums.

    Every landed page is read. With ``stop_at_last_page`` the import ends where a
    client with this ``page_size`` would have stopped paging.
    """
    source = Source(
        pages,
        check_provider(provider),
        since,
        until,
        page_size,
        stop_at_last_page,
        top_level_only,
        drop_repeated_pages,
    )
    return _analyze(
        spark,
        [source],
        project,
        config,
        catalog,
        rules,
        dry_run,
        out,
        chunk_size,
        ingest_time,
        run_id,
        responses,
    )


def analyze_many(
    spark: SparkSession,
    sources: Sequence[Source],
    project: str,
    config: dict[str, Any] | None = None,
    catalog: DataFrame | None = None,
    rules: dict[str, Rule] | None = None,
    dry_run: bool = False,
    out: str | None = None,
    chunk_size: int = CHUNK_SIZE,
    ingest_time: datetime | None = None,
    run_id: str | None = None,
    responses: DataFrame | None = None,
) -> Result:
    """Calls of several sources together, through one replay."""
    if not sources:
        raise ValueError("at least one source is required")
    return _analyze(
        spark,
        sources,
        project,
        config,
        catalog,
        rules,
        dry_run,
        out,
        chunk_size,
        ingest_time,
        run_id,
        responses,
    )


def _for_provider(provider: str):
    def run(spark: SparkSession, pages: DataFrame, project: str, **options: Any) -> Result:
        return analyze(spark, pages, provider, project, **options)

    run.__name__ = f"analyze_{provider}"
    run.__doc__ = f":func:`analyze` for {provider} pages."
    return run


analyze_helicone = _for_provider("helicone")
analyze_langfuse = _for_provider("langfuse")
analyze_langsmith = _for_provider("langsmith")
