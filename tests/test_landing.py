import json
import random

from helpers import INGEST, pages_of, utc

from tracewaste import analyze
from tracewaste.sources.landing import file_pages, read_filed_pages

FIELDS = {"helicone": "created_at", "langfuse": "timestamp", "langsmith": "start_time"}


def bodies(provider, n=40, seed=1):
    """Pages of a month, some empty, broken or with records without a time."""
    rng = random.Random(seed)
    out = []
    for day in range(1, n + 1):
        rows = []
        for i in range(rng.choice([0, 1, 3])):
            row = {"id": f"{day}-{i}", "run_type": "llm", "observations": [{"type": "GENERATION"}]}
            if rng.random() > 0.15:
                row[FIELDS[provider]] = f"2026-04-{1 + day % 28:02d}T{rng.randrange(24):02d}:00:00.5Z"
            rows.append(row)
        body = {"helicone": rows, "langfuse": {"data": rows}, "langsmith": {"runs": rows}}[provider]
        out.append("broken" if rng.random() < 0.05 else json.dumps(body))
    return out


def test_bounds_on_filed_pages_keep_the_same_records(spark, tmp_path):
    for provider in FIELDS:
        pages = pages_of(spark, *bodies(provider))
        path = str(tmp_path / provider)
        file_pages(pages.filter("page_idx < 20"), provider, path)
        file_pages(pages.filter("page_idx >= 20"), provider, path)
        since, until = utc(2026, 4, 10, 12, 0, 0, 500_000), utc(2026, 4, 20, 3, 0, 0, 700_000)
        bounds = {"since": since} if provider == "helicone" else {"since": since, "until": until}
        found = read_filed_pages(spark, path, **bounds)
        assert found.count() < pages.count()

        def calls(some, provider=provider, bounds=bounds):
            result = analyze(spark, some, provider, "demo", dry_run=True, ingest_time=INGEST, **bounds)
            return sorted((r["src_seq"], r["session_id"]) for r in result.calls.select("src_seq", "session_id").collect())

        assert calls(found) == calls(pages) != []
    assert read_filed_pages(spark, path).count() == pages.count()


def test_a_bound_prunes_folders_and_row_groups(spark, tmp_path):
    path = str(tmp_path / "filed")
    file_pages(pages_of(spark, *bodies("helicone")), "helicone", path)
    found = read_filed_pages(spark, path, utc(2026, 4, 20))
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    (folders,) = (x for x in plan.splitlines() if x.startswith("PartitionFilters"))
    (groups,) = (x for x in plan.splitlines() if x.startswith("PushedFilters"))
    assert "dt" in folders and ">= 2026-04-20" in folders
    assert "GreaterThanOrEqual(newest_us" in groups
