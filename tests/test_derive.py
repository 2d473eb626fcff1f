"""What is derived when a consumer names its columns."""

import pytest
from helpers import INGEST
from pyspark.sql import functions as F

from tracewaste.operators.derive import derived, inputs_of, paths
from tracewaste.operators.normalize import candidate_columns, normalize_records
from tracewaste.schemas import RECORDS


def test_only_what_the_wanted_need(spark):
    steps = [
        paths("v", {"a": "$.a", "b": "$.b"}) | {"c": lambda v: F.lit(3)},
        {"d": lambda a: F.concat(a.cast("string"), F.lit("!")), "e": lambda b: F.sha2(b.cast("string"), 256)},
        # A column may be made of its own earlier value.
        {"d": lambda d, kept: F.concat(d, kept)},
    ]
    df = spark.sql("""SELECT parse_json('{"a":1,"b":2}') AS v, 'k' AS kept, 'other' AS unread""")
    assert inputs_of(steps, ["d"]) == {"v", "kept"}
    found = derived(df, steps, ["d", "kept"])
    assert [tuple(r) for r in found.select("d", "kept").collect()] == [("1!k", "k")]
    assert sorted(found.columns) == ["d", "kept"]
    assert "sha2" not in found._jdf.queryExecution().optimizedPlan().toString()


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def record(spark):
    return spark.createDataFrame([], RECORDS.replace("rec VARIANT", "json STRING")).select(
        "provider_src", "page_idx", "src_seq", F.try_parse_json("json").alias("rec")
    )


@pytest.mark.parametrize("provider", ["helicone", "langfuse", "langsmith"])
def test_a_session_needs_no_request_hash_or_time(spark, provider):
    whole = plan_of(normalize_records(record(spark), provider, INGEST))
    asked = normalize_records(record(spark), provider, INGEST, ["provider_src", "session_id"])
    assert asked.columns == ["provider_src", "session_id", "skip_reason"]
    some = plan_of(asked)
    assert "to_variant_object" in whole and "to_variant_object" not in some
    assert "sha2" not in some and "raw_request" not in some and "t_start" not in some and "t_created" not in some
    # A Helicone record with an unreadable number is no call, so its numbers are read for any column.
    share = 0.8 if provider == "helicone" else 0.5
    assert some.count("try_variant_get") < whole.count("try_variant_get") * share


@pytest.mark.parametrize("provider", ["helicone", "langfuse", "langsmith"])
def test_one_column_at_a_time_is_the_whole(spark, provider):
    texts = [
        '{"id":"a","session_id":"s","provider":"OpenAI","model":"gpt-4o","run_type":"llm","prompt_tokens":3,'
        '"created_at":"2024-02-03T00:00:00Z","start_time":"2024-02-03T00:00:00Z","prompt":"p","observations":'
        '[{"type":"GENERATION","id":"o","model":"m","usage":{"input":4,"unit":"TOKENS"},"input":"x"}, 5]}',
        '{"prompt_tokens":"many","run_type":"llm","observations":"none"}',
        "[1]",
        "null",
    ]
    rows = [(provider, page, page * 10, text) for page, text in enumerate(texts)] + [(provider, None, None, texts[0])]
    given = spark.createDataFrame(rows, "provider_src string, page_idx long, src_seq long, json string").select(
        "provider_src", "page_idx", F.col("src_seq").cast("decimal(38,0)").alias("src_seq"),
        F.parse_json("json").alias("rec"),
    )
    whole = normalize_records(given, provider, INGEST)
    shown = {n: F.to_json(F.struct(n)).alias(n) for n in candidate_columns()}
    wanted = whole.select(*shown.values()).collect()
    for name in candidate_columns():
        one = normalize_records(given, provider, INGEST, [name])
        assert sorted(str(r[0]) for r in one.select(shown[name]).collect()) == sorted(str(r[name]) for r in wanted), name


def test_an_unknown_column_is_named(spark):
    with pytest.raises(ValueError, match="nothing"):
        normalize_records(record(spark), "helicone", INGEST, ["nothing"])
