"""Temporal list join: every capture against the list entries in force on the day it was fetched.

Dated list entries become validity intervals. A capture is looked up by its address, its host and each
parent domain. A verdict depends only on (key, day), so captures are first reduced to their distinct
keys and days: the interval join sees a host at most once a day however often it was fetched, and the
verdicts go back over equality joins, which adaptive execution may split where a host is frequent.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KINDS = ("url", "host", "domain")


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute address, without user and port; null if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.lower(host))


def address_of(url: Column) -> Column:
    """Host and the rest of the address up to the fragment; scheme, user and port do not matter."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.concat(host_of(url), rest)


def domains_of(host: Column) -> Column:
    """The host and each parent with two labels at least."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), count - 1)),
        lambda i: F.array_join(F.slice(labels, i, count), "."),
    )


def list_intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, value, starts, ends): the days, from ``starts`` to before ``ends``, an entry is in force.

    ``entries`` has list, kind (url, host or domain), value, listed (added or removed) and since (a date).
    Several entries for one day count as added if any is; repeated additions or removals change nothing;
    a null in any column voids the entry. A value has at most one row a day, so no window is large.
    """
    daily = (
        entries.select("list", "kind", "value", "listed", F.col("since").cast("date").alias("since"))
        .dropna()
        .groupBy("list", "kind", "value", "since")
        .agg(F.max("listed").alias("listed"))
    )
    history = Window.partitionBy("list", "kind", "value").orderBy("since")
    changes = daily.withColumn("before", F.lag("listed", 1, False).over(history)).filter(
        F.col("before") != F.col("listed")
    )
    return (
        changes.withColumn("ends", F.lead("since").over(history))
        .filter("listed")
        .select("list", "kind", "value", F.col("since").alias("starts"), "ends")
    )


def lists_in_force(keys: DataFrame, intervals: DataFrame) -> DataFrame:
    """(kind, value, day, lists) for those of the distinct (kind, value, day) that some list holds."""
    in_force = (F.col("day") >= F.col("starts")) & (F.col("ends").isNull() | (F.col("day") < F.col("ends")))
    return (
        keys.join(intervals.withColumnsRenamed({"kind": "i_kind", "value": "i_value"}),
                  (F.col("kind") == F.col("i_kind")) & (F.col("value") == F.col("i_value")) & in_force)
        .groupBy("kind", "value", "day")
        .agg(F.collect_set("list").alias("lists"))
    )


def temporal_list_join(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, url, fetched_on, host, lists, blocked) of every capture.

    ``captures`` has page_id, url and fetched_on (a date). ``lists`` names, sorted and joined by commas,
    the lists with an entry in force that day for the address, the host or one of its domains; none gives
    an empty text and ``blocked`` false, and so does a null or unreadable url or a null date. Repeated
    captures are answered each. Further columns are left out.
    """
    seen = captures.select(
        "page_id",
        "url",
        F.col("fetched_on").cast("date").alias("fetched_on"),
        host_of(F.col("url")).alias("host"),
        address_of(F.col("url")).alias("address"),
    )
    intervals = list_intervals(entries)
    hosts = seen.select("host", F.col("fetched_on").alias("day")).dropna().distinct()
    addresses = seen.select("address", F.col("fetched_on").alias("day")).dropna().distinct()
    host_keys = hosts.select(
        "host",
        "day",
        F.explode(
            F.concat(
                F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("value"))),
                F.transform(
                    domains_of(F.col("host")), lambda d: F.struct(F.lit("domain").alias("kind"), d.alias("value"))
                ),
            )
        ).alias("key"),
    ).select("host", "day", "key.kind", "key.value")
    host_lists = (
        host_keys.join(
            lists_in_force(host_keys.select("kind", "value", "day").distinct(), intervals), ["kind", "value", "day"]
        )
        .groupBy("host", "day")
        .agg(F.array_distinct(F.flatten(F.collect_set("lists"))).alias("host_lists"))
        .withColumnsRenamed({"host": "h_host", "day": "h_day"})
    )
    address_lists = lists_in_force(
        addresses.select(F.lit("url").alias("kind"), F.col("address").alias("value"), "day"), intervals
    ).select(F.col("value").alias("a_address"), F.col("day").alias("a_day"), F.col("lists").alias("address_lists"))
    none = F.array().cast("array<string>")
    lists = F.sort_array(F.array_union(F.coalesce("host_lists", none), F.coalesce("address_lists", none)))
    return (
        seen.join(
            host_lists, (F.col("host") == F.col("h_host")) & (F.col("fetched_on") == F.col("h_day")), "left"
        )
        .join(
            address_lists,
            (F.col("address") == F.col("a_address")) & (F.col("fetched_on") == F.col("a_day")),
            "left",
        )
        .select(
            "page_id",
            "url",
            "fetched_on",
            "host",
            F.array_join(lists, ",").alias("lists"),
            (F.size(lists) > 0).alias("blocked"),
        )
    )
