"""Uniform shuffle of rows into shards of exact sizes, by a hypergeometric communication matrix.

Of a uniformly random arrangement of all rows in shards, only one thing links the source partitions:
how many rows each sends to each shard. That matrix has a multivariate hypergeometric law and is drawn
first, down a tree of ``FAN`` children a node over the partitions. Each partition then permutes its rows
and deals them out by its row of the matrix, and each shard permutes what it has received. Shard sizes
are exact, and no task sees more than one source partition or one bucket of a shard.

All of it is DataFrame expressions. Random numbers are hashes of a seed and a row's number, so a task
that is run again decides the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewaste.llm.tables import binary_text, written

SHARDS = 24
FAN = 64
BUCKET_ROWS = 4_096
SEED = 20_011


def _uniform(*key) -> Column:
    """A number in [0, 1) from a key."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") * 2.0**-53


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(good: Column, total: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` rows taken from ``total`` are among the ``good`` ones, for a uniform ``u``.

    Inverts the distribution outwards from its mode. Weights relative to the mode's follow from ratios
    of neighbours; beyond 14 standard deviations and 30 counts they are below a double's precision.
    """
    k, t, n = (c.cast("double") for c in (good, total, draws))
    least = F.greatest(F.lit(0).cast("long"), draws + good - total)
    most = F.least(draws, good)
    centre = F.floor((n + 1) * (k + 1) / (t + 2)).cast("long")
    spread = F.sqrt(n * (k / t) * F.greatest(F.lit(0.0), 1 - k / t) * (t - n) / F.greatest(F.lit(1.0), t - 1))
    bounds = F.struct(
        least.alias("least"), most.alias("most"), centre.alias("centre"), F.ceil(spread * 14 + 30).alias("reach")
    )

    def pick(b: Column) -> Column:
        mode = F.greatest(b["least"], F.least(b["most"], b["centre"]))
        high = F.least(b["most"], mode + b["reach"])
        low = F.greatest(b["least"], mode - b["reach"])
        ups = F.sequence(mode, high)
        downs = F.when(mode > low, F.sequence(mode, low, F.lit(-1).cast("long"))).otherwise(F.array(mode))

        def grow(x):  # weight of x + 1 over weight of x
            return (k - x) * (n - x) / ((x + 1) * (t - k - n + x + 1))

        def shrink(x):  # weight of x - 1 over weight of x
            return x * (t - k - n + x) / ((k - x + 1) * (n - x + 1))

        def total_of(values, ratio):
            start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
            return F.aggregate(
                values,
                start,
                lambda s, x: F.struct((s["w"] * ratio(x)).alias("w"), (s["sum"] + s["w"]).alias("sum")),
            )["sum"]

        def find(values, ratio, left):
            start = F.struct(F.lit(1.0).alias("w"), left.alias("left"), F.lit(-1).cast("long").alias("at"))
            return F.aggregate(
                values,
                start,
                lambda s, x: F.struct(
                    (s["w"] * ratio(x)).alias("w"),
                    (s["left"] - s["w"]).alias("left"),
                    F.when((s["at"] < 0) & (s["left"] < s["w"]), x).otherwise(s["at"]).alias("at"),
                ),
            )["at"]

        def choose(w: Column) -> Column:  # the mode counts among the ups, so the downs start after it
            left = u * (w["up"] + w["down"] - 1)
            return F.when(left < w["up"], find(ups, grow, left)).otherwise(find(downs, shrink, left - w["up"] + 1))

        weights = F.struct(total_of(ups, grow).alias("up"), total_of(downs, shrink).alias("down"))
        return F.greatest(_let(weights, choose), low)

    return F.when(least == most, least).otherwise(_let(bounds, pick))


def _row_of(need: Column, pool: Column, *key) -> Column:
    """A multivariate hypergeometric vector: ``need`` rows taken from shards holding ``pool`` places."""
    start = F.struct(
        need.alias("need"),
        F.aggregate(pool, F.lit(0).cast("long"), lambda a, x: a + x).alias("left"),
        F.array().cast("array<bigint>").alias("row"),
    )

    def step(s: Column, j: Column) -> Column:
        places = F.element_at(pool, j + 1)
        drawn = hypergeometric(places, s["left"], s["need"], _uniform(F.lit(SEED), *key, j))
        return _let(
            drawn,
            lambda x: F.struct(
                (s["need"] - x).alias("need"),
                (s["left"] - places).alias("left"),
                F.concat(s["row"], F.array(x)).alias("row"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(pool) - 1), start, step)["row"]


def _split(parents: DataFrame, children: DataFrame, level: int) -> DataFrame:
    """(node, places) of all children: each draws its row, one after the other, from what its parent has left."""
    grouped = children.groupBy(F.floor(F.col("node") / FAN).cast("long").alias("parent")).agg(
        F.sort_array(F.collect_list(F.struct("node", "n"))).alias("family")
    )
    joined = grouped.join(parents.select(F.col("node").alias("parent"), "places"), "parent")
    start = F.struct(
        F.col("places").alias("rest"),
        F.array().cast("array<struct<node:bigint,places:array<bigint>>>").alias("done"),
    )

    def step(s: Column, child: Column) -> Column:
        drawn = _row_of(child["n"], s["rest"], F.lit(level), child["node"])
        return _let(
            drawn,
            lambda row: F.struct(
                F.zip_with(s["rest"], row, lambda a, b: a - b).alias("rest"),
                F.concat(s["done"], F.array(F.struct(child["node"].alias("node"), row.alias("places")))).alias("done"),
            ),
        )

    return joined.select(F.inline(F.aggregate("family", start, step)["done"]))


def communication_matrix(counts: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(node, places): how many rows of source partition ``node`` go to each shard.

    ``counts`` has one row (node, n) for each source partition, numbered from 0. Rows sum to n, columns
    to the shard sizes, which differ by one at most.
    """
    total = counts.agg(F.sum("n").alias("n"), F.max("node").alias("last")).first()
    rows, last = total["n"] or 0, total["last"] or 0
    sizes = [rows // shards + (j < rows % shards) for j in range(shards)]
    levels = [counts]
    while last > 0:
        last //= FAN
        levels.append(
            levels[-1].groupBy(F.floor(F.col("node") / FAN).cast("long").alias("node")).agg(F.sum("n").alias("n"))
        )
    matrix = counts.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("node"), F.array(*(F.lit(x).cast("long") for x in sizes)).alias("places")
    )
    for level in range(len(levels) - 2, -1, -1):
        matrix = _split(matrix, levels[level], level)
    return matrix


def shard_rows(rows: DataFrame, shards: int = SHARDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: a uniform shuffle into shards whose sizes differ by one at most.

    Slots run without gaps from 0 in each shard. Repeated rows and any nulls are rows like others; an
    empty table stays empty. Columns named shard, slot or _part, _row, _key, _bucket must not exist.
    Rows are written once to the shared folder, numbered by source partition and position.
    """
    part, key = F.spark_partition_id().cast("long"), F.xxhash64(F.lit(SEED), F.lit("deal"), "_part", "_row")
    source = written(
        rows.select("*", part.alias("_part"), F.monotonically_increasing_id().alias("_row")), "shard-source"
    )
    counts = source.groupBy(F.col("_part").alias("node")).agg(F.count("*").alias("n"))
    ends = F.aggregate(
        "places",
        F.array().cast("array<bigint>"),
        lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("long")) + x)),
    )
    matrix = communication_matrix(counts, shards).select(F.col("node").alias("_part"), ends.alias("_ends"))
    local = Window.partitionBy("_part").orderBy(key, "_row")
    total = source.count()
    buckets = max(1, -(-total // (shards * bucket_rows)))
    dealt = (
        source.withColumn("_rank", F.row_number().over(local) - 1)
        .join(matrix, "_part")
        .withColumn("shard", F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))).cast("int"))
        .withColumn("_key", F.xxhash64(F.lit(SEED), F.lit("place"), "_part", "_row"))
        .withColumn(
            "_bucket",
            F.floor(_uniform(F.lit(SEED), F.lit("place"), F.col("_part"), F.col("_row")) * buckets).cast("long"),
        )
        .drop("_ends", "_rank")
    )
    dealt = written(dealt, "shard-dealt")
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "_bucket")
        .count()
        .select("shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy("_key", "_part", "_row")
    return (
        dealt.withColumn("_place", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "_bucket"])
        .withColumn("slot", (F.col("_offset") + F.col("_place")).cast("long"))
        .drop("_part", "_row", "_key", "_bucket", "_place", "_offset")
    )


def sharded_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every document by the law `rows`; sizes are UTF-8 bytes plus 8, none for a null text."""
    text = binary_text(F.col("text"))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return shard_rows(slim, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
