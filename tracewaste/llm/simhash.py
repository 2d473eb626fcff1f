"""Near-duplicates by SimHash fingerprints, linked by meeting in the middle of their balls.

Two fingerprints that differ in at most two bits have a variant within one bit of both. To reach three
bits, the 64 bits are cut into ``PARTS`` parts and each is masked in turn: a pair with three differing
bits has one of them in some part, and without that part it differs in two at most. So every
fingerprint emits, for each masked part, itself and all variants within one bit; two fingerprints that
may link meet on a variant, and a comparison of all 64 bits decides.

What meets on a variant is not paired off: a walk over the group emits a spanning tree of its links.
Equal texts share a fingerprint and are reduced to one before anything is emitted. Components come from
alternating stars on the links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewaste.llm.tables import appended, binary_text, by_bytes, give_back, written

RADIUS = 3
PARTS = 4
SHINGLE = 3
SEED = 42
#: Sorted rows that are searched for groups at a time; a group is never cut.
RUN_ROWS = 500_000

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit majority of the hashes of all word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)],
        np.uint64,
    )
    octets = hashes.view(np.uint8).reshape(-1, 8)
    votes = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches):
    for batch in batches:
        for at, n in by_bytes(batch.column(1)):
            prints = np.array([fingerprint(t) for t in batch.column(1).slice(at, n).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, n), pa.array(prints.view(np.int64))], names=["doc_id", "fp"]
            )
    give_back()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every document, written once; fp is the fingerprint as a signed long."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text(F.col("text")).alias("text"))
    return written(slim.mapInArrow(_fingerprints, "doc_id long, fp long"), "simhash-prints")


def variants(prints: np.ndarray, part: int) -> np.ndarray:
    """(print, variant): each print without one part of its bits, and that with one other bit flipped.

    The masked part holds the part's number, so that the parts' variants rarely mix; where they do, the
    comparison of all bits decides as ever.
    """
    width = 64 // PARTS
    mask = np.uint64(((1 << width) - 1) << (part * width))
    bits = [b for b in range(64) if not part * width <= b < (part + 1) * width]
    flips = np.array([0, *(1 << b for b in bits)], np.uint64)
    base = (prints & ~mask) | np.uint64((part + 1) << (part * width))
    return base[:, None] ^ flips[None, :]


def _emit(batches):
    for batch in batches:
        signed = batch.column(0).to_numpy(zero_copy_only=False)
        for part in range(PARTS):
            found = variants(signed.view(np.uint64), part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.reshape(-1).view(np.int64)), pa.array(np.repeat(signed, found.shape[1]))],
                names=["variant", "fp"],
            )


def spanning_links(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within a group of distinct prints, as two index arrays."""
    left = np.arange(len(prints))
    heads, tails = [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            head = front.pop()
            near = np.bitwise_count(prints[left] ^ prints[head]) <= RADIUS
            if near.any():
                front.extend(left[near].tolist())
                heads.append(np.full(np.count_nonzero(near), head))
                tails.append(left[near])
                left = left[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(heads), np.concatenate(tails)) if heads else (none, none)


def _link(batches):
    """Links within each run of equal variants of sorted rows."""

    def links(variant, prints):
        new = np.concatenate([[True], (variant[1:] != variant[:-1]) | (prints[1:] != prints[:-1])])
        variant, prints = variant[new], prints[new]
        edge = np.flatnonzero(np.concatenate([[True], variant[1:] != variant[:-1], [True]]))
        starts, sizes = edge[:-1], np.diff(edge)
        pairs = starts[sizes == 2]
        near = pairs[np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= RADIUS]
        heads, tails = [prints[near]], [prints[near + 1]]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            group = prints[start : start + size]
            a, b = spanning_links(group)
            heads.append(group[a])
            tails.append(group[b])
        a, b = np.concatenate(heads).view(np.int64), np.concatenate(tails).view(np.int64)
        both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])

    held, size = [], 0
    for batch in batches:
        held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
        size += batch.num_rows
        if size >= RUN_ROWS:
            variant, prints = (np.concatenate(x) for x in zip(*held, strict=True))
            whole = np.searchsorted(variant, variant[-1])
            if whole:
                yield links(variant[:whole], prints[:whole].view(np.uint64))
            held, size = [[variant[whole:], prints[whole:]]], len(variant) - whole
    if size:
        variant, prints = (np.concatenate(x) for x in zip(*held, strict=True))
        yield links(variant, prints.view(np.uint64))


def links_of(prints: DataFrame) -> DataFrame:
    """(u, v), u > v: links between distinct prints (a column fp) that connect all that ought to be."""
    emitted = prints.select("fp").mapInArrow(_emit, "variant long, fp long")
    met = emitted.repartition("variant").sortWithinPartitions("variant", "fp")
    return written(met.mapInArrow(_link, "u long, v long").distinct(), "simhash-links")


def _checksum(links: DataFrame):
    return links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of the component of every linked node, by alternating stars.

    ``links`` has u > v. Each round ties a node's larger neighbours to its least one, then the node and
    its smaller neighbours likewise, until nothing changes; the rounds grow as the logarithm of a
    component's size. Minima combine before the shuffle and are written before they are joined, so a node
    with many links is not gathered.
    """
    before = _checksum(links)
    while before["n"]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that both sides of the join are plain exchanges and a star's centre may be split over tasks.
        least = written(both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.col("w")).alias("m")), "stars-least")
        large = (
            both.join(least, F.col("u") == F.col("w"))
            .filter("v > u AND v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = written(large, "stars")
        least = written(large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "stars-least")
        joined = large.join(least, F.col("u") == F.col("w"))
        small = (
            joined.filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        links = written(small, "stars")
        after = _checksum(links)
        if after == before:
            break
        before = after
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )


def _append_fingerprints():
    def run(texts: list[bytes]):
        return [pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))]

    return run


def one_of_each(docs: DataFrame) -> DataFrame:
    """Whole rows of ``docs``, one of each component: that with the least id, null ids last.

    Of rows that share their id and fingerprint, any one stays. See near_duplicates.
    """
    return least_of_each(docs, *_components_of(fingerprints(docs)), _append_fingerprints)


def least_of_each(docs: DataFrame, firsts: DataFrame, named: DataFrame, append_prints) -> DataFrame:
    """The rows of ``docs`` with the least id of each component; ``append_prints`` gives each text's print."""
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("fp").alias("c"))
    kept = written(
        firsts.join(named, F.col("fp") == F.col("named"))
        .withColumn("doc_id", F.col("first"))
        .groupBy("root")
        .agg(F.min(order).alias("least"))
        .select(F.col("least.c").alias("kept"), F.col("least.b").alias("kept_id")),
        "simhash-kept",
    )
    # Texts go through one shuffle, on print and id: copies share a print only, so they do not meet.
    prints = appended(docs, "text", append_prints, "fp long")
    keyed = prints.withColumn("key", F.xxhash64("fp", F.col("row.doc_id").cast("long")))
    wanted = kept.withColumn("kept_key", F.xxhash64("kept", "kept_id"))
    same = (F.col("fp") == F.col("kept")) & F.col("row.doc_id").eqNullSafe(F.col("kept_id"))
    rows = keyed.join(wanted, F.col("key") == F.col("kept_key")).filter(same)
    return rows.groupBy("kept_key", "kept", "kept_id").agg(F.first("row").alias("row")).select("row.*")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every document; component_id is the least doc_id it is linked to.

    Texts are taken as words between ASCII white space, A-Z in lower case, in shingles of three; fewer
    words are one shingle, and a text without words, null ones included, has fingerprint zero and links
    as any other. Documents whose fingerprints differ in three bits or fewer are linked, and links chain.
    Repeated rows share their component. Null ids are passed over when a component is named; one with
    null ids only is named null. Further columns are left out.
    """
    prints = fingerprints(docs)
    _, named = _components_of(prints)
    return prints.join(named, F.col("fp") == F.col("named")).select("doc_id", "fp", "component_id")


def _components_of(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, first) of the distinct prints, and (named, root, component_id) of each."""
    firsts = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    return named_components(firsts, links_of(firsts))


def named_components(firsts: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``firsts`` (fp, first), and (named, root, component_id) of each of its prints by the links."""
    nodes = components(links)
    rooted = written(
        firsts.join(nodes, F.col("fp") == F.col("node"), "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "simhash-roots",
    )
    names = rooted.groupBy(F.col("root").alias("of")).agg(F.min("first").alias("component_id"))
    named = rooted.join(names, F.col("root") == F.col("of")).select(F.col("fp").alias("named"), "root", "component_id")
    return firsts, written(named, "simhash-components")


def near_duplicate_digests(docs: DataFrame) -> DataFrame:
    """near_duplicates with the fingerprint as 16 hexadecimal digits."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
