"""Spelling variants: words one edit apart, found by walking a trie that is a distributed table.

States (word, position, node, edits) advance level by level: each level joins them with the trie's rows
of that depth. A state without an edit sits on the prefix of its own word; there it may leave out the
word's next letter or take an edge of another letter. A state with its edit made must follow the word's
letters to its end; if a word ends there too, the two are neighbours.

What keeps the frontier small, and loses no pair:

* Edits are made in a word's later half only. A second trie of the reversed words covers the earlier
  half, so no state branches near a root, where every edge would be tried.
* Of two words the longer one leaves a letter out, and of two of equal length the one with the smaller
  letter takes the edge of the larger; a letter out of a run of equal ones is left out at one place.
  So each pair is found once, and is then turned round.
* A node's row lists its edges with the letters that follow each, as bit masks, so that a state that
  would die on the next level is not written.

Depth, and with it the number of levels, is bounded by ``TRIE_LETTERS``. Longer words, of any length,
are compared exactly in another way (long_neighbours).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewaste.llm.tables import written
from tracewaste.session import ensure_checkpoint_dir

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent as the word.
FORM_RATIO = 10
#: One occurrence in so many loses a letter.
TYPO_EVERY = 31
TRIE_LETTERS = 64
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "[a-zÀ-ÿ]"


def occurrences(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """(word) of every run of ``least`` letters or more, A-Z in lower case, with the letters lost by hash.

    Only runs of that length can become words, since letters are only lost.
    """
    low = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), CAPITALS, SMALL)
    runs = F.regexp_extract_all(low, F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    each = docs.select(key.alias("key"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return each.withColumn("h", h).select(
        F.when(F.col("h") % TYPO_EVERY == 0, shorter).otherwise(F.col("run")).alias("word")
    )


def counted_words(docs: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of ``least`` letters that occur ``least_count`` times, written once.

    Counts combine before the shuffle, so a frequent word sends one row a task.
    """
    counted = occurrences(docs, least).filter(F.char_length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return written(counted.filter(F.col("n") >= least_count), "spelling-words")


def _letter_bits(letter: Column) -> tuple[Column, Column]:
    """Bit masks of a letter, or none: a-z in the first, the 64 further letters in the second."""
    code = F.ascii(letter)
    low = F.when((letter != "") & (code < 128), F.call_function("shiftleft", F.lit(1).cast("long"), code - 97))
    high = F.when(code >= 192, F.call_function("shiftleft", F.lit(1).cast("long"), code - 192))
    return F.coalesce(low, F.lit(0).cast("long")), F.coalesce(high, F.lit(0).cast("long"))


def _oriented(words: DataFrame) -> DataFrame:
    """(back, word, n, size, since): each word and its reverse, and where edits may begin."""
    size = F.char_length("word")
    half = F.expr("char_length(word) div 2")
    return words.select(
        "n",
        size.alias("size"),
        F.explode(
            F.array(
                F.struct(F.lit(False).alias("back"), F.col("word").alias("w"), half.alias("since")),
                F.struct(F.lit(True).alias("back"), F.reverse("word").alias("w"), (size - half).alias("since")),
            )
        ).alias("o"),
    ).select("o.back", F.col("o.w").alias("word"), "n", "size", F.col("o.since").cast("int").alias("since"))


def trie_of(oriented: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """(back, node, kids, depth): the trie's rows from depth ``least`` div 2 on, written by depth.

    A node is named by its prefix. Its kids are (letter, n, low, high): n of the word that ends behind
    that edge, or 0, and the letters that follow as masks. A word that ends at the node itself is a kid
    without a letter. A node has at most one kid for each letter of the alphabet.
    """
    depth = F.explode(F.sequence(F.lit(least // 2), F.col("size")))
    spelled = oriented.select("back", "word", "n", "size", depth.alias("depth"))
    low, high = _letter_bits(F.substr("word", F.col("depth") + 1, F.lit(1)))
    nodes = spelled.groupBy("back", "depth", F.substr("word", F.lit(1), F.col("depth")).alias("node")).agg(
        F.max(F.when(F.col("depth") == F.col("size"), F.col("n")).otherwise(0)).alias("n"),
        F.bit_or(low).alias("low"),
        F.bit_or(high).alias("high"),
    )
    as_kid = F.struct(
        (F.col("depth") - 1).alias("at"),
        F.substr("node", F.lit(1), F.col("depth") - 1).alias("of"),
        F.struct(F.substr("node", F.col("depth"), F.lit(1)).alias("letter"), "n", "low", "high").alias("kid"),
    )
    none = F.lit(0).cast("long")
    as_end = F.struct(
        F.col("depth").alias("at"),
        F.col("node").alias("of"),
        F.struct(F.lit("").alias("letter"), F.col("n"), none.alias("low"), none.alias("high")).alias("kid"),
    )
    edges = nodes.select("back", F.explode(F.array(as_kid, as_end)).alias("e")).select("back", "e.*")
    kept = edges.filter((F.col("kid.letter") != "") | (F.col("kid.n") > 0)).filter(F.col("at") >= least // 2)
    rows = kept.groupBy("back", F.col("of").alias("node"), F.col("at").alias("depth")).agg(
        F.collect_list("kid").alias("kids")
    )
    return written(rows, "spelling-trie", partition_by="depth")


def _moves() -> Column:
    """Where a joined state may go: (letter, n, low, high, pos) of the kids it may take.

    pos is the word's next letter to follow after the move.
    """
    word, pos, edits = F.col("word"), F.col("pos"), F.col("edits")
    own, following = F.substr(word, pos + 1, F.lit(1)), F.substr(word, pos + 2, F.lit(1))
    # Out of a run of equal letters the first one of the word as written is left out.
    neighbour = F.when(F.col("back"), following).otherwise(F.substr(word, pos, F.lit(1)))

    def to(at: int):
        return lambda kid: F.struct(
            kid["letter"].alias("letter"), kid["n"].alias("n"), kid["low"].alias("low"), kid["high"].alias("high"),
            (pos + at).cast("int").alias("pos"),
        )

    follow = F.transform(F.filter("kids", lambda kid: (kid["letter"] == own) & (own != "")), to(1))
    replace = F.transform(F.filter("kids", lambda kid: kid["letter"] > own), to(1))
    # Behind the last letter `following` is empty, as is the letter of a word that ends at the node.
    leave_out = F.transform(
        F.filter("kids", lambda kid: (kid["letter"] == following) & (own != neighbour)), to(2)
    )
    return F.when(edits == 1, follow).otherwise(F.concat(replace, leave_out))


def _level(states: DataFrame, rows: DataFrame) -> DataFrame:
    """The states one level on: those that ended with a neighbour are ``done``, the others can go on."""
    moved = (
        states.join(rows, ["back", "node"])
        .select("back", "word", "n", "size", "node", F.explode(_moves()).alias("to"))
        .select(
            "back", "word", "n", "size",
            F.concat("node", "to.letter").alias("node"),
            F.col("to.pos").alias("pos"),
            F.col("to.n").alias("near_n"),
            (F.col("to.pos") >= F.col("size")).alias("done"),
            F.substr("word", F.col("to.pos") + 1, F.lit(1)).alias("next"),
            "to.low", "to.high",
        )
    )
    low, high = _letter_bits(F.col("next"))
    alive = (low.bitwiseAND(F.col("low")) != 0) | (high.bitwiseAND(F.col("high")) != 0)
    kept = moved.filter(F.when(F.col("done"), F.col("near_n") > 0).otherwise(alive))
    return kept.select("back", "word", "n", "size", "node", "pos", "near_n", "done")


def trie_neighbours(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """(word, n, near, near_n) of words of at most TRIE_LETTERS letters, each pair once.

    Each level is one join, written to the shared folder; a lost executor costs a re-read of the last.
    """
    short = words.filter(F.char_length("word") <= TRIE_LETTERS)
    oriented = written(_oriented(short), "spelling-oriented")
    trie = trie_of(oriented, least)
    deepest = oriented.agg(F.max("size").alias("m")).first()["m"] or 0
    spark = words.sparkSession
    base = f"{ensure_checkpoint_dir(spark)}/spelling-levels-{uuid.uuid4().hex}"
    layout = "back boolean, word string, n long, size int, node string, pos int, near_n long"
    frontier = spark.createDataFrame([], f"{layout}, done boolean")
    states = ["back", "word", "n", "size", "node", "pos", "edits"]
    for depth in range(least // 2, deepest):
        at = F.lit(depth)
        spine = oriented.filter((F.col("since") <= at) & (F.col("size") > at)).select(
            "back", "word", "n", "size",
            F.substr("word", F.lit(1), at).alias("node"), at.alias("pos"), F.lit(0).alias("edits"),
        )
        edited = frontier.filter(~F.col("done")).withColumn("edits", F.lit(1)).select(*states)
        rows = trie.filter(F.col("depth") == depth).drop("depth")
        path = f"{base}/level={depth}"
        _level(spine.unionByName(edited), rows).write.partitionBy("done").parquet(path)
        frontier = spark.read.schema(f"{layout}, done boolean").parquet(path)
    if deepest <= least // 2:
        found = frontier
    else:
        found = spark.read.schema(f"{layout}, level int, done boolean").parquet(base).filter("done")

    def written_form(c: str) -> Column:
        return F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))

    return found.select(
        written_form("word").alias("word"), "n", written_form("node").alias("near"), "near_n"
    )


def _mixed(letters: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit number of each letter at its place."""
    x = (letters.astype(np.uint64) << np.uint64(40)) + places.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shortened_hashes(word: str) -> tuple[int, np.ndarray]:
    """The word's hash and, in linear time, those of the word without each of its letters."""
    letters = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    places = np.arange(len(letters))
    kept = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(letters, places), dtype=np.uint64)])
    moved = np.cumsum(_mixed(letters, places - 1)[::-1], dtype=np.uint64)[::-1]
    after = np.concatenate([moved[1:], np.zeros(1, np.uint64)])
    return int(kept[-1].astype(np.int64)), (kept[:-1] + after).astype(np.int64)


def _shortened(batches):
    names = ["row", "size", "at", "hash"]
    for batch in batches:
        for row, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own, without = shortened_hashes(word)
            size = len(without)
            at = np.arange(-1, size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size + 1, row, np.int64)),
                    pa.array(np.full(size + 1, size, np.int32)),
                    pa.array(at.astype(np.int32)),
                    pa.array(np.concatenate([[own], without]).astype(np.int64)),
                ],
                names=names,
            )


def long_neighbours(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of words of TRIE_LETTERS letters or more, each pair once.

    Each word gives the hash of itself (at = -1) and of itself without each letter, of constant size
    whatever the word's length. Words of equal size that agree without the same letter differ there
    alone; a word that without a letter agrees with another is one letter longer. Both are compared
    letter by letter in the end. As many words agree as there are letters at most, so no group grows.
    """
    numbered = written(
        words.filter(F.char_length("word") >= TRIE_LETTERS).select(
            F.monotonically_increasing_id().alias("row"), "word", "n"
        ),
        "spelling-long",
    )
    hashes = written(
        numbered.select("row", "word").mapInArrow(_shortened, "row long, size int, at int, hash long"),
        "spelling-long-hashes",
    )
    without = hashes.filter("at >= 0")
    other = without.select(F.col("row").alias("other"), "size", "at", "hash")
    replaced = without.join(other, ["size", "at", "hash"]).filter("row < other").select("row", "other", "at", F.lit(True).alias("same"))
    whole = hashes.filter("at < 0").select(F.col("row").alias("other"), (F.col("size") + 1).alias("size"), "hash")
    left_out = without.join(whole, ["size", "hash"]).groupBy("row", "other").agg(F.min("at").alias("at"))
    pairs = replaced.unionByName(left_out.withColumn("same", F.lit(False)))

    def less(word: str) -> Column:
        return F.concat(F.substr(word, F.lit(1), F.col("at")), F.substr(word, F.col("at") + 2))

    near = numbered.select(F.col("row").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    joined = pairs.join(numbered, "row").join(near, "other")
    agrees = less("word") == F.when(F.col("same"), less("near")).otherwise(F.col("near"))
    return joined.filter(agrees).select("word", "n", "near", "near_n")


def neighbours(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """(word, n, near, near_n) of all words one inserted, deleted or replaced code point apart, each pair once."""
    pairs = trie_neighbours(words, least)
    if words.filter(F.char_length("word") > TRIE_LETTERS).isEmpty():
        return pairs
    # Two words of exactly TRIE_LETTERS letters are found in the trie.
    longer = F.greatest(F.char_length("word"), F.char_length("near")) > TRIE_LETTERS
    return pairs.unionByName(long_neighbours(words).filter(longer))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): the last form that follows from each word of ``forms`` (word, form).

    Pointers double, so a chain of m forms takes log2(m) joins; m is bounded, since each form is
    FORM_RATIO times as frequent as the one before.
    """
    roots = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = roots.select(F.col("word").alias("at"), F.col("root").alias("further"))
        stepped = roots.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        roots = written(stepped, "spelling-roots")
        if roots.filter("moved").isEmpty():
            return roots.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents.

    Words and their counts are those of counted_words; n_near counts the words one edit away. A word's
    form is the most frequent of these, the first in code-point order of several, if it is FORM_RATIO
    times as frequent as the word; root follows forms to the last, and is the word itself without one.
    A null text has no words, a null doc_id counts as empty, repeated rows count each, words of any
    length take part, an empty table gives no rows, and further columns are left out.
    """
    words = counted_words(docs)
    pairs = neighbours(words)
    both = pairs.select(
        F.explode(
            F.array(
                F.struct("word", "near", "near_n"),
                F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
            )
        ).alias("p")
    ).select("p.word", F.struct((-F.col("p.near_n")).alias("less"), F.col("p.near").alias("near")).alias("best"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    known = words.join(best, "word", "left")
    frequent = -F.col("best.less") >= FORM_RATIO * F.col("n")
    placed = written(
        known.select(
            "word",
            F.when(frequent, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = roots_of(placed.filter("form IS NOT NULL"))
    return placed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
