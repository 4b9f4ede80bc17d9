"""Line deduplication: exact repeats of any length, and deletion neighbourhoods with an edit bound of one character.

Two lines are within one edit if and only if they are equal, or one is the other with a character deleted, or both
become equal when the same position is deleted. So every line emits itself and all its deletions as hashed keys, equal
keys meet in an aggregation that keeps the earliest line of each key (never a list of all its lines), and the partner
found is verified by its edit distance before the later line goes.

A line of 300 characters has 300 deletions of 299, but almost no line has a partner. So coarser rounds come first: a
line is cut into segments, and as one edit touches one segment, partners agree on the line less some segment. Lines
that share none of these keys with another line have no partner and go no further; the rounds lose no pair. Of
lines that share one, the deletions within that segment are emitted, keyed by the rest of the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailseq.llm import common
from trailseq.session import written_table

#: Shorter lines go only if they repeat exactly: one edit of them is often another word.
LEAST_CHARS = 12
#: Segments of the first and of the second round.
COARSE, FINE = 2, 16
#: Rows of (document, place) up to which lines are fetched with a broadcast.
BROADCAST_ROWS = 1_000_000

_LAST = (1 << 63) - 1


def _digest(*parts: Column) -> list[Column]:
    """Two 64-bit hashes, as columns a and b."""
    return [F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b")]


def _segment(line: Column, segments: int, q: Column, less: int) -> tuple[Column, Column]:
    """Hash of the line less its segment ``q``, and the segment, for partners of the same or another length.

    For a pair the shorter length places the segments; a line takes part with its own length (less = 0) and with one
    character less (less = 1, where the segment has that character more).
    """
    size = F.length(line) - less
    start, end = F.floor(size * q / segments).cast("int"), F.floor(size * (q + 1) / segments).cast("int")
    rest = F.xxhash64(q, size, F.substring(line, F.lit(1), start), F.substring(line, end + less + 1, size - end))
    return rest, F.substring(line, start + 1, end - start + less)


def _coarse_keys(line: Column) -> Column:
    """NULL for lines that are compared for exact repeats only."""
    return F.when(F.length(line) >= LEAST_CHARS, F.array(
        *(_segment(line, COARSE, F.lit(q), less)[0] for less in (0, 1) for q in range(COARSE))))


def _fine_segments(line: Column) -> Column:
    """Array of (key, less, segment)."""
    def of(less: int) -> Column:
        def one(q: Column) -> Column:
            key, segment = _segment(line, FINE, q, less)
            return F.struct(key.alias("key"), F.lit(less).alias("less"), segment.alias("segment"))
        return F.transform(F.sequence(F.lit(0), F.lit(FINE - 1)), one)
    return F.concat(of(0), of(1))


def _lines(docs: DataFrame) -> DataFrame:
    """at (doc_id, NULL last), text_key, pos and line of every line that isn't empty."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("at"), F.xxhash64("text").alias("text_key"),
        F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"),
    ).where(F.length("line") > 0)


def _shared(keys: DataFrame) -> DataFrame:
    """The rows (a, b, key) whose key another line has too."""
    shared = keys.groupBy("key").agg(
        *(f(c).alias(f"{n}_{c}") for n, f in (("low", F.min), ("high", F.max)) for c in "ab")).where(
        "low_a < high_a or low_b < high_b").select("key")
    return keys.join(shared, "key", "left_semi")


def _fetch(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The lines at ``places`` (a, b, first: struct of at, pos), read from the documents again."""
    wanted = written_table(places.select("a", "b", "first.*"), "line-places")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("at"),
                       F.split("text", "\n", -1).alias("lines"))
    found = rows.join(common.checked_side(wanted, BROADCAST_ROWS), "at").select(
        "a", "b", F.struct("at", "pos").alias("first"), F.try_element_at("lines", F.col("pos") + 1).alias("line"))
    own = _digest(F.col("line"))
    # documents that share an id may have another line at that place
    return found.where((F.col("a") == own[0]) & (F.col("b") == own[1])).dropDuplicates(["a", "b"])


def _partners(lines: DataFrame) -> DataFrame:
    """(a, b, earliest): for distinct ``lines`` (a, b, first, line) the earliest line within one edit, if earlier."""
    segments = lines.select("a", "b", "first", F.explode(_fine_segments(F.col("line"))).alias("s")).select(
        "a", "b", "first", "s.*")
    open_ = written_table(_shared(segments), "open-segments")
    n = F.length("segment")
    gone = written_table(
        open_.where(n > 0).select("first", "key", "less", F.posexplode(F.transform(
            F.sequence(F.lit(1), n), lambda i: F.concat(
                F.substring("segment", F.lit(1), i - 1), F.substring(F.col("segment"), i + 1, n))))
            .alias("place", "rest")), "deletions")
    replaced = gone.groupBy("key", "less", "place", "rest").agg(
        F.min("first").alias("other"), F.count("*").alias("n")).where("n > 1").drop("n")
    whole = open_.where("less = 0").select("key", F.col("segment").alias("rest"), "first")
    shorter = gone.where("less = 1")
    longer = shorter.groupBy("key", "rest").agg(F.min("first").alias("other"))
    found = (
        gone.join(replaced, ["key", "less", "place", "rest"]).select("first", "other")
        .unionByName(shorter.join(whole.withColumnRenamed("first", "other"), ["key", "rest"]).select("first", "other"))
        .unionByName(whole.join(longer, ["key", "rest"]).select("first", "other"))
        .where("other < first").distinct())
    text = lines.select(F.col("first").alias("other"), F.col("line").alias("other_line"))
    return (
        found.join(lines, "first").join(text, "other")
        .where(F.levenshtein("line", "other_line", 1) >= 0)
        .groupBy("a", "b").agg(F.min("other").alias("earliest")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Remove every line that has an earlier line, equal or (from LEAST_CHARS characters on) within one edit.

    Earlier means a smaller doc_id (NULL last), or a smaller place in the same document; the earlier line counts
    whether or not it stays itself. Lines end at line feeds; empty ones stay, and both lines of a pair within one edit
    have LEAST_CHARS characters. Rows that repeat a document aren't earlier than each other. Returns the columns of ``docs`` with the new text, and
    n_lines and n_removed (both replaced if ``docs`` has them); a NULL text stays NULL, with 0 lines.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    docs = docs.select(*kept)
    lines = _lines(docs).select("at", "text_key", "pos", *_digest(F.col("line")),
                                _coarse_keys(F.col("line")).alias("keys"))
    width = 2 * COARSE
    distinct = written_table(
        lines.groupBy("a", "b").agg(
            F.min(F.struct("at", "pos")).alias("first"), F.count("*").alias("n"),
            *(F.min(F.col("keys")[k]).alias(f"k{k}") for k in range(width))), "distinct-lines")
    keys = distinct.where("k0 is not null").select("a", "b", F.explode(F.array(*(f"k{k}" for k in range(width)))).alias("key"))
    coarse = _shared(keys).select("a", "b").distinct()
    near = written_table(_fetch(docs, distinct.join(coarse, ["a", "b"]).select("a", "b", "first")), "near-lines")
    partners = _partners(near)

    decided = distinct.join(partners, ["a", "b"], "left").where("n > 1 or earliest is not null").select(
        "a", "b", F.least("first", F.coalesce("earliest", "first")).alias("earliest"))
    removed = (
        lines.select("at", "text_key", "pos", "a", "b").join(decided, ["a", "b"])
        .where(F.struct("at", "pos") > F.col("earliest"))
        .groupBy("at", "text_key").agg(F.collect_set("pos").alias("removed")))
    at = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST))
    joined = docs.withColumns({"__at": at, "__key": F.xxhash64("text")}).join(
        removed.select(F.col("at").alias("__at"), F.col("text_key").alias("__key"), F.col("removed").alias("__removed")),
        ["__at", "__key"], "left")
    parts = F.split("text", "\n", -1)
    text = F.when(F.col("__removed").isNull(), F.col("text")).otherwise(F.array_join(
        F.filter(parts, lambda _, i: ~F.array_contains("__removed", i)), "\n"))
    return joined.select(
        *(text.alias("text") if c == "text" else F.col(c) for c in kept),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("__removed"), F.lit(0)).cast("bigint").alias("n_removed"))
