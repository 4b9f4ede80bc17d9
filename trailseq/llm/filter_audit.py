"""What quality filters remove alone, together and in every order: an audit by the Hart-Mas-Colell potential.

A set of filters (a coalition) removes the documents that fail any of them. A document is known by the set of filters it
fails, so a part of the corpus (a source) comes down to a count per such set, and its removal game to one
value per coalition. The potential of a game is 0 without filters and else, with v the coalition's removals,

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

and the Shapley value of a filter is the potential of all filters less the potential of all others. Potentials are held
times |S|!, which keeps them whole numbers. What a filter does at its step of an order is the difference of two
coalitions: of the filters up to it, and of those before it.

Coalitions are bit masks: filter k of ``filters`` is bit 2 ** k.
"""

from __future__ import annotations

import itertools
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Most filters of an audit: its games have 2 ** n coalitions, and its report n! orders.
MOST_FILTERS = 6


def quality_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions on one text (not NULL) and the array of its words; each is true or false."""
    n = F.size(words)
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * F.lit(100) < n * 65,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")) * F.lit(100) > F.length(text) * 5,
        "D": F.rlike(text, F.lit(r"[#$%&*|]")),
    }


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic), a row for each row of ``docs`` (doc_id, text, source).

    ``failed`` is the mask of the filters A to E that the document fails; E fails if a smaller doc_id has the identical
    text. A NULL text counts as empty, and a NULL source as the part of empty name. Rows that repeat a doc_id are documents of
    their own; E holds none against another of the same id. A NULL doc_id has no label, passes E and is no smaller id.
    A label that is there several times counts if any row has it; NULL labels are none. Other columns aren't used.

    Only digests, ids and masks are moved. First holders of a text are found again by text and id, so that a text with very
    many copies meets its first holder in as many tasks as it has ids.
    """
    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"))
    # words between separators; a text that begins or ends with one has an empty piece there
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    split = plain.withColumn("words", words)
    own = quality_filters(F.col("text"), F.col("words"))
    mask = sum((F.when(failed, F.lit(1 << k)).otherwise(0) for k, failed in enumerate(own.values())), F.lit(0))
    narrow = split.select("doc_id", "part", mask.alias("failed"), F.sha2("text", 256).alias("digest"))

    copies = plain.select("doc_id", F.sha2("text", 256).alias("digest"))
    first = copies.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null")
    first = first.select("digest", "doc_id", F.lit(True).alias("is_first"))
    marked = narrow.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part",
        F.when(F.col("is_first").isNotNull() | F.col("doc_id").isNull(), F.col("failed")).otherwise(
            F.col("failed") + (1 << len(own))).alias("failed"))
    flags = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    no = F.lit(False)
    return marked.join(flags, "doc_id", "left").select(
        "part", "failed", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def games(failed: DataFrame, filters: int) -> DataFrame:
    """(part, n, lost, good_lost, toxic_lost): by coalition, the documents that it removes, one row per part."""
    counts = failed.groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))

    def by_coalition(count: str) -> Column:
        return F.array(*(F.sum(F.when(F.col("failed").bitwiseAND(F.lit(s)) != 0, F.col(count)).otherwise(0))
                         for s in range(1 << filters)))

    return counts.groupBy("part").agg(
        F.sum("n").alias("n"), by_coalition("n").alias("lost"), by_coalition("good").alias("good_lost"),
        by_coalition("toxic").alias("toxic_lost"))


def potentials(value: Column, filters: int) -> Column:
    """By coalition S, the potential of the game ``value`` (an array by coalition) times |S|!.

    Every coalition's number is larger than those of its subsets, so one pass in ascending order has what it needs.
    """
    size = lambda s: bin(s).count("1")
    subsets = [[s ^ (1 << k) for k in range(filters) if s >> k & 1] for s in range(1 << filters)]
    steps = F.arrays_zip(
        F.lit(list(range(1, 1 << filters))).alias("s"),
        F.lit([factorial(size(s) - 1) for s in range(1, 1 << filters)]).alias("scale"),
        F.array(*(F.lit(x) for x in subsets[1:])).alias("smaller"))
    return F.aggregate(steps, F.array(F.lit(0).cast("bigint")), lambda known, step: F.concat(known, F.array(
        F.aggregate(step["smaller"], step["scale"] * F.get(value, step["s"]),
                    lambda total, t: total + F.get(known, t)))))


def orders(filters: str) -> Column:
    """Every order of the filters and every step of it, as an array of structs with the masks of before and up to it."""
    rows = [(order, k + 1, sum(1 << filters.index(x) for x in order[:k]), filters.index(order[k]))
            for order in map("".join, itertools.permutations(filters)) for k in range(len(filters))]
    names = ("filter_order", "step", "before", "filter")
    return F.arrays_zip(*(F.lit(list(values)).alias(name) for name, values in zip(names, zip(*rows))))


def audit(failed: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """What every filter does in every order, for each part of ``failed`` (part, failed, good, toxic).

    One row per part, order and step: part, filter_order, step, kept (after this step), removed (here), redundant (failing
    the filter, removed earlier), unique_fails (failing this filter only), good_lost, toxic_lost (removed here), shapley
    (what its filter removes, summed over all orders). Counts are long. Without documents there are no rows.
    """
    if not 1 <= len(filters) <= MOST_FILTERS or len(set(filters)) < len(filters):
        raise ValueError(f"{filters!r}: 1 to {MOST_FILTERS} different filters")
    all_of = (1 << len(filters)) - 1
    of_part = games(failed, len(filters)).withColumn("potential", potentials(F.col("lost"), len(filters)))
    steps = of_part.select("*", F.inline(orders(filters)))
    bit = F.element_at(F.lit([1 << k for k in range(len(filters))]), F.col("filter") + 1)
    rest = F.lit(all_of) - bit
    difference = lambda game: F.get(game, F.col("before") + bit) - F.get(game, F.col("before"))
    removed = difference("lost")
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        (F.col("n") - F.get("lost", F.col("before") + bit)).alias("kept"), removed.alias("removed"),
        (F.get("lost", bit) - removed).alias("redundant"),
        (F.get("lost", F.lit(all_of)) - F.get("lost", rest)).alias("unique_fails"),
        difference("good_lost").alias("good_lost"), difference("toxic_lost").alias("toxic_lost"),
        # potentials are held times |S|!, the orders of all filters are n! = n * (n - 1)!
        (F.get("potential", F.lit(all_of)) - len(filters) * F.get("potential", rest)).alias("shapley"))
