"""Mixing sources to target weights by entropy balancing.

Of all ways to repeat documents at some rate, the balanced one keeps the rates as close to 1 as it can (in relative
entropy) while every source's tokens meet its target. Its dual is convex, with one multiplier per source; the rate of a document
is ``exp(multiplier * size)``, never above the most copies allowed. Newton's method solves the dual: each round sums tokens and
their derivative over all partitions and moves every source's multiplier, halving its bracket where a step would leave it.
Rates are then rounded into whole copies, the largest documents first, so that what one rounding gains or loses
is made up by the next, smaller documents.

Documents of one source and size have the same rate, so rounds run on counts by source and size, and a hot source
is no larger than its different sizes.
"""

from __future__ import annotations

from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailseq.llm import common
from trailseq.operators.numbering import row_numbers
from trailseq.session import written_table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: Copies of a document at most, and of a source on the whole.
MOST_COPIES = 3
#: Relative distance of a source's balanced tokens from its target.
TOLERANCE = 1e-9
ROUNDS = 200
#: Documents of a source and size that are ranked in one piece.
RANKED_ROWS = 512
#: Rows (of a few numbers) up to which sources and sizes are sent to all executors.
BROADCAST_ROWS = 200_000


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source_key, size): size is the number of words; NULL sources come last in the order of keys."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~"))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("source_key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))


def targets(cells: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """(source_key, source_size, least, target), one row per source of ``cells`` (source_key, size, n).

    Sources in the order of their keys weigh ``weights``, repeating, and share all tokens. A target stops at
    ``most_copies`` times its source's size; what it leaves is shared by the others until none is above. ``least`` is the
    source's smallest size above 0.
    """
    sources = written_table(cells.groupBy("source_key").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")),
        "mixing-sources")
    numbered = row_numbers(sources, "source_key", carry=("source_size", "least"))
    weight = F.element_at(F.lit(list(weights)), (F.pmod(F.col("row_no") - 1, F.lit(len(weights))) + 1).cast("int"))
    shares = written_table(numbered.select(
        "source_key", "source_size", "least", weight.alias("weight"),
        (most_copies * F.col("source_size")).cast("double").alias("limit")), "mixing-weights")
    # all sources above the level stop at their limits, which lifts the level for the others
    level, total = 0.0, float(shares.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        open_ = F.col("limit") > F.col("weight") * level
        stopped, weight_left, fresh = shares.agg(
            F.sum(F.when(~open_, F.col("limit"))), F.sum(F.when(open_, F.col("weight"))), F.count("*")).first()
        following = (total - (stopped or 0.0)) / weight_left if weight_left else level
        if following <= level or not fresh:
            break
        level = following
    return shares.select(
        "source_key", "source_size", "least", F.least("limit", F.col("weight") * level).alias("target"))


def _rate(multiplier: Column, size: Column, most: float) -> Column:
    """exp(multiplier * size), at most ``most``; the exponent is cut first, so that nothing overflows."""
    return F.least(F.lit(float(most)), F.exp(F.least(F.lit(log(most) + 1), multiplier * size)))


def multipliers(cells: DataFrame, goals: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """(source_key, source_size, target, multiplier): the solution of the dual, one row per source.

    A source whose target is its limit has an infinite multiplier, one without tokens 0. Every round is one
    aggregate over ``cells`` and is written, so a lost executor repeats a round at most.
    """
    limit = F.col("target") >= most_copies * F.col("source_size")
    up, least = F.col("target") > F.col("source_size"), F.col("least").cast("double")
    bare = F.col("least").isNull()
    # at these ends every document is at its limit, or all tokens together are below the target
    end = F.when(up, F.lit(log(most_copies)) / least).otherwise(F.ln(F.col("target") / F.col("source_size")) / least)
    state = goals.select(
        "source_key", "source_size", "target",
        F.when(bare, 0.0).when(limit, F.lit(float("inf"))).otherwise(0.0).alias("multiplier"),
        F.when(bare | up, 0.0).otherwise(end).alias("low"), F.when(~bare & up, end).otherwise(0.0).alias("high"),
        (bare | limit | (F.col("target") == F.col("source_size"))).alias("done"))
    state = written_table(state, "mixing-multipliers")
    x = F.col("size").cast("double")
    for _ in range(ROUNDS):
        if not state.where("not done").limit(1).count():
            return state.select("source_key", "source_size", "target", "multiplier")
        going = common.checked_side(state.where("not done").select("source_key", "multiplier"), BROADCAST_ROWS)
        rate = _rate(F.col("multiplier"), x, most_copies)
        sums = cells.where("size > 0").join(going, "source_key").groupBy("source_key").agg(
            F.sum(F.col("n") * x * rate).alias("tokens"),
            F.sum(F.when(rate < most_copies, F.col("n") * x * x * rate).otherwise(0.0)).alias("slope"))
        joined = state.join(sums, "source_key", "left")
        # of the logarithm, which is closer to a straight line
        step = F.ln(F.col("target") / F.col("tokens")) * F.col("tokens") / F.col("slope")
        below = F.col("tokens") < F.col("target")
        low = F.when(below, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(below, F.col("high")).otherwise(F.col("multiplier"))
        newton, middle = F.col("multiplier") + step, (low + high) / 2
        fine = F.col("slope").isNotNull() & (F.col("slope") > 0) & (newton > low) & (newton < high)
        met = F.abs(F.col("tokens") - F.col("target")) <= TOLERANCE * F.col("target")
        stuck = (middle <= low) | (middle >= high)
        done = F.col("done") | met | stuck
        following = joined.select(
            "source_key", "source_size", "target",
            F.when(done, F.col("multiplier")).when(fine, newton).otherwise(middle).alias("multiplier"),
            F.when(done, F.col("low")).otherwise(low).alias("low"), F.when(done, F.col("high")).otherwise(high).alias("high"),
            done.alias("done"))
        state = written_table(following, "mixing-multipliers")
    raise RuntimeError(f"no balance after {ROUNDS} rounds")


def _rounded(most_copies: int):
    """Copies of each size of one source, largest first; what a rounding is off is added to the next size's tokens.

    No size is rounded so far that the smaller ones, between no copies and all, couldn't make up for it.
    """
    def run(group: pa.Table) -> pa.Table:
        size, n = group.column("size").to_numpy(), group.column("n").to_numpy()
        due, most = group.column("rate").to_numpy() * n * size, most_copies * n * size
        order = np.argsort(-size, kind="stable")
        due_after = due[order][::-1].cumsum()[::-1] - due[order]
        most_after = most[order][::-1].cumsum()[::-1] - most[order]
        copies, owed = np.zeros(len(size), dtype=np.int64), 0.0
        for k, rest_due, rest_most in zip(order, due_after, most_after):
            owed += due[k]
            if size[k]:
                least = ceil((owed - (rest_most - rest_due)) / size[k] - 1e-9)
                largest = floor((owed + rest_due) / size[k] + 1e-9)
                wanted = round(owed / size[k])
                if least <= largest:  # else nothing hits the target, and the nearest is best
                    wanted = min(max(wanted, least), largest)
                copies[k] = min(max(wanted, 0), most_copies * int(n[k]))
                owed -= float(copies[k] * size[k])
        return pa.table({"source_key": group.column("source_key"), "size": group.column("size"),
                         "copies": pa.array(copies, pa.int64())})
    return run


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken), a row for each row of ``docs`` (doc_id, text, source).

    ``copies`` (0 to ``most_copies``) are how often the mix takes the document, ``taken`` its words in all. A NULL text has
    no words and is never taken, nor is an empty one; a NULL source is a source of its own, the last. Rows that
    repeat a doc_id are documents of their own. Documents of one source and size differ by one copy at most; those with the
    smallest hash of their id have more, so that reruns agree. An empty table gives no rows.

    A source's copies are rounded in one task, which holds three numbers for each different size in it.
    """
    sized = written_table(sizes(docs), "mixing-sizes")
    cells = written_table(sized.groupBy("source_key", "size").agg(F.count("*").alias("n")), "mixing-cells")
    goals = targets(cells, weights, most_copies)
    solved = multipliers(cells, goals, most_copies)
    rate = F.when(F.col("multiplier") == float("inf"), float(most_copies)).otherwise(
        _rate(F.col("multiplier"), F.col("size").cast("double"), most_copies))
    side = common.checked_side(solved, BROADCAST_ROWS)
    copies = cells.join(side, "source_key").select("source_key", "size", "n", rate.alias("rate")).groupBy(
        "source_key").applyInArrow(_rounded(most_copies), "source_key string, size bigint, copies bigint")
    keys = ["source_key", "size"]
    plan = written_table(
        cells.join(copies, keys).join(side, "source_key").select(
            *keys, "n", "copies", "source_size", "target"), "mixing-copies")

    # the first copies % n documents of a size have one more: ranked within pieces, counted over pieces
    piece = F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.ceil(F.col("n") / RANKED_ROWS))
    dealt = sized.join(common.checked_side(plan, BROADCAST_ROWS), keys).withColumn("piece", piece)
    extra = (F.col("copies") % F.col("n"))
    whole = F.floor(F.col("copies") / F.col("n"))
    ranked = dealt.withColumn("rank", F.row_number().over(
        Window.partitionBy(*keys, "piece").orderBy(F.xxhash64("doc_id"), "doc_id")))
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = dealt.where(F.col("n") > RANKED_ROWS).groupBy(*keys, "piece").agg(F.count("*").alias("m")).select(
        *keys, "piece", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("earlier"))
    placed = ranked.join(pieces, [*keys, "piece"], "left")
    taken = whole + F.when(F.col("rank") + F.coalesce("earlier", F.lit(0)) <= extra, 1).otherwise(0)
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("copies"),
                         (taken * F.col("size")).alias("taken"))
