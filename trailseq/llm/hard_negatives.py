"""Hard negatives: for anchors and their positives, the best rows of another label below each positive's score.

Every positive p of an anchor asks for the first rows whose score lies in a window: at most p's score, at least a share of
it. The windows of one anchor overlap, so they aren't searched one by one. The upper limits, in descending order,
cut the scores into disjoint slots; each task keeps the first k rows of every slot (the combiner), these are merged per slot,
and the answer of a positive is read from its slot and all lower ones together, the best first, down to its lower limit.

Anchors and rows meet in groups of (part, anchor block, row share). A task sorts a group's anchors first, holds them as a
matrix of bounded size and lets the rows pass by it, so neither side has to fit into memory and nothing is broadcast.
Scores are inner products of whole numbers and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailseq.llm import common
from trailseq.session import written_table

POSITIVES = 5
NEGATIVES = 5
#: A negative's score is at least this share (in percent) of the positive's, and at most the positive's.
LOWER, UPPER = 80, 100
#: Bytes of a block of anchors, which a task holds, and of a matrix of scores.
ANCHOR_BYTES = 64 << 20
SCORE_BYTES = 16 << 20
#: Rows scored at once at most; scores below 2 ** 54 times it fit 64 bits.
CHUNK_ROWS = 256
#: Rows of a share; it has at least twice as many as the block has anchors.
SHARE_ROWS = 4096

_NONE = np.iinfo(np.int64).min


def quantized(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, q) of ``embeddings`` (vec_id, label, embedding): components as floor(scale * x).

    Rows with a NULL id, label or vector, or with a component that is NULL or not finite, are left out. Of rows that
    repeat a vec_id the one of the smallest label, then the smallest vector, counts.
    """
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    q = F.transform(x, lambda v: F.floor(v * scale))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    one = rows.groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(
        F.min(F.struct(F.col("label").cast("bigint").alias("label"), q.alias("q"))).alias("row"))
    return one.select("vec_id", "row.label", "row.q")


def _dealt(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Anchors (kind 0) and rows (kind 1) by (part, block, share), sorted so that a group's anchors come first.

    Both have part, vec_id, label, q; anchors have limits. A part's anchors are dealt to blocks and its rows to shares
    by their ids; a row goes to each block, an anchor to each share.
    """
    sizes = written_table(
        rows.groupBy("part").agg(F.count("*").alias("rows")).join(
            anchors.groupBy("part").agg(F.count("*").alias("anchors"), F.max(F.size("q")).alias("dim")), "part")
        .withColumn("blocks", F.ceil(F.col("anchors") * F.greatest("dim", F.lit(1)) * 8 / ANCHOR_BYTES))
        .withColumn("shares", F.ceil(F.col("rows") / F.greatest(
            F.lit(SHARE_ROWS), F.ceil(2 * F.col("anchors") / F.col("blocks")))))
        .select("part", "blocks", "shares"), "negatives-sizes")
    groups = int(sizes.agg(F.sum(F.col("blocks") * F.col("shares"))).first()[0] or 1)
    side = common.checked_side(sizes, 100_000)
    one_of = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).alias(n[:-1])
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)).alias(n[:-1])
    columns = ["part", "block", "share", "vec_id", "label", "q", "limits"]
    own = anchors.join(side, "part").select("*", one_of("blocks"), each("shares")).select(
        F.lit(0).alias("kind"), *columns)
    others = rows.withColumn("limits", F.lit(None).cast("array<bigint>")).join(side, "part").select(
        "*", one_of("shares"), each("blocks")).select(F.lit(1).alias("kind"), *columns)
    place = ["part", "block", "share"]
    return own.unionByName(others).repartition(groups, *place).sortWithinPartitions(*place, "kind")


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    dim = int(lengths.max()) if len(lengths) else 0
    if (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    out[np.arange(dim)[None, :] < lengths[:, None]] = flat
    return out


def _widened(matrix: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, dim - matrix.shape[1]))) if matrix.shape[1] < dim else matrix


class Held:
    """The anchors of a group, and per anchor and slot the first ``k`` rows so far: larger scores, then smaller ids."""

    def __init__(self, batches: list[pa.RecordBatch], k: int, other_label: bool):
        self.k, self.other_label = k, other_label
        self.ids = np.concatenate([b.column("vec_id").to_numpy() for b in batches])
        self.labels = np.concatenate([b.column("label").to_numpy() for b in batches])
        parts = [_matrix(b.column("q")) for b in batches]
        dim = max(p.shape[1] for p in parts)
        self.vectors = np.concatenate([_widened(p, dim) for p in parts])
        self.most = int(np.abs(self.vectors).max(initial=0))
        self.exact = self.vectors.astype(np.float64)
        #: Upper limits of the slots in descending order; one slot without a limit if there are none.
        self.limits = np.full((len(self.ids), 1), np.iinfo(np.int64).max)
        if other_label:
            self.limits = _filled(pa.concat_arrays([b.column("limits") for b in batches]))
        # windows of scores below 0 are empty
        low = np.where(self.limits >= 0, -(-LOWER * np.maximum(self.limits, 0) // UPPER), np.iinfo(np.int64).max)
        self.low = low.min(axis=1) if other_label else np.full(len(self.ids), _NONE + 1)
        shape = (self.limits.shape[1], len(self.ids), k)
        self.scores, self.rows = np.full(shape, _NONE), np.full(shape, np.iinfo(np.int64).max)

    def products(self, rows: np.ndarray) -> np.ndarray:
        """(anchors, rows) inner products, exact in whichever arithmetic holds them."""
        dim = max(rows.shape[1], self.vectors.shape[1])
        bound = self.most * int(np.abs(rows).max(initial=0)) * max(dim, 1)
        if bound < 1 << 53:
            width = min(rows.shape[1], self.vectors.shape[1])
            return (self.exact[:, :width] @ rows[:, :width].astype(np.float64).T).astype(np.int64)
        if bound >= 1 << 54:  # their 100-fold is compared
            raise ValueError("scores are too large for 64-bit numbers")
        return _widened(self.vectors, dim) @ _widened(rows, dim).T

    def see(self, batch: pa.RecordBatch) -> None:
        order = np.argsort(batch.column("vec_id").to_numpy(), kind="stable")
        ids, labels = batch.column("vec_id").to_numpy()[order], batch.column("label").to_numpy()[order]
        rows = _matrix(batch.column("q"))[order]
        step = max(1, min(CHUNK_ROWS, SCORE_BYTES // (8 * len(self.ids))))
        for at in range(0, len(ids), step):
            some = slice(at, at + step)
            self._see(ids[some], labels[some], self.products(rows[some]))

    def _see(self, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray) -> None:
        n = len(ids)
        differs = labels[None, :] != self.labels[:, None]
        allowed = differs if self.other_label else ~differs & (ids[None, :] != self.ids[:, None])
        allowed &= (scores <= self.limits[:, :1]) & (scores >= self.low[:, None])
        # one number to select by: the score, then the place among the ids, which ascend
        key = scores * n + (n - 1 - np.arange(n))
        k = min(self.k, n)
        for slot in range(len(self.scores)):
            inside = allowed if slot + 1 == len(self.scores) else allowed & (scores > self.limits[:, slot + 1:slot + 2])
            inside &= scores >= self.scores[slot, :, -1:]
            if slot:
                inside &= scores <= self.limits[:, slot:slot + 1]
            touched = np.flatnonzero(inside.any(axis=1))
            if not len(touched):
                continue
            top = np.partition(np.where(inside[touched], key[touched], _NONE), n - k, axis=1)[:, n - k:]
            found = top != _NONE
            score = np.where(found, top // n, _NONE)
            row = np.where(found, ids[n - 1 - top % n], np.iinfo(np.int64).max)
            both = np.concatenate([self.scores[slot, touched], score], axis=1)
            rows = np.concatenate([self.rows[slot, touched], row], axis=1)
            order = np.lexsort((rows, -both, both == _NONE), axis=-1)[:, :self.k]
            self.scores[slot, touched] = np.take_along_axis(both, order, axis=1)
            self.rows[slot, touched] = np.take_along_axis(rows, order, axis=1)

    def out(self) -> pa.RecordBatch:
        slot, anchor, place = np.nonzero(self.scores != _NONE)
        return pa.RecordBatch.from_pydict({
            "anchor_id": pa.array(self.ids[anchor]), "slot": pa.array(slot.astype(np.int32)),
            "score": pa.array(self.scores[slot, anchor, place]), "vec_id": pa.array(self.rows[slot, anchor, place])})


def _filled(limits: pa.Array) -> np.ndarray:
    lengths = limits.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(lengths), int(lengths.max())), _NONE)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = limits.flatten().to_numpy(zero_copy_only=False)
    return out


def _first_rows(rows: DataFrame, anchors: DataFrame, k: int, other_label: bool) -> DataFrame:
    """(anchor_id, slot, place, score, vec_id): per anchor and slot the first ``k`` rows, numbered from 1.

    Rows of the anchor's label without itself, or those of other labels in the slots of the anchor's limits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, waiting, held = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("part", "block", "share", "kind")], axis=1)
            edges = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for start, end in zip([0, *edges], [*edges, len(keys)]):
                if end == start:
                    continue
                piece, place = batch.slice(start, end - start), tuple(keys[start, :3])
                if place != group:
                    if held:
                        yield held.out()
                    group, waiting, held = place, [], None
                if keys[start, 3] == 0:
                    waiting.append(piece)
                elif waiting:
                    held = held or Held(waiting, k, other_label)
                    held.see(piece)
        if held:
            yield held.out()

    found = _dealt(rows, anchors).mapInArrow(run, "anchor_id bigint, slot int, score bigint, vec_id bigint")
    place = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("place", place).where(F.col("place") <= k).select(
        "anchor_id", "slot", "place", "score", "vec_id")


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """Hard negatives of ``anchors`` among ``rows``, both with vec_id, label and q (whole numbers), ids unique.

    An anchor's positives are the first ``positives`` other rows of its label by descending score (inner product with the
    anchor), then ascending vec_id. Of every positive the first ``negatives`` rows of another label whose score is
    at most the positive's and at least LOWER percent of it are returned: anchor_id, positive_id, rank (from 1),
    negative_id, positive_score, negative_score. Positives below 0 have an empty window, anchors without a positive or a
    negative no row. Shorter vectors count as filled up with zeros. Empty tables give no rows.
    """
    same = lambda df: df.select(F.col("label").alias("part"), "vec_id", "label", "q")
    nothing = F.lit(None).cast("array<bigint>")
    first = written_table(_first_rows(
        same(rows), same(anchors).withColumn("limits", nothing), positives, other_label=False), "positives")
    of_anchor = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list("score"), asc=False).alias("limits"))
    whole = lambda df: df.select(F.lit(0).cast("bigint").alias("part"), "*")
    asked = whole(anchors.select("vec_id", "label", "q").join(of_anchor, "vec_id"))
    slots = _first_rows(whole(rows.select("vec_id", "label", "q")), asked, negatives, other_label=True)
    # what the slots hold, best first: the slots from a positive's on are those of scores up to its own
    best = slots.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("score")).alias("minus"), F.col("vec_id").alias("negative_id"), "slot"))).alias("held"))
    pairs = first.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                         (F.col("place") - 1).alias("own")).join(best, "anchor_id")
    window = F.filter("held", lambda h: (h["slot"] >= F.col("own")) & (
        -h["minus"] * UPPER >= F.col("positive_score") * LOWER))
    return pairs.select(
        "anchor_id", "positive_id", "positive_score",
        F.posexplode(F.slice(window, 1, negatives)).alias("at", "h")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), "h.negative_id", "positive_score",
        (-F.col("h.minus")).alias("negative_score"))
