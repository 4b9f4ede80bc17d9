"""Removal of repeated passages by prefix-partitioned suffix trees.

Suffixes of all documents are dealt into groups by words that they have near their beginning, and every group gets the
part of the generalized suffix tree that holds its suffixes. A window of ``WINDOW`` words belongs to the ANCHOR words
in it whose digest is the smallest, so equal windows meet wherever they stand. Anchors that only one document has
make groups without a deep node and are left out, which is nearly all of the corpus. Where an anchor is in more
than ``GROUP`` documents the key is lengthened to the whole window, so groups stay of a size for memory.

The tree of a group is built by doubling: suffixes are ranked by their first 1, 2, 4, 8 and then ``WINDOW`` words. The
nodes at that depth with several suffixes are the repeats; each holds the smallest document that it starts in. A
repeat is maximal when its windows are joined, which is what covering words by all their windows does.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailseq.llm import common
from trailseq.session import written_table

WINDOW = 13
ANCHOR = 6
#: Documents of an anchor beyond which its windows are grouped one by one.
GROUP = 20_000
#: Stretches that a task holds to merge equal ones before they are shuffled.
HELD = 100_000
#: Rows up to which repeated texts are looked up by a broadcast.
BROADCAST_ROWS = 1_000_000

_LAST = (1 << 63) - 1


def anchors(words: common.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows with one anchor: first window, number of windows, anchor's digest, text."""
    starts = np.flatnonzero(words.whole(WINDOW))
    if not len(starts):
        return starts, starts, np.zeros(0, dtype=np.uint64), starts
    digests, _ = words.windows(ANCHOR)
    at = sliding_window_view(digests, WINDOW - ANCHOR + 1)[starts].argmin(axis=1) + starts
    text = np.searchsorted(words.first, starts, side="right") - 1
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), digests[at[first]], text[first]


def digests(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of the words from ``first`` to ``last`` (exclusive), from running sums."""
    out = []
    with np.errstate(over="ignore"):
        size = (last - first).astype(np.uint64)
        for salt in (1, 2):
            step = int(common.mix(np.array([salt], dtype=np.uint64))[0]) | 1
            powers = np.cumprod(np.full(len(hashes) + 1, step, dtype=np.uint64))
            inverse = np.cumprod(np.full(len(hashes) + 1, pow(step, -1, 1 << 64), dtype=np.uint64))
            sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
            np.cumsum(common.mix(hashes + np.uint64(salt)) * powers[:-1], out=sums[1:])
            out.append(common.mix((sums[last] - sums[first]) * inverse[first] + size).view(np.int64))
    return out[0], out[1]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.chunks(batches):
        _, _, digest, text = anchors(common.Words(common.column(batch, "text")))
        cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_pydict({
            "__id": batch.column(0),
            "anchors": pa.array([np.unique(digest[a:b]).view(np.int64) for a, b in zip(cuts, cuts[1:])],
                                pa.list_(pa.int64()))})


def _stretches(batch: pa.RecordBatch):
    """Stretches whose anchors other documents share, of large groups each window.

    Words of the batch, and of each stretch: group key, first word, number of words, row of the batch.
    """
    words = common.Words(common.column(batch, "text"))
    first, n, digest, text = anchors(words)
    cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
    wanted, large = np.zeros(len(first), dtype=bool), np.zeros(len(first), dtype=bool)
    for names, flags in (("__shared", wanted), ("__large", large)):
        for i, listed in enumerate(common.column(batch, names)):
            if listed:
                flags[cuts[i]:cuts[i + 1]] = np.isin(
                    digest[cuts[i]:cuts[i + 1]], np.array(listed, dtype=np.int64).view(np.uint64))
    light, heavy = np.flatnonzero(wanted & ~large), np.flatnonzero(wanted & large)
    each = np.repeat(heavy, n[heavy])
    starts = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(n[heavy]) - n[heavy], n[heavy])
    own = words.windows(WINDOW)[0][starts] if len(starts) else np.zeros(0, dtype=np.uint64)
    return (words, np.concatenate([digest[light], own]), np.concatenate([first[light], starts]),
            np.concatenate([n[light] + WINDOW - 1, np.full(len(starts), WINDOW)]), np.concatenate([text[light], text[each]]))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the stretches are, by their digests."""
    for batch in common.chunks(batches):
        words, _, first, size, row = _stretches(batch)
        a, b = digests(words.hashes, first, first + size)
        at, key = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("__at", "__key"))
        yield pa.RecordBatch.from_pydict({
            "__id": batch.column(batch.schema.get_field_index("__id")).take(pa.array(row)),
            "__at": pa.array(at[row]), "__key": pa.array(key[row]), "a": pa.array(a), "b": pa.array(b),
            "start": pa.array((first - words.first[row]).astype(np.int64))})


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches themselves, once for a task as far as HELD of them go: group key, words, first and last document."""
    held: dict[tuple[int, int], list] = {}

    def out() -> pa.RecordBatch:
        columns = list(zip(*held.values())) or [()] * 4
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()),
             pa.array(columns[3], pa.int64())], names=["prefix", "words", "first_at", "last_at"])

    for batch in common.chunks(batches):
        words, prefix, first, size, row = _stretches(batch)
        a, b = digests(words.hashes, first, first + size)
        at = batch.column(batch.schema.get_field_index("__at")).to_numpy()[row]
        begin, end = words.starts[first], words.ends[first + size - 1]
        for k, (key, own) in enumerate(zip(zip(a.tolist(), b.tolist()), at.tolist())):
            seen = held.get(key)
            if seen is None:
                held[key] = [int(prefix[k].view(np.int64)), words.data[begin[k]:end[k]].decode("utf-8", "surrogatepass"),
                             own, own]
            elif own < seen[2]:
                seen[2] = own
            elif own > seen[3]:
                seen[3] = own
        if len(held) > HELD:
            yield out()
    yield out()


def tree_nodes(words: common.Words) -> np.ndarray:
    """The node at depth WINDOW of the suffix at every word, by doubling; meaningful where the window is whole."""
    rank = np.unique(words.hashes, return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < WINDOW:
        step = min(depth, WINDOW - depth)
        behind = np.zeros(len(rank), dtype=np.int64)
        behind[:len(rank) - step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + behind, return_inverse=True)[1].astype(np.int64)
        depth += step
    return rank


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every stretch the smallest document of each window's node; rows of a group follow each other."""
    held: pa.RecordBatch | None = None
    for batch in common.chunks(batches, "words"):
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        group = batch.column(0).to_numpy()
        cut = int(np.searchsorted(-(group[::-1] == group[-1]).astype(int), 0))  # rows of the last group
        held = batch.slice(batch.num_rows - cut)
        if cut < batch.num_rows:
            yield _tree(batch.slice(0, batch.num_rows - cut))
    if held is not None:
        yield _tree(held)


def _tree(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = common.Words(common.column(batch, "words"))
    a, b = digests(words.hashes, words.first[:-1], words.first[1:])
    nodes, starts = tree_nodes(words), np.flatnonzero(words.whole(WINDOW))
    stretch = np.searchsorted(words.first, starts, side="right") - 1
    first, last = (np.array(common.column(batch, c), dtype=np.int64) for c in ("first_at", "last_at"))
    smallest = np.full(len(nodes) + 1, _LAST, dtype=np.int64)
    np.minimum.at(smallest, nodes[starts], first[stretch])
    least = smallest[nodes[starts]]
    cuts = np.searchsorted(stretch, np.arange(batch.num_rows + 1))
    # a stretch that several tasks have seen is kept once
    order = np.lexsort((b, a))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    latest = np.maximum.reduceat(last[order], np.flatnonzero(new))
    kept = order[new]
    kept = kept[np.minimum.reduceat(least, cuts[:-1])[kept] < latest]
    return pa.RecordBatch.from_pydict({
        "a": pa.array(a[kept]), "b": pa.array(b[kept]),
        "least": pa.array([least[cuts[k]:cuts[k + 1]] for k in kept], pa.list_(pa.int64()))})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their covered words; other columns pass."""
    for batch in common.chunks(batches):
        words = common.Words(common.column(batch, "text"))
        covers = batch.column(batch.schema.get_field_index("__covers"))
        size = np.diff(words.first)
        owner = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(covers), 0).to_numpy())
        start, windows, key = (
            covers.flatten().field(n).to_numpy(zero_copy_only=False) for n in ("start", "windows", "key"))
        # of rows that share an id, each has its own covers
        own = key == batch.column(batch.schema.get_field_index("__key")).to_numpy()[owner]
        owner, start, windows = owner[own], start[own], windows[own]
        steps = np.zeros(len(words.starts) + 1, dtype=np.int64)
        for k in range(WINDOW - ANCHOR + 1):
            hit = (windows >> k) & 1 > 0
            at = words.first[owner[hit]] + start[hit] + k
            np.add.at(steps, at, 1)
            np.add.at(steps, at + WINDOW, -1)
        copies = (np.bincount(owner[start < 0], minlength=batch.num_rows) > 0) & (size >= WINDOW)
        np.add.at(steps, words.first[:-1][copies], 1)
        np.add.at(steps, words.first[1:][copies], -1)
        keep = np.cumsum(steps[:-1]) == 0
        removed = size - np.diff(np.concatenate(([0], np.cumsum(keep)))[words.first])
        texts = []
        for i, text in enumerate(common.column(batch, "text")):
            own = (text or "").encode("utf-8", "surrogatepass").split()
            if removed[i]:
                own = itertools.compress(own, keep[words.first[i]:words.first[i + 1]].tolist())
            texts.append(b" ".join(own).decode("utf-8", "surrogatepass"))
        names = [n for n in batch.schema.names if not n.startswith("__")]
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(batch.schema.get_field_index(n))
                   for n in names]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(size, pa.int64()), pa.array(removed, pa.int64())],
            names=[*names, "n_words", "n_removed"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Remove every word that a window covers whose words also start in a document with a smaller doc_id.

    Windows are judged on the input. Returns the columns of ``docs`` with the kept words, joined by one space,
    as text, and n_words and n_removed (both replaced if there). A NULL text becomes an empty one. A NULL doc_id counts
    as larger than all others; rows that share a doc_id don't remove from each other.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    docs = docs.select(*kept)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = docs.withColumns({
        "__at": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)), "__key": F.xxhash64("text"),
        "__id": F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text"))})
    other = F.xxhash64(F.lit(1), F.col("text")).alias("other")
    copies = written_table(
        base.groupBy("__key", other).agg(F.min("__at").alias("first_at"), F.max("__at").alias("last_at")).where(
            "first_at < last_at"), "repeated-texts")
    looked = base.select("__id", "__at", "__key", "text", other).join(
        common.checked_side(copies.drop("last_at"), BROADCAST_ROWS), ["__key", "other"], "left")
    is_copy = F.coalesce(F.col("__at") > F.col("first_at"), F.lit(False))

    # read twice, which costs less than to store them; rows that share an id share their list, which is harmless
    single = looked.where(~is_copy).select("__id", "text").mapInArrow(
        _anchors, "__id bigint, anchors array<bigint>").select("__id", F.explode("anchors").alias("anchor"))
    shared = single.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    flagged = single.join(shared, "anchor").groupBy("__id").agg(
        F.collect_list("anchor").alias("__shared"),
        F.collect_list(F.when(F.col("n") > GROUP, F.col("anchor"))).alias("__large"))
    # all columns, so that one exchange of the documents serves here and below
    marked = base.join(flagged, "__id")
    trees = (
        marked.mapInArrow(_distinct, "prefix bigint, words string, first_at bigint, last_at bigint")
        .repartition(parts, "prefix").sortWithinPartitions("prefix")
        .mapInArrow(_trees, "a bigint, b bigint, least array<bigint>"))
    places = marked.mapInArrow(_places, "__id bigint, __at bigint, __key bigint, a bigint, b bigint, start bigint")
    # a stretch has at most WINDOW - ANCHOR + 1 windows; a bit tells which of them a smaller document has
    bits = F.aggregate(F.transform("least", lambda x, i: F.when(
        x < F.col("__at"), F.pow(F.lit(2), i).cast("int")).otherwise(0)), F.lit(0), lambda s, x: s + x)
    covers = places.join(trees, ["a", "b"]).select("__id", F.struct(
        F.col("start").cast("int").alias("start"), bits.alias("windows"), F.col("__key").alias("key")).alias("cover")).where(
        "cover.windows > 0")
    # a copy is covered as a whole, whatever its windows
    whole = looked.where(is_copy).select("__id", F.struct(
        F.lit(-1).alias("start"), F.lit(0).alias("windows"), F.col("__key").alias("key")).alias("cover")).distinct()
    decided = covers.unionByName(whole).groupBy("__id").agg(F.collect_list("cover").alias("__covers"))
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType())])
    return base.join(decided, "__id", "left").mapInArrow(_cut, schema)
