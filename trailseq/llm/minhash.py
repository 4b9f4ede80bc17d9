"""Near-duplicate documents by b-bit MinHash.

A document's set is its distinct shingles of ``WORDS`` words, as 64-bit digests. ``BANDS * ROWS`` minima are
taken over a set; their low ``BITS`` bits are kept as a packed signature, and each band of minima is hashed to a bucket.
Sets that share a bucket are candidates. Counting equal bit fields, less what equal low bits come about by chance,
estimates their similarity; pairs far below the threshold go, all others are confirmed on the full sets.

Documents with equal sets are one class, represented by the smallest id. No bucket is expanded into all its pairs:
first every class is held against one well-connected class, then against the centre of each of its buckets, and only
where a bucket still holds classes of different components those outside its largest one are held against the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailseq.llm import common
from trailseq.llm.components import components
from trailseq.session import written_table

WORDS = 5
BANDS = 32
ROWS = 4
BITS = 4
#: Links have 100 * intersection >= LINK * union.
LINK = 75
#: Pairs estimated so far below the threshold (4 standard deviations of the estimate) can't reach it.
MARGIN = 0.16
#: Nodes on either side of a tile of pairs, and rows of a bucket that one task compares.
BLOCK = 64
BUCKET_BLOCK = 512
#: Shingles (about words) of the nodes on either side, which bounds the texts and sets that a task holds.
TILE_SHINGLES = 1_000_000

#: Classes with a shared bucket up to which their texts are picked out by a broadcast of their ids.
BROADCAST_ROWS = 1_000_000

_HASHES = BANDS * ROWS
_SIGNATURE = _HASHES * BITS // 64
_FIELDS = np.array([sum(1 << k for k in range(0, 64, BITS))], dtype=np.uint64)[0]
_FACTORS = common.mix(np.arange(1, 2 * _HASHES + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle digests of each text; with fewer words than a shingle has, of all of them as one."""
    words = common.Words(texts, lower=True)
    per = np.diff(words.first)
    digests, _ = words.windows(WORDS)
    short = {n: words.windows(n)[0] for n in range(1, WORDS) if (per == n).any()}
    out = []
    for i, n in enumerate(per):
        at = words.first[i]
        if n >= WORDS:
            out.append(np.unique(digests[at:at + n - WORDS + 1]))
        elif n:
            out.append(common.mix(short[n][at:at + 1] + np.uint64(n)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(hashes, sets) minima of sets that aren't empty."""
    sizes = np.array([len(s) for s in sets])
    first = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets)
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((_HASHES, len(sets)), dtype=np.uint32)
    for k in range(_HASHES):
        out[k] = np.minimum.reduceat(low * _FACTORS[2 * k] + high * _FACTORS[2 * k + 1], first)
    return out


def signatures(low: np.ndarray) -> np.ndarray:
    """(sets, words) low bits of the minima, packed."""
    per = 64 // BITS
    fields = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(_SIGNATURE, per, -1)
    shifts = (np.arange(per, dtype=np.uint64) * np.uint64(BITS))[None, :, None]
    return np.bitwise_or.reduce(fields << shifts, axis=1).T


def bucket_keys(low: np.ndarray) -> np.ndarray:
    """(sets, bands) hash of each band's number and minima."""
    out = np.empty((low.shape[1], BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(low.shape[1], band, dtype=np.uint64)
        for row in low[band * ROWS:(band + 1) * ROWS]:
            key = common.mix(key ^ row.astype(np.uint64))
        out[:, band] = key
    return out


_SIGNED = "doc_id bigint, n_shingles bigint, key_a bigint, key_b bigint, signature array<bigint>, buckets array<bigint>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.chunks(batches):
        sets = shingle_sets(common.column(batch, "text"))
        full = [k for k, s in enumerate(sets) if len(s)]
        key_a, key_b = np.zeros(len(sets), dtype=np.int64), np.zeros(len(sets), dtype=np.int64)
        signature, buckets = [None] * len(sets), [None] * len(sets)
        if full:
            flat = np.concatenate([sets[k] for k in full])
            first = np.cumsum([0, *(len(sets[k]) for k in full[:-1])])
            one = common.mix(flat)
            key_a[full] = np.add.reduceat(one, first).view(np.int64)
            key_b[full] = np.bitwise_xor.reduceat(common.mix(one), first).view(np.int64)
            low = minima([sets[k] for k in full])
            for k, s, b in zip(full, signatures(low).view(np.int64), bucket_keys(low).view(np.int64)):
                signature[k], buckets[k] = s, b
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(common.column(batch, "doc_id"), pa.int64()),
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "key_a": pa.array(key_a), "key_b": pa.array(key_b),
            "signature": pa.array(signature, pa.list_(pa.int64())),
            "buckets": pa.array(buckets, pa.list_(pa.int64()))})
    common.release_memory()


def estimate(a: str, b: str) -> F.Column:
    """Similarity from the equal fields of two signatures, corrected for fields that are equal by chance."""
    differing = F.lit(0)
    for k in range(_SIGNATURE):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        for shift in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(F.col(a)[k].bitwiseXOR(F.col(b)[k]), shift))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(int(_FIELDS.view(np.int64)))))
    chance = 2.0 ** -BITS
    return (1 - differing / _HASHES - chance) / (1 - chance)


def _plausible(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs (a, b, n_a, n_b) that sizes and signatures don't rule out."""
    side = lambda x: signed.select(
        F.col("rep").alias(x), F.col("signature").alias(f"signature_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(
        (100 * F.least("n_a", "n_b") >= LINK * F.greatest("n_a", "n_b"))
        & (estimate("signature_a", "signature_b") >= LINK / 100 - MARGIN)).select("a", "b", "n_a", "n_b")


def _linked(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the other full sets have a link to ``own``."""
    if not others:
        return np.zeros(0, dtype=bool)
    sizes = np.array([len(o) for o in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    shared = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * shared >= LINK * (len(own) + sizes - shared)


def _confirm_tile(group: pa.Table) -> pa.Table:
    """The pairs of a tile that are linked on their full sets; it holds the texts of its nodes once each."""
    kind = group.column("kind").to_numpy()
    node, other = group.column("a").to_pylist(), group.column("b").to_pylist()
    sets: dict[int, np.ndarray] = {}
    texts = group.select(["a", "text"]).filter(pa.array(kind == 0))
    for batch in common.chunks(iter(texts.combine_chunks().to_batches())):
        sets.update(zip(common.column(batch, "a"), shingle_sets(common.column(batch, "text"))))
    partners: dict[int, list[int]] = {}
    for k in np.flatnonzero(kind == 1):
        partners.setdefault(node[k], []).append(other[k])
    a, b = [], []
    for centre, mates in partners.items():
        linked = _linked(sets[centre], [sets[m] for m in mates])
        b += [m for m, yes in zip(mates, linked) if yes]
        a += [centre] * int(linked.sum())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) that are linked on their full sets; ``pairs`` has n_a and n_b, ``texts`` has rep and text.

    The pairs of one a are cut into tiles of about BLOCK nodes and TILE_SHINGLES shingles, to which a text is shipped once.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK, F.sum("n_b") / TILE_SHINGLES)).alias("columns"))
    dealt = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("columns")).alias("j"))
    dealt = dealt.withColumn("hub", F.col("a"))
    tile = ["hub", "j"]
    nodes = dealt.select(*tile, F.explode(F.array("a", "b")).alias("rep")).distinct().join(texts, "rep").select(
        *tile, F.lit(0).alias("kind"), F.col("rep").alias("a"), F.lit(None).cast("bigint").alias("b"), "text")
    rows = nodes.unionByName(
        dealt.select(*tile, F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("string").alias("text")))
    return rows.groupBy(*tile).applyInArrow(_confirm_tile, "a bigint, b bigint")


class _Tile:
    """Probes and targets of a bucket; ``mates(k)`` are the targets that probe k has to be held against."""

    def __init__(self, group: pa.Table):
        numbers = {n: group.column(n).to_numpy(zero_copy_only=False) for n in (
            "bucket", "rep", "component", "n_shingles", "probe", "minor")}
        self.bucket, self.rep, self.part, self.size, self.probe, self.minor = numbers.values()
        self.part = self.part.copy()
        arrays = lambda n, width: group.column(n).combine_chunks().flatten().to_numpy().reshape(
            -1, width).view(np.uint64)
        self.words, self.buckets = arrays("signature", _SIGNATURE), arrays("buckets", BANDS)
        self.targets = np.flatnonzero(~self.probe)

    def mates(self, k: int) -> np.ndarray:
        mates = self.targets
        # of two minor nodes each is a probe; the pair belongs to the smaller one
        mates = mates[(self.part[mates] != self.part[k]) & (~self.minor[mates] | (self.rep[mates] > self.rep[k]))]
        small, large = np.minimum(self.size[mates], self.size[k]), np.maximum(self.size[mates], self.size[k])
        mates = mates[100 * small >= LINK * large]
        x = self.words[mates] ^ self.words[k]
        y = x.copy()
        for shift in range(1, BITS):
            y |= x >> np.uint64(shift)
        differing = np.bitwise_count(y & _FIELDS).sum(axis=1)
        chance = 2.0 ** -BITS
        mates = mates[(1 - differing / _HASHES - chance) / (1 - chance) >= LINK / 100 - MARGIN]
        # pairs that share several buckets belong to the first
        shared = self.buckets[mates] == self.buckets[k]
        own = self.buckets[k] == self.bucket[k:k + 1].view(np.uint64)
        return mates[shared.argmax(axis=1) == own.argmax()] if len(mates) else mates


def _open_nodes(group: pa.Table) -> pa.Table:
    """The rows of a tile that take part in a pair that the signatures don't rule out."""
    tile = _Tile(group)
    needed = np.zeros(len(tile.rep), dtype=bool)
    for k in np.flatnonzero(tile.probe):
        mates = tile.mates(k)
        needed[mates] = True
        needed[k] = len(mates) > 0
    return group.filter(pa.array(needed))


def _tile_links(group: pa.Table) -> pa.Table:
    """Links between components in a tile; what a link has joined isn't compared any more."""
    tile, sets = _Tile(group), []
    for batch in common.chunks(iter(group.select(["text"]).combine_chunks().to_batches())):
        sets += shingle_sets(common.column(batch, "text"))
    a, b = [], []
    for k in np.flatnonzero(tile.probe):
        mates = tile.mates(k)
        for at in range(0, len(mates), BLOCK):
            some = mates[at:at + BLOCK]
            some = some[tile.part[some] != tile.part[k]]
            for m in some[_linked(sets[k], [sets[m] for m in some])]:
                if tile.part[m] != tile.part[k]:
                    a.append(tile.rep[k])
                    b.append(tile.rep[m])
                    tile.part[tile.part == tile.part[m]] = tile.part[k]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _residual_links(rows: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components that share a bucket; ``rows`` has bucket, rep, n_shingles, component.

    In a bucket the nodes outside its largest component are probes, and all nodes are targets. Both are cut into
    blocks; a tile holds one block of either. Signatures come first, texts only of nodes that may have a link.
    """
    counts = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    blocks = lambda n, w: F.ceil(F.greatest(n / BUCKET_BLOCK, w / TILE_SHINGLES))
    mixed = counts.groupBy("bucket").agg(
        F.sum("n").alias("all"), F.sum("w").alias("w"), F.max(F.struct("n", "component", "w")).alias("major"),
        F.count("*").alias("parts")).where("parts > 1").select(
        "bucket", F.col("major.component").alias("major"), blocks(F.col("all"), F.col("w")).alias("columns"),
        blocks(F.col("all") - F.col("major.n"), F.col("w") - F.col("major.w")).alias("rows"))
    own = rows.join(mixed, "bucket").withColumn("minor", F.col("component") != F.col("major"))
    row, column = F.pmod(F.xxhash64("rep"), F.col("rows")), F.pmod(F.xxhash64("rep"), F.col("columns"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    plain = ["bucket", "rep", "component", "minor"]
    spread = own.where("minor").select(*plain, F.lit(True).alias("probe"), row.alias("i"), each("columns").alias("j")).unionByName(
        own.select(*plain, F.lit(False).alias("probe"), each("rows").alias("i"), column.alias("j")))
    tiles = spread.join(signed.select("rep", "signature", "n_shingles", "buckets"), "rep")
    needed = tiles.groupBy("bucket", "i", "j").applyInArrow(_open_nodes, tiles.schema)
    return needed.join(texts, "rep").groupBy("bucket", "i", "j").applyInArrow(_tile_links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links reach, the document's own included; kept means that it is its own.
    Documents without words, or without a text, have no shingles and are linked with nothing. Rows that repeat a
    doc_id are one document. A row with a NULL doc_id belongs to the component of its exact copies, if these have
    an id, and is otherwise kept alone with a NULL component_id.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = written_table(narrow.mapInArrow(_sign, _SIGNED), "signed")
    keys = ["n_shingles", "key_a", "key_b"]
    classes = signed.where("n_shingles > 0").groupBy(*keys).agg(F.min("doc_id").alias("rep"))
    reps = written_table(
        signed.where("n_shingles > 0").join(
            classes.select(F.col("rep").alias("doc_id"), *keys), ["doc_id", *keys], "left_semi")
        .dropDuplicates(["doc_id", *keys]).withColumnRenamed("doc_id", "rep"), "classes")
    buckets = reps.select("rep", "n_shingles", F.explode("buckets").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    mates = written_table(buckets.join(shared, "bucket"), "bucket-mates")

    degree = mates.groupBy("rep").agg(F.sum("size").alias("degree"))
    ranked = mates.join(degree, "rep").withColumn("rank", F.struct("degree", -F.col("rep")))
    centres = ranked.groupBy("bucket").agg((-F.max("rank")["col2"]).alias("centre"))
    centred = written_table(
        mates.join(centres, "bucket").join(degree.select(F.col("rep").alias("centre"), "degree"), "centre")
        .select("bucket", "rep", "centre", "degree"), "bucket-centres")
    mated = written_table(mates.select(F.col("rep").alias("doc_id")).distinct(), "mated")
    texts = written_table(
        narrow.join(common.checked_side(mated, BROADCAST_ROWS), "doc_id", "left_semi")
        .withColumnRenamed("doc_id", "rep").dropDuplicates(["rep"]), "mated-texts")

    best = centred.groupBy("rep").agg(F.max(F.struct("degree", -F.col("centre")))["col2"].alias("c")).select(
        (-F.col("c")).alias("a"), F.col("rep").alias("b")).where("a != b")
    first = _plausible(best, reps)
    links = written_table(_confirmed(first, texts), "links")
    labels = components(links)
    in_parts = lambda: mates.select("bucket", "rep", "n_shingles").join(
        labels.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    parts = in_parts()
    apart = parts.join(centred.select("bucket", "rep", "centre"), ["bucket", "rep"]).join(
        parts.select("bucket", F.col("rep").alias("centre"), F.col("component").alias("other")), ["bucket", "centre"])
    second = apart.where("component != other").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    links = links.unionByName(written_table(
        _confirmed(_plausible(second, reps), texts), "links"))
    labels = components(links)
    links = links.unionByName(written_table(_residual_links(in_parts(), reps, texts), "links"))
    labels = components(links)

    of_class = reps.select("rep", *keys).join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        *keys, F.coalesce("component", "rep").alias("component"))
    joined = signed.select("doc_id", *keys).join(of_class, keys, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))
