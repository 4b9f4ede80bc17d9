"""Fingerprints of documents: invertible Bloom lookup tables of paragraph digests.

A paragraph is a run of words up to the end of its line or to a word whose digest is divisible by ``MARK``, so that an
edit changes the paragraphs around it only. A sketch has three hash functions and a cell for each hash value: the number
of digests, their XOR and the XOR of their check sums. Cells of two versions subtract; peeling the cells that hold
one digest recovers the digests in which the versions differ. Where it doesn't come to an end, both
versions are sketched anew with four times the cells.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailseq.llm import common
from trailseq.session import written_table

MARK = 12
HASHES = 3
#: Cells of each hash function in a stored fingerprint.
STORED = 8
GROWTH = 4


def paragraphs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all paragraphs and the text of each; the n-th copy of a paragraph has a digest of its own."""
    words = common.Words(texts)
    n = len(words.hashes)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(words.data, dtype=np.uint8)
    lines = np.cumsum(raw == 0x0A)[words.starts]
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    first = np.ones(n, dtype=bool)
    first[1:] = (lines[1:] != lines[:-1]) | (words.hashes[:-1] % np.uint64(MARK) == 0)
    starts = np.flatnonzero(first)
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    with np.errstate(over="ignore"):
        parts = words.hashes * (common.mix(place.astype(np.uint64)) | np.uint64(1))
        digests = common.mix(np.add.reduceat(parts, starts))
    of = owner[starts]
    order = np.lexsort((digests, of))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (of[order][1:] == of[order][:-1]) & (digests[order][1:] == digests[order][:-1])
    run = np.arange(len(order))
    copy = run - np.maximum.accumulate(np.where(same, 0, run))
    with np.errstate(over="ignore"):
        numbered = np.where(copy > 0, common.mix(digests[order] + copy.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)),
                            digests[order])
    return numbered, of[order]


class Sketches:
    """Tables of several texts: counts, XOR of digests, XOR of check sums, each (texts, HASHES * size)."""

    def __init__(self, n: int, size: int):
        self.n, self.size, self.cells = n, size, HASHES * size
        self.count = np.zeros(n * self.cells, dtype=np.int32)
        self.key = np.zeros(n * self.cells, dtype=np.uint64)
        self.check = np.zeros(n * self.cells, dtype=np.uint32)

    def toggle(self, digests: np.ndarray, owner: np.ndarray, sign) -> None:
        check = check_sum(digests)
        for k in range(HASHES):
            with np.errstate(over="ignore"):
                slot = (common.mix(digests + np.uint64(k + self.size)) % np.uint64(self.size)).astype(np.int64)
            at = owner * self.cells + k * self.size + slot
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, digests)
            np.bitwise_xor.at(self.check, at, check)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.n, self.size)
        out.count = self.count - other.count
        out.key, out.check = self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Whether each table came to an end, and what was recovered: (table, digest, sign) by round."""
        found = []
        for _ in range(10 * self.cells + 10):
            pure = np.flatnonzero((np.abs(self.count) == 1) & (check_sum(self.key) == self.check))
            if not len(pure):
                break
            table, digest, sign = pure // self.cells, self.key[pure], self.count[pure]
            order = np.lexsort((digest, table))
            table, digest, sign = table[order], digest[order], sign[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (table[1:] != table[:-1]) | (digest[1:] != digest[:-1])
            table, digest, sign = table[new], digest[new], sign[new]
            self.toggle(digest, table, -sign)
            found.append((table, digest, sign))
        rest = (self.count != 0) | (self.key != 0) | (self.check != 0)
        return ~rest.reshape(self.n, self.cells).any(axis=1), found


def check_sum(digests: np.ndarray) -> np.ndarray:
    return (common.mix(digests ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


def sketch(digests: np.ndarray, owner: np.ndarray, n: int, size: int) -> Sketches:
    out = Sketches(n, size)
    out.toggle(digests, owner, np.int32(1))
    return out


def differences(a: np.ndarray, a_of: np.ndarray, b: np.ndarray, b_of: np.ndarray, n: int,
                size: int = STORED) -> np.ndarray:
    """Number of digests that only one version of each of n pairs has, by subtracting and peeling tables."""
    out = np.zeros(n, dtype=np.int64)
    active = np.arange(n)
    totals = np.bincount(a_of, minlength=n) + np.bincount(b_of, minlength=n)
    while len(active):
        tables = sketch(a, a_of, len(active), size).minus(sketch(b, b_of, len(active), size))
        ended, found = tables.peel()
        got = np.zeros(len(active), dtype=np.int64)
        for table, _, _ in found:
            got += np.bincount(table, minlength=len(active))
        out[active[ended]] = got[ended]
        size *= GROWTH
        place = np.cumsum(~ended) - 1
        keep_a, keep_b = ~ended[a_of], ~ended[b_of]
        a, a_of, b, b_of = a[keep_a], place[a_of[keep_a]], b[keep_b], place[b_of[keep_b]]
        active = active[~ended]
        if len(active) and size > 4096 * (1 + totals[active].max()):
            raise ValueError("tables don't peel: digests collide")
    return out


def likeness(size_a: np.ndarray, size_b: np.ndarray, differing: np.ndarray) -> np.ndarray:
    """Shared paragraphs by all paragraphs, 1.0 for two texts without any."""
    shared = (size_a + size_b - differing) / 2
    union = size_a + size_b - shared
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)


def stored(digests: np.ndarray, owner: np.ndarray, n: int) -> list[str]:
    """Fingerprints as text: number of paragraphs, then the cells' counts, digests and check sums in base64."""
    tables, sizes = sketch(digests, owner, n, STORED), np.bincount(owner, minlength=n)
    count = tables.count.astype("<i4").reshape(n, -1)
    key, check = tables.key.astype("<u8").reshape(n, -1), tables.check.astype("<u4").reshape(n, -1)
    return [f"{sizes[i]}:" + base64.b64encode(
        count[i].tobytes() + key[i].tobytes() + check[i].tobytes()).decode() for i in range(n)]


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def compare(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """Rows for texts and what follows each. ``following`` is often ``texts[1:]`` plus one."""
    n = len(texts)
    chained = following[:-1] == texts[1:]
    versions = [edited(t, f) for t, f in zip(texts, following)]
    whole, whole_of = paragraphs(texts + following[-1:] if chained else texts + following)
    changed, changed_of = paragraphs(versions)
    own, own_of = whole[whole_of < n], whole_of[whole_of < n]
    skip = 1 if chained else n
    later, later_of = whole[whole_of >= skip], whole_of[whole_of >= skip] - skip
    sizes = [np.bincount(x, minlength=n) for x in (own_of, changed_of, later_of)]
    return common.rows(
        _RESULT, doc_id=ids, n_chars=[len(t) for t in texts],
        edited_sha256=[common.sha256_hex(v) for v in versions],
        fingerprint=stored(own, own_of, n), edited_fingerprint=stored(changed, changed_of, n),
        near_edited=likeness(sizes[0], sizes[1], differences(own, own_of, changed, changed_of, n)),
        near_next=likeness(sizes[0], sizes[2], differences(own, own_of, later, later_of, n)))


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of sorted ranges but the last of each, each with the row that follows."""
    held: tuple = ([], [], [])
    for batch in common.chunks(batches, limit=COMPARED_CHARS):
        got = (common.column(batch, "part"), common.column(batch, "doc_id"), common.column(batch, "text"))
        parts, ids, texts = (h + g for h, g in zip(held, got))
        texts = [t or "" for t in texts]
        cuts = [0, *(k for k in range(1, len(parts)) if parts[k] != parts[k - 1]), len(parts)]
        for start, end in zip(cuts, cuts[1:]):
            if end - start > 1:
                yield compare(ids[start:end - 1], texts[start:end - 1], texts[start + 1:end])
        held = (parts[-1:], ids[-1:], texts[-1:])
    common.release_memory()


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.chunks(batches, limit=COMPARED_CHARS):
        texts = [[t or "" for t in common.column(batch, c)] for c in ("text", "next_text")]
        yield compare(common.column(batch, "doc_id"), *texts)
    common.release_memory()


#: Characters of texts that are compared at once; their arrays take about a hundred times as many bytes.
COMPARED_CHARS = 500_000
#: Ranges of ids for each shuffle partition.
RANGES = 4
_NULL_ID = -(1 << 63)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how like they and the next text are.

    The next document is the one with the next larger doc_id (after the last: the first); rows with equal ids follow
    each other in the order of their texts, NULL ids come first. A NULL text counts as empty. A single
    document follows itself. Columns other than doc_id and text are ignored.

    Quantiles of the ids, a few for each shuffle partition, cut the documents into ranges. Texts move once,
    by range; the last text of a range is matched with the first of the next one through a broadcast of one row
    per range.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL_ID))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       at.alias("at"))
    n = RANGES * parts
    found = rows.agg(F.percentile_approx("at", [k / n for k in range(1, n)], 100 * n).alias("q")).first()["q"]
    bounds = np.unique(np.array(found or [], dtype=np.int64))

    @F.arrow_udf("int")
    def part(values: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, values.to_numpy(zero_copy_only=False), side="right"), pa.int32())

    edges = rows.select("at", part("at").alias("part")).groupBy("part").agg(
        F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    in_order = Window.orderBy("part")  # one narrow row per range
    edges = written_table(edges.select("last_at", F.coalesce(
        F.lead("first_at").over(in_order), F.first("first_at").over(in_order)).alias("next_at")), "range-edges")
    last = rows.join(F.broadcast(edges), F.col("at") == F.col("last_at")).groupBy("last_at", "next_at").agg(
        F.max("text").alias("text"))
    first = rows.join(F.broadcast(edges.select("next_at")), F.col("at") == F.col("next_at")).groupBy("next_at").agg(
        F.min("text").alias("next_text"))
    across = last.join(first, "next_at").select(
        F.nullif("last_at", F.lit(_NULL_ID)).alias("doc_id"), "text", "next_text").mapInArrow(_across, RESULT)
    within = (
        rows.select("doc_id", "text", "at", part("at").alias("part"))
        .repartition(parts, "part").sortWithinPartitions("part", "at", "text")
        .select("part", "doc_id", "text").mapInArrow(_within, RESULT))
    return within.unionByName(across)
