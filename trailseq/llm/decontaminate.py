"""Benchmark decontamination: passages of documents that are within a few word edits of a benchmark item.

Windows of an item's size are embedded by the CGK random walk: at each step the walk puts out the word it
stands on and, by a hash of step and word, stays or moves on, so that few edits become few differing steps. A
repetition has a walk of its own, which sets out at a word of the window that is drawn for the size, and samples some of
its first steps; a window is a candidate for an item if all sampled words are equal in any repetition. Only candidates
are aligned, which gives the exact number of edits.

Walks of two texts that have come apart by a deleted word seldom meet again, so one walk over a long window sees
little of it; walks that set out all over the window each ask for a few unchanged words only. With every fifth word
edited, however evenly, a repetition agrees if it sets out in one of the unchanged stretches and its steps stay there,
which has a chance of about a half at any size, so that all REPETITIONS hardly ever miss.

Only windows that can reach the bound are embedded: an item cut into one more block than edits are allowed has an
unchanged block in every such passage, so a seed of the item (4 words, or 1 to 3 where blocks are that short) must be
there at its place, give or take the edits. The seeds also say where windows begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailseq.llm import common

#: Words of a seed at most.
SEED = 4
#: Share of an item's words that may be edited (inserted, deleted or replaced).
EDITS = 0.2
#: Repetitions: walks, each with its start, its run of steps and the steps that it samples.
REPETITIONS = 32
RUN = 5
STEPS = 2
#: Seeds and windows that are worked on at a time.
BLOCK_WINDOWS = 1_000_000
#: Characters of benchmark text that are searched for, and broadcast, at a time.
BLOCK_CHARS = 8_000_000

FOUND = "array<struct<item_id: bigint, start: bigint, length: bigint, edits: bigint>>"


def allowed(words: int) -> int:
    """Edits allowed in an item of so many words."""
    return int(words * EDITS)


def seed_size(words: int) -> int:
    """Words of a seed of an item of so many words: such that one of the unchanged blocks has a seed."""
    return min(SEED, words // (allowed(words) + 1))


def walk(words: np.ndarray, at: np.ndarray, first: np.ndarray, end: np.ndarray, repetition: int) -> np.ndarray:
    """(RUN, n) words that CGK walks put out which set out at ``at``; 0 outside of ``first`` to ``end`` (exclusive)."""
    at, out = at.copy(), np.empty((RUN, len(at)), dtype=np.uint64)
    for step in range(RUN):
        inside = (at >= first) & (at < end)
        word = np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(0))
        out[step] = word
        salt = common.mix(np.array([repetition * 1_000_003 + step], dtype=np.uint64))[0]
        at += ((common.mix(word ^ salt) >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
    return out


def sample_keys(words: np.ndarray, start: np.ndarray, size: np.ndarray, first: np.ndarray, last: np.ndarray,
                repetition: int) -> np.ndarray:
    """A hash of the steps that ``repetition`` samples of each window; 0 if its walk sets out outside of the text."""
    draw = common.mix(np.arange(STEPS + 1, dtype=np.uint64) + np.uint64((STEPS + 1) * repetition))
    offset = (draw[0] % size.astype(np.uint64)).astype(np.int64)
    steps = walk(words, start + offset, np.maximum(first, start), np.minimum(last, start + size), repetition)
    # the first step, and one that is drawn among the others
    key = common.mix(steps[0] ^ np.uint64(repetition + 1))
    for k in range(1, STEPS):
        key = common.mix(key ^ steps[1 + int(draw[k] % np.uint64(RUN - 1))])
    return np.where(steps[0] != 0, key, np.uint64(0))


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Fewest edits of ``item`` against any stretch of ``words``, and start and length of the first such stretch."""
    m = len(words)
    place = np.arange(m + 1)
    cost, start = np.zeros(m + 1, dtype=np.int64), place.copy()
    for k, word in enumerate(item):
        diagonal = cost[:-1] + (words != word)
        above = cost[1:] + 1
        best = np.concatenate(([k + 1], np.minimum(diagonal, above)))
        origin = np.concatenate(([0], np.where(diagonal <= above, start[:-1], start[1:])))
        # inserted words: the best cell to the left, one more for each step
        level = best - place
        low = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == low, place, 0))
        source = np.where(level == low, place, source)
        cost, start = low + place, origin[source]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end - int(start[end])


def _counted(rows: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Distinct columns of (text, item, start), sorted, with the sum of their weights as a fourth row."""
    order = np.lexsort(rows[::-1])
    rows = rows[:, order]
    weights = np.ones(len(order), dtype=np.int64) if weights is None else weights[order]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(rows, axis=1) != 0).any(axis=0)))[:len(order)])
    sums = np.add.reduceat(weights, first) if len(first) else weights
    return np.concatenate([rows[:, first], sums[None, :]])


class Items:
    """Benchmark items with their seeds and sample keys."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        words = common.Words(texts, lower=True)
        self.words = [words.hashes[a:b] for a, b in zip(words.first, words.first[1:])]
        self.ids = ids
        self.sizes = np.diff(words.first)
        self.slack = np.array([allowed(n) for n in self.sizes.tolist()], dtype=np.int64)
        self.seed = np.array([seed_size(n) for n in self.sizes.tolist()], dtype=np.int64)
        owner = np.repeat(np.arange(len(ids)), self.sizes)
        #: By words of a seed: sorted seeds, item and offset of each, and which upper bits they have.
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({n for n in self.seed.tolist() if n}):
            seeds, whole = words.windows(n)
            at = np.flatnonzero(whole & (self.seed[owner] == n))
            at = at[np.argsort(seeds[at], kind="stable")]
            known = np.zeros(1 << 22, dtype=bool)
            known[seeds[at] >> np.uint64(42)] = True
            self.seeds[n] = seeds[at], owner[at], at - words.first[owner[at]], known
        of = words.first[:-1]
        some = np.flatnonzero(self.sizes > 0)
        #: (repetitions, items) keys of the items themselves.
        self.keys = np.zeros((REPETITIONS, len(ids)), dtype=np.uint64)
        for r in range(REPETITIONS):
            if len(some):
                self.keys[r, some] = sample_keys(
                    words.hashes, of[some], self.sizes[some], of[some], of[some] + self.sizes[some], r)

    def _seeded(self, words: common.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, item, start) that seeds point to, sorted, and the number of seeds."""
        parts = [np.zeros((4, 0), dtype=np.int64)]
        for n, (seeds, owner, offset, known) in self.seeds.items():
            digests, whole = words.windows(n)
            at = np.flatnonzero(whole & known[digests >> np.uint64(42)])
            low = np.searchsorted(seeds, digests[at], side="left")
            count = np.searchsorted(seeds, digests[at], side="right") - low
            at, low, count = at[count > 0], low[count > 0], count[count > 0]
            so_far, begin = np.cumsum(count), 0
            while begin < len(at):
                before = int(so_far[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(so_far, before + BLOCK_WINDOWS, side="right")))
                some, many = slice(begin, end), count[begin:end]
                hit = np.repeat(low[some], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                place = np.repeat(at[some], many)
                text = np.searchsorted(words.first, place, side="right") - 1
                parts.append(_counted(np.stack([text, owner[hit], place - offset[hit]])))
                if len(parts) > 8:
                    parts = [_counted(np.concatenate([p[:3] for p in parts], axis=1), np.concatenate([p[3] for p in parts]))]
                begin = end
        whole = _counted(np.concatenate([p[:3] for p in parts], axis=1), np.concatenate([p[3] for p in parts]))
        return whole[0], whole[1], whole[2], whole[3]

    def hits(self, words: common.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, item, start) by seeds, where enough seeds of the item lie around for one within the bound."""
        text, item, start, seeds = self._seeded(words)
        # an edit changes at most as many seeds as one has words, and seeds of one passage are at most twice the edits apart
        slack, seed = self.slack[item], self.seed[item]
        need = np.maximum(self.sizes[item] - seed + 1 - seed * slack, 1)
        pair = np.cumsum(np.concatenate(([0], (np.diff(text) != 0) | (np.diff(item) != 0)))[:len(text)])
        place = pair * (1 << 40) + start
        total = np.concatenate(([0], np.cumsum(seeds)))
        around = (total[np.searchsorted(place, place + 2 * slack, side="right")]
                  - total[np.searchsorted(place, place - 2 * slack, side="left")])
        kept = around >= need
        return text[kept], item[kept], start[kept]

    def candidates(self, words: common.Words) -> Iterator[tuple[int, int, int]]:
        """(text, item, start) of seeded windows that agree with their item in a repetition, sorted."""
        text, item, start = self.hits(words)
        for begin in range(0, len(text), BLOCK_WINDOWS):
            some = slice(begin, begin + BLOCK_WINDOWS)
            t, k, s = text[some], item[some], start[some]
            agree = np.zeros(len(t), dtype=bool)
            for r in range(REPETITIONS):
                left = np.flatnonzero(~agree)
                own = sample_keys(words.hashes, s[left], self.sizes[k[left]], words.first[t[left]], words.first[t[left] + 1], r)
                agree[left] = (own == self.keys[r, k[left]]) & (own != 0)
            yield from zip(t[agree].tolist(), k[agree].tolist(), s[agree].tolist())

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """Items found in each text, each once, at its best place."""
        found: list[dict[int, dict]] = [{} for _ in texts]
        words = common.Words(texts, lower=True)
        self._verify(self.candidates(words), words, found)
        return [[f[k] for k in sorted(f)] for f in found]

    def _verify(self, candidates, words: common.Words, found: list[dict[int, dict]]) -> None:
        """Align the sorted ``candidates`` (text, item, start); a passage starts at most the edits before or after."""
        covered: dict[tuple[int, int], int] = {}
        for text, item, start in candidates:
            best = found[text].get(item)
            if best and best["edits"] == 0:  # the first, as candidates are sorted
                continue
            size, slack = int(self.sizes[item]), int(self.slack[item])
            first, last = int(words.first[text]), int(words.first[text + 1])
            if covered.get((text, item), -1) >= min(last, start + size + 2 * slack):
                continue
            begin, end = max(first, start - slack), min(last, start + size + 4 * slack)
            covered[text, item] = end
            edits, at, length = align(self.words[item], words.hashes[begin:end])
            place = {"item_id": self.ids[item], "start": begin - first + at, "length": length, "edits": edits}
            if edits <= slack and (best is None or (edits, place["start"]) < (best["edits"], best["start"])):
                found[text][item] = place


def mark(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All rows of ``docs`` with ``found``: benchmark items (item_id, start, length, edits) that the text contains.

    ``start`` and ``length`` are in words (split at ASCII white space, A-Z lowered); an item is listed once, at the
    place with the fewest edits. Items without a word or an id are in no document; those of under 5 words must be there
    without an edit. Items that repeat are listed by each id. The benchmark is searched for in blocks of about ``block_chars`` characters, a pass
    over the documents each, so what is broadcast doesn't grow. A NULL text contains nothing; a column named
    found is replaced.
    """
    docs = docs.drop("found").withColumn("found", F.array().cast(FOUND))
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where(
        "item_id is not null and text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    for block in range(blocks):
        rows = sorted(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect())
        shared = docs.sparkSession.sparkContext.broadcast(
            Items([r["item_id"] for r in rows], [r["text"] for r in rows]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in common.chunks(batches):
                at = batch.schema.get_field_index("found")
                more = shared.value.search(common.column(batch, "text"))
                both = pa.array([(a or []) + b for a, b in zip(common.column(batch, "found"), more)],
                                type=pa.list_(pa.struct([(n, pa.int64()) for n in (
                                    "item_id", "start", "length", "edits")])))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:at], both, *batch.columns[at + 1:]], names=batch.schema.names)
            common.release_memory()

        docs = docs.mapInArrow(run, T.StructType([
            T.StructField(f.name, f.dataType) if f.name == "found" else f for f in docs.schema]))
    return docs


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, length, edits), a row for each item that a document contains."""
    marked = mark(docs.select("doc_id", "text"), benchmark).select("doc_id", F.explode("found").alias("f"))
    return marked.select("doc_id", "f.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    return mark(docs, benchmark).where(F.size("found") == 0).select(*docs.columns)
