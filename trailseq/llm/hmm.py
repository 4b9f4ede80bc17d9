"""Hidden Markov language model over words.

All training words are counted. Words that make up at least ``SYMBOL_SHARE`` of them are symbols of their own, the
others share one symbol and a smoothed word distribution below it, and the end of a text is a symbol too. Baum-Welch
adds the expected counts of all training texts over the partitions; the tables that the driver gathers are bounded
by 1 / SYMBOL_SHARE symbols. The scaled forward recursion then gives the exact likelihood of a whole text.

A text's words are looked up in two ways: those of a share of at least ``HEAD_SHARE`` in a broadcast table of at
most 1 / HEAD_SHARE words of at most ``HEAD_BYTES`` bytes, all others by a join with the counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailseq.llm import common
from trailseq.session import written_table

SYMBOL_SHARE = 1e-4
HEAD_SHARE = 1e-6
HEAD_BYTES = 64
STATES = 8
ITERATIONS = 6
#: Start of training: how long states last, and the spread of the factors by which they differ.
STAY = 0.9
SPREAD = 2.0
SMOOTHING = 0.1
#: Training texts are cut into stretches of so many symbols; the forward recursion of scoring isn't.
STRETCH = 64
#: Words that a counting task holds before it hands them on, and symbols that a scoring step holds.
HELD_WORDS = 300_000
HELD_SYMBOLS = 2_000_000
RARE, END = 0, 1  # the first symbols


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: lowers A-Z only


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "word": pa.array(list(counter), pa.binary()), "n": pa.array(list(counter.values()), pa.int64())})
    counter: Counter = Counter()
    for batch in common.chunks(batches):
        for text in common.column(batch, "text"):
            counter.update(words_of(text))
        if len(counter) > HELD_WORDS:
            yield out()
            counter.clear()
    yield out()


@dataclass
class Vocabulary:
    """Counts of the training tokens. ``head``: word -> (symbol, log10 of count + smoothing)."""

    counts: DataFrame
    documents: int
    words: int
    distinct: int
    head: dict[bytes, tuple[int, float]]
    frequency: np.ndarray  # training count of each symbol
    rare_words: int
    rare_distinct: int

    @property
    def tokens(self) -> int:
        return self.words + self.documents

    @property
    def log_all(self) -> float:
        """log10 of the denominator of the base score; the end of a text is a distinct token."""
        distinct = self.distinct + (self.documents > 0)
        return math.log10(self.tokens + SMOOTHING * (distinct + 1))

    @property
    def log_rare(self) -> float:
        return math.log10(self.rare_words + SMOOTHING * (self.rare_distinct + 1))


def vocabulary(docs: DataFrame) -> Vocabulary:
    """Count the words of all rows of ``docs``."""
    counts = written_table(
        docs.select("text").mapInArrow(_count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")),
        "word-counts")
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    short = F.octet_length("word") <= HEAD_BYTES
    head = counts.where(short & (F.col("n") >= max(1.0, HEAD_SHARE * words))).toArrow().sort_by(
        [("n", "descending"), ("word", "ascending")])
    table, symbols, common_words, frequency = {}, 2, 0, []
    for word, n in zip(head.column("word").to_pylist(), head.column("n").to_pylist()):
        own = n >= SYMBOL_SHARE * words
        table[word] = (symbols if own else RARE, math.log10(n + SMOOTHING))
        if own:
            symbols += 1
            common_words += n
            frequency.append(n)
    documents, rare = docs.count(), words - common_words
    return Vocabulary(counts, documents, words, distinct, table,
                      np.array([rare + SMOOTHING, documents + SMOOTHING, *frequency]), rare, distinct - (symbols - 2))


_ENCODED = ("row_id bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_head bigint, head_log double, "
            "n_rare bigint, rare_log double, symbols array<int>, tail array<struct<word: binary, n: int>>")


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Symbols of every text, sums over its head words, and its other words with their number."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab.head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, row = shared.value, TaskContext.get().partitionId() << 33
        nothing = (-1, 0.0)
        for batch in common.chunks(batches):
            out: dict[str, list] = {k: [] for k in (
                "n_tokens", "n_head", "head_log", "n_rare", "rare_log", "symbols", "tail")}
            for text in common.column(batch, "text"):
                words = words_of(text)
                looked = [head.get(w, nothing) for w in words]
                symbols = np.array([x[0] for x in looked] + [END], dtype=np.int32)
                logs = np.array([x[1] for x in looked] + [0.0])
                tail = Counter(w for w, x in zip(words, looked) if x[0] < 0) if (symbols < 0).any() else {}
                out["n_tokens"].append(len(words) + 1)
                out["n_head"].append(int((symbols >= 0).sum()) - 1)
                out["head_log"].append(float(logs.sum()))
                out["rare_log"].append(float(logs[symbols == RARE].sum()))
                symbols = np.maximum(symbols, RARE)
                out["n_rare"].append(int((symbols == RARE).sum()))
                out["symbols"].append(symbols)
                out["tail"].append([{"word": w, "n": n} for w, n in tail.items()])
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict({
                "row_id": pa.array(range(row, row + n), pa.int64()),
                "doc_id": pa.array(common.column(batch, "doc_id"), pa.int64()),
                "held_out": pa.array(common.column(batch, "held_out"), pa.bool_()),
                "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                "n_head": pa.array(out["n_head"], pa.int64()),
                "head_log": pa.array(out["head_log"], pa.float64()),
                "n_rare": pa.array(out["n_rare"], pa.int64()),
                "rare_log": pa.array(out["rare_log"], pa.float64()),
                "symbols": pa.array(out["symbols"], pa.list_(pa.int32())),
                "tail": pa.array(out["tail"], pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))),
            })
            row += n
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "text").mapInArrow(run, _ENCODED)


@dataclass
class Model:
    start: np.ndarray  # (K,) state of the first symbol
    move: np.ndarray  # (K, K) next state by state
    emit: np.ndarray  # (symbols, K) symbol by state

    @classmethod
    def initial(cls, frequency: np.ndarray, states: int) -> Model:
        """States that last, each with the symbols' frequencies times a factor drawn from a hash."""
        noise = common.mix(np.arange(states * len(frequency), dtype=np.uint64)) / 2.0 ** 64
        emit = frequency[:, None] * np.exp(SPREAD * (noise.reshape(len(frequency), states) - 0.5))
        move = np.full((states, states), (1 - STAY) / states) + STAY * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))

    def resting(self) -> np.ndarray:
        """Share of time spent in each state; where a stretch begins inside a text."""
        power = np.linalg.matrix_power(self.move, 64)
        return power.mean(axis=0)

    def log10(self, texts: list[np.ndarray]) -> np.ndarray:
        """Exact log10 likelihood of whole symbol sequences by the scaled forward recursion."""
        out = np.zeros(len(texts))
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order])
        flat = np.concatenate([texts[i] for i in order]) if len(order) else np.zeros(0, dtype=np.int64)
        first = np.cumsum(lengths) - lengths
        active = int((lengths > 0).sum())
        step, emit = np.ascontiguousarray(self.move.T), np.ascontiguousarray(self.emit.T)
        alpha = np.repeat(self.start[:, None], active, axis=1)
        logs = np.zeros(len(order))
        t = 0
        while active:
            if t:
                alpha = step @ alpha[:, :active]
            alpha *= emit.take(flat[first[:active] + t], axis=1)
            scale = alpha.sum(axis=0)
            alpha /= scale
            logs[:active] += np.log10(scale)
            t += 1
            while active and lengths[active - 1] <= t:
                active -= 1
        out[order] = logs
        return out


def expected_counts(model: Model, stretches: np.ndarray, lengths: np.ndarray, begins: np.ndarray):
    """Expected starts, moves and emissions of symbol stretches (n, T), padded behind ``lengths``."""
    order = np.argsort(-lengths, kind="stable")
    symbols, lengths, begins = np.ascontiguousarray(stretches[order].T), lengths[order], begins[order]
    size, n = symbols.shape
    states = len(model.start)
    active = [int(np.searchsorted(-lengths, -t)) for t in range(size + 1)]  # stretches longer than t
    step, back = np.ascontiguousarray(model.move.T.astype(np.float32)), model.move.astype(np.float32)
    emit = np.ascontiguousarray(model.emit.T.astype(np.float32)).take(symbols, axis=1)  # (states, T, n)
    alpha = np.empty((size, states, n), dtype=np.float32)
    inverse = np.ones((size, n), dtype=np.float32)
    first = np.where(begins, model.start[:, None], model.resting()[:, None]).astype(np.float32)
    for t in range(size):
        k = active[t]
        np.multiply(step @ alpha[t - 1, :, :k] if t else first[:, :k], emit[:, t, :k], out=alpha[t, :, :k])
        np.divide(1, alpha[t, :, :k].sum(axis=0), out=inverse[t, :k])
        alpha[t, :, :k] *= inverse[t, :k]
    moves = np.zeros((states, states))
    beta = np.ones((states, n), dtype=np.float32)
    for t in range(size - 1, -1, -1):
        k = active[t + 1]
        if k:
            ahead = emit[:, t + 1, :k] * beta[:, :k] * inverse[t + 1, :k]
            moves += alpha[t, :, :k] @ ahead.T
            beta[:, :k] = back @ ahead
        alpha[t, :, :active[t]] *= beta[:, :active[t]]
        alpha[t, :, :active[t]] /= alpha[t, :, :active[t]].sum(axis=0)
    used = np.concatenate([symbols[t, :active[t]] for t in range(size)])
    emissions = np.zeros((len(model.emit), states))
    for k in range(states):
        gamma = np.concatenate([alpha[t, k, :active[t]] for t in range(size)])
        emissions[:, k] = np.bincount(used, weights=gamma, minlength=len(model.emit))
    return alpha[0][:, begins].sum(axis=1, dtype=float), moves * model.move, emissions


def _stretches(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into stretches of STRETCH symbols, padded with symbol 0."""
    sizes = np.array([len(t) for t in texts])
    per = -(-sizes // STRETCH)
    out = np.zeros((int(per.sum()), STRETCH), dtype=np.int64)
    first = np.cumsum(per) - per
    flat = np.concatenate(texts)
    at = np.repeat(first * STRETCH, sizes) + np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out.reshape(-1)[at] = flat
    lengths = np.full(len(out), STRETCH)
    lengths[first + per - 1] = sizes - (per - 1) * STRETCH
    begins = np.zeros(len(out), dtype=bool)
    begins[first] = True
    return out, lengths, begins


def _symbol_lists(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Row ids and symbols of about ``most`` symbols at a time."""
    ids, texts, held = [], [], 0
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("symbols"))
        values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(
            column.value_lengths().to_numpy(zero_copy_only=False))
        for row, end, text in zip(common.column(batch, "row_id"), ends, np.split(values, ends[:-1])):
            ids.append(row)
            texts.append(text)
            held += len(text)
            if held >= most:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def learn(encoded: DataFrame, vocab: Vocabulary, states: int = STATES, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over all training rows of ``encoded``; each round adds counts over the partitions."""
    spark = encoded.sparkSession
    model = Model.initial(vocab.frequency, states)
    training = encoded.where("not held_out").select("row_id", "symbols")
    schema = "slot int, " + ", ".join(f"s{k} double" for k in range(states))
    for _ in range(iterations if vocab.documents else 0):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            total = np.zeros((1 + states + len(own.emit), states))
            for _, texts in _symbol_lists(batches, HELD_SYMBOLS // 16):
                start, moves, emissions = expected_counts(own, *_stretches(texts))
                total += np.vstack([start[None, :], moves, emissions])
            slots = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_pydict(
                {"slot": pa.array(slots, pa.int32())} | {f"s{k}": pa.array(total[slots, k]) for k in range(states)})

        sums = training.mapInArrow(run, schema).groupBy("slot").agg(
            *(F.sum(f"s{k}").alias(f"s{k}") for k in range(states))).toArrow()
        total = np.zeros((1 + states + len(vocab.frequency), states))
        total[sums.column("slot").to_numpy()] = np.stack(
            [sums.column(f"s{k}").to_numpy() for k in range(states)], axis=1)
        total += SMOOTHING
        start, moves, emissions = total[0], total[1:1 + states], total[1 + states:]
        model = Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emissions / emissions.sum(axis=0))
    return model


def score(docs: DataFrame, folds: int = 10, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """log10 probabilities of all texts under the model learned from those of the other folds.

    Trains on the rows whose crc32(doc_id) modulo ``folds`` isn't 0 (a NULL doc_id is held out). Returns doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score and score, a row per row of ``docs``; a NULL text counts as
    empty, that is, one end token. Without training rows every word is unseen and score equals base_score.
    """
    spark = docs.sparkSession
    held_out = common.remainder(F.col("doc_id"), folds) == 0
    marked = docs.select("doc_id", held_out.alias("held_out"), "text")
    vocab = vocabulary(marked.where("not held_out"))
    encoded = written_table(encode(marked, vocab), "encoded")
    shared = spark.sparkContext.broadcast(learn(encoded, vocab, states, iterations))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _symbol_lists(batches, HELD_SYMBOLS):
            yield pa.RecordBatch.from_pydict({
                "row_id": pa.array(ids, pa.int64()), "hidden_log": pa.array(shared.value.log10(texts))})

    hidden = encoded.select("row_id", "symbols").mapInArrow(run, "row_id bigint, hidden_log double")
    tail = (
        encoded.select("row_id", F.explode("tail").alias("t")).select("row_id", "t.word", F.col("t.n").alias("times"))
        .join(vocab.counts, "word", "left")
        .groupBy("row_id").agg(
            F.sum(F.col("times") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + SMOOTHING)).alias("tail_log"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_tail")))
    known_end = int(vocab.documents > 0)
    end_log = math.log10(vocab.documents + SMOOTHING)
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    base = F.col("head_log") + tail_log + F.lit(end_log) - F.col("n_tokens") * F.lit(vocab.log_all)
    model = F.col("hidden_log") + F.col("rare_log") + tail_log - F.col("n_rare") * F.lit(vocab.log_rare)
    return (
        encoded.drop("symbols", "tail").join(hidden, "row_id").join(tail, "row_id", "left").select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_head") + F.coalesce("n_tail", F.lit(0)) + known_end).cast("bigint").alias("n_known"),
            F.lit(vocab.tokens).cast("bigint").alias("train_tokens"),
            base.alias("base_score"), (model if vocab.documents else base).alias("score")))
