"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the word definition [^\x20\x09-\x0D]+, the same bytes that ``bytes.split()`` splits at.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Texts are handled in pieces of about so many bytes, which bounds the arrays of a task.
CHUNK_BYTES = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the word (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(256, dtype=np.uint64))
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.full(max(n, 4096), _STEP, dtype=np.uint64)) * np.uint64(1)
    return _POWERS


class Words:
    """The words of a list of texts: byte ranges, 64-bit digests and the first word of each text."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        if lower:
            encoded = [t.lower() for t in encoded]  # of bytes: A-Z only
        self.data = b"\n".join(encoded) + b"\n"
        raw = np.frombuffer(self.data, dtype=np.uint8)
        word = ~SPACE[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        text_starts = np.zeros(len(encoded) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in encoded], out=text_starts[1:])
        #: ``first[i]`` to ``first[i + 1]``: the words of text i.
        self.first = np.searchsorted(self.starts, text_starts)

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, dtype=np.uint64)
        raw = np.frombuffer(self.data, dtype=np.uint8)
        word = ~SPACE[raw]
        offsets = np.cumsum(lengths) - lengths
        inside = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(offsets, lengths)
        with np.errstate(over="ignore"):
            parts = _BYTE[raw[word]] * _powers(int(lengths.max()))[inside]
            return mix(np.add.reduceat(parts, offsets) + lengths.astype(np.uint64))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Digest of the n words from each position on, and whether these lie in one text."""
        size = len(self.hashes)
        digests = np.zeros(size, dtype=np.uint64)
        if size >= n:
            with np.errstate(over="ignore"):
                total = np.zeros(size - n + 1, dtype=np.uint64)
                for k in range(n):
                    total = total * _STEP + self.hashes[k:size - n + 1 + k]
            digests[:size - n + 1] = mix(total)
        return digests, self.whole(n)

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each position on lie in one text."""
        ends = np.repeat(self.first[1:], np.diff(self.first))
        return np.arange(len(ends)) + n <= ends

    def text(self, i: int, j: int) -> str:
        """Words i to j (exclusive), joined by one space."""
        data, starts, ends = self.data, self.starts, self.ends
        return b" ".join(data[starts[k]:ends[k]] for k in range(i, j)).decode("utf-8", "surrogatepass")


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``limit`` characters of ``text``, one row at least."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.cumsum([len(x.as_py() or "") for x in column]) if batch.num_rows else []
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type, from_pandas=False) for f in schema], schema=schema)


def release_memory() -> None:
    """Give what this process has freed back to the system.

    Workers stay for later stages, and what their allocators keep is missing in the executor.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library here may have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a NULL id counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % by, F.lit(0))


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checked_side(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` (narrow) rows, else as it is, for a shuffled join.

    Only the plan differs, never the rows. ``df`` should be stored, as its rows are counted first.
    """
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
