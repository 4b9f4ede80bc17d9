"""Packing of documents into training sequences: bounded-space, online, best fit.

Every partition tokenizes its documents and keeps at most ``open_windows`` windows open. A piece goes to the
window in which it leaves the least room. If it fits into none, and no more may be opened, the fullest window is
topped up with the beginning of the piece, unless its room is under ``min_cut`` tokens, and emitted. What a
partition has open at its end is merged with what its neighbours have open, again best fit, so that at most a few
windows per ``MERGED_PARTITIONS`` partitions stay short.
"""

from __future__ import annotations

import os
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from operator import add
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailseq.llm import common
from trailseq.session import written_table

LENGTH = 2048
OPEN_WINDOWS = 32
MIN_CUT = 16
MERGED_PARTITIONS = 64
END_ID = 1
#: Parts of words of a generation, whose ids a worker remembers; more begin a new generation.
REMEMBERED_WORDS = 150_000

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")


class Encoder:
    """Token ids of whole texts.

    The tokenizer normalizes and splits at white space before anything else, so the ids of a text are those of
    its white-space-separated words. Arrow finds the distinct words of a chunk of texts, and puts the ids of each
    where it occurs. A word made of letters and then ASCII punctuation is split there too, as the tokenizer does, and
    its letters are looked up in lower case; most have been seen before. Latin letters need none of the tokenizer's
    other steps and go to its model as they are.
    What was seen is held in two generations; a full one becomes the older, which is then dropped.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.parts: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.packed = [k.to_bytes(4, "little") for k in range(self.tokenizer.get_vocab_size())]

    def ids(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text without special tokens, then the end id."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([(text or "").encode("utf-8", "replace").decode("utf-8") for text in texts], pa.string())
        if not len(texts):
            return []
        words = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = words.flatten().dictionary_encode()
        ends = words.offsets.to_numpy()[1:]
        placed = np.insert(coded.indices.to_numpy(), ends, len(coded.dictionary))
        packed = pa.array([*self._words(coded.dictionary), _END], pa.large_binary()).take(pa.array(placed))
        _, offsets, data = packed.buffers()
        stops = np.frombuffer(offsets, dtype=np.int64)[ends + np.arange(1, len(texts) + 1)] // 4
        return np.split(np.frombuffer(data, dtype="<u4")[:stops[-1]], stops[:-1])

    def _words(self, words: pa.Array) -> Iterator[bytes]:
        """The packed ids of each word."""
        split = pc.extract_regex(words, _LATIN_WORD)
        part = _bytes(pc.utf8_lower(pc.struct_field(split, "letters")))
        rest = _bytes(pc.struct_field(split, "rest"))
        for k in np.flatnonzero(split.is_null().to_numpy(zero_copy_only=False)).tolist():
            part[k], rest[k] = _split(words[k].as_py().encode("utf-8"))
        self._learn(set(part).union(rest))
        known = self.parts.__getitem__
        return map(add, map(known, part), map(known, rest))

    def _learn(self, wanted: set[bytes]) -> None:
        if len(self.parts) > REMEMBERED_WORDS:
            self.older, self.parts = self.parts, {}
        older, known, other = self.older.get, self.parts, []
        tokenize, packed = self.model.tokenize, self.packed
        known[b""] = b""
        for part in wanted.difference(known):
            if (ids := older(part)) is not None:
                known[part] = ids
            elif (spelled := part.decode() if part.isalpha() else _byte_letters(part)) is not None:
                known[part] = b"".join([packed[t.id] for t in tokenize(spelled)])
            else:
                other.append(part)
        texts = [part.decode("utf-8") for part in other]
        for part, one in zip(other, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            known[part] = array("I", one.ids).tobytes()


_END = np.array([END_ID], dtype="<u4").tobytes()
#: Punctuation that the tokenizer never joins with the letters before it.
_CLOSING = b".,;:!?)]}*%$#&-"
#: Letters whose lower case depends on their place or has more than one character.
_SPECIAL = frozenset("\u03a3\u0130")
#: Words of letters up to U+017F, none of them special, and closing punctuation.
_LATIN_WORD = (r"^(?P<letters>[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+)"
               r"(?P<rest>[.,;:!?)\]}*%$#&-]*)$")
#: Letters before this code point are lower-cased alike everywhere.
_LATIN_END = 0x250
#: The model's letters for bytes: printable ones stand for themselves, the others are moved behind the first 256.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_MOVED = [b for b in range(0x100) if b not in set(_PRINTABLE)]
_LETTERS = "".join(chr(0x100 + _MOVED.index(b) if b in _MOVED else b) for b in range(0x100))


def _bytes(strings: pa.Array) -> list[bytes | None]:
    return strings.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _split(word: bytes) -> tuple[bytes, bytes]:
    """A word's letters, in lower case, and its closing punctuation; the whole word if it has anything else."""
    letters = word.rstrip(_CLOSING)
    part = letters.lower() if letters.isalpha() else _lowered(letters)
    return (word, b"") if part is None else (part, word[len(letters):])


def _byte_letters(part: bytes) -> str | None:
    """Lower-case Latin letters, not all of them ASCII, as the model spells their bytes; None for anything else."""
    if part.isascii():
        return None
    text = part.decode("utf-8")
    if text.isalpha() and ord(max(text)) < _LATIN_END and text == text.lower() and is_normalized("NFC", text):
        return charmap_decode(part, "strict", _LETTERS)[0]
    return None


def _lowered(letters: bytes) -> bytes | None:
    """The lower case of letters that aren't all ASCII; None for anything else."""
    if letters.isascii():
        return None
    text = letters.decode("utf-8")
    return text.lower().encode("utf-8") if text.isalpha() and _SPECIAL.isdisjoint(text) else None


_ENCODERS: dict[str, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """This process's encoder; what it has seen serves later tasks as well."""
    if definition not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[definition] = Encoder(definition)
    return _ENCODERS[definition]


class Window:
    def __init__(self, sequence_id: int):
        self.sequence_id, self.used, self.pieces = sequence_id, 0, []


class Packer:
    """The open windows of one partition; ``place`` returns the windows that are complete."""

    def __init__(self, partition: int, length: int, open_windows: int, min_cut: int):
        self.length, self.most, self.min_cut = length, open_windows, min_cut
        self.open: list[Window] = []
        self.next_id = partition << 32

    def _new(self) -> Window:
        self.next_id += 1
        return Window(self.next_id - 1)

    def place(self, doc_id, ids: np.ndarray) -> list[Window]:
        done, start = [], 0
        while start < len(ids):
            size = min(self.length, len(ids) - start)
            if size == self.length:
                window = self._new()
            else:
                fitting = [w for w in self.open if w.used + size <= self.length]
                if fitting:
                    window = max(fitting, key=lambda w: w.used)
                elif len(self.open) < self.most:
                    window = self._new()
                    self.open.append(window)
                else:
                    window = max(self.open, key=lambda w: w.used)
                    size = self.length - window.used
                    if size < self.min_cut:
                        self.open.remove(window)
                        done.append(window)
                        continue
            part = ids[start:start + size].copy()  # an open window would hold the ids of a whole chunk otherwise
            window.pieces.append((doc_id, start, size, zlib.crc32(part), len(ids), window.used, part))
            window.used += size
            start += size
            if window.used == self.length:
                if window in self.open:
                    self.open.remove(window)
                done.append(window)
        return done


def _packing_task(definition, length: int, open_windows: int, min_cut: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(definition.value)
        packer = Packer(TaskContext.get().partitionId(), length, open_windows, min_cut)

        def out(windows: list[Window], still_open: bool) -> pa.RecordBatch:
            flat = [(w, p) for w in windows for p in w.pieces]
            columns = {
                "doc_id": pa.array([p[0] for _, p in flat], pa.int64()),
                "start": pa.array([p[1] for _, p in flat], pa.int64()),
                "length": pa.array([p[2] for _, p in flat], pa.int64()),
                "ids_crc32": pa.array([p[3] for _, p in flat], pa.int64()),
                "doc_tokens": pa.array([p[4] for _, p in flat], pa.int64()),
                "sequence_id": pa.array([w.sequence_id for w, _ in flat], pa.int64()),
                "offset": pa.array([p[5] for _, p in flat], pa.int64()),
                "still_open": pa.array([still_open] * len(flat), pa.bool_()),
            }
            if with_ids:
                columns["ids"] = pa.array([p[6].astype(np.int32) for _, p in flat], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(columns)

        for batch in common.chunks(batches):
            done = []
            texts = batch.column(batch.schema.get_field_index("text"))
            for doc_id, ids in zip(common.column(batch, "doc_id"), own.ids(texts)):
                done += packer.place(doc_id, ids)
            yield out(done, False)
        yield out(packer.open, True)
        common.release_memory()
    return run


def _merge(length: int):
    """Windows that are still open, fullest first, each into the merged one that it leaves the least room in."""
    def run(group: pa.Table) -> pa.Table:
        ids = group.column("sequence_id").to_numpy()
        used = group.column("used").to_numpy()
        room: dict[int, list[list[int]]] = {}  # merged windows by their room
        new_id, shift, filled = {}, {}, {}
        for k in sorted(range(len(ids)), key=lambda i: (-used[i], ids[i])):
            size = int(used[k])
            left = next((r for r in range(size, length) if room.get(r)), None)
            merged = room[left].pop() if left is not None else int(ids[k])
            new_id[k], shift[k] = merged, filled.get(merged, 0)
            filled[merged] = shift[k] + size
            room.setdefault(length - filled[merged], []).append(merged)
        order = range(len(ids))
        return pa.table({
            "sequence_id": pa.array(ids, pa.int64()),
            "new_id": pa.array([new_id[k] for k in order], pa.int64()),
            "shift": pa.array([shift[k] for k in order], pa.int64()),
        })
    return run


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, open_windows: int = OPEN_WINDOWS,
         min_cut: int = MIN_CUT, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (doc_id, text), placed in sequences of at most ``length`` tokens.

    ``tokenizer`` is the path of a tokenizer definition on the driver. One row per piece: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` if asked for. A NULL or empty text is the end id alone.
    Repeated rows are packed once each; rows with a NULL doc_id too. An empty table gives no rows.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    schema = T.StructType.fromDDL(PIECES + ", still_open boolean" + (", ids array<int>" if with_ids else ""))
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    pieces = written_table(
        narrow.mapInArrow(_packing_task(definition, length, open_windows, min_cut, with_ids), schema), "pieces")
    left = (
        pieces.where("still_open").groupBy("sequence_id").agg(F.sum("length").alias("used"))
        .withColumn("part_group", F.shiftright("sequence_id", 32) / F.lit(MERGED_PARTITIONS).cast("bigint"))
        .withColumn("part_group", F.floor("part_group"))
    )
    moved = left.groupBy("part_group").applyInArrow(
        _merge(length), "sequence_id bigint, new_id bigint, shift bigint")
    columns = [f.name for f in schema if f.name != "still_open"]
    placed = pieces.where("still_open").join(moved, "sequence_id").select(*(
        F.col("new_id").alias("sequence_id") if c == "sequence_id"
        else (F.col("offset") + F.col("shift")).alias("offset") if c == "offset" else F.col(c) for c in columns))
    return pieces.where("not still_open").select(*columns).unionByName(placed)
