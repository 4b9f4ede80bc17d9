"""Language identification with bit-sliced Bloom filters of character n-grams.

Training counts every 4-gram of letters (lower case, words apart) per language over all training texts. A language's
set holds the 4-grams that make up at least ``min_share`` of all its 4-grams, so a set has at most 1 / min_share
members however large the corpus is. All sets share one filter: each of ``slots`` positions holds a bit mask of
languages, and the AND of the masks at the hash positions of a 4-gram names all languages that contain it. Per
text the bits are counted by language, each rate is corrected for the false positives that the filter's fill of
that language predicts, and the largest corrected rate decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailseq.llm import common
from trailseq.session import written_table

GRAM = 4
HASHES = 3
MIN_SHARE = 2e-5
SLOTS = 1 << 20
#: Bound on the label set; with 1 / MIN_SHARE members each it bounds what the driver gathers.
MAX_LANGUAGES = 512

#: Characters handled at a time; a 4-gram takes about 70 bytes of arrays.
CHUNK_CHARS = 1_000_000

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """4-grams of the texts as 64-bit values, the text of each, and which texts have a letter.

    Every run of characters that aren't letters counts as one space; a text begins with two spaces and ends with one.
    """
    lowered = [(t or "").lower() for t in texts]
    lengths = np.array([len(t) + 3 for t in lowered], dtype=np.int64)
    codes = np.frombuffer("".join(f"  {t} " for t in lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    first = np.cumsum(lengths) - lengths
    keep[first] = keep[first + 1] = True
    owner = np.repeat(np.arange(len(texts)), lengths)[keep]
    has_letter = np.bincount(owner, weights=letter[keep], minlength=len(texts)) > 0
    kept = np.where(letter, codes, 0x20)[keep].astype(np.uint64) & np.uint64(0xFFFF)
    n = max(0, len(kept) - GRAM + 1)
    value = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        value = (value << np.uint64(16)) | kept[k:k + n]
    inside = owner[:n] == owner[GRAM - 1:] if n else np.zeros(0, dtype=bool)
    return value[inside], owner[:n][inside], has_letter


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.chunks(batches, limit=CHUNK_CHARS):
        langs = np.array(common.column(batch, "lang"), dtype=object)
        value, owner, _ = grams(common.column(batch, "text"))
        of = langs[owner] if len(owner) else owner
        for lang in set(langs):
            found, n = np.unique(value[of == lang], return_counts=True)
            if len(found):
                yield common.rows(_COUNTS, lang=[lang] * len(found), gram=found.view(np.int64), n=n)
    common.release_memory()


class Model:
    """The filter: languages in order, masks by slot, and each language's rate of false positives."""

    def __init__(self, languages: list[str], members: dict[str, np.ndarray], slots: int = SLOTS):
        self.languages, self.slots = languages, slots
        self.masks = np.zeros((max(1, -(-len(languages) // 64)), slots), dtype=np.uint64)
        self.false_rate = np.zeros(len(languages))
        for k, lang in enumerate(languages):
            bit = np.uint64(1) << np.uint64(k % 64)
            for at in self._positions(members[lang]):
                self.masks[k // 64][np.unique(at)] |= bit
            self.false_rate[k] = ((self.masks[k // 64] & bit) > 0).mean() ** HASHES

    def _positions(self, value: np.ndarray) -> list[np.ndarray]:
        one = common.mix(value)
        two = common.mix(one) | np.uint64(1)
        with np.errstate(over="ignore"):
            return [((one + np.uint64(k) * two) % np.uint64(self.slots)).astype(np.int64) for k in range(HASHES)]

    def rates(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of 4-grams known to each language (texts x languages), and which texts have a letter."""
        value, owner, has_letter = grams(texts)
        total = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        out = np.zeros((len(texts), len(self.languages)))
        at = self._positions(value)
        for block, masks in enumerate(self.masks):
            hit = masks[at[0]] & masks[at[1]] & masks[at[2]]
            for k in range(64 * block, min(64 * block + 64, len(self.languages))):
                bits = (hit >> np.uint64(k % 64)) & np.uint64(1)
                out[:, k] = np.bincount(owner, weights=bits, minlength=len(texts)) / total
        return np.clip((out - self.false_rate) / (1 - self.false_rate), 0, 1), has_letter


def train(docs: DataFrame, min_share: float = MIN_SHARE) -> Model:
    """Learn from all rows of ``docs`` (text, lang); rows without a text or a lang count for nothing.

    The driver gathers at most 1 / min_share members for each of at most MAX_LANGUAGES languages.
    """
    labelled = docs.select("text", "lang").where("text is not null and lang is not null")
    counts = labelled.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    counts = written_table(counts, "language-grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).limit(
        MAX_LANGUAGES + 1).collect()}
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(totals)
    if not languages:
        return Model([], {})
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counts.join(F.broadcast(sums), "lang").where(F.col("n") >= min_share * F.col("total"))
    found = frequent.select("lang", "gram").toArrow()
    langs = np.array(found.column("lang").to_pylist(), dtype=object)
    values = found.column("gram").to_numpy().view(np.uint64)
    return Model(languages, {lang: values[langs == lang] for lang in languages})


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All rows of ``docs`` with ``lang_pred`` and ``score``, the corrected share of 4-grams that the language knows.

    Ties go to the first language by name. A NULL text, or one without a letter, gives ``und`` and 0.0, as does
    every text if no language was learned. Columns of these names that ``docs`` has are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in common.chunks(batches, limit=CHUNK_CHARS):
            texts = common.column(batch, "text")
            rates, has_letter = own.rates(texts)
            best = rates.argmax(axis=1) if own.languages else np.zeros(len(texts), dtype=int)
            lang = [own.languages[b] if ok and own.languages else "und" for b, ok in zip(best, has_letter)]
            score = [float(rates[i, b]) if ok and own.languages else 0.0
                     for i, (b, ok) in enumerate(zip(best, has_letter))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])
        common.release_memory()

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Train on the documents whose crc32(doc_id) modulo ``folds`` isn't 0, predict for all.

    Returns doc_id, held_out, lang_pred, score; one row per row of ``docs``. A NULL doc_id is held out.
    """
    held_out = common.remainder(F.col("doc_id"), folds) == 0
    model = train(docs.where(~held_out))
    narrow = docs.select("doc_id", held_out.alias("held_out"), "text")
    return predict(narrow, model).select("doc_id", "held_out", "lang_pred", "score")
