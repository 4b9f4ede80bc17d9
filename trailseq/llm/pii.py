"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Matches of the fixed patterns are seeds. The words next to seeds are lexical patterns (a word on the left or on the
right, for a kind of identifier). A pattern's confidence is the score of the instances that it occurs with, by all its
occurrences in all documents, identifiers or not; the score of an instance that isn't a seed is the chance that any of
its patterns is right. The two are computed from each other for a few rounds; an instance whose score is high enough
is trusted from then on, and the other words that it stands next to become patterns of the next round. Patterns of high
confidence, seen with several different trusted identifiers, then discover what looks like an identifier of their kind.

Only DataFrame functions. The documents are read once for spans and once for the frequency of context words;
everything between works on rows of identifiers. Within a text, sums and maxima over its matches are taken in blocks, so that
a text with very many matches takes time in proportion to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailseq.functions.vectors import let
from trailseq.llm import common
from trailseq.session import written_table

# The kinds in order with their patterns. Possessive quantifiers and the look-behind only spare retries
# that can't match: what may not be followed by the next character fails at every other start as well.
LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What looks like an identifier: words with a digit or an @, less punctuation around them.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
LOOKS = {
    "email": r"^[^@]+@[^@]*$",
    "ip": r"^[0-9]+[.:_-][0-9]+[.:_-][0-9]+[.:_-][0-9]+$",
    "card": r"^[0-9][0-9-]{12,}[0-9]$",
    "phone": r"^\(?[0-9][().0-9-]{5,13}[0-9]$",
}
#: Numbers in groups, as phones and cards are mostly written, and how many digits make which.
SPACED = r"(?<!\S)\(?[0-9]++(?:[().-]?[\x20().-][(]?+[0-9]++)++(?!\S)"
SPACED_DIGITS = {"phone": (7, 12), "card": (13, 19)}
#: Code points on either side, back to the last match and on to the next one, in which the neighbouring word is looked for.
REACH = 60
#: Matches of a text that are walked through in one go.
BLOCK = 256
ROUNDS = 3
#: A pattern discovers if it has this confidence and came with so many different trusted identifiers.
CONFIDENCE = 0.5
LEAST_SEEDS = 3
#: Context words up to which their frequency is counted behind a broadcast.
BROADCAST_ROWS = 200_000

_SPANS = "array<struct<start: int, end: int, value: string, before: string, after: string>>"


def _blocks(items: Column) -> Column:
    """``items`` in slices of BLOCK elements, one at least."""
    def cut(items: Column) -> Column:
        last = F.greatest(F.floor((F.size(items) - 1) / BLOCK).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))
    return let(items, cut)


def _running(blocks: Column, first: Column, of_block, combine) -> Column:
    """What ``combine`` makes of ``first`` and all blocks before each block."""
    every = F.aggregate(
        blocks, F.array(first), lambda known, block: F.array_append(
            known, combine(F.element_at(known, -1), of_block(block))))
    return F.slice(every, F.lit(1), F.size(blocks))


def _located(text: Column, pattern: str) -> Column:
    """Start, end (exclusive, in code points), text and surroundings of all matches, leftmost and without overlap."""
    rest = F.lit(1 << 30)

    def spans_of(found: Column) -> Column:
        gaps, values = found["gaps"], found["values"]
        pairs = F.arrays_zip(
            gaps.alias("gap"), values.alias("value"), F.concat(F.array(F.lit("")), values).alias("previous"),
            F.slice(gaps, F.lit(2), rest).alias("next_gap"), F.slice(values, F.lit(2), rest).alias("next"))
        return let(_blocks(F.slice(pairs, F.lit(1), F.size(values))), in_blocks)

    def in_blocks(blocks: Column) -> Column:
        width = lambda p: F.length(p["gap"]) + F.length(p["value"])
        total = lambda block: F.aggregate(block, F.lit(0), lambda n, p: n + width(p))
        starts = _running(blocks, F.lit(0), total, lambda a, b: a + b)
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), starts.alias("at")), lambda z: F.aggregate(
            z["block"], F.struct(z["at"].alias("at"), F.array().cast(_SPANS).alias("spans")), step,
            lambda state: state["spans"])))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        empty = F.lit("")
        span = F.struct(
            start.alias("start"), end.alias("end"), pair["value"].alias("value"),
            F.right(F.concat(pair["previous"], pair["gap"]), F.lit(REACH)).alias("before"),
            F.left(F.concat(F.coalesce(pair["next_gap"], empty), F.coalesce(pair["next"], empty)), F.lit(REACH)).alias("after"))
        return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    return let(F.struct(F.split(text, pattern, -1).alias("gaps"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")), spans_of)


def _earlier_max(numbers: Column) -> Column:
    """The largest number before each element, -1 if none is larger."""
    def in_blocks(blocks: Column) -> Column:
        tops = _running(blocks, F.lit(-1), lambda block: F.coalesce(F.array_max(block), F.lit(-1)), F.greatest)
        start = lambda z: F.struct(z["top"].alias("top"), F.array().cast("array<int>").alias("out"))
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), tops.alias("top")), lambda z: F.aggregate(
            z["block"], start(z), lambda state, x: F.struct(
                F.greatest(state["top"], x).alias("top"), F.array_append(state["out"], state["top"]).alias("out")),
            lambda state: state["out"])))
    return let(_blocks(numbers), in_blocks)


def _free(spans: Column, taken: Column) -> Column:
    """The ``spans`` that overlap none of ``taken`` (start, end): in order of their starts, none that began before reaches in, none
    begins inside."""
    def filtered(marks: Column) -> Column:
        last = 1 << 30  # above any place in a text
        ends = F.transform(marks, lambda m: F.when(m["own"] == 0, m["span"]["end"]).otherwise(-1))
        starts = F.transform(F.reverse(marks), lambda m: F.when(m["own"] == 0, last - m["span"]["start"]).otherwise(-1))
        zipped = F.arrays_zip(marks.alias("m"), _earlier_max(ends).alias("end"), F.reverse(_earlier_max(starts)).alias("start"))
        free = F.filter(zipped, lambda z: (z["m"]["own"] == 1) & (z["end"] <= z["m"]["start"]) & (
            last - z["start"] >= z["m"]["span"]["end"]))
        return F.transform(free, lambda z: z["m"]["span"])

    def mark(span: Column, own: int) -> Column:
        whole = [span[c] if own or c in ("start", "end") else F.lit("") for c in ("start", "end", "value", "before", "after")]
        return F.struct(span["start"].alias("start"), F.lit(own).alias("own"), F.struct(*(
            c.alias(n) for c, n in zip(whole, ("start", "end", "value", "before", "after")))).alias("span"))

    def unless_empty(spans: Column) -> Column:
        marks = F.sort_array(F.concat(F.transform(taken, lambda t: mark(t, 0)), F.transform(spans, lambda w: mark(w, 1))))
        return F.when((F.size(taken) == 0) | (F.size(spans) == 0), spans).otherwise(let(marks, filtered))
    return let(spans, unless_empty)


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, 2 * digit).otherwise(digit)
        return F.when(twice > 9, twice - 9).otherwise(twice)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + value(i))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return F.regexp_like(value, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    if kind == "card":
        return F.length(digits).between(16, 19) & F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one kind; matches that fail its test are dropped and not tried again."""
    needed = {"email": "@", "phone": "+"}.get(kind)
    here = text.contains(needed) if needed else F.regexp_like(text, F.lit("[0-9]"))
    spans = F.filter(_located(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
    return F.when(here, spans).otherwise(F.array().cast(_SPANS))


def _word(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[0-9]", "0")


def _instance(kind: Column, span: Column, seed: bool) -> Column:
    """A span with the words next to it."""
    left = F.regexp_extract(span["before"], r"(\S+)\s*$", 1)
    right = F.regexp_extract(span["after"], r"^\s*(\S+)", 1)
    contexts = F.array_compact(F.array(*(
        F.when(word != "", F.concat(F.lit(side), _word(word))) for side, word in (("L", left), ("R", right)))))
    return F.struct(
        kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
        F.lower(span["value"]).alias("value"), F.lit(seed).alias("seed"), contexts.alias("contexts"))


def _typed(spans: Column, kind) -> Column:
    """(kind, span) of the spans that ``kind`` of their text is not NULL for."""
    typed = F.transform(spans, lambda w: F.struct(kind(w["value"]).alias("kind"), w.alias("span")))
    return F.filter(typed, lambda t: t["kind"].isNotNull())


def _spaced(text: Column, taken: Column) -> Column:
    """(kind, span) of numbers in groups that don't overlap a base span."""
    def kind(value: Column) -> Column:
        digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
        return F.coalesce(*(F.when(value.contains(" ") & digits.between(*of), F.lit(k)) for k, of in SPACED_DIGITS.items()))
    return _typed(_free(_located(text, SPACED), taken), kind)


def _lookalikes(text: Column, taken: Column) -> Column:
    """(kind, span) of words that look like identifiers of a kind and don't overlap what is taken."""
    def trimmed(span: Column) -> Column:
        lead = F.regexp_extract(span["value"], r"^[\"'<\[{,;:]*", 0)
        value = F.regexp_extract(span["value"], r"^[\"'<\[{,;:]*(.*?)[\"'>\]},;:.!?]*$", 1)
        start = span["start"] + F.length(lead)
        tail = F.right(span["value"], F.length(span["value"]) - F.length(lead) - F.length(value))
        return F.struct(
            start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
            F.right(F.concat(span["before"], lead), F.lit(REACH)).alias("before"),
            F.left(F.concat(tail, span["after"]), F.lit(REACH)).alias("after"))
    kind = lambda value: F.coalesce(*(F.when(F.regexp_like(value, F.lit(p)), F.lit(k)) for k, p in LOOKS.items()))
    typed = _typed(F.transform(_located(text, TOKEN), trimmed), kind)
    free = _free(F.transform(typed, lambda t: t["span"]), taken)
    return _typed(free, kind)


def spans(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, the base spans by kind, and instances with their contexts; stored, one row per row."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", *(base_spans(F.col("text"), k).alias(k) for k in PATTERNS))
    place = lambda k: F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    ends = lambda typed: F.transform(typed, lambda t: F.struct(
        t["span"]["start"].alias("start"), t["span"]["end"].alias("end")))
    digits = F.regexp_like("text", F.lit("[0-9@]"))
    found = found.withColumn("taken", F.concat(*(place(k) for k in PATTERNS)))
    found = found.withColumn("spaced", F.when(digits, _spaced(F.col("text"), F.col("taken"))))
    found = found.withColumn("words", F.when(digits, _lookalikes(
        F.col("text"), F.concat("taken", F.coalesce(ends(F.col("spaced")), F.slice("taken", 1, 0))))))
    other = lambda c: F.transform(c, lambda t: _instance(t["kind"], t["span"], False))
    seed = lambda k: F.transform(k, lambda s: _instance(F.lit(k), s, True))
    seeds = [seed(k) for k in PATTERNS]
    none = F.slice(seeds[0], 1, 0)
    instances = F.concat(*seeds, F.coalesce(other(F.col("spaced")), none), F.coalesce(other(F.col("words")), none))
    return written_table(
        found.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", *(place(k).alias(k) for k in PATTERNS),
                     instances.alias("instances")), "identifier-spans")


def _frequencies(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(word, frequency) of the context ``words`` among the white-space-separated words of all documents."""
    every = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), r"\s+")).alias("word")).select(
        _word(F.col("word")).alias("word"))
    return every.join(common.checked_side(words, BROADCAST_ROWS), "word", "left_semi").groupBy("word").agg(
        F.count("*").alias("frequency"))


def patterns(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(kind, context, confidence) of the patterns that discover identifiers.

    confidence = (sum of the scores of what a pattern occurs with) / (all its occurrences + 1); a seed's score is 1, that of
    another instance 1 - product of (1 - confidence) over its patterns. Patterns of a round are the contexts of what
    is trusted: seeds, and instances whose score has reached CONFIDENCE in an earlier round.
    """
    rows = written_table(
        found.select(F.explode("instances").alias("i")).select("i.kind", "i.value", "i.seed", F.explode("i.contexts").alias(
            "context")).groupBy("kind", "value", "context").agg(F.count("*").alias("n"), F.max("seed").alias("seed")),
        "pattern-instances")
    word = F.substring("context", 2, 1 << 30)
    words = written_table(rows.select(word.alias("word")).distinct(), "context-words")
    frequency = written_table(_frequencies(docs, words), "context-frequencies")
    totals = written_table(
        rows.groupBy("kind", "context").agg(F.sum("n").alias("occurrences")).withColumn("word", word)
        .join(frequency, "word", "left")
        .select("kind", "context", F.greatest("occurrences", F.coalesce("frequency", F.lit(0))).alias("all")), "pattern-totals")
    scores = rows.withColumn("score", F.col("seed").cast("double")).withColumn("trusted", F.col("seed"))
    for _ in range(ROUNDS):
        confidence = written_table(
            scores.groupBy("kind", "context").agg(
                F.sum(F.col("score") * F.col("n")).alias("weight"), F.count_if("trusted").alias("trusted"))
            .where("trusted > 0").join(totals, ["kind", "context"])
            .select("kind", "context", "trusted", (F.col("weight") / (F.col("all") + 1)).alias("confidence")),
            "pattern-confidence")
        instance = rows.join(confidence, ["kind", "context"]).groupBy("kind", "value").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("from_patterns"))
        score = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("from_patterns", F.lit(0.0)))
        scores = written_table(rows.join(instance, ["kind", "value"], "left").select(
            *rows.columns, score.alias("score"), (F.col("seed") | (score >= CONFIDENCE)).alias("trusted")), "pattern-scores")
    return confidence.where((F.col("confidence") >= CONFIDENCE) & (F.col("trusted") >= LEAST_SEEDS)).drop("trusted")


def find(docs: DataFrame) -> DataFrame:
    """Spans of personal data in every text of ``docs`` (doc_id, text), one row per row.

    doc_id; email, ip, card and phone: arrays of base spans (start, end); added: array of (kind, start, end) that
    patterns discovered, none of which overlaps a base span. A NULL text counts as empty. Repeated rows have equal
    spans, and all of them count as occurrences of their patterns.
    """
    found = spans(docs)
    added = (
        found.select("row_id", F.explode("instances").alias("i")).where("not i.seed")
        .select("row_id", "i.kind", "i.start", "i.end", F.explode("i.contexts").alias("context"))
        .join(patterns(docs, found), ["kind", "context"], "left_semi")
        .groupBy("row_id").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("added")))
    return found.join(added, "row_id", "left").select(
        "doc_id", *PATTERNS, F.coalesce("added", F.array().cast(
            "array<struct<kind: string, start: int, end: int>>")).alias("added"))


def added_of(kind: str) -> Column:
    """(start, end) of the added spans of a kind."""
    return F.transform(F.filter("added", lambda a: a["kind"] == kind),
                       lambda a: F.struct(a["start"].alias("start"), a["end"].alias("end")))


def listed(parts: dict[str, Column]) -> Column:
    """kind:start:end by kind, then start, joined by commas; ``parts`` has an array of (start, end) by kind."""
    def of(kind: str) -> Column:
        return F.transform(F.array_sort(parts[kind]), lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))
    return F.array_join(F.concat(*map(of, parts)), ",")
