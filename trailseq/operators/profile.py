"""Length, uniqueness and channel statistics of histories and vectors.

Lengths are counted per distinct value before anything else, so medians, histograms and densities work on
tables with one row per distinct length instead of one per history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailseq.functions import sequences as S
from trailseq.functions.vectors import add_up, min_max_scale
from trailseq.operators import selection
from trailseq.session import written_table


def length_counts(histories: DataFrame, history: Column | str = "history") -> DataFrame:
    """``length``, ``n``: how many histories have which length."""
    return histories.groupBy(F.size(history).cast("bigint").alias("length")).agg(F.count("*").alias("n"))


def stats_of_counts(counts: DataFrame, value: str = "length", n: str = "n") -> DataFrame:
    """Count, mean and exact interpolated median of a counted column; NULLs when there are no rows."""
    total = F.sum(n)
    return counts.agg(
        F.coalesce(total, F.lit(0)).cast("bigint").alias("n"),
        F.try_divide(F.sum(F.col(value) * F.col(n)).cast("double"), total).alias("mean_length"),
        F.percentile(value, 0.5, F.col(n)).alias("median_length"),
    )


def history_length_stats(histories: DataFrame) -> DataFrame:
    return stats_of_counts(length_counts(histories))


def history_copies(histories: DataFrame) -> DataFrame:
    """Every distinct history with its number of copies."""
    return histories.groupBy("history").agg(F.count("*").alias("copies"))


def ratio_of_counts(counts: DataFrame) -> DataFrame:
    return counts.select(
        "n_unique", "n_all",
        F.try_divide(F.col("n_unique").cast("double"), F.col("n_all")).alias("ratio"),
    )


def unique_history_ratio(histories: DataFrame) -> DataFrame:
    """How many histories are distinct: one grouping gives both counts."""
    return ratio_of_counts(history_copies(histories).agg(
        F.count("*").alias("n_unique"), F.coalesce(F.sum("copies"), F.lit(0)).alias("n_all")))


def unique_history_stats(histories: DataFrame) -> DataFrame:
    return stats_of_counts(length_counts(histories.select("history").distinct()))


def real_length_counts(prepared: DataFrame) -> DataFrame:
    """``unpadded_length_counts`` of prepared sequences, from their ``n_real``; no vector is read."""
    return prepared.groupBy(F.col("n_real").cast("bigint").alias("length")).agg(F.count("*").alias("n"))


def unpadded_length_counts(sequences: DataFrame, dim: int) -> DataFrame:
    return length_counts(sequences, S.remove_padding("value", dim))


def unpadded_length_stats(sequences: DataFrame, dim: int) -> DataFrame:
    return stats_of_counts(unpadded_length_counts(sequences, dim))


def real_vectors(sequences: DataFrame, dim: int, *keys: str) -> DataFrame:
    """One row per vector that is not padding, in a narrow plan."""
    return sequences.select(*keys, F.posexplode(S.remove_padding("value", dim)).alias("pos", "vec"))


def channel_range(vectors: DataFrame) -> DataFrame:
    """Smallest and largest channel over all vectors, without exploding them."""
    low, high = F.min(F.array_min("vec")), F.max(F.array_max("vec"))
    return vectors.agg(
        low.alias("min_channel"), high.alias("max_channel"))


def vector_sums(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("channel_sum", add_up("vec")).drop("vec")


def normalized_vectors(vectors: DataFrame) -> DataFrame:
    """Min-max scaling with the range of the whole table, read as scalar subqueries."""
    stats = channel_range(vectors)
    low, high = stats.select("min_channel").scalar(), stats.select("max_channel").scalar()
    bounded = vectors.withColumn("low", low).withColumn("high", high)
    return bounded.withColumn("vec", min_max_scale("vec", F.col("low"), F.col("high"))).drop("low", "high")


def normalized_sums(vectors: DataFrame) -> DataFrame:
    """Channel sums of the min-max-scaled vectors, from one pass: scaling is affine, so sum and range are enough."""
    narrow = written_table(
        vectors.withColumns({"channel_sum": add_up("vec"), "size": F.size("vec"), "low": F.array_min("vec"),
                             "high": F.array_max("vec")}).drop("vec"), "sums")
    low, high = (narrow.agg(f(c).alias("v")).scalar() for f, c in ((F.min, "low"), (F.max, "high")))
    bounded = narrow.withColumns({"low": low, "high": high})
    scaled = F.try_divide(F.col("channel_sum") - F.col("size") * F.col("low"), F.col("high") - F.col("low"))
    return bounded.withColumn("channel_sum", scaled).drop("size", "low", "high")


def channels(vectors: DataFrame) -> DataFrame:
    """One row per channel; meant to be aggregated right away, inside the same stage."""
    return vectors.select(F.explode("vec").alias("channel"))


#: Numbers a task works on at a time.
CHUNK_NUMBERS = 1 << 20

#: What can be binned: every channel or the sum of a vector's channels, as it is or after min-max scaling of all channels.
VECTOR_PROFILES = ("channel", "sum", "normalized", "normalized_sum")


def _flat_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All channels of a batch, and the number of channels of each vector that isn't NULL. NULL channels are left out of both."""
    column = column.drop_null()
    values = column.flatten()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    if values.null_count:
        owner = np.repeat(np.arange(len(lengths)), lengths)
        present = values.is_valid().to_numpy(zero_copy_only=False)
        lengths = np.bincount(owner[present], minlength=len(lengths))
        values = values.drop_null()
    return values.to_numpy(zero_copy_only=False), lengths


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each vector, added from the first channel to the last; 0.0 when empty."""
    total = np.zeros(len(lengths))
    first = np.cumsum(lengths) - lengths
    for k in range(int(lengths.max(initial=0))):
        longer = lengths > k
        total[longer] += values[first[longer] + k]
    return total


def _profiled(values: np.ndarray, lengths: np.ndarray, low: float, high: float, kinds: tuple[str, ...]):
    """(kind, numbers) of one batch; a range of zero width leaves nothing to scale."""
    span = high - low
    sums = _sums(values, lengths) if any("sum" in k for k in kinds) else None
    for kind in kinds:
        if kind == "channel":
            yield kind, values
        elif kind == "sum":
            yield kind, sums
        elif span > 0:
            yield kind, (values - low) / span if kind == "normalized" else (sums - lengths * low) / span


def _binned(numbers: np.ndarray, low: float, width: float, bins: int) -> np.ndarray:
    place = np.minimum(np.floor((numbers - low) / width), bins - 1).astype(np.int64)
    return np.bincount(place, minlength=bins)


def vector_histograms(vectors: DataFrame, bins: int, kinds: tuple[str, ...] = VECTOR_PROFILES) -> dict[str, DataFrame]:
    """Histograms of ``vec``, each as ``histogram`` would give it, from two scans for all ``kinds`` together.

    The first scan finds ranges; those of scaled numbers follow from them, or for scaled sums of vectors of several
    lengths from a scan in between. The second counts the bins of a task in arrays, so that a task sends
    one row per kind and bin, whatever it has read. Vectors should be stored, as they are read twice.
    """
    vectors = vectors.select("vec")

    def extremes(low: float, high: float, kinds: tuple[str, ...]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[str, list[float]] = {}
            for batch in batches:
                values, lengths = _flat_vectors(batch.column(0))
                for kind, numbers in _profiled(values, lengths, low, high, kinds):
                    if len(numbers):
                        ends = found.setdefault(kind, [np.inf, -np.inf])
                        ends[:] = min(ends[0], float(numbers.min())), max(ends[1], float(numbers.max()))
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array(list(found), pa.string()), "low": pa.array([e[0] for e in found.values()], pa.float64()),
                "high": pa.array([e[1] for e in found.values()], pa.float64())})
        return run

    def ranges(low: float, high: float, kinds: tuple[str, ...]) -> dict[str, tuple[float, float]]:
        found = vectors.mapInArrow(extremes(low, high, kinds), "kind string, low double, high double").groupBy("kind").agg(
            F.min("low").alias("low"), F.max("high").alias("high"))
        return {r["kind"]: (r["low"], r["high"]) for r in found.collect()}

    plain = tuple(k for k in ("channel", "sum") if k in kinds or k == "channel")
    edges = ranges(0.0, 0.0, plain)
    low, high = edges.get("channel", (0.0, 0.0))
    if high > low and "normalized" in kinds:
        edges["normalized"] = (0.0, 1.0)
    if high > low and "normalized_sum" in kinds:
        edges |= ranges(low, high, ("normalized_sum",))
    wanted = tuple(k for k in kinds if k in edges)
    grid = {k: (lo, (hi - lo) / bins) if hi > lo else (lo - 0.5, 1.0 / bins) for k, (lo, hi) in edges.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {k: np.zeros(bins, dtype=np.int64) for k in wanted}
        for batch in batches:
            values, lengths = _flat_vectors(batch.column(0))
            for kind, numbers in _profiled(values, lengths, low, high, wanted):
                counts[kind] += _binned(numbers, *grid[kind], bins)
        for kind, n in counts.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array([kind] * len(used), pa.string()), "bin": pa.array(used), "n": pa.array(n[used])})

    counted = written_table(vectors.mapInArrow(count, "kind string, bin bigint, n bigint").groupBy("kind", "bin").agg(
        F.sum("n").alias("n")), "vector-bins")

    def table(kind: str) -> DataFrame:
        start, width = grid.get(kind, (0.0, 1.0))
        rows = vectors.sparkSession.range(bins if kind in grid else 0).withColumnRenamed("id", "bin")
        return rows.join(F.broadcast(counted.where(F.col("kind") == kind).drop("kind")), "bin", "left").select(
            "bin", (F.lit(start) + F.col("bin") * width).alias("bin_low"),
            (F.lit(start) + (F.col("bin") + 1) * width).alias("bin_high"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))

    return {kind: table(kind) for kind in kinds}


def _counted(rows: DataFrame, value: str, n: str | None) -> tuple[DataFrame, Column]:
    return rows.where(F.col(value).isNotNull()), (F.col(n) if n else F.lit(1))


def histogram(rows: DataFrame, value: str, bins: int | str = 10, n: str | None = None,
              low: float | None = None, high: float | None = None) -> DataFrame:
    """Equal-width bins over the range of ``value``: ``bin``, ``bin_low``, ``bin_high``, ``n``.

    The last bin includes the upper edge. ``n`` names a count column when the rows are counted already.
    Without given edges the range is a scalar subquery. ``bins="auto"`` takes the narrower of the Sturges
    and the Freedman-Diaconis width, from exact quartiles. Empty bins have n = 0; without
    any value there are no bins.
    """
    rows, weight = _counted(rows, value, n)
    column = F.col(value).cast("double")
    stats = rows.agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.sum(weight).alias("total"),
        *([_quartiles(rows, value, column, n).alias("q")] if bins == "auto" else []),
    )
    if low is not None and high is not None:
        stats = stats.withColumn("low", F.lit(float(low))).withColumn("high", F.lit(float(high)))
    span = F.col("high") - F.col("low")
    if bins == "auto":
        sturges = span / (F.log2(F.col("total").cast("double")) + 1)
        spread = 2 * (F.col("q")[1] - F.col("q")[0]) / F.pow(F.col("total").cast("double"), F.lit(1 / 3))
        width = F.when(spread > 0, F.least(spread, sturges)).otherwise(sturges)
        stats = stats.withColumn("bins", F.when(span > 0, F.ceil(span / width)).otherwise(1))
    else:
        stats = stats.withColumn("bins", F.lit(bins).cast("bigint"))
    # a range of zero width is widened by half a unit on both sides
    stats = stats.select(
        F.when(span > 0, F.col("low")).otherwise(F.col("low") - 0.5).alias("low"),
        F.when(span > 0, span / F.col("bins")).otherwise(1.0 / F.col("bins")).alias("width"),
        F.col("bins").cast("bigint").alias("bins"),
    )
    stats = written_table(stats.where("low is not null"), "bin-edges")  # one row, read twice
    edges = stats.select(F.struct("low", "width", "bins").alias("e")).scalar()
    placed = rows.select(column.alias("x"), weight.alias("w"), edges.alias("e"))
    position = F.floor((F.col("x") - F.col("e.low")) / F.col("e.width"))
    filled = placed.groupBy(F.least(position, F.col("e.bins") - 1).cast("bigint").alias("bin")).agg(
        F.sum("w").cast("bigint").alias("n"))
    grid = stats.select("low", "width", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bins") - 1)).alias("bin"))
    return grid.join(filled, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def _quartiles(rows: DataFrame, value: str, column: Column, n: str | None) -> Column:
    """Exact quartiles; of numbers that aren't counted by selection in a few scans, so these should be stored."""
    if n:
        return F.percentile(column, F.array(F.lit(0.25), F.lit(0.75)), F.col(n))
    return F.array(*(F.lit(q).cast("double") for q in selection.quantiles(rows, value, [0.25, 0.75])))


def kernel_density(rows: DataFrame, value: str, grid_size: int = 200, n: str | None = None,
                   cut: float = 0.0) -> DataFrame:
    """Gaussian kernel density on an even grid: ``grid_no``, ``x``, ``density``.

    The bandwidth follows Scott's rule, ``sd * N^(-1/5)``. A task adds what its distinct values give to the points of the
    grid in one array, so it makes one row per grid point, and the density is exact. For continuous columns pass the bins
    of ``histogram`` (middle and count). Without a value there is no grid; without spread the density is NULL.
    """
    rows, weight = _counted(rows, value, n)
    counted = written_table(
        rows.groupBy(F.col(value).cast("double").alias("x")).agg(F.sum(weight).alias("w")), "counted")
    total, x, w = F.sum("w").cast("double"), F.col("x"), F.col("w")
    mean = F.sum(x * w) / total
    moments = counted.agg(
        total.alias("n"), mean.alias("mean"), F.min("x").alias("low"), F.max("x").alias("high"))
    centre = moments.select("mean").scalar()
    spread = counted.agg(F.sum(w * F.pow(x - centre, F.lit(2.0))).alias("ss"))
    stats = moments.select(
        "n", "low", "high",
        F.sqrt(F.try_divide(spread.scalar(), F.col("n") - 1)).alias("sd"),
    ).select("n", "low", "high", (F.col("sd") * F.pow("n", F.lit(-0.2))).alias("h"))
    stats = stats.select(
        "n", "h", (F.col("low") - cut * F.col("h")).alias("low"),
        ((F.col("high") - F.col("low") + 2 * cut * F.col("h")) / (grid_size - 1)).alias("step"))
    found = stats.first()
    if found["n"] is None or found["low"] is None:
        return rows.sparkSession.createDataFrame([], "grid_no int, x double, density double")
    grid = found["low"] + np.arange(grid_size) * found["step"]
    scale = None if not found["h"] else found["n"] * found["h"] * (2 * 3.141592653589793) ** 0.5
    places = rows.sparkSession.createDataFrame(list(enumerate(grid.tolist())), "grid_no int, x double")
    if not scale:  # a single value, or no spread: no density
        return places.withColumn("density", F.lit(None).cast("double"))
    width = found["h"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, step = np.zeros(grid_size), max(1, CHUNK_NUMBERS // grid_size)
        for batch in batches:
            at, weights = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for k in range(0, len(at), step):
                distance = (grid[:, None] - at[None, k:k + step]) / width
                mass += np.exp(-0.5 * distance * distance) @ weights[k:k + step].astype(np.float64)
        yield pa.RecordBatch.from_pydict({"grid_no": pa.array(np.arange(grid_size, dtype=np.int32)), "mass": pa.array(mass)})

    masses = counted.select("x", "w").mapInArrow(spread, "grid_no int, mass double").groupBy("grid_no").agg(
        F.sum("mass").alias("mass"))
    return places.join(masses, "grid_no").select("grid_no", "x", (F.col("mass") / F.lit(scale)).alias("density"))
