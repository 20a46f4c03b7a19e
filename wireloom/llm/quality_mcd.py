"""Quality rules: robust multivariate outliers among document statistics, per language and source.

Each document becomes a vector of transformed statistics.  Per cell (language and source) the minimum-covariance-
determinant estimate is found by concentration steps over all documents of the cell: order by Mahalanobis distance,
take the nearest half, estimate mean and covariance from these, again, until the determinant of the covariance stops
falling.  This is done from three first orders side by side (around the medians, lower and upper quartiles, each by the
median absolute deviations, which hold until half of a cell is of another kind); the least determinant wins.  A document is rejected if its distance from its cell's estimate is beyond ``cut``.

A step is one pass that sums counts, components and products per cell and distance bin before anything is shuffled;
the bins up to the needed share then give the new estimate.  So a cell may hold any part of the rows.  Components are
whole numbers (``UNIT``-ths), so sums are exact and the same in any order.

Each variance gets a floor (most statistics are zero in clean text, so a plain covariance would be singular), and the
covariance is scaled so that the median distance is that of normal data.  Languages and sources with fewer than
``least`` documents are judged together: by language, else all of them.

Nulls: a null text has no words and fails the base rules; a null language or source is one of its own.  Repeated rows
are judged alike.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement, count

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireloom.llm.storage import stored

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
REPEATED = 8
#: Components are kept as whole numbers of this part of one.
UNIT = 256
#: Least standard deviation of each component.
FLOORS = (0.08, 0.15, 0.35, 0.1, 1.2)
PAIRS = list(combinations_with_replacement(range(len(FLOORS)), 2))
#: Squared distance beyond which a document is rejected: 0.99999 of normal data in five dimensions is within.
CUT = 30.86
#: Median of the squared distance of normal data in five dimensions.
MEDIAN = 4.351
#: A determinant has stopped falling if a step takes off less than this part of it.
STILL = 1e-6
#: Bins of distance for each factor of e.
FINE = 64


def repeated_words(words: Sequence[bytes], size: int = REPEATED) -> int:
    """Words in windows of ``size`` words that are found twice or more.

    Windows get exact names by doubling: the name of 2n words is that of the pair of names of n words.
    """
    if len(words) <= size:
        return 0
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    names = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    span = 1
    while span < size:
        step = min(span, size - span)
        pair = names[: len(names) - step] * (len(words) + 1) + names[step:]
        named, names = np.unique(pair, return_inverse=True)
        if len(named) == len(pair):
            return 0
        span += step
    often = np.bincount(names)[names] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[: len(often)] += often
    edges[size : size + len(often)] -= often
    return int((np.cumsum(edges) > 0).sum())


def text_statistics(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    words = text.split()
    data = np.frombuffer(text, "u1")
    points = int(((data & 0xC0) != 0x80).sum())
    white = len(text) - len(text.translate(None, WHITE))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = Counter(text.split(b"\n")) if b"\n" in text else {}
    repeated = sum(n - 1 for line, n in lines.items() if n > 1 and line.strip())
    return len(words), points - white, symbols, repeated, repeated_words(words)


def with_statistics(docs: DataFrame, columns: Sequence[str], text_col: str = "text") -> DataFrame:
    """These columns of a table with the statistics of its texts."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [text_statistics(text.as_py() or b"") for text in batch.column("_utf8")]
            own = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [()] * len(STATISTICS))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *own], [*columns, *STATISTICS])

    kept = docs.select(*columns)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(name, T.LongType()) for name in STATISTICS)])
    return docs.select(*columns, F.col(text_col).cast("binary").alias("_utf8")).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def components() -> list[Column]:
    """Transformed statistics in whole ``UNIT``-ths; ratios are drawn to usual values where words are few."""
    n = F.col("n_words").cast("double")
    vector = [
        F.log((F.col("word_chars") + 1000) / (n + 200)),
        F.log1p(10 * F.col("n_symbols") / (n + 20)),
        F.log1p(100 * F.col("n_dup_lines") / (n + 100)),
        F.col("n_repeat_words") / (n + 1),
        F.log1p(n),
    ]
    return [F.round(x * UNIT).cast("long").alias(f"x{j}") for j, x in enumerate(vector)]


def cells(passed: DataFrame, least: int) -> DataFrame:
    """Rows with ``cell``: language and source, or what small ones are judged with."""
    sizes = passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < least
    per_lang = Window.partitionBy("lang")  # one row per source of a language
    pooled = F.sum(F.when(small, F.col("n"))).over(per_lang)
    named = sizes.select(
        "lang",
        "source",
        F.when(~small, F.to_json(F.struct("lang", "source", F.lit(0).alias("level"))))
        .when(pooled >= least, F.to_json(F.struct("lang", F.lit(1).alias("level"))))
        .otherwise("small")
        .alias("cell"),
    )
    return stored(named, "quality-cells")


def join_cells(rows: DataFrame, named: DataFrame) -> DataFrame:
    named = named.withColumnsRenamed({"lang": "_own_lang", "source": "_own_source"})
    return rows.join(named, rows["lang"].eqNullSafe(named["_own_lang"]) & rows["source"].eqNullSafe(named["_own_source"])).drop("_own_lang", "_own_source")


def first_estimate(vectors: DataFrame) -> DataFrame:
    """Medians and quartile ranges of each component of each cell, from exact counts of its values."""
    p = len(FLOORS)
    values = vectors.select("cell", F.posexplode(F.array(*(f"x{j}" for j in range(p)))).alias("j", "x"))
    counts = values.groupBy("cell", "j", "x").agg(F.count("*").alias("n"))
    each = Window.partitionBy("cell", "j")  # one row per value
    ranked = counts.withColumns({"upto": F.sum("n").over(each.orderBy("x")), "total": F.sum("n").over(each)})

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("x")))

    found = ranked.groupBy("cell", "j").agg(quantile(0.5).alias("mid"), (quantile(0.75) - quantile(0.25)).alias("range"))
    each_cell = found.groupBy("cell")  # one row per component
    middles = F.array(*(F.max(F.when(F.col("j") == j, F.col("mid"))).cast("double") for j in range(p)))
    ranges = F.array(*(F.max(F.when(F.col("j") == j, F.col("range"))).cast("double") for j in range(p)))
    return each_cell.agg(middles.alias("mean"), ranges.alias("range")).mapInPandas(_spread, "cell string, mean array<double>, inverse array<double>")


def _inverse(covariance: np.ndarray, scale: float = 1.0) -> list[float]:
    floored = covariance * scale + np.diag((np.array(FLOORS) * UNIT) ** 2)
    inverse = np.linalg.inv(floored)
    return [float(inverse[i, j] * (1 if i == j else 2)) for i, j in PAIRS]


def _spread(frames):
    for frame in frames:
        inverse = [_inverse(np.diag((np.array(r) / 1.349) ** 2)) for r in frame["range"]]
        yield frame.assign(inverse=inverse)[["cell", "mean", "inverse"]]


def _concentrated(frames):
    """Mean and inverse covariance from sums."""
    for frame in frames:
        means, inverses = [], []
        for n, sums, products in zip(frame["n"], frame["sums"], frame["products"], strict=True):
            mean = np.array(sums, float) / n
            covariance = np.zeros((len(FLOORS), len(FLOORS)))
            for (i, j), product in zip(PAIRS, products, strict=True):
                covariance[i, j] = covariance[j, i] = product / n - mean[i] * mean[j]
            means.append(mean.tolist())
            inverses.append(_inverse(covariance))
        yield frame.assign(mean=means, inverse=inverses)[["cell", "mean", "inverse"]]


def first_estimates(vectors: DataFrame) -> DataFrame:
    """Three starts of each cell: around medians, lower and upper quartiles, all by median absolute deviations."""
    p = len(FLOORS)
    values = vectors.select("cell", F.posexplode(F.array(*(f"x{j}" for j in range(p)))).alias("j", "x"))
    counts = stored(values.groupBy("cell", "j", "x").agg(F.count("*").alias("n")), "quality-values")
    each = Window.partitionBy("cell", "j")  # one row per value

    def quantiles(of: DataFrame, **wanted: float) -> DataFrame:
        ranked = of.withColumns({"upto": F.sum("n").over(each.orderBy("x")), "total": F.sum("n").over(each)})
        found = [F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("x"))).alias(name) for name, q in wanted.items()]
        return ranked.groupBy("cell", "j").agg(*found)

    middles = quantiles(counts, at0=0.5, at1=0.25, at2=0.75)
    away = counts.join(middles.select("cell", "j", "at0"), ["cell", "j"]).select("cell", "j", F.abs(F.col("x") - F.col("at0")).alias("x"), "n")
    spread = quantiles(away.groupBy("cell", "j", "x").agg(F.sum("n").alias("n")), mad=0.5)

    def vector(name: str) -> Column:
        return F.array(*(F.max(F.when(F.col("j") == j, F.col(name))).cast("double") for j in range(p)))

    whole = middles.join(spread, ["cell", "j"]).groupBy("cell").agg(*(vector(name).alias(name) for name in ("at0", "at1", "at2", "mad")))  # one row per component
    starts = whole.select("cell", "mad", F.posexplode(F.array("at0", "at1", "at2")).alias("start", "mean"))
    return starts.mapInPandas(_started, ESTIMATE)


ESTIMATE = "cell string, start int, mean array<double>, inverse array<double>, logdet double"


def _started(frames):
    for frame in frames:
        inverse = [_inverse(np.diag((np.array(m) * 1.4826) ** 2)) for m in frame["mad"]]
        yield frame.assign(inverse=inverse, logdet=np.inf)[["cell", "start", "mean", "inverse", "logdet"]]


def _with_determinants(frames):
    """Estimates from sums, with the logarithms of the determinants of their covariances."""
    for frame in frames:
        rows = next(_concentrated([frame]))
        logdets = []
        for inverse in rows["inverse"]:
            matrix = np.zeros((len(FLOORS), len(FLOORS)))
            for (i, j), x in zip(PAIRS, inverse, strict=True):
                matrix[i, j] = matrix[j, i] = x if i == j else x / 2
            logdets.append(-float(np.linalg.slogdet(matrix)[1]))
        yield rows.assign(start=frame["start"], logdet=logdets)[["cell", "start", "mean", "inverse", "logdet"]]


def squared_distance() -> Column:
    """Of components from ``mean`` by ``inverse``."""
    apart = [F.col(f"x{j}") - F.col("mean")[j] for j in range(len(FLOORS))]
    terms = [F.col("inverse")[k] * apart[i] * apart[j] for k, (i, j) in enumerate(PAIRS)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _binned(vectors: DataFrame, estimate: DataFrame, keys: Sequence[str] = ("cell",)) -> DataFrame:
    step = F.floor(F.log1p(F.greatest(squared_distance(), F.lit(0.0))) * FINE).alias("bin")
    return vectors.join(estimate, "cell").select(*keys, step, *(f"x{j}" for j in range(len(FLOORS))))


def nearest(vectors: DataFrame, estimate: DataFrame, share: float, keys: Sequence[str] = ("cell",)) -> DataFrame:
    """Counts, sums and products of the ``share`` of each cell that is nearest to each of its estimates."""
    sums = [F.sum(f"x{j}").alias(f"s{j}") for j in range(len(FLOORS))]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in PAIRS]
    binned = _binned(vectors, estimate, keys).groupBy(*keys, "bin").agg(F.count("*").alias("n"), *sums, *products)
    each = Window.partitionBy(*keys)  # one row per bin
    near = binned.withColumns({"upto": F.sum("n").over(each.orderBy("bin")), "total": F.sum("n").over(each)})
    near = near.filter(F.col("upto") - F.col("n") < F.ceil(F.col("total") * share))
    return near.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.array(*(F.sum(f"s{j}").cast("double") for j in range(len(FLOORS)))).alias("sums"),
        F.array(*(F.sum(f"p{i}{j}").cast("double") for i, j in PAIRS)).alias("products"),
    )


def concentrate(vectors: DataFrame, estimate: DataFrame, share: float) -> DataFrame:
    """One concentration step: the estimate from the ``share`` of each cell that is nearest to the one before."""
    return nearest(vectors, estimate, share).mapInPandas(_concentrated, "cell string, mean array<double>, inverse array<double>")


def scales(vectors: DataFrame, estimate: DataFrame) -> DataFrame:
    """Per cell, by what the covariance must grow for the median distance to be that of normal data."""
    counts = _binned(vectors, estimate).groupBy("cell", "bin").agg(F.count("*").alias("n"))
    each = Window.partitionBy("cell")
    ranked = counts.withColumns({"upto": F.sum("n").over(each.orderBy("bin")), "total": F.sum("n").over(each)})
    middle = F.min(F.when(F.col("upto") * 2 >= F.col("total"), F.col("bin")))
    return ranked.groupBy("cell").agg(F.greatest(F.lit(1.0), F.expm1((middle + 1) / FINE) / MEDIAN).alias("scale"))


def fit(vectors: DataFrame, share: float = 0.75, steps: int = 4) -> DataFrame:
    """Estimates (cell, mean, inverse, scale) of all cells from one start by a fixed number of steps; ``vectors`` has cell and x0...; store it first."""
    estimate = stored(first_estimate(vectors), "quality-estimate")
    for _ in range(steps):
        estimate = stored(concentrate(vectors, estimate, share), "quality-estimate")
    return stored(estimate.join(scales(vectors, estimate), "cell"), "quality-estimate")


def least_determinant(vectors: DataFrame, share: float = 0.5) -> DataFrame:
    """Estimates (cell, mean, inverse, scale) of least determinant over all starts of each cell, each stepped until its determinant stops falling."""
    active = stored(first_estimates(vectors), "quality-estimate")
    done: list[DataFrame] = []
    while not active.isEmpty():
        sums = nearest(vectors, active, share, ("cell", "start"))
        made = sums.mapInPandas(_with_determinants, ESTIMATE)
        before = active.select("cell", "start", F.col("logdet").alias("was"))
        made = stored(made.join(before, ["cell", "start"]).withColumn("falls", F.col("logdet") < F.col("was") + math.log1p(-STILL)), "quality-estimate")
        done.append(made.drop("was", "falls"))
        active = made.filter("falls").drop("was", "falls")
    if not done:
        return stored(fit(vectors, share, 0), "quality-estimate")
    every = reduce(DataFrame.unionByName, done)
    best = every.groupBy("cell").agg(F.min_by(F.struct("mean", "inverse"), F.struct("logdet", "start")).alias("m")).select("cell", "m.mean", "m.inverse")
    best = stored(best, "quality-estimate")
    return stored(best.join(scales(vectors, best), "cell"), "quality-estimate")


def judged(docs: DataFrame, columns: Sequence[str], *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", share: float = 0.5, cut: float = CUT, least: int = 50) -> DataFrame:
    """These columns with statistics, ``base_failed`` and ``kept``.  ``columns`` must not bear names of statistics."""
    taken = docs.select(*columns, F.col(text_col).alias("_text"), F.col(lang_col).alias("_cell_lang"), F.col(source_col).alias("_cell_source"))
    if text_col in columns:  # texts are not stored a second time; their statistics are taken once for the fit and once for the verdict
        found = with_statistics(taken, [*columns, "_cell_lang", "_cell_source"], "_text")
        fitted = stored(with_statistics(taken, ["_cell_lang", "_cell_source"], "_text"), "quality-statistics")
    else:
        found = fitted = stored(with_statistics(taken, [*columns, "_cell_lang", "_cell_source"], "_text"), "quality-statistics")
    found = found.withColumn("base_failed", base_failed())
    slim = fitted.filter(~base_failed()).select(F.col("_cell_lang").alias("lang"), F.col("_cell_source").alias("source"), *components())
    named = cells(slim, least)
    vectors = stored(join_cells(slim, named).drop("lang", "source"), "quality-vectors")
    estimate = named.join(least_determinant(vectors, share), "cell").withColumnsRenamed({"lang": "_own_lang", "source": "_own_source"})
    estimate = stored(estimate, "quality-model")
    same = found["_cell_lang"].eqNullSafe(estimate["_own_lang"]) & found["_cell_source"].eqNullSafe(estimate["_own_source"])
    rows = found.select("*", *components()).join(estimate, same, "left")
    near = squared_distance() <= F.col("scale") * F.lit(cut)
    return rows.select(*columns, *STATISTICS, "base_failed", (~F.col("base_failed") & F.coalesce(near, F.lit(True))).alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, statistics, base_failed and kept of every document."""
    return judged(docs, ["doc_id"])

