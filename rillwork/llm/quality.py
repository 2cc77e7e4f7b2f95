"""Quality rules: plain limits per text, and robust outliers by language and source.

The second rule estimates the centre and shape of a vector of text statistics for
every language and source by the minimum covariance determinant: from two robust
starts, concentration steps over all rows take the share of rows that lie nearest
and estimate again; the start whose determinant ends smaller wins.  Texts far
from the centre by Mahalanobis distance are rejected.

A concentration step is one pass: squared distances are counted in bins of equal
ratio, and each bin carries the sums that a mean and a covariance need.  A group,
however large, comes down to a few hundred rows before anything is gathered.
"""

from __future__ import annotations

from collections import Counter
from math import log, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rillwork.llm.common import add_columns, saved, scratch

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
FEATURES = ("length", "word_length", "symbols", "dup_lines", "repeats")
#: Share of a group's rows that a concentration step keeps, steps, and rows a group needs.
CORE = 0.75
STEPS = 4
LEAST_ROWS = 100
#: Spread that is added to each feature: smaller differences say nothing about a text.
FLOOR = (0.25, 0.05, 0.10, 0.10, 0.10)
#: Share of normal rows that may lie beyond the limit.
BEYOND = 1e-6
#: Bins of squared distance per doubling, and lowest bin.
PER_DOUBLING = 16
LOWEST = -320


def measure_text(text: bytes | None) -> tuple[int, ...]:
    """The six counts of one whole text; a null text has none of anything."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.split()
    n = len(words)
    chars = len(text.translate(None, b" \t\n\x0b\x0c\r").decode())
    symbols = len(text) - len(text.translate(None, b"#*$%&|<>"))
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = bytearray(n)
        for i, w in enumerate(windows):
            if times[w] > 1:
                covered[i] = covered[i + 1] = covered[i + 2] = 1
        repeated = sum(covered)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def measure(df: DataFrame, text: str = "text", prefix: str = "", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add the six counts of every whole text."""
    return add_columns(
        df, [text], [(prefix + c, T.LongType()) for c in COUNTS], lambda: measure_text, drop
    )


def failed(prefix: str = "") -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    n, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * repeats > 50 * n)


def features(prefix: str = "") -> list[Column]:
    """Logarithms and roots bring the counts to about even spread."""
    words = F.greatest(F.col(f"{prefix}n_words"), F.lit(1))
    lines = F.greatest(F.col(f"{prefix}n_lines"), F.lit(1))
    return [
        F.log(words.cast("double")),
        F.log((F.col(f"{prefix}word_chars") + 1) / words),
        F.sqrt(F.col(f"{prefix}n_symbols") / words),
        F.sqrt(F.col(f"{prefix}n_dup_lines") / lines),
        F.sqrt(F.col(f"{prefix}n_repeat_words") / words),
    ]


def group_key(*columns: str) -> Column:
    """Language and source, or language alone, as one key; null is a value of its own."""
    return F.concat_ws(
        "\x01",
        *[F.when(F.col(c).isNull(), F.lit("\x02")).otherwise(F.col(c).cast("string")) for c in columns],
    )


def chi_squared(p: int, share: float) -> float:
    """The quantile of chi squared, by the cube-root normal approximation."""
    z = NormalDist().inv_cdf(share)
    return p * (1 - 2 / (9 * p) + z * sqrt(2 / (9 * p))) ** 3


LIMIT = chi_squared(len(FEATURES), 1 - BEYOND)

PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
SHAPE = T.StructType(
    [
        T.StructField("grp", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("centre", T.ArrayType(T.DoubleType())),
        T.StructField("inverse", T.ArrayType(T.DoubleType())),
        T.StructField("size", T.DoubleType()),
        T.StructField("scale", T.DoubleType()),
    ]
)


def shape_row(grp: str, start: int, centre, covariance, scale: float = 1.0) -> tuple:
    """Parameters of one group: the covariance gets the floor and is inverted."""
    widened = np.asarray(covariance) + np.diag(np.square(FLOOR))
    inverse = np.linalg.inv(widened)
    weights = [float(inverse[i, j] * (1 if i == j else 2)) for i, j in PAIRS]
    return grp, start, [float(c) for c in centre], weights, float(np.linalg.slogdet(widened)[1]), scale


def squared_distance() -> Column:
    """Mahalanobis distance, squared, of the feature columns from a joined group's centre."""
    d = [F.col(f) - F.col("centre")[i] for i, f in enumerate(FEATURES)]
    terms = [d[i] * d[j] * F.col("inverse")[k] for k, (i, j) in enumerate(PAIRS)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


def starts(rows: DataFrame) -> DataFrame:
    """Two robust first estimates per group.

    Start 0 takes medians and the spread around them, counted on a grid of 1/64;
    start 1 the plain moments of rows cut to three such spreads around the median.
    """
    grid = 64
    cells = rows.select(
        "grp", F.posexplode(F.array(*[F.round(F.col(f) * grid).cast("int") for f in FEATURES])).alias("f", "bin")
    )
    counted = saved(cells.groupBy("grp", "f", "bin").agg(F.count(F.lit(1)).alias("n")), "grid")

    def spread(table: pa.Table) -> pa.Table:
        grp = table["grp"][0].as_py()
        f, b, n = (np.array(table[c]) for c in ("f", "bin", "n"))
        middle, wide, cut_mean, cut_var = [], [], [], []
        for i in range(len(FEATURES)):
            order = np.argsort(b[f == i], kind="stable")
            x, w = b[f == i][order] / grid, n[f == i][order]
            m = x[np.searchsorted(np.cumsum(w), w.sum() / 2)]
            away = np.abs(x - m)
            by = np.argsort(away, kind="stable")
            mad = 1.4826 * away[by][np.searchsorted(np.cumsum(w[by]), w.sum() / 2)]
            cut = np.clip(x, m - 3 * (mad + FLOOR[i]), m + 3 * (mad + FLOOR[i]))
            mean = np.average(cut, weights=w)
            middle.append(m)
            wide.append(mad**2)
            cut_mean.append(mean)
            cut_var.append(np.average((cut - mean) ** 2, weights=w))
        made = [shape_row(grp, 0, middle, np.diag(wide)), shape_row(grp, 1, cut_mean, np.diag(cut_var))]
        return pa.table([list(c) for c in zip(*made)], schema=to_arrow_schema(SHAPE))

    return saved(counted.groupBy("grp").applyInArrow(spread, SHAPE), "start")


def concentrate(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """One concentration step of every group and start over all its rows."""
    joined = rows.join(shapes, "grp").withColumn("d2", squared_distance())
    bin_ = F.greatest(
        F.floor(F.log2(F.greatest("d2", F.lit(1e-9))) * PER_DOUBLING), F.lit(LOWEST)
    ).cast("int")
    sums = [F.sum(F.col(f)).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    sums += [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}{j}") for i, j in PAIRS]
    binned = joined.groupBy("grp", "start", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), *sums)
    half = chi_squared(len(FEATURES), 0.5)

    def estimate(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array(table["bin"]), kind="stable")
        n = np.array(table["n"])[order]
        upto = np.cumsum(n)
        take = np.searchsorted(upto, CORE * upto[-1]) + 1
        core = upto[take - 1]

        def total(column):
            return np.array(table[column])[order][:take].sum()

        centre = np.array([total(f"s{i}") for i in range(len(FEATURES))]) / core
        covariance = np.zeros((len(FEATURES), len(FEATURES)))
        for i, j in PAIRS:
            covariance[i, j] = covariance[j, i] = total(f"p{i}{j}") / core - centre[i] * centre[j]
        # Of the distances just used: a normal law has its median at ``half``.
        middle = np.array(table["bin"])[order][np.searchsorted(upto, upto[-1] / 2)]
        scale = 2.0 ** ((middle + 0.5) / PER_DOUBLING) / half
        row = shape_row(
            table["grp"][0].as_py(), table["start"][0].as_py(), centre, covariance, max(scale, 1.0)
        )
        return pa.table([[v] for v in row], schema=to_arrow_schema(SHAPE))

    return saved(binned.groupBy("grp", "start").applyInArrow(estimate, SHAPE), "shape")


def estimates(rows: DataFrame) -> DataFrame:
    """The winning estimate of every group of ``rows`` (columns grp and the features)."""
    shapes = starts(rows)
    for _ in range(STEPS + 1):
        before, shapes = shapes, concentrate(rows, shapes)
    # The last pass gave the scale of the distances that ``before`` measures.
    final = before.drop("scale").join(shapes.select("grp", "start", "scale"), ["grp", "start"])
    best = F.row_number().over(Window.partitionBy("grp").orderBy("size", "start"))
    return saved(final.withColumn("place", best).filter("place = 1").drop("place", "start"), "estimate")


def judged(
    df: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "", counts: DataFrame | None = None
) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to a measured table.

    ``counts`` is the same table, written out already, with at least the counts,
    language and source; ``df`` itself unless given.  Estimates come from the texts that pass the plain limits, per language and
    source; a group with fewer than ``LEAST_ROWS`` of them is judged by all texts of its
    language, or if those are too few by all texts, and if even those are, all are kept.  Null language and null source
    are values like others.  Texts that fail the plain limits are never kept.
    """

    def with_features(table: DataFrame) -> DataFrame:
        return table.withColumn("_grp", group_key(lang, source)).withColumns(
            {f"_{f}": c for f, c in zip(FEATURES, features(prefix))}
        )

    keyed = with_features(df)
    passing = with_features(df if counts is None else counts).filter(~failed(prefix)).select(
        F.col("_grp").alias("own"), group_key(lang).alias("tongue"), *[F.col(f"_{f}").alias(f) for f in FEATURES]
    )
    with scratch(df.sparkSession):
        sizes = saved(passing.groupBy("own", "tongue").agg(F.count(F.lit(1)).alias("n")), "groups")
        tongues = saved(sizes.groupBy("tongue").agg(F.sum("n").alias("m")), "tongues")
        all_ = tongues.agg(F.sum("m")).first()[0] or 0
        levels = F.array(F.concat(F.lit("own "), "own"), F.concat(F.lit("lang "), "tongue"), F.lit("all"))
        level = F.when(F.col("n") >= LEAST_ROWS, levels[0]).when(F.col("m") >= LEAST_ROWS, levels[1])
        groups = sizes.join(tongues, "tongue").select("own", "tongue", level.otherwise(levels[2]).alias("grp"))
        groups = saved(groups.filter(F.lit(all_ >= LEAST_ROWS)), "levels")
        # A group's rows count in every estimate that some group is judged by.
        used = groups.select("grp").distinct()
        feeds = groups.select("own", F.explode(levels).alias("grp")).join(used, "grp", "left_semi")
        rows = saved(passing.drop("tongue").join(feeds, "own").drop("own"), "features")
        groups = groups.select("own", "grp")
        found = estimates(rows)
        by_own = saved(groups.join(found, "grp").drop("grp"), "verdicts", outlives=True)
    marked = keyed.withColumnsRenamed({f"_{f}": f"_f_{f}" for f in FEATURES})
    marked = marked.join(by_own, marked["_grp"] == by_own["own"], "left")
    d = marked.withColumns({f: F.col(f"_f_{f}") for f in FEATURES}).withColumn(
        "_d2", F.round(squared_distance() / F.col("scale"), 6)
    )
    far = F.coalesce(F.col("_d2") > LIMIT, F.lit(False))
    return d.withColumn("base_failed", failed(prefix)).withColumn("kept", ~F.col("base_failed") & ~far)


def rules(df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail; whole texts of any length are
    measured; repeated rows get a row each; an empty table gives an empty result;
    other columns are ignored.  Calling it runs jobs.
    """
    slim = measure(df.select(id, lang, source, text), text, drop=(text,))
    out = judged(saved(slim, "measured"), lang, source)
    return out.select(id, *COUNTS[:5], "base_failed", "kept", F.col("_d2").alias("distance"))


def keep_good(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that ``rules`` keeps, with all their columns, whatever their names.

    Null and empty texts fail; repeated rows are judged alike and all stay or go; an
    empty table stays empty.  Calling it runs jobs; texts are measured twice.
    """
    # The row travels as one column, so its columns cannot clash with the operator's own.
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        F.col(lang).alias("_lang"), F.col(source).alias("_source"),
    )
    # Texts are measured twice, so that no second copy of them is written.
    slim = df.select(F.col(text).alias("_text"), F.col(lang).alias("_lang"), F.col(source).alias("_source"))
    counts = saved(measure(slim, "_text", drop=("_text",)), "measured")
    whole = measure(packed, f"_row.{text}")
    return judged(whole, "_lang", "_source", counts=counts).filter("kept").select("_row.*")
