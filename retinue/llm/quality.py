"""Quality rules: robust multivariate outliers among document statistics."""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, lgamma, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.frames import ROW, WORD, carried, words_of
from retinue.operators.staging import settle

# Fixed value: characters that count as symbols.
SYMBOL = r"[#*$%&|<>]"


def statistics(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **keep: str) -> DataFrame:
    """Word and line statistics of whole texts, with built-in functions only.

    Adds to ``doc_id`` and the columns ``keep`` names: ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an earlier line) and
    ``n_repeat_words`` (words in 3-word windows that the text has twice or more). Null text
    has no words.

    Windows are compared by a 64-bit hash. Where all differ, which sorts nothing, the last
    count is 0. Otherwise the sorted (hash, position) pairs show which windows repeat, and
    the gaps between their positions add up to the words they cover.
    """
    rows = carried(docs, doc_id=doc_id, body=F.coalesce(F.col(text), F.lit("")), **keep).drop(ROW)
    counted = rows.withColumns(
        {
            "words": words_of(F.col("body")),
            "lines": F.filter(F.split("body", "\n", -1), lambda line: line.rlike(WORD)),
            "n_symbols": F.regexp_count("body", F.lit(SYMBOL)).cast("bigint"),
        }
    )
    counted = counted.select(
        "doc_id",
        *keep,
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
    )
    hashed = counted.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word))).drop("words")
    follower = lambda i: F.get(F.col("hashes"), i)
    windows = F.transform("hashes", lambda first, i: F.xxhash64(first, follower(i + 1), follower(i + 2)))
    windowed = hashed.withColumn("windows", F.slice(windows, F.lit(1), F.greatest(F.size("hashes") - 2, F.lit(0))))
    pairs = F.transform("windows", lambda window, i: F.struct(window.alias("w"), i.alias("i")))
    differ = F.size(F.array_distinct("windows")) == F.size("windows")
    ordered = windowed.drop("hashes").withColumn("ordered", F.when(~differ, F.sort_array(pairs))).drop("windows")
    same = lambda pair, other: F.coalesce(F.get(F.col("ordered"), other)["w"] == pair["w"], F.lit(False))
    repeated = F.filter("ordered", lambda pair, j: same(pair, j - 1) | same(pair, j + 1))
    placed = ordered.withColumn("places", F.sort_array(F.transform(repeated, lambda pair: pair["i"]))).drop("ordered")
    widths = F.transform(
        "places", lambda place, j: F.least(F.lit(3), F.coalesce(F.get(F.col("places"), j + 1) - place, F.lit(3)))
    )
    covered = F.aggregate(widths, F.lit(0), lambda total, width: total + width)
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("places")


# Scale below which a feature's spread is not believed: more than half of all clean texts
# have no symbol, repeated line or repeated window at all, so their plain spread is 0.
# Each stands above the effect of one symbol or repeated line on a text of common size. Where
# a team has no spread and all else is usual, a text goes at the default tail (6.18 floors)
# from a mean word length changed by a factor of 1.25, 3 % symbols, 3 repeated lines or 20 %
# of words in repeated windows, all below what the base rules allow.
FLOORS = (0.036, 0.028, 0.223, 0.072)


def features() -> list[Column]:
    """Transformed statistics: log mean word length, roots of the shares, log repeated lines."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return [
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.log1p(F.col("n_dup_lines").cast("double")),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def chi_square_cdf(x: float, degrees: int) -> float:
    """Series of the regularised lower incomplete gamma function."""
    a, half = degrees / 2, x / 2
    if half <= 0:
        return 0.0
    term = exp(a * log(half) - half - lgamma(a + 1))
    total, n = 0.0, 0
    while term > 1e-17 * max(total, 1e-300) or n < half:
        total += term
        n += 1
        term *= half / (a + n)
    return min(1.0, total)


def chi_square_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < share else (low, middle)
    return high


def _factors(dims: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(dims) for j in range(i + 1)]


def _with_factor(moments: DataFrame, floors: Sequence[float]) -> DataFrame:
    """From ``mean`` and ``cov`` (lower triangle by rows): ``factor``, with factor · cov · factorᵀ = 1.

    The squared floors are added to the diagonal, so the matrix is never singular.
    """
    dims = len(floors)
    place = {pair: k for k, pair in enumerate(_factors(dims))}
    out = moments
    for i, j in _factors(dims):  # Cholesky: cov = L · Lᵀ
        value = F.col("cov")[place[i, j]] + F.lit(floors[i] ** 2 if i == j else 0.0)
        for k in range(j):
            value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(value) if i == j else value / F.col(f"l{j}{j}"))
    for i, j in _factors(dims):  # L⁻¹ by forward substitution
        if i == j:
            value = 1 / F.col(f"l{i}{i}")
        else:
            value = -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}")
        out = out.withColumn(f"w{i}{j}", value)
    spread = sum((F.log(F.col(f"l{i}{i}")) for i in range(dims)), F.lit(0.0))
    return out.withColumn("factor", F.array(*[F.col(f"w{i}{j}") for i, j in _factors(dims)])).select(
        *moments.columns, "factor", (2 * spread).alias("log_det")
    )


def _distance(dims: int) -> Column:
    """Squared Mahalanobis distance of ``x`` to ``mean``."""
    rows = []
    for i in range(dims):
        terms = [
            F.col("factor")[k] * (F.col("x")[j] - F.col("mean")[j])
            for k, (row, j) in enumerate(_factors(dims))
            if row == i
        ]
        rows.append(sum(terms[1:], terms[0]))
    return sum((r * r for r in rows[1:]), rows[0] * rows[0])


def _moments(dims: int) -> list[Column]:
    x = [F.col("x")[i] for i in range(dims)]
    return [
        F.array(*[F.avg(c) for c in x]).alias("mean"),
        F.array(*[F.covar_pop(x[i], x[j]) for i, j in _factors(dims)]).alias("cov"),
    ]


def mcd(
    points: DataFrame, *, floors: Sequence[float] = FLOORS, support: float = 0.75, steps: int = 3, accuracy: int = 2000
) -> DataFrame:
    """Minimum-covariance-determinant estimate of each ``team`` of points ``x`` (array of doubles).

    Two starts, the median with the median deviations and the classical moments, each take
    ``steps`` concentration steps: the ``support`` share of points with the smallest distances
    gives the next mean and covariance. Per team the start with the smaller determinant wins.
    Returns ``team``, ``mean`` and ``factor`` (see ``_with_factor``); the covariance is
    scaled to be consistent for normal data. ``points`` is read twice a step.

    The share is cut at an approximate percentile (1 / ``accuracy`` of the ranks), which merges
    partial results: a team with a third of all points is never gathered in one task. Means
    and covariances combine in the same way.
    """
    dims = len(floors)
    x = [F.col("x")[i] for i in range(dims)]
    middle = settle(
        points.groupBy("team").agg(F.array(*[F.percentile_approx(c, 0.5, accuracy) for c in x]).alias("mean"))
    )
    off = [F.percentile_approx(F.abs(c - F.col("mean")[i]), 0.5, accuracy) for i, c in enumerate(x)]
    # 1.4826 makes the median deviation of normal data its standard deviation.
    robust = (
        points.join(middle, "team")
        .groupBy("team", "mean")
        .agg(F.array(*[(1.4826 * o) * (1.4826 * o) for o in off]).alias("diagonal"))
        .select(
            "team",
            F.lit(0).alias("start"),
            "mean",
            F.array(*[F.col("diagonal")[i] if i == j else F.lit(0.0) for i, j in _factors(dims)]).alias("cov"),
        )
    )
    classical = points.groupBy("team").agg(*_moments(dims)).select("team", F.lit(1).alias("start"), "mean", "cov")
    estimate = settle(_with_factor(robust.unionByName(classical), floors))
    for _ in range(steps):
        near = points.join(estimate.select("team", "start", "mean", "factor"), "team").select(
            "team", "start", "x", _distance(dims).alias("d")
        )
        cuts = settle(near.groupBy("team", "start").agg(F.percentile_approx("d", support, accuracy).alias("cut")))
        inside = near.join(cuts, ["team", "start"]).where(F.col("d") <= F.col("cut"))
        estimate = settle(_with_factor(inside.groupBy("team", "start").agg(*_moments(dims)), floors))
    best = estimate.groupBy("team").agg(F.min(F.struct("log_det", "start", "mean", "cov")).alias("best"))
    # The central share of a normal distribution has a smaller covariance, by this factor.
    shrunk = chi_square_cdf(chi_square_quantile(support, dims), dims + 2) / support
    scaled = best.select("team", F.col("best.mean").alias("mean"), F.transform("best.cov", lambda c: c / shrunk).alias("cov"))
    return settle(_with_factor(scaled, floors).select("team", "mean", "factor"))


def judge(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_words: int = 50,
    most_repeated: int = 50,
    least_team: int = 100,
    tail: float = 1e-7,
    **estimation,
) -> DataFrame:
    """Reject documents whose statistics lie far from those of their language and source.

    The base rules fail a text with fewer than ``min_words`` words, or with more than
    ``most_repeated`` percent of its words in repeated windows. The others of each language
    and source get a robust centre and covariance of their transformed statistics
    (:func:`mcd`). A text is rejected if its Mahalanobis distance exceeds what normal data
    exceed with probability ``tail``. Teams of fewer than ``least_team`` texts are pooled by
    language, and what is still smaller over all languages; a pool that small rejects nothing.

    Returns one row per input row: ``doc_id``, ``lang``, ``source``, the five statistics,
    ``base_failed``, ``distance`` (squared; null where no estimate applies), ``kept``. Null or
    empty text has no words and fails the base rules. A null language or source is a value
    of its own. Rows may repeat; each counts. Points at the same distance are in or out of
    the central share together, and a point exactly on the cut is kept. One text, however
    long, is a row of a task, with its windows beside it. An empty table gives an empty result.
    """
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    measured = statistics(docs, doc_id=doc_id, text=text, lang=lang, source=source).withColumns(
        {"base_failed": base_failed, "x": F.array(*features())}
    )
    stored = settle(measured)
    passing = stored.where(~F.col("base_failed")).select("lang", "source", "x")
    counts = passing.groupBy("lang", "source").count()
    own = counts.where(F.col("count") >= least_team).select(
        "lang", "source", F.to_json(F.struct(F.lit(0), "lang", "source")).alias("team")
    )
    small = counts.where(F.col("count") < least_team)
    pools = small.groupBy("lang").agg(F.sum("count").alias("pool"))
    rest = (
        small.alias("a")
        .join(pools.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang")))
        .select(
            "a.lang",
            "source",
            F.when(F.col("pool") >= least_team, F.to_json(F.struct(F.lit(1), "a.lang")))
            .otherwise(F.lit("2"))
            .alias("team"),
        )
    )
    teams = settle(own.unionByName(rest))
    together = F.col("a.lang").eqNullSafe(F.col("b.lang")) & F.col("a.source").eqNullSafe(F.col("b.source"))
    points = settle(passing.alias("a").join(teams.alias("b"), together).select("team", "x"))
    sizes = settle(points.groupBy("team").count().where(F.col("count") >= least_team).select("team"))
    estimates = mcd(points.join(sizes, "team", "left_semi"), **estimation)
    dims = len(estimation.get("floors", FLOORS))
    cut = chi_square_quantile(1 - tail, dims)
    return (
        stored.alias("a")
        .join(teams.alias("b"), together, "left")
        .select("a.*", F.when(~F.col("base_failed"), F.col("team")).alias("team"))
        .join(estimates, "team", "left")
        .withColumn("distance", _distance(dims))
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True)))
        .select(*[c for c in measured.columns if c != "x"], "distance", "kept")
    )
