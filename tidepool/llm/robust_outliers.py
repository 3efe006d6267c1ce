"""Quality rules by robust multivariate outliers, with DataFrame functions only.

Each text becomes a vector of transformed statistics. Per language and source the minimum
covariance determinant is approached by concentration: a step keeps the SUPPORT share of
rows with the smallest Mahalanobis distances and takes their mean and covariance, which
never raises the determinant. Steps begin from a fixed set of robust starts (see
``starting_shapes``); the start with the least determinant after STEPS steps goes on until its
determinant falls no more. A last step uses all rows within the chi-square cutoff. Rows far
outside of that ellipsoid, in the metric of their group, are rejected.

All steps are aggregations that combine before the shuffle, over a stored table of a few
numbers per row, joined to a table of a few numbers per group; a group of any size is fine.
Thresholds of distances are approximate percentiles over all rows of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .tables import joined

SUPPORT = 0.75
# Steps from every start; the best start goes on while its log determinant falls by FALL.
STEPS = 2
FALL = 1e-3
# Groups with fewer usable rows are judged by the shape of their whole language, or of all rows.
MIN_GROUP = 50
# Added to variances, so that a statistic that hardly varies in a group can't decide alone.
RIDGE = 0.25
# The same for starts, whose covariances are in units of deviations.
_START_RIDGE = 0.05
# Chi-square quantiles with five degrees of freedom: median, 97.5 %, and 1 - 1e-7.
MEDIAN, INNER, CUTOFF = 4.351, 12.833, 41.06
STATISTICS = ["x0", "x1", "x2", "x3", "x4"]
_P = len(STATISTICS)
_PAIRS = [(i, j) for i in range(_P) for j in range(i + 1)]
_SHAPE = ["judge", *[f"c{i}" for i in range(_P)], *[f"m{i}" for i in range(_P)], *[f"l{i}{j}" for i, j in _PAIRS], "scale"]

_SPACE = r"[\x20\x09-\x0D]+"
# An array of this many repeated runs is searched one by one; more are sorted.
_FEW = 16


def _with_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` (words, ...) with n_repeat_words: words in a run of three found twice or more.

    Each array is a column of its own, since a lambda would compute it anew for every element.
    Texts without repeats, most of them, get no further than comparing two sizes.
    """
    n = F.size("words")
    run = F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
    )
    rows = rows.withColumn("_runs", F.when(n >= 4, run))
    repeats = F.size(F.array_distinct("_runs")) < F.size("_runs")
    rows = rows.withColumn("_runs", F.when(repeats, F.col("_runs")))
    rows = rows.withColumn("_sorted", F.sort_array("_runs"))
    again = F.filter("_sorted", lambda x, i: (i > 0) & (x == F.get("_sorted", i - 1)))
    rows = rows.withColumn("_twice", F.array_distinct(again))
    few = F.filter(
        F.transform("_runs", lambda x, i: F.when(F.array_contains("_twice", x), i)), lambda x: x.isNotNull()
    )
    rows = rows.withColumn(
        "_pairs",
        F.when(
            F.size("_twice") > _FEW,
            F.sort_array(F.transform("_runs", lambda x, i: F.struct(x.alias("run"), i.alias("at")))),
        ),
    )
    many = F.transform(
        "_pairs",
        lambda x, i: F.when(
            ((i > 0) & (F.get("_pairs", i - 1)["run"] == x["run"]))
            | F.coalesce(F.get("_pairs", i + 1)["run"] == x["run"], F.lit(False)),
            x["at"],
        ),
    )
    many = F.sort_array(F.filter(many, lambda x: x.isNotNull()))
    rows = rows.withColumn("_at", F.when(F.col("_pairs").isNull(), few).otherwise(many))
    # each run covers three words, but for those that the next run covers
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
        lambda a: a["n"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_runs", "_sorted", "_twice", "_pairs", "_at"
    )


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    out = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    filled = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select(
        "doc_id",
        "lang",
        "source",
        F.array_remove(F.split("text", _SPACE), "").alias("words"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        filled.alias("_lines"),
    )
    out = out.select(
        "doc_id",
        "lang",
        "source",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    return _with_repeats(out).drop("words")


def _vectors(base: DataFrame) -> DataFrame:
    n = F.greatest("n_words", F.lit(1))
    return base.select(
        "*",
        F.log1p("n_words").alias("x0"),
        (F.col("word_chars") / n).alias("x1"),
        F.log1p(100 * F.col("n_symbols") / n).alias("x2"),
        F.log1p(100 * F.col("n_dup_lines") / n).alias("x3"),
        F.log1p(100 * F.col("n_repeat_words") / n).alias("x4"),
    )


def _groups(rows: DataFrame) -> DataFrame:
    """(_l, _s, judge, parts): whose shape judges a language and source, and which its rows shape.

    A group of MIN_GROUP usable rows has a shape of its own. A language with smaller groups, or
    all rows where a whole language is smaller, has one that all of its usable rows shape.
    """
    usable = F.count_if(~F.col("base_failed"))
    sizes = written(rows.groupBy("_l", "_s").agg(usable.alias("_n")))
    tongues = sizes.groupBy("_l").agg(F.sum("_n").alias("_nl"), F.min("_n").alias("_least"))
    least = tongues.agg(F.min("_nl").alias("_least_nl"))
    sizes = sizes.join(tongues, "_l").join(F.broadcast(least), F.lit(True))  # one row
    own, tongue, every = F.to_json(F.array("_l", "_s")), F.to_json(F.array("_l")), F.lit("[]")
    large, large_tongue = F.col("_n") >= MIN_GROUP, F.col("_nl") >= MIN_GROUP
    judge = F.when(large, own).when(large_tongue, tongue).otherwise(every)
    parts = F.array_compact(
        F.array(
            F.when(large, own),
            F.when(large_tongue & (F.col("_least") < MIN_GROUP), tongue),
            F.when(F.col("_least_nl") < MIN_GROUP, every),
        )
    )
    return written(sizes.select("_l", "_s", judge.alias("judge"), parts.alias("parts")))


def _with_distance(rows: DataFrame, shape: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d`` in their group's metric.

    ``shape`` has the mean m0.. and the lower triangle l00, l10, ... of the covariance's
    Cholesky factor for each group; solving with it row by row avoids an inverse.
    """
    out = rows.join(shape, "judge", how)
    for i, x in enumerate(STATISTICS):
        rest = F.col(x) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
        out = out.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    d = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, _P)), F.col("y0") * F.col("y0"))
    return out.withColumn("d", d * F.col("scale")).drop(*[f"y{i}" for i in range(_P)])


def _sums(values: list) -> list:
    """The mean of values and of their products, and how many there are."""
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.avg(v).alias(f"a{i}") for i, v in enumerate(values)],
        *[F.avg(values[i] * values[j]).alias(f"q{i}{j}") for i, j in _PAIRS],
    ]


def _with_factor(sums: DataFrame, ridge: float) -> DataFrame:
    """``sums`` with the lower triangle l00, l10, ... of their covariance's Cholesky factor."""
    for i, j in _PAIRS:
        v = F.col(f"q{i}{j}") - F.col(f"a{i}") * F.col(f"a{j}")
        for k in range(j):
            v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        v = F.sqrt(F.greatest(v, F.lit(0.0)) + ridge) if i == j else v / F.col(f"l{j}{j}")
        sums = sums.withColumn(f"l{i}{j}", v)
    return sums


def _log_determinant():
    return 2 * sum((F.log(F.col(f"l{i}{i}")) for i in range(1, _P)), F.log(F.col("l00")))


def _shape(rows: DataFrame, *by: str) -> DataFrame:
    """Mean and Cholesky factor of the covariance of ``rows`` in each group, not yet scaled.

    Sums are taken around c0.., the group's medians, to keep their digits.
    """
    by = by or ("judge",)
    sums = _sums([F.col(x) - F.col(f"c{i}") for i, x in enumerate(STATISTICS)])
    out = rows.groupBy(*by, *[f"c{i}" for i in range(_P)]).agg(*sums)
    out = out.withColumns({f"m{i}": F.col(f"c{i}") + F.col(f"a{i}") for i in range(_P)})
    out = _with_factor(out, RIDGE).withColumn("scale", F.lit(1.0))
    return out.select(*by, *_SHAPE[1:])


def _percentile(rows: DataFrame, share: float, alias: str, *by: str) -> DataFrame:
    return rows.groupBy(*(by or ("judge",))).agg(F.percentile_approx("d", share, 10_000).alias(alias))


def _scaled(rows: DataFrame, shape: DataFrame) -> DataFrame:
    """``shape`` scaled so that the median distance is that of a normal distribution."""
    medians = _percentile(_with_distance(rows, shape), 0.5, "median")
    # where half of the rows are alike the scale stays
    scale = F.when(F.col("median") > 0, F.least(MEDIAN / F.col("median"), F.lit(1.0))).otherwise(F.lit(1.0))
    return shape.join(medians, "judge").withColumn("scale", scale).select(*_SHAPE)


def starting_shapes(rows: DataFrame) -> DataFrame:
    """(judge, start, shape): robust starts for each group of stored ``rows`` (judge, x0..).

    With z, the distances from the medians in units of the median absolute deviation, they
    are the deviations alone (0), the covariance of tanh(z) (1) and of the spatial signs
    z / |z| (2) around the medians, and mean and covariance of the half with the least |z| (3).
    """
    middle = rows.groupBy("judge").agg(*[F.percentile_approx(x, 0.5, 10_000).alias(f"c{i}") for i, x in enumerate(STATISTICS)])
    middle = written(middle)  # stored, so its size is known and rows needn't be shuffled to it
    away = rows.join(middle, "judge").groupBy("judge", *[f"c{i}" for i in range(_P)]).agg(
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"c{i}")), 0.5, 10_000).alias(f"s{i}") for i, x in enumerate(STATISTICS)]
    )
    # 1.4826 deviations make a standard deviation of normal values
    units = {f"s{i}": F.sqrt((1.4826 * F.col(f"s{i}")) ** 2 + RIDGE) for i in range(_P)}
    middle = written(away.withColumns(units))
    z = [(F.col(x) - F.col(f"c{i}")) / F.col(f"s{i}") for i, x in enumerate(STATISTICS)]
    length = F.sqrt(sum((v * v for v in z[1:]), z[0] * z[0]))
    around = rows.join(middle, "judge").withColumn("d", length)
    middle = written(middle.join(_percentile(around, 0.5, "half"), "judge"))
    vectors = [
        F.array(*[F.tanh(v) for v in z]),
        F.array(*[F.when(F.col("d") > 0, v / F.col("d")).otherwise(0.0) for v in z]),
        F.when(F.col("d") <= F.col("half"), F.array(*z)),
    ]
    keys = ["judge", *[f"c{i}" for i in range(_P)], *[f"s{i}" for i in range(_P)]]
    vectors = rows.join(middle, "judge").withColumn("d", length).select(
        *keys, F.posexplode(F.array(*vectors)).alias("start", "v")
    )
    vectors = vectors.where("v IS NOT NULL").withColumn("start", F.col("start") + 1)
    found = vectors.groupBy(*keys, "start").agg(*_sums([F.get("v", F.lit(i)) for i in range(_P)]))
    found = _with_factor(found, _START_RIDGE)
    alone = {f"l{i}{j}": F.lit(float(i == j)) for i, j in _PAIRS} | {f"a{i}": F.lit(0.0) for i in range(_P)}
    found = found.unionByName(middle.select(*keys, F.lit(0).alias("start")).withColumns(alone), allowMissingColumns=True)
    # from units of z to those of the statistics
    moved = {f"m{i}": F.col(f"c{i}") + F.when(F.col("start") == 3, F.col(f"a{i}") * F.col(f"s{i}")).otherwise(0.0) for i in range(_P)}
    sized = {f"l{i}{j}": F.col(f"l{i}{j}") * F.col(f"s{i}") for i, j in _PAIRS}
    found = found.withColumns(moved | sized).withColumn("scale", F.lit(1.0))
    return written(found.select("start", *_SHAPE))


def _concentrated(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """``shapes`` (judge, start, ...) after one concentration step over ``rows``, stored."""
    by = ("judge", "start")
    most = written(shapes.join(_percentile(_with_distance(rows, shapes), SUPPORT, "most", *by), list(by)))
    return written(_shape(_with_distance(rows, most).where("d <= most"), *by))


def _least(shapes: DataFrame) -> DataFrame:
    """The start with the least determinant of each group, the first of equals."""
    best = shapes.groupBy("judge").agg(F.min(F.struct(_log_determinant().alias("v"), "start")).alias("best"))
    return written(shapes.join(best.select("judge", F.col("best.start").alias("start")), ["judge", "start"]))


def least_determinants(rows: DataFrame) -> DataFrame:
    """(judge, start, shape): mean and covariance of the minimum covariance determinant.

    Ends by itself: a group goes on only after its log determinant fell by FALL, and the ridge
    bounds that from below.
    """
    shapes = starting_shapes(rows)
    for _ in range(STEPS):
        shapes = _concentrated(rows, shapes)
    going, done = _least(shapes), None
    while not going.isEmpty():
        after = _concentrated(rows, going).withColumn("fell", _log_determinant())
        before = going.select("judge", _log_determinant().alias("before"))
        after = written(after.join(before, "judge").withColumn("fell", F.col("before") - F.col("fell")).drop("before"))
        # a step that rounding let rise counts for nothing
        stayed = going.join(after.where(F.col("fell") < 0).select("judge"), "judge", "left_semi")
        ended = after.where((F.col("fell") >= 0) & (F.col("fell") < FALL)).drop("fell").unionByName(stayed)
        done = ended if done is None else done.unionByName(ended)
        done, going = written(done), written(after.where(F.col("fell") >= FALL).drop("fell"))
    return going if done is None else done


def covariance_shapes(rows: DataFrame) -> DataFrame:
    """The robust mean and metric of each group of stored ``rows`` (judge, x0..)."""
    shape = written(_scaled(rows, least_determinants(rows).drop("start")))
    shape = _shape(_with_distance(rows, shape).where(F.col("d") <= INNER))
    return written(_scaled(rows, written(shape)))


def judged(docs: DataFrame) -> DataFrame:
    """The statistics, base rule and verdict of every row (doc_id, text, lang, source).

    base_failed: fewer than 50 words, or more than half of them in repeated runs of three.
    kept: neither base_failed nor farther than CUTOFF from its group's centre; distance is
    the squared Mahalanobis distance. A null text counts as empty; null languages or sources
    form groups of their own. Texts that fail the base rule take no part in the estimates; a
    group with fewer than MIN_GROUP others is judged by the shape of all rows of its language,
    and a language with fewer by that of all rows. Where no text is usable the base rule
    decides alone, and distance is null. Repeated rows count each.
    """
    rows = _vectors(base_statistics(docs))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = written(
        rows.withColumns(
            {"base_failed": failed, "_l": F.coalesce("lang", F.lit("")), "_s": F.coalesce("source", F.lit(""))}
        )
    )
    groups = _groups(rows)
    n_groups = groups.count()
    usable = joined(rows.where("NOT base_failed"), groups, ["_l", "_s"], "inner", n_groups)
    shapes = covariance_shapes(written(usable.select(F.explode("parts").alias("judge"), *STATISTICS)))
    rows = joined(rows, groups, ["_l", "_s"], "inner", n_groups)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = _with_distance(rows, shapes, "left")
    kept = ~F.col("base_failed") & (F.coalesce("d", F.lit(0.0)) <= CUTOFF)
    return found.select(*columns, kept.alias("kept"), F.col("d").alias("distance"))
