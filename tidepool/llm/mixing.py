"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Tokens are summed per cell of source, language and topic. The cells' weights are then raked:
scaled in turn so that the sums over each source, each language and each topic meet their
targets, until all three do. A document of a cell whose weight is r times its tokens is kept
with probability min(1, c * r); c is set so that the expected tokens are those asked for.
The draw is a hash of the document's id, so it is the same in every run and for every copy
of the job.

The corpus is read once to be summed up and once to be sampled. What is raked is the table of
cells, whose size follows the number of sources and not of documents.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .tables import joined

MARGINS = ["source", "lang", "topic"]
# Rounds of raking per stored table, and at most.
ROUNDS, MAX_ROUNDS = 5, 50
TOLERANCE = 1e-6
# Target shares are the corpus's shares to this power: below 1, smaller ones gain.
SMOOTHING = 0.7
# Share of all tokens that is to be kept, as far as probabilities up to 1 allow.
KEEP = 0.8
# Cells that one task rakes; the factors of more are worked out by aggregates over all tasks.
_ONE_TASK = 200_000


def topic_of(text: Column) -> Column:
    """A coarse topic by form: table, licence, credentials, marked up or prose."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("License") | text.contains("Copyright"), "licence")
        .when(text.rlike(r"(?i)password|secret|token|api_?key"), "credentials")
        .when(text.rlike(r"[#*$%&<>]{3}|!!"), "marked")
        .otherwise("prose")
    )


def weighted(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """doc_id, the three margins (null as '') and tokens, words by white space, per row."""
    words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), ""))
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce(topic_of(text) if topic is None else topic, F.lit("")).alias("topic"),
        words.cast("long").alias("tokens"),
    )


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))


def smoothed_targets(cells: DataFrame, margin: str, power: float = SMOOTHING) -> DataFrame:
    """(margin, target): shares of all tokens, each the present share to a power."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).where("t > 0")
    raised = F.pow(F.col("t").cast("double"), F.lit(power))
    total = sums.agg(F.sum(raised)).first()[0]
    return sums.select(margin, (raised / F.lit(total)).alias("target"))


def _rounds_in_one_task(now: DataFrame) -> DataFrame:
    now = now.coalesce(1)
    for _ in range(ROUNDS):
        for m in MARGINS:
            sums = F.sum("weight").over(Window.partitionBy(m))
            now = now.withColumn("weight", F.when(sums > 0, F.col("weight") * F.col(f"_{m}") / sums).otherwise(0.0))
    return now


def _rounds_by_factors(now: DataFrame) -> DataFrame:
    """The same rounds, as one factor per value of each margin; cells are never dealt by a margin."""
    factors: dict[str, tuple[DataFrame, int]] = {}

    def weighed(margins: list[str]) -> DataFrame:
        out, weight = now, F.col("weight")
        for m in margins:
            if m in factors:
                out = joined(out, factors[m][0], m, "left", factors[m][1])
                weight = weight * F.col(f"_by_{m}")
        return out.withColumn("weight", weight).select(now.columns)

    for _ in range(ROUNDS):
        for m in MARGINS:
            sums = weighed([x for x in MARGINS if x != m]).groupBy(m).agg(F.sum("weight").alias("s"), F.first(f"_{m}").alias("aim"))
            by = written(sums.select(m, F.when(F.col("s") > 0, F.col("aim") / F.col("s")).otherwise(0.0).alias(f"_by_{m}")))
            factors[m] = (by, by.count())
    return weighed(MARGINS)


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``cells`` with tokens above 0 and their ``weight``, a share of the raked total of 1.

    ``targets`` has for each margin a table (margin, target); a margin's targets need not add
    up to 1, they are scaled. Values without a target weigh nothing. Without ``targets`` they
    are the smoothed shares. Stops when every margin is met to TOLERANCE, or after
    ``max_rounds``: targets that the cells can't meet together leave the last margin exact.
    ``off`` is the largest difference between a value's weight and its target that is left; a
    warning tells when it is above TOLERANCE.
    """
    targets = targets or {m: smoothed_targets(cells, m) for m in MARGINS}
    now = cells.where("tokens > 0")
    for m in MARGINS:
        aim = targets[m].select(m, F.col("target").cast("double").alias(f"_{m}"))
        now = now.join(aim, m, "left").fillna(0.0, [f"_{m}"])
    now = written(now)
    n, total = now.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    step = _rounds_in_one_task if n <= _ONE_TASK else _rounds_by_factors
    columns = {"weight": F.col("tokens") / F.lit(total)}
    for m in MARGINS:  # a value's share among the values that occur
        every = now.groupBy(m).agg(F.first(f"_{m}").alias("aim")).agg(F.sum("aim")).first()[0]
        columns[f"_{m}"] = F.col(f"_{m}") / F.lit(every) if every else F.lit(0.0)
    now = now.withColumns(columns)
    now = written(now.coalesce(1) if n <= _ONE_TASK else now)
    most = None
    for _ in range(0, max_rounds, ROUNDS):
        now = written(step(now))
        off = [
            now.groupBy(m).agg(F.abs(F.sum("weight") - F.first(f"_{m}")).alias("off")).agg(F.max("off")).first()[0]
            for m in MARGINS
        ]
        most = max((x or 0.0) for x in off)
        if most <= TOLERANCE:
            break
    else:
        warnings.warn(f"after {max_rounds} rounds a margin is off its target by {most}", stacklevel=2)
    return now.select(*MARGINS, "tokens", "docs", "weight", F.lit(most).cast("double").alias("off"))


def probabilities(raked: DataFrame, keep: float = KEEP) -> DataFrame:
    """``raked`` cells with the probability that keeps a document of the cell.

    The factor c solves sum(min(tokens, c * weight)) = keep * sum(tokens). The sum is concave in
    c and made of straight pieces: from c = 0, the root of the piece at c is the next c, which
    grows until no more cells reach probability 1. Each step is one aggregate over the cells.
    """
    live = raked.where("weight > 0")
    factor, reached = 0.0, None
    while factor is not None:
        full = F.lit(factor) * F.col("weight") > F.col("tokens")
        cells, tokens, filled, open_ = live.agg(
            F.sum(full.cast("long")),
            F.sum("tokens"),
            F.sum(F.when(full, F.col("tokens")).otherwise(0)),
            F.sum(F.when(~full, F.col("weight"))),
        ).first()
        if cells is None or (reached is not None and cells <= reached):
            break
        reached = cells
        factor = (keep * tokens - filled) / open_ if open_ else None
    if factor is None:
        chance = F.lit(1.0)
    else:
        chance = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(factor) * F.col("weight") / F.col("tokens")))
    return live.select(*MARGINS, chance.alias("probability"), F.col("weight").alias("target_weight"))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number from 0 to 1 (exclusive) that depends on the id and the seed."""
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def mixed(docs: DataFrame, keep: float = KEEP, seed: int = 1) -> DataFrame:
    """The rows of ``docs`` that ``sampled`` samples towards the smoothed shares."""
    chances = written(probabilities(rake(written(cells_of(weighted(docs)))), keep))
    chances = chances.select(*[F.col(m).alias(f"_mix_{m}") for m in MARGINS], F.col("probability").alias("_mix_p"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumns(
        {
            "_mix_source": F.coalesce("source", F.lit("")),
            "_mix_lang": F.coalesce("lang", F.lit("")),
            "_mix_topic": topic_of(text),
        }
    )
    rows = joined(rows, chances, [f"_mix_{m}" for m in MARGINS], "left", chances.count())
    wordless = ~text.rlike(r"[^\x20\x09-\x0D]")
    chance = F.coalesce("_mix_p", F.lit(0.0))
    return rows.where(wordless | (uniform(F.col("doc_id"), seed) < chance)).select(docs.columns)


def sampled(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    topic: Column | None = None,
    keep: float = KEEP,
    seed: int = 1,
) -> DataFrame:
    """doc_id, margins, tokens, probability and sampled of every row of ``docs``.

    A null or wordless text has no tokens, takes nothing from any target and is kept. A null
    margin is the value ''. Documents of a value without a target aren't sampled. Rows of one
    id are sampled together. An empty table gives no rows.
    """
    rows = written(weighted(docs, topic))
    chances = written(probabilities(rake(written(cells_of(rows)), targets), keep))
    out = joined(rows, chances, MARGINS, "left", chances.count())
    chance = F.when(F.col("tokens") == 0, 1.0).otherwise(F.coalesce("probability", F.lit(0.0)))
    out = out.withColumn("probability", chance)
    return out.select(
        "doc_id", *MARGINS, "tokens", "probability", (uniform(F.col("doc_id"), seed) < F.col("probability")).alias("sampled")
    )
