"""Mixing to target weights: raking of token weights, then sampling by calibrated probabilities.

Documents are counted into cells of (source, language, topic). Iterative proportional fitting
scales the cells' token weights to the targets of one dimension after the other until all of
them hold. The sample has as many tokens as it can have if cells with 1 - ``met`` = 5 % of the
tokens may be wanted more often than they occur. A document's probability is its cell's ratio
of wanted to given tokens. Cells wanted beyond what they hold are taken whole and the others
raked again, so the targets still hold in the expected tokens of the sample. Where a category
as a whole has fewer tokens than its target takes, the target is infeasible: all of it is
taken, and the other categories of the dimension share the rest in proportion to their
targets. ``achieved`` reports per category target and expected share, which are infeasible,
and the last deviation. With ``met`` = 1 no cell is taken beyond what it holds at once.

The cells are Spark tables; each sweep's result is stored. Sampling compares a hash of the
document with its probability, so a repeated task draws the same documents.

Defined results: a null category is the category ''. Null and blank texts have no words, so
no tokens; they weigh nothing and get the probability of their cell, or 0 if the cell has no
tokens. Rows that share id and text are drawn together. Categories without tokens have no
target. Targets that the cells can't meet leave the last sweep's weights. An empty table
gives an empty result. Other columns pass unchanged, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import join_few, stored, words_of

DIMENSIONS = ("source", "lang", "topic")
TOPICS = 6
TOPIC_WORD_CHARS = 7
TEMPER = {"source": 0.7, "lang": 0.8, "topic": 0.5}
TOLERANCE = 1e-6
MAX_SWEEPS = 40
MET = 0.95
CELL_BYTES = 160
SEED = 11


def with_tokens_and_topic(docs: DataFrame, topics: int = TOPICS) -> DataFrame:
    """Adds ``tokens``, the number of words, and ``topic``: of the hash classes of the long
    words, the one with most of them (the first of several; '' without any)."""
    worded = docs.drop("tokens", "topic").withColumn("_w", words_of("text")).withColumn("tokens", F.size("_w").cast("bigint"))
    hashed = worded.withColumn("_h", F.expr(
        f"transform(filter(_w, w -> length(w) >= {TOPIC_WORD_CHARS}), w -> CAST(pmod(xxhash64(lower(w)), {topics}) AS int))"))
    counted = hashed.withColumn("_n", F.array(*[F.expr(f"size(filter(_h, x -> x = {t}))") for t in range(topics)]))
    best = F.expr("CAST(array_position(_n, array_max(_n)) - 1 AS string)")
    return counted.withColumn("topic", F.when(F.size("_h") > 0, F.concat(F.lit("t"), best)).otherwise("")).drop("_w", "_h", "_n")


def _category(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def cells_of(docs: DataFrame, dimensions=DIMENSIONS) -> DataFrame:
    """One row per combination of categories, with its tokens and documents."""
    by = docs.groupBy(*[_category(d).alias(d) for d in dimensions])
    return stored(by.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "cells")


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(category, target): shares of the tokens to a power, scaled to sum to one."""
    shares = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0")
    raised = shares.select(dimension, F.pow("t", F.lit(power)).alias("t"))
    total = raised.agg(F.sum("t")).first()[0] or 1.0
    return raised.select(dimension, (F.col("t") / total).alias(f"target_{dimension}"))


def given(cells: DataFrame, dimension: str, shares: Mapping[str, float]) -> DataFrame:
    """(category, target) from a mapping; categories without tokens or share are left out."""
    spark = cells.sparkSession
    wanted = spark.createDataFrame([(k or "", float(v)) for k, v in shares.items() if v > 0], f"{dimension} string, target_{dimension} double")
    held = wanted.join(cells.where("tokens > 0").select(dimension).distinct(), dimension, "left_semi")
    total = held.agg(F.sum(f"target_{dimension}")).first()[0] or 1.0
    return held.withColumn(f"target_{dimension}", F.col(f"target_{dimension}") / total)


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = TOLERANCE, max_sweeps: int = MAX_SWEEPS) -> DataFrame:
    """The cells with tokens and a target in each dimension, with ``weight``, shares that sum to one.

    ``deviation`` is the largest relative distance of a marginal from its target that the
    last sweep met.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    raked = cells.where("tokens > 0").withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for dimension, shares in targets.items():
        raked = raked.join(shares, dimension)
    raked = stored(raked, "raked")
    for _ in range(max_sweeps):
        step = raked.withColumn("deviation", F.lit(0.0))
        for dimension in targets:
            sums = step.groupBy(dimension).agg(F.sum("weight").alias("_sum"))
            ratio = F.col(f"target_{dimension}") / F.col("_sum")
            step = step.join(sums, dimension).withColumn("deviation", F.greatest("deviation", F.abs(ratio - 1))).withColumn(
                "weight", F.col("weight") * ratio).drop("_sum")
        raked = stored(step, "raked")
        if (raked.agg(F.max("deviation")).first()[0] or 0.0) < tolerance:
            break
        raked = raked.drop("deviation")
    return raked


def _goals(raked: DataFrame, dimension: str, size: float) -> DataFrame:
    """(category, goal_, infeasible_): tokens per category, all it holds where its target takes more.

    The others get equal multiples of their targets, so that the goals sum to ``size``.
    """
    held = stored(raked.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("_held"), F.first(f"target_{dimension}").alias("_target")), "held")
    level, taken = 0.0, -1
    while True:
        whole = F.col("_held") < F.col("_target") * F.lit(level)
        row = held.agg(F.count_if(whole), F.sum(F.when(whole, F.col("_held")).otherwise(0.0)), F.sum(F.when(whole, 0.0).otherwise(F.col("_target")))).first()
        if row[0] == taken or not row[2]:
            break
        taken, level = row[0], (size - row[1]) / row[2]
    wanted = F.col("_target") * F.lit(level)
    return held.select(dimension, F.least("_held", wanted).alias(f"goal_{dimension}"), (F.col("_held") < wanted * (1 - 1e-9)).alias(f"infeasible_{dimension}"))


def bounded(raked: DataFrame, dimensions=DIMENSIONS, met: float = MET, tolerance: float = TOLERANCE, max_sweeps: int = MAX_SWEEPS) -> DataFrame:
    """The raked cells with ``wanted`` <= ``tokens``, the expected tokens of the sample.

    A cell's wanted tokens are its weight times one factor per category, at most what it
    holds; each sweep moves the factors to their categories' goals. ``off`` is the largest
    relative distance from a goal that the last sweep met.
    """
    ratio = F.col("weight") / F.col("tokens")
    full, held = raked.agg(F.percentile(ratio, F.lit(met), F.col("tokens")), F.sum("tokens")).first()
    if not full:
        return raked.withColumns({"wanted": F.lit(0.0), "off": F.lit(0.0), **{f"infeasible_{d}": F.lit(False) for d in dimensions}})
    size = min(1.0 / full, float(held))
    cells = raked.withColumn("_asked", F.col("weight") * F.lit(size))
    for d in dimensions:
        cells = cells.join(_goals(raked, d, size), d)
    cells = stored(cells, "bounded")
    wanted, free = F.least("_asked", F.col("tokens").cast("double")), F.col("_asked") < F.col("tokens")
    for _ in range(max_sweeps):
        step = cells.withColumn("off", F.lit(0.0))
        for d in dimensions:
            sums = step.groupBy(d).agg(F.sum(wanted).alias("_sum"), F.sum(F.when(free, F.col("_asked")).otherwise(0.0)).alias("_free"))
            goal, total = F.col(f"goal_{d}"), F.col("_sum")
            # Too much: all factors fall. Too little: only cells that are not whole can give more.
            by = F.when(total > goal, goal / total).when(F.col("_free") > 0, 1 + (goal - total) / F.col("_free")).otherwise(1.0)
            step = step.join(sums, d).withColumn("off", F.greatest("off", F.abs(total / goal - 1))).withColumn(
                "_asked", F.col("_asked") * by).drop("_sum", "_free")
        cells = stored(step, "bounded")
        off = cells.agg(F.max("off")).first()[0] or 0.0
        if off < tolerance:
            break
        cells = cells.drop("off")
    return cells.withColumns({"wanted": wanted, "off": F.lit(off)}).drop("_asked")


def probabilities(raked: DataFrame, dimensions=DIMENSIONS, met: float = MET) -> DataFrame:
    """(categories, weight, probability) of the raked cells."""
    cells = bounded(raked, dimensions, met)
    return stored(cells.select(*dimensions, "weight", (F.col("wanted") / F.col("tokens")).alias("probability")), "probabilities")


def _shares(cells: DataFrame, targets, dimensions) -> dict[str, DataFrame]:
    return {d: given(cells, d, targets[d]) if targets and d in targets else tempered(cells, d, TEMPER.get(d, 1.0)) for d in dimensions}


def achieved(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, dimensions=DIMENSIONS, met: float = MET) -> DataFrame:
    """(dimension, category, target, expected, infeasible, off): shares of the sample's expected tokens."""
    cells = cells_of(docs, dimensions)
    fit = stored(bounded(rake(cells, _shares(cells, targets, dimensions)), dimensions, met), "achieved")
    total = fit.agg(F.sum("wanted")).first()[0] or 1.0
    parts = [
        fit.groupBy(F.lit(d).alias("dimension"), F.col(d).alias("category")).agg(
            F.first(f"target_{d}").alias("target"), (F.sum("wanted") / F.lit(total)).alias("expected"),
            F.first(f"infeasible_{d}").alias("infeasible"), F.max("off").alias("off"))
        for d in dimensions
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def draw(text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the document's id and the hash of its text."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("bigint"), text), 11)
    return place / float(1 << 53)


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, dimensions=DIMENSIONS, seed: int = SEED, met: float = MET) -> DataFrame:
    """The table with ``weight`` of its cell, ``probability`` and ``sampled``.

    ``docs`` has ``tokens`` and the dimensions' columns. Without ``targets`` the given
    shares are flattened by the powers in TEMPER.
    """
    cells = cells_of(docs, dimensions)
    rates = probabilities(rake(cells, _shares(cells, targets, dimensions)), dimensions, met).select(
        *[F.col(d).alias(f"_{d}") for d in dimensions], F.col("weight"), F.col("probability"))
    plain = docs.drop("weight", "probability", "sampled").withColumns({f"_{d}": _category(d) for d in dimensions})
    joined = join_few(plain, rates, [f"_{d}" for d in dimensions], row_bytes=CELL_BYTES).drop(*[f"_{d}" for d in dimensions])
    filled = joined.withColumns({"weight": F.coalesce("weight", F.lit(0.0)), "probability": F.coalesce("probability", F.lit(0.0))})
    text = F.col("_text_hash") if "_text_hash" in docs.columns else text_hash()
    return filled.withColumn("sampled", draw(text, seed) < F.col("probability"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, categories, tokens, cell weight, probability and whether the document is drawn."""
    narrow = with_tokens_and_topic(docs.select("doc_id", "source", "lang", "text"))
    slim = stored(narrow.withColumn("_text_hash", text_hash()).drop("text"), "document-categories")
    return mix(slim).drop("_text_hash")


def sampled(docs: DataFrame) -> DataFrame:
    """The drawn rows, in the same columns."""
    rows = docs.select("doc_id", "source", "lang", "text", F.struct(*docs.columns).alias("_original"))
    return mix(with_tokens_and_topic(rows)).where("sampled").select("_original.*")
