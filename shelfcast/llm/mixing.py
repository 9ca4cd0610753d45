"""Mixing sources to target weights by temperature.

A source's share of all tokens is raised to an exponent and the powers are
normalised to weights: exponent 1 keeps the shares, smaller ones level them. The
exponent is bisected to meet a target: an entropy of the weights, or a limit on
how often the most repeated source is passed. Each step of the bisection is one
aggregate over the (small) table of sources; several exponents are tried in one
step, so the interval shrinks 32-fold.

The weights are realised under a token budget by block permutations. A source's
rows are dealt into blocks by a hash. Every pass over the source orders its
blocks, and the rows in them, anew by a hash keyed with the pass. A source with
budget for 1.6 passes gets one whole pass, then the blocks of its second
permutation until the budget ends: whole blocks by a running sum over blocks,
the last one row by row. No window is larger than the blocks of a source
(``BLOCKS``) or the rows of a block, however many rows a source has.

Without a given budget it is the least that passes every source once, so that
no row is dropped; a smaller budget samples.

Defined cases: null sources are one source; null and empty texts have no tokens
and come once in each whole pass; a source without tokens is passed once;
repeated rows are rows. An empty table gives an empty table. Further columns
pass through; those named like the results are replaced, names starting with
``_mx_`` are reserved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import table, written

BLOCKS = 16_384          # of a source at most
REPETITION_LIMIT = 2.0
STEPS, TRIED = 7, 32     # 32 ** 7: beyond the precision of a double's exponent


def words(text: Column) -> Column:
    """Tokens of a text: runs of other than white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(source: str) -> Column:
    """The source; null is one, too."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def _measures(shares: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float]]:
    """Entropy of the weights and passes over the most repeated source, for
    each exponent; one aggregate."""
    log_p, t = F.log("_mx_share"), F.col("_mx_tokens")
    aggs = []
    for i, a in enumerate(exponents):
        power = F.exp(F.lit(a) * log_p)
        aggs += [F.sum(power).alias(f"z{i}"), F.sum(power * F.lit(a) * log_p).alias(f"e{i}"),
                 F.max(power / t).alias(f"m{i}"), F.min(power / t).alias(f"l{i}")]
    r = shares.agg(*aggs).first()
    out = []
    for i in range(len(exponents)):
        z, e, most, least = (r[f"{k}{i}"] for k in "zeml")
        passes = most / least if budget is None else budget * most / z
        out.append((math.log(z) - e / z, passes))
    return out


def exponent(shares: DataFrame, entropy: float | None = None, repetition: float | None = None,
             budget: float | None = None) -> float:
    """The exponent in [0, 1] whose weights have at least this entropy (in
    nats), or pass no source more often than ``repetition``: the nearest to 1
    for an entropy, the nearest to 0 for a limit. Both measures are monotone."""
    if (entropy is None) == (repetition is None):
        raise ValueError("give either a target entropy or a repetition limit")
    low, high = 0.0, 1.0

    def enough(measure: tuple[float, float]) -> bool:
        """Whether the exponent is on the side of 0 of the one searched for."""
        return measure[0] >= entropy if entropy is not None else measure[1] > repetition

    for _ in range(STEPS):
        tried = [low + (high - low) * i / (TRIED - 1) for i in range(TRIED)]
        below = [enough(m) for m in _measures(shares, tried, budget)]
        if not below[0]:
            return low if entropy is None else 0.0
        if below[-1]:
            return high
        at = max(i for i, b in enumerate(below) if b)
        low, high = tried[at], tried[at + 1]
    return low if entropy is not None else high


def plan(sizes: DataFrame, entropy: float | None = None, repetition: float | None = REPETITION_LIMIT,
         budget: int | None = None) -> DataFrame:
    """For each source of ``sizes(_mx_key, _mx_n, ...)``: tokens, share, weight,
    budget, whole passes and the tokens of the last, partial pass."""
    totals = sizes.groupBy("_mx_key").agg(F.sum("_mx_n").alias("_mx_tokens"))
    totals = written(totals, "mix-totals")
    every = totals.agg(F.sum("_mx_tokens")).first()[0] or 0
    shares = totals.withColumn("_mx_share", F.col("_mx_tokens") / F.lit(float(max(every, 1))))
    live = shares.where("_mx_tokens > 0")
    if live.isEmpty():
        return shares.select("_mx_key", "_mx_tokens", F.lit(0.0).alias("share"), F.lit(0.0).alias("weight"),
                             F.lit(0).cast("long").alias("_mx_budget"), F.lit(1).cast("long").alias("_mx_passes"),
                             F.lit(0).cast("long").alias("_mx_rest"))
    a = exponent(live, entropy, repetition if entropy is None else None, budget)
    power = F.exp(F.lit(a) * F.log("_mx_share"))
    norm = live.agg(F.sum(power).alias("_mx_z"), F.max(F.col("_mx_tokens") / power).alias("_mx_cover"))
    row = norm.first()
    # the least budget under which each source is passed once
    total = float(budget) if budget is not None else row["_mx_cover"] * row["_mx_z"]
    weight = F.when(F.col("_mx_tokens") > 0, power / F.lit(row["_mx_z"])).otherwise(F.lit(0.0))
    share_of = F.round(F.lit(total) * F.col("weight")).cast("long")
    return (shares.withColumn("weight", weight).withColumn("_mx_budget", share_of)
            .withColumn("_mx_passes", F.when(F.col("_mx_tokens") > 0, F.floor(F.col("_mx_budget") / F.col("_mx_tokens")))
                        .otherwise(F.lit(1 if budget is None else 0)).cast("long"))
            .withColumn("_mx_rest", F.col("_mx_budget") - F.col("_mx_passes") * F.col("_mx_tokens"))
            .withColumnRenamed("_mx_share", "share")
            .select("_mx_key", "_mx_tokens", "share", "weight", "_mx_budget", "_mx_passes", "_mx_rest"))


def mix(df: DataFrame, text: str = "text", source: str = "source", ident: str = "doc_id",
        entropy: float | None = None, repetition: float | None = REPETITION_LIMIT,
        budget: int | None = None, seed: int = 11, n_tokens: Column | None = None,
        carry: list[str] | None = None) -> DataFrame:
    """The rows as often as their source's weight calls for, columns ``carry``
    (default: all) with ``n_tokens``, ``weight`` (of the source), ``epoch``
    (pass, from 1), ``block`` and ``position``: the row's place in (0, 1) of its
    source's passes. Read in the order of ``position``, the sources come at
    their weights throughout."""
    results = ("n_tokens", "weight", "epoch", "block", "position")
    carry = [c for c in (df.columns if carry is None else carry) if c not in results]
    tokens = words(F.col(text)) if n_tokens is None else n_tokens
    block = F.pmod(F.xxhash64(F.col(ident), F.lit(seed)), F.lit(BLOCKS)).cast("int")
    keyed = lambda rows: (rows.withColumn("_mx_key", _key(source)).withColumn("_mx_n", tokens)
                          .withColumn("_mx_block", block))
    blocks = written(keyed(df).groupBy("_mx_key", "_mx_block").agg(F.sum("_mx_n").alias("_mx_n")), "mix-blocks")
    sources = written(plan(blocks, entropy, repetition, budget), "mix-plan")

    # the order of blocks in the partial pass, and where the budget ends
    turn = F.col("_mx_passes") + 1
    shuffled = Window.partitionBy("_mx_key").orderBy(F.xxhash64("_mx_block", turn, F.lit(seed)), "_mx_block")
    partial = (blocks.join(sources.where("_mx_rest > 0"), "_mx_key")
               .withColumn("_mx_left", F.col("_mx_rest") - F.sum("_mx_n").over(shuffled) + F.col("_mx_n"))
               .where("_mx_left > 0").select("_mx_key", "_mx_block", "_mx_left"))
    decided = blocks.drop("_mx_n").join(sources, "_mx_key").join(partial, ["_mx_key", "_mx_block"], "left")
    # what the order of rows needs of the text is taken before rows are moved
    rows = (keyed(df).withColumn("_mx_tie", F.xxhash64(F.col(text))).select(
        *dict.fromkeys([*carry, ident]), "_mx_key", "_mx_n", "_mx_block", "_mx_tie")
        .join(decided, ["_mx_key", "_mx_block"]))
    whole = rows.where("_mx_passes > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), "_mx_passes")))
    in_block = Window.partitionBy("_mx_key", "_mx_block").orderBy(
        F.xxhash64(F.col(ident), turn, F.lit(seed)), F.col(ident), "_mx_tie")
    cut = (rows.where("_mx_left is not null")
           .withColumn("_mx_sum", F.sum("_mx_n").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
           .where("_mx_sum <= _mx_left").drop("_mx_sum").withColumn("epoch", turn))
    # (pass, permuted block, permuted row) as one number in (0, 1)
    passes = F.greatest(F.col("_mx_budget") / F.greatest(F.col("_mx_tokens"), F.lit(1)), F.lit(1.0))
    unit = lambda *c: (F.shiftrightunsigned(F.xxhash64(*c), 11) + 0.5) / F.lit(float(1 << 53))
    in_pass = unit(F.col("_mx_block"), F.col("epoch"), F.lit(seed)) + unit(
        F.col(ident), F.col("epoch"), F.lit(seed)) / (4 * BLOCKS)
    last = F.when(F.col("epoch") > F.col("_mx_passes"), passes - F.col("_mx_passes")).otherwise(F.lit(1.0))
    position = (F.col("epoch") - 1 + in_pass / (1 + 1 / (4 * BLOCKS)) * last) / F.greatest(passes, F.col("epoch") - 1 + last)
    return whole.unionByName(cut).select(
        *carry, F.col("_mx_n").alias("n_tokens"), "weight", F.col("epoch"), F.col("_mx_block").alias("block"),
        position.alias("position"))


def op4_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed so that no source is passed more than twice and none is
    cut: one row for each time a document comes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, carry=["doc_id", "source"])
