"""Mixing sources to target weights by temperature, in DataFrame functions only.

A source with share ``p`` of the tokens gets weight ``p^a / sum(p^a)``. The
exponent ``a`` is bisected on a grid of 1/65536: the largest exponent whose
weights reach the target entropy (as a share of the even mix), but not below
the smallest one whose repetition of any source stays within the limit. Each
round evaluates 15 exponents in one small aggregate over the per-source totals
and narrows the bracket to a sixteenth (four bisections at once); only one row
of sums reaches the driver, however many sources there are.

The weights are realised as budgeted block permutations. A block is one
permutation of all documents of a source, ordered by a hash of seed, block
number and document; a source is laid out block after block until its token
budget (weight times the whole budget) is used up. A document of the last
block is taken while the tokens before it are below the budget, so a source
exceeds its budget by less than one document (rows equal in doc_id, text and
source count as one document, with their number in ``copies``). Positions and running tokens
come from a two-level prefix sum (inside hash ranges, then over the ranges), so
a source holding a third of the rows is spread over many tasks.

The default budget gives every source at least one whole block: nothing is
lost, and small sources are repeated.

Defined cases: a null source is a source of its own (output null); documents
without words have no tokens and come along in whole blocks only, a source of
none but those is laid out once; repeated rows are laid out together; an empty
table gives an empty result; texts of any length are only counted and hashed.
``mix`` reads doc_id, text and source only; ``mixed_documents`` returns every input
column, whatever its name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, shielded

GRID_BITS = 16
GRID = 1 << GRID_BITS
#: Share of the even mix's entropy to reach, and the most often a source may be laid out.
TARGET_ENTROPY = 0.98
MAX_REPEATS = 4.0
#: Hash ranges a block is cut into for the prefix sums: one per value of so many hex digits of the order.
RANGE_DIGITS = 3
KEY = ("doc_id", "text_hash", "source")
SLACK = 1e-9


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_totals(df: DataFrame) -> DataFrame:
    """(source, docs, tokens) of the rows of ``narrow``; a hot source collapses before the shuffle."""
    return df.groupBy("source").agg(F.sum("copies").alias("docs"), F.sum("tokens").alias("tokens"))


def _at(totals: DataFrame, steps: list[int], total: float) -> list[tuple[float, float, float]]:
    """For each exponent step/GRID: sum of p^a, of p^a ln p, and the least p."""
    p = F.col("tokens") / F.lit(float(total))
    sums = []
    for i, step in enumerate(steps):
        power = F.pow(p, F.lit(step / GRID))
        sums += [F.sum(power).alias(f"s{i}"), F.sum(power * F.log(p)).alias(f"l{i}")]
    row = totals.filter("tokens > 0").agg(*sums, F.min(p).alias("low"), F.max(p).alias("high")).first()
    return [(row[f"s{i}"], row[f"l{i}"], row["low"], row["high"]) for i in range(len(steps))]


def _bisect(totals: DataFrame, total: float, holds) -> int:
    """Largest grid step in [0, GRID] for which ``holds`` (true up to some step), or 0."""
    low, high = 0, GRID + 1  # holds at low (or nowhere), fails at high
    while high - low > 1:
        width = -(-(high - low) // 16)
        steps = [s for s in range(low + width, high, width)]
        for step, found in zip(steps, _at(totals, steps, total), strict=True):
            if not holds(step / GRID, *found):
                high = step
                break
            low = step
    return low


def entropy(a: float, s: float, weighted_log: float) -> float:
    """Entropy of the weights p^a / s."""
    return math.log(s) - a * weighted_log / s


def solve_exponent(totals: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> float:
    """Exponent that meets both targets; where they conflict, the repetition limit wins."""
    found = totals.filter("tokens > 0").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).first()
    if found["n"] < 2:
        return 1.0
    total, even = float(found["t"]), math.log(found["n"])
    wide = _bisect(totals, total, lambda a, s, w, low, high: entropy(a, s, w) >= target_entropy * even - SLACK)
    # Repetition against the largest source, which is laid out once: (high/low)^(1-a) falls as a grows.
    over = _bisect(totals, total, lambda a, s, w, low, high: (high / low) ** (1 - a) > max_repeats + SLACK)
    first = found["t"] and _at(totals, [0], total)[0]
    least = 0 if first[3] / first[2] <= max_repeats + SLACK else min(GRID, over + 1)
    return max(wide, least) / GRID


def target_budgets(totals: DataFrame, exponent: float, budget_tokens: int | None = None) -> DataFrame:
    """(source, docs, tokens, weight, budget): whole tokens that each source is to get."""
    t = F.col("tokens").cast("double")
    live = totals.filter("tokens > 0")
    # p^a is proportional to tokens^a: no total is needed.
    sums = live.agg(F.sum(F.pow(t, F.lit(exponent))), F.max(F.pow(t, F.lit(1 - exponent)))).first()
    power, scale = (sums[0] or 1.0), (sums[1] or 1.0)
    whole = float(budget_tokens) if budget_tokens is not None else scale * power
    weight = F.when(F.col("tokens") > 0, F.pow(t, F.lit(exponent)) / F.lit(power)).otherwise(F.lit(0.0))
    # Rounded to a millionth first, so that an exact number of blocks is not missed by an ulp.
    budget = F.floor(F.round(weight * F.lit(whole), 3) + F.lit(0.0005)).cast("long")
    if budget_tokens is None:  # every source at least once; doubles may fall short of that in very large sources
        budget = F.greatest(budget, F.col("tokens").cast("long"))
    return totals.withColumn("weight", weight).withColumn("budget", budget)


def block_order(block: Column, key: Column, text_hash: Column, seed: int) -> Column:
    shown = F.coalesce(key.cast("string"), F.lit("null"))
    return F.md5(F.concat_ws("/", F.lit(str(seed)), block.cast("string"), shown, text_hash))


def lay_out(rows: DataFrame, budgets: DataFrame, seed: int = 29) -> DataFrame:
    """The realised schedule: one row per document and block it is laid out in.

    ``rows`` comes from ``narrow``. ``position`` counts rows from 0 inside a
    block. Blocks a source does not need are never made.
    """
    blocks = F.when(F.col("tokens") > 0, F.greatest(F.ceil(F.col("budget") / F.col("tokens")), F.lit(0))).otherwise(1)
    plan = cut(budgets.select(F.col("source").alias("_s"), F.col("tokens").alias("_all"), "budget",
                              blocks.cast("int").alias("_blocks")), "mix_plan")
    wanted = rows.join(plan, F.col("source").eqNullSafe(F.col("_s"))).filter("_blocks > 0")
    block = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    laid = (wanted.select(*KEY, "copies", "tokens", "_all", "budget", block.alias("block"))
            .withColumn("_order", block_order(F.col("block"), F.col("doc_id"), F.col("text_hash"), seed))
            .withColumn("_range", F.conv(F.substring("_order", 1, RANGE_DIGITS), 16, 10).cast("int")))
    by = ["source", "block", "_range"]
    sums = laid.groupBy(*by).agg(F.sum("copies").alias("_n"), F.sum("tokens").alias("_t"))
    before = Window.partitionBy("source", "block").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(sums.select(F.col("source").alias("_s"), F.col("block").alias("_b"), F.col("_range").alias("_r"),
                             F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                             F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_t0")), "mix_starts")
    inside = Window.partitionBy(*by).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    done = (laid.withColumn("_n1", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
            .withColumn("_t1", F.coalesce(F.sum("tokens").over(inside), F.lit(0))))
    placed = done.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b"))
                       & (F.col("_range") == F.col("_r")))
    used = F.col("block") * F.col("_all") + F.col("_t0") + F.col("_t1")
    taken = (F.col("_all") == 0) | (used < F.col("budget")) | ((F.col("block") + 1) * F.col("_all") <= F.col("budget"))
    return placed.filter(taken).select(*KEY, "copies", "tokens", "block",
                                       (F.col("_n0") + F.col("_n1")).alias("position"))


def narrow(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, text_hash, source, copies, tokens): equal rows folded, tokens of all copies."""
    rows = df.select(F.col(key).alias("doc_id"), F.coalesce(F.md5(F.col(text)), F.lit("null")).alias("text_hash"),
                     F.col(source).alias("source"), token_count(F.col(text)).alias("tokens"))
    return rows.groupBy(*KEY).agg(F.count("*").alias("copies"), F.sum("tokens").alias("tokens"))


def mix(df: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS,
        budget_tokens: int | None = None, seed: int = 29) -> DataFrame:
    """Schedule of ``df`` (see ``lay_out``)."""
    rows = cut(narrow(df), "mix_rows")
    totals = cut(source_totals(rows), "mix_totals")
    exponent = solve_exponent(totals, target_entropy, max_repeats)
    return lay_out(rows, target_budgets(totals, exponent, budget_tokens), seed)


def mixed_documents(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df``, each as often as the schedule has it, in the columns of ``df``.

    The schedule is folded to a number of blocks per (doc_id, text, source) and
    the text rows are repeated where they are.
    """
    blocks = (mix(df.select("doc_id", "text", "source"), **options).groupBy(*KEY).agg(F.count("*").cast("int").alias("_times"))
              .withColumnsRenamed({"doc_id": "_d", "text_hash": "_h", "source": "_s"}))
    plan = cut(blocks, "mix_times")
    rows, at = shielded(df)
    found = rows.withColumn("_hash", F.coalesce(F.md5(F.col(at["text"])), F.lit("null"))).join(
        plan, (F.col("_hash") == F.col("_h")) & F.col(at["doc_id"]).eqNullSafe(F.col("_d"))
        & F.col(at["source"]).eqNullSafe(F.col("_s")))
    return (found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
            .select(*rows.columns).toDF(*df.columns))
