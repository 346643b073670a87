"""Mixing sources to target weights.

The weight of a source is its share of all tokens to the power ``a``, made to sum
to one. ``a`` is bisected (many ways at a time: one aggregation measures a whole
row of exponents) until the weights reach a target entropy, or until no source is
repeated more often than a limit. The budget in tokens is then dealt out: a
source's quota is its weight's share of the budget, filled by permutations of its
documents, one per epoch, cut where the quota is full. A document's place in its
source's stream decides its block, so every block holds the sources in the target
proportions; inside a block documents are permuted again.

Running sums never see a whole source in one task: a permutation is cut into about
sqrt(n) buckets of the hash order, summed per bucket first, then within each. A
block has a bounded number of tokens, so its documents are bounded too.

Edge cases: a null or empty text counts as one token; a null source is a source of
its own; rows with the same id share their places in hash order and are told apart
by size; repeated rows count each; an empty table gives an empty result; extra
columns are carried along, and an input column named like a result column
(epoch, block, position) is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.common import whole_text
from tidewright.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WAYS = 16
FEW_SOURCES = 10_000
OUT = ("epoch", "block", "position")


def token_count(text_col: str = "text") -> Column:
    return F.greatest(F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long"), F.lit(1).cast("long"))


def source_key(source_col: str) -> Column:
    """A text that is never null; different for null and for any named source."""
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))


def source_shares(counted: DataFrame) -> DataFrame:
    """(source_key, docs, tokens, share) from (source_key, tokens) rows."""
    sums = counted.groupBy("source_key").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens"))
    sums = cut_lineage(sums)
    everything = sums.agg(F.sum("tokens")).first()[0]
    return sums.withColumn("share", F.col("tokens") / F.lit(everything))


def measure(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy in nats, largest repetition when the least repeated source is seen once)
    for each exponent: one row comes back, whatever the number of sources."""
    aggs = []
    for i, a in enumerate(exponents):
        power = F.pow("share", F.lit(a))
        aggs += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log("share")).alias(f"l{i}")]
    ends = shares.agg(F.min("share").alias("least"), F.max("share").alias("most"), *aggs).first()
    out = []
    for i, a in enumerate(exponents):
        z, logs = ends[f"z{i}"], ends[f"l{i}"]
        repeat = (ends["most"] / ends["least"]) ** abs(1 - a)
        out.append((math.log(z) - a * logs / z, repeat))
    return out


def find_exponent(shares: DataFrame, entropy: float | None = None, max_repeat: float | None = None, tol: float = 1e-12) -> float:
    """The exponent whose weights have ``entropy`` (in nats), or the smallest one in [0, 1]
    that repeats no source more than ``max_repeat`` times as often as the least repeated.
    Both figures fall as the exponent grows, so the interval can be narrowed."""
    if (entropy is None) == (max_repeat is None):
        raise ValueError("give a target entropy or a repetition limit")
    if not shares.take(1):
        return 1.0
    which, target = (0, entropy) if max_repeat is None else (1, max_repeat)
    low, high = 0.0, 16.0 if max_repeat is None else 1.0
    if measure(shares, [low])[0][which] <= target:
        return low
    while high - low > tol:
        steps = [low + (high - low) * i / WAYS for i in range(WAYS + 1)]
        over = max([0, *(i for i, m in enumerate(measure(shares, steps)) if m[which] > target)])
        low, high = steps[over], steps[min(over + 1, WAYS)]
        if over == WAYS:  # not even the largest exponent reaches the target
            break
    return high


def quotas(shares: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """Adds weight and quota (tokens). Without a budget: the smallest one at which every
    document is taken at least once."""
    powers = shares.withColumn("power", F.pow("share", F.lit(exponent)))
    z, per_power = powers.agg(F.sum("power"), F.max(F.col("tokens") / F.col("power"))).first()
    size = F.lit(per_power) * F.col("power") if budget is None else F.lit(float(budget)) * F.col("power") / F.lit(z)
    return powers.select(
        "source_key", "docs", "tokens", (F.col("power") / F.lit(z)).alias("weight"), F.round(size).cast("long").alias("quota"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", tokens: Column | None = None,
    entropy: float | None = None, max_repeat: float | None = None, budget: int | None = None, block_tokens: int = 1 << 20, seed: int = 0,
) -> DataFrame:
    """The mixed stream: rows of ``docs``, each once per epoch it is taken in, with epoch,
    block and position (in the block, from 1). Written as it comes, each partition
    holds whole blocks in order."""
    cols = [c for c in docs.columns if c not in OUT]
    rows = docs.select(
        source_key(source_col).alias("source_key"), (token_count(text_col) if tokens is None else tokens).cast("long").alias("tokens"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.struct(*cols).alias("row"))
    shares = source_shares(rows.select("source_key", "tokens"))
    plan = quotas(shares, find_exponent(shares, entropy, max_repeat), budget)
    plan = cut_lineage(plan.where("quota > 0").select(
        "source_key", F.col("tokens").alias("all"), "quota", F.ceil(F.col("quota") / F.col("tokens")).alias("epochs"),
        F.round(F.log(16.0, F.sqrt("docs"))).cast("int").alias("digits")))
    # a few sources go to every task; beyond that rows meet their source in a shuffle
    few = plan.count() <= FEW_SOURCES
    blocks = max(1, round((plan.agg(F.sum("quota")).first()[0] or 0) / block_tokens))
    draws = (
        rows.join(F.broadcast(plan) if few else plan, "source_key")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
        .withColumn("draw", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), "id").cast("binary")))
        .withColumn("bucket", F.substring("draw", F.lit(1), F.col("digits")))
    )
    stream = ["source_key", "epoch"]
    bucket_sums = draws.groupBy(*stream, "bucket").agg(F.sum("tokens").alias("in_bucket"))
    before = W.partitionBy(*stream).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = bucket_sums.select(*stream, "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("offset"))
    earlier = W.partitionBy(*stream, "bucket").orderBy("draw", "tokens").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("epoch") * F.col("all") + F.col("offset") + F.col("within")
    taken = (
        draws.withColumn("within", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
        .join(offsets, [*stream, "bucket"])
        .withColumn("start", start)
        .where("start < quota")
        # the product may pass 64 bits, the quotient is below the number of blocks
        .withColumn("block", F.expr(f"(cast(start as decimal(20,0)) * cast({blocks} as decimal(18,0))) div cast(quota as decimal(20,0))"))
        .withColumn("place", F.md5(F.concat_ws("|", F.lit(f"{seed}|block"), F.col("epoch").cast("string"), "id").cast("binary")))
    )
    in_block = W.partitionBy("block").orderBy("place", "tokens")
    return taken.select(*[F.col("row")[c].alias(c) for c in cols], "epoch", "block", F.row_number().over(in_block).cast("long").alias("position"))
