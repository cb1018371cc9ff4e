"""Mixing sources to target weights by temperature.

A source's share of the tokens is raised to an exponent and normalised. The
exponent is found by bisection, for a least entropy (bits), for a limit on how
often a source is repeated, or for both; it lies between 0 (equal weights) and 1 (the
sources' own shares), so no source is ever thinned out for being small. The limit
on repeats goes before the entropy. The weights are then realised under a
token budget: a source is a run of epochs, an epoch a permutation of blocks of
its documents, a block a permutation of documents; documents are taken in that
order until the source's share of the budget is met.

Only DataFrame functions. A round of the search evaluates 63 exponents in one
aggregation (six bisection steps), so the driver sees 63 rows a round whatever
the number of sources. Blocks hold about ``block_docs`` documents, so no task
orders a whole source: a window sees one row per block, or one block.

Cases: null sources form one source; a null or empty text has no tokens and
follows its block; a source without tokens has weight 0 and is left out; an entropy that
the sources have already leaves their shares as they are, one out of reach makes them
as equal as the limit on repeats allows; a budget of more than ``max_repeats`` times the
input is met only up to that;
repeated rows count each and are taken together; an empty table gives no rows;
other columns are kept, also where they clash with the names added here (those
start with ``mix_``; an input column of such a name is replaced).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import staged

_GRID, _ROUNDS = 64, 5      # five rounds of six bisection steps each
_FLATTEST, _NATURAL = 0.0, 1.0


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Adds ``mix_src`` (never null) and ``mix_key``, a hash of the row."""
    source = F.col("source").cast("string")
    return docs.withColumns({
        "mix_src": F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source)),
        "mix_key": F.xxhash64(F.lit(seed), "doc_id", "text"),
    })


def _n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _exponent(shares: DataFrame, budget_ratio: float, target_entropy: float | None,
              max_repeats: float | None) -> float:
    """The exponent nearest to 1 from below (flatter) whose weights have the entropy,
    or the least one that keeps the repeats if that is greater: entropy falls as the
    exponent grows, and so do the repeats of the smallest source, the most repeated one.
    At 1 every source is repeated as often. ``shares`` has one ``share`` per source."""
    log_p = F.log(F.col("share"))
    power = F.exp(F.col("a") * log_p)

    def measured(lo: float, hi: float) -> list[tuple[float, float, float]]:
        grid = [lo + (hi - lo) * k / _GRID for k in range(1, _GRID)]
        rows = (shares.select("share", F.explode(F.array(*map(F.lit, grid))).alias("a"))
                .groupBy("a")
                .agg(F.sum(power).alias("z"), F.sum(power * log_p).alias("zl"),
                     F.max((F.col("a") - 1) * log_p).alias("m"))
                .select("a", ((F.log("z") - F.col("a") * F.col("zl") / F.col("z"))
                              / F.log(F.lit(2.0))).alias("entropy"),
                        (F.exp("m") / F.col("z") * budget_ratio).alias("repeats"))
                .collect())
        return sorted((r.a, r.entropy, r.repeats) for r in rows)

    def search(lo: float, hi: float, low_enough) -> float:
        for _ in range(_ROUNDS):
            below, above = lo, hi
            for a, entropy, repeats in measured(lo, hi):
                if low_enough(entropy, repeats):
                    above = a
                    break
                below = a
            lo, hi = below, above
        return hi

    a = _FLATTEST if target_entropy is None else search(
        _FLATTEST, _NATURAL, lambda h, r: h <= target_entropy)
    if max_repeats is not None:
        a = max(a, search(_FLATTEST, _NATURAL, lambda h, r: r <= max_repeats))
    return a


def weights(sources: DataFrame, budget: float, target_entropy: float | None = None,
            max_repeats: float | None = None) -> DataFrame:
    """``sources`` (mix_src, mix_tokens) with ``mix_share``, ``mix_weight`` and
    ``mix_quota`` (tokens of the budget). Sources without tokens are left out."""
    some = sources.filter(F.col("mix_tokens") > 0)
    total = some.agg(F.sum("mix_tokens")).first()[0]
    if not total:
        return some.withColumns({c: F.lit(0.0) for c in ("mix_share", "mix_weight", "mix_quota")})
    shares = some.withColumn("mix_share", F.col("mix_tokens") / F.lit(float(total)))
    a = _exponent(shares.select(F.col("mix_share").alias("share")), budget / total,
                  target_entropy, max_repeats)
    z = 1.0 if a == _NATURAL else shares.agg(F.sum(F.pow("mix_share", F.lit(a)))).first()[0]
    repeats = F.pow("mix_share", F.lit(a - 1)) / F.lit(z) * F.lit(budget / total)
    if max_repeats is not None:
        repeats = F.least(repeats, F.lit(float(max_repeats)))
    return (shares.withColumn("mix_weight", F.pow("mix_share", F.lit(a)) / F.lit(z))
                  .withColumn("mix_quota", F.col("mix_tokens") * repeats))


def mix(docs: DataFrame, target_entropy: float | None = 4.0, max_repeats: float | None = 4.0,
        budget: float | None = None, block_docs: int = 4096, seed: int = 7,
        entropy_share: float | None = None, budget_ratio: float = 1.0) -> DataFrame:
    """``docs`` (doc_id, text, source and others) with each row repeated as often
    as it is taken. ``budget`` is in tokens (words); none means ``budget_ratio`` times what the input
    has. With ``entropy_share`` the target entropy is that share of the most that the sources can have
    (the logarithm of their number).

    Added columns: ``mix_tokens``, ``mix_weight`` (of the source), ``mix_epoch``
    (from 0), ``mix_block`` and ``mix_rank``, by which a source's rows of one epoch are
    ordered: blocks permuted by a hash of (epoch, block), documents by a hash of the row.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower().startswith("mix_")])
    slim = staged(_keyed(docs.select("doc_id", "text", "source"), seed).select(
        "mix_src", "mix_key", _n_tokens(F.col("text").cast("string")).alias("mix_tokens")),
        "mix-rows")
    sources = slim.groupBy("mix_src").agg(F.sum("mix_tokens").alias("mix_tokens"),
                                          F.count("*").alias("mix_docs"))
    sources = staged(sources, "mix-sources")
    tokens, some = sources.filter("mix_tokens > 0").agg(F.sum("mix_tokens"), F.count("*")).first()
    if budget is None:
        budget = budget_ratio * float(tokens or 0)
    if entropy_share is not None:
        target_entropy = entropy_share * math.log2(max(some, 1))
    quotas = staged(
        weights(sources, budget, target_entropy, max_repeats).select(
            "mix_src", "mix_weight", F.ceil(F.col("mix_docs") / block_docs).alias("mix_blocks"),
            F.floor(F.col("mix_quota") / F.col("mix_tokens")).cast("int").alias("mix_full"),
            (F.col("mix_quota") % F.col("mix_tokens")).alias("mix_rest")), "mix-quotas")

    def blocked(rows: DataFrame) -> DataFrame:
        return rows.join(quotas, "mix_src").withColumns({
            "mix_block": F.pmod("mix_key", "mix_blocks"),
            "mix_order": F.xxhash64("mix_key", F.lit(seed)),
        })

    def last_epoch(block: Column) -> Column:
        return F.xxhash64(F.col("mix_full"), block, F.lit(seed))

    # the last, partial epoch: whole blocks in permuted order, then part of one
    by_block = (blocked(slim).groupBy("mix_src", "mix_block", "mix_full", "mix_rest")
                .agg(F.sum("mix_tokens").alias("tokens")))
    in_turn = Window.partitionBy("mix_src").orderBy(last_epoch(F.col("mix_block")), "mix_block")
    before = F.sum("tokens").over(in_turn.rowsBetween(Window.unboundedPreceding, -1))
    turns = staged(by_block.withColumn("before", F.coalesce(before, F.lit(0))), "mix-blocks")
    room = F.col("mix_rest") - F.col("before")
    cut = turns.filter((room > 0) & (F.col("tokens") > room)).select(
        "mix_src", "mix_block", room.alias("room"))
    in_block = Window.partitionBy("mix_src", "mix_block").orderBy("mix_order")
    running = F.sum("mix_tokens").over(in_block.rowsBetween(Window.unboundedPreceding, -1))
    limits = (blocked(slim).join(cut, ["mix_src", "mix_block"])
              .withColumn("before", F.coalesce(running, F.lit(0)))
              .filter(F.col("before") < F.col("room"))
              .groupBy("mix_src", "mix_block").agg(F.max("mix_order").alias("mix_limit")))
    taken = staged(
        turns.filter(room > 0).join(limits, ["mix_src", "mix_block"], "left").select(
            "mix_src", "mix_block", "mix_limit", F.lit(True).alias("mix_taken")), "mix-taken")

    rows = blocked(_keyed(docs, seed)).join(taken, ["mix_src", "mix_block"], "left")
    extra = F.when(F.col("mix_taken") & (F.col("mix_limit").isNull()
                                         | (F.col("mix_order") <= F.col("mix_limit"))), 1)
    copies = F.col("mix_full") + F.coalesce(extra, F.lit(0))
    return (rows.withColumn("mix_copies", copies).filter("mix_copies > 0")
            .select(*docs.columns, _n_tokens(F.col("text").cast("string")).alias("mix_tokens"),
                    "mix_weight", "mix_block", "mix_order",
                    F.explode(F.sequence(F.lit(0), F.col("mix_copies") - 1)).alias("mix_epoch"))
            .withColumn("mix_rank", F.struct(
                F.xxhash64("mix_epoch", "mix_block", F.lit(seed)).alias("block"),
                F.col("mix_order").alias("doc")))
            .drop("mix_order"))
