"""Mixing sources to target weights: temperature, token budgets, block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.common import fresh, packed, stored, unpacked
from fleetmart.operators.ranking import ranked, row_number


def word_tokens(text: str = "text") -> Column:
    """Words of a text, as its tokens; null or empty has none."""
    words = F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def weights_at(tokens: list[int], exponent: float) -> list[float]:
    """Normalised shares, each raised to ``exponent``; sources without tokens get 0."""
    total = sum(tokens)
    powers = [(n / total) ** exponent if n else 0.0 for n in tokens]
    return [p / sum(powers) for p in powers]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w)


def passes(tokens: list[int], weights: list[float]) -> list[float]:
    """How often each source is read when the least read one is read once."""
    ratios = [w / n if n else 0.0 for n, w in zip(tokens, weights, strict=True)]
    least = min(r for r in ratios if r)
    return [r / least for r in ratios]


def exponent_for(
    tokens: list[int], *, repetitions: float | None = None, target_entropy: float | None = None
) -> float:
    """Bisects the exponent in [0, 1] that meets a limit of repetitions or a target entropy.

    1 leaves the shares as they are, 0 makes all sources alike. The result is the smallest
    exponent whose most repeated source is read no more than ``repetitions`` times, or
    whose weights have an entropy of no more than ``target_entropy`` (in nats).
    """
    if (repetitions is None) == (target_entropy is None):
        raise ValueError("give either repetitions or target_entropy")

    def met(exponent: float) -> bool:
        weights = weights_at(tokens, exponent)
        if repetitions is not None:
            return max(passes(tokens, weights)) <= repetitions
        return entropy(weights) <= target_entropy

    low, high = 0.0, 1.0
    if met(low):
        return low
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if met(middle) else (middle, high)
    return high


def budgets(tokens: list[int], weights: list[float], total: int | None = None) -> list[int]:
    """Tokens to take from each source. Without ``total`` no source is read less than once."""
    if total is not None:
        return [int(w * total) for w in weights]
    return [math.ceil(n * p - 1e-6) for n, p in zip(tokens, passes(tokens, weights), strict=True)]


def _exact_sum(value: Column) -> Column:
    """A sum to 18 places, which does not depend on the order of rows."""
    return F.sum(value.cast("decimal(28,18)"))


def _exponent_over(
    totals: DataFrame, *, repetitions: float | None, target_entropy: float | None
) -> float:
    """``exponent_for`` over a frame of any number of sources (n tokens, none 0)."""
    if (repetitions is None) == (target_entropy is None):
        raise ValueError("give either repetitions or target_entropy")
    if repetitions is not None:
        # Passes are (n / largest) ** (exponent - 1): the smallest source is read most.
        ends = totals.agg(F.min("n"), F.max("n")).first()
        return exponent_for([ends[0], ends[1]], repetitions=repetitions)
    whole = totals.agg(F.sum("n")).first()[0]

    def met(exponents: list[float]) -> list[bool]:
        # With p = share ** exponent the entropy is log(sum p) - exponent * sum(p log share) / sum p.
        share = F.col("n") / F.lit(whole)
        sums = []
        for exponent in exponents:
            power = F.pow(share, F.lit(exponent))
            sums += [_exact_sum(power), _exact_sum(power * F.log(share))]
        found = [float(x) for x in totals.agg(*sums).first()]
        pairs = zip(exponents, found[::2], found[1::2], strict=True)
        return [math.log(p) - e * q / p <= target_entropy for e, p, q in pairs]

    low, high = 0.0, 1.0
    if met([low])[0]:
        return low
    # Many cuts a job instead of two halves: the entropy falls as the exponent grows.
    for _ in range(10):
        cuts = [low + (high - low) * k / 64 for k in range(1, 64)]
        first = next((k for k, ok in enumerate(met(cuts)) if ok), len(cuts))
        low, high = ([low, *cuts][first], [*cuts, high][first])
    return high


def _plan(
    totals: DataFrame,
    *,
    repetitions: float | None,
    target_entropy: float | None,
    total: int | None,
    block_tokens: int,
) -> DataFrame:
    """(_name, _whole, _part, _passes, _blocks) of each source: ``budgets`` by ``totals``."""
    n = F.col("n")
    full = totals.where("n > 0")
    some = full.agg(F.max("n"), F.sum("n")).first()
    if some[0] is None:
        budget = F.lit(0).cast("long")
    else:
        most, whole = some
        exponent = _exponent_over(full, repetitions=repetitions, target_entropy=target_entropy)
        if total is not None:
            power = F.pow(n / F.lit(whole), F.lit(exponent))
            powers = float(full.agg(_exact_sum(power)).first()[0])
            budget = F.floor(power / F.lit(powers) * F.lit(total)).cast("long")
        else:
            budget = F.ceil(n * F.pow(n / F.lit(most), F.lit(exponent - 1.0)) - 1e-6).cast("long")
    return totals.withColumn("budget", budget).select(
        F.col("_source").alias("_name"),
        F.expr("if(n = 0, 1L, budget div n)").alias("_whole"),
        F.expr("if(n = 0, 0L, budget % n)").alias("_part"),
        F.expr("if(n = 0, 1D, greatest(budget, 1L) / n)").alias("_passes"),
        F.expr(f"greatest(1L, (n + {block_tokens - 1}) div {block_tokens})").alias("_blocks"),
    )


def _block_order(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit("block"), "_source", "_block", "_epoch")


def _doc_order(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit("document"), "_key", "_epoch")


def mix(
    docs: DataFrame,
    *,
    source: str = "source",
    repetitions: float | None = 2.0,
    target_entropy: float | None = None,
    total: int | None = None,
    block_tokens: int = 1 << 20,
    most_sources: int = 100_000,
    seed: int = 0,
    tokens: Column | None = None,
    places: bool = True,
    ordered: bool = False,
) -> DataFrame:
    """A row of ``docs`` for every time a document is taken, with its place in the order.

    Adds _epoch, _block, _block_order and _doc_order (with more underscores where ``docs``
    has such a column), unless ``places`` is off: a source is read by epoch, then block order,
    then document order.

    Each source's share of tokens is raised to an exponent that bisection finds, and
    normalised to weights and token budgets. A budget is spent on passes over the source:
    documents fall into blocks of about ``block_tokens`` by a hash of id and text, each
    pass puts its blocks, and the documents of each block, into an order of its own, and
    the last pass stops at the document that reaches the budget. So without ``total`` every
    document is taken at least once.

    ``ordered`` hands the rows out range-partitioned and sorted in that order, so that what is
    written next holds the permutation: a source's blocks lie evenly between the first and
    the last row of the corpus, however often it is read.

    A null source is a source of its own. A text without words costs nothing and is taken
    with its place in the order; a source without any tokens is taken once. Rows equal in id
    and text share a place; where a budget ends among them, the last pass takes as many of
    them as it needs, by a hash of all their columns. An empty table gives no rows.

    Unless ``ordered``, no row moves for this but sums by block, the sizes of one block per
    source, in which the last pass ends, and equal rows among which it ends; totals by source
    are a stored table, which is broadcast up to ``most_sources`` sources. Beyond that rows
    are shuffled by source to meet it.
    """
    spark = docs.sparkSession
    cost = word_tokens() if tokens is None else tokens
    key = F.xxhash64(F.lit(seed), "doc_id", "text")
    light = stored(
        docs.select(
            F.col(source).alias("_source"),
            F.coalesce(cost, F.lit(0)).cast("long").alias("_tokens"),
            key.alias("_key"),
        ),
        "sizes",
    )
    totals = stored(light.groupBy("_source").agg(F.sum("_tokens").alias("n")), "totals")
    plan = _plan(
        totals,
        repetitions=repetitions,
        target_entropy=target_entropy,
        total=total,
        block_tokens=block_tokens,
    )
    sources = stored(plan, "sources")
    # Broadcast while they are few; more sources than that are joined by a shuffle.
    small = sources.count() <= most_sources

    def near(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    def planned(rows: DataFrame) -> DataFrame:
        joined = rows.join(near(sources), rows["_source"].eqNullSafe(sources["_name"]))
        return joined.drop("_name").withColumn("_block", F.pmod("_key", "_blocks"))

    # Where the last pass of each source ends: the block, then the document in it. Rows equal
    # in id and text have one key: they are summed before any window, and cut by number.
    last = planned(light).where("_part > 0 and _tokens > 0").withColumn("_epoch", F.col("_whole"))
    last = last.withColumn("_border", _block_order(seed)).withColumn("_dorder", _doc_order(seed))
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_block = so_far(Window.partitionBy("_source").orderBy("_border", "_block"))
    ends = (
        last.groupBy("_source", "_border", "_block", "_part")
        .agg(F.sum("_tokens").alias("n"))
        .withColumn("upto", F.sum("n").over(by_block))
        .where("upto >= _part and upto - n < _part")
        .select(
            F.col("_source").alias("_name"),
            F.col("_block").alias("_cut_block"),
            (F.col("_part") - F.col("upto") + F.col("n")).alias("_need"),
        )
    )
    ends = stored(ends, "last-blocks")
    inside = last.join(
        near(ends),
        last["_source"].eqNullSafe(ends["_name"]) & (last["_block"] == ends["_cut_block"]),
    )
    by_doc = so_far(Window.partitionBy("_name").orderBy("_dorder", "_key"))
    cuts = (
        inside.groupBy("_name", "_need", "_border", "_block", "_dorder", "_key")
        .agg(F.sum("_tokens").alias("n"), F.max("_tokens").alias("one"), F.count(F.lit(1)).alias("_copies"))
        .withColumn("upto", F.sum("n").over(by_doc))
        .where("upto >= _need and upto - n < _need")
        .select(
            "_name",
            F.struct("_border", "_block", "_dorder", "_key").alias("_cut"),
            F.expr("least(_copies, (_need - upto + n + one - 1) div one)").alias("_take"),
            "_copies",
        )
    )
    cuts = stored(cuts, "last-documents")

    rows = planned(packed(docs, _source=F.col(source), _key=key)).withColumn("_epoch", F.col("_whole"))
    rows = rows.withColumn("_border", _block_order(seed)).withColumn("_dorder", _doc_order(seed))
    rows = rows.withColumn("_at", F.struct("_border", "_block", "_dorder", "_key"))
    ended = rows.join(near(cuts), rows["_source"].eqNullSafe(cuts["_name"]), "left")
    taken_last = F.expr("_cut is not null and (_at < _cut or (_at = _cut and _take = _copies))")
    epochs = F.col("_whole") + F.when(taken_last, 1).otherwise(0) - 1
    places_of = ["_row", "_source", "_key", "_block", "_passes"]
    taken = ended.select(
        *places_of,
        F.explode(F.when(epochs >= 0, F.sequence(F.lit(0).cast("long"), epochs))).alias("_epoch"),
    )
    some = cuts.where("_take < _copies")
    if some.count():
        # Some of the rows equal in id and text: the first by a hash of all they hold.
        alike = rows.join(near(some), rows["_source"].eqNullSafe(some["_name"]) & (rows["_at"] == some["_cut"]))
        alike = alike.withColumn("_hash", F.xxhash64(F.to_json("_row")))
        alike = alike.withColumnRenamed("_row", "_whole_row")  # ranks have a _row of their own
        counted = ranked(alike, [("_name", "asc"), ("_hash", "asc")], [], {"_number": row_number()})
        counted = stored(counted.withColumnRenamed("_whole_row", "_row"), "alike")
        firsts = counted.groupBy(F.col("_name").alias("_whose")).agg(F.min("_number").alias("_first"))
        few = counted.join(near(firsts), counted["_name"].eqNullSafe(firsts["_whose"]))
        taken = taken.unionByName(few.where("_number - _first < _take").select(*places_of, "_epoch"))
    if ordered:
        # A source's blocks lie evenly over the whole corpus; rows of one place are many tasks' work.
        spread = (_block_order(seed).cast("double") + 2.0**63) / 2.0**64
        at = ((F.col("_epoch") + spread) / F.col("_passes")).alias("_at")
        order = ["_at", "_source", "_block", "_dorder", "_any"]
        taken = (
            taken.select("*", at, _doc_order(seed).alias("_dorder"), F.monotonically_increasing_id().alias("_any"))
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
        )
    if not places:
        return unpacked(taken, docs)
    epoch, block, border, dorder = fresh(docs, "epoch", "block", "block_order", "doc_order")
    return taken.select(
        *(F.col("_row").getField(name).alias(name) for name in docs.columns),
        F.col("_epoch").alias(epoch),
        F.col("_block").alias(block),
        _block_order(seed).alias(border),
        _doc_order(seed).alias(dorder),
    )
