"""Mixing sources to token targets by entropy balancing.

Targets: sources, by code point and null last, have repeating weights; they share a multiple
of all tokens by weight, a target stops at ``most`` times its source's tokens, and the
excess is shared again by weight among the others until none is above.

Rates: among all document rates with the right tokens for each source and none above
``most``, those nearest to 1 in relative entropy are ``min(most, exp(l * size / mean))``
with one multiplier l a source: an exponential tilt by size.  The multipliers solve the
convex dual by Newton steps kept inside a bracket; a step is one grouped sum over all
(source, size) counts, all sources at once.

Copies: a source's sizes are taken from the largest to the smallest, with the number of
documents of each.  A size gets its rates' sum in copies, rounded so that the source's
running tokens are off by as little as possible; the next smaller sizes make up for what is
left.  Tokens then miss their target by about half of a small document.  The copies of one
size are spread evenly over its documents in seeded order, 0 to ``most`` each.

Defined cases: null text has size 0; documents of size 0 count for no target and get the
copies their rate gives.  A null source is a source.  A source without tokens has target 0.
Rows with equal ids are told apart by their text's hash, and if that is equal too they are
interchangeable.  An empty table gives no rows.  Extra columns are ignored by ``mix``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docstrata.llm.ranks import bucket_count, hash_order, ranked
from docstrata.llm.storage import passing_workspaces, staged, workspace
from docstrata.llm.words import SPACES

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
_STEPS, _TOLERANCE = 60, 1e-6


def word_count(text: str | Column) -> Column:
    """Number of runs outside ASCII white space; 0 for null."""
    column = F.col(text) if isinstance(text, str) else text
    # White space becomes blanks, so that one split by runs of blanks gives the words.
    words = F.split(F.trim(F.translate(column, SPACES, " " * len(SPACES))), " +")
    return F.when(F.trim(F.translate(F.coalesce(column, F.lit("")), SPACES, " " * len(SPACES))) == "", 0).otherwise(F.size(words)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Targets of sources from (source, source_size).

    Filling is by level: with sources in order of cap / weight, the first k stop at their
    caps for the largest k at which the level left for the others is not below theirs.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.lit(list(weights)), F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))).cast("int") + 1)
    rows = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * float(most))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    rows = (
        rows.withColumn("budget", F.sum("source_size").over(whole) * share)
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weights_left", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("caps_before")) / F.col("weights_left"))
        .withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
    )
    free_level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("level").alias("level")))).over(whole)
    return rows.withColumn("free", free_level).select(
        "source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("free.level"))).alias("target")
    )


def _rate(most: int) -> Column:
    """Rate by size from the source's multiplier; the exponent is held where exp stays finite."""
    return F.least(F.lit(float(most)), F.exp(F.least(F.col("l") * F.col("size") / F.col("mean"), F.lit(50.0))))


def multipliers(counts: DataFrame, goal: DataFrame, folder: str, most: int = MOST) -> DataFrame:
    """(source, l, mean, target) from (source, size, n) and targets, by bracketed Newton steps."""
    means = counts.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("tokens"), F.sum("n").alias("docs"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")
    )
    ratio = F.col("tokens") / F.col("docs")
    # At ``top`` all rates are at their most; the low end takes next to nothing.
    start = goal.alias("g").join(means.alias("m"), F.col("g.source").eqNullSafe(F.col("m.source"))).select(
        "g.source", "target", "tokens", ratio.alias("mean"), (F.log(F.lit(float(most))) * ratio / F.col("least")).alias("top"), (-60.0 * ratio / F.col("least")).alias("bottom")
    )
    up, full = F.col("target") >= F.col("tokens"), F.col("target") >= most * F.col("tokens")
    state = staged(
        start.select(
            "source", "target", "tokens", "mean",
            F.when(full, F.coalesce("top", F.lit(0.0))).otherwise(0.0).alias("l"),
            F.when(up, 0.0).otherwise(F.col("bottom")).alias("lo"), F.when(up, F.col("top")).otherwise(0.0).alias("hi"),
            (full | (F.abs(F.col("tokens") - F.col("target")) <= _TOLERANCE * F.col("target"))).alias("done"),
        ),
        f"{folder}/0",
    )
    # Decimal sums do not depend on the order of rows, so reruns agree to the last bit.
    exact = lambda term: F.sum(term.cast("decimal(34,6)")).cast("double")
    for step in range(1, _STEPS + 1):
        rate = _rate(most)
        sums = (
            counts.alias("c").join(state.where("not done").alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
            .select("s.source", "size", "n", "l", "mean")
            .groupBy("source").agg(
                exact(F.col("n") * F.col("size") * rate).alias("got"),
                exact(F.when(rate < most, F.col("n") * F.col("size") * F.col("size") / F.col("mean") * rate).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.col("got") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("l")).otherwise(F.col("lo")), F.when(gap > 0, F.col("l")).otherwise(F.col("hi"))
        newton = F.col("l") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("new_lo")) & (newton < F.col("new_hi"))
        near = F.abs(gap) <= _TOLERANCE * F.col("target")
        moved = (
            state.alias("s").join(sums.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")), "left").select("s.*", "got", "slope")
            .withColumn("new_lo", lo).withColumn("new_hi", hi)
            .withColumn("next", F.when(inside, newton).otherwise((F.col("new_lo") + F.col("new_hi")) / 2))
            .withColumn("stop", F.col("done") | F.coalesce(near, F.lit(False)))
            .select(
                "source", "target", "tokens", "mean", F.when(F.col("stop"), F.col("l")).otherwise(F.col("next")).alias("l"),
                F.when(F.col("stop"), F.col("lo")).otherwise(F.col("new_lo")).alias("lo"), F.when(F.col("stop"), F.col("hi")).otherwise(F.col("new_hi")).alias("hi"),
                F.col("stop").alias("done"),
            )
        )
        state = staged(moved, f"{folder}/{step}")
        if not state.where("not done").limit(1).count():
            break
    return state.select("source", "l", "mean", "target")


def _copies_by_size(group: pd.DataFrame, most: int) -> pd.DataFrame:
    """Copies of each size of one source; the rows are distinct sizes, not documents."""
    group, owed, totals = group.sort_values("size", ascending=False), 0.0, []
    for size, n, rate in zip(group["size"].tolist(), group["n"].tolist(), group["rate"].tolist()):
        wanted = rate * n + (owed / size if size else 0.0)
        total = min(max(round(wanted), 0), most * n)
        owed += (rate * n - total) * size
        totals.append(total)
    return group.assign(total=totals)[["source", "size", "rate", "n", "total"]]


def mix(
    docs: DataFrame, *, seed: int = 29, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, text: str = "text", doc_id: str = "doc_id", source: str = "source"
) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken of every row."""
    folder = workspace(docs.sparkSession, "mix")
    rows = staged(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("text_key")), f"{folder}/rows"
    )
    counts = staged(rows.groupBy("source", "size").agg(F.count("*").alias("n")), f"{folder}/counts")
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = staged(targets(sizes, weights, share, most), f"{folder}/targets")
    solved = multipliers(counts, goal.select("source", "target"), f"{folder}/newton", most)

    rated = counts.alias("c").join(solved.alias("m"), F.col("c.source").eqNullSafe(F.col("m.source"))).select("c.source", "size", "n", "l", "mean")
    rated = rated.select("source", "size", "n", F.coalesce(_rate(most), F.lit(1.0)).alias("rate"))
    kind = docs.schema[source].dataType.simpleString()
    steps = staged(
        rated.groupBy("source").applyInPandas(lambda group: _copies_by_size(group, most), f"source {kind}, size bigint, rate double, n bigint, total bigint"), f"{folder}/steps"
    )
    n = rows.count()
    order = hash_order(seed, "doc_id", "text_key")
    placed = ranked(rows.withColumn("order", order), ["source", "size"], F.floor(F.col("order") / F.lit(float(1 << 60)) * bucket_count(rows, n)), ["order", "doc_id"], "rank")
    known = placed.alias("p").join(steps.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")) & (F.col("p.size") == F.col("s.size")))
    known = known.select("doc_id", "text_key", "p.source", "p.size", "rate", "n", "total", "rank")
    spread = lambda k: F.floor(k * (F.col("total") / F.col("n")) + 0.5)
    copies = (spread(F.col("rank") + 1) - spread(F.col("rank"))).cast("bigint")
    out = known.withColumn("copies", copies)
    return out.alias("o").join(goal.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source"))).select(
        "doc_id", "text_key", "o.source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", most: int = MOST, **options) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it.

    Rows equal in id and text share out their copies in the order of their other columns.
    """
    folder = workspace(docs.sparkSession, "mixed")
    # How many rows of an id and text are taken at most k times, for each k below ``most``.
    below = [F.count_if(F.col("copies") <= k).alias(f"upto{k}") for k in range(most)]
    with passing_workspaces(docs.sparkSession):  # nothing of the mix is needed once the shares are written
        taken = mix(docs, text=text, doc_id=doc_id, most=most, **options)
        shares = staged(taken.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows"), *below), f"{folder}/copies").alias("t")
    # The document goes through as one column, so its names meet no others.
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"), F.struct(*docs.columns).alias("row")).alias("d")
    found = rows.join(shares, F.col("d.id").eqNullSafe(F.col("t.doc_id")) & (F.col("d.key") == F.col("t.text_key"))).drop("doc_id", "text_key")
    nth = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.xxhash64("row")))
    again = found.where("rows > 1").withColumn("nth", nth)
    every = found.where("rows = 1").withColumn("nth", F.lit(1)).unionByName(again)
    copies = sum((F.when(F.col("nth") > F.col(f"upto{k}"), 1).otherwise(0) for k in range(1, most)), F.when(F.col("nth") > F.col("upto0"), 1).otherwise(0))
    return every.withColumn("copies", copies).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
