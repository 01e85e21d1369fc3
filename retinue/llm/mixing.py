"""Mixing sources to target weights by repeating and thinning documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retinue.llm.frames import carried, word_count
from retinue.operators.staging import settle

# 13 hexadecimal digits: a fraction that a double holds exactly.
_STEPS = float(1 << 52)


def source_targets(sizes: DataFrame, *, weights: Sequence[int] = (5, 2, 1), most_repeats: int = 3) -> DataFrame:
    """Share the total of all sizes among sources by weight, none above ``most_repeats`` times its size.

    ``sizes`` has one row per ``source`` with its ``source_size``. Weights go round in
    code point order of the sources, null last. What a source cannot take is shared among
    the others by weight, until none is above its limit: sources are filled in the order
    in which they reach their limits, so one pass over running sums settles all rounds.
    Adds ``target``; 0 where there is nothing to take.

    The windows run over one row per source in one task: the list of sources is the
    mix's own configuration, and its rows do not grow with the documents of a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    weighted = sizes.withColumn("place", F.row_number().over(by_name)).select(
        "source",
        "source_size",
        cycle[(F.col("place") - 1) % len(weights)].alias("weight"),
        (F.lit(most_repeats) * F.col("source_size")).alias("limit"),
        "place",
    )
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = weighted.withColumns(
        {
            "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)),
            "weight_left": F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    ).withColumn("full", F.col("limit") * F.col("weight_left") <= F.col("left") * F.col("weight"))
    # The first source that is not full fixes the level of all that follow.
    first = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), "place", "left", "weight_left")))
    return level.withColumn("first", first.over(everything)).select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("limit").cast("double"))
        .otherwise(
            F.col("weight").cast("double")
            * F.col("first.left").cast("double")
            / F.col("first.weight_left").cast("double")
        )
        .alias("target"),
    )


def uniform(seed: str, key: Column) -> Column:
    """A number in [0, 1) that depends on seed and key alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(_STEPS)


def repeats(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    most_repeats: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """How often each document goes into the mix.

    A source's rate is its target over its size. Each document is taken floor(rate) times,
    and once more with the rate's fraction as probability, drawn from a hash of seed and id:
    reruns agree, whatever the partitions. Returns one row per input row: ``doc_id``,
    ``size`` (words), ``source_size``, ``target``, ``copies`` and ``row`` (the input row).

    Null text has size 0. Documents without a source form a source. A source without words
    has target 0, and its documents are not taken. Rows with the same id share one draw;
    no other tie decides anything. One text, however long, is a row of a task; it is copied
    like any other and may carry its source beyond the target by its own size. An empty
    table gives an empty result.
    """
    sized = carried(docs, doc_id=doc_id, source=source, size=word_count(F.col(text)))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = settle(source_targets(sizes, weights=weights, most_repeats=most_repeats))
    joined = sized.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (uniform(seed, F.col("doc_id")) < F.col("rate") - F.floor("rate")).cast("bigint")
    return (
        joined.select("d.doc_id", "size", "source_size", "target", "row")
        .withColumn("rate", rate)
        .select("doc_id", "size", "source_size", "target", (F.floor("rate") + extra).alias("copies"), "row")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each row of ``docs`` as often as :func:`repeats` says."""
    taken = repeats(docs, **options).where(F.col("copies") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
