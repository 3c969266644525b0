"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.session import materialize

# Weights of the sources in code-point order, repeating, and the most copies of a source or document.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Slices of the ranking per source whose sizes are summed; the exact order is needed inside one only.
SLICE_BITS = 16


def word_count(text: str | Column) -> Column:
    """Words between ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Words to take from each source: (source, source_size, target), a row per source.

    ``sizes`` has columns source and size. Sources in code-point order, NULL last, take the weights in
    turn and share the sum of all sizes. A target stops at ``most`` times its source's size; the excess
    is shared again by weight among the others until none is above. Sources are numbered by a
    distributed sort, and a round of sharing is one sum over the sources.
    """
    spark = sizes.sparkSession
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = sources.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    numbered = spark.createDataFrame(
        ordered.map(lambda x: (x[0][0], x[0][1], weights[x[1] % len(weights)])), "source string, source_size long, weight long"
    )
    table = materialize(numbered, "sources")
    exact = "decimal(38,0)"
    total = int(table.agg(F.sum("source_size")).first()[0] or 0)
    rest, weight = total, int(table.agg(F.sum("weight")).first()[0] or 0)

    def above(rest, weight):
        return F.col("weight").cast(exact) * F.lit(rest).cast(exact) > most * F.col("source_size").cast(exact) * F.lit(weight).cast(exact)

    while weight:
        over = above(rest, weight)
        full, free = table.agg(
            F.sum(F.when(over, most * F.col("source_size")).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight")))
        ).first()
        if (total - int(full), int(free)) == (rest, weight):
            break
        rest, weight = total - int(full), int(free)
    capped = (most * F.col("source_size")).cast("double")
    target = F.when(above(rest, weight), capped).otherwise(F.lit(float(rest)) * F.col("weight") / F.lit(float(weight))) if weight else capped
    return table.select("source", "source_size", target.alias("target"))


def uniform(*keys: str | Column, seed: int = 0) -> Column:
    """A repeatable number strictly between 0 and 1 for each combination of keys."""
    words = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string") if isinstance(k, str) else k, F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(words), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def pareto_rank(number: Column, probability: Column) -> Column:
    """Random odds divided by inclusion odds: units with the smallest values make up the sample."""
    return number / (1 - number) * ((1 - probability) / probability)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 0,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` with size, source_size, target, copies and taken (words, repeats counted).

    A source whose target is f times its size takes floor(f) whole copies of every document for certain.
    The fraction left is each document's inclusion probability: documents are ranked by random odds over
    inclusion odds (Pareto order sampling), and taken in that order as long as this brings the words taken
    nearer to the target, so a source misses its target by half a document at most.

    The order inside a source is never brought to one task: sizes are summed in slices of the ranking, and
    only the slice that the target falls into is ordered. A source that takes whole copies only has no cut and
    nothing of it is ordered. The random numbers are hashes of id, source and size, so reruns agree; rows that
    repeat all three are ordered next to each other in any order. NULL text has size 0 and takes 0 words. NULL
    sources are one source, in the last place. Columns named like the results are replaced; other columns are
    kept. An empty table gives no rows.
    """
    placed = placed_rows(docs, weights, most, seed, doc_id, text, source)
    order = Window.partitionBy("__source").orderBy("__rank", F.col(doc_id)).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("__cut.before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    inside = placed.where("__ordered").withColumn("__chosen", (2 * ahead + F.col("size") <= 2 * F.col("__budget")).cast("long"))
    # Without words in the source all its documents come along once; whole copies of the others are all there is.
    below = F.when(F.col("__open"), F.coalesce(F.col("__slice") < F.col("__cut.slice"), F.lit(True))).otherwise(F.col("__source_size") == 0)
    outside = placed.where("NOT __ordered").withColumn("__chosen", below.cast("long"))
    both = inside.unionByName(outside)
    names = ("size", "source_size", "target", "copies", "taken")
    return both.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in names],
        "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__whole") + F.col("__chosen")).alias("copies"),
        (F.col("size") * (F.col("__whole") + F.col("__chosen"))).alias("taken"),
    )


def placed_rows(docs: DataFrame, weights: tuple[int, ...], most: int, seed: int, doc_id: str, text: str, source: str) -> DataFrame:
    """The rows of ``docs`` with their source's target and cut, their slice of its ranking, and whether they have to be ordered."""
    rows = docs.withColumn("size", word_count(F.col(text)))
    keys = rows.select(F.col(source).cast("string").alias("source"), F.col(doc_id).cast("string").alias("id"), "size")
    stored = materialize(keys, "sizes")
    targets = source_targets(stored, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = materialize(
        targets.select(
            F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
            whole.alias("__whole"),
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") - whole).otherwise(0.0).alias("__share"),
            F.greatest(F.col("target") - whole * F.col("source_size"), F.lit(0.0)).alias("__budget"),
        ),
        "targets",
    )
    # Nothing is sampled where whole copies reach the target.
    targets = targets.withColumn("__open", F.expr("__share > 0 AND __budget > 0"))

    def ranked(frame: DataFrame, source: Column, key: Column, targets: DataFrame) -> DataFrame:
        joined = frame.join(targets, source.eqNullSafe(F.col("__source")))
        rank = F.when(F.col("__share") > 0, pareto_rank(uniform(key, source.cast("string"), F.col("size"), seed=seed), F.col("__share"))).otherwise(0.0)
        joined = joined.withColumn("__rank", rank)
        return joined.withColumn("__slice", F.floor(F.col("__rank") / (1 + F.col("__rank")) * (1 << SLICE_BITS)).cast("int"))

    sums = ranked(stored, F.col("source"), F.col("id"), targets).where("__open").groupBy("__source", "__slice").agg(
        F.sum("size").alias("__words"), F.first("__budget").alias("__budget")
    )
    # Running sums in two levels, so no task orders all slices of a source.
    sums = materialize(sums.withColumn("__coarse", F.shiftright("__slice", SLICE_BITS // 2)), "slices")
    coarse = sums.groupBy("__source", "__coarse").agg(F.sum("__words").alias("__all"))
    start = F.sum("__all").over(Window.partitionBy("__source").orderBy("__coarse")) - F.col("__all")
    coarse = coarse.select(F.col("__source").alias("__s"), F.col("__coarse").alias("__k"), start.alias("__start"))
    upto = F.sum("__words").over(Window.partitionBy("__source", "__coarse").orderBy("__slice"))
    sums = sums.withColumn("__upto", upto).join(coarse, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__coarse") == F.col("__k")))
    upto = F.col("__start") + F.col("__upto")
    # The first slice that goes beyond the target: all before it are taken, none behind it, and it is ordered.
    cuts = sums.where(upto > F.col("__budget")).groupBy(F.col("__source").alias("__s")).agg(
        F.min(F.struct(F.col("__slice").alias("slice"), (upto - F.col("__words")).alias("before"))).alias("__cut")
    )
    # A row per source: Spark sends it to all tasks while sources are few.
    targets = materialize(targets.join(cuts, F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s"), "cuts")
    placed = ranked(rows, F.col(source), F.col(doc_id).cast("string"), targets)
    return placed.withColumn("__ordered", F.coalesce(F.col("__slice") == F.col("__cut.slice"), F.lit(False)))


def mixed_copies(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row per copy taken, numbered from 1 in a column ``copy``; size, source_size and target are kept.

    Documents without words carry nothing into a mix measured in words; they come along when their rank falls
    below the cut.
    """
    rows = mix(docs, **options).where("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "taken")
