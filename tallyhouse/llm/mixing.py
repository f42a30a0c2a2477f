"""Mixing sources to target weights: capped water-filling and seeded repetitions.

DataFrame functions only. Sizes, totals and cuts are narrow tables; a document's text
is not moved. One table row per source is the only thing joined to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import write_through

WORD = r"[^\x20\x09-\x0D]+"
# Pieces of a source that are summed apart, so that no task meets a whole source.
_BUCKET_BITS = 12
_DRAW_BITS = 32


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: str, seed: int) -> Column:
    """A whole number under 2**32 that depends on the id and the seed alone."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, _DRAW_BITS // 4), 16, 10).cast("long")


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``sources`` (source, source_size, weight, ...) with ``target`` for each.

    The targets sum to ``share`` of all sizes (or to all caps, if those are less) and
    follow the weights, but stop at ``max_epochs`` times the size; what is cut off goes
    to the others by weight until none is above its cap. Sources fill up in the order
    of cap / weight, so running sums in that order give the final level at once.
    """
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    order = [(F.col("_cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = sources.withColumn("_cap", cap).select(
        "*",
        F.coalesce(F.sum("_cap").over(before), F.lit(0.0)).alias("_full"),
        F.sum("weight").over(after).alias("_open"),
        (F.lit(float(share)) * F.sum("source_size").over(everything)).alias("_total"),
    )
    # The first source that does not reach its cap sets the level for all behind it.
    stays = F.col("weight") * (F.col("_total") - F.col("_full")) < F.col("_cap") * F.col("_open")
    level = F.struct(F.col("_full"), F.col("_open"))
    first = F.first(F.when(stays, level), ignorenulls=True).over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    target = F.when(
        F.col("_level").isNotNull(),
        F.col("weight") * (F.col("_total") - F.col("_level._full")) / F.col("_level._open"),
    ).otherwise(F.col("_cap"))
    return filled.withColumn("_level", first).withColumn("target", F.least(target, F.col("_cap"))).drop(
        "_cap", "_full", "_open", "_total", "_level"
    )


def plan_mix(
    documents: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """(sizes of the documents, one row per source with target, repetitions and cuts).

    Both are written tables. A source's target is ``whole`` repetitions of all its
    documents and a fractional one: long documents (over twice the mean) are drawn one by
    one, the others are taken in the order of their draws up to the words still missing, so
    that a source ends within half a usual document of its target.
    """
    sized = write_through(
        documents.select("doc_id", "source", n_words().alias("size"), draw("doc_id", seed).alias("draw"))
    )
    # Partial sums per piece first: a hot source sends as many rows as it has pieces.
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs")
    )
    # One row per source from here on.
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ranked = totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int") + 1))
    targets = write_through(water_fill(ranked, share, max_epochs).select(
        "*",
        F.floor(F.try_divide("target", "source_size")).cast("long").alias("_whole"),
    ).select(
        "source", "source_size", "source_docs", "weight", "target",
        F.coalesce("_whole", F.lit(0)).alias("whole"),
        F.coalesce(F.col("target") - F.col("_whole") * F.col("source_size"), F.lit(0.0)).alias("part"),
    ))
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    marked = joined.select("source", "doc_id", "size", "draw", "part", is_long().alias("long"), drawn().alias("drawn"))
    bucket = F.shiftright("draw", _DRAW_BITS - _BUCKET_BITS)
    short = ~F.col("long")
    pieces = marked.groupBy("source", bucket.alias("bucket")).agg(
        F.first("part").alias("part"),
        F.sum(F.when(short, F.col("size")).otherwise(0)).alias("short_size"),
        F.sum(F.when(~short & F.col("drawn"), F.col("size")).otherwise(0)).alias("long_taken"),
    )
    by_source = Window.partitionBy("source")  # at most 2**_BUCKET_BITS rows each
    before = by_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("short_size").over(before), F.lit(0)).alias("_before"),
        (F.col("part") - F.sum("long_taken").over(by_source)).alias("missing"),
    )
    placed = marked.where(short & (F.col("size") > 0)).withColumn("bucket", bucket).join(
        offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    )
    inside = Window.partitionBy("source", "bucket").orderBy(
        "draw", F.col("doc_id").asc_nulls_last(), "size"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = placed.withColumn("_until", F.col("_before") + F.sum("size").over(inside))
    cuts = reached.where(F.col("_until") - F.col("size") / 2 < F.col("missing")).groupBy("source").agg(
        F.max(position()).alias("cut")
    )
    plan = targets.join(cuts.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
    return sized, write_through(plan.drop("_source"))


def is_long() -> Column:
    return F.col("size") * F.col("source_docs") > 2 * F.col("source_size")


def drawn() -> Column:
    return F.col("draw") * F.col("source_size") < F.col("part") * F.lit(float(1 << _DRAW_BITS))


def position() -> Column:
    """Place of a short document in its source's order; null ids come last."""
    last = F.lit((1 << 63) - 1)
    return F.struct(F.col("draw"), F.coalesce(F.col("doc_id").cast("long"), last).alias("id"), F.col("size"))


def repetitions() -> Column:
    """How often a document is taken, from its own columns and its source's row."""
    short_in = F.coalesce(position() <= F.col("cut"), F.lit(False)) & (F.col("size") > 0)
    extra = F.when(is_long(), drawn()).otherwise(short_in)
    return F.col("whole") + extra.cast("long")


def mix(documents: DataFrame, **settings) -> DataFrame:
    """One row per document: size, source_size, target of its source, repetitions, taken words.

    See :func:`plan_mix` for the settings. Documents without words and sources without any
    are taken 0 words. Null sources form one source; a null doc_id draws as an empty text.
    Rows that repeat a document get equal results. Other columns are not read.
    """
    sized, plan = plan_mix(documents, **settings)
    joined = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    return joined.withColumn("repetitions", repetitions()).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("repetitions")).alias("taken"), "source", "repetitions",
    )


def mixed_documents(documents: DataFrame, **settings) -> DataFrame:
    """The documents themselves, each as many times as the mix takes it; same columns."""
    _, plan = plan_mix(documents, **settings)
    plan = plan.select(F.col("source").alias("_source"), F.struct(*[c for c in plan.columns if c != "source"]).alias("_plan"))
    row = F.struct(*documents.columns).alias("_row")
    staged = documents.select(row, "doc_id", F.col("source").alias("_of"), n_words().alias("size"),
                              draw("doc_id", settings.get("seed", 17)).alias("draw"))
    joined = staged.join(plan, F.col("_of").eqNullSafe(F.col("_source"))).select("_row", "doc_id", "size", "draw", "_plan.*")
    times = joined.select("_row", repetitions().alias("_times")).where(F.col("_times") > 0)
    return times.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_n")).select("_row.*")
