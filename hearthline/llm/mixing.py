"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

A document's rate is the expected number of its copies. For each source the rates of largest entropy
that meet the token constraint ``sum(rate * size) = target`` are exponential tilts
``min(cap, exp(lambda * size / mean size))`` of one copy each. The multiplier minimises the convex dual;
damped Newton steps find it for all sources at once, each step one aggregation over the table of
``(source, size, documents)``, which is stored and small against the texts.

Rates become whole copies by error diffusion. Documents of a source fall into cells by size class and
hash of the id. Going through the cells, large classes first, a cell's documents get the whole number of
copies nearest to what they are owed, and what was given too much or too little is carried on to the
next cell, so that small documents make up for large ones. A source has a fixed number of cells at
most, whatever its number of documents, and the result depends on ids and texts alone.

Defined results: a null or empty text has size 0 and takes no words; a null source is a source, the
last one; a source without words has target 0; repeated rows share a cell and get equal copies; an
empty table gives an empty mix. Only the id, source and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthline.sources.stages import stage


@dataclass(frozen=True)
class Settings:
    weights: tuple[float, ...] = (3, 1, 2)  # by rank of the source, repeating
    budget: float = 1.5  # tokens of the mix, as a multiple of all tokens
    cap: int = 2  # copies of a document, and of a source's tokens, at most
    buckets: int = 128  # cells per size class
    steps: int = 60
    tolerance: float = 1e-6


def size_of(text: str) -> Column:
    """Number of words: runs without white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0))


def sizes(docs: DataFrame, id: str, source: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("id"), F.col(source).alias("source"), size_of(text).alias("size"))


def targets(sized: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``source, source_size, target`` for every source.

    Sources in code-point order weigh ``weights``, repeating, and share the budget. A target stops at
    ``cap`` times its source; what is over is shared again by weight until none is above. That is a
    common level per unit of weight, found by going through the sources in the order in which they
    reach their caps. One row per source passes through one task here, and no document.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(settings.weights)
    weight = F.array(*[F.lit(float(w)) for w in settings.weights])
    per = per.withColumn("w", F.get(weight, (F.row_number().over(order) - 1) % n))
    per = per.withColumn("most", F.col("source_size") * float(settings.cap))
    filling = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) * settings.budget
    per = per.withColumn("level", (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(after))
    # The first source that stays below its cap has the common level; if none does, all are capped.
    per = per.withColumn("common", F.max(F.when(F.col("most") >= F.col("level") * F.col("w"), F.col("level"))).over(whole))
    target = F.least(F.col("most"), F.coalesce(F.col("common") * F.col("w"), F.col("most")))
    return per.select("source", "source_size", target.alias("target"))


def _tilt(cap: int) -> tuple[Column, Column]:
    """Whether the rate is below its cap, and the rate, at multiplier ``lam`` and covariate ``c``."""
    free = F.col("lam") * F.col("c") < F.log(F.lit(float(cap)))
    return free, F.when(free, F.exp(F.col("lam") * F.col("c"))).otherwise(float(cap))


def multipliers(sized: DataFrame, goal: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``goal`` with ``mean`` and ``lam``, the dual solution per source; null where all is capped."""
    strata = sized.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    strata = stage(strata, "mix-strata")
    means = strata.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    state = goal.join(means.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    full = F.col("target") >= settings.cap * F.col("source_size") * (1 - 1e-12)
    state = state.select(
        "*", F.when(~full, F.lit(0.0)).alias("lam"), F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"), F.when(full, 0.0).otherwise(1.0).alias("error"),
    )
    state = stage(state, "mix-dual")
    for _ in range(settings.steps):
        open_ = state.where(F.col("error") > settings.tolerance)
        if open_.isEmpty():
            break
        free, rate = _tilt(settings.cap)
        tokens = F.col("n") * F.col("size")
        sums = (
            strata.join(open_.select(F.col("source").alias("s"), "lam", "mean"), F.col("source").eqNullSafe(F.col("s")))
            .withColumn("c", F.col("size") / F.col("mean"))
            .groupBy("s")
            .agg(F.sum(tokens * rate).alias("got"), F.sum(F.when(free, tokens * F.col("c") * rate).otherwise(0.0)).alias("slope"))
        )
        gap = F.col("target") - F.col("got")
        low = F.when(gap > 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.col("lam")).otherwise(F.col("high"))
        reach = F.greatest(F.lit(2.0), F.abs("lam"))
        step = F.when(F.col("slope") > 0, gap / F.col("slope")).otherwise(F.signum(gap) * reach)
        newton = F.col("lam") + F.greatest(-reach, F.least(reach, step))
        inside = (F.coalesce(newton > F.col("low"), F.lit(True))) & (F.coalesce(newton < F.col("high"), F.lit(True)))
        moved = (
            state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
            .withColumns({"low": low, "high": high})
            .select(
                "source", "source_size", "target", "mean",
                F.when(F.col("got").isNull(), F.col("lam")).when(F.abs(gap) <= settings.tolerance * F.col("target"), F.col("lam"))
                .when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2).alias("lam"),
                "low", "high",
                F.when(F.col("got").isNull(), F.col("error")).otherwise(F.abs(gap) / F.greatest(F.col("target"), F.lit(1e-300))).alias("error"),
            )
        )
        state = stage(moved, "mix-dual")
    return state.select("source", "source_size", "target", "mean", "lam")


def _rated(rows: DataFrame, solved: DataFrame, settings: Settings) -> DataFrame:
    """``rows`` (``id``, ``source``, ``size``) with the rate and the cell of each."""
    solved = solved.withColumnRenamed("source", "s")
    # Many rows share a source: the few rows of ``solved`` are broadcast if Spark finds them small,
    # else an adaptive skew join splits the large sources.
    rated = rows.join(solved, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    rated = rated.withColumn("c", F.col("size") / F.col("mean"))
    _, tilted = _tilt(settings.cap)
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("lam").isNull(), float(settings.cap)).otherwise(tilted)
    rated = rated.withColumn("rate", rate)
    return rated.withColumns({
        "class": F.when(F.col("size") > 0, F.floor(2 * F.log2("size"))).otherwise(-1).cast("int"),
        "bucket": F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(settings.buckets)).cast("int"),
    })


def _mixed(docs: DataFrame, id: str, source: str, text: str, settings: Settings, more: list[Column]) -> DataFrame:
    sized = stage(sizes(docs, id, source, text), "mix-sizes")
    solved = multipliers(sized, stage(targets(sized, settings), "mix-targets"), settings)
    given = _cell_copies(_rated(sized, solved, settings), settings).select(
        F.col("source").alias("s"), F.col("class").alias("k"), F.col("bucket").alias("b"), F.col("copies").alias("given")
    )
    rows = sized if not more else docs.select(
        F.col(id).alias("id"), F.col(source).alias("source"), size_of(text).alias("size"), *more
    )
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("k")) & (F.col("bucket") == F.col("b"))
    rated = _rated(rows, solved, settings).join(given, same, "left")
    return rated.withColumn("copies", F.coalesce("given", F.lit(0)))


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text",
        settings: Settings = Settings()) -> DataFrame:
    """``id, source, size, source_size, target, rate, copies, taken`` per row of ``docs``."""
    mixed = _mixed(docs, id, source, text, settings, [])
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("id", "source", "size", "source_size", "target", "rate", "copies", taken)


def repeat(docs: DataFrame, copy: str = "copy", id: str = "doc_id", source: str = "source", text: str = "text",
           settings: Settings = Settings()) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, numbered by ``copy`` from 1.

    The new column replaces one of the same name.
    """
    names = [c for c in docs.columns if c != copy]
    mixed = _mixed(docs, id, source, text, settings, [F.struct(*names).alias("row")])
    times = F.expr("if(copies > 0, sequence(1, copies), cast(array() as array<int>))")
    return mixed.select("row", F.explode(times).alias("n")).select("row.*", F.col("n").alias(copy))


def _cell_copies(rated: DataFrame, settings: Settings) -> DataFrame:
    """Copies of the documents of each cell, by error diffusion from large to small."""
    cells = (
        rated.where("size > 0")
        .groupBy("source", "class", "bucket")
        .agg(F.sum("size").alias("tokens"), F.sum(F.col("size") * F.col("rate")).alias("wanted"))
    )
    row = F.struct((-F.col("class")).alias("k"), F.col("bucket").alias("b"), F.col("tokens").alias("n"), F.col("wanted").alias("q"))
    # At most 128 size classes times ``buckets`` cells for a source.
    lists = cells.groupBy("source").agg(F.array_sort(F.collect_list(row)).alias("cells"))
    copies = f"least({settings.cap}, greatest(0, cast(round((a.owed + x.q) / x.n) as int)))"
    walk = F.expr(f"""
        aggregate(cells, named_struct('owed', 0D, 'given', cast(array() as array<struct<k:int,b:int,c:int>>)),
          (a, x) -> named_struct('owed', a.owed + x.q - x.n * {copies},
            'given', concat(a.given, array(named_struct('k', x.k, 'b', x.b, 'c', {copies})))),
          a -> a.given)""")
    given = lists.select("source", F.explode(walk).alias("x"))
    return stage(given.select("source", (-F.col("x.k")).alias("class"), F.col("x.b").alias("bucket"), F.col("x.c").alias("copies")), "mix-cells")
