"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescast.llm.common import WORD, repeats, text_of, uniform
from salescast.staging import materialize

#: Weights of the sources in code point order, over and over.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words of the mix as a share of all words.
SHARE = 1.5
#: No source and no document is taken more often than this.
MOST = 2


def size_of(text: str = "text") -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), null last.

    The total is shared by weight; what a source cannot take (``most`` times its size) is shared anew among
    the others. Sources fill up in the order of limit over weight, so the level at which the rest stand is
    found with running sums over that order instead of rounds. The table has a row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("w", F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    limit = F.col("source_size") * float(most)
    by_fill = Window.orderBy(limit / F.col("w"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        ranked.withColumn("limit", limit)
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
        # The first source whose limit lies above the level that is left for it and those after it.
        .withColumn("stands", F.min(F.when(F.col("limit") >= F.col("level") * F.col("w"), F.struct(
            limit / F.col("w"), F.col("level")))).over(everything)["level"]))
    return levels.select("source", "source_size", F.coalesce(
        F.least(F.col("limit"), F.col("stands") * F.col("w")), F.col("limit")).alias("target"))


def _inclusion(size: str = "size") -> Column:
    """Inclusion probability: proportional to the size, 1 from ``sure_size`` on, 0 for empty texts."""
    x = F.col(size)
    return F.when((x <= 0) | F.col("rate").isNull(), F.lit(0.0)).when(
        x >= F.col("sure_size"), F.lit(1.0)).otherwise(F.least(F.col("rate") * x, F.lit(1.0)))


def _rank(seed: int) -> Column:
    """Random odds over inclusion odds, as a share: below 1/2 where the odds are below 1. Null is never taken."""
    u, p = uniform(F.col("key"), seed), _inclusion()
    odds = (u / (1 - u)) / (p / (1 - p))
    return F.when(p <= 0, F.lit(None).cast("double")).when(p >= 1, F.lit(0.0)).otherwise(odds / (1 + odds))


def plan_mix(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
             seed: int = 17) -> DataFrame:
    """One row a source: what decides for each of its documents how often it is taken.

    ``sizes`` has key, source, size. A source with target T and size S takes every document floor(T / S)
    times for certain. The rest R of T is drawn: a document's inclusion probability is proportional to its
    size, with documents that would exceed 1 certain (``sure_size``), such that the expected words are R.
    Documents are then ranked by random odds over inclusion odds (Pareto order), and the first ones are
    taken until their words reach R: a sample of fixed size in words. The rank is a function of the key, so a
    rerun draws the same documents.

    The place where the words reach R is found by sums over two levels of 1,024 bins of the rank, so only the
    documents of one bin in a million are ever sorted.
    """
    by_source = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    by_source = materialize(by_source, "mix-sizes")
    sources = by_source.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialize(
        source_targets(sources, weights, share, most)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.least(
            F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))),
        "mix-targets")

    def same(a: str = "source", b: str = "t_source") -> Column:
        return F.col(a).eqNullSafe(F.col(b))

    named = targets.select(F.col("source").alias("t_source"), "rest")
    # From the largest size down: what is left for the sizes from this one on, over their sum of squares.
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    x, n = F.col("size").cast("double"), F.col("n")
    rates = (
        by_source.where("size > 0").join(named, same())
        .withColumn("above", F.coalesce(F.sum(x * n).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("squares", F.sum(x * x * n).over(down.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("r", (F.col("rest") - F.col("above")) / F.col("squares"))
        .groupBy("source").agg(
            F.max(F.when(F.col("r") * x < 1, F.struct("size", "r"))).alias("open"), F.max("size").alias("largest"))
        .select(F.col("source").alias("r_source"),
                F.when(F.col("open").isNull(), F.lit(0.0)).otherwise(F.greatest(F.col("open.r"), F.lit(0.0))).alias("rate"),
                (F.coalesce(F.col("open.size"), F.lit(0)) + 1).alias("sure_size")))
    rated = materialize(targets.join(rates, same("source", "r_source"), "left").drop("r_source"), "mix-rates")

    ranked = (
        sizes.join(rated.select(F.col("source").alias("t_source"), "rest", "rate", "sure_size"), same())
        .where("size > 0 and rest > 0").withColumn("q", _rank(seed)).where("q is not null"))
    fine = F.least(F.floor(F.col("q") * float(1 << 20)), F.lit((1 << 20) - 1))
    ranked = ranked.select("key", "source", "size", "q", F.floor(fine / 1024).alias("coarse"), fine.alias("fine"))

    def reach(rows: DataFrame, part: str, at: DataFrame) -> DataFrame:
        """(source, part, left): the part in which the words reach what is left, and what is left inside it."""
        run = Window.partitionBy("source").orderBy(part)
        sums = rows.groupBy("source", part).agg(F.sum("size").alias("words")).withColumn(
            "until", F.sum("words").over(run))
        return (sums.join(at.select(F.col("source").alias("t_source"), "left"), same())
                .where("until >= left").groupBy("source")
                .agg(F.min(F.struct(part, (F.col("left") - F.col("until") + F.col("words")).alias("left"))).alias("c"))
                .select("source", f"c.{part}", "c.left"))

    def inside(rows: DataFrame, part: str, at: DataFrame) -> DataFrame:
        return rows.join(at.select(F.col("source").alias("t_source"), F.col(part).alias("t_part")),
                         same() & (F.col(part) == F.col("t_part")), "left_semi")

    coarse = materialize(reach(ranked, "coarse", targets.withColumnRenamed("rest", "left")), "mix-coarse")
    rows = inside(ranked, "coarse", coarse)
    narrow = materialize(reach(rows, "fine", coarse), "mix-fine")
    run = Window.partitionBy("source").orderBy("q", "key")
    # The document that crosses the mark is taken if that comes nearer to it than leaving it out.
    last = (
        inside(rows, "fine", narrow).withColumn("until", F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, 0)))
        .join(narrow.select(F.col("source").alias("t_source"), "left"), same())
        .where(F.col("until") - F.col("size") / 2 <= F.col("left"))
        .groupBy("source").agg(F.max(F.struct("q", "key")).alias("last"))
        .select(F.col("source").alias("l_source"), F.col("last.q").alias("last_q"), F.col("last.key").alias("last_key")))
    ends = narrow.select(F.col("source").alias("e_source"), (F.col("fine") / float(1 << 20)).alias("floor_q"))
    return materialize(
        rated.join(ends, same("source", "e_source"), "left").join(last, same("source", "l_source"), "left")
        .select("source", "source_size", "target", "whole", "rest", "rate", "sure_size", "floor_q", "last_q", "last_key"),
        "mix-plan")


def _copies() -> Column:
    """How often a row with its rank ``q`` is taken, beside the plan of its source."""
    q = F.col("q")
    drawn = F.when((F.col("size") <= 0) | q.isNull() | (F.col("rest") <= 0), F.lit(False)).when(
        F.col("floor_q").isNull(), F.lit(True)).when(
        F.col("last_q").isNull(), q < F.col("floor_q")).otherwise(
        (q < F.col("last_q")) | ((q == F.col("last_q")) & ((F.col("key") <= F.col("last_key")))))
    return F.col("whole") + F.coalesce(drawn, F.lit(False)).cast("long")


#: Equal rows that one task numbers.
CHUNK = 10_000


def _spread(groups: DataFrame, start: Column) -> DataFrame:
    """A row for each of the ``n`` rows of a group, numbered (``nth``) from ``start`` on; large groups are dealt out in chunks."""
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))).alias("part")
    dealt = groups.withColumn("start", start).select("*", parts)
    if groups.where(F.col("n") > CHUNK).isEmpty():
        return dealt.select("*", _numbers()).drop("n", "start", "part")
    return dealt.repartition("h", "part").select("*", _numbers()).drop("n", "start", "part")


def _numbers() -> Column:
    first = F.col("part") * CHUNK
    last = F.least(first + CHUNK, F.col("n")) - 1
    return F.explode(F.sequence(F.col("start") + first, F.col("start") + last)).alias("nth")


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size_of().alias("size"),
                       F.xxhash64(text_of()).alias("h"), *more)


def _keyed(rows: DataFrame, repeated: bool) -> DataFrame:
    """``rows`` of :func:`_sized` with the ``key`` they are drawn by.

    The key is drawn from the id, the text and, among rows of a source that agree in both, a number. Such rows are counted
    and written out again from their number, so no task gets all of them; which of them has which number
    follows from the whole rows alone.
    """
    if repeated:
        groups = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
        start = F.lit(0).cast("long")
        if "row" in rows.columns:  # rows that differ in other columns share the numbers of their key
            before = Window.partitionBy("doc_id", "h", "source").orderBy(F.xxhash64("row")).rowsBetween(Window.unboundedPreceding, -1)
            start = F.coalesce(F.sum("n").over(before), start)
        rows = _spread(groups, start)
    else:
        rows = rows.withColumn("nth", F.lit(0).cast("long"))
    return rows.withColumn("key", F.xxhash64("doc_id", "h", "nth")).drop("h", "nth")


def _planned(docs: DataFrame, weights: Sequence[float], share: float, most: int, seed: int) -> tuple[DataFrame, DataFrame, bool]:
    """The keyed narrow rows, the plan of their sources, and whether any rows agree in id, text and source."""
    narrow = materialize(_sized(docs), "mix-documents")
    repeated = repeats(narrow, "doc_id", "h", "source")
    sizes = _keyed(narrow, repeated)
    if repeated:
        sizes = materialize(sizes, "mix-numbered")
    return sizes, plan_mix(sizes, weights, share, most, seed), repeated


def mix_counts(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
               seed: int = 17) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, copies, taken (words, repeats counted).

    Sources with a null name are one source, the last. A null text has size 0 and is taken 0 times where only
    the draw would take it. Rows that repeat an id, have none, or are equal throughout are drawn each on their own. An
    empty table gives no rows. Other columns are not read.
    """
    sizes, plan, _ = _planned(docs, weights, share, most, seed)
    return _counted(sizes, plan, seed).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _counted(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    joined = rows.join(plan.withColumnRenamed("source", "p_source"), F.col("source").eqNullSafe(F.col("p_source")))
    return joined.withColumn("q", _rank(seed)).withColumn("copies", _copies())


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
        seed: int = 17) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``; odd rows as in :func:`mix_counts`.

    A document's count follows from its own row and its source's plan, so the texts are read again but not
    shuffled for it (unless rows are repeated, or there are too many sources to send the plan around).
    """
    _, plan, repeated = _planned(docs, weights, share, most, seed)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    taken = _counted(_keyed(_sized(docs, own), repeated), plan, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
