"""Mixing sources to target weights: certain whole copies, then a Pareto order sample of the rest.

A source's target T against its size S gives floor(T/S) certain copies of each document; what is left, R words,
is a sample without replacement.  Its inclusion probabilities are proportional to size, cut off at 1: p = min(1, l * size)
with l such that the expected words of the sample are R (documents for which p is 1 are certain, and l is what the others
then need).  Documents are ranked by random odds divided by inclusion odds, u/(1-u) / (p/(1-p)), smallest first, and
taken while their sum stays within R.  One more, the one that brings the sum nearest to R, and another one if that
still brings it nearer, fill what is left.  A document larger than R can't be within R words; it can only be such a last one.  u comes from the md5 of id and text, so
reruns agree however rows are dealt.

No source is sorted whole: ranks are bucketed in two steps of STEP buckets, the words of each (source, bucket) summed with
map-side partial sums, and only the one bucket per source in which R is reached is ordered, within itself.  The
probabilities come from counts by (source, size).  The sources themselves are numbered and laid out by one task if they
are few, by ranges of them otherwise; their targets are a water level over them: no target exceeds MOST times its source.

Null text: size 0, takes no words.  Null source: a source of its own, after all others.  Null ids are told apart by their
texts.  Rows of equal id and text have equal ranks: one is as good as another.  Very long texts count as any.  A source of
size 0 has target 0.  An empty table stays empty.  Extra columns are ignored by `mix` and kept by `mixture`, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store

#: Most copies, as a multiple of a source's size.
MOST = 3
#: Buckets of ranks in each of the two steps.
STEP = 256
#: Documents taken last, to come nearer to a target, at most.
FILLS = 2
#: Sources up to which a row for each is broadcast and one task lays them out; beyond, plain joins and ranges.
FEW = 50_000
WORDS = r"[^\x20\x09-\x0D]+"


def _before(df: DataFrame, order: list[Column], sums: dict[str, Column], few: bool) -> DataFrame:
    """`df` with, for each name, the sum over all rows before each in the order."""
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    if few:
        return df.withColumns({n: zero(c, ahead(Window.orderBy(*order))) for n, c in sums.items()})
    dealt = store.written(df.repartitionByRange(store.parts(df.sparkSession), *order).withColumn("range", F.spark_partition_id()), "ranges")
    whole = dealt.groupBy("range").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    first = whole.select(F.col("range").alias("r"), *(zero(F.col(n), ahead(Window.orderBy("range"))).alias(f"first_{n}") for n in sums))
    out = dealt.withColumns({n: zero(c, ahead(Window.partitionBy("range").orderBy(*order))) for n, c in sums.items()})
    out = out.join(F.broadcast(first), out["range"] == first["r"])  # a row for each task
    return out.withColumns({n: F.col(n) + F.col(f"first_{n}") for n in sums}).select(*df.columns, *sums)


def targets(sizes: DataFrame, most: int = MOST, few: bool = True) -> DataFrame:
    """Of (source, size) per source: weights 1, 2, 3, repeating by name, and each source's target.

    With sources sorted by most * size / weight, the first k are at their ceiling and the rest share what is left
    by weight, for the smallest k at which none is above."""
    name = F.col("source").asc_nulls_last()
    n, total = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    s = _before(sizes, [name], {"number": F.lit(1)}, few).withColumn("weight", F.col("number") % 3 + 1).withColumn("room", F.lit(most) * F.col("size") / F.col("weight"))
    s = _before(s, [F.col("room"), name], {"full": F.col("size"), "light": F.col("weight")}, few)
    weights = n // 3 * 6 + (0, 1, 3)[n % 3]
    s = s.withColumn("level", (F.lit(total) - most * F.col("full")).cast("double") / (F.lit(weights) - F.col("light")).cast("double"))
    level = s.where("level <= room").agg(F.max("level")).first()[0]
    return s.select(
        "source",
        F.col("size").alias("source_size"),
        F.least(F.col("size") * F.lit(float(most)), F.lit(float("inf") if level is None else level) * F.col("weight")).alias("target")
    )


def _random(mark: Column) -> Column:
    """A number in (0, 1): 52 bits of an md5, plus a half."""
    return (F.conv(F.substring(mark, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    mark = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    return store.written(docs.select("doc_id", "source", size.alias("size"), mark.alias("mark"), F.monotonically_increasing_id().alias("row_key"), *more), "sizes")


def mix(docs: DataFrame, most: int = MOST, step: int = STEP, few: int = FEW) -> DataFrame:
    """Per row: doc_id, size, source_size, target, copies (how often the mix takes it), taken (words)."""
    return _mixed(_sized(docs), most, step, few).select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def probabilities(rows: DataFrame) -> DataFrame:
    """Of (s, size, rest): per source l, the sample's inclusion probability for each word of a document (null: all are certain)."""
    counts = rows.where("size > 0 and size <= rest").groupBy("s", "rest", "size").agg(F.count("*").alias("c"))
    size = F.col("size").cast("decimal(19,0)")
    largest = Window.partitionBy("s").orderBy(F.desc("size"))
    certain = F.coalesce(F.sum(F.col("c") * F.col("size")).over(largest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double")
    squares = F.sum(F.col("c").cast("decimal(19,0)") * size * size).over(largest.rowsBetween(Window.currentRow, Window.unboundedFollowing)).cast("double")
    each = counts.withColumn("l", (F.col("rest") - certain) / squares)  # if all larger sizes are certain
    return each.where("l * size <= 1").groupBy("s").agg(F.max_by("l", "size").alias("l")).withColumnRenamed("s", "t")


def _edge(sums: DataFrame) -> DataFrame:
    """Of (s, rest, base, bucket, words): per source the first bucket in which the running sum reaches `rest`, and the sum before it."""
    upto = F.col("base") + F.sum("words").over(Window.partitionBy("s").orderBy("bucket"))
    first = sums.withColumn("upto", upto).where("upto >= rest").groupBy("s").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("base"))).alias("e"))
    return first.select(F.col("s").alias("es"), F.col("e.bucket").alias("edge"), F.col("e.base").alias("base"))


def _mixed(rows: DataFrame, most: int, step: int, few: int) -> DataFrame:
    """`rows` (doc_id, source, size, mark, row_key, anything else) with source_size, target, copies."""
    sizes = store.written(rows.groupBy("source").agg(F.sum("size").alias("size")), "sources")
    is_few = sizes.count() <= few  # a row for each source may be broadcast
    near = (lambda df: F.broadcast(df)) if is_few else (lambda df: df)
    goal = targets(sizes, most, is_few)
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goal = goal.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumnRenamed("source", "s")
    chances = probabilities(rows.select("source", "size").join(near(goal.select("s", "rest")), _same("source", "s")))
    goal = store.written(goal.join(chances, _same("s", "t"), "left").drop("t"), "targets")
    p = F.least(F.coalesce(F.col("l") * F.col("size"), F.lit(1.0)), F.lit(1.0))
    u = _random(F.col("mark"))
    odds = (u / (1 - u)) / (p / (1 - p))
    rank = F.when(p >= 1, F.lit(0.0)).otherwise(odds / (1 + odds))
    ranked = rows.join(near(goal), _same("source", "s")).withColumn("rank", F.when((F.col("size") > 0) & (F.col("size") <= F.col("rest")), rank))
    ranked = ranked.withColumn("bucket", F.least(F.floor(F.col("rank") * (step * step)), F.lit(step * step - 1)).cast("int"))
    some = ranked.where("bucket is not null")
    coarse = some.groupBy("s", "rest", F.floor(F.col("bucket") / step).alias("bucket")).agg(F.sum("size").alias("words"))
    coarse = _edge(coarse.withColumn("base", F.lit(0).cast("long")))
    fine = some.join(near(coarse), _same("s", "es") & (F.floor(F.col("bucket") / step) == F.col("edge")))
    edge = _edge(fine.groupBy("s", "rest", "base", "bucket").agg(F.sum("size").alias("words")))
    out = ranked.join(near(edge), _same("s", "es"), "left")
    out = out.withColumn(
        "part",
        F.when(F.col("bucket") == F.col("edge"), "edge").when(
            (F.col("bucket") < F.col("edge")) | (F.col("bucket").isNotNull() & F.col("edge").isNull()),
            "in"
        ).otherwise("out")
    )
    whole = out.where("part <> 'edge'").withColumn("more", F.when(F.col("part") == "in", 1).otherwise(0))
    order = Window.partitionBy("s").orderBy("rank", "mark", "row_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = out.where("part = 'edge'").withColumn("sum", F.col("base") + F.sum("size").over(order))
    cut = cut.withColumn("more", F.when(F.col("sum") <= F.col("rest"), 1).otherwise(0)).drop("sum")
    first = store.written(whole.unionByName(cut), "sampled")
    gaps = first.groupBy("s", "rest").agg(F.sum(F.col("more") * F.col("size")).alias("had")).select(F.col("s").alias("gs"), (F.col("rest") - F.col("had")).alias("gap"))
    picks = []
    for _ in range(FILLS):
        free = first.where("more = 0 and size > 0").join(near(gaps), _same("s", "gs"))
        for p in picks:
            free = free.join(near(p.select("last_key")), F.col("row_key") == F.col("last_key"), "left_anti")
        free = free.withColumn("off", F.abs(F.col("size") - F.col("gap"))).where("off < gap")
        best = free.groupBy("s").agg(F.min(F.struct("off", F.coalesce("rank", F.lit(1.0)), "mark", "row_key", "size")).alias("l"))
        pick = store.written(best.select(F.col("s").alias("ps"), F.col("l.row_key").alias("last_key"), F.col("l.size").alias("filled")), "filled")
        gaps = gaps.join(near(pick), _same("gs", "ps")).select("gs", (F.col("gap") - F.col("filled")).alias("gap"))
        picks.append(pick)
    last = reduce(DataFrame.union, picks).select("last_key")
    return first.join(near(last), F.col("row_key") == F.col("last_key"), "left").withColumn("copies", F.col("whole") + F.col("more") + F.col("last_key").isNotNull().cast("int"))


def mixture(docs: DataFrame, most: int = MOST, step: int = STEP, few: int = FEW) -> DataFrame:
    """The mix itself: rows of `docs`, each as often as it is taken.  Words are counted once, texts move once."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    taken = _mixed(_sized(docs, whole), most, step, few).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
