"""Importance resampling towards a target distribution: documents drawn by how much likelier their n-grams are in a target.

Features are runs of 1 to `order` consecutive words (lower-cased A-Z), counted in `buckets` buckets by their crc32.  A bucket's
gain is floor(1000 ln of its smoothed share in the target over that in the documents); a document's weight is the sum of
its features' gains.  Gumbel noise from the id's sha256 is added, and the largest sums are drawn: a sample without replacement
with odds by weight, the same at every run.

Words come from a position table: posexplode gives (row, position, word), and for each order above the first, lead() over
the row's positions appends the following word.  Words of a row are laid out in pieces of PIECE positions, each with the
words that its last runs need, so that no window holds more, however long a text is.  With order 1 no window and no shuffle
of words is needed: explode, hash, join with the gains (a row a bucket, broadcast) and sum are one pass with map-side sums.
Buckets are counted likewise, from whichever table.  Ranks come from one range-partitioned numbering, not from a global window.

Null and empty texts, and texts without words: no features, weight 0, never drawn unless `least` is 0.  Repeated rows and ids
are rows like any.  A null id takes part with the noise of the empty id.  Equal scores: smaller id first (null before all), then
rows in any order.  Empty documents: no rows; an empty target: all gains come from smoothing.  Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.index import running_total
from . import store

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, SEED = 10_000, 2024
#: Words below which a document isn't drawn, and the percentage of the others that is.
LEAST, PERCENT = 20, 10
#: Positions of a row's words in one window.
PIECE = 4096


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(WORDS), F.lit(0))


def features(rows: DataFrame, order: int, piece: int = PIECE) -> DataFrame:
    """`rows` (with a text, and a `row` that tells them apart where order > 1) once for each feature, in column `feature`
    (null: the row has none), without text."""
    keys = [c for c in rows.columns if c != "text"]
    split = rows.select(*keys, words(F.col("text")).alias("words"))
    if order == 1:
        return split.select(*keys, F.explode_outer("words").alias("feature"))
    n = F.size("words")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(piece)))
    cut = split.select(*keys, "words", F.explode_outer(starts).alias("at")).select(*keys, "at", F.slice("words", F.col("at") + 1, piece + order - 1).alias("words"))
    table = cut.select(*keys, "at", F.posexplode_outer("words").alias("pos", "w1"))
    along = Window.partitionBy("row", "at").orderBy("pos")
    for k in range(2, order + 1):
        table = table.withColumn(f"w{k}", F.concat(F.col(f"w{k - 1}"), F.lit(" "), F.lead("w1", k - 1).over(along)))
    runs = F.array(*(F.col(f"w{k}") for k in range(1, order + 1)))
    runs = F.filter(runs, lambda w: w.isNotNull())
    own = table.where(F.col("pos").isNull() | (F.col("pos") < piece))
    return own.select(*keys, F.explode_outer(runs).alias("feature"))


def bucket(feature: Column, buckets: int = BUCKETS) -> Column:
    return F.crc32(feature.cast("binary")) % F.lit(buckets)


def counts(rows: DataFrame, order: int, buckets: int, name: str) -> DataFrame:
    """(b, name): features in each bucket."""
    found = features(rows, order).where("feature is not null").select(bucket(F.col("feature"), buckets).alias("b"))
    return found.groupBy("b").agg(F.count("*").alias(name))


def gains(docs: DataFrame, target: DataFrame, order: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(b, gain): a row a bucket."""
    mine = counts(docs.select(F.monotonically_increasing_id().alias("row"), "text"), order, buckets, "s")
    theirs = counts(target.select(F.monotonically_increasing_id().alias("row"), "text"), order, buckets, "t")
    each = docs.sparkSession.range(buckets).select(F.col("id").alias("b")).join(mine, "b", "left").join(theirs, "b", "left").na.fill(0, ["s", "t"])
    each = store.written(each, "buckets")
    s, t = each.agg(F.sum("s"), F.sum("t")).first()
    ratio = ((F.col("t") + 1) * F.lit(s + buckets)).cast("double") / ((F.col("s") + 1) * F.lit(t + buckets)).cast("double")
    return each.select("b", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 x a standard Gumbel number) of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(float(1 << 32)))))


def weights(docs: DataFrame, target: DataFrame, order: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight (and `row`, by which rows of equal id differ)."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    known = F.broadcast(gains(docs, target, order, buckets))  # a row a bucket
    each = features(rows, order).withColumn("b", bucket(F.col("feature"), buckets)).join(known.withColumnRenamed("b", "known"), F.col("b") == F.col("known"), "left")
    found = each.groupBy("row", "doc_id").agg(F.count("feature").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"))
    if order == 1:
        return found.withColumn("n_words", F.col("n_features"))
    # with n words there are n, n - 1, ... runs of each order, as far as these are positive
    n = F.col("n_features")
    full = order * (order - 1) // 2
    short = F.floor((F.sqrt(8 * n + 1) - 1) / 2)  # n(n+1)/2 runs of fewer words than the order
    return found.withColumn("n_words", F.when(n >= order * (order + 1) // 2, (n + full) / order).otherwise(short).cast("long"))


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST, order: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score, rank (null where it isn't drawn)."""
    found = store.written(weights(docs, target, order, buckets).withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed)).cast("long")), "weights")
    able = found.where(F.col("n_words") >= least)
    size = able.count() * percent // 100
    placed = running_total(able.withColumn("down", -F.col("score")), "down", name="before", ties=("doc_id", "row"))
    rank = F.when(F.col("before") < size, F.col("before") + 1)
    out = placed.withColumn("rank", rank).unionByName(found.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long")), allowMissingColumns=True)
    return out.select("doc_id", "n_words", "n_features", F.col("weight").cast("long").alias("weight"), "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents' ids in their order: doc_id, rank."""
    return draw(docs, target, **options).where("rank is not null").select("doc_id", "rank")


def report(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    return draw(docs, target, **options).drop("n_words")
