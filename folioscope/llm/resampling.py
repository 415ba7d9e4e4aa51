"""Importance resampling towards a target distribution of hashed word runs.

Features of a text are its words and its pairs of neighbouring words; a feature
falls into one of BUCKETS buckets by its checksum.  The share of a bucket in the
target corpus against its share in all documents is the bucket's gain, and a
document's weight is the mean gain of its features.  Gumbel noise, which follows
from the document's key, is added to the weights, and the documents of highest
score are drawn: that is a sample without replacement, in proportion to the
exponent of the weights.

Documents are scored without exploding them.  Higher-order functions make the
array of a document's buckets, and an aggregate over the array sums element_at
of a literal array that holds all gains.  The arrays of bucket numbers, two bytes
a feature, are kept in the shared folder between counting and scoring, so texts
are cut and hashed once.  Only the buckets' totals, at most BUCKETS rows a task,
are shuffled and come to the driver; the draw ranks narrow rows by a
range-partitioned sort.

Gains and scores are integers, thousandths of natural logarithms rounded down.

Defined results: a null or empty text, or one without words, has no features and
weight 0; a null key counts as an empty string in the noise.  Repeated rows each
get a row and each count, ties go to the smaller key, and rows that are equal in
score and key are ranked by features and weight.  An empty target, or an empty
table of documents, gives finite gains.  Columns besides key and text are never read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed
from .sharding import numbered

BUCKETS = 10_000
#: Words that a document needs to be drawn, the share drawn in percent, and the seed of the noise.
LEAST_WORDS, PERCENT, SEED = 20, 25, 7

#: Maps A-Z to a-z, and every ASCII character that isn't in a word to a space.
_FROM = "".join(c for c in map(chr, range(128)) if not (c.isdigit() or c.islower()))
_TO = "".join(c.lower() if c.isupper() else " " for c in _FROM)


def words(text: str) -> Column:
    """The words of a text: runs of a-z, 0-9 and all characters beyond ASCII, A-Z in lower case."""
    own = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), _FROM, _TO)
    return F.array_remove(F.split(own, " "), "")


def buckets(own: str, n: int = BUCKETS) -> Column:
    """The buckets of all features of a column of words; pairs come last, and a null after them."""
    one = lambda w: (F.crc32(w.cast("binary")) % n).cast("smallint")
    pairs = F.zip_with(own, F.slice(own, 2, F.greatest(F.size(own), F.lit(1))), lambda a, b: one(F.concat(a, F.lit(" "), b)))
    return F.concat(F.transform(own, one), pairs)


def features(texts: DataFrame, text: str = "text", keys: tuple[str, ...] = (), n: int = BUCKETS) -> DataFrame:
    """(keys, n_words, buckets) of every row."""
    return texts.select(*keys, words(text).alias("__words")).select(*keys, F.size("__words").cast("bigint").alias("n_words"), buckets("__words", n).alias("buckets"))


def totals(found: DataFrame, n: int = BUCKETS) -> np.ndarray:
    """How many features each bucket has."""
    own = found.select(F.explode("buckets").alias("bucket")).where("bucket IS NOT NULL").groupBy("bucket").count().toArrow()
    out = np.zeros(n, np.int64)
    out[own.column("bucket").to_numpy()] = own.column("count").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target against that in the source."""
    s, t, n = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weights(found: DataFrame, by_bucket: np.ndarray, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_features, weight) of rows of features."""
    literal = F.split(F.lit(",".join(map(str, by_bucket.tolist()))), ",").cast("array<bigint>")
    total = F.aggregate("buckets", F.lit(0).cast("bigint"), lambda acc, b: acc + F.coalesce(F.element_at(literal, b + 1), F.lit(0).cast("bigint")))
    summed = found.select(key, "n_words", (F.col("n_words") + F.greatest(F.col("n_words") - 1, F.lit(0))).alias("n_features"), total.alias("__total"))
    # Rounds down, below zero too.
    return summed.select(key, "n_words", "n_features", F.expr("if(n_features = 0, 0L, (__total - pmod(__total, n_features)) div n_features)").alias("weight"))


def noise(key: str, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, n_buckets: int = BUCKETS) -> DataFrame:
    """One row per document: (key, n_words, n_features, weight, score, rank); rank is 1 for the highest score and null for the undrawn.

    Of the N documents of at least `least_words` words, percent * N / 100,
    rounded down, are drawn.
    """
    found = checkpointed(features(docs, text, (key,), n_buckets))
    by_bucket = gains(totals(found, n_buckets), totals(features(target, target_text, n=n_buckets), n_buckets))
    scored = checkpointed(weights(found, by_bucket, key).withColumn("score", F.col("weight") + noise(key, seed)))
    able = scored.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    ranked = numbered(able.withColumn("__down", -F.col("score")), ["__down", key, "n_features", "weight"])
    rank = F.when(F.col("rank") < drawn, F.col("rank") + 1).cast("bigint")
    columns = [key, "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, rank.alias("rank")).unionByName(scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("bigint").alias("rank")))
