"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate: its target share of the mix divided by its share
of the corpus. Each document draws a copy count from the Poisson distribution of its
source's rate by inversion: a uniform number seeded by (seed, id) is looked up in the
cumulative probabilities. The document is exploded by the count and the copies are dealt
globally by a hash of (seed, id, copy number).

Rates: with ``weights`` the target share of source s is weights[s] / sum(weights) (a
source without a weight gets none); otherwise it is proportional to size ** temperature.
Sizes are code points of the text; ``epochs`` scales the expected size of the whole mix.

Edge cases: a null source is a source of its own. A null or empty text adds no size; a
source without any text has rate ``epochs``. Rows equal in id draw the same count and the
same deal (a null id counts as an empty one), so repeated rows stay repeated. No rows give
no rows. Other columns, whatever their names, are carried along.

Scale: one aggregation by source (combined before the shuffle, so a hot source costs
nothing), one lookup of the rate (``frames.attach``: broadcast if counted small, salted
otherwise), a row-local explode and one shuffle on a hash of all copies, even by nature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry.llm.frames import attach, fresh, materialise, unit_hash

SEED = 5
TEMPERATURE = 0.7
EPOCHS = 1.0


def rates(docs: DataFrame, source: str = "source", text: str = "text", weights: dict | None = None,
          temperature: float = TEMPERATURE, epochs: float = EPOCHS) -> DataFrame:
    """(source, rate): one row per source."""
    sizes = docs.groupBy(F.col(source).alias("source")) \
        .agg(F.sum(F.coalesce(F.length(text), F.lit(0))).cast("double").alias("size"))
    sizes = materialise(sizes, "source-sizes")
    if weights is None:
        share = sizes.withColumn("w", F.when(F.col("size") > 0, F.pow("size", F.lit(float(temperature)))).otherwise(0.0))
    else:
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, w double")
        share = sizes.join(F.broadcast(named), sizes["source"].eqNullSafe(named["source"]), "left") \
            .select(sizes["source"], "size", F.coalesce("w", F.lit(0.0)).alias("w"))
    total = share.agg(F.sum("size").alias("all_size"), F.sum("w").alias("all_w"))
    return share.join(F.broadcast(total)).select(  # one row of totals
        "source", F.when(F.col("size") > 0, epochs * F.col("w") / F.col("all_w") * F.col("all_size") / F.col("size"))
        .otherwise(F.lit(float(epochs))).alias("rate"))


def poisson_tables(rate: DataFrame) -> DataFrame:
    """(source, rate, cdf): cumulative probabilities of 0, 1, ... copies, until nothing measurable is left.

    Terms are taken in logarithms, so a large rate does not underflow.
    """
    by = Window.partitionBy("source", "rate").orderBy("k")
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    terms = rate.withColumn("k", F.explode(F.sequence(F.lit(0), last))) \
        .withColumn("log_factorial", F.sum(F.log(F.greatest(F.col("k"), F.lit(1)).cast("double"))).over(by)) \
        .withColumn("p", F.when(F.col("rate") > 0, F.exp(F.col("k") * F.log("rate") - F.col("rate") - F.col("log_factorial")))
                    .otherwise((F.col("k") == 0).cast("double"))) \
        .withColumn("below", F.sum("p").over(by))
    return terms.groupBy("source", "rate").agg(F.array_sort(F.collect_list("below")).alias("cdf"))


def replicate(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text",
              seed: int = SEED, with_details: bool = False, **options) -> DataFrame:
    """``docs`` with every row repeated by its Poisson count, dealt globally.

    ``with_details`` adds rate, copies, copy (from 1) and shuffle_key.
    """
    cdf, u, n, key, rate, copy = (fresh(x) for x in ("cdf", "u", "n", "key", "rate", "copy"))
    stats = poisson_tables(rates(docs, source, text, **options)).select(
        F.col("source").alias(source), F.col("rate").alias(rate), F.col("cdf").alias(cdf))
    stats = materialise(stats, "poisson")
    drawn = attach(docs, stats, source).withColumn(u, unit_hash(F.col(id_column), seed=seed)) \
        .withColumn(n, F.size(F.filter(cdf, lambda c: c <= F.col(u)))).drop(cdf, u)
    copies = drawn.filter(F.col(n) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))) \
        .withColumn(key, F.md5(F.concat_ws(":", F.lit(f"deal{seed}"), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.col(copy).cast("string"))))
    dealt = copies.repartition(F.col(key)).sortWithinPartitions(key)
    if not with_details:
        return dealt.drop(rate, n, copy, key)
    return dealt.withColumnsRenamed({rate: "rate", n: "copies", copy: "copy", key: "shuffle_key"})
