"""Operator 4: mixing sources to target weights by Poisson replication.

A source's rate is its target share of the output's characters over its share
of the input's, times ``epochs``. A document of that source appears k times,
where k is the smallest number whose Poisson(rate) distribution function reaches
a hash-seeded uniform of the document; the copies are then put in one global
pseudo-random order.

Defined cases: a null source is the source ''. A null or empty text counts one
character, so that every source has a rate. A source without a target weight
gets rate 0; without weights the target is the ``TEMPERATURE`` power of the sizes.
Equal ids get equal counts where they share a source; documents without an id draw by their text, so equal ones
get equal counts. Very long texts only count by their length. An empty table gives an empty result. The result has the
input's columns and those with the prefix ``mix_``, which replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unit_hash, whole_text

TEMPERATURE = 0.7
EPOCHS = 1.0
SEED = "mix"
#: Copies of each source's rate row; a hot source is joined in as many tasks.
SALTS = 32


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = EPOCHS,
                 temperature: float = TEMPERATURE) -> DataFrame:
    """(source, n_docs, size, rate), one row a source, summed before the shuffle."""
    size = F.greatest(F.length(whole_text()), F.lit(1)).cast("long")
    sizes = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(
        F.count("*").alias("n_docs"), F.sum(size).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("wish", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        given = F.coalesce(*[F.when(F.col("source") == s, F.lit(float(w))) for s, w in weights.items()], F.lit(0.0))
        sizes = sizes.withColumn("wish", given)
    # Exact sums: wishes as decimals, so that the order of addition does not matter.
    wish = F.col("wish").cast("decimal(38,9)")
    total = sizes.agg(F.sum("size").alias("size"), F.sum(wish).cast("double").alias("wish")).first()
    if not total["wish"]:
        return sizes.select("source", "n_docs", "size", F.lit(0.0).alias("rate"))
    share = F.col("wish") / F.lit(total["wish"])
    return sizes.select("source", "n_docs", "size", (
        F.lit(float(epochs)) * share * (F.lit(float(total["size"])) / F.col("size"))).alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """The distribution function at 0, 1, ... up to far beyond the mean.

    The step probabilities are summed from the mean's neighbourhood in logarithms, so large rates don't underflow.
    """
    top = (rate + 12 * F.sqrt(rate + 1) + 12).cast("int")
    log_p = lambda k: k * F.ln(rate) - rate
    start = F.struct(F.array().cast("array<double>").alias("steps"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("logs"))

    def step(a: Column, k: Column) -> Column:
        logs = a["logs"] + F.when(k > 0, F.ln(F.greatest(k, F.lit(1)).cast("double"))).otherwise(0.0)
        total = a["sum"] + F.exp(log_p(k) - logs)
        return F.struct(F.array_append(a["steps"], total).alias("steps"), total.alias("sum"), logs.alias("logs"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(0), top), start, step)["steps"]).otherwise(
        F.array().cast("array<double>"))


def row_name() -> Column:
    """What a document's draws hash: its id, or its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(whole_text().cast("binary"))))


def with_copies(docs: DataFrame, rates: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with ``mix_rate`` and ``mix_copies`` (0 or more)."""
    steps = rates.select(F.col("source").alias("mix_source"), F.col("rate").alias("mix_rate"),
                         poisson_steps(F.col("rate")).alias("mix_steps"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("mix_salt"))
    draw = unit_hash(F.lit(seed), row_name())
    rows = docs.withColumns({
        "mix_draw": draw, "mix_salt": F.pmod(F.xxhash64("doc_id", whole_text()), F.lit(SALTS)).cast("int"),
        "mix_source": F.coalesce("source", F.lit(""))})
    rows = rows.join(steps, ["mix_source", "mix_salt"])
    # Empty steps (rate 0) give 0 copies.
    copies = F.size(F.filter("mix_steps", lambda c: c < F.col("mix_draw")))
    return rows.withColumn("mix_copies", copies).drop("mix_steps", "mix_salt", "mix_source", "mix_draw")


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = EPOCHS,
          seed: str = SEED, partitions: int | None = None) -> DataFrame:
    """Every copy of every document, in one global pseudo-random order.

    Adds ``mix_rate``, ``mix_copies``, ``mix_copy`` (from 0) and ``mix_order`` (the key of the order).
    """
    rows = with_copies(docs, source_rates(docs, weights, epochs), seed)
    rows = rows.filter("mix_copies > 0")
    rows = rows.withColumn("mix_copy", F.explode(F.sequence(F.lit(0), F.col("mix_copies") - 1)))
    rows = rows.withColumn("mix_order", unit_hash(F.lit(f"{seed}-order"), row_name(), F.col("mix_copy")))
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, "mix_order").sortWithinPartitions("mix_order", "doc_id", "mix_copy")
