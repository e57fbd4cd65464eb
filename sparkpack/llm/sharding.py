"""Sharding by proportional stratified interleaving."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpack.llm.common import running, seeded_hash, slots_for

SEED = 20240229
_TOP = 1 << 60


def interleave_shards(rows: DataFrame, key: str, source: str, shards: int, seed: int = SEED) -> DataFrame:
    """Add shard (0 .. shards-1), slot (gapless from 0 in each shard) and source_rank.

    Rows are shuffled by a seeded hash within their source and ranked; rank r of n gets the fraction (2r + 1) / 2n. Sorted by
    fraction, every stretch of rows holds the sources in proportion, so cutting the order into `shards` equal
    stretches gives shards whose counts differ by at most one and match the mixture. Equal texts are not kept together:
    equal counts come first.

    A null source is a source of its own, a null key is hashed as such; repeated rows tie and take any order among
    themselves. Other columns are carried along; an empty table gives an empty table. `rows` must not hold large
    columns: they would be shuffled.
    """
    base = rows.withColumn("_h", seeded_hash(seed, F.col(key), F.col(source)))
    base = base.withColumn("_src", F.struct(F.col(source).isNull().alias("z"), F.coalesce(F.col(source), F.lit("")).alias("s")))
    n = rows.count()
    slots = slots_for(n)
    order = [F.col("_h"), F.col(key)]
    slot = F.floor(F.col("_h") / F.lit(float(_TOP)) * slots)
    ranked = running(base, ["_src"], F.least(slot, F.lit(slots - 1)), order, F.lit(1), slots, "source_rank")
    sizes = base.groupBy(F.col("_src").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    spread = ranked.join(sizes, F.col("_src") == F.col("_of")).drop("_of")
    # compared exactly: (2r+1)/2n as integer parts of a common grid first, then as a double, then by source
    spread = spread.withColumn("_f", (2 * F.col("source_rank") + 1) / (2.0 * F.col("_n")))
    order = [F.col("_f"), F.col("_src"), F.col("_h"), F.col(key)]
    placed = running(spread, [], F.least(F.floor(F.col("_f") * slots), F.lit(slots - 1)), order, F.lit(1), slots, "_at")
    first = lambda s: F.ceil(s * F.lit(n) / F.lit(float(shards)))
    shard = F.least(F.floor(F.col("_at") * F.lit(shards) / F.lit(max(n, 1))), F.lit(shards - 1)).cast("int")
    placed = placed.withColumn("shard", shard)
    placed = placed.withColumn("slot", (F.col("_at") - first(F.col("shard"))).cast("long"))
    return placed.drop("_h", "_src", "_n", "_f", "_at")
