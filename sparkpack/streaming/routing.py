"""Routing with a shard map that results can prove wrong."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpack.operators import shards
from sparkpack.operators.stage import materialize

#: What a micro-batch of results has to tell: the shard a record was routed to, and the one that stored it.
SEEN = ["stream_name", "predicted_shard", "stored_shard"]


class MapInUse:
    """The shard map records are routed with, read once and kept until a result shows that it is wrong.

    `load` reads the open shards (stream_name, shard_no, end_key) as they are now. The map is a stage table with its index;
    the driver holds its place and how often it was read. After a restart it is read anew, so nothing needs to be restored.
    """

    def __init__(self, load: Callable[[SparkSession], DataFrame]):
        self.load, self.index, self.reads = load, None, 0

    def current(self, spark: SparkSession) -> shards.ShardIndex:
        if self.index is None:
            now = materialize(self.load(spark))
            self.index, self.reads = shards.shard_index(shards.shard_ranges(now, ["stream_name"]), ["stream_name"]), self.reads + 1
        return self.index

    def observe(self, seen: DataFrame) -> bool:
        """Drop the map if some record was stored in another shard than it said; records routed without a shard say nothing."""
        wrong = (F.col("predicted_shard") != shards.UNKNOWN_SHARD) & (F.col("predicted_shard") != F.col("stored_shard"))
        if self.index is not None and not seen.filter(wrong).isEmpty():
            self.index = None
        return self.index is None


def route_with_feedback(maps: MapInUse, results: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame], DataFrame]:
    """A step for `runner.run_each_batch`: keyed records to records with shard_no, routed by the map in use.

    results tells what became of a routed micro-batch (SEEN). If that disagrees with the map, the next micro-batch reads
    the map again. The routed batch is stored first, so what is checked is what was sent.
    """
    def step(batch: DataFrame) -> DataFrame:
        routed = materialize(shards.shard_lookup_index(batch, maps.current(batch.sparkSession)))
        if results is not None:
            maps.observe(results(routed))
        return routed
    return step
