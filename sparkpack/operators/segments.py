"""Greedy cuts of one global order under a row bound and a size bound, by pointer doubling.

Where a batch starts depends on where the one before it started, but every row knows where the next batch would start if one
started at it. The order is cut into blocks; a batch that reaches into a block covers at most its first `max_rows` rows, so what a
block does is a table with one line for each of these entries: where the next block is entered, how many batches
start here, and where the last one starts. Tables compose, so the tables of 2, 4, 8 ... blocks are joined in as many rounds as
the number of blocks has digits, and no task walks the order.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpack.operators.scan import ranged_row_numbers, spread
from sparkpack.operators.stage import materialize

BLOCK_ROWS = 4096


def _next_starts(size: np.ndarray, max_rows: int, max_size: int) -> np.ndarray:
    """For each row the start of the next batch if one starts here; a row above the size bound travels alone."""
    total = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(len(size))
    by_size = np.searchsorted(total, total[:-1] + max_size, "right") - 1
    return np.maximum(at + 1, np.minimum(at + max_rows, by_size))


def _tables(max_rows: int, max_size: int):
    """One line per entry of a block: the next block's entry, batches that start here, the row where the last of them starts."""
    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        rn, own = pdf["rn"].to_numpy(np.int64), int(pdf["own"].sum())
        following = np.minimum(_next_starts(pdf["size"].to_numpy(np.int64), max_rows, max_size), own + max_rows - 1).tolist()
        leave, count, last = [0] * own, [0] * own, [0] * own
        for i in range(own - 1, -1, -1):
            j = following[i]
            leave[i], count[i], last[i] = (j - own, 1, int(rn[i])) if j >= own else (leave[j], count[j] + 1, last[j])
        # the end of the order may have fewer rows than entries
        beyond = range(own, max_rows)
        n = min(own, max_rows)
        return pd.DataFrame([[key[0], leave[:n] + [i - own for i in beyond], count[:n] + [0 for _ in beyond], last[:n] + [-1 for _ in beyond]]],
                            columns=["block", "leave", "count", "last"])
    return fn


def _composed(tables: DataFrame, blocks: int) -> DataFrame:
    """Per block the table of everything up to and including it."""
    reach = 1
    while reach < blocks:
        earlier = tables.select((F.col("block") + reach).alias("block"), *[F.col(c).alias(f"_{c}") for c in ("leave", "count", "last")])
        at = lambda name: F.transform("_leave", lambda e: F.get(F.col(name), e.cast("int")))
        both = tables.join(earlier, "block", "left")
        joined = F.col("_leave").isNotNull()
        tables = materialize(both.select(
            "block",
            F.when(joined, at("leave")).otherwise(F.col("leave")).alias("leave"),
            F.when(joined, F.zip_with("_count", at("count"), lambda a, b: a + b)).otherwise(F.col("count")).alias("count"),
            F.when(joined, F.zip_with("_last", at("last"), lambda a, b: F.when(b >= 0, b).otherwise(a))).otherwise(F.col("last")).alias("last")))
        reach *= 2
    return tables


def _assigned(max_rows: int, max_size: int):
    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        rn, own = pdf["rn"].to_numpy(np.int64), int(pdf["own"].sum())
        entry, before, last = (int(pdf[c].iloc[0]) for c in ("entry", "before", "last_start"))
        following, starts = _next_starts(pdf["size"].to_numpy(np.int64), max_rows, max_size).tolist(), []
        i = entry
        while i < own:
            starts.append(i)
            i = following[i]
        which = np.searchsorted(np.array(starts, np.int64), np.arange(own), "right")       # 0: the batch that reaches in
        first = np.concatenate([[last], rn[starts]]).astype(np.int64)[which]
        return pd.DataFrame({"rn": rn[:own], "batch_no": before - 1 + which, "pos": rn[:own] - first})
    return fn


def cut_batches(df: DataFrame, order: list[Column], size: Column, max_rows: int, max_size: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add batch_no and pos (both from 0): batches of consecutive rows in `order`, of at most max_rows rows and max_size in sum, each as
    long as it can be. A row larger than max_size is a batch of its own. Ties of the order may fall either way; nulls in
    `size` count nothing. No rows give no rows."""
    block_rows = max(block_rows, max_rows)
    numbered = materialize(ranged_row_numbers(df, [], order))
    block = F.floor(F.col("rn") / block_rows).cast("bigint")
    slim = numbered.select("rn", F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint")).alias("size"))
    # a block also sees the rows its last batch may reach into
    homes = F.when((F.col("rn") % block_rows < max_rows) & (F.col("rn") >= block_rows), F.array(block, block - 1)).otherwise(F.array(block))
    rows = slim.withColumn("_own", block).withColumn("block", F.explode(homes))
    rows = materialize(spread(rows.select("block", "rn", "size", (F.col("_own") == F.col("block")).alias("own")), "block"))
    blocks = (rows.agg(F.max("block")).first()[0] or 0) + 1
    tables = materialize(rows.groupBy("block").applyInPandas(_tables(max_rows, max_size), "block long, leave array<long>, count array<long>, last array<long>"))
    upto = _composed(tables, blocks).select((F.col("block") + 1).alias("block"), F.get("leave", F.lit(0)).alias("entry"),
                                            F.get("count", F.lit(0)).alias("before"), F.get("last", F.lit(0)).alias("last_start"))
    entered = rows.join(upto, "block", "left").na.fill({"entry": 0, "before": 0, "last_start": 0})
    placed = entered.groupBy("block").applyInPandas(_assigned(max_rows, max_size), "rn long, batch_no long, pos long")
    return numbered.join(placed, "rn").drop("rn")
