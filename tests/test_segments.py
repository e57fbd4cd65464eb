"""Greedy cuts under two bounds against one pass over the rows."""
import random

import pytest
from pyspark.sql import functions as F

from sparkpack.operators.segments import cut_batches


def greedy(sizes, max_rows, max_size):
    out, batch, held, total = [], -1, 0, 0
    for s in sizes:
        s = s or 0
        if batch < 0 or held == max_rows or total + s > max_size:
            batch, held, total = batch + 1, 0, 0
        out.append((batch, held))
        held, total = held + 1, total + s
    return out


@pytest.mark.parametrize("max_rows, max_size, block_rows", [(20, 60, 1), (5, 33, 7), (3, 10**9, 5), (50, 40, 64), (4, 1, 9)])
def test_cuts_equal_one_pass(spark, max_rows, max_size, block_rows):
    rng = random.Random(max_rows)
    sizes = [rng.choice([0, 1, 2, 9, 30, None, 100 if rng.random() < 0.05 else 3]) for _ in range(611)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "k long, s long").repartition(5)
    got = cut_batches(df, [F.col("k")], F.col("s"), max_rows, max_size, block_rows).orderBy("k").collect()
    assert [(r.batch_no, r.pos) for r in got] == greedy(sizes, max_rows, max_size)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    got = cut_batches(spark.range(n), [F.col("id")], F.lit(5), 2, 100).orderBy("id").collect()
    assert [(r.batch_no, r.pos) for r in got] == greedy([5] * n, 2, 100)
