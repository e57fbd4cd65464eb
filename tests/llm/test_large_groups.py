"""A large group of near copies: the edges passed on grow with its rows, and every pair of different labels is tested."""
import random

from sparkpack.llm import near_dedup as nd


def test_edges_of_near_copies_grow_with_their_number(spark, monkeypatch):
    n, made = 1200, spark.sparkContext.accumulator(0)
    for name in ("_agreeing", "_verified"):
        def counted(*a, plain=getattr(nd, name)):
            run = plain(*a)

            def go(batches):
                for out in run(batches):
                    made.add(out.num_rows)
                    yield out
            return go
        monkeypatch.setattr(nd, name, counted)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for d in range(n):
        text = list(words)
        text[d % 200] = f"x{d}"
        rows.append((d, " ".join(text)))
    rows += [(n + d, f"something else {d} altogether {d}") for d in range(50)]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == (0 if r.doc_id < n else r.doc_id) for r in got) and len(got) == n + 50
    assert made.value <= 2 * (nd.BANDS + 1) * n


def test_all_links_of_a_group_are_found(spark):
    rng = random.Random(5)
    rows = [(g, i.to_bytes(8, "big"), bytes(rng.randrange(3 + 4 * g) for _ in range(4))) for g in range(4) for i in range(100 * g, 100 * g + 20 + 20 * g)]
    rows += [(4, (1000 + i).to_bytes(8, "big"), b"same" if i % 10 else bytes(rng.randrange(200) for _ in range(4))) for i in range(60)]
    df = spark.createDataFrame(rows, "bucket long, fp binary, sig binary")
    labels = {bytes(r.node): bytes(r.label) for r in nd._linked(df, "bucket", "sig", nd._agreeing(4, 0.75), size=4).collect()}
    want = {fp: fp for _, fp, _ in rows}

    def top(x):
        while want[x] != x:
            x = want[x]
        return x
    for g, a, s in rows:
        for h, b, t in rows:
            if g == h and sum(x == y for x, y in zip(s, t)) >= 3:
                lo, hi = sorted([top(a), top(b)])
                want[hi] = lo
    assert all(labels.get(fp, fp) == top(fp) for fp in want)
