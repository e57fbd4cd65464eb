"""Line dedup over a suffix array of line ids: prefix doubling, LCP intervals, later copies of repeated runs deleted."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.llm.common import WORD, id_key, stage

#: A repeated run of lines is deleted from this many words on.
MIN_WORDS = 50


def _doc_keys(text: str, key: str) -> tuple[Column, Column, Column]:
    whole = F.coalesce(F.col(text), F.lit(""))
    return id_key(key), F.xxhash64(whole), F.xxhash64(F.lit(7), whole)


def line_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line with a word: document (id, t1, t2), line_no in the text, two hashes of the trimmed line, words.

    A document is its id and its text; repeated rows of both are one document.
    """
    doc_id, t1, t2 = _doc_keys(text, key)
    lines = docs.select(doc_id.alias("id"), t1.alias("t1"), t2.alias("t2"),
                        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "line"))
    line = F.trim(F.col("line"), F.lit(" \t\r\x0b\x0c"))
    lines = lines.withColumn("line", line).filter(F.col("line") != "")
    return lines.select("id", "t1", "t2", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
                        F.regexp_count("line", F.lit(WORD)).alias("words"))


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Number the lines of a document (pos) and find, per line, the shortest run of min_words from it on (ahead) and up to it (back)."""
    doc = ["id", "t1", "t2"]
    # one exchange serves the removal of repeated rows and all windows of a document
    lines = lines.repartition(*doc).dropDuplicates([*doc, "line_no"])
    order = Window.partitionBy(*doc).orderBy("line_no")
    # a line of min_words or more is a run by itself, so counts are capped there; the first line that reaches the
    # bound then lies less than 2 * min_words words away, which bounds the frames
    capped = F.least(F.col("words"), F.lit(min_words)).cast("long")
    lines = (lines.withColumn("w", capped).withColumn("pos", F.row_number().over(order).cast("long") - 1)
             .withColumn("upto", F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("before", F.col("upto") - F.col("w")))
    whole = Window.partitionBy(*doc)
    far = 2 * min_words - 1
    ahead = F.min("pos").over(Window.partitionBy(*doc).orderBy("before").rangeBetween(min_words, far))
    back = F.max("pos").over(Window.partitionBy(*doc).orderBy("upto").rangeBetween(-far, -min_words))
    lines = lines.withColumn("total", F.max("upto").over(whole)).withColumn("n", F.max("pos").over(whole) + 1)
    ahead = F.coalesce(ahead, F.when(F.col("total") - F.col("before") >= min_words, F.col("n")))
    back = F.coalesce(back + 1, F.when(F.col("upto") >= min_words, F.lit(0).cast("long")))
    return lines.withColumn("ahead", ahead - F.col("pos")).withColumn("back", F.col("pos") + 1 - back)


def suffix_ranks(lines: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, int]:
    """Ranks of all suffixes by their first 1, 2, 4 .. lines (columns r0, r1 ..) in lexicographic order of line ids.

    Prefix doubling: the rank by 2^(k+1) lines orders the pairs (rank of the suffix, rank of the suffix 2^k later) by 2^k
    lines. Only prefixes that two suffixes share get a rank; the others are null and drop out, so later
    rounds see repeated text only. A run of min_words words has at most min_words lines, so doubling stops there.
    Pairs are counted before they are shuffled, ranked by a range sort of the distinct ones and joined back.
    """
    doc = ["id", "t1", "t2"]
    rows = stage(_windows(lines, min_words))
    ranks = _rank(rows, ["h1", "h2"])
    rows = stage(rows.join(ranks, ["h1", "h2"]).withColumnRenamed("rank", "r0").drop("h1", "h2", "w", "upto", "before", "total", "n", "words"))
    k, step = 0, 1
    while step * 2 <= min_words:
        at = Window.partitionBy(*doc).orderBy("pos").rangeBetween(step, step)
        pairs = stage(rows.withColumn("x", F.col(f"r{k}")).withColumn("y", F.max(f"r{k}").over(at)))
        ranks = _rank(pairs.filter("x is not null and y is not null"), ["x", "y"])
        rows = stage(pairs.join(ranks, ["x", "y"], "left").withColumnRenamed("rank", f"r{k + 1}").drop("x", "y"))
        k, step = k + 1, step * 2
    return rows, k


def _rank(rows: DataFrame, by: list[str]) -> DataFrame:
    """Distinct values of `by` that two different suffixes share, with a rank that grows in their order."""
    shared = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(*by)
    ordered = shared.repartitionByRange(*by).sortWithinPartitions(*by)
    return stage(ordered.withColumn("rank", F.monotonically_increasing_id()))


def repeated_windows(rows: DataFrame, levels: int) -> DataFrame:
    """LCP intervals at the depth of min_words: suffixes agreeing on a run of that length, all but the first occurrence.

    A run of m lines is named by the ranks of its first and its last 2^k lines, k the largest with 2^k <= m: two
    runs of m lines with equal names are equal. Forward runs (from a line on) and backward runs (up to a line)
    together cover every repeated run of min_words or more. Returns the covered spans: document, first, past.
    """
    doc = ["id", "t1", "t2"]
    ahead = rows.filter("ahead is not null").select(*doc, F.col("pos").alias("first"), (F.col("pos") + F.col("ahead")).alias("past"))
    back = rows.filter("back is not null").select(*doc, (F.col("pos") + 1 - F.col("back")).alias("first"), (F.col("pos") + 1).alias("past"))
    spans = ahead.union(back).distinct().withColumn("m", F.col("past") - F.col("first"))
    level = F.lit(0)
    for k in range(1, levels + 1):
        level = F.when(F.col("m") >= 2**k, F.lit(k)).otherwise(level)
    spans = spans.withColumn("k", level).withColumn("tail", F.col("past") - F.expr("shiftleft(1, k)"))
    heads = rows.select(*doc, F.col("pos").alias("first"), F.array(*[f"r{k}" for k in range(levels + 1)]).alias("ra"))
    tails = rows.select(*doc, F.col("pos").alias("tail"), F.array(*[f"r{k}" for k in range(levels + 1)]).alias("rb"))
    named = (spans.join(heads, [*doc, "first"]).join(tails, [*doc, "tail"])
             .select(*doc, "first", "past", "m", F.get("ra", F.col("k")).alias("a"), F.get("rb", F.col("k")).alias("b"))
             .filter("a is not null and b is not null"))
    named = stage(named)
    place = F.struct("id", "t1", "t2", "first")
    firsts = stage(named.groupBy("m", "a", "b").agg(F.min(place).alias("origin"), F.max(place).alias("last")).filter("origin < last"))
    return named.join(firsts, ["m", "a", "b"]).filter(place > F.col("origin")).select(*doc, "first", "past")


def remove_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Delete the later copies of every run of whole lines that repeats and has at least min_words words.

    Copies are ordered by (id, place); the first stays, and a run may repeat inside one document. Lines are compared
    without blanks at their ends; lines without words belong to no run and stay, as do shorter runs. Adds
    n_lines (lines with words) and n_removed_lines. Null text stays null, null ids count as smaller than
    all others, rows that repeat id and text are one document and change alike. Text that loses nothing is
    unchanged byte for byte; other columns are carried along (n_lines and n_removed_lines are replaced).
    """
    doc = ["id", "t1", "t2"]
    lines = line_table(docs, key, text)
    rows, levels = suffix_ranks(lines, min_words)
    spans = repeated_windows(rows, levels).distinct()
    gone = spans.select(*doc, F.explode(F.sequence("first", F.col("past") - 1)).alias("pos")).distinct()
    gone = gone.join(rows.select(*doc, "pos", "line_no"), [*doc, "pos"])
    drops = stage(gone.groupBy(*doc).agg(F.sort_array(F.collect_set("line_no")).alias("_gone")))
    drops = drops.select(F.col("id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "_gone")
    doc_id, t1, t2 = _doc_keys(text, key)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines")]
    out = docs.select(*names).withColumns({"_i": doc_id, "_a": t1, "_b": t2})
    out = out.join(drops.hint("shuffle_hash"), (F.col("_i") == F.col("_id")) & (F.col("_a") == F.col("_t1")) & (F.col("_b") == F.col("_t2")), "left")
    parts = F.split(F.col(text), "\n")
    left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    n_lines = F.size(F.filter(parts, lambda x: F.trim(x, F.lit(" \t\r\x0b\x0c")) != ""))
    out = out.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(n_lines).cast("long"))
    out = out.withColumn("n_removed_lines", F.coalesce(F.size("_gone"), F.lit(0)).cast("long"))
    out = out.withColumn("n_removed_lines", F.when(F.col("_gone").isNull(), F.lit(0).cast("long")).otherwise(F.col("n_removed_lines")))
    out = out.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(left))
    return out.select(*names, "n_lines", "n_removed_lines")
