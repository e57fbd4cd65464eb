"""Framed log lines -> records. Order state is carried across slices of each source, never in one task."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpack.operators.scan import ranged_scan
from sparkpack.operators.stage import materialize

# fixed values of the frame format
START, END = "++++", "----"
LEVEL_PATTERN = "(trace|debug|info|warn(?:ing)?|error|fatal)"
NO_LEVEL_PREFIX = "!!Failed to extract level!! - "
DEFAULT_LEVEL = {"StdOut": "info", "StdErr": "warn"}


def framed(lines: DataFrame) -> DataFrame:
    """Each line with its marker kind, the number of markers so far, and the marker that governs it, as a stage table."""
    marker = F.when(F.col("line").startswith(START), "S").when(F.col("line").startswith(END), "E")
    return materialize(ranged_scan(
        lines.withColumn("marker", marker), ["source"], [F.col("line_no")],
        sums={"seg": F.when(F.col("marker").isNotNull(), 1).otherwise(0).cast("bigint")}, lasts={"state": F.col("marker")}))


def _segments(lines: DataFrame, texts: bool) -> DataFrame:
    """One row per stretch between two markers: its opening and closing marker and, inside frames, its lines."""
    inside = F.col("marker").isNull()
    role = F.struct(F.col("seg").alias("seg"), F.lit("line").alias("role"))
    roles = F.when(inside, F.array(role)).otherwise(F.array(
        F.struct(F.col("seg").alias("seg"), F.lit("open").alias("role")),
        F.struct((F.col("seg") - 1).alias("seg"), F.lit("close").alias("role"))))
    rows = lines.select("source", "line_no", "line", "marker", F.explode(roles).alias("r"))
    is_line, is_close = F.col("r.role") == "line", F.col("r.role") == "close"
    aggs = [
        F.max(F.when(F.col("r.role") == "open", F.col("marker"))).alias("opener"),
        F.max(F.when(is_close, F.col("marker"))).alias("closer"),
        F.max(F.when(is_close, F.col("line_no"))).alias("close_line"),
        F.count_if(is_line).alias("n_lines"),
    ]
    if texts:
        aggs += [F.min(F.when(is_line, F.col("line_no"))).alias("first_line"),
                 F.array_sort(F.collect_list(F.when(is_line, F.struct("line_no", "line")))).alias("texts")]
    return rows.groupBy("source", F.col("r.seg").alias("seg")).agg(*aggs)


def default_level():
    pairs = [F.lit(x) for kv in DEFAULT_LEVEL.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.col("source"))


def log_frames(lines: DataFrame) -> DataFrame:
    """Records: complete frames, lines outside any frame, and a frame still open at the end of a source."""
    marked = framed(lines)
    in_frame = F.coalesce(F.col("state") == "S", F.lit(False))
    loose = marked.filter(F.col("marker").isNull() & ~in_frame).select(
        "source", F.col("line_no").alias("first_line"), F.lit("loose").alias("kind"), F.col("line").alias("text"))
    frames = (
        _segments(marked.filter(in_frame | F.col("marker").isNotNull()), texts=True)
        .filter((F.col("opener") == "S") & (F.col("n_lines") > 0) & (F.col("closer").isNull() | (F.col("closer") == "E")))
        .select("source", "first_line", F.when(F.col("closer").isNull(), "open").otherwise("frame").alias("kind"),
                F.array_join(F.transform("texts", lambda t: t["line"]), "\n").alias("text"))
    )
    return frames.unionByName(loose)


def log_levels(records: DataFrame) -> DataFrame:
    """Level and cleaned text of each record."""
    word = F.regexp_extract("text", LEVEL_PATTERN, 1)
    found, is_frame = word != "", F.col("kind") == "frame"
    level = F.when(word == "warning", "warn").when(word == "fatal", "error").otherwise(word)
    cleaned = F.replace("text", F.concat(word, F.lit(":")), F.lit(""))
    return records.withColumns({
        "level": F.when(~is_frame, default_level()).when(found, level).otherwise("warn"),
        "text": F.when(~is_frame, F.col("text")).when(found, cleaned).otherwise(F.concat(F.lit(NO_LEVEL_PREFIX), F.col("text"))),
    })


def log_anomalies(lines: DataFrame) -> DataFrame:
    """Frames whose data was dropped, terminators without a start, and terminators without data."""
    seg = _segments(framed(lines), texts=False)
    started = F.coalesce(F.col("opener") == "S", F.lit(False))
    ends = F.col("closer") == "E"
    kinds = F.array_compact(F.array(
        F.when((F.col("closer") == "S") & started & (F.col("n_lines") > 0), "data dropped"),
        F.when(ends & ~started, "no start"),
        F.when(ends & (~started | (F.col("n_lines") == 0)), "no data"),
    ))
    return seg.filter("closer IS NOT NULL").select("source", F.col("close_line").alias("line_no"), F.explode(kinds).alias("kind"))
