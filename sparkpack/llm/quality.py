"""Quality rules: a threshold table compiled into one projection of built-in functions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of English, French, Spanish and German.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "are", "as", "with", "be", "by", "this", "or", "an", "at",
    "le", "la", "les", "de", "des", "et", "un", "une", "en", "que", "pour", "dans", "est", "sur", "pas", "par", "du", "qui",
    "el", "los", "las", "del", "y", "se", "con", "una", "por", "no", "al", "es", "lo", "su",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "ein", "ist", "im", "dem", "nicht", "auf", "für", "des", "eine",
]

#: (metric, least, most): a document is kept if every metric that is defined lies between its bounds.
THRESHOLDS: list[tuple[str, float | None, float | None]] = [
    ("n_words", 50, None),
    ("mean_word_chars", 2.0, 12.0),
    ("symbols_per_word", None, 0.1),
    ("stop_word_ratio", 0.06, None),
    ("dup_line_ratio", None, 0.3),
    ("repeat_word_ratio", None, 0.5),
    ("shout_ratio", None, 0.5),
]

_GAP = r"[\x20\x09-\x0D]+"


def _metrics(words: Column, text: Column) -> dict[str, Column]:
    n = F.size(words).cast("long")
    joined = F.array_join(words, "")
    chars = F.char_length(joined).cast("long")
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(" \t\r\x0b\x0c")) != "")
    n_lines = F.size(lines).cast("long")
    dup_lines = n_lines - F.size(F.array_distinct(lines))
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols.cast("long"), "n_lines": n_lines,
            "n_dup_lines": dup_lines.cast("long"), "n_repeat_words": F.col("_repeat")}


def _repeat_words(docs: DataFrame) -> DataFrame:
    """Add `_repeat`: words inside a 3-word window that occurs twice or more in `_words`.

    Only documents with an equal pair of hashed windows sort them with their places and compare neighbours. What a lambda looks up by index is a
    column of its own: an expression inside a lambda would be evaluated again for every element.
    """
    words = F.col("_words")
    at = F.when(F.size(words) > 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    docs = docs.withColumn("_hashes", F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    unlike = F.size(F.array_distinct("_hashes")) == F.size("_hashes")
    placed = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    docs = docs.withColumn("_windows", F.when(~unlike, F.sort_array(placed)))
    by_hash = F.col("_windows")
    again = F.filter(by_hash, lambda w, k: ((k > 0) & (F.get(by_hash, k - 1)["h"] == w["h"])) | (F.get(by_hash, k + 1)["h"] == w["h"]))
    places = F.sort_array(F.transform(again, lambda w: w["p"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum"))
    covered = F.aggregate(places, start, lambda acc, p: F.struct(
        p.alias("last"), (acc["sum"] + F.least(F.lit(3), p - acc["last"])).alias("sum")), lambda acc: acc["sum"])
    return docs.withColumn("_repeat", F.coalesce(covered, F.lit(0).cast("long"))).drop("_windows", "_hashes")


def quality_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the metrics as columns `_q_...`; null text counts as empty.

    Words are runs of anything but blanks; a line counts if it has a word. Each metric is a built-in expression
    over the one row, so a document's cost depends on its own length only and nothing is shuffled.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, _GAP), lambda w: w != "")
    docs = _repeat_words(docs.withColumn("_words", words))
    found = _metrics(F.col("_words"), whole) | _word_counts(F.col("_words"))
    # the row number keeps a later filter above this projection: pushed below, it would evaluate the metrics again and
    # again, inside their own lambdas too
    found["row"] = F.monotonically_increasing_id()
    return docs.withColumns({f"_q_{k}": c for k, c in found.items()}).drop("_words", "_repeat")


def _word_counts(words: Column) -> dict[str, Column]:
    stop = list(dict.fromkeys(STOP_WORDS))
    is_stop = lambda w: (F.octet_length(w) <= 8) & F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(stop)
    return {"n_stop": F.size(F.filter(words, is_stop)).cast("long"),
            "n_shout": F.size(F.filter(words, lambda w: F.endswith(w, F.lit("!!")))).cast("long")}


def _ratio(metric: str, q: dict[str, Column]) -> Column:
    per_word = lambda c: F.when(q["n_words"] > 0, c / q["n_words"])
    return {
        "n_words": q["n_words"].cast("double"),
        "mean_word_chars": per_word(q["word_chars"]),
        "symbols_per_word": per_word(q["n_symbols"]),
        "stop_word_ratio": per_word(q["n_stop"]),
        "dup_line_ratio": F.when(q["n_lines"] > 0, q["n_dup_lines"] / q["n_lines"]),
        "repeat_word_ratio": per_word(q["n_repeat_words"]),
        "shout_ratio": per_word(q["n_shout"]),
    }[metric]


def verdict(q: dict[str, Column], thresholds: list[tuple[str, float | None, float | None]] = THRESHOLDS) -> Column:
    """The table as one boolean expression; an undefined metric (no words, no lines) breaks no rule."""
    rules = [r for name, least, most in thresholds for r in
             ([_ratio(name, q) >= least] if least is not None else []) + ([_ratio(name, q) <= most] if most is not None else [])]
    out = F.lit(True)
    for rule in rules:
        out = out & F.coalesce(rule, F.lit(True))
    return out


def apply_quality_rules(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    base_failed: under 50 words, or over half of them in repeated 3-word windows. kept: not base_failed, and the
    table's verdict. Null and empty texts have no words and fail the base. Added columns replace columns of the
    same name.
    """
    out = quality_metrics(docs, text)
    q = {c.removeprefix("_q_"): F.col(c) for c in out.columns if c.startswith("_q_")}
    failed = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    shown = {k: q[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    out = out.withColumns(shown | {"base_failed": failed, "kept": ~failed & verdict(q, thresholds) & (q["row"] >= 0)})
    return out.drop(*[f"_q_{k}" for k in q])
