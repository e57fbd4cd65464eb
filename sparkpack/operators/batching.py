"""Batches of ordered records: by count, bytes, deadline, predicate and flush commands.

Count, island, predicate and flush batches are running sums. Batches bounded by bytes or deadlines depend on
where the previous batch ended; they are still computed in parallel for one hot key:

1. the order of each key is cut into blocks of bounded cost, and the tail of a block that may still be
   buffered is repeated in the next one;
2. each block computes, for every buffer it may inherit, the buffer it leaves behind (few distinct answers);
3. the answers are chained per key -- a handful of numbers per block, not rows, and in groups if there are many;
4. each block replays its records from its one true starting buffer.
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpack.operators.fold import NEVER, BatchRule, Stretch
from sparkpack.operators.scan import RANGE, deal_ranges, ordered_scan, ranged_row_numbers, ranged_scan, row_numbers, spread, time_slice
from sparkpack.operators.stage import materialize

ORDER = ["deadline_ts", "arrival_ts", "source_id"]
KEYS = ["stream_name", "shard_no"]
#: Blocks one task follows from first to last.
CHAIN = 4096


def _order(order: list[str]) -> list[Column]:
    return [F.col(c) for c in order]


def batch_by_count(records: DataFrame, size: int, slice_ms: int, keys: list[str] = KEYS, order: list[str] = ORDER) -> DataFrame:
    """Batches of `size` records in deadline order."""
    numbered = row_numbers(records, keys, time_slice(F.col(order[0]), slice_ms), _order(order))
    return numbered.withColumns({
        "batch_no": F.floor((F.col("rn") - 1) / size).cast("bigint"), "pos": ((F.col("rn") - 1) % size).cast("bigint")}).drop("rn")


def batch_islands(records: DataFrame, gap_ms: int, keys: list[str] = KEYS) -> DataFrame:
    """Number the stretches separated by more than `gap_ms` without an arrival; no buffer survives such a gap."""
    order = [F.col("arrival_ts"), F.col("source_id")]
    lagged = ordered_scan(deal_ranges(records, keys, order), keys, F.col(RANGE), order, lags={"_prev": F.col("arrival_ts")})
    opens = F.when(F.unix_micros("arrival_ts") - F.unix_micros("_prev") > gap_ms * 1000, 1).otherwise(0).cast("bigint")
    return ordered_scan(materialize(lagged), keys, F.col(RANGE), order, sums={"island": opens}).drop("_prev", RANGE)


def batch_predicate(records: DataFrame, flush: Column, slice_ms: int, keys: list[str] = KEYS, order: list[str] = ORDER) -> DataFrame:
    """A record for which `flush` holds is the last of its batch."""
    flag = F.when(F.coalesce(flush, F.lit(False)), 1).otherwise(0).cast("bigint")
    marked = ordered_scan(records.withColumn("_flag", flag), keys, time_slice(F.col(order[0]), slice_ms), _order(order),
                          sums={"_ended": F.col("_flag")})
    return marked.withColumn("batch_no", F.col("_ended") - F.col("_flag")).drop("_ended", "_flag")


def _seen_commands(records: DataFrame, commands: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add the number of commands of the record's key at or before its arrival."""
    rows = records.withColumns({"_at": F.col("arrival_ts"), "_mark": F.lit(0).cast("bigint")})
    marks = commands.select(*keys, F.col("flush_ts").alias("_at"), F.lit(1).cast("bigint").alias("_mark"))
    order = [F.col("_at"), F.lit(1) - F.col("_mark"), F.coalesce("source_id", F.lit(-1))]
    out = ranged_scan(rows.unionByName(marks, allowMissingColumns=True), keys, order, sums={name: F.col("_mark")})
    return out.filter("_mark = 0").drop("_at", "_mark")


def flush_all(records: DataFrame, controls: DataFrame) -> DataFrame:
    """Number of flush commands each record has seen before it arrived; a command without a stream reaches all.

    A command at the time of an arrival comes first. Commands of a stream are repeated for the stream's shards;
    commands to everybody are counted in a scan of their own, over time only.
    """
    shards = records.select(*KEYS).distinct()
    of_stream = controls.filter("stream_name IS NOT NULL").join(shards, "stream_name")
    own = _seen_commands(records, of_stream, KEYS, "_own")
    both = _seen_commands(own, controls.filter("stream_name IS NULL"), [], "_all")
    return both.withColumn("flush_no", F.col("_own") + F.col("_all")).drop("_own", "_all")


# -- ordered folds --------------------------------------------------------------------------------------

_STATE = "rn long, n_total long, size long, arrival_us long, deadline_us long, flag boolean, pk string, ehk string, burst_key long"


def _blocks(records: DataFrame, keys: list[str], order: list[str], rule: BatchRule, size: Column, flag: Column | None,
            burst_key: Column | None, slice_ms: int, block_cost: int, block_ms: int, buffered_ms: int, id_col: str) -> DataFrame:
    """Slim rows with their global order, cut into blocks; rows that may still be buffered later are repeated."""
    deadline = F.unix_micros("deadline_ts") if rule.use_deadline else F.lit(NEVER)
    slim = records.select(
        *keys, *[F.col(c).alias(f"_o_{c}") for c in order], F.col(id_col).alias("id"),
        size.cast("bigint").alias("size"), F.unix_micros("arrival_ts").alias("arrival_us"), deadline.alias("deadline_us"),
        F.coalesce(flag, F.lit(False)).alias("flag") if flag is not None else F.lit(False).alias("flag"),
        *([F.col("partition_key").alias("pk"), F.col("explicit_hash_key").alias("ehk")] if rule.packed
          else [F.lit(None).cast("string").alias("pk"), F.lit(None).cast("string").alias("ehk")]),
        (burst_key if burst_key is not None else F.lit(-1)).cast("bigint").alias("burst_key"),
    )
    by_size = rule.size_limit != NEVER
    cost = F.least(F.col("size"), F.lit(rule.size_limit)) + F.lit(5 if rule.packed else 0) if by_size else F.lit(0)
    scanned = ordered_scan(
        slim, keys, time_slice(F.col(f"_o_{order[0]}"), slice_ms), [F.col(f"_o_{c}") for c in order],
        sums={"rn": F.lit(1).cast("bigint"), "_cost": cost.cast("bigint")}, totals={"n_total": F.lit(1).cast("bigint")})
    if by_size:
        start, width = F.col("_cost") - cost, max(block_cost, 4 * rule.size_limit)
        last = start + 2 * rule.size_limit + 5
    else:
        start, width = F.col("deadline_us"), max(block_ms, 4 * buffered_ms) * 1000
        last = start + buffered_ms * 1000
    block = lambda p: F.floor(p / F.lit(width)).cast("bigint")
    return (
        scanned.withColumn("_own", block(start))
        .withColumn("_block", F.explode(F.sequence(F.col("_own"), block(last))))
        .select(*keys, "_block", (F.col("_own") == F.col("_block")).alias("own"), "id", *[f.split()[0] for f in _STATE.split(", ")]),
        None if by_size else width, buffered_ms * 1000,
    )


def _stretch(pdf: pd.DataFrame, rule: BatchRule, width: int | None, buffered_us: int):
    """Sorted rows of one block, the number of repeated rows, and the time up to which timers may fire."""
    pdf = pdf.sort_values("rn", ignore_index=True)
    own = int((~pdf["own"]).sum())
    last = bool(pdf["rn"].iloc[-1] == pdf["n_total"].iloc[-1])
    if width is None:
        until = NEVER if last else -NEVER      # nothing but later records can flush a buffer inside the order
        skip = own == len(pdf)                 # past the end of the key
    else:
        until = (int(pdf["_block"].iloc[0]) + 1) * width - buffered_us
        skip = False
    return pdf, Stretch(pdf, rule), own, until, skip


def _transitions(keys: list[str], rule: BatchRule, width: int | None, buffered_us: int):
    """Per block: buffer start it may inherit -> buffer start it leaves, as breakpoints of a step function."""
    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, st, own, until, skip = _stretch(pdf, rule, width, buffered_us)
        if skip:
            return pd.DataFrame(columns=[*keys, "_block", "starts", "leaves"])
        base, memo, starts, leaves = int(pdf["rn"].iloc[0]), {}, [], []
        for s in st.inheritable(own):
            out = base + st.run(s, own, st.n, until, memo)
            if not leaves or leaves[-1] != out:
                starts.append(base + s)
                leaves.append(out)
        return pd.DataFrame([[*key, starts, leaves]], columns=[*keys, "_block", "starts", "leaves"])
    return fn


def _follow(entry: int, starts, leaves) -> int:
    """The buffer start a step function makes of the one it is entered with."""
    at = max(i for i, x in enumerate(starts) if x <= max(entry, starts[0]))
    return int(leaves[at])


def _chain(keys: list[str]):
    """Follow the step functions of consecutive blocks from the buffer start the first one is entered with (its own first, if null)."""
    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block", ignore_index=True)
        first = pdf["_entry"].iloc[0]
        entry, rows = int(pdf["starts"].iloc[0][0] if pd.isna(first) else first), []
        for block, starts, leaves in zip(pdf["_block"], pdf["starts"], pdf["leaves"]):
            rows.append([*key[: len(keys)], block, entry])
            entry = _follow(entry, starts, leaves)
        return pd.DataFrame(rows, columns=[*keys, "_block", "entry"])
    return fn


def _through(keys: list[str]):
    """One step function for a group of consecutive blocks."""
    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block", ignore_index=True)
        starts, leaves = [], []
        for s in pdf["starts"].iloc[0]:
            entry = int(s)
            for own, out in zip(pdf["starts"], pdf["leaves"]):
                entry = _follow(entry, own, out)
            if not leaves or leaves[-1] != entry:
                starts.append(int(s))
                leaves.append(entry)
        return pd.DataFrame([[*key, starts, leaves]], columns=[*keys, "_group", "starts", "leaves"])
    return fn


def _entries(maps: DataFrame, keys: list[str], key_ddl: str) -> DataFrame:
    """The buffer start every block is entered with: (keys, _block, entry).

    A key with more than CHAIN blocks is chained in groups: each group becomes one step function, the groups are chained the
    same way, and each group is followed from its entry. So a task follows CHAIN blocks whatever share of the rows a key holds.
    """
    maps = materialize(maps)
    most = maps.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    chained = f"{key_ddl}, _block long, entry long"
    if most <= CHAIN:
        return maps.withColumn("_entry", F.lit(None).cast("bigint")).groupBy(*keys).applyInPandas(_chain(keys), chained)
    numbered = ranged_row_numbers(maps, keys, [F.col("_block")], "_no")
    numbered = materialize(numbered.withColumn("_group", F.floor(F.col("_no") / CHAIN).cast("bigint")).drop("_no"))
    by = [*keys, "_group"]
    groups = numbered.groupBy(*by).applyInPandas(_through(keys), f"{key_ddl}, _group long, starts array<long>, leaves array<long>")
    entered = _entries(groups.withColumnRenamed("_group", "_block"), keys, key_ddl)
    entered = entered.withColumnRenamed("_block", "_group").withColumnRenamed("entry", "_entry")
    return numbered.join(entered, by).groupBy(*by).applyInPandas(_chain(keys), chained)


def _replay(keys: list[str], rule: BatchRule, width: int | None, buffered_us: int):
    """Flush a block's records from its true starting buffer; records still buffered belong to the next block."""
    columns = [*keys, "id", "rn", "batch_rn", "pos", "flush_us", "reason"]

    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        entry = int(pdf["entry"].iloc[0])
        pdf, st, own, until, skip = _stretch(pdf, rule, width, buffered_us)
        if skip:
            return pd.DataFrame(columns=columns)
        base, flushes = int(pdf["rn"].iloc[0]), []
        s = st.run(max(entry - base, 0), own, st.n, until, None, flushes)
        if width is None and until == NEVER and s < st.n:        # no timers: the end of the key flushes
            while s < st.n:
                e = st.prefix(s, st.n)
                flushes.append((s, e, None, "end"))
                s = e
        if not flushes:
            return pd.DataFrame(columns=columns)
        first, stop = flushes[0][0], flushes[-1][1]
        lengths = [e - b for b, e, _, _ in flushes]
        begin = pd.Series([b for b, _, _, _ in flushes]).repeat(lengths).to_numpy()
        out = pdf.loc[first:stop - 1, [*keys, "id", "rn"]].reset_index(drop=True)
        out["batch_rn"] = base + begin
        out["pos"] = out["rn"] - out["batch_rn"]
        out["flush_us"] = pd.Series([w for _, _, w, _ in flushes], dtype="Int64").repeat(lengths).to_numpy()
        out["reason"] = pd.Series([r for _, _, _, r in flushes]).repeat(lengths).to_numpy()
        return out[columns]
    return fn


def fold_batches(
    records: DataFrame, rule: BatchRule, *, size: Column, keys: list[str] = KEYS, order: list[str] = ORDER,
    flag: Column | None = None, burst_key: Column | None = None, id_col: str = "source_id",
    slice_ms: int, block_cost: int, block_ms: int, buffered_ms: int,
) -> DataFrame:
    """Assign every record to a batch: (keys, id, rn, batch_rn, pos, flush_us, reason).

    `batch_rn` is the key-wide row number of the batch's first record and names the batch. Payloads do not pass
    through here; join the result to them by id.
    """
    rows, width, buffered_us = _blocks(records, keys, order, rule, size, flag, burst_key, slice_ms, block_cost, block_ms, buffered_ms, id_col)
    by = keys + ["_block"]
    rows = spread(rows, *by)
    types = dict(records.dtypes)
    key_ddl = ", ".join(f"{k} {types[k]}" for k in keys)
    maps = rows.groupBy(*by).applyInPandas(
        _transitions(keys, rule, width, buffered_us), f"{key_ddl}, _block long, starts array<long>, leaves array<long>")
    entries = _entries(maps, keys, key_ddl)
    return rows.join(entries, by).groupBy(*by).applyInPandas(
        _replay(keys, rule, width, buffered_us),
        f"{key_ddl}, id {types[id_col]}, rn long, batch_rn long, pos long, flush_us long, reason string")
