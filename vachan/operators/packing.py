"""C1 without one task per recording: exact greedy packing of a recording
whose words span many partitions (a hot recording).

The greedy rule makes every chunk start depend on the previous one, so the
work is split where that dependency is small:

1. words are range-partitioned on ``(key, order)``; a *piece* is the part of
   one recording inside one partition;
2. per piece (Spark aggregate): row count and latest start; a piece that is
   not its recording's first is *continuing*, one that is not its last is
   *continued* — at most one of each per partition boundary, so this flag
   table has at most ``partitions + recordings`` rows and the continuing /
   continued subset at most ``2 * partitions`` rows (broadcast);
3. per continuing piece (Arrow kernel): a *summary*, the map from the start of
   the chunk that is open before the piece to the start of the one that is
   open after it.  The first boundary inside the piece for an open chunk that
   started at ``s`` is the first word with ``end - s > max_dur``, and that is
   a record of the running maximum of ends; so the map is a step function
   over those records.  Steps with the same outcome are merged.  A continued
   piece that is its recording's first has a constant summary;
4. summaries are composed in a tree of FAN_IN pieces per task and level, and
   entry states run back down it.  A composed summary has steps only for words
   within ``max_dur`` of its first, however many pieces it covers, so no
   task holds more than FAN_IN times the words of one chunk;
5. per piece (Arrow kernel, batch by batch with carried state): words are
   assigned to chunks (a chunk is named by its first word); chunks are grouped
   by that name, and numbered per recording with the distributed index of
   ``sampling.with_group_index``.

Every comparison is ``end - start > max_dur`` in doubles, as in the fold
(``chunking.pack_words``); subtraction is monotone, so searching for the first
such word is exact.  Blank words are dropped first (the greedy rule skips
them); a recording with a NULL word text or time is left out (see
``chunking.chunk_rejects``).
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vachan.functions import text as TX
from vachan.session import cut_lineage

FAN_IN = 16

STATE = "struct<pid:long,local:long,start:double>"  # names a chunk by its first word


def _first_beyond(ends: list, start: float, max_dur: float) -> int:
    """Index of the first of ascending ``ends`` with ``end - start > max_dur``."""
    return bisect.bisect_left(ends, True, key=lambda e: e - start > max_dur)


def _chain_exits(s: np.ndarray, e: np.ndarray, max_dur: float) -> np.ndarray:
    """For every word of a piece: the last chunk start inside the piece if a
    chunk starts at that word.  One pass from the back; ``far`` holds the words
    that can still be the first beyond some start, their ends ascending
    towards the back of the list being the nearest word's."""
    n = len(s)
    exits = np.arange(n, dtype=np.int64)
    far: list[int] = []          # nearest word last, ends descending from first to last
    for j in range(n - 1, -1, -1):
        # words whose end is beyond: a prefix of ``far``; its last entry is the nearest of them
        k = bisect.bisect_left(far, True, key=lambda w: not e[w] - s[j] > max_dur)
        if k:
            exits[j] = exits[far[k - 1]]
        while far and e[far[-1]] <= e[j]:
            far.pop()
        far.append(j)
    return exits


def _merged(ends: list, states: list) -> tuple[list, list]:
    """Drop a step whose successor has the same outcome."""
    keep = [i for i in range(len(states)) if i + 1 == len(states) or states[i] != states[i + 1]]
    return [ends[i] for i in keep], [states[i] for i in keep]


def piece_summary(s: np.ndarray, e: np.ndarray, names: list[tuple], before: float, max_dur: float) -> tuple[list, list]:
    """Steps (end, state after the piece) for chunks that are open before it;
    none of those starts after ``before``."""
    exits = _chain_exits(s, e, max_dur)
    top = np.maximum.accumulate(e)
    records = np.flatnonzero(np.concatenate([[True], top[1:] > top[:-1]]))
    last = np.flatnonzero(top[records] - before > max_dur)   # beyond it every open chunk has ended
    records = records[:last[0] + 1] if len(last) else records
    return _merged([float(top[r]) for r in records], [names[exits[r]] for r in records])


def advance(state: tuple | None, steps: tuple[list, list], max_dur: float) -> tuple | None:
    """State after a piece, from the state before it."""
    if state is None:
        return None
    i = _first_beyond(steps[0], state[2], max_dur)
    return steps[1][i] if i < len(steps[0]) else state


def compose(parts: list[tuple[list, list]], before: float, max_dur: float) -> tuple[list, list]:
    """Summary of consecutive pieces."""
    ends, states, top = [], [], -np.inf
    for i, (e, st) in enumerate(parts):
        for end, state in zip(e, st, strict=True):
            if end <= top:
                continue
            for later in parts[i + 1:]:
                state = advance(state, later, max_dur)
            ends.append(end)
            states.append(state)
            top = end
            if end - before > max_dur:
                return _merged(ends, states)
    return _merged(ends, states)


def _runs(batches: Iterator[pd.DataFrame], key: str):
    """(key, pid, first of its piece, rows) for each run of a piece inside a batch."""
    last = None
    for pdf in batches:
        if not len(pdf):
            continue
        keys, pids = pdf[key].to_numpy(), pdf["__pid"].to_numpy()
        cut = np.flatnonzero((keys[1:] != keys[:-1]) | (pids[1:] != pids[:-1])) + 1
        for a, b in zip([0, *cut], [*cut, len(pdf)], strict=True):
            name = (keys[a], int(pids[a]))
            yield *name, name != last, pdf.iloc[a:b]
            last = name


def _summaries(key: str, max_dur: float):
    """Times of one piece at a time (a piece is inside one partition)."""
    columns = [key, "pid", "cont", "before", "ends", "states"]

    def row(k, pid, parts):
        s, e, local = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("start", "end", "__local"))
        names = [(pid, int(i), float(x)) for i, x in zip(local, s, strict=True)]
        cont, before = bool(parts[0]["__cont"].iloc[0]), parts[0]["__s_before"].iloc[0]
        if cont:
            ends, states = piece_summary(s.astype(float), e.astype(float), names, float(before), max_dur)
        else:
            ends, states = [], [names[_chain_exits(s.astype(float), e.astype(float), max_dur)[0]]]
        return k, pid, cont, float(before) if cont else None, ends, [dict(zip(("pid", "local", "start"), x, strict=True)) for x in states]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, name = [], None
        for k, pid, new, rows in _runs(batches, key):
            if new and held:
                yield pd.DataFrame([row(*name, held)], columns=columns)
                held = []
            name = (k, pid)
            if rows["__cont"].iloc[0] or rows["__contd"].iloc[0]:
                held.append(rows[["start", "end", "__local", "__cont", "__s_before"]])
        if held:
            yield pd.DataFrame([row(*name, held)], columns=columns)
    return run


def _steps(ends, states) -> tuple[list, list]:
    return list(ends), [(int(x["pid"]), int(x["local"]), float(x["start"])) for x in states]


def _compose_group(key: str, max_dur: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pid")
        first = pdf.iloc[0]
        parts = [_steps(r.ends, r.states) for r in pdf.itertuples()]
        if first["cont"]:
            ends, states = compose(parts, float(first["before"]), max_dur)
        else:   # starts with its recording's first piece: one outcome
            state = parts[0][1][0]
            for p in parts[1:]:
                state = advance(state, p, max_dur)
            ends, states = [], [state]
        out = [dict(zip(("pid", "local", "start"), x, strict=True)) for x in states]
        return pd.DataFrame([(first[key], int(first["block"]), bool(first["cont"]), first["before"], ends, out)],
                            columns=[key, "pid", "cont", "before", "ends", "states"])
    return run


def _entries_group(key: str, max_dur: float):
    """Entry states of a block's parts, from the block's own entry state (carried
    on every row; NULL where the block starts its recording)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pid")
        name, entry, out = pdf[key].iloc[0], pdf["entry"].iloc[0], []
        state = None if entry is None else (int(entry["pid"]), int(entry["local"]), float(entry["start"]))
        for r in pdf.itertuples():
            if state is not None:
                out.append((name, int(r.pid), dict(zip(("pid", "local", "start"), state, strict=True))))
            steps = _steps(r.ends, r.states)
            state = advance(state, steps, max_dur) if r.cont else steps[1][0]
        return pd.DataFrame(out, columns=[key, "pid", "entry"])
    return run


def entry_states(summaries: DataFrame, key: str, key_type: str, n_parts: int, max_dur: float) -> DataFrame:
    """``(key, pid, entry)`` of every continuing piece: up the tree and down again."""
    one = f"{key} {key_type}, pid long, cont boolean, before double, ends array<double>, states array<{STATE}>"
    down = f"{key} {key_type}, pid long, entry {STATE}"
    levels, width = [cut_lineage(summaries)], n_parts
    while width > FAN_IN:
        up = levels[-1].withColumn("block", F.floor(F.col("pid") / FAN_IN).cast("long"))
        levels.append(cut_lineage(up.groupBy(key, "block").applyInPandas(_compose_group(key, max_dur), one)))
        width = -(-width // FAN_IN)
    above = None
    for level in reversed(levels):
        rows = level.withColumn("block", F.floor(F.col("pid") / FAN_IN).cast("long") if above is not None else F.lit(0).cast("long"))
        if above is None:
            rows = rows.withColumn("entry", F.lit(None).cast(STATE))
        else:
            rows = rows.join(above.select(key, F.col("pid").alias("block"), "entry"), [key, "block"], "left")
        above = rows.groupBy(key, "block").applyInPandas(_entries_group(key, max_dur), down)
    return above


def _assign(key: str, max_dur: float):
    """Name the chunk of every word, batch by batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for _, pid, new, rows in _runs(batches, key):
            if new:
                state = tuple(rows[c].iloc[0] for c in ("__e_pid", "__e_local", "__e_s")) if rows["__cont"].iloc[0] else None
            s, e, local = rows["start"].tolist(), rows["end"].tolist(), rows["__local"].tolist()
            named = []
            for i in range(len(s)):
                if state is None or e[i] - state[2] > max_dur:
                    state = (pid, local[i], s[i])
                named.append(state[:2])
            out = rows[[key, "word", "start", "end"]].copy()
            out["chunk_pid"], out["chunk_local"] = (np.array(c, dtype=np.int64) for c in zip(*named, strict=True))
            out["pid"], out["local"] = pid, rows["__local"]
            yield out[[key, "chunk_pid", "chunk_local", "pid", "local", "word", "start", "end"]]
    return run


def pack_rows(rows: DataFrame, key: str, order_cols: list[str], max_dur: float = 29.0, min_dur: float = 0.5,
              partitions: int | None = None) -> DataFrame:
    """C1 over timed-word rows ``(key, *order_cols, word, start, end)``:
    ``(key, chunk_id, text, start, end)``, identical to ``chunk_recordings``
    on the ordered word arrays.  ``order_cols`` must be unique per key."""
    from vachan.operators.sampling import with_group_index

    spark = rows.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bad = rows.where(F.col("word").isNull() | F.col("start").isNull() | F.col("end").isNull()).select(key).distinct()
    ok = rows.join(bad, key, "left_anti")
    blank = F.regexp_replace("word", "^" + TX.WS + "+|" + TX.WS + "+$", "") == ""
    ok = ok.where(~blank).select(key, *order_cols, "word", F.col("start").cast("double").alias("start"),
                                 F.col("end").cast("double").alias("end"))
    ranged = (ok.repartitionByRange(n_parts, key, *order_cols).sortWithinPartitions(key, *order_cols)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__local", F.monotonically_increasing_id() - (F.col("__pid").cast("long") * (1 << 33))))
    # Range bounds are drawn from a sample seeded per execution and three
    # branches read these ids: they are written once, and the kernels get
    # every piece whole again by hashing on the stored partition number.
    ranged = cut_lineage(ranged)
    by_pid = ranged.repartition(n_parts, "__pid").sortWithinPartitions("__pid", key, *order_cols)

    # 2. pieces: continuing / continued flags and the latest start before a piece
    pieces = ranged.groupBy(key, "__pid").agg(F.max("start").alias("__ms"))
    w = Window.partitionBy(key).orderBy("__pid")
    pieces = (pieces.withColumn("__cont", F.lag("__pid").over(w).isNotNull())
                    .withColumn("__contd", F.lead("__pid").over(w).isNotNull())
                    .withColumn("__s_before", F.max("__ms").over(w.rowsBetween(Window.unboundedPreceding, -1)))
                    .where(F.col("__cont") | F.col("__contd"))
                    .select(key, "__pid", "__cont", "__contd", "__s_before"))
    tagged = (by_pid.join(F.broadcast(pieces), [key, "__pid"], "left")
                    .fillna(False, subset=["__cont", "__contd"]))

    # 3. summaries of continuing / continued pieces
    key_type = rows.schema[key].dataType.simpleString()
    summ = tagged.where("__cont OR __contd").mapInPandas(
        _summaries(key, max_dur), f"{key} {key_type}, pid long, cont boolean, before double, ends array<double>, states array<{STATE}>")

    # 4. entry state of every continuing piece
    entries = entry_states(summ, key, key_type, n_parts, max_dur).select(
        key, F.col("pid").cast("int").alias("__pid"), F.col("entry.pid").alias("__e_pid"),
        F.col("entry.local").alias("__e_local"), F.col("entry.start").alias("__e_s"))

    # 5. assign words to chunks, group chunks, number them per recording
    final_in = (by_pid.join(F.broadcast(entries.withColumn("__cont", F.lit(True))), [key, "__pid"], "left")
                      .fillna(False, subset=["__cont"]))
    assigned = final_in.mapInPandas(_assign(key, max_dur),
                                    f"{key} {key_type}, chunk_pid long, chunk_local long, pid long, local long, "
                                    "word string, start double, end double")
    chunks = (assigned.groupBy(key, "chunk_pid", "chunk_local")
                      .agg(F.array_sort(F.collect_list(F.struct("pid", "local", "word", "start", "end"))).alias("w")))
    chunks = chunks.select(key, "chunk_pid", "chunk_local",
                           F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("raw"),
                           F.element_at("w", 1)["start"].alias("start"), F.element_at("w", -1)["end"].alias("end"))
    kept = chunks.where(((F.col("end") - F.col("start")) >= min_dur) &
                        (F.regexp_replace("raw", "^" + TX.WS + "+|" + TX.WS + "+$", "") != ""))
    numbered = with_group_index(kept, [key], ["chunk_pid", "chunk_local"], "chunk_id", materialize=True)
    return numbered.select(key, F.col("chunk_id").cast("int").alias("chunk_id"),
                           TX.clean_transcript("raw").alias("text"), "start", "end")
