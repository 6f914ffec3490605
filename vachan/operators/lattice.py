"""Multi-system alignment, lattice construction and lattice WER.

A segment's reference and its systems' hypotheses sit in one row, so the whole
evaluation is one narrow stage: ``segment_reports`` (``mapInArrow``) aligns
the systems of a segment, builds its bins, and scores every system against
them; only small per-segment results leave it, and the only exchange of a
summary is its final aggregation.

* E5 alignment — ``alignment.align``: the dynamic program of many segments and all
  their systems at once, in linear memory.  Ties prefer diagonal, then
  deletion, then insertion, followed back from the end.
* E7/A8 bins — reference token plus every system token aligned there; A9
  consensus substitutions and A10 insertions are counts over systems.  All of
  them are sorted keys of token numbers; strings come back only in the bins.
* E8 lattice edits — a dynamic program of all hypotheses against the bins.

The relational form of the same definitions (``align`` to one row per
operation, then ``groupBy``) stays for ad-hoc SQL and as an independent check.

``mode='coded'`` reproduces the executable definition: an optional bin
follows the reference bin of its gap, trailing insertions make no bin, and
skipping an optional bin costs 1 except in the first column.  ``mode=
'documented'`` puts optional bins at their gap, keeps the trailing gap and
lets every skip of an optional bin be free (then WER never increases).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vachan.operators import alignment as AL

EPS = "ε"
PIECE = 512  # segments taken from an Arrow batch at a time, so that memory doesn't follow the batch

ALIGN_SCHEMA = ("segment_id long, system string, sys_ord int, op_pos int, ref_pos int, gap int, "
                "ref_tok string, hyp_tok string, op string")


# ── kernels ─────────────────────────────────────────────────────────────────

def _strings(*arrays: pa.Array) -> tuple[list[np.ndarray], pa.Array]:
    """Numbers of the strings of each array, in the order of the strings, and the strings."""
    whole = pa.concat_arrays([pc.fill_null(x.cast(pa.string()), "") for x in arrays]).dictionary_encode()
    order = pc.sort_indices(whole.dictionary).to_numpy()  # by bytes, which is by code point
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    ids = rank[whole.indices.to_numpy()] if len(order) else np.zeros(0, np.int32)
    cut = np.cumsum([len(x) for x in arrays])[:-1]
    return np.split(ids, cut), whole.dictionary.take(pa.array(order))


def _offsets(lists: pa.ListArray) -> np.ndarray:
    """Offsets into ``lists.flatten()``; a null list is empty."""
    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]).astype(np.int64)


@dataclass
class Operations:
    """All alignment operations of some segments, in order: arrays of one entry each."""

    segment: np.ndarray  # number of the segment
    system: np.ndarray  # number of the hypothesis in its segment
    place: np.ndarray  # position in the alignment
    step: np.ndarray
    position: np.ndarray  # reference position, or the gap of an insertion
    ref: np.ndarray  # token numbers
    hyp: np.ndarray


class Aligned:
    """Segments of an Arrow batch with their alignments (E5).

    ``refs`` is a list of tokens per segment, ``hyps`` a list of hypotheses."""

    def __init__(self, refs: pa.ListArray, hyps: pa.ListArray):
        each = hyps.flatten()
        (self.ref, self.hyp, eps), self.words = _strings(refs.flatten(), each.flatten(), pa.array([EPS]))
        self.eps = int(eps[0])
        self.roff, self.soff, self.hoff = _offsets(refs), _offsets(hyps), _offsets(each)
        self.rlen, self.hlen = np.diff(self.roff), np.diff(self.hoff)
        self.systems = np.diff(self.soff)
        longest = np.zeros(len(self.rlen), np.int64)
        np.maximum.at(longest, np.repeat(np.arange(len(self.rlen)), self.systems), self.hlen)
        self.batches = list(AL.batches(self.rlen, longest, self.systems))

    def operations(self, segments: np.ndarray) -> Operations:
        owner = np.repeat(segments, self.systems[segments])
        pair = np.repeat(self.soff[segments], self.systems[segments]) + _within(self.systems[segments])
        ref, rlen = AL.padded(self.ref, self.roff, owner, -1)
        hyp, hlen = AL.padded(self.hyp, self.hoff, pair, -2)
        steps = AL.align(ref, hyp, rlen, hlen)
        real = steps != AL.NONE
        used = np.cumsum((steps == AL.DIAGONAL) | (steps == AL.DELETION), axis=1, dtype=np.int32)[real]
        said = np.cumsum((steps == AL.DIAGONAL) | (steps == AL.INSERTION), axis=1, dtype=np.int32)[real]
        place = (np.cumsum(real, axis=1, dtype=np.int32) - 1)[real]
        n, step = np.repeat(np.arange(len(pair)), real.sum(axis=1)), steps[real]
        inserted, dropped = step == AL.INSERTION, step == AL.DELETION
        position = np.where(inserted, used, used - 1)
        r = np.where(inserted, -1, self.ref[np.minimum(self.roff[owner[n]] + position, len(self.ref) - 1)]) if len(self.ref) else np.full(len(n), -1)
        h = np.where(dropped, -1, self.hyp[np.minimum(self.hoff[pair[n]] + np.maximum(said - 1, 0), len(self.hyp) - 1)]) if len(self.hyp) else np.full(len(n), -1)
        return Operations(owner[n], pair[n] - self.soff[owner[n]], place, step, position, r, h)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after another."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


_NAMES = np.array(["match", "sub", "del", "ins"])


def _lists(refs: list[list], hyps: list[list[list]]) -> tuple[pa.ListArray, pa.ListArray]:
    return pa.array(refs, pa.list_(pa.string())), pa.array(hyps, pa.list_(pa.list_(pa.string())))


def alignment(ref: list, hyp: list) -> list[tuple]:
    """``(ref_pos, gap, ref_tok, hyp_tok, op)`` in order; tie order diagonal,
    deletion, insertion from the end."""
    a = Aligned(*_lists([ref], [[hyp]]))
    o = a.operations(np.array([0]))
    words = a.words.to_pylist()
    out = []
    for step, p, r, h in zip(o.step.tolist(), o.position.tolist(), o.ref.tolist(), o.hyp.tolist(), strict=True):
        if step == AL.INSERTION:
            out.append((None, p, None, words[h], "ins"))
        elif step == AL.DELETION:
            out.append((p, None, words[r], None, "del"))
        else:
            out.append((p, None, words[r], words[h], "match" if r == h else "sub"))
    return out


def _align_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``segment_id, system, sys_ord, ref, hyp``: each is a segment of one hypothesis."""
    for b in batches:
        hyp = b.column("hyp")
        one = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32)), hyp)
        a = Aligned(b.column("ref"), one)
        for segments in a.batches:
            o = a.operations(segments)
            row = pa.array(o.segment)
            ins, no_ref, no_hyp = o.step == AL.INSERTION, o.ref < 0, o.hyp < 0
            op = np.where(o.step == AL.DIAGONAL, np.where(o.ref == o.hyp, 0, 1), np.where(ins, 3, 2))
            at = lambda v, skip: pa.array(v.astype(np.int32), pa.int32(), mask=skip)
            yield pa.RecordBatch.from_arrays(
                [b.column("segment_id").take(row), b.column("system").take(row), b.column("sys_ord").take(row), pa.array(o.place, pa.int32()),
                 at(o.position, ins), at(o.position, ~ins), a.words.take(at(o.ref, no_ref)), a.words.take(at(o.hyp, no_hyp)), pa.array(_NAMES[op], pa.string())],
                names=["segment_id", "system", "sys_ord", "op_pos", "ref_pos", "gap", "ref_tok", "hyp_tok", "op"])


BIN = "struct<pos:int,kind:int,first_sys:int,first_pos:int,tokens:array<string>,optional:boolean>"
SCORE = "struct<sys_ord:int,subs:bigint,dels:bigint,ins:bigint,hits:bigint,lattice_edits:bigint,lattice_n:bigint>"
SUSPECT = "struct<ref_pos:int,ref_tok:string,hyp_tok:string,n_systems:bigint>"


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order that sorts the keys, first entry of each in that order, how many)."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return order, first, np.diff(np.append(first, len(k)))


def _report(a: Aligned, segments: np.ndarray, thresh: int, mode: str) -> tuple[list, list, list]:
    """Columns of bins, scores and suspects of some segments, ordered by segment."""
    o = a.operations(segments)
    d = len(a.words)
    both, ins = o.step == AL.DIAGONAL, o.step == AL.INSERTION
    # Reference positions and the tokens heard there
    own = np.repeat(segments, a.rlen[segments])
    pos = _within(a.rlen[segments])
    said = a.ref[a.roff[own] + pos]
    here = (a.roff[o.segment[both]] + o.position[both]) * d + o.hyp[both]
    ref_keys = np.unique(np.concatenate([(a.roff[own] + pos) * d + said, here]))
    spot = ref_keys // d
    _, lead, size = _grouped(spot)
    seg_of = np.searchsorted(a.roff, spot[lead], "right") - 1
    bins = [seg_of, spot[lead] - a.roff[seg_of], np.zeros(len(lead), np.int64), np.zeros(len(lead), np.int64), np.zeros(len(lead), np.int64), lead, size]
    token = ref_keys % d
    # Tokens that several systems put in a reference token's place
    order, first, many = _grouped(here)
    k = here[order[first]]
    at = k // d
    odd = (many >= thresh) & (a.ref[at] != k % d) if len(k) else np.zeros(0, bool)
    sus_seg = np.searchsorted(a.roff, at[odd], "right") - 1
    suspects = [sus_seg, at[odd] - a.roff[sus_seg], a.ref[at[odd]] if len(a.ref) else at[odd], k[odd] % d, many[odd]]
    # A10: inserted tokens of a gap, first seen by the first system, there first
    rows = np.flatnonzero(ins)
    rows = rows[np.lexsort((o.place[rows], o.system[rows]))]
    gap = (a.roff[o.segment[rows]] + o.segment[rows] + o.position[rows]) * d + o.hyp[rows]
    order, first, many = _grouped(gap)
    lead = rows[order[first]]
    keep = many >= thresh
    if mode == "coded":
        keep &= o.position[lead] < a.rlen[o.segment[lead]]
    lead = lead[keep]
    added = [o.segment[lead], o.position[lead], np.full(len(lead), 1 if mode == "coded" else -1), o.system[lead] + 1, o.place[lead], len(token) + np.arange(len(lead)), np.ones(len(lead), np.int64)]
    token = np.concatenate([token, o.hyp[lead]])
    opt = np.concatenate([np.zeros(len(seg_of), bool), np.ones(len(lead), bool)])
    bins = [np.concatenate([x, y]) for x, y in zip(bins, added, strict=True)]
    sort = np.lexsort((bins[4], bins[3], bins[2], bins[1], bins[0]))
    seg, pos, kind, sys1, place1, start, size = (x[sort] for x in bins)
    opt = opt[sort]
    # E8
    by = np.argsort(segments)
    number = np.searchsorted(segments[by], seg)  # segments in order, from 0
    count = np.bincount(number, minlength=len(segments))
    slot = _within(count)
    tokens = np.full((len(segments), int(count.max(initial=0)), int(size.max(initial=0)) + 1), -3, np.int32)
    inner = _within(size)
    flat = token[np.repeat(start, size) + inner]
    tokens[np.repeat(number, size), np.repeat(slot, size), inner] = flat
    tokens[number[opt], slot[opt], size[opt]] = a.eps
    has = np.zeros(tokens.shape[:2], bool)
    only = np.zeros(tokens.shape[:2], bool)
    has[number, slot] = (tokens[number, slot] == a.eps).any(axis=1)
    only[number, slot] = has[number, slot] & ((tokens[number, slot] == a.eps) | (tokens[number, slot] == -3)).all(axis=1)
    ordered = segments[by]
    owner = np.repeat(np.arange(len(ordered)), a.systems[ordered])
    pair = np.repeat(a.soff[ordered], a.systems[ordered]) + _within(a.systems[ordered])
    hyp, hlen = AL.padded(a.hyp, a.hoff, pair, -2)
    edits = AL.lattice(tokens, has, only if mode == "coded" else has, count, owner, hyp, hlen)
    full = np.bincount(number, weights=~has[number, slot], minlength=len(segments)).astype(np.int64)
    # E6
    n = a.soff[o.segment] + o.system
    tally = [np.bincount(n[m], minlength=len(a.hlen))[pair] for m in (both & (o.ref != o.hyp), o.step == AL.DELETION, ins, both & (o.ref == o.hyp))]
    scores = [ordered[owner], pair - a.soff[ordered[owner]] + 1, *tally, edits, full[owner]]
    return [seg, pos, kind, sys1, place1, size, flat, opt], scores, suspects


def _structs(count: np.ndarray, fields: list[tuple[str, pa.Array]]) -> pa.ListArray:
    """A list of structs per row from their columns."""
    off = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays([x for _, x in fields], names=[n for n, _ in fields]))


def _reports(refs: pa.ListArray, hyps: pa.ListArray, thresh: int, mode: str) -> list[pa.Array]:
    """Columns ``bins``, ``scores``, ``suspects`` of the segments."""
    a, n = Aligned(refs, hyps), len(refs)
    parts = [_report(a, s, thresh, mode) for s in a.batches]

    def joined(k: int, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
        cols = [np.concatenate([p[k][c] for p in parts]) if parts else np.zeros(0, np.int64) for c in range(width)]
        return np.argsort(cols[0], kind="stable"), cols

    def word(ids):
        return a.words.take(pa.array(ids.astype(np.int64)))

    order, (seg, pos, kind, sys1, place1, size, flat, opt) = joined(0, 8)
    start = np.cumsum(size) - size
    size = size[order]
    flat = flat[np.repeat(start[order], size) + _within(size)]
    tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), word(flat))
    i32 = lambda v: pa.array(v[order], pa.int32())
    bins = _structs(np.bincount(seg, minlength=n), [("pos", i32(pos)), ("kind", i32(kind)), ("first_sys", i32(sys1)), ("first_pos", i32(place1)), ("tokens", tokens), ("optional", pa.array(opt[order].astype(bool)))])
    order, (seg, ordinal, *numbers) = joined(1, 8)
    names = ("subs", "dels", "ins", "hits", "lattice_edits", "lattice_n")
    scores = _structs(np.bincount(seg, minlength=n), [("sys_ord", pa.array(ordinal[order], pa.int32())), *[(k, pa.array(v[order], pa.int64())) for k, v in zip(names, numbers, strict=True)]])
    order, (seg, pos, ref, hyp, many) = joined(2, 5)
    suspects = _structs(np.bincount(seg, minlength=n), [("ref_pos", pa.array(pos[order], pa.int32())), ("ref_tok", word(ref[order])), ("hyp_tok", word(hyp[order])), ("n_systems", pa.array(many[order], pa.int64()))])
    return [bins, scores, suspects]


def segment_report(ref: list, hyps: list[list], thresh: int = 3, mode: str = "coded") -> tuple[list, list, list]:
    """(bins, scores per system, suspected reference errors) of one segment, as tuples."""
    return tuple([tuple(x.values()) for x in col.to_pylist()[0]] for col in _reports(*_lists([ref], [hyps]), thresh, mode))


def _report_batches(batches: Iterator[pa.RecordBatch], keep: list[str], thresh: int, mode: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, PIECE):
            b = whole.slice(at, PIECE)
            b = b.filter(pc.greater(pc.list_value_length(b.column("ref")), 0))  # a null list isn't kept
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *_reports(b.column("ref"), b.column("hyps"), thresh, mode)], names=[*keep, "bins", "scores", "suspects"])


def segment_reports(wide: DataFrame, thresh: int = 3, mode: str = "coded", keep: list[str] | None = None) -> DataFrame:
    """``(segment_id, ref, hyps, ...)`` plus ``bins``, ``scores`` and ``suspects``;
    ``keep`` names the input columns that pass through (all by default).
    Segments with an empty reference are left out (P7).  An Arrow batch is taken
    ``PIECE`` segments at a time: memory follows these, not the batch."""
    keep = wide.columns if keep is None else keep
    fields = {f.name: f.dataType.simpleString() for f in wide.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in keep) + f", bins array<{BIN}>, scores array<{SCORE}>, suspects array<{SUSPECT}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _report_batches(batches, keep, thresh, mode)
    need = [*keep, *[c for c in ("ref", "hyps") if c not in keep]]
    # empty references are left out there: a filter here would be pushed below what makes the
    # reference, which then is made twice, by one more Python worker a task
    return wide.select(*need).mapInArrow(run, schema)


def wide_segments(sheet: DataFrame, systems=None) -> DataFrame:
    """Sheet rows (texts by system column) to ``(segment_id, url, ref, systems, hyps)``
    token arrays; no shuffle."""
    from vachan.functions import lexicon as L
    from vachan.functions import text as TX

    systems = list(systems or L.SYSTEMS)
    return sheet.select("segment_id", "url", TX.tokenise("Human").alias("ref"), F.array(*[F.lit(n) for n in systems]).alias("systems"),
                        F.array(*[TX.tokenise(F.col(f"`{n}`")) for n in systems]).alias("hyps"))


def detail_rows(reports: DataFrame) -> DataFrame:
    """E9/E11 rows from reports that kept ``segment_id, url, ref, systems, hyps``: one
    per (segment, system) with plain and lattice scores."""
    each = F.transform("scores", lambda s: F.struct(
        F.element_at("systems", s["sys_ord"]).alias("system"), s["sys_ord"].alias("sys_ord"), F.element_at("hyps", s["sys_ord"]).alias("hyp"),
        (s["subs"] + s["dels"] + s["ins"]).alias("edits"), s["lattice_edits"].alias("lattice_edits"), s["lattice_n"].alias("lattice_n")))
    rows = reports.select("segment_id", "url", "ref", F.explode(each).alias("s")).select("segment_id", "url", "ref", "s.*")
    rows = rows.withColumn("n", F.size("ref"))
    return (rows.withColumn("plain_wer", F.when(F.col("n") > 0, F.round(F.col("edits") / F.col("n"), 4)).otherwise(F.lit(0.0)))
                .withColumn("lattice_wer", F.when(F.col("lattice_n") > 0, F.round(F.col("lattice_edits") / F.col("lattice_n"), 4)).otherwise(F.lit(0.0)))
                .withColumn("delta", F.round(F.col("lattice_wer") - F.col("plain_wer"), 4)))


def _per_segment(pairs: DataFrame) -> DataFrame:
    """Long pairs to one row per segment, systems in order (bounded: one entry per system)."""
    s = F.array_sort(F.collect_list(F.struct("sys_ord", "system", "hyp", "ref", "url")))
    g = pairs.groupBy("segment_id").agg(s.alias("s"))
    return g.select("segment_id", F.element_at(F.col("s.url"), 1).alias("url"), F.element_at(F.col("s.ref"), 1).alias("ref"),
                    F.col("s.system").alias("systems"), F.col("s.hyp").alias("hyps"))


# ── Spark operators ─────────────────────────────────────────────────────────

def align(pairs: DataFrame) -> DataFrame:
    """E5 (+ V5 surface): ``(segment_id, system, sys_ord, ref, hyp)`` token
    arrays to one row per alignment operation (ALIGN_SCHEMA)."""
    return (pairs.select(F.col("segment_id").cast("long"), F.col("system").cast("string"), F.col("sys_ord").cast("int"), "ref", "hyp")
                 .mapInArrow(_align_batches, ALIGN_SCHEMA))


def op_counts(aligned: DataFrame) -> DataFrame:
    """Substitutions, deletions, insertions and hits per (segment, system)."""
    return aligned.groupBy("segment_id", "system", "sys_ord").agg(
        F.count_if(F.col("op") == "sub").alias("subs"), F.count_if(F.col("op") == "del").alias("dels"),
        F.count_if(F.col("op") == "ins").alias("ins"), F.count_if(F.col("op") == "match").alias("hits"))


def reference_bins(aligned: DataFrame) -> DataFrame:
    """``(segment_id, ref_pos, ref_tok, tokens)``; tokens = sorted set of
    the reference token and every system token aligned at ``ref_pos``."""
    return (aligned.where(F.col("ref_pos").isNotNull())
                   .groupBy("segment_id", "ref_pos")
                   .agg(F.max("ref_tok").alias("ref_tok"), F.collect_set("hyp_tok").alias("__h"))
                   .select("segment_id", "ref_pos", "ref_tok",
                           F.array_sort(F.array_union(F.array("ref_tok"), F.col("__h"))).alias("tokens")))


def suspected_reference_errors(aligned: DataFrame, thresh: int = 3) -> DataFrame:
    """Non-reference tokens that at least ``thresh`` systems put at the same
    reference position (the reference itself is probably wrong there)."""
    return (aligned.where((F.col("op") == "sub"))
                   .groupBy("segment_id", "ref_pos", "ref_tok", "hyp_tok")
                   .agg(F.count(F.lit(1)).alias("n_systems"))
                   .where(F.col("n_systems") >= thresh))


def optional_bins(aligned: DataFrame, ref_len: DataFrame, thresh: int = 3, mode: str = "coded") -> DataFrame:
    """Inserted tokens seen at least ``thresh`` times (over all systems,
    repeats included) at one gap; ``first_sys, first_pos`` = first sighting in
    system order then alignment order.  Coded mode drops the trailing gap."""
    ins = (aligned.where(F.col("op") == "ins")
                  .groupBy("segment_id", "gap", "hyp_tok")
                  .agg(F.count(F.lit(1)).alias("cnt"),
                       F.min(F.struct("sys_ord", "op_pos")).alias("__first"))
                  .where(F.col("cnt") >= thresh))
    if mode == "coded":
        ins = ins.join(ref_len, "segment_id").where(F.col("gap") < F.col("ref_len")).drop("ref_len")
    return ins.select("segment_id", "gap", "hyp_tok", "cnt",
                      F.col("__first.sys_ord").alias("first_sys"), F.col("__first.op_pos").alias("first_pos"))


def build_lattice(aligned: DataFrame, thresh: int = 3, mode: str = "coded") -> DataFrame:
    """One row per segment, ``bins ARRAY<STRUCT<pos, kind, first_sys,
    first_pos, tokens ARRAY<STRING>, optional BOOLEAN>>`` in lattice order."""
    rb = reference_bins(aligned)
    ref_len = rb.groupBy("segment_id").agg(F.count(F.lit(1)).alias("ref_len"))
    ob = optional_bins(aligned, ref_len, thresh, mode)
    kind_opt = 1 if mode == "coded" else -1
    bins = rb.select("segment_id", F.col("ref_pos").alias("pos"), F.lit(0).alias("kind"),
                     F.lit(0).alias("first_sys"), F.lit(0).alias("first_pos"), "tokens",
                     F.lit(False).alias("optional")).unionByName(
        ob.select("segment_id", F.col("gap").alias("pos"), F.lit(kind_opt).alias("kind"), "first_sys",
                  "first_pos", F.array("hyp_tok").alias("tokens"), F.lit(True).alias("optional")))
    return bins.groupBy("segment_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "kind", "first_sys", "first_pos", "tokens", "optional")))
         .alias("bins"))


def evaluate(pairs: DataFrame, thresh: int = 3, mode: str = "coded") -> DataFrame:
    """E9/E11 on long pairs ``segment_id, url, system, sys_ord, ref, hyp``: gathers the
    systems of a segment, then one narrow stage.  A sheet needs no gathering:
    ``detail_rows(segment_reports(wide_segments(sheet)))``."""
    return detail_rows(segment_reports(_per_segment(pairs), thresh, mode, ["segment_id", "url", "ref", "systems", "hyps"]))


def system_summary(detail: DataFrame) -> DataFrame:
    """A7 + P12: per system micro-averaged plain and lattice WER, delta, verdict."""
    agg = detail.groupBy("system", "sys_ord").agg(
        F.sum("edits").alias("plain_edits"), F.sum("n").alias("plain_n"),
        F.sum("lattice_edits").alias("lattice_edits"), F.sum("lattice_n").alias("lattice_n"))
    p = F.col("plain_edits") / F.col("plain_n")
    lw = F.col("lattice_edits") / F.col("lattice_n")
    d = lw - p
    return agg.select("system", "sys_ord", "plain_edits", "plain_n", "lattice_edits", "lattice_n",
                      p.alias("plain_wer"), lw.alias("lattice_wer"), d.alias("delta"),
                      F.when(d < -0.0001, F.lit("REDUCED")).when(F.abs(d) < 0.0001, F.lit("same"))
                       .otherwise(F.lit("INCREASED?")).alias("verdict"))


def top_improved(detail: DataFrame, k: int = 15, threshold: float = -0.10) -> DataFrame:
    """The ``k`` most negative deltas below ``threshold``; ties keep
    sheet order (segment, then system).  A top-k report: the limit is the
    feature (TakeOrdered, no global sort)."""
    return (detail.where(F.col("delta") < threshold)
                  .orderBy("delta", "segment_id", "sys_ord").limit(k))


def unchanged_perfect(detail: DataFrame, k: int = 5) -> DataFrame:
    """First ``k`` rows in sheet order with |delta| < 0.001 and plain 0."""
    return (detail.where((F.abs(F.col("delta")) < 0.001) & (F.col("plain_wer") == 0.0))
                  .orderBy("segment_id", "sys_ord").limit(k))


def inspect_bins(ref_tokens: DataFrame, lattice: DataFrame) -> DataFrame:
    """Reference tokens zipped with lattice bins by position
    (truncated at the shorter list, so optional bins shift later pairs, as in
    the original display), the sorted full bin (optional bins show ``ε``) and
    a variants flag (bin minus the reference token is non-empty)."""
    return zip_bins(ref_tokens.join(lattice, "segment_id"))


def zip_bins(j: DataFrame) -> DataFrame:
    """``inspect_bins`` on rows that hold both ``ref`` and ``bins``."""
    full = F.transform("bins", lambda b: F.array_sort(
        F.when(b["optional"], F.array_union(b["tokens"], F.array(F.lit(EPS)))).otherwise(b["tokens"])))
    z = j.select("segment_id", F.arrays_zip(F.col("ref").alias("ref_tok"), full.alias("full_bin")).alias("z"),
                 F.least(F.size("ref"), F.size("bins")).alias("m"))
    z = z.select("segment_id", F.posexplode(F.slice("z", 1, F.col("m"))).alias("bin_idx", "p"))
    return z.select("segment_id", "bin_idx", F.col("p.ref_tok").alias("ref_tok"), F.col("p.full_bin").alias("full_bin"),
                    (F.size(F.array_except(F.col("p.full_bin"), F.array(F.col("p.ref_tok")))) > 0).alias("variants"))


def nth_segment(df: DataFrame, n: int = 2, order_col: str = "segment_id") -> DataFrame:
    """T5: rows of the ``n``-th segment in sheet order; none if there are fewer.  Picked in
    the sheet, before it is aligned, a single segment is evaluated."""
    first = df.select(order_col).distinct().orderBy(order_col).limit(n)
    pick = first.agg(F.max(order_col).alias("__nth"), F.count(F.lit(1)).alias("__k")).where(F.col("__k") == n)
    return df.join(pick, F.col(order_col) == F.col("__nth"), "left_semi")


OPERATION = "struct<op_pos:int,ref_pos:int,gap:int,ref_tok:string,hyp_tok:string,op:string>"


def _aligned_lists(ref: pa.ListArray, hyp: pa.ListArray) -> pa.ListArray:
    """The operations of each pair as a list of OPERATION structs; a null list is empty."""
    a = Aligned(ref, pa.ListArray.from_arrays(pa.array(np.arange(len(hyp) + 1, dtype=np.int32)), hyp))
    parts = [a.operations(segments) for segments in a.batches]
    row, place, step, position, r, h = (np.concatenate([getattr(o, k) for o in parts] or [np.zeros(0, np.int64)]) for k in ("segment", "place", "step", "position", "ref", "hyp"))
    order = np.lexsort((place, row))
    step, r, h = step[order], r[order], h[order]
    ins = step == AL.INSERTION
    op = np.where(step == AL.DIAGONAL, np.where(r == h, 0, 1), np.where(ins, 3, 2))
    at = lambda v, skip: pa.array(v.astype(np.int32), pa.int32(), mask=skip)
    return _structs(np.bincount(row, minlength=len(ref)), [
        ("op_pos", pa.array(place[order], pa.int32())), ("ref_pos", at(position[order], ins)), ("gap", at(position[order], ~ins)),
        ("ref_tok", a.words.take(at(r, r < 0))), ("hyp_tok", a.words.take(at(h, h < 0))), ("op", pa.array(_NAMES[op], pa.string()))])


def register_align_udtf(spark, name: str = "align_words") -> None:
    """V5: SQL surface of E5 — ``SELECT * FROM t, LATERAL align_words(ref, hyp)``
    yields ``(op_pos, ref_pos, gap, ref_tok, hyp_tok, op)`` rows.  A SQL table function
    over an Arrow function, so many rows are aligned at once; a Python table
    function would be called, and its rows converted, pair by pair."""
    @F.arrow_udf(f"array<{OPERATION}>")
    def align_lists(ref: pa.Array, hyp: pa.Array) -> pa.Array:
        if len(ref) == 0:
            return _aligned_lists(ref, hyp)
        parts = [_aligned_lists(ref.slice(i, PIECE), hyp.slice(i, PIECE)) for i in range(0, len(ref), PIECE)]
        return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

    spark.udf.register(f"{name}_lists", align_lists)
    columns = OPERATION[len("struct<"):-1].replace(":", " ").replace(",", ", ")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(ref ARRAY<STRING>, hyp ARRAY<STRING>) RETURNS TABLE({columns}) "
              f"RETURN SELECT inline({name}_lists(ref, hyp))")
