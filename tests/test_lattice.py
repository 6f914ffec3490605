"""Lattice operators against small fixtures and an independent brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from vachan.operators import lattice as LT
from vachan.operators.scoring import with_plain_wer

SYS = ["s1", "s2", "s3", "s4", "s5", "s6"]


def pairs_df(spark, segments):
    rows = []
    for seg, (ref, hyps) in enumerate(segments):
        for k, h in enumerate(hyps):
            rows.append((seg, f"u{seg}", SYS[k], k + 1, ref, h))
    return spark.createDataFrame(rows, "segment_id long, url string, system string, sys_ord int, "
                                       "ref array<string>, hyp array<string>")


def scripts(r, h):
    """Every way to turn r tokens into h tokens, as strings read from the end:
    a = both, b = reference only, c = hypothesis only."""
    if r == h == 0:
        yield ""
        return
    for step, dr, dh in (("a", 1, 1), ("b", 1, 0), ("c", 0, 1)):
        if r >= dr and h >= dh:
            for rest in scripts(r - dr, h - dh):
                yield step + rest


def script_cost(script, ref, hyp):
    r, h, cost = len(ref), len(hyp), 0
    for step in script:
        cost += step != "a" or ref[r - 1] != hyp[h - 1]
        r -= step != "c"
        h -= step != "b"
    return cost


def best_script(ref, hyp):
    """The cheapest script; of equals the first in the order a, b, c from the end."""
    return min(scripts(len(ref), len(hyp)), key=lambda s: (script_cost(s, ref, hyp), s))


def heard(ref, hyp):
    """(place, token) pairs: place p for reference position p, p - 0.5 for a gap before it."""
    out, r, h = [], len(ref), len(hyp)
    for step in best_script(ref, hyp):
        r -= step != "c"
        h -= step != "b"
        if step != "b":
            out.append((r - 0.5 if step == "c" else r, hyp[h]))
    return out[::-1]


def expected_bins(ref, hyps, thresh=3):
    """Coded mode: [(tokens, optional)], an optional bin after the reference bin of its gap."""
    everything = [x for h in hyps for x in heard(ref, h)]
    bins = []
    for p, token in enumerate(ref):
        bins.append(({token} | {t for q, t in everything if q == p}, False))
        inserted = [t for q, t in everything if q == p - 0.5]
        bins += [({t}, True) for t in dict.fromkeys(inserted) if inserted.count(t) >= thresh]
    return bins


def expected_edits(bins, hyp):
    """Least cost over all walks through bins and hypothesis (coded mode)."""
    def walks(i, j, cost):
        if i == len(bins) and j == len(hyp):
            yield cost
        if i < len(bins):
            tokens, optional = bins[i]
            yield from walks(i + 1, j, cost + (0 if optional and j == 0 else 1))  # a free skip only before any word
            if j < len(hyp):
                yield from walks(i + 1, j + 1, cost + (hyp[j] not in tokens))
        if j < len(hyp):
            yield from walks(i, j + 1, cost + 1)

    return min(walks(0, 0, 0)), sum(not optional for _, optional in bins)


def test_alignment_tie_order():
    ref = "मौनता का अर्थ क्या होता है".split()
    hyp = "मौन तागार थके होतई".split()
    ops = [op[4] for op in LT.alignment(ref, hyp)]
    assert ops == ["del", "del", "sub", "sub", "sub", "sub"]
    assert [op[3] for op in LT.alignment(ref, hyp)][2:] == hyp


def test_alignment_is_the_first_of_the_cheapest_scripts():
    rnd = random.Random(3)
    names = {"match": "a", "sub": "a", "del": "b", "ins": "c"}
    for _ in range(250):
        r = [rnd.choice("abc") for _ in range(rnd.randint(0, 5))]
        h = [rnd.choice("abcd") for _ in range(rnd.randint(0, 5))]
        ops = LT.alignment(r, h)
        assert "".join(names[x[4]] for x in reversed(ops)) == best_script(r, h)
        assert [x[2] for x in ops if x[2] is not None] == r and [x[3] for x in ops if x[3] is not None] == h


def test_fixture_bins_and_scores(spark):
    ref = ["a", "b", "c"]
    hyps = [["a", "X", "b", "c"]] * 3 + [["a", "b", "c"]] * 3
    df = pairs_df(spark, [(ref, hyps)])
    lat = LT.build_lattice(LT.align(df), 3, "coded").first()["bins"]
    assert [(list(b["tokens"]), b["optional"]) for b in lat] == [(["a"], False), (["b"], False), (["X"], True), (["c"], False)]
    detail = {r["system"]: r for r in LT.evaluate(df, 3, "coded").collect()}
    assert detail["s1"]["lattice_edits"] == 2 and detail["s4"]["lattice_edits"] == 1
    doc = {r["system"]: r for r in LT.evaluate(df, 3, "documented").collect()}
    assert doc["s1"]["lattice_edits"] == 0 and doc["s4"]["lattice_edits"] == 0


def test_trailing_insertion_makes_no_bin(spark):
    ref = ["a", "b", "c"]
    hyps = [["a", "b", "c", "X"]] * 3 + [["a", "b", "c"]] * 3
    lat = LT.build_lattice(LT.align(pairs_df(spark, [(ref, hyps)])), 3, "coded").first()["bins"]
    assert not any(b["optional"] for b in lat)


def random_segments(rnd, n, longest):
    for _ in range(n):
        ref = [rnd.choice("abcd") for _ in range(rnd.randint(1, longest))]
        hyps = []
        for _ in range(6):
            h = [t if rnd.random() < 0.7 else rnd.choice("xyab") for t in ref if rnd.random() < 0.9]
            if rnd.random() < 0.6:
                h.insert(rnd.randint(0, len(h)), rnd.choice("xy"))
            hyps.append(h)
        yield ref, hyps


def test_lattice_against_all_walks(spark):
    segments = list(random_segments(random.Random(11), 25, 3))
    got = {(r["segment_id"], r["sys_ord"]): (r["lattice_edits"], r["lattice_n"], r["edits"])
           for r in LT.evaluate(pairs_df(spark, segments), 3, "coded").collect()}
    for seg, (ref, hyps) in enumerate(segments):
        bins = expected_bins(ref, hyps)
        for k, h in enumerate(hyps):
            assert got[seg, k + 1][:2] == expected_edits(bins, h), (seg, k, ref, hyps)
            assert got[seg, k + 1][2] == script_cost(best_script(ref, h), ref, h)


def test_reports_equal_the_relational_form(spark):
    """Bins, counts and suspects of the narrow stage against groupBy over operations."""
    segments = list(random_segments(random.Random(5), 40, 9))
    pairs = pairs_df(spark, segments)
    aligned = LT.align(pairs).cache()
    for mode in ("coded", "documented"):
        reports = LT.segment_reports(LT._per_segment(pairs), 3, mode).collect()
        want = {r["segment_id"]: r["bins"] for r in LT.build_lattice(aligned, 3, mode).collect()}
        assert all([tuple(b) for b in r["bins"]] == [tuple(b) for b in want[r["segment_id"]]] for r in reports)
    counts = {(r["segment_id"], r["sys_ord"]): (r["subs"], r["dels"], r["ins"], r["hits"]) for r in LT.op_counts(aligned).collect()}
    suspects = {(r["segment_id"], r["ref_pos"], r["hyp_tok"]): r["n_systems"] for r in LT.suspected_reference_errors(aligned, 3).collect()}
    found = {(r["segment_id"], s["ref_pos"], s["hyp_tok"]): s["n_systems"] for r in reports for s in r["suspects"]}
    assert found == suspects and len(found) > 0
    for r in reports:
        for s in r["scores"]:
            assert counts.get((r["segment_id"], s["sys_ord"]), (0, 0, 0, 0)) == (s["subs"], s["dels"], s["ins"], s["hits"])


def test_documented_mode_never_increases(spark):
    segments = list(random_segments(random.Random(2), 60, 9))
    for r in LT.evaluate(pairs_df(spark, segments), 3, "documented").collect():
        assert r["lattice_edits"] <= r["edits"]


def test_op_counts_sum_to_edits(spark):
    segs = [("a b c d".split(), ["a x c d".split(), "b c d".split(), "a b c d e".split(),
                                 "a b c d".split(), "".split(), "d c b a".split()])]
    df = pairs_df(spark, segs)
    ops = LT.op_counts(LT.align(df))
    plain = with_plain_wer(df, "ref", "hyp")
    j = ops.join(plain, ["segment_id", "system", "sys_ord"]).collect()
    assert all(r["subs"] + r["dels"] + r["ins"] == r["edits"] for r in j)


def test_reports(spark):
    ref = ["a", "b", "c"]
    hyps = [["a", "X", "b", "c"]] * 3 + [["a", "b", "c"]] * 3
    detail = LT.evaluate(pairs_df(spark, [(ref, hyps)]), 3, "coded")
    summ = {r["system"]: r for r in LT.system_summary(detail).collect()}
    assert summ["s4"]["verdict"] == "INCREASED?"
    assert LT.unchanged_perfect(detail).count() == 0
    insp = LT.inspect_bins(pairs_df(spark, [(ref, hyps)]).where(F.col("sys_ord") == 1).select("segment_id", "ref"),
                           LT.build_lattice(LT.align(pairs_df(spark, [(ref, hyps)]))))
    rows = insp.orderBy("bin_idx").collect()
    # three reference tokens zipped with the first three bins (the optional bin shifts "c")
    assert [(r["ref_tok"], r["full_bin"], r["variants"]) for r in rows] == [
        ("a", ["a"], False), ("b", ["b"], False), ("c", ["X", "ε"], True)]


def test_suspected_reference_errors(spark):
    ref = ["a", "b", "c"]
    hyps = [["a", "Z", "c"]] * 3 + [["a", "b", "c"], ["a", "Q", "c"], ["a", "b", "c"]]
    rows = LT.suspected_reference_errors(LT.align(pairs_df(spark, [(ref, hyps)])), 3).collect()
    assert [(r["ref_pos"], r["ref_tok"], r["hyp_tok"], r["n_systems"]) for r in rows] == [(1, "b", "Z", 3)]


def test_align_udtf(spark):
    LT.register_align_udtf(spark)
    spark.createDataFrame([(["a", "b"], ["a", "c", "b"])], "ref array<string>, hyp array<string>") \
         .createOrReplaceTempView("pairs_t")
    rows = spark.sql("SELECT a.* FROM pairs_t, LATERAL align_words(ref, hyp) a ORDER BY op_pos").collect()
    assert [(r["op"], r["gap"]) for r in rows] == [("match", None), ("ins", 1), ("match", None)]


def test_align_words_takes_many_rows_at_once(spark):
    """No Python call per pair; empty and null sides, and rows that come twice."""
    LT.register_align_udtf(spark)
    rows = [(1, ["a", "b"], ["a", "c", "b"]), (2, [], ["x"]), (3, ["x", None], None), (4, None, None), (1, ["a", "b"], ["a", "c", "b"])] + [(10 + k, ["a"] * k, ["b"] * (k % 7)) for k in range(40)] * 30
    d = spark.createDataFrame(rows, "k int, ref array<string>, hyp array<string>").coalesce(1)
    q = spark.sql("SELECT k, a.* FROM {d}, LATERAL align_words(ref, hyp) a", d=d)
    assert "EvalPythonUDTF" not in q._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r) for r in q.collect()]
    want = [(k, i, *op) for k, r, h in rows for i, op in enumerate(LT.alignment(r or [], h or []))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_reports_are_made_piece_by_piece():
    """A large Arrow batch leaves as small ones, with the same rows as segment by segment."""
    import pyarrow as pa

    rnd = random.Random(4)
    refs = [None if k % 50 == 0 else [rnd.choice("abc") for _ in range(k % 9)] for k in range(2 * LT.PIECE + 100)]
    hyps = [[[rnd.choice("abcd") for _ in range(rnd.randrange(9))] for _ in range(4)] for _ in refs]
    b = pa.RecordBatch.from_arrays([pa.array(range(len(refs))), *LT._lists(refs, hyps)], names=["segment_id", "ref", "hyps"])
    out = list(LT._report_batches(iter([b]), ["segment_id"], 3, "coded"))
    assert len(out) == 3 and max(x.num_rows for x in out) <= LT.PIECE
    got = {r["segment_id"]: r for x in out for r in x.to_pylist()}
    assert sorted(got) == [k for k, r in enumerate(refs) if r]
    for k in list(got)[::97]:
        for name, want in zip(("bins", "scores", "suspects"), LT.segment_report(refs[k], hyps[k]), strict=True):
            assert [tuple(x.values()) for x in got[k][name]] == want


def test_sheet_is_normalised_once(spark):
    """One Python step for the texts, one for the reports: no filter that makes the reference again."""
    from vachan.functions import lexicon as L

    names = ["segment_id", "url", "Human", *L.SYSTEMS]
    sheet = spark.range(1).select(*[F.col("id").cast("string").alias(n) if n != "segment_id" else F.col("id").alias(n) for n in names])
    plan = LT.segment_reports(LT.wide_segments(sheet))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("MapInArrow") == 1


def test_running_minimum():
    from vachan.operators import alignment as AL

    rng = np.random.default_rng(3)
    for rows in (1, 2, 3, 7, 64, 65, 200):
        x = rng.integers(-500, 500, (rows, 5)).astype(np.int16)
        assert (AL._lowest_so_far(x.copy()) == np.minimum.accumulate(x, axis=0)).all()


def test_bands_give_the_same_steps(monkeypatch):
    """Any band size, down to a row a band, follows the same way back."""
    from vachan.operators import alignment as AL

    rnd = random.Random(8)
    segs = [([rnd.choice("abc") for _ in range(rnd.randrange(40))], [[rnd.choice("abcd") for _ in range(rnd.randrange(40))] for _ in range(rnd.randrange(7))]) for _ in range(30)]
    lists = LT._lists(*map(list, zip(*segs, strict=True)))

    def steps():
        a, out = LT.Aligned(*lists), {}
        for s in a.batches:
            o = a.operations(s)
            for row in zip(o.segment.tolist(), o.system.tolist(), o.place.tolist(), o.step.tolist(), o.position.tolist(), o.ref.tolist(), o.hyp.tolist(), strict=True):
                out[row[:3]] = row[3:]
        return out

    want = steps()
    assert len(want) > 1000
    for limit, edges in ((1, 2), (60, 3), (700, 32)):
        monkeypatch.setattr(AL, "BAND_BYTES", limit)
        monkeypatch.setattr(AL, "EDGES", edges)
        assert steps() == want


def test_alignment_memory_is_linear():
    """2,500 words against six hypotheses: 6 x 6.25 MB of directions at once before."""
    import tracemalloc

    from vachan.operators import alignment as AL

    rnd = random.Random(1)
    ref = [str(rnd.randrange(300)) for _ in range(2500)]
    hyps = [[t if rnd.random() < 0.8 else "x" for t in ref if rnd.random() < 0.95] for _ in range(6)]
    limit, AL.BAND_BYTES = AL.BAND_BYTES, 1 << 19
    try:
        tracemalloc.start()
        a = LT.Aligned(*LT._lists([ref], [hyps]))
        o = a.operations(np.array([0]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        AL.BAND_BYTES = limit
    assert peak < 20 << 20 and len(o.step) >= 6 * 2500


def test_awkward_segments(spark):
    """Empty references (P7), no hypotheses, empty and null ones, the lattice's own sign as a word."""
    rows = [(1, [], [["a"]] * 6), (2, ["a"], [[], None, ["a"], ["b"], ["b"], ["b"]]), (3, ["ε", "b"], [["b"]] * 6), (4, ["a"], []), (5, None, [["a"]])]
    d = spark.createDataFrame(rows, "segment_id long, ref array<string>, hyps array<array<string>>")
    got = {r["segment_id"]: r for r in LT.segment_reports(d).collect()}
    assert sorted(got) == [2, 3, 4]
    assert [(s["subs"], s["dels"], s["ins"], s["hits"]) for s in got[2]["scores"]] == [(0, 1, 0, 0), (0, 1, 0, 0), (0, 0, 0, 1)] + [(1, 0, 0, 0)] * 3
    assert [tuple(x) for x in got[2]["suspects"]] == [(0, "a", "b", 3)]
    assert [s["lattice_n"] for s in got[3]["scores"]] == [1] * 6 and [s["lattice_edits"] for s in got[3]["scores"]] == [0] * 6
    assert got[4]["scores"] == [] and [b["tokens"] for b in got[4]["bins"]] == [["a"]]
