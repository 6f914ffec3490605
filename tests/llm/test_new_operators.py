"""Periodic runs, Merkle manifest, line dedup: against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import rows as R
from hypothesis import given, settings
from hypothesis import strategies as st

from vachan.llm import line_dedup, merkle, period_runs
from vachan.llm.queries import planted


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


# ---------------------------------------------------------------- op 11

def brute_runs(w: list, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) by trying every period at every place."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def caught(docs: list[list], **how) -> list[list[tuple[int, int, int]]]:
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for d in docs for w in d], np.uint64)
    off = np.cumsum([0] + [len(d) for d in docs])
    doc, s, n, p = period_runs.catch(period_runs.mix(ids + np.uint64(1)), off, **how)
    return [[(int(a), int(b), int(c)) for k, a, b, c in zip(doc, s, n, p, strict=True) if k == d] for d in range(len(docs))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(
    st.lists(st.integers(0, 1), max_size=60),
    st.lists(st.integers(0, 3), max_size=40),
    st.builds(lambda u, k, a, b: a + (u * 40)[:k] + b, st.lists(st.integers(0, 2), min_size=1, max_size=17), st.integers(0, 150), st.lists(st.integers(0, 2), max_size=9), st.lists(st.integers(0, 2), max_size=9)),
), max_size=5))
def test_runs_of_any_words(docs):
    assert caught(docs) == [brute_runs(d) for d in docs]
    assert caught(docs, least=2, times=3) == [brute_runs(d, 2, 3) for d in docs]


def test_runs_of_three_periods_at_odd_places():
    """Such a run may hold a single whole block that is caught."""
    for d in ([2, 2, 0, 1, 2, 1, 2, 1, 2, 0], ([0, 2, 0, 0, 1, 2] * 40)[:141] + [2, 0]):
        assert caught([d], least=2, times=3) == [brute_runs(d, 2, 3)]


def test_runs_of_special_words():
    fib = ["a", "ab"]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    thue = "".join(str(bin(i).count("1") % 2) for i in range(1024))
    rnd = random.Random(3)
    nested = "".join(("ab" * rnd.randrange(1, 9) + "c" * rnd.randrange(1, 9)) * rnd.randrange(1, 7) for _ in range(12))
    docs = [list(x) for x in ("", "a", "aaaaa", "aaaaaa", "a" * 500, "ab" * 300, fib[-1], thue, nested, nested * 5, "aab" * 90 + "aba" * 90)]
    assert caught(docs) == [brute_runs(d) for d in docs]


def expected_runs(i, text, plan=None):
    w = R.words(text)
    r = plan(i, len(w)) if plan else None
    if r is not None:
        w = [w[k] for k in r]
    runs = brute_runs(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return (i, len(w), tuple(runs), " ".join(x for k, x in enumerate(w) if k not in gone))


def found_runs(df, **how) -> Counter:
    return Counter((r.id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in period_runs.find(df, **how).collect())


@pytest.mark.parametrize("plan", [None, planted])
def test_runs_of_documents(spark, awkward, plan):
    rows = [(r.doc_id, r.text) for r in awkward.collect() if len(r.text or "") < 30_000]
    rows += [(1000 + i, R.prose(random.Random(i), 30, 40) + " " + "p q r " * (i % 40)) for i in range(120)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found_runs(d, rewrite=plan) == Counter(expected_runs(i, t, plan) for i, t in rows)
    assert period_runs.find(awkward).count() == awkward.count()


def test_planted_repetition_keeps_words_before_it():
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert planted(None, 10) is None and planted(ids[0], 0) is None
    for i in ids[:50]:
        r = planted(i, 97)
        a = zlib.crc32(str(i).encode()) // 10 % 97
        assert r[:a].tolist() == list(range(a)) and set(r[a:].tolist()) <= set(range(a, 97))


def test_words_of_one_hash_are_told_apart(spark, monkeypatch):
    """A hash that hides differences costs time, not results."""
    monkeypatch.setattr(period_runs.Spans, "hash", lambda self, a, b: (b - a).astype(np.uint64))
    text = "aa bb cc dd ee ff gg hh ii jj kk kk kk kk kk kk kk ll mm"
    batch = spark.createDataFrame([(1, text)], "id long, text string").toArrow().to_batches()[0]
    data, off = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    s, e, f = period_runs.words(data, off)
    assert len(period_runs.catch(period_runs.Spans(data).hash(s, e), f)[0]) == 1
    assert period_runs.exact(text.encode().split(), 6, 4) == brute_runs(text.split()) == [(10, 7, 1)]
    assert batch.num_rows == 1


def test_runs_without_rows(none):
    assert period_runs.find(none).count() == 0


# ---------------------------------------------------------------- op 12

def enc(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves: list[str], fanout: int):
    """(root, ways): the siblings (left, right) of each leaf, level by level."""
    ways, level, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            a = i - i % fanout
            ways[k].append(("".join(level[a:i]), "".join(level[i + 1:a + fanout])))
        level = [sha("".join(level[i:i + fanout])) for i in range(0, len(level), fanout)]
        at = [i // fanout for i in at]
    return level[0], ways


def expected_proofs(rows, fanout):
    """rows: (lang, key, leaf, shown)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    names = sorted(groups, key=lambda g: b"" if g is None else b"1" + g.encode())
    tops, below = {}, {}
    for g in names:
        own = sorted(groups[g], key=lambda r: (R.order(r[1]), r[2], r[3]))
        below[g] = own, *tree([r[2] for r in own], fanout)
    root, ways = tree([below[g][1] for g in names], fanout)
    tops = dict(zip(names, ways, strict=True))
    out = Counter()
    for g in names:
        own, subroot, local = below[g]
        for (_, key, leaf, shown), steps in zip(own, local, strict=True):
            node = shown
            for a, z in steps + tops[g]:
                node = sha(a + node + z)
            out[key, leaf, subroot, root, sha("".join(a + z for a, z in steps + tops[g])), node, node == root] += 1
    return out


@pytest.mark.parametrize(("fanout", "block", "swap"), [(2, 10, 4), (2, 2, 1), (2, 1, 2), (3, 1, 1)])
def test_manifest_proves_every_row(spark, awkward, monkeypatch, fanout, block, swap):
    from pyspark.sql import functions as F

    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block)
    monkeypatch.setattr(merkle, "SWAP_LEVELS", swap)
    cols = ["doc_id", "source", "lang", "n_chars", "text"]
    d = awkward.select("*").withColumn("lang", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("l"), (F.col("doc_id") % 7).cast("string"))).otherwise(F.col("lang")))
    leaf = merkle.leaf(*[F.col(c) for c in cols])
    shown = merkle.leaf(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in cols])
    got = merkle.prove(d, "lang", "doc_id", leaf, F.when(F.col("doc_id") % 4 == 0, shown), fanout=fanout).collect()
    rows = []
    for r in d.collect():
        own = sha("".join(enc(r[c]) for c in cols))
        other = sha("".join(enc(r[c] + 1 if c == "n_chars" and r[c] is not None else r[c]) for c in cols))
        rows.append((r.lang, r.doc_id, own, other if r.doc_id is not None and r.doc_id % 4 == 0 else own))
    if any(a == b and a[3] != b[3] for a in rows for b in rows):
        raise AssertionError
    want = expected_proofs(rows, fanout)
    assert Counter((r.item, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got) == want
    assert not all(r.verified for r in got) and any(r.verified for r in got)


@pytest.mark.parametrize("n", [1, 3, 17, 32])
def test_ragged_butterflies(spark, monkeypatch, n):
    """Any number of partitions, full or not, learns the root and its proofs."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(merkle, "SWAP_LEVELS", 1)
    d = spark.range(n).select(F.lit("en").alias("lang"), F.col("id"))
    got = merkle.prove(d, "lang", "id", F.sha2(F.col("id").cast("string"), 256)).collect()
    want = expected_proofs([("en", i, sha(str(i)), sha(str(i))) for i in range(n)], 2)
    assert Counter((r.item, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got) == want


def test_manifest_without_rows(none):
    from pyspark.sql import functions as F

    assert merkle.prove(none, "lang", "doc_id", merkle.leaf(F.col("doc_id"))).count() == 0


# ---------------------------------------------------------------- op 13

def line_key(line: str) -> str:
    return line.strip(" \t\n\x0b\f\r").translate(R.LOWER)


def expected_lines(rows, min_chars=20, min_docs=3) -> Counter:
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[line_key(line)].add(R.order(i))
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(k := line_key(x)) < min_chars or len(holders[k]) < min_docs or max(holders[k]) == R.order(i)]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def found_lines(df, **how) -> Counter:
    return Counter((r.id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(df, **how).collect())


def test_lines_that_documents_share(spark, awkward):
    rnd = random.Random(12)
    common = [f"this line number {k} stands in many a document" for k in range(9)] + ["É" * 20, "é" * 19, "\x85 not ascii blank at the ends \xa0", "x" * 20, "short"]
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for i in range(120):
        lines = [rnd.choice([rnd.choice(common), f" \t{rnd.choice(common).upper()}\r", f"own line {i} {rnd.random()} of this one", "", "the hot line of every document"]) for _ in range(rnd.randrange(12))]
        rows.append((rnd.choice([2000 + i, 2000 + i, None]), "\n".join([*lines, "The HOT line of every document"])))
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found_lines(d) == expected_lines(rows)
    assert found_lines(d, min_chars=1, min_docs=2) == expected_lines(rows, 1, 2)
    assert found_lines(awkward) == expected_lines([(r.doc_id, r.text) for r in awkward.collect()])


def test_lines_of_odd_tables(spark, none):
    assert line_dedup.dedup_lines(none).count() == 0
    line = "a line of more than twenty characters"
    rows = [(1, line), (2, line + "\n"), (3, f"\n{line}\n{line}"), (4, f"{line}\nend"), (4, f"other\n{line}"), (None, line), (None, f"{line}\n" * 5000 + "tail")]
    got = found_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == expected_lines(rows)
    assert got[1, 1, 1, ""] == 1 and got[4, 2, 0, f"{line}\nend"] == 1


def test_line_dedup_runs_without_python(spark, awkward):
    plan = line_dedup.dedup_lines(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
