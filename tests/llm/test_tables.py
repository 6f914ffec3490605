"""Packing, token files, exact dedup, Jaccard join, WARC, suffix dedup and the pipeline."""

import random
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import rows as R

import public_tokenizers
from vachan.llm import exact_dedup, ngram_join, packing, suffix_dedup, token_files, tokens, warc
from vachan.llm.common import Bloom, join_hot, rank_within, scratch_path, slices
from vachan.llm.components import components
from vachan.llm.tokens import Encoder, encoder

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ---------------------------------------------------------------- token ids

@pytest.mark.parametrize("remembered", [1_500_000, 300])
@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_pieces_give_the_library_s_ids(path, remembered, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", remembered)
    rnd = random.Random(3)
    parts = ["a", "B", "é", "1", "2", ".", ",", "'s", "'", "!", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "　", "\u0085", "\x1c", "日本", "ß", "İ", "é", "́", "😀", "᠎",
             "​", "<|endoftext|>", "<|startoftext|>", "_", "-", ":", ";", "?", ")", '"', "]", "(", "<|", "|>", "Σ", "'LL", "2.5", "½"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(4000)]
    enc, want = Encoder(path), library(path)
    for _, data, off in slices(pa.RecordBatch.from_pydict({"text": texts}), "text", 1 << 14):
        ids, at = enc.encode(data, off)
        for i in range(len(off) - 1):
            t = data[off[i]:off[i + 1]].tobytes().decode()
            assert ids[at[i]:at[i + 1]].tolist() == want(t), repr(t)


# ---------------------------------------------------------------- op 1

def exhaustive(sizes: list[int], capacity: int) -> int:
    """Fewest rolls, by trying every way."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for r in range(len(rooms)):
            if rooms[r] >= sizes[i]:
                place(i + 1, [*rooms[:r], rooms[r] - sizes[i], *rooms[r + 1:]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


def test_knapsack_is_optimal():
    rnd = np.random.default_rng(1)
    for _ in range(30):
        value, capacity = rnd.random(rnd.integers(1, 9)), int(rnd.integers(1, 14))
        best = [0.0] * (capacity + 1)
        for c in range(1, capacity + 1):
            best[c] = max([best[c - 1]] + [best[c - s - 1] + value[s] for s in range(len(value)) if s < c])
        worth, pattern = packing.knapsack(value, capacity)
        assert abs(worth - best[capacity]) < 1e-9
        assert abs(sum(value[s - 1] * k for s, k in pattern.items()) - worth) < 1e-9 and sum(s * k for s, k in pattern.items()) <= capacity


def test_plan_is_near_the_optimum():
    rnd = random.Random(2)
    for _ in range(15):
        sizes = sorted((rnd.randrange(1, 13) for _ in range(9)), reverse=True)
        rolls = packing.plan(Counter(sizes), 12, 1)
        assert sum(k for _, k in rolls) <= exhaustive(sizes, 12) + 1
        placed = Counter()
        for pattern, k in rolls:
            assert sum(c * n for c, n in pattern.items()) <= 12
            placed.update({c: n * k for c, n in pattern.items()})
        assert placed == Counter(sizes)
    lengths = Counter(np.clip(np.random.default_rng(1).lognormal(6, 1, 20_000).astype(int) % 2048, 1, 2047).tolist())
    rolls = sum(k for _, k in packing.plan(lengths))
    assert sum(n * k for n, k in lengths.items()) / (rolls * 2048) > 0.985


def check_pieces(found, docs, seq_len):
    want = library(WORD_BPE)
    pieces = defaultdict(list)
    for r in found:
        pieces[r.id].append(r)
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(want(t) + [1])
    for i, lists in texts.items():
        expect = Counter((a, min(seq_len, len(x) - a), crc(x[a:a + seq_len]), len(x)) for x in lists for a in range(0, len(x), seq_len))
        assert Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[i]) == expect
    assert set(pieces) == set(texts)
    seqs = defaultdict(list)
    for r in found:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= seq_len
    assert sorted(seqs) == list(range(len(seqs)))


def test_packing(awkward):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    check_pieces(packing.pack(awkward, WORD_BPE).collect(), docs, 2048)
    found = packing.pack(awkward, WORD_BPE, seq_len=256, with_ids=True).collect()
    check_pieces(found, docs, 256)
    assert all(crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length for r in found)


def test_packing_without_rows(none):
    assert packing.pack(none, WORD_BPE).count() == 0


def test_rank_in_a_hot_group(spark):
    d = spark.range(2000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', id % 7) END AS grp", "id AS v").repartition(5)
    got = defaultdict(list)
    for r in rank_within(d, "grp", ["v"]).collect():
        got[r.grp].append((r.v, r["rank"]))
    for rows in got.values():
        assert [k for _, k in sorted(rows)] == list(range(len(rows)))


def test_hot_join(spark):
    d = spark.range(500).selectExpr("id AS row", "CASE WHEN id < 300 THEN 'hot' WHEN id = 499 THEN NULL ELSE concat('k', id) END AS k")
    groups = d.filter("k IS NOT NULL").groupBy("k").count()
    got = {r.row: r.g and r.g["count"] for r in join_hot(d, groups, "k", "count", 500, "row", part=3).collect()}
    assert got == {i: 300 if i < 300 else None if i == 499 else 1 for i in range(500)}


# ---------------------------------------------------------------- op 3

def test_token_files_round_trip(spark, awkward):
    folder = scratch_path(spark, "test-sequences")
    manifest = token_files.write(awkward, folder, BYTE_BPE, shard_text=20_000).collect()
    assert len(manifest) > 2
    want, docs = library(BYTE_BPE), sorted(((r.doc_id, r.text) for r in awkward.collect()), key=lambda r: R.order(r[0]))
    found = sorted(token_files.read(spark, folder).collect(), key=lambda r: r.start)
    assert [r.id for r in found] == [i for i, _ in docs]
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    expect = Counter((i, len(x) + 1, crc([*x, 2])) for i, x in ((i, want(t)) for i, t in docs))
    assert Counter((r.id, r.n_tokens, r.ids_crc32) for r in found) == expect
    # random access: sequences and masks of one shard, against its documents in order
    m = max(manifest, key=lambda r: r.n_sequences)
    shard = token_files.Shard(folder, m.shard)
    assert shard.file.schema.field("tokens").type.list_size == token_files.SEQ_LEN
    tokens, mask = zip(*(shard.sequence(i) for i in range(m.n_sequences)), strict=True)
    flat = np.concatenate(tokens)[np.concatenate(mask)]
    assert len(flat) == m.n_tokens and np.concatenate(mask).sum() == m.n_tokens
    assert (flat == np.concatenate(list(shard.span(0, m.n_tokens)))).all()
    # views of the memory map: nothing is allocated, and the tokens can't be written to
    before = pa.total_allocated_bytes()
    view, bits = shard.batch(0), shard.mask(m.n_sequences - 1)
    assert pa.total_allocated_bytes() == before
    assert not view.flags.owndata and not view.flags.writeable
    assert bits.to_pylist() == mask[-1].tolist()


def test_id_width_is_checked(spark, none):
    assert token_files.id_width(65_535) == "<u2" and token_files.id_width(65_536) == "<u4"
    with pytest.raises(ValueError, match="doesn't fit"):
        token_files.id_width(65_536, "<u2")
    with pytest.raises(ValueError, match="doesn't fit"):
        token_files.write(none, scratch_path(spark, "test-sequences"), BYTE_BPE, width="<u1")
    folder = scratch_path(spark, "test-sequences")
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    token_files.write(docs, folder, BYTE_BPE, end_id=70_000)
    assert token_files.Shard(folder, 0).batch(0).dtype == np.uint32
    ids = [*library(BYTE_BPE)("some words"), 70_000]
    assert [(r.id, r.n_tokens, r.ids_crc32) for r in token_files.read(spark, folder).sort("id").collect()] == [(1, len(ids), crc(ids)), (2, 1, crc([70_000]))]


def test_token_files_without_rows(spark, none):
    folder = scratch_path(spark, "test-sequences")
    assert token_files.write(none, folder, BYTE_BPE).count() == 0
    assert token_files.read(spark, folder).count() == 0


# ---------------------------------------------------------------- op 8

def test_exact_dedup_batches(spark, awkward):
    table = f"test_index_{uuid.uuid4().hex}"
    first = exact_dedup.dedup_batch(awkward, table, "one", buckets=4).collect()
    groups = defaultdict(list)
    for r in awkward.collect():
        groups[(r.text or "").translate(R.LOWER)].append(r.doc_id)
    import hashlib

    by = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(first) == awkward.count()
    kept = Counter()
    for r in first:
        ids = by[r.digest]
        best = max(ids, key=R.order)
        assert r.keep_id == best and r.group_size == len(ids)
        assert not r.kept or r.id == best
        kept[r.digest] += r.kept
    assert set(kept.values()) == {1} and set(kept) == set(by)
    # a second batch: known texts go, new ones are appended
    more = spark.createDataFrame([(10_000, "brand NEW text"), (10_001, "Brand new text"), (10_002, "ONE"), (None, None)], "doc_id long, text string")
    second = {r.id: r for r in exact_dedup.dedup_batch(more, table, "two").collect()}
    assert [second[i].kept for i in (10_000, 10_001, 10_002, None)] == [False, True, False, False]
    assert second[10_002].keep_id == max(groups["one"]) and second[10_000].keep_id == 10_001
    assert spark.table(table).count() == len(by) + 1
    spark.sql(f"DROP TABLE {table}")


def test_exact_dedup_always_asks_the_index(spark, awkward, monkeypatch):
    """The first batch too is anti-joined with the bucketed index, which isn't shuffled."""
    plans = []
    real = exact_dedup.open_index

    def seen(spark, table, buckets):
        t = real(spark, table, buckets)
        plans.append(awkward.select(exact_dedup.digest(F.col("text")).alias("digest")).distinct().join(t.select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString())
        return t

    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "open_index", seen)
    table = f"test_index_{uuid.uuid4().hex}"
    exact_dedup.dedup_batch(awkward, table, "one").count()
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "LeftAnti" in plans[0] and "Bucketed: true" in plans[0]
    spark.sql(f"DROP TABLE {table}")


def test_exact_dedup_keeps_whole_rows(spark, awkward, none):
    table = f"test_index_{uuid.uuid4().hex}"
    kept = exact_dedup.keep_rows(awkward, table, "one")
    assert kept.columns == awkward.columns
    got = Counter((r.text or "").translate(R.LOWER) for r in kept.collect())
    assert set(got.values()) == {1} and set(got) == {(r.text or "").translate(R.LOWER) for r in awkward.collect()}
    empty = f"test_index_{uuid.uuid4().hex}"
    assert exact_dedup.dedup_batch(none, empty, "one").count() == 0
    for t in (table, empty):
        spark.sql(f"DROP TABLE {t}")


# ---------------------------------------------------------------- op 7

def test_jaccard_components(awkward):
    want = Counter(R.components([(r.doc_id, r.text) for r in awkward.collect()]))
    got = Counter((r.id, r.n_shingles, r.component_id) for r in ngram_join.cluster(awkward).collect())
    # an empty set is linked with nothing: its component is its own id
    assert got == want


def test_jaccard_chains_and_large_groups(spark, monkeypatch):
    """Near copies of near copies, in groups cut into many blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "BUCKET_TOKENS", 500)
    rnd, texts = random.Random(9), []
    for _ in range(4):
        w = R.prose(rnd, 120, 3000).split()
        for _ in range(40):
            texts.append(" ".join(w))
            if rnd.random() < 0.3:
                w = list(w)
                w[rnd.randrange(len(w))] = f"w{rnd.randrange(10_000)}"
            if rnd.random() < 0.2:
                w = w[: len(w) - rnd.randrange(12)] or w
    rnd.shuffle(texts)
    data = list(enumerate(texts))
    got = {(r.id, r.n_shingles, r.component_id) for r in ngram_join.cluster(spark.createDataFrame(data, "doc_id long, text string").repartition(5)).collect()}
    assert got == set(R.components(data))


def test_keep_one_of_each_group(awkward, none):
    want = R.components([(r.doc_id, r.text) for r in awkward.collect()])
    kept = ngram_join.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {i for i, n, c in want if n == 0 or i == c}
    assert ngram_join.cluster(none).count() == 0 and ngram_join.keep_one(none).count() == 0


def test_keep_one_counts_rows(spark, awkward):
    """One row of each component, and every row with an empty set."""
    parts = R.components([(k, r.text) for k, r in enumerate(awkward.collect())])  # a component's id is its own
    assert ngram_join.keep_one(awkward).count() == sum(n == 0 for _, n, _ in parts) + len({c for _, n, c in parts if n})
    rnd = random.Random(4)
    near = [R.prose(rnd, 120, 3000).split() for _ in range(3)]
    a, b, c = (" ".join(w) for w in near)
    a2, b2, c2 = (" ".join(w[:60] + ["zz"] + w[61:]) for w in near)
    # null ids; id 5 repeated, first of its component with b and a copy of c's; equal rows; empty sets
    data = [(None, a), (None, a2), (None, a), (5, b), (5, c2), (6, b2), (2, c), (2, c), (None, ""), (None, ""), (9, None)]
    d = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.text) for r in ngram_join.keep_one(d).collect())
    first = next(t for t in (a, a2) if (None, t) in got)
    assert got == Counter([(None, first), (5, b), (2, c), (None, ""), (None, ""), (9, None)])


def test_tree_shares_and_prunes_exactly():
    rnd = np.random.default_rng(4)
    for _ in range(60):
        base = np.sort(rnd.choice(4000, rnd.integers(1, 300), replace=False)).astype(np.uint64)
        sets = []
        for _ in range(12):
            s = set(base.tolist())
            for x in rnd.choice(base, rnd.integers(0, max(1, len(base) // 3) + 1)):
                s.discard(int(x))
            s |= set(rnd.integers(0, 4000, rnd.integers(0, 40)).tolist())
            sets.append(np.array(sorted(s), np.uint64))
        sets = [s for s in sets if len(s)]
        for s, i in zip(sets, ngram_join.tree_overlaps(base, sets), strict=True):
            exact = len(np.intersect1d(base, s))
            assert i == (exact if 100 * exact >= 80 * (len(base) + len(s) - exact) else -1)


def test_bitmaps_bound_the_difference():
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 5, 100, 130, 260, 300, 1000)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], rnd.integers(0, 1 << 62, 5).astype(np.uint64)])) for s in sets]
    maps = ngram_join.Maps(ngram_join.bitmaps(np.concatenate(sets), np.array([len(s) for s in sets])))
    for i in range(len(sets)):
        d = maps.distance(i, np.arange(len(sets)))
        assert all(d[j] <= len(np.setxor1d(sets[i], sets[j])) for j in range(len(sets))) and d[i] == 0


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 90) if i % 30] + [(200, 200 + i) for i in range(1, 50)] + [(rnd.randrange(500, 700), rnd.randrange(500, 700)) for _ in range(90)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_bloom_never_misses(spark):
    d = spark.range(0, 5000, 7)
    bloom = Bloom(d, "id")
    assert bloom.may_contain(np.arange(0, 5000, 7).view(np.uint64)).all()
    assert bloom.may_contain(np.arange(10**6, 10**6 + 5000).view(np.uint64)).mean() < 0.01


# ---------------------------------------------------------------- op 9

def pages(spark):
    rnd = random.Random(6)
    data = [(i, f"http://h/{i}", rnd.choice(["<p>same</p>", "<p>other</p>", f"<p>{i} é</p>", "", None]), i) for i in range(80)]
    data += [data[3], (3, "http://again", data[3][2], 1), (None, None, "<p>same</p>", 2), (200, "http://x/\r\na b", "<p>" + "long " * 20_000, 3), (201, None, "a\r\n\r\nb", 4)]
    return spark.createDataFrame(data, "page_id long, url string, html string, shard int").repartition(3)


def test_warc_round_trip(spark):
    import base64
    import hashlib

    d = pages(spark)
    folder = scratch_path(spark, "test-warc")
    manifest = warc.write(d, folder, shard_bytes=2000, roll_bytes=600).collect()
    assert len({m.shard for m in manifest}) > 1 and max(m.part for m in manifest) > 0
    found = warc.read(spark, folder).collect()
    groups = defaultdict(list)
    for r in d.collect():
        groups[(r.html or "").encode()].append(r.page_id)
    by = {base64.b32encode(hashlib.sha1(p).digest()).decode(): (len(p), ids) for p, ids in groups.items()}
    assert Counter(r.page_id for r in found) == Counter(r.page_id for r in d.collect())
    responses = Counter()
    for r in found:
        n, ids = by[r.payload_digest]
        first = min(ids, key=R.order)
        assert r.payload_bytes == n
        responses[r.payload_digest] += r.record_type == "response"
        assert r.page_id == first if r.record_type == "response" else r.refers_to == first
    assert set(responses.values()) == {1}
    # the same rows in other partitions give the same files
    again = warc.write(d.repartition(7), scratch_path(spark, "test-warc"), shard_bytes=2000, roll_bytes=600).collect()
    assert sorted(manifest) == sorted(again)


def test_warc_small_payloads_are_responses(spark):
    folder = scratch_path(spark, "test-warc")
    warc.write(pages(spark), folder, min_bytes=12)
    assert all(r.record_type == "response" for r in warc.read(spark, folder).collect() if r.payload_bytes < 12)


def test_warc_without_rows_and_damage(spark):
    folder = scratch_path(spark, "test-warc")
    assert warc.write(pages(spark).limit(0), folder).count() == 0
    assert warc.read(spark, folder).count() == 0
    with pytest.raises(ValueError, match="digest"):
        data = zlib.decompress(warc.record(1, "u", b"payload", warc.base32_sha1(b"payload"), None, 0), 31)
        warc.parse(data.replace(b"payload\r\n", b"PAYLOAD\r\n"))


# ---------------------------------------------------------------- op 10

def found_repeats(df) -> Counter:
    return Counter((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(df).collect())


def unique_ids(df):
    """Rows whose id isn't repeated with another text; those have one right result."""
    seen, out = set(), []
    for r in df.collect():
        if r.doc_id not in seen:
            seen.add(r.doc_id)
            out.append((r.doc_id, r.text))
    return out


def test_suffix_dedup(spark, awkward):
    data = unique_ids(awkward)
    assert found_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(4)) == R.repeats(data)


def test_suffix_dedup_of_repeated_rows(spark):
    text = R.prose(random.Random(2), 60)
    got = sorted((r.n_removed, r.n_spans) for r in suffix_dedup.dedup(spark.createDataFrame([(1, text)] * 3, "doc_id long, text string")).collect())
    assert got == [(0, 0), (len(text.encode()), 1), (len(text.encode()), 1)]


@pytest.mark.parametrize("hot", [3, 20_000])
def test_suffix_dedup_of_periodic_and_common_text(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_ANCHOR", hot)
    monkeypatch.setattr(suffix_dedup, "FLUSH_ANCHORS", 30 if hot == 3 else 400_000)
    rnd = random.Random(11)
    passage = R.prose(rnd, 40)
    data = [(i, R.prose(rnd, rnd.randrange(60), 50) + passage[rnd.randrange(20):] + R.prose(rnd, rnd.randrange(60), 50)) for i in range(40)]
    data += [(100, "a" * 700), (101, "ab" * 300), (102, "a" * 99), (103, "a" * 100), (104, "abc" * 200 + "a" * 150), (105, "é" * 120), (106, passage * 3)]
    assert found_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(3)) == R.repeats(data)


def test_suffix_dedup_returns_the_rest(spark, none):
    p = R.prose(random.Random(3), 40)
    d = spark.createDataFrame([(1, "x " + p), (2, "y " + p + " z")], "doc_id long, text string")
    kept = {r.id: bytes(r.kept).decode() for r in suffix_dedup.dedup(d, with_kept=True).collect()}
    assert kept[1] == "x " + p and kept[2] in ("y z", "y  z")
    assert suffix_dedup.dedup(none).count() == 0


def test_touching_windows_are_one_interval():
    rnd = random.Random(4)
    for _ in range(50):
        data = [(rnd.randrange(3), a := rnd.randrange(40), a + rnd.randrange(6)) for _ in range(rnd.randrange(12))]
        want = {(r, p) for r, a, z in data for p in range(a, z + 1)}
        row, first, last = (x.tolist() for x in suffix_dedup.join_windows(*(np.array([d[k] for d in data], np.int64) for k in range(3))))
        assert {(r, p) for r, a, z in zip(row, first, last, strict=True) for p in range(a, z + 1)} == want
        assert len(row) == sum((r, p - 1) not in want for r, p in want)


def test_a_frequent_passage_is_one_interval_a_text(spark, monkeypatch):
    """Interval rows don't grow with the windows of a passage, however frequent its anchors are."""
    rnd = random.Random(5)
    line = R.prose(rnd, 60, 5000)[:260]
    d = spark.createDataFrame([(i, f"{R.prose(rnd, 8)} {line} {R.prose(rnd, 8)}") for i in range(120)], "doc_id long, text string").coalesce(1)
    counts = {}
    for hot in (3, 20_000):
        monkeypatch.setattr(suffix_dedup, "HOT_ANCHOR", hot)
        texts, name = suffix_dedup.write_table(d, "doc_id", "text")
        wanted, filt = suffix_dedup.frequent_anchors(texts, 40_000, suffix_dedup.LENGTH)
        counts[hot] = suffix_dedup.segments(texts, wanted, filt, 2, suffix_dedup.LENGTH).filter("bucket = -1").count()
        spark.sql(f"DROP TABLE {name}")
    assert counts[3] <= 2 * 120 and counts[20_000] <= 12 * 120


def test_sorting_by_difference_cover():
    rnd = np.random.default_rng(8)
    for letters, n in ((2, 600), (1, 300), (4, 3000)):
        text = rnd.integers(0, letters, n).astype(np.uint8)
        text[n // 2:n // 2 + 150] = text[:150]
        start = rnd.permutation(n - 100)[:400]
        cls = suffix_dedup.equal_windows(text, start)
        want = [text[s:s + 100].tobytes() for s in start]
        assert len(set(zip(want, cls.tolist(), strict=True))) == len(set(want)) == len(set(cls.tolist()))


def test_long_documents_come_in_parts(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    b = pa.RecordBatch.from_pydict({"text": pa.array([data.tobytes()], pa.binary())})
    b = pa.RecordBatch.from_arrays([b.column(0)], names=["text"])
    whole, parts = Counter(), Counter()
    k, _, lo, hi, place, _ = suffix_dedup.anchors(data, np.array([0, len(data)]))
    for a in zip(k.tolist(), lo.tolist(), hi.tolist(), place.tolist(), strict=True):
        whole.update((a[0], w, a[3]) for w in range(a[1], a[2] + 1))
    for _, part, off, base in suffix_dedup.chunks(b, 700):
        k, _, lo, hi, place, _ = suffix_dedup.anchors(part, off)
        for a in zip(k.tolist(), lo.tolist(), hi.tolist(), place.tolist(), strict=True):
            parts.update((a[0], w + base, a[3] + base) for w in range(a[1], a[2] + 1))
    assert whole == parts and len(whole) == 4901


# ---------------------------------------------------------------- the pipeline

def test_pipeline_stages(spark, awkward, tmp_path):
    import corpus_pipeline

    folder = f"{tmp_path}/sf"
    awkward.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == awkward.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs.count())
    assert seen[1] < seen[0] and seen[2] < seen[1] and seen[3] <= seen[2]
    found = corpus_pipeline.STAGES[-1][1](spark, docs, folder).withColumnRenamed("doc_id", "id").collect()
    check_pieces(found, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    whole = corpus_pipeline.run(spark, folder)
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in whole.collect()) == Counter((r.id, r.start, r.ids_crc32) for r in found)


def test_pipeline_without_rows(spark, none, tmp_path):
    import corpus_pipeline

    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
