"""Quality rules, HTML extraction, PII, mixing: against brute force and planted cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import rows as R

from vachan.llm import html_extract, mixing, pii, quality, text_stats
from vachan.llm.common import slices


# ---------------------------------------------------------------- op 2

def test_statistics_match_brute_force(spark, awkward):
    want = Counter((r.doc_id, *R.stats(r.text)) for r in awkward.collect())
    got = Counter((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.score(awkward).collect())
    assert got == want


def test_base_rules_and_verdicts(awkward):
    for r in quality.score(awkward).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_clean_stay(spark):
    rnd = random.Random(1)
    data = [(i, R.prose(rnd, rnd.randrange(60, 400), 3000), "en", "hot") for i in range(400)]
    data += [(1000 + i, re.sub(r"(\w+)", lambda m: m[1] + rnd.choice(["###", "$$$", "%%%"]), R.prose(rnd, 100, 3000)), "en", "hot") for i in range(60)]
    d = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    verdict = {r.id: r.kept for r in quality.score(d).collect()}
    assert all(verdict[i] for i in range(400))
    assert not any(verdict[1000 + i] for i in range(60))
    kept = quality.keep_clean(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, k in sorted(verdict.items()) if k]


def test_one_statistic_alone_rejects(spark):
    rnd = random.Random(2)
    clean = [R.prose(rnd, rnd.randrange(60, 400), 3000) for _ in range(400)]

    def line(n):
        return R.prose(rnd, n, 3000).replace("\n", "")

    def half_again(t):
        w = t.split()
        return " ".join(w[:20] + w[20:80] + w[:20])

    planted = {
        "words": lambda: re.sub(r"(\w+)", r"\1xx", line(100)),
        "symbols": lambda: " ".join(w + "#" * (i % 10 == 0) for i, w in enumerate(line(100).split())),
        "lines": lambda: "".join(f"again\n{line(8)}\n" for _ in range(12)),
        "repeats": lambda: half_again(line(80)),
    }
    data = [(i, t, "en", "hot") for i, t in enumerate(clean)]
    data += [(1000 * k + i, make(), "en", "hot") for k, make in enumerate(planted.values(), 1) for i in range(20)]
    d = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    found = quality.score(d).collect()
    assert not any(r.base_failed for r in found)
    kept = Counter(r.id // 1000 for r in found if r.kept)
    assert kept == Counter({0: 400})


def brute_mcd(x, starts=200):
    """Minimum covariance determinant over many random starts, exact nearest sets."""
    rnd, floor = np.random.default_rng(0), np.diag(np.array(list(quality.FLOORS.values())) ** 2)
    h, best = int(np.ceil(quality.SUPPORT * len(x))), (np.inf, None, None)

    def estimate(rows):
        return rows.mean(0), quality.CONSISTENCY * np.cov(rows.T, bias=True) + floor

    for _ in range(starts):
        m, c = estimate(x[rnd.choice(len(x), 6, replace=False)])
        last = np.inf
        while True:
            d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            m2, c2 = estimate(x[np.argsort(d2, kind="stable")[:h]])
            det = np.linalg.slogdet(c2)[1]
            if det >= last - 1e-12:
                break
            m, c, last = m2, c2, det
        if last < best[0]:
            best = (last, m, c)
    return best


def test_verdicts_match_brute_force_mcd(spark):
    rnd = random.Random(5)

    def doc(i):
        t = R.prose(rnd, rnd.randrange(60, 500), 2000)
        if i % 10 == 0:  # symbols
            t = re.sub(r"(\w+)", lambda m: m[1] + "#" * (rnd.random() < 0.05 * (1 + i % 4)), t)
        if i % 7 == 0:  # repeated lines
            t += "\nagain and again\n" * (i % 5)
        return t

    d = spark.createDataFrame([(i, doc(i), "en", "ab"[i % 3 == 0]) for i in range(600)], "doc_id long, text string, lang string, source string")
    found = quality.score(d).collect()
    for source in "ab":
        rows = [r for r in found if ("ab"[r.id % 3 == 0]) == source and not r.base_failed]

        def logit(k, n):
            s = k / max(n, 1)
            return np.log((s + quality.NEAR_ZERO) / (1 + quality.NEAR_ZERO - s))

        x = np.array([[np.log(max(r.word_chars, 1) / r.n_words), np.log1p(10 * r.n_symbols / r.n_words), logit(r.n_dup_lines, r.n_lines), logit(r.n_repeat_words, r.n_words)] for r in rows])
        x = np.round(x * quality.GRID) / quality.GRID
        _, m, c = brute_mcd(x)
        d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        assert (d2 > quality.CUTOFF).sum() >= 5
        for r, want in zip(rows, d2, strict=True):
            if not 0.9 < want / quality.CUTOFF < 1.1:
                assert r.kept == (want <= quality.CUTOFF)


def test_quality_without_rows(none):
    assert quality.score(none).count() == 0
    assert quality.keep_clean(none).columns == none.columns
    assert quality.keep_clean(none).count() == 0


def test_chi_square():
    assert abs(quality.chi2_cdf(quality.chi2_quantile(0.95, 4), 4) - 0.95) < 1e-9
    assert abs(quality.chi2_quantile(0.95, 4) - 9.4877) < 1e-3


# ---------------------------------------------------------------- op 4

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/x>Menu</a></nav><div class="cookie-notice">We use cookies.</div>
<article><h1>Head &amp; line</h1><p>First <b>bo</b>ld   text, with a line.<br>More<p>Second &lt;para&gt; here. <script>var x="</p>";</script>And on.
<aside>Related story</aside><ul><li>one<li>two</ul></article><div id="sidebar">Latest: much longer running text, and more of it. Yes, more.</div>
<section class="comments"><p>Great post, I love it!</p></section><form>Mail <input></form><footer>&copy; us</footer></body></html>"""


def test_article_text():
    assert html_extract.extract(PAGE) == "Head & line First bold text, with a line. More Second <para> here. And on. one two"


def test_pages_without_article_use_ratios():
    page = ("<body><div class='header'>Site</div><ul class='menu'><li><a>Home</a><li><a>News</a></ul><div class='content'><h2>Title</h2>"
            + "<p>A paragraph of text, long enough to count. It goes on, and on.</p>" * 3 + "</div><div><a href=1>Link one</a> <a href=2>Link two</a></div></body>")
    text = html_extract.extract(page)
    assert text.startswith("Title A paragraph") and text.count("paragraph") == 3
    assert "Home" not in text and "Link one" not in text and "Site" not in text


def test_layout_classes_do_not_drop_content():
    assert html_extract.extract("<body class='no-js has-sidebar'><div class='content with-sidebar'><p>Kept, all of it.</p></div><div class='sidebar'>gone</div>") == "Kept, all of it."


def test_long_text_outside_wins_over_a_teaser():
    body = [f"Paragraph {i} of the main text, which runs on for a while; it has commas, and it ends here." for i in range(4)]
    page = "<article class=card><h3>Read more here. Go.</h3></article><div class=x1>" + "".join(f"<p>{b}</p>" for b in body) + "</div>"
    text = html_extract.extract(page)
    assert text.endswith(" ".join(body))


def test_deep_pages_keep_their_text():
    for depth in (450, 3000):
        page = "<div>" * depth + "<article><p>First paragraph, in full.</p>" + "</div>" * 0 + "<section>" * depth + "x" + "</section>" * depth + "<p>Second paragraph, in full.</p></article>" + "</div>" * depth
        assert html_extract.extract(page) == "First paragraph, in full. x Second paragraph, in full."
    page = "<div>" * 450 + "<article><p>First paragraph, in full.</p>" + "<div>" * 40 + "</div>" * 40 + "<p>Second paragraph, in full.</p></article>"
    assert html_extract.extract(page) == "First paragraph, in full. Second paragraph, in full."


def opaque_page(rnd: random.Random, k: int) -> tuple[str, str]:
    """A page without article, main or telling names: (html, its main text)."""
    def sentence(n):
        return (" ".join(R.prose(rnd, n).split()) + ".").capitalize()

    body = [", ".join(sentence(rnd.randrange(8, 20)) for _ in range(rnd.randrange(2, 6))) for _ in range(rnd.randrange(4, 12))]
    title = " ".join(R.prose(rnd, 5).split())
    links = "".join(f"<li><a href=/{i}>{R.prose(rnd, 1)}</a></li>" for i in range(9))
    page = (f"<body><div class=k{k}><ul>{links}</ul></div><div class=z{k}><span>{R.prose(rnd, 3)}</span></div><div class=q{k}><h1>{title}</h1>" + "".join(f"<p>{b}</p>" for b in body)
            + f"<ul><li>{title}</ul></div><div class=r{k}><a href=/t>{R.prose(rnd, 2)}</a> {R.prose(rnd, 2)}</div></body>")
    return page, " ".join([title, *(" ".join(b.split()) for b in body), title])


def test_ratios_decide_without_names(monkeypatch):
    """With every list of names emptied, the text still comes out and the rest doesn't."""
    for n in ("DROP_NAMES", "DROP_ROLES", "DROP_WORDS", "TOP_WORDS", "CONTENT_NAMES"):
        monkeypatch.setattr(html_extract, n, set())
    rnd = random.Random(21)
    for k in range(60):
        page, text = opaque_page(rnd, k)
        assert html_extract.extract(page) == text


def test_ratios_by_brute_force():
    """Ratios, smoothing and fusion of a page, worked out block by block."""
    import math

    page, _ = opaque_page(random.Random(4), 1)
    found = html_extract.blocks(page)
    got = html_extract.ratios(found)
    full = {id(b): "".join(b.text) for b in found}

    def own(path):
        mine = [b for b in found if b.path == path]
        n, chars = len(mine), sum(len(full[id(b)]) for b in mine)
        marks, linked = sum(len(re.findall(r"[.,;:!?]", full[id(b)])) for b in mine), sum(b.linked for b in mine)
        return 0.0 if linked > 0.6 * chars else math.log1p(chars / n) * (1 + math.log1p(marks / n)) * (1 - linked / chars)

    def chars(paths):
        return sum(len(full[id(b)]) for b in found if b.path in paths)

    paths = {b.path for b in found}
    tops = {p[0] for p in paths}
    for p in paths:
        f = own(p)
        for d in range(1, len(p)) if f else ():
            below = {q for q in paths if q[:d] == p[:d]}
            f = max(f, max(0.6, 0.9 ** (len(p) - d)) * sum(own(q) * chars({q}) for q in below) / chars(below))
        share = chars({q for q in paths if q[0] == p[0]}) / max(chars({q for q in paths if q[0] == t}) for t in tops)
        assert math.isclose(got[p, False, False], f * share ** 0.3, rel_tol=1e-9)


@pytest.mark.parametrize(("page", "text"), [("", ""), ("   ", ""), ("just text", "just text"), ("<article>a &am b", "a &am b"), ("<article><p>cut off &quo", "cut off &quo"),
                                            ("<article>a<!-- b", "a"), ("<article>x <a href='y>z'>w</a>", "x w"), ("<p>a &nbsp; b", "a b"), ("<script>never closed", "")])
def test_small_pages(page, text):
    assert html_extract.extract(page) == text


def test_pages_table(spark):
    d = spark.createDataFrame([(1, "u", PAGE, 7), (1, "u", PAGE, 7), (2, None, None, 8), (None, "v", "", 9)], "page_id long, url string, html string, text int")
    got = Counter((r.id, r.url, r.text) for r in html_extract.extract_pages(d).collect())
    assert got == Counter([(1, "u", html_extract.extract(PAGE))] * 2 + [(2, None, ""), (None, "v", "")])
    assert html_extract.extract_pages(d.limit(0)).count() == 0


def test_long_pages_are_linear():
    for page in ("<" * 200_000, "<div>" * 40_000 + "x", "<div>" * 40_000 + "</p></li></b>" * 20_000, "<div><li><p>" * 9_000 + "x<a>" * 9_000, "<a " * 60_000, "<p>x" * 40_000, "&" * 200_000):
        html_extract.extract(page)


# ---------------------------------------------------------------- op 5

def base_spans(text):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2]) and (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    kinds = ["email", "ip", "card", "phone"]
    return sorted(out, key=lambda s: (s[0], kinds.index(s[2])))


@pytest.mark.parametrize("letters", ["aZ09.@+-%_ ()é\n0123456789", "0123. @a", "4111 -+()"])
def test_plain_identifiers_match_the_patterns(letters):
    rnd = random.Random(letters)
    for _ in range(20_000):
        t = "".join(rnd.choice(letters) for _ in range(rnd.randrange(70)))
        assert pii.plain(t) == base_spans(t), t


@pytest.mark.parametrize(("text", "found"), [
    ("mail john.doe [at] example [dot] com now", ["john.doe [at] example [dot] com"]),
    ("write john(at)example.com", ["john(at)example.com"]),
    ("jane at mail dot example dot org please", ["jane at mail dot example dot org"]),
    ("аdmin@exаmple.com", ["аdmin@exаmple.com"]),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", ["ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"]),
    ("john​@exam​ple.com", ["john​@exam​ple.com"]),
    ("+１ (555) ٥٥٥-1234 x", ["+１ (555) ٥٥٥-1234"]),
    ("call five five five one two three four five six seven today", ["five five five one two three four five six seven"]),
    ("one nine two dot one six eight dot zero dot one", ["one nine two dot one six eight dot zero dot one"]),
    ("４１１１-1111-1111-1111", ["４１１１-1111-1111-1111"]),
    ("we looked at the dot on it", []),
    ("one or two of three were at home", []),
    ("café élève at Zürich; the point is made", []),
])
def test_disguises_map_back(text, found):
    base, both = pii.scan(text)
    assert set(base) <= set(both)
    assert [text[a:b] for a, b, _ in both] == found


@pytest.mark.parametrize(("text", "base", "more"), [
    ("to \u0430dmin@example.com now", ["dmin@example.com"], ["\u0430dmin@example.com"]),
    ("to admin@example.com\u2024au now", ["admin@example.com"], ["admin@example.com\u2024au"]),
    ("+1 555 123 456\uff17 x", ["+1 555 123 456"], ["+1 555 123 456\uff17"]),
    ("10.0.0.1\uff12 x", ["10.0.0.1"], ["10.0.0.1\uff12"]),
    ("jane dot doe at example dot com", [], ["jane dot doe at example dot com"]),
    ("ask j dot r dot doe [at] example [dot] com", [], ["j dot r dot doe [at] example [dot] com"]),
    ("jane punto doe arroba example punto com", [], ["jane punto doe arroba example punto com"]),
    ("jane dot doe@example.com", ["doe@example.com"], ["jane dot doe@example.com"]),
    ("at this point doe@example.com wrote", ["doe@example.com"], []),
    ("one zero dot zero dot zero dot one", [], ["one zero dot zero dot zero dot one"]),
    ("is one dot two dot three dot four up", [], ["one dot two dot three dot four"]),
    ("one zero [dot] zero [dot] zero [dot] one", [], ["one zero [dot] zero [dot] zero [dot] one"]),
    ("one. two. three. four", [], []),
    ("nine nine nine dot one dot one dot one", [], []),
    ("one dot two and three dot four", [], []),
])
def test_disguises_beyond_plain_spans(text, base, more):
    found, both = pii.scan(text)
    assert [text[a:b] for a, b, _ in found] == base
    assert [text[a:b] for a, b, _ in sorted(set(both) - set(found))] == more
    assert set(found) <= set(both)
    for t in base + more:
        assert t not in pii.mask(text, both)


def test_mask_covers_overlapping_spans():
    text = "+1 555 123 456\uff17 x"
    assert pii.mask(text, pii.scan(text)[1]) == "<phone> x"


def test_spaced_dots_are_linear():
    for t in ("a dot " * 50_000 + "b@c.de", "a dot b@c.de " * 20_000, " " * 200_000 + "dot b@c.de", "one dot " * 30_000 + "one two"):
        pii.scan(t)


def test_pii_table(spark, awkward):
    d = awkward.select("doc_id", "text").union(spark.createDataFrame([(900, "x a.b@c.de 10.0.0.1 +1 (555) 123-4567 4111 1111 1111 1111")], "doc_id long, text string"))
    got = {(r.id, r.base, r.spans) for r in pii.find(d).collect()}
    assert got == {(r.doc_id, pii.spell(base_spans(r.text or "")), pii.spell(pii.scan(r.text or "")[1])) for r in d.collect()}
    assert pii.find(d.limit(0)).count() == 0
    assert pii.mask("to a@b.co now", pii.scan("to a@b.co now")[1]) == "to <email> now"


# ---------------------------------------------------------------- op 6

def want_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Water-filling, step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        t = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if t[s] > cap * sizes[s]]
        if not over:
            out |= t
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def test_mix_hits_targets(awkward):
    found = mixing.mix(awkward, block=20).collect()
    sizes = Counter()
    for r in awkward.collect():
        sizes[r.source] += len(R.words(r.text))
    want = want_targets(sizes)
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert Counter((r.id, r.size) for r in found) == Counter((r.doc_id, len(R.words(r.text))) for r in awkward.collect())
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1
    again = mixing.mix(awkward.repartition(7), block=20).collect()
    assert Counter((r.id, r.size, r.taken) for r in again) == Counter((r.id, r.size, r.taken) for r in found)


def test_rounding_is_fair():
    import pandas as pd

    rnd, total, runs = np.random.default_rng(3), np.zeros(40), 600
    size = rnd.integers(1, 50, 40)
    for _ in range(runs):
        f = pd.DataFrame({"row": range(40), "key": range(40), "source": "a", "size": size, "p": 0.3, "u": rnd.random(40), "node": 0, "settled": False})
        out = mixing.settle(f).sort_values("row")
        assert (~out["settled"]).sum() <= 1
        assert abs((out["p"] * out["size"]).sum() - 0.3 * size.sum()) < 1e-6
        total += out["p"].to_numpy()
    assert abs(total / runs - 0.3).max() < 0.09


def test_expanded_mix_has_whole_texts(awkward):
    """Each document as often as its share says, the one with a part by a draw; no text is cut."""
    mixed = mixing.mix(awkward, block=20).collect()
    docs = mixing.expand(awkward, mixing.mix(awkward, block=20))
    assert docs.columns == awkward.columns
    got = Counter((r.doc_id, r.text) for r in docs.collect())
    given = Counter((r.doc_id, r.text) for r in awkward.collect())
    assert set(got) <= set(given)
    least, most, size = Counter(), Counter(), {}
    for r in mixed:
        least[r.id] += r.whole
        most[r.id] += r.whole + (r.part > 0)
    for i in given:
        size[i[0]] = size.get(i[0], 0) + got[i]
    assert all(least[i] <= n <= most[i] for i, n in size.items())
    assert sum(r.part > 0 for r in mixed) <= len({r.source for r in mixed})


def test_the_last_part_is_drawn_fairly(spark):
    from pyspark.sql import functions as F

    mixed = spark.range(4000).select(F.col("id"), F.col("id").alias("tie"), F.lit(0).cast("long").alias("whole"), F.lit(30).cast("long").alias("part"), F.lit(100).cast("long").alias("size"))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    mixed = mixed.withColumn("tie", F.xxhash64(F.col("id").cast("string")))
    assert 1080 < mixing.expand(docs, mixed).count() < 1320


def test_stages_keep_columns_of_any_name(spark, awkward):
    """Every name that the stages use inside, as a column of the table."""
    import uuid

    from pyspark.sql import functions as F

    from vachan.llm import exact_dedup, ngram_join

    names = ["__id", "__d", "__t", "__k", "__n", "__ns", "__tie", "__many", "__row", "__cut", "whole", "times", "shares", "copy", "tie", "mark", "kept", "copies", "a.b", "last", "rank", "c", "g_1"]
    d = awkward.select("doc_id", "text", "lang", "source", "n_chars", "row", "key", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    given = Counter(tuple(r) for r in d.collect())
    index = f"test_index_{uuid.uuid4().hex}"
    for out in (quality.keep_clean(d), exact_dedup.keep_rows(d, index, "one"), ngram_join.keep_one(d), mixing.expand(d, mixing.mix(d))):
        assert out.columns == d.columns
        rows = [tuple(r) for r in out.collect()]
        assert rows and set(rows) <= set(given)
    spark.sql(f"DROP TABLE {index}")


def test_mix_without_rows(none):
    assert mixing.mix(none).count() == 0
    assert mixing.expand(none, mixing.mix(none)).count() == 0


def test_slices_cover_long_and_null_texts():
    import pyarrow as pa

    b = pa.RecordBatch.from_pydict({"text": ["a" * 50, None, "", "b" * 5, "c" * 90, "d"]})
    parts = list(slices(b, "text", 40))
    assert sum(p[0].num_rows for p in parts) == 6
    assert b"".join(p[1].tobytes() for p in parts) == b"a" * 50 + b"b" * 5 + b"c" * 90 + b"d"
    assert text_stats.stats(np.zeros(0, np.uint8), np.array([0, 0, 0]))["n_words"].tolist() == [0, 0]
