"""DuckDB oracle SQL for the registered queries.

Each oracle restates the query in plain SQL over the driver views.  Word edit
distance is an anti-diagonal dynamic programme in a recursive CTE: every step
computes one whole diagonal with ``list_transform`` (cells on a diagonal do
not depend on each other), and ``USING KEY`` keeps only the last two
diagonals per pair.  Regular expressions use RE2 syntax that is also valid
Java syntax; where Java needs look-around, the oracle consumes the boundary
characters instead (see ``sql_rewrite``).
"""

from __future__ import annotations

from vachan.functions import text as TX
from vachan.plans import derived as D

lit = D.sql_lit
BIG = "1000000000"


def edit_cte(name: str, pairs: str) -> str:
    """CTEs ``{name}_dp`` and ``{name}(pid, edits)`` over ``pairs(pid, a, b)``."""
    return f"""{name}_dp(pid, d, cur, prev) USING KEY (pid) AS (
  SELECT pid, 0, list_transform(range(0, len(a) + 1), lambda i: CASE WHEN i = 0 THEN 0 ELSE {BIG} END),
         []::BIGINT[] FROM {pairs}
  UNION ALL
  SELECT x.pid, x.d + 1,
    list_transform(range(0, len(p.a) + 1), lambda i:
      CASE WHEN x.d + 1 - i < 0 OR x.d + 1 - i > len(p.b) THEN {BIG}
           WHEN i = 0 OR x.d + 1 - i = 0 THEN x.d + 1
           ELSE least(x.cur[i] + 1, x.cur[i + 1] + 1,
                      x.prev[i] + CASE WHEN p.a[i] = p.b[x.d + 1 - i] THEN 0 ELSE 1 END) END),
    x.cur
  FROM {name}_dp x JOIN {pairs} p ON x.pid = p.pid WHERE x.d < len(p.a) + len(p.b)
),
{name} AS (SELECT x.pid, x.cur[len(p.a) + 1] AS edits FROM {name}_dp x JOIN {pairs} p ON x.pid = p.pid)"""


def jiwer_words_sql(expr: str) -> str:
    ws = TX.WS
    x = f"regexp_replace(coalesce({expr}, ''), {lit(ws + '{2,}')}, ' ', 'g')"
    x = f"regexp_replace({x}, {lit('^' + ws + '+|' + ws + '+$')}, '', 'g')"
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


BASE = f"WITH RECURSIVE utt AS ({D.SQL_UTT}), sys AS ({D.SQL_SYSTEMS})"

# Per (segment, system) plain scores: pid = segment_id*10 + m.
SYS_SCORES = (BASE + ",\nsys_pairs AS (SELECT segment_id*10+m AS pid, segment_id, m, system, ref AS a, hyp AS b FROM sys),\n"
              + edit_cte("sys_ed", "sys_pairs") + ",\n"
              "plain AS (SELECT p.segment_id, p.m, p.system, e.edits, len(p.a) AS n FROM sys_pairs p JOIN sys_ed e ON e.pid = p.pid)\n")

CORPUS_WER = SYS_SCORES + """SELECT sum(edits) AS total_edits, sum(n) AS total_words,
  round(CASE WHEN sum(n) > 0 THEN sum(edits) / sum(n) ELSE 0.0 END, 6) AS wer FROM plain"""

SYSTEM_WER = SYS_SCORES + """SELECT system, sum(edits) AS total_edits, sum(n) AS total_words,
  round(CASE WHEN sum(n) > 0 THEN sum(edits) / sum(n) ELSE 0.0 END, 6) AS wer FROM plain GROUP BY system"""

RESULTS = (BASE + f",\nres AS ({D.SQL_RESULTS}),\n"
           f"res_pairs AS (SELECT idx AS pid, idx, reference, hypothesis, {jiwer_words_sql('reference')} AS a, "
           f"{jiwer_words_sql('hypothesis')} AS b FROM res),\n"
           + edit_cte("res_ed", "res_pairs") + ",\n"
           "scored AS (SELECT p.idx, p.reference, p.hypothesis, "
           "CASE WHEN len(p.a) > 0 THEN round(e.edits * 100.0 / len(p.a), 2) END AS wer "
           "FROM res_pairs p JOIN res_ed e ON e.pid = p.pid),\n"
           "tiered AS (SELECT *, CASE WHEN wer IS NULL OR isnan(wer) THEN 'high' WHEN wer <= 0 THEN 'correct' "
           "WHEN wer <= 15 THEN 'low' WHEN wer <= 50 THEN 'medium' ELSE 'high' END AS tier FROM scored)\n")

UTTERANCE_WER = RESULTS + "SELECT idx, reference, hypothesis, wer FROM scored"

TIER_COUNTS = RESULTS + "SELECT tier, count(*) AS n FROM tiered GROUP BY tier"

TIER_SAMPLE = RESULTS + """, errs AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY idx) - 1 AS i,
   count(*) OVER (PARTITION BY tier) AS c FROM tiered WHERE tier <> 'correct'),
samp AS (SELECT * FROM errs WHERE i % greatest(1, c // 10) = 0 AND i // greatest(1, c // 10) < 10)
SELECT CAST(row_number() OVER (ORDER BY idx) AS INTEGER) AS sample_id, idx, tier,
  CASE tier WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 END AS severity_rank,
  wer, reference, hypothesis FROM samp"""


ORACLES = {
    "corpus_wer": CORPUS_WER,
    "system_wer": SYSTEM_WER,
    "utterance_wer": UTTERANCE_WER,
    "tier_counts": TIER_COUNTS,
    "tier_sample": TIER_SAMPLE,
}


# ── canonicalisation, cleaning, tagging ──────────────────────────────────────

NW = r"[^\p{L}\p{N}_]"


def _is_word_char(ch: str) -> bool:
    import unicodedata
    return ch == "_" or unicodedata.category(ch)[0] in "LN"


def _sentinelled(s: str) -> str:
    """SQL expression for ``s`` with chr(1) after every non-word character."""
    parts, buf = [], ""
    for ch in s:
        buf += ch
        if not _is_word_char(ch):
            parts.append(lit(buf))
            parts.append("chr(1)")
            buf = ""
    if buf:
        parts.append(lit(buf))
    return " || ".join(parts) if parts else "''"


def sql_rewrite(expr: str, pairs) -> str:
    """Whole-token rewrites with one left-to-right pass each, exactly.

    RE2 has no look-around, so the boundary characters are consumed.  A
    sentinel (chr(1), itself a non-word character) after every non-word
    character gives each match its own left boundary, so two matches never
    compete for one separator; the sentinels are removed at the end.
    """
    x = f"regexp_replace({expr}, {lit('(' + NW + ')')}, '\\1' || chr(1), 'g')"
    for variant, canon in pairs:
        pat = f"{lit('(^|' + NW + ')' + chr(92) + 'Q')} || {_sentinelled(variant)} || {lit(chr(92) + 'E(' + NW + '|$)')}"
        rep = f"'\\1' || {_sentinelled(canon)} || '\\2'"
        x = f"regexp_replace({x}, {pat}, {rep}, 'g')"
    return f"replace({x}, chr(1), '')"


def sql_canonicalise(expr: str, convert_number_words: bool = False) -> str:
    from vachan.functions import lexicon as L
    x = f"trim(regexp_replace({expr}, {lit(TX.WS + '+')}, ' ', 'g'))"
    x = f"translate({x}, {lit(L.DEVANAGARI_DIGITS)}, {lit(L.ASCII_DIGITS)})"
    x = sql_rewrite(x, L.ORDINAL_REWRITES)
    if convert_number_words:
        x = sql_rewrite(x, L.NUMBER_WORD_REWRITES)
    x = sql_rewrite(x, L.SCHWA_REWRITES)
    return f"trim({x})"


def sql_clean_transcript(expr: str) -> str:
    x = f"regexp_replace({expr}, {lit(TX.MARKUP)}, '', 'g')"
    x = f"regexp_replace({x}, {lit(TX.NOT_SCRIPT)}, ' ', 'g')"
    return f"coalesce(trim(regexp_replace({x}, {lit(TX.WS + '+')}, ' ', 'g')), '')"


def before_after_sql(results: str, numbers: bool = False) -> str:
    """CTE ``ba``: scores of ``results`` before and after canonicalisation."""
    r1, h1 = (sql_canonicalise(f"coalesce({c}, '')", numbers) for c in ("reference", "hypothesis"))
    return (BASE + f",\nres AS ({results}),\n"
            f"canon AS (SELECT idx, reference, hypothesis, coalesce(reference, '') AS r0, coalesce(hypothesis, '') AS h0, "
            f"{r1} AS r1, {h1} AS h1 FROM res),\n"
            f"pb AS (SELECT idx AS pid, {jiwer_words_sql('r0')} AS a, {jiwer_words_sql('h0')} AS b FROM canon),\n"
            f"pa AS (SELECT idx AS pid, {jiwer_words_sql('r1')} AS a, {jiwer_words_sql('h1')} AS b FROM canon),\n"
            + edit_cte("eb", "pb") + ",\n" + edit_cte("ea", "pa") + ",\n"
            "ba AS (SELECT c.idx, c.reference, c.hypothesis,\n"
            "  CASE WHEN len(pb.a) > 0 THEN round(eb.edits * 100.0 / len(pb.a), 2) END AS wer_before_norm,\n"
            "  CASE WHEN len(pa.a) > 0 THEN round(ea.edits * 100.0 / len(pa.a), 2) END AS wer_after_norm\n"
            "  FROM canon c JOIN pb ON pb.pid = c.idx JOIN eb ON eb.pid = c.idx JOIN pa ON pa.pid = c.idx JOIN ea ON ea.pid = c.idx)\n")


BEFORE_AFTER = before_after_sql(D.SQL_RESULTS)
HINDI_BEFORE_AFTER = before_after_sql(D.SQL_HINDI, True)
HINDI = f"WITH utt AS ({D.SQL_UTT}), res AS ({D.SQL_HINDI})"

WER_BEFORE_AFTER = BEFORE_AFTER + ("SELECT idx, reference, hypothesis, wer_before_norm, wer_after_norm, "
                                   "round(wer_before_norm - wer_after_norm, 2) AS wer_delta FROM ba")

NORM_SUMMARY = BEFORE_AFTER + ("SELECT round(avg(wer_before_norm), 6) AS avg_wer_before, round(avg(wer_after_norm), 6) AS avg_wer_after, "
                               "round(avg(wer_before_norm) - avg(wer_after_norm), 6) AS reduction_pp FROM ba")

CLEAN_TEXT = f"SELECT page_id, {sql_clean_transcript('html')} AS cleaned FROM pages"

DIGIT_MAP = ("SELECT doc_id, md5(translate(text, " + lit("०१२३४५६७८९") + ", '0123456789')) AS text_md5, "
             "length(translate(text, " + lit("०१२३४५६७८९") + ", '0123456789')) AS n_chars FROM documents")


def _doc_rewrites():
    from vachan.plans.queries import DOC_REWRITES
    return DOC_REWRITES


TOKEN_REWRITE = ("SELECT doc_id, md5(" + sql_rewrite("text", _doc_rewrites()) + ") AS text_md5, "
                 "length(" + sql_rewrite("text", _doc_rewrites()) + ") AS n_chars FROM documents")

URL_REWRITE = (f"WITH utt AS ({D.SQL_UTT}) SELECT segment_id, url, "
               "CASE WHEN regexp_matches(url, '/([0-9]+)/([0-9]+)_') THEN "
               "'https://storage.example/upload/' || regexp_extract(url, '/([0-9]+)/([0-9]+)_', 1) || '/' || "
               "regexp_extract(url, '/([0-9]+)/([0-9]+)_', 2) || '_audio.wav' END AS audio_url, "
               "CASE WHEN regexp_matches(url, '/([0-9]+)/([0-9]+)_') THEN "
               "'https://storage.example/upload/' || regexp_extract(url, '/([0-9]+)/([0-9]+)_', 1) || '/' || "
               "regexp_extract(url, '/([0-9]+)/([0-9]+)_', 2) || '_transcription.json' END AS transcript_url, "
               "CASE WHEN NOT regexp_matches(url, '/([0-9]+)/([0-9]+)_') THEN 'unparsable url' END AS reject_reason "
               "FROM utt")

SPLIT_USERS = ("WITH u AS (SELECT DISTINCT user_id FROM events), "
               "r AS (SELECT user_id, row_number() OVER (ORDER BY md5('42|' || CAST(user_id AS VARCHAR)), user_id) - 1 AS rk, "
               "count(*) OVER () AS n FROM u), "
               "s AS (SELECT user_id, CASE WHEN rk < ceil(n * 0.1) THEN 'validation' ELSE 'train' END AS split FROM r) ")

SPEAKER_SPLIT = SPLIT_USERS + "SELECT user_id, split FROM s"

SPLIT_COUNTS = (SPLIT_USERS + "SELECT s.split, count(*) AS n_rows, count(DISTINCT e.user_id) AS n_users "
                "FROM events e JOIN s ON e.user_id = s.user_id GROUP BY s.split")

MANIFEST_TOTALS = ("SELECT count(*) AS recordings, round(sum(value) / 3600.0, 6) AS hours, "
                   "count(DISTINCT user_id) AS speakers FROM events")


def _tag_parts_sql(text: str) -> str:
    """X2 as a DuckDB list of ``{out, word}`` structs for one text expression."""
    from vachan.functions import lexicon as L
    lex = "[" + ", ".join(lit(w) for w in L.LOANWORDS) + "]"
    shell = TX.SHELL
    core = f"regexp_replace(regexp_replace(t, {lit('^' + shell + '+')}, ''), {lit(shell + '+$')}, '')"
    pre = f"regexp_extract(t, {lit('^' + shell + '*')}, 0)"
    suf = f"regexp_extract(regexp_replace(t, {lit('^' + shell + '+')}, ''), {lit(shell + '*$')}, 0)"
    eng = f"(regexp_matches({core}, {lit(TX.latin_class())}) OR list_contains({lex}, {core}))"
    toks = f"regexp_extract_all(coalesce({text}, ''), {lit(TX.NON_WS + '+')}, 0)"
    return (f"list_transform({toks}, lambda t: {{'out': CASE WHEN {eng} THEN {pre} || '[EN]' || {core} || '[/EN]' || {suf} "
            f"ELSE t END, 'word': CASE WHEN {eng} THEN {core} END}})")


def _code_switch_sql() -> str:
    from vachan.functions import lexicon as L
    lex = "[" + ", ".join(lit(w) for w in L.LOANWORDS) + "]"
    shell = TX.SHELL
    core = f"regexp_replace(regexp_replace(t, {lit('^' + shell + '+')}, ''), {lit(shell + '+$')}, '')"
    pre = f"regexp_extract(t, {lit('^' + shell + '*')}, 0)"
    suf = f"regexp_extract(regexp_replace(t, {lit('^' + shell + '+')}, ''), {lit(shell + '*$')}, 0)"
    eng = f"(regexp_matches({core}, {lit(TX.latin_class())}) OR list_contains({lex}, {core}))"
    toks = f"regexp_extract_all(coalesce(text, ''), {lit(TX.NON_WS + '+')}, 0)"
    parts = (f"list_transform({toks}, lambda t: {{'out': CASE WHEN {eng} THEN {pre} || '[EN]' || {core} || '[/EN]' || {suf} "
             f"ELSE t END, 'word': CASE WHEN {eng} THEN {core} END}})")
    return (f"WITH p AS (SELECT doc_id, {parts} AS parts FROM documents) "
            "SELECT doc_id, md5(array_to_string(list_transform(parts, lambda x: x.out), ' ')) AS tagged_md5, "
            "len(list_filter(list_transform(parts, lambda x: x.word), lambda w: w IS NOT NULL)) AS n_en_words, "
            "md5(array_to_string(list_filter(list_transform(parts, lambda x: x.word), lambda w: w IS NOT NULL), '|')) AS en_words_md5 "
            "FROM p")


ORACLES.update({
    "wer_before_after": WER_BEFORE_AFTER,
    "norm_summary": NORM_SUMMARY,
    "clean_text": CLEAN_TEXT,
    "digit_map": DIGIT_MAP,
    "token_rewrite": TOKEN_REWRITE,
    "url_rewrite": URL_REWRITE,
    "speaker_split": SPEAKER_SPLIT,
    "split_counts": SPLIT_COUNTS,
    "manifest_totals": MANIFEST_TOTALS,
    "code_switch": _code_switch_sql(),
})


def _pack_chunks_sql(max_dur: float = 86400.0, min_dur: float = 1.0) -> str:
    ws = TX.WS
    strip = lambda e: f"regexp_replace({e}, {lit('^' + ws + '+|' + ws + '+$')}, '', 'g')"
    return f"""WITH RECURSIVE w AS (
  SELECT user_id, ts, event_id,
         CASE WHEN event_type = 'error' THEN '' ELSE event_type || '-' || CAST(event_id AS VARCHAR) END AS word,
         epoch_us(ts) / 1000000.0 AS s, epoch_us(ts) / 1000000.0 + value AS e FROM events),
nb AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, word, s, e
       FROM w WHERE {strip('word')} <> ''),
st(user_id, k, cs, ce, txt, out_txt, out_s, out_e) AS (
  SELECT user_id, k, s, e, word, NULL::VARCHAR, NULL::DOUBLE, NULL::DOUBLE FROM nb WHERE k = 1
  UNION ALL
  SELECT n.user_id, n.k,
    CASE WHEN n.e - st.cs > {max_dur} THEN n.s ELSE st.cs END, n.e,
    CASE WHEN n.e - st.cs > {max_dur} THEN n.word ELSE st.txt || ' ' || n.word END,
    CASE WHEN n.e - st.cs > {max_dur} THEN st.txt END,
    CASE WHEN n.e - st.cs > {max_dur} THEN st.cs END,
    CASE WHEN n.e - st.cs > {max_dur} THEN st.ce END
  FROM st JOIN nb n ON n.user_id = st.user_id AND n.k = st.k + 1),
last AS (SELECT user_id, max(k) AS k FROM st GROUP BY user_id),
chunks AS (
  SELECT user_id, k, out_txt AS txt, out_s AS s, out_e AS e FROM st WHERE out_txt IS NOT NULL
  UNION ALL
  SELECT st.user_id, st.k + 1, st.txt, st.cs, st.ce FROM st JOIN last USING (user_id, k)),
kept AS (SELECT * FROM chunks WHERE e - s >= {min_dur} AND {strip('txt')} <> '')
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY k) - 1 AS INTEGER) AS chunk_id,
  {sql_clean_transcript('txt')} AS text, round(s, 6) AS start, round(e, 6) AS "end" FROM kept"""


ORACLES["pack_chunks"] = _pack_chunks_sql()


def _json_words_sql() -> str:
    def num(j, key):
        p = lit("$." + key)
        return (f"CASE json_type({j}, {p}) WHEN 'BIGINT' THEN json_extract({j}, {p})::DOUBLE "
                f"WHEN 'UBIGINT' THEN json_extract({j}, {p})::DOUBLE WHEN 'DOUBLE' THEN json_extract({j}, {p})::DOUBLE "
                f"WHEN 'VARCHAR' THEN try_cast(json_extract_string({j}, {p}) AS DOUBLE) END")

    def string(j, key):
        p = lit("$." + key)
        return f"CASE WHEN json_type({j}, {p}) = 'VARCHAR' THEN json_extract_string({j}, {p}) END"

    def first(j, keys, getter, default):
        whens = " ".join(f"WHEN json_exists({j}, {lit('$.' + k)}) THEN {getter(j, k)}" for k in keys)
        return f"CASE {whens} ELSE {default} END"

    def word(j, sk, ek):
        return (f"{{'word': {first(j, ['word', 'text'], string, chr(39) * 2)}, "
                f"'start': {first(j, sk, num, '0.0')}, 'end': {first(j, ek, num, '0.0')}}}")

    k, typ, uid = "event_id", "event_type", "CAST(user_id AS VARCHAR)"
    s = f"CAST(({k} * 7) % 1000 AS VARCHAR)"
    e = f"CAST(({k} * 7) % 1000 + {k} % 5 AS VARCHAR)"
    e1 = f"CAST(({k} * 7) % 1000 + {k} % 5 + 1 AS VARCHAR)"
    s_or_null = f"CASE WHEN {typ} = 'error' THEN 'null' ELSE {s} END"
    d0 = (f"'{{\"words\":[{{\"word\":\"' || {typ} || '\",\"start\":' || {s_or_null} || ',\"end\":' || {e} || "
          f"'}},{{\"word\":\"u' || {uid} || '\",\"start\":' || {e} || ',\"end\":' || {e1} || '}}]}}'")
    d1 = (f"'{{\"words\":[{{\"text\":\"' || {typ} || '\",\"start_time\":' || {s} || ',\"end_time\":' || {e} || '}}]}}'")
    d2 = (f"'{{\"segments\":[{{\"words\":[{{\"word\":\"' || {typ} || '\",\"start\":' || {s} || ',\"end\":' || {e} || "
          f"'}}]}},{{\"words\":[{{\"text\":\"u' || {uid} || '\",\"start\":' || {e} || ',\"end\":' || {e1} || "
          f"'}}]}},{{\"other\":1}}]}}'")
    d3 = (f"CASE WHEN {typ} = 'view' THEN '{{\"k\":1}}' WHEN {typ} = 'click' THEN 'not json' "
          f"ELSE '{{\"transcript\":\"' || {typ} || '\",\"duration\":' || {s} || '}}' END")
    doc = f"CASE WHEN {k} % 4 = 0 THEN {d0} WHEN {k} % 4 = 1 THEN {d1} WHEN {k} % 4 = 2 THEN {d2} ELSE {d3} END"
    w1 = f"list_transform(json_extract(raw, '$.words[*]'), lambda w: {word('w', ['start', 'start_time'], ['end', 'end_time'])})"
    w2 = ("flatten(list_transform(json_extract(raw, '$.segments[*]'), lambda g: "
          "CASE WHEN json_exists(g, '$.words') THEN list_transform(json_extract(g, '$.words[*]'), lambda w: "
          + word('w', ['start'], ['end']) + ") ELSE [] END))")
    text = first("raw", ["transcript", "text"], string, "''")
    dur = f"CASE WHEN json_exists(raw, '$.duration') THEN {num('raw', 'duration')} ELSE 30.0 END"
    w3 = f"[{{'word': {text}, 'start': 0.0, 'end': {dur}}}]"
    return f"""WITH docs AS (SELECT {k} AS recording_id, {doc} AS raw FROM events),
v AS (SELECT recording_id, raw, json_valid(raw) AS ok FROM docs),
o AS (SELECT recording_id, CASE WHEN ok THEN raw END AS raw, ok, CASE WHEN ok THEN json_type(raw) = 'OBJECT' END AS obj FROM v),
w AS (SELECT recording_id, ok, obj,
  CASE WHEN NOT ok OR NOT obj THEN NULL
       WHEN json_exists(raw, '$.words') THEN CASE WHEN json_type(raw, '$.words') = 'ARRAY' THEN {w1} END
       WHEN json_exists(raw, '$.segments') THEN CASE WHEN json_type(raw, '$.segments') = 'ARRAY' THEN {w2} END
       WHEN json_exists(raw, '$.transcript') OR json_exists(raw, '$.text') THEN {w3}
       ELSE [] END AS words FROM o),
r AS (SELECT recording_id, words, CASE WHEN NOT ok THEN 'not json' WHEN NOT obj THEN 'not an object'
  WHEN words IS NULL THEN 'malformed word list'
  WHEN len(list_filter(words, lambda x: x.word IS NULL OR x.start IS NULL OR x."end" IS NULL)) > 0 THEN 'null word text or time'
  END AS reject_reason FROM w)
SELECT recording_id, CASE WHEN reject_reason IS NULL THEN len(words) END AS n_words,
  CASE WHEN reject_reason IS NULL THEN array_to_string(list_transform(words, lambda x:
     concat_ws('@', x.word, CAST(CAST(x.start AS BIGINT) AS VARCHAR), CAST(CAST(x."end" AS BIGINT) AS VARCHAR))), '|') END AS words,
  reject_reason FROM r"""


ORACLES["json_words"] = _json_words_sql()


_MIX = """WITH e AS (SELECT vec_id, label, embedding, len(embedding) // 2 AS h FROM embeddings),
m AS (SELECT vec_id, label, list_transform(range(0, h), lambda i: (embedding[i + 1]::FLOAT + embedding[h + i + 1]::FLOAT) / 2::FLOAT) AS x FROM e),
p AS (SELECT vec_id, label, x, list_max(list_transform(x, lambda v: abs(v))) AS peak FROM m),
c AS (SELECT vec_id, label, CASE WHEN peak > 0 THEN list_transform(x, lambda v: v / peak) ELSE x END AS x FROM p)
"""


def _micro_sql(arr: str) -> str:
    return f"array_to_string(list_transform({arr}, lambda v: CAST(CAST(round(v::DOUBLE * 1e6::DOUBLE) AS BIGINT) AS VARCHAR)), ',')"


ORACLES["wave_condition"] = _MIX + f""", b AS (SELECT vec_id, x, unnest(range(0, (len(x) + 12) // 13)) AS block FROM c),
s AS (SELECT vec_id, block, x[block * 13 + 1 : block * 13 + 13] AS x FROM b)
SELECT vec_id, block, len(x) AS n_samples, {_micro_sql('x')} AS samples_e6 FROM s"""
ORACLES["wave_slice"] = (_MIX + """, s AS (SELECT vec_id, x, CAST(trunc(((vec_id % 7) / 16000.0) * 16000) AS INTEGER) AS s0,
   CAST(trunc(((vec_id % 7) / 16000.0 + (20 + label) / 16000.0) * 16000) AS INTEGER) AS e0 FROM c),
t AS (SELECT vec_id, CASE WHEN s0 >= len(x) THEN []::FLOAT[] ELSE x[s0 + 1 : least(e0, len(x))] END AS x FROM s)
SELECT vec_id, len(x) AS n_samples, """ + _micro_sql("x") + " AS samples_e6 FROM t WHERE len(x) >= 16")


def _number_words_sql(select: str) -> str:
    """X1 in DuckDB, from the rule: one row per token, idioms matched token by token,
    runs as gaps and islands, values as a fold per run.  Word characters and
    trailing punctuation are spelled out here, not taken from the package."""
    import unicodedata

    from vachan.functions import lexicon as L
    from vachan.plans.queries import DEVANAGARI_WORDS

    word, other = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"

    def matches(expr, left, body, right):
        return f"regexp_matches({expr}, {lit(left + chr(92) + 'Q' + body + chr(92) + 'E' + right)})"

    def end(phrase):   # a boundary lies where word characters begin or end
        return f"({other}|$)" if unicodedata.category(phrase[-1])[0] in "LN" else word

    start = f"(^|{other})"
    guards = []
    for p in L.IDIOM_PHRASES:
        parts = p.split()
        if len(parts) == 1:
            guards.append(matches("tok", start, p, end(p)))
        else:
            first, second = parts
            guards.append(f"({matches('tok', start, first, '$')} AND {matches('nxt', '^', second, end(p))})")
            guards.append(f"({matches('prv', start, first, '$')} AND {matches('tok', '^', second, end(p))})")

    def table(values):
        return "[" + ", ".join(lit(k) for k in values) + "]", "[" + ", ".join(f"{v}::HUGEINT" for v in values.values()) + "]"

    (add_k, add_v), (mul_k, mul_v) = table(L.ADDITIVE_VALUES), table(L.MULTIPLIER_VALUES)
    lex = "[" + ", ".join(lit(w) for w in DEVANAGARI_WORDS) + "]"
    non_ws = lit(r"[^ \t\n\x0B\f\r]+")
    a, m = f"{add_v}[list_position({add_k}, w)]", f"{mul_v}[list_position({mul_k}, w)]"
    group = "(CASE WHEN acc.current > 0 THEN acc.current ELSE 1::HUGEINT END)"
    fold = (f"list_reduce(list_append(keys, ''), lambda acc, w: CASE WHEN w = '' THEN {{'total': acc.total + acc.current, 'current': 0::HUGEINT}} "
            f"WHEN {a} IS NOT NULL THEN {{'total': acc.total, 'current': acc.current + {a}}} "
            f"WHEN {m} >= 1000 THEN {{'total': acc.total + {group} * {m}, 'current': 0::HUGEINT}} "
            f"ELSE {{'total': acc.total, 'current': {group} * {m}}} END, {{'total': 0::HUGEINT, 'current': 0::HUGEINT}}).total")
    return f"""WITH utt AS ({D.SQL_UTT}),
dt AS (SELECT segment_id, array_to_string(list_transform(regexp_extract_all(coalesce(Human, ''), {non_ws}, 0),
   lambda t: {lex}[(length(t) % {len(DEVANAGARI_WORDS)}) + 1] || CASE WHEN length(t) % 5 = 0 THEN ',' ELSE '' END), ' ') AS raw FROM utt),
tl AS (SELECT segment_id, regexp_extract_all(raw, {non_ws}, 0) AS toks FROM dt),
tk AS (SELECT segment_id, unnest(range(0, len(toks))) AS k, unnest(toks) AS tok FROM tl),
nb AS (SELECT *, coalesce(lag(tok) OVER s, '') AS prv, coalesce(lead(tok) OVER s, '') AS nxt, rtrim(tok, ',।!?') AS key FROM tk WINDOW s AS (PARTITION BY segment_id ORDER BY k)),
fl AS (SELECT *, list_contains({add_k}, key) OR list_contains({mul_k}, key) AS num, {" OR ".join(guards)} AS guarded FROM nb),
rn AS (SELECT *, sum(CASE WHEN num AND before THEN 0 ELSE 1 END) OVER (PARTITION BY segment_id ORDER BY k) AS run
   FROM (SELECT *, coalesce(lag(num) OVER (PARTITION BY segment_id ORDER BY k), false) AS before FROM fl)),
pc AS (SELECT segment_id, run, min(k) AS pos, bool_and(num) AND NOT bool_or(guarded) AS conv, string_agg(tok, ' ' ORDER BY k) AS original, list(key ORDER BY k) AS keys
   FROM rn GROUP BY segment_id, run),
pv AS (SELECT *, CASE WHEN conv THEN CAST({fold} AS VARCHAR) END AS value FROM pc),
ag AS (SELECT segment_id, string_agg(coalesce(value, original), ' ' ORDER BY pos) AS text,
   list({{'original': original, 'replacement': value, 'position': CAST(pos AS INTEGER)}} ORDER BY pos) FILTER (conv) AS changes FROM pv GROUP BY segment_id),
res AS (SELECT segment_id, coalesce(text, '') AS text, coalesce(changes, []) AS changes FROM dt LEFT JOIN ag USING (segment_id))
{select}"""


ORACLES["number_words"] = _number_words_sql(
    "SELECT segment_id, md5(text) AS text_md5, len(changes) AS n_changes, "
    "array_to_string(list_transform(changes, lambda c: concat_ws('=>', c.original, c.replacement, CAST(c.position AS VARCHAR))), '|') AS changes FROM res")


ORACLES["asr_cleanup"] = _number_words_sql(
    f", tg AS (SELECT segment_id, text, changes, {_tag_parts_sql('text')} AS parts FROM res) "
    "SELECT segment_id, md5(text) AS num_md5, "
    "md5(array_to_string(list_transform(parts, lambda x: x.out), ' ')) AS tagged_md5, len(changes) AS n_changes, "
    "len(list_filter(list_transform(parts, lambda x: x.word), lambda w: w IS NOT NULL)) AS n_en_words FROM tg")


_SCORED_HINDI = "SELECT idx, wer_before_norm AS wer FROM ba"
ORACLES.update({
    "hindi_canonical": HINDI + ", c AS (SELECT idx, reference, " + sql_canonicalise("coalesce(reference, '')") + " AS plain, "
                       + sql_canonicalise("coalesce(reference, '')", True) + " AS numbers, " + sql_canonicalise("coalesce(reference, 'nan')")
                       + " AS nan FROM res) SELECT idx, md5(plain) AS plain_md5, md5(numbers) AS numbers_md5, md5(nan) AS nan_md5, "
                       "coalesce(reference, '') <> plain AS changed FROM c",
    "hindi_before_after": HINDI_BEFORE_AFTER + "SELECT idx, wer_before_norm, wer_after_norm, round(wer_before_norm - wer_after_norm, 2) AS wer_delta FROM ba",
    "hindi_norm_summary": HINDI_BEFORE_AFTER + "SELECT round(avg(wer_before_norm), 6) AS avg_wer_before, round(avg(wer_after_norm), 6) AS avg_wer_after, "
                          "round(avg(wer_before_norm) - avg(wer_after_norm), 6) AS reduction_pp FROM ba",
    "hindi_preview": HINDI_BEFORE_AFTER + "SELECT idx, wer_before_norm, wer_after_norm FROM (SELECT *, row_number() OVER (ORDER BY idx) AS r FROM ba "
                     "WHERE wer_before_norm IS NOT NULL AND wer_after_norm IS NOT NULL) WHERE r <= 10",
    "scoring_rejects": HINDI + " SELECT idx, CAST(NULL AS DOUBLE) AS wer, 'empty reference' AS reject_reason FROM res WHERE trim(coalesce(reference, '')) = ''",
    "tier_report": HINDI_BEFORE_AFTER + ", t AS (SELECT CASE WHEN wer <= 15 THEN 'low' WHEN wer <= 50 THEN 'medium' ELSE 'high' END AS tier, count(*) AS available "
                   f"FROM ({_SCORED_HINDI}) WHERE wer > 0 GROUP BY 1) "
                   "SELECT tier, available, least(available, 10) AS sampled, CAST(sum(available) OVER () AS BIGINT) AS total_errors FROM t",
    "nfc_tokens": HINDI + f", t AS (SELECT idx, {D.sql_tokenise('hypothesis')} AS t FROM res) SELECT idx, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM t",
})


# ── lattice oracles ─────────────────────────────────────────────────────────

def _lattice_base() -> str:
    """CTE chain: full anti-diagonal DP per (segment, system) kept for every
    diagonal, a recursive traceback (diagonal, then deletion, then insertion,
    from the end), bins by GROUP BY, the lattice as an ordered list, and a
    lattice DP (anti-diagonal again) per (segment, system)."""
    return BASE + f""",
pairs AS (SELECT segment_id*10+m AS pid, segment_id, url, m, system, ref AS a, hyp AS b FROM sys WHERE len(ref) > 0),
sys_pairs AS (SELECT pid, a, b FROM pairs),
{edit_cte("sys_ed", "sys_pairs")},
diag(pid, d, cur, prev) AS (
  SELECT pid, 0, list_transform(range(0, len(a) + 1), lambda i: CASE WHEN i = 0 THEN 0 ELSE {BIG} END), []::BIGINT[] FROM pairs
  UNION ALL
  SELECT x.pid, x.d + 1,
    list_transform(range(0, len(p.a) + 1), lambda i:
      CASE WHEN x.d + 1 - i < 0 OR x.d + 1 - i > len(p.b) THEN {BIG}
           WHEN i = 0 OR x.d + 1 - i = 0 THEN x.d + 1
           ELSE least(x.cur[i] + 1, x.cur[i + 1] + 1,
                      x.prev[i] + CASE WHEN p.a[i] = p.b[x.d + 1 - i] THEN 0 ELSE 1 END) END),
    x.cur
  FROM diag x JOIN pairs p ON x.pid = p.pid WHERE x.d < len(p.a) + len(p.b)),
dg AS (SELECT pid, d, cur FROM diag),
tb(pid, i, j, step, op, ref_pos, gap, ref_tok, hyp_tok) AS (
  SELECT pid, len(a), len(b), 0, NULL::VARCHAR, NULL::INTEGER, NULL::INTEGER, NULL::VARCHAR, NULL::VARCHAR FROM pairs
  UNION ALL
  SELECT t.pid,
    CASE WHEN k.dg_ok OR k.del_ok THEN t.i - 1 ELSE t.i END,
    CASE WHEN k.dg_ok OR NOT k.del_ok THEN t.j - 1 ELSE t.j END,
    t.step + 1,
    CASE WHEN k.dg_ok THEN CASE WHEN k.ai = k.bj THEN 'match' ELSE 'sub' END WHEN k.del_ok THEN 'del' ELSE 'ins' END,
    CASE WHEN k.dg_ok OR k.del_ok THEN t.i - 1 END,
    CASE WHEN NOT (k.dg_ok OR k.del_ok) THEN t.i END,
    CASE WHEN k.dg_ok OR k.del_ok THEN k.ai END,
    CASE WHEN k.dg_ok OR NOT k.del_ok THEN k.bj END
  FROM tb t JOIN LATERAL (
    SELECT p.a[t.i] AS ai, p.b[t.j] AS bj,
      (t.i > 0 AND t.j > 0 AND d0.cur[t.i + 1] = d2.cur[t.i] + CASE WHEN p.a[t.i] = p.b[t.j] THEN 0 ELSE 1 END) AS dg_ok,
      (t.i > 0 AND NOT (t.i > 0 AND t.j > 0 AND d0.cur[t.i + 1] = d2.cur[t.i] + CASE WHEN p.a[t.i] = p.b[t.j] THEN 0 ELSE 1 END)
       AND d0.cur[t.i + 1] = d1.cur[t.i] + 1) AS del_ok
    FROM pairs p JOIN dg d0 ON d0.pid = p.pid AND d0.d = t.i + t.j
      LEFT JOIN dg d1 ON d1.pid = p.pid AND d1.d = t.i + t.j - 1
      LEFT JOIN dg d2 ON d2.pid = p.pid AND d2.d = t.i + t.j - 2
    WHERE p.pid = t.pid) k ON true
  WHERE t.i > 0 OR t.j > 0),
ops AS (SELECT p.segment_id, p.m, p.system, t.step, t.op, t.ref_pos, t.gap, t.ref_tok, t.hyp_tok
        FROM tb t JOIN pairs p ON p.pid = t.pid WHERE t.step > 0),
rlen AS (SELECT segment_id, any_value(len(a)) AS r FROM pairs GROUP BY segment_id),
rbins AS (SELECT segment_id, ref_pos, any_value(ref_tok) AS ref_tok,
            list_sort(list_distinct(list_append(coalesce(list(hyp_tok) FILTER (WHERE hyp_tok IS NOT NULL), []::VARCHAR[]), any_value(ref_tok)))) AS tokens
          FROM ops WHERE ref_pos IS NOT NULL GROUP BY segment_id, ref_pos),
obins AS (SELECT o.segment_id, o.gap, o.hyp_tok, count(*) AS cnt, min(o.m * 1000000000 - o.step) AS first_key
          FROM ops o JOIN rlen USING (segment_id) WHERE o.op = 'ins' AND o.gap < rlen.r
          GROUP BY o.segment_id, o.gap, o.hyp_tok HAVING count(*) >= 3),
allbins AS (SELECT segment_id, ref_pos AS pos, 0 AS kind, 0::BIGINT AS fk, tokens, false AS opt FROM rbins
            UNION ALL SELECT segment_id, gap, 1, first_key, [hyp_tok], true FROM obins),
lat AS (SELECT segment_id, list({{'tokens': tokens, 'opt': opt}} ORDER BY pos, kind, fk) AS bins FROM allbins GROUP BY segment_id),
lp AS (SELECT p.pid, p.segment_id, p.url, p.m, p.system, p.a AS ref, l.bins AS a, p.b FROM pairs p JOIN lat l USING (segment_id)),
ldp(pid, d, cur, prev) USING KEY (pid) AS (
  SELECT pid, 0, list_transform(range(0, len(a) + 1), lambda i: CASE WHEN i = 0 THEN 0 ELSE {BIG} END), []::BIGINT[] FROM lp
  UNION ALL
  SELECT x.pid, x.d + 1,
    list_transform(range(0, len(p.a) + 1), lambda i:
      CASE WHEN x.d + 1 - i < 0 OR x.d + 1 - i > len(p.b) THEN {BIG}
           WHEN i = 0 THEN x.d + 1
           WHEN x.d + 1 - i = 0 THEN x.cur[i] + CASE WHEN p.a[i].opt THEN 0 ELSE 1 END
           ELSE least(x.cur[i] + 1, x.cur[i + 1] + 1,
                      x.prev[i] + CASE WHEN list_contains(p.a[i].tokens, p.b[x.d + 1 - i]) THEN 0 ELSE 1 END) END),
    x.cur
  FROM ldp x JOIN lp p ON x.pid = p.pid WHERE x.d < len(p.a) + len(p.b)),
ledits AS (SELECT p.pid, x.cur[len(p.a) + 1] AS lattice_edits, len(list_filter(p.a, lambda z: NOT z.opt)) AS lattice_n
           FROM ldp x JOIN lp p ON x.pid = p.pid),
detail AS (SELECT p.segment_id, p.url, p.m, p.system, p.ref, p.b AS hyp, e.edits, len(p.ref) AS n,
             round(e.edits / len(p.ref), 4) AS plain_wer, l.lattice_edits, l.lattice_n,
             CASE WHEN l.lattice_n > 0 THEN round(l.lattice_edits / l.lattice_n, 4) ELSE 0.0 END AS lattice_wer
           FROM lp p JOIN ledits l ON l.pid = p.pid JOIN sys_ed e ON e.pid = p.pid)
"""


def _lattice_sql(select: str) -> str:
    return _lattice_base() + select


def _documented_sql(select: str) -> str:
    """Documented mode: optional bins lie at their gap, the trailing one included, and
    every skip of one is free."""
    sql = _lattice_base()
    for old, new in (("WHERE o.op = 'ins' AND o.gap < rlen.r", "WHERE o.op = 'ins'"),
                     ("SELECT segment_id, gap, 1, first_key", "SELECT segment_id, gap, -1, first_key"),
                     ("least(x.cur[i] + 1, x.cur[i + 1] + 1,\n                      x.prev[i] + CASE WHEN list_contains",
                      "least(x.cur[i] + CASE WHEN p.a[i].opt THEN 0 ELSE 1 END, x.cur[i + 1] + 1,\n                      x.prev[i] + CASE WHEN list_contains")):
        assert sql.count(old) == 1, old
        sql = sql.replace(old, new)
    return sql + select


ORACLES.update({
    "align_ops": _lattice_sql("SELECT segment_id, system, count(*) FILTER (WHERE op = 'sub') AS subs, "
                              "count(*) FILTER (WHERE op = 'del') AS dels, count(*) FILTER (WHERE op = 'ins') AS ins, "
                              "count(*) FILTER (WHERE op = 'match') AS hits FROM ops GROUP BY segment_id, system"),
    "lattice_bins": _lattice_sql("SELECT segment_id, len(bins) AS n_bins, len(list_filter(bins, lambda z: z.opt)) AS n_optional, "
                                 "array_to_string(list_transform(bins, lambda z: array_to_string(z.tokens, '/') || "
                                 "CASE WHEN z.opt THEN '|ε' ELSE '' END), ' ') AS bins FROM lat"),
    "suspected_ref_errors": _lattice_sql("SELECT segment_id, ref_pos, ref_tok, hyp_tok, count(DISTINCT system) AS n_systems "
                                         "FROM ops WHERE op = 'sub' GROUP BY segment_id, ref_pos, ref_tok, hyp_tok "
                                         "HAVING count(DISTINCT system) >= 3"),
})

_DETAIL_COLS = ("segment_id, url, system, array_to_string(ref, ' ') AS ref, array_to_string(hyp, ' ') AS hyp, "
                "plain_wer, lattice_wer, round(lattice_wer - plain_wer, 4) AS delta")

ORACLES.update({
    "lattice_detail": _lattice_sql(f"SELECT {_DETAIL_COLS} FROM detail"),
    "lattice_system_wer": _lattice_sql(
        "SELECT system, sum(edits) AS plain_edits, sum(n) AS plain_n, sum(lattice_edits) AS lattice_edits, "
        "sum(lattice_n) AS lattice_n, round(sum(edits) / sum(n), 6) AS plain_wer, "
        "round(sum(lattice_edits) / sum(lattice_n), 6) AS lattice_wer, "
        "round(sum(lattice_edits) / sum(lattice_n) - sum(edits) / sum(n), 6) AS delta, "
        "CASE WHEN sum(lattice_edits) / sum(lattice_n) - sum(edits) / sum(n) < -0.0001 THEN 'REDUCED' "
        "WHEN abs(sum(lattice_edits) / sum(lattice_n) - sum(edits) / sum(n)) < 0.0001 THEN 'same' "
        "ELSE 'INCREASED?' END AS verdict FROM detail GROUP BY system"),
    "lattice_documented": _documented_sql(
        "SELECT system, sum(edits) AS plain_edits, sum(n) AS plain_n, sum(lattice_edits) AS lattice_edits, sum(lattice_n) AS lattice_n, "
        "count(*) FILTER (lattice_edits > edits) AS n_worse FROM detail GROUP BY system"),
    "lattice_top": _lattice_sql(f"SELECT {_DETAIL_COLS} FROM detail WHERE round(lattice_wer - plain_wer, 4) < -0.10 "
                                "ORDER BY round(lattice_wer - plain_wer, 4), segment_id, m LIMIT 15"),
    "lattice_unchanged": _lattice_sql(f"SELECT {_DETAIL_COLS} FROM detail WHERE abs(round(lattice_wer - plain_wer, 4)) < 0.001 "
                                      "AND plain_wer = 0.0 ORDER BY segment_id, m LIMIT 5"),
    "lattice_inspect": _lattice_sql(
        ", ins AS (SELECT p.segment_id, p.a AS ref, l.bins, unnest(range(0, least(len(p.a), len(l.bins)))) AS bin_idx "
        "FROM pairs p JOIN lat l USING (segment_id) WHERE p.m = 1), "
        "fb AS (SELECT segment_id, bin_idx, ref[bin_idx + 1] AS ref_tok, "
        "list_sort(CASE WHEN bins[bin_idx + 1].opt THEN list_distinct(list_append(bins[bin_idx + 1].tokens, 'ε')) "
        "ELSE bins[bin_idx + 1].tokens END) AS full_bin FROM ins) "
        "SELECT segment_id, CAST(bin_idx AS INTEGER) AS bin_idx, ref_tok, array_to_string(full_bin, '/') AS full_bin, "
        "len(list_filter(full_bin, lambda x: x <> ref_tok)) > 0 AS variants FROM fb"),
})


def _dataset_build_sql(max_dur: float = 0.001, min_dur: float = 0.0005) -> str:
    """C4 + C5 over ``embeddings``: URL check, conditioned samples, greedy
    packing of each recording's words (recursive CTE), per-chunk slices,
    minimum-sample filter, speaker split by md5 rank."""
    ws = TX.WS
    strip = lambda e: f"regexp_replace({e}, {lit('^' + ws + '+|' + ws + '+$')}, '', 'g')"
    return _MIX.replace("WITH ", "WITH RECURSIVE ", 1) + f""", man AS (SELECT vec_id AS recording_id, CAST(label AS BIGINT) AS user_id,
   printf('https://h/c/hq/hi/%d/%d_audio.wav', label, vec_id) AS url, (len(embedding) / 2) / 16000.0 AS dur
   FROM embeddings),
w AS (SELECT recording_id, 1 AS pos, 'शब्द' || CAST(recording_id AS VARCHAR) AS word, 0.0::DOUBLE AS s, dur / 2 AS e FROM man
      UNION ALL SELECT recording_id, 2, CAST(user_id AS VARCHAR), dur / 2, dur FROM man),
good AS (SELECT recording_id, user_id FROM man WHERE regexp_matches(url, '/([0-9]+)/([0-9]+)_')),
nb AS (SELECT w.recording_id, row_number() OVER (PARTITION BY w.recording_id ORDER BY pos) AS k, word, s, e
       FROM w JOIN good USING (recording_id) WHERE {strip('word')} <> ''),
st(recording_id, k, cs, ce, txt, out_txt, out_s, out_e) AS (
  SELECT recording_id, k, s, e, word, NULL::VARCHAR, NULL::DOUBLE, NULL::DOUBLE FROM nb WHERE k = 1
  UNION ALL
  SELECT n.recording_id, n.k,
    CASE WHEN n.e - st.cs > {max_dur} THEN n.s ELSE st.cs END, n.e,
    CASE WHEN n.e - st.cs > {max_dur} THEN n.word ELSE st.txt || ' ' || n.word END,
    CASE WHEN n.e - st.cs > {max_dur} THEN st.txt END,
    CASE WHEN n.e - st.cs > {max_dur} THEN st.cs END,
    CASE WHEN n.e - st.cs > {max_dur} THEN st.ce END
  FROM st JOIN nb n ON n.recording_id = st.recording_id AND n.k = st.k + 1),
lastk AS (SELECT recording_id, max(k) AS k FROM st GROUP BY recording_id),
chunks AS (SELECT recording_id, k, out_txt AS txt, out_s AS s, out_e AS e FROM st WHERE out_txt IS NOT NULL
           UNION ALL SELECT st.recording_id, st.k + 1, st.txt, st.cs, st.ce FROM st JOIN lastk USING (recording_id, k)),
kept AS (SELECT recording_id, CAST(row_number() OVER (PARTITION BY recording_id ORDER BY k) - 1 AS INTEGER) AS chunk_id,
           {sql_clean_transcript('txt')} AS sentence, s, e FROM chunks WHERE e - s >= {min_dur} AND {strip('txt')} <> ''),
sl AS (SELECT k.recording_id, g.user_id, k.chunk_id, k.sentence,
         CAST(trunc(k.s * 16000) AS INTEGER) AS s0, CAST(trunc(k.e * 16000) AS INTEGER) AS e0, c.x
       FROM kept k JOIN good g USING (recording_id) JOIN c ON c.vec_id = k.recording_id),
ex AS (SELECT recording_id, user_id, chunk_id, sentence,
         len(CASE WHEN s0 >= len(x) THEN []::FLOAT[] ELSE x[s0 + 1 : least(e0, len(x))] END) AS n_samples FROM sl),
ex2 AS (SELECT * FROM ex WHERE n_samples >= {int(min_dur * 16000)}),
u AS (SELECT DISTINCT user_id FROM ex2),
r AS (SELECT user_id, row_number() OVER (ORDER BY md5('42|' || CAST(user_id AS VARCHAR)), user_id) - 1 AS rk,
        count(*) OVER () AS n FROM u)
SELECT ex2.recording_id, ex2.user_id, ex2.chunk_id,
  CASE WHEN r.rk < ceil(r.n * 0.1) THEN 'validation' ELSE 'train' END AS split, ex2.sentence, ex2.n_samples
FROM ex2 JOIN r USING (user_id)"""


ORACLES["dataset_build"] = _dataset_build_sql()


def _over(key: str, select: str) -> str:
    """Another query's SQL as a table ``q``."""
    return f"SELECT {select.format(q='(' + ORACLES[key] + ')')}"


ORACLES.update({
    # a pair of two empty texts has no operation, so no row of the lateral join
    "align_sql": _over("align_ops", "* FROM {q} WHERE subs + dels + ins + hits > 0"),
    "chunk_counts": _over("pack_chunks", "user_id, count(*) AS n_chunks FROM {q} GROUP BY user_id"),
    "second_segment": _over("lattice_inspect", "segment_id, bin_idx, left(ref_tok, 3) AS ref_tok, full_bin, variants "
                            "FROM (SELECT *, dense_rank() OVER (ORDER BY segment_id) AS r FROM {q}) WHERE r = 2"),
    "asset_paths": "SELECT event_id AS recording_id, 'cache/audio/' || event_id || '.wav' AS audio_path, 'cache/transc/' || event_id || '.json' AS transcript_path FROM events",
    "sql_normalise": HINDI + " SELECT idx, md5(" + sql_canonicalise("coalesce(reference, '')") + ") AS plain_md5 FROM res",
    "dataset_round_trip": _over("dataset_build", "recording_id, chunk_id, sentence FROM {q} WHERE split = 'validation'"),
    "dataset_rejects": "SELECT vec_id AS recording_id, r AS reject_reason FROM (SELECT vec_id, CASE WHEN vec_id % 11 = 0 THEN 'unparsable url' "
                       "WHEN vec_id % 13 = 0 THEN 'missing audio' WHEN vec_id % 17 = 0 THEN 'sampling rate is not 16 kHz' "
                       "WHEN vec_id % 29 = 0 THEN 'missing transcript' WHEN vec_id % 23 = 0 THEN 'not json' "
                       "WHEN vec_id % 19 = 0 THEN 'null word text or time' END AS r FROM embeddings) WHERE r IS NOT NULL",
})


def _latin() -> str:
    """Code points whose Unicode name starts with LATIN, as a class (own copy of the rule)."""
    import itertools
    import unicodedata

    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000 and unicodedata.name(chr(c), "").startswith("LATIN")]
    runs = [list(g) for _, g in itertools.groupby(enumerate(points), lambda p: p[1] - p[0])]
    return "[" + "".join(f"\\x{{{r[0][1]:X}}}-\\x{{{r[-1][1]:X}}}" for r in runs) + "]"


ORACLES.update({
    "sheet_rows": f"WITH utt AS ({D.SQL_UTT}), sy AS ({D.SQL_SYSTEMS}) SELECT row_number() OVER (ORDER BY segment_id) - 1 AS sheet_row, regexp_extract(url, '[^/]*$') AS file, "
                  "md5(array_to_string(ref, ' ')) AS ref_md5, md5(array_to_string(hyp, ' ')) AS hyp_md5 FROM sy WHERE m = 4",
    "results_exchange": """WITH u AS (SELECT conv_id * 100 + turn AS k, text AS t FROM conversations)
SELECT CASE WHEN k % 11 <> 0 THEN k::INTEGER END AS idx, md5(CASE k % 7 WHEN 0 THEN 'say "' || t || '", ok' WHEN 1 THEN 'two' || chr(10) || 'lines ' || t || ' ' WHEN 2 THEN '' ELSE t END) AS reference_md5,
  md5(translate(t, 'aeiou', 'eioua')) AS hypothesis_md5, CASE WHEN k % 13 <> 0 THEN (k % 400) / 4.0::DOUBLE END AS wer,
  nullif('bad ' || concat_ws(', ', CASE WHEN k % 11 = 0 THEN 'idx' END, CASE WHEN k % 13 = 0 THEN 'wer' END), 'bad ') AS reject_reason FROM u""",
    "manifest_exchange": """SELECT event_id AS recording_id, CASE WHEN event_id % 10 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 15 <> 0 THEN (event_id % 90) / 4.0::DOUBLE END AS duration,
  nullif('bad ' || concat_ws(', ', CASE WHEN event_id % 10 = 0 THEN 'user_id' END, CASE WHEN event_id % 15 = 0 THEN 'duration' END), 'bad ') AS reject_reason FROM events""",
    "asset_scan": """WITH e AS (SELECT conv_id AS k, count(*) AS n, string_agg(role || length(text), ' ' ORDER BY turn) AS w, k % 4 <> 1 AS t, k % 5 <> 2 AS a, k % 6 = 0 AS bad
  FROM conversations WHERE conv_id % 4 <> 1 OR conv_id % 5 <> 2 GROUP BY conv_id)
SELECT k AS recording_id, CASE WHEN a THEN n + 1 END AS length, CASE WHEN a AND t AND NOT bad THEN n END AS n_words, CASE WHEN a AND t AND NOT bad THEN w END AS words,
  CASE WHEN NOT a THEN 'missing audio' WHEN NOT t THEN 'missing transcript' WHEN bad THEN 'not json' END AS reject_reason FROM e""",
    "reject_counts": "SELECT r.reject_reason, count(*) AS n FROM embeddings e LEFT JOIN (" + ORACLES["dataset_rejects"] + ") r ON r.recording_id = e.vec_id GROUP BY 1",
    "incremental_scores": _over("wer_before_after", "idx, wer_before_norm, wer_after_norm, wer_delta FROM {q}"),
    "script_flags": f"""WITH u AS (SELECT conv_id * 100 + turn AS segment_id, conv_id, text FROM conversations),
t AS (SELECT *, CASE segment_id % 3 WHEN 0 THEN 'नमस्ते दुनिया ' || text WHEN 1 THEN repeat('नमस्ते दुनिया ', 40) || text ELSE text END AS t FROM u)
SELECT segment_id, coalesce(2 * length(regexp_replace(t, {lit('[^' + _latin()[1:])}, '', 'g')) > length(t), FALSE) AS roman, regexp_matches(t, {lit(r'[\x{0900}-\x{097F}]')}) AS devanagari,
  segment_id || '_audio.wav' AS file FROM t""",
    "lattice_sparse": _over("align_ops", "* FROM {q} WHERE segment_id % 17 <> 0"),
})
