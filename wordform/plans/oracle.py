"""DuckDB SQL for every harness query (the correctness oracle).

Written independently of the DataFrame code: plain CTEs with global window
functions, correlated look-ups and CASE chains, with its own copy of the fixed
values. Only the affix files are the same.
"""

from __future__ import annotations

from wordform import PREFIX_FILE, SUFFIX_FILE

# Fixed values of the rules, written down here again so that a slip in the
# engine's lists shows.


class R:
    BAD_POS = "ART PPER PRF PIS PIAT PPOSS PRELS PRELAT KOUS KON KOKOM".split()
    ADJ_POS = "ADJA ADJD".split()
    PREFIX_DROP_IF_UPPER = "ab ent er be".split()
    SUFFIX_DROP_IF_LOWER = "er ast at i ie ier ik ine ist ling ner or ade ler ur".split()
    SUFFIX_DROP_IF_UPPER = "ern weg bar fach haft end ens ig lings nd weise wegen".split()
    SUFFIX_NEED_CONSONANT = "i ie ik in ine ade".split()
    PREFIX_NO_BASE = "hyper ko kon konter makro mikro neo para post prä re retro sub trans über un unter wider".split()
    PREFIX_VERBAL = "er ent ab be an de hinter miss um ver zer".split()
    PREFIX_LATINATE = "erz ex inter in im il multi ultra".split()
    SUFFIX_CONFIX = "abel age al ant anz ar ast at el ent ibel ie ik".split()
    SUFFIX_BASE_IS_STEM = "alie chen ei schaft tum in keit mäßig nis".split()


WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NOT_WS = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
BODY_LINK_RE = r"\(?http[^ ]+\)?"
URL_RE = rf"https?:\/\/{NOT_WS}*"
YT_PARAM_RE = rf"v={NOT_WS}*t={NOT_WS}*"
SUB_USER_RE = r"\/(r|u)\/"
PATHLIKE_RE = rf"{NOT_WS}*\/{NOT_WS}*\.{NOT_WS}*"
SENTENCE_RE = r"[^.!?\n]+[.!?]*"
TOKEN_RE = r"[\p{L}\p{N}]+|[^\t-\r\x1c-\x20\x{85}\p{Z}\p{L}\p{N}]"
STOP_WORDS = {
    "de": "der die das und ist nicht ein den von zu mit sich auf für im dem des als auch".split(),
    "en": "the of and to in is that it for was on are as with they be at this have from".split(),
    "fr": "le la les de des et un une est que qui dans pour en il elle du au ne pas".split(),
    "es": "el la los las de que y en un una por con para es no se del al lo como".split(),
}
# (bin, least count, largest count); 64 is in two bins
BINS = [(1, 1, 1), (2, 2, 3), (3, 4, 7), (4, 8, 15), (5, 16, 31), (6, 32, 64), (7, 64, 127), (8, 128, None)]
SIZE_TRAIN = 0.8
SIZE_TEST = 0.15
NULL_KEY = "\u2400"
COMMUNITY_LINES = ['src1', ' src4', 'src7 ', 'src7', 'SRC2', 'src12', 'src19', 'nonexistent']
FIXTURE_POS = ['NN', 'VVINF', 'ADJD', 'ADJA', 'KON']

SEED = 200
SAMPLE_SEED = 7


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def inlist(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def _affix_values() -> str:
    rows = []
    with open(PREFIX_FILE, encoding="utf-8") as fh:
        for line in fh:
            a = line.strip()
            a = a[:-1].strip() if a.endswith("-") else a
            if a:
                rows.append((a, "prefix"))
    with open(SUFFIX_FILE, encoding="utf-8") as fh:
        for line in fh:
            a = line.strip()
            a = a[1:].strip() if a.startswith("-") else a
            if a:
                rows.append((a, "suffix"))
    return "SELECT * FROM (VALUES " + ", ".join(f"({q(a)}, {q(k)})" for a, k in sorted(set(rows))) + ") t(affix, kind)"


STRIP = "^" + WS + "+|" + WS + r"+\z"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP)}, '', 'g')"


def sanitize_body(x: str) -> str:
    return f"regexp_replace(replace(replace({x}, chr(13), ''), chr(10), ' '), {q(BODY_LINK_RE)}, '', 'g')"


def unescape(x: str) -> str:
    out = x
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"),
                    ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        out = f"replace({out}, {q(ent)}, {q(ch)})"
    return out


def sanitize_text(x: str) -> str:
    s = f"replace(replace({unescape(x)}, chr(13), ''), chr(10), ' ')"
    for pat in (URL_RE, YT_PARAM_RE, SUB_USER_RE, PATHLIKE_RE):
        s = f"regexp_replace({s}, {q(pat)}, '', 'g')"
    return s


def cons(x: str) -> str:
    return f"regexp_full_match({x}, '[bcdfghjklmnpqrstvwxyz]*')"


def up(x: str) -> str:
    return f"regexp_matches({x}, '^\\p{{Lu}}')"


def low(x: str) -> str:
    return f"regexp_matches({x}, '^\\p{{Ll}}')"


def title(x: str) -> str:
    return f"(upper(left({x}, 1)) || lower(substr({x}, 2)))"


def cut(x: str, n: int) -> str:
    return f"left({x}, length({x}) - {n})"


def _stop_counts(text: str = "text") -> str:
    words = f"regexp_extract_all(lower({text}), '\\p{{L}}+')"
    parts = []
    for lang, sw in STOP_WORDS.items():
        parts.append(f"len(list_filter({words}, lambda w: list_contains([{', '.join(q(x) for x in sw)}], w))) AS c_{lang}")
    return ", ".join(parts)


def _lang_pred() -> str:
    langs = list(STOP_WORDS)
    best = "greatest(" + ", ".join(f"c_{l}" for l in langs) + ")"
    case = " ".join(f"WHEN c_{l} = {best} THEN {q(l)}" for l in langs)
    return f"CASE WHEN {best} > 0 THEN CASE {case} END END"


def _communities() -> str:
    vals = sorted({s.strip() for s in COMMUNITY_LINES if s.strip()})
    return "(" + ", ".join(q(v) for v in vals) + ")"


FIXTURE_LEX = f"""
fx_scored AS (SELECT doc_id, source, text, {_stop_counts()} FROM documents),
fx_de AS (SELECT doc_id, source, text FROM fx_scored WHERE {_lang_pred()} = 'de'),
fx_words AS (
  SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '\\p{{L}}+')) AS w FROM fx_de) GROUP BY w),
fx_vocab AS (SELECT lower(w) AS token FROM fx_words GROUP BY lower(w) HAVING sum(n) >= 5),
fx_lex_raw AS (
  SELECT w AS word,
    CASE WHEN n % 11 = 0 THEN 'unknown'
         WHEN lower(w) LIKE '%en' THEN lower(w)
         WHEN length(w) % 3 = 0 THEN lower(w) || 'en'
         ELSE w END AS base,
    CASE WHEN n % 13 = 0 THEN '$(' ELSE [{", ".join(q(p) for p in FIXTURE_POS)}][length(w) % 5 + 1] END AS pos,
    n::DOUBLE AS frequency, n, w
  FROM fx_words WHERE n >= 3 AND length(w) >= 3),
fx_lex AS (
  SELECT word, base, pos, frequency FROM (
    SELECT lower(word) AS word, base, pos, frequency,
      row_number() OVER (PARTITION BY lower(word) ORDER BY n ASC, w DESC) AS rn
    FROM fx_lex_raw
    WHERE frequency IS NOT NULL AND (base IS NULL OR base NOT IN ('unknown', 'UNKNOWN'))
      AND (pos IS NULL OR NOT contains(pos, '$'))) WHERE rn = 1),
affixes AS ({_affix_values()})
"""


def segment_ctes(source: str = "fx_de", keys: tuple[str, ...] = ("doc_id",)) -> str:
    """Sentences and candidate tokens of ``source`` (columns: keys, text)."""
    k = ", ".join(keys)
    return f"""sents_all AS (
  SELECT {k}, sent_pos::INTEGER AS sent_pos, {strip('raw_sentence')} AS sentence FROM (
    SELECT {k}, unnest(arr) AS raw_sentence, unnest(range(len(arr))) AS sent_pos
    FROM (SELECT {k}, regexp_extract_all({strip('text')}, {q(SENTENCE_RE)}) AS arr FROM {source}))),
sents_tok AS (SELECT *, regexp_extract_all(sentence, {q(TOKEN_RE)}) AS toks FROM sents_all),
sents AS (SELECT {k}, sent_pos, sentence, toks FROM sents_tok WHERE len(toks) BETWEEN 10 AND 100),
toks_all AS (
  SELECT {k}, sent_pos, sentence, CASE WHEN tok_pos = 0 THEN lower(raw_token) ELSE raw_token END AS token, tok_pos::INTEGER AS tok_pos
  FROM (SELECT {k}, sent_pos, sentence, unnest(toks) AS raw_token, unnest(range(len(toks))) AS tok_pos FROM sents)),
toks AS (SELECT * FROM toks_all WHERE length(token) >= 5 AND NOT regexp_matches(token, '\\p{{Nd}}'))"""


def _dictionary(vocab: bool, lexicon: bool) -> str:
    lex = "SELECT word, base, pos FROM fx_lex" if lexicon else "SELECT word, base, pos FROM fx_lex WHERE false"
    if not vocab:
        return f"""dict AS (SELECT word AS key, true AS in_lexicon, base AS lex_base, pos AS lex_pos,
  false AS base_in_vocab, false AS in_vocab FROM ({lex}))"""
    return f"""lexd AS ({lex}),
dict AS (
  SELECT coalesce(l.word, v.token) AS key, l.word IS NOT NULL AS in_lexicon, l.base AS lex_base, l.pos AS lex_pos,
    coalesce(l.base IS NOT NULL AND lower(l.base) IN (SELECT token FROM fx_vocab), false) AS base_in_vocab,
    v.token IS NOT NULL AS in_vocab
  FROM lexd l FULL OUTER JOIN fx_vocab v ON l.word = v.token)"""


def _types(vocab: bool) -> str:
    gate = "WHERE lower(token) NOT IN (SELECT token FROM fx_vocab)" if vocab else ""
    return f"types AS (SELECT token, count(*) AS count FROM toks {gate} GROUP BY token)"


PREFIX_RULE = f"""CASE
  WHEN {cons('c.stem')} OR c.prefix IN {inlist(R.PREFIX_NO_BASE)} THEN NULL
  WHEN c.prefix IN {inlist(R.PREFIX_VERBAL)} AND NOT starts_with(c.stem, 'ge') AND {low('c.token')}
       AND length(c.stem) > 6 AND ends_with(c.stem, 'ende') THEN {cut('c.stem', 2)}
  WHEN c.prefix IN {inlist(R.PREFIX_VERBAL)} AND NOT starts_with(c.stem, 'ge') AND {low('c.token')}
       AND length(c.stem) > 6 AND ends_with(c.stem, 'enden') THEN {cut('c.stem', 3)}
  WHEN c.prefix IN {inlist(R.PREFIX_VERBAL)} AND NOT starts_with(c.stem, 'ge') AND {low('c.token')}
       AND (ends_with(c.stem, 'en') OR ends_with(c.stem, 'ern')) THEN c.stem
  WHEN c.prefix IN {inlist(R.PREFIX_LATINATE)} AND ends_with(c.stem, 'e') THEN {cut('c.stem', 1)}
  WHEN c.prefix IN {inlist(R.PREFIX_LATINATE)} AND ends_with(c.stem, 'en') THEN {cut('c.stem', 2)}
  WHEN c.prefix IN {inlist(R.PREFIX_LATINATE)} AND (ends_with(c.stem, 'ion') OR ends_with(c.stem, 'nal')) THEN c.stem
END"""

SECOND_LAST = "substr(c.stem, length(c.stem) - 1, 1)"

SUFFIX_RULE = f"""CASE
  WHEN {cons('c.stem')} THEN NULL
  WHEN c.suffix IN {inlist(R.SUFFIX_CONFIX)} THEN NULL
  WHEN c.suffix IN {inlist(R.SUFFIX_BASE_IS_STEM)} THEN c.stem
  WHEN c.suffix = 'ung' THEN lower(c.stem || CASE WHEN ends_with(c.stem, 'r') THEN 'n' ELSE 'en' END)
  WHEN c.suffix = 'lich' THEN CASE
      WHEN contains(c.stem, 'äu') THEN {title("replace(c.stem, 'ä', 'a')")}
      WHEN contains(c.stem, 'ö') THEN {title("replace(c.stem, 'ö', 'o')")}
      WHEN ends_with(c.stem, 'er') THEN c.stem || 'n'
      ELSE c.stem || 'en' END
  WHEN c.suffix = 'er' THEN CASE WHEN ends_with(c.stem, 'tik') THEN c.stem ELSE lower(c.stem || 'en') END
  WHEN c.suffix = 'ig' AND ends_with(c.stem, 'r') AND {cons(SECOND_LAST)} AND {SECOND_LAST} NOT IN ('r', 'h')
       THEN {cut('c.stem', 1)} || 'er'
  WHEN c.suffix IN ('ig', 'isch') THEN pr.lex_base
  WHEN c.suffix = 'weise' THEN CASE WHEN ends_with(c.stem, 's') THEN {cut('c.stem', 1)}
       WHEN ends_with(c.stem, 'er') THEN {cut('c.stem', 2)} ELSE c.stem END
  WHEN c.suffix = 'bar' THEN c.stem || CASE WHEN ends_with(c.stem, 'er') THEN 'n' ELSE 'en' END
  WHEN c.suffix = 'e' THEN lower(c.stem)
  WHEN c.suffix IN ('end', 'nd') THEN lower(c.stem) ||
       CASE WHEN ends_with(c.stem, 'e') OR ends_with(c.stem, 'r') OR ends_with(c.stem, 'l') THEN 'n' ELSE 'en' END
  WHEN c.suffix = 'ur' THEN CASE WHEN ends_with(c.stem, 'e') THEN {cut('c.stem', 1)} ELSE c.stem END
  WHEN c.suffix = 'dings' THEN CASE WHEN ends_with(c.stem, 'er') THEN {cut('c.stem', 2)} ELSE c.stem END
  WHEN c.suffix = 'ell' THEN {title("CASE WHEN ends_with(c.stem, 'in') THEN c.stem || 'al' ELSE c.stem END")}
  WHEN c.suffix = 'los' THEN CASE WHEN ends_with(c.stem, 's') THEN {cut('c.stem', 1)} ELSE c.stem END
  WHEN c.suffix = 'ner' THEN pr.lex_base
END"""

LAST = "right(c.stem, 1)"

SUFFIX_ELIM = f"""coalesce(
     (c.suffix = 'chen' AND ({LAST} = 's' OR NOT {cons(LAST)}))
  OR (c.suffix IN {inlist(R.SUFFIX_DROP_IF_LOWER)} AND {low('c.token')})
  OR (c.suffix IN {inlist(R.SUFFIX_DROP_IF_UPPER)} AND {up('c.token')})
  OR (c.suffix = 'e' AND NOT ({up('c.stem')} AND coalesce(l1.in_lexicon, false)
                               AND coalesce(l1.lex_pos IN {inlist(R.ADJ_POS)}, false)))
  OR (c.suffix = 'age' AND (ends_with(c.stem, 'sl') OR ends_with(c.stem, 'st') OR {cons('right(c.stem, 3)')}))
  OR c.suffix = 'ens'
  OR (c.suffix = 'ette' AND pr.key IS NOT NULL)
  OR (c.suffix IN {inlist(R.SUFFIX_NEED_CONSONANT)} AND NOT {cons(LAST)})
  OR (c.suffix = 'tel' AND {LAST} = 't')
  OR (c.suffix = 'er' AND {LAST} = 'i'), false)"""

PREFIX_ELIM = f"""coalesce((c.prefix = 'a' AND starts_with(c.stem, 'b'))
  OR (c.prefix IN {inlist(R.PREFIX_DROP_IF_UPPER)} AND {up('c.token')}), false)"""


def analysis_ctes(vocab: bool = True, lexicon: bool = True, pre: str = "", source: str = "fx_de",
                  keys: tuple[str, ...] = ("doc_id",)) -> str:
    vt = "true" if not vocab else None
    in_lexica = "coalesce(l1.in_lexicon, false)" + ("" if not vocab else " AND coalesce(l1.base_in_vocab, false)")
    stem_ok = vt or "coalesce(l1.in_vocab, false)"
    base_ok = vt or "bv.key IS NOT NULL"
    fixtures = FIXTURE_LEX + (",\n" + pre if pre else "") + ",\n" + segment_ctes(source, keys)
    okeys = ", ".join(f"o.{x}" for x in keys)
    return f"""{fixtures},
{_dictionary(vocab, lexicon)},
{_types(vocab)},
m AS (
  SELECT t.token, a.affix, a.kind FROM types t JOIN affixes a
    ON (a.kind = 'prefix' AND starts_with(lower(t.token), a.affix))
    OR (a.kind = 'suffix' AND ends_with(lower(t.token), a.affix))),
mt AS (
  SELECT token, count(*) FILTER (WHERE kind = 'prefix') AS np, count(*) FILTER (WHERE kind = 'suffix') AS ns,
    coalesce(bool_or(kind = 'suffix' AND affix = 'ier'), false) AND coalesce(bool_or(kind = 'suffix' AND affix = 'er'), false) AS ier_er0
  FROM m GROUP BY token),
cand0 AS (
  SELECT mt.token, 'prefix' AS mode, p.affix AS prefix, NULL::VARCHAR AS suffix, false AS ier_er
    FROM mt JOIN m p ON p.token = mt.token AND p.kind = 'prefix' WHERE mt.ns = 0
  UNION ALL
  SELECT mt.token, 'suffix', NULL, s.affix, mt.ier_er0
    FROM mt JOIN m s ON s.token = mt.token AND s.kind = 'suffix' WHERE mt.np = 0
  UNION ALL
  SELECT mt.token, 'both', p.affix, s.affix, false
    FROM mt JOIN m p ON p.token = mt.token AND p.kind = 'prefix'
            JOIN m s ON s.token = mt.token AND s.kind = 'suffix' WHERE mt.np > 0 AND mt.ns > 0),
cand AS (
  SELECT *, substr(token, lp + 1, greatest(length(token) - lp - ls, 0)) AS stem, -lp AS ord_p, ls AS ord_s
  FROM (SELECT *, coalesce(length(prefix), 0) AS lp, coalesce(length(suffix), 0) AS ls FROM cand0)),
ev0 AS (
  SELECT c.*, l1.lex_base AS lstem_base,
    {in_lexica} AS in_lexica,
    coalesce(tk.in_lexicon AND tk.lex_pos IN {inlist(R.BAD_POS)}, false)
      OR coalesce(c.stem = lower(c.stem) AND l1.in_lexicon AND l1.lex_pos IN {inlist(R.BAD_POS)}, false) AS bad_pos,
    (c.prefix IS NOT NULL AND {PREFIX_ELIM}) OR (c.suffix IS NOT NULL AND {SUFFIX_ELIM}) AS eliminated,
    CASE WHEN c.mode = 'prefix' THEN {PREFIX_RULE} ELSE {SUFFIX_RULE} END AS rule_base,
    {stem_ok} AS stem_ok
  FROM cand c
  LEFT JOIN dict tk ON tk.key = c.token
  LEFT JOIN dict l1 ON l1.key = lower(c.stem)
  LEFT JOIN dict pr ON pr.in_lexicon AND pr.key = CASE c.suffix
      WHEN 'ig' THEN c.stem || 'e' WHEN 'isch' THEN c.stem || 'e'
      WHEN 'ner' THEN c.stem || 'en' WHEN 'ette' THEN c.stem || 'et' END
  WHERE length(c.stem) > 3),
ev AS (
  SELECT e.*,
    CASE WHEN e.in_lexica AND (e.mode = 'prefix' OR e.suffix <> 'end') THEN e.lstem_base
         WHEN e.rule_base IS NOT NULL AND {base_ok}
              AND length(e.rule_base) >= CASE e.mode WHEN 'prefix' THEN 4 WHEN 'suffix' THEN 3 ELSE 0 END
         THEN e.rule_base END AS r_base,
    CASE WHEN e.stem_ok THEN e.stem END AS r_stem
  FROM ev0 e LEFT JOIN dict bv ON bv.in_vocab AND bv.key = lower(e.rule_base)),
surv AS (
  SELECT *, row_number() OVER (PARTITION BY token ORDER BY ord_p, ord_s) AS rk,
    count(*) OVER (PARTITION BY token) AS nsurv
  FROM ev WHERE NOT bad_pos AND NOT eliminated AND (r_base IS NOT NULL OR r_stem IS NOT NULL)),
pick AS (
  SELECT f.token, coalesce(
      (SELECT min(x.rk) FROM surv x WHERE x.token = f.token AND x.in_lexica),
      CASE WHEN f.nsurv >= 2 AND ((f.mode = 'prefix' AND f.prefix = 'erz' AND s.prefix = 'er') OR f.ier_er) THEN 2 END,
      1) AS rk
  FROM surv f LEFT JOIN surv s ON s.token = f.token AND s.rk = 2 WHERE f.rk = 1),
analyses AS (
  SELECT s.token, s.mode, s.prefix, s.suffix,
    CASE s.mode WHEN 'prefix' THEN s.prefix WHEN 'suffix' THEN s.suffix
         ELSE '(''' || s.prefix || ''', ''' || s.suffix || ''')' END AS affix,
    s.r_base AS base, s.r_stem AS stem, s.in_lexica
  FROM surv s JOIN pick p ON p.token = s.token AND p.rk = s.rk),
summary AS (SELECT a.*, t.count FROM analyses a JOIN types t USING (token)),
long AS (
  SELECT {okeys}, o.sent_pos, o.tok_pos, a.*, {sanitize_text('o.sentence')} AS context
  FROM toks o JOIN analyses a USING (token))"""


SUMMARY_COLS = "token, mode, prefix, suffix, affix, base, stem, in_lexica, count"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _bins() -> str:
    rows = ", ".join(f"({b}, {lo}, {hi if hi is not None else 'NULL'})" for b, lo, hi in BINS)
    return f"bins AS (SELECT * FROM (VALUES {rows}) t(bin, lo, hi))"


def _merged(ctes: str) -> str:
    return f"""{ctes},
merged AS (SELECT token, affix, base, in_lexica, stem, mode, prefix, suffix, sum(count)::BIGINT AS count
  FROM summary GROUP BY ALL)"""


def _rows_ctes() -> str:
    return f"""{analysis_ctes()},
{_bins()},
rows AS (
  SELECT l.token, l.doc_id, l.sent_pos, l.tok_pos, l.mode, b.bin, l.base, l.stem
  FROM long l JOIN summary s USING (token)
  JOIN bins b ON s.count >= b.lo AND (b.hi IS NULL OR s.count <= b.hi))"""


def _key_split(key: str) -> str:
    return _with(
        _rows_ctes() + ",",
        f"""keys AS (SELECT DISTINCT mode, bin, {key} AS k FROM rows),
kr AS (SELECT *, row_number() OVER (PARTITION BY mode, bin ORDER BY
         md5(concat_ws('|', '{SEED}', mode, bin::VARCHAR, coalesce(k, {q(NULL_KEY)})))) - 1 AS rk,
       count(*) OVER (PARTITION BY mode, bin) AS kn FROM keys),
ks AS (SELECT mode, bin, k, CASE WHEN rk < floor({SIZE_TRAIN!r}::DOUBLE * kn) THEN 'train'
         WHEN rk < floor({SIZE_TRAIN!r}::DOUBLE * kn) + floor({SIZE_TEST!r}::DOUBLE * kn) THEN 'test'
         ELSE 'dev' END AS split FROM kr WHERE k IS NOT NULL)
SELECT r.token, r.doc_id, r.sent_pos, r.tok_pos, r.mode, r.bin, r.base, r.stem, ks.split
FROM rows r JOIN ks ON ks.mode = r.mode AND ks.bin = r.bin AND ks.k = r.{key}""",
    )


def _shared() -> str:
    rest = SIZE_TEST / (1 - SIZE_TRAIN)
    return _with(
        _rows_ctes() + ",",
        f"""h AS (SELECT *, md5(concat_ws('|', '{SEED}', mode, bin::VARCHAR, token, doc_id::VARCHAR,
                         sent_pos::VARCHAR, tok_pos::VARCHAR)) AS h FROM rows),
r AS (SELECT *, row_number() OVER (PARTITION BY mode, bin ORDER BY h) - 1 AS rk,
        count(*) OVER (PARTITION BY mode, bin) AS n FROM h),
s AS (SELECT *, round_even({SIZE_TRAIN!r}::DOUBLE * n, 0) AS n_train FROM r),
s2 AS (SELECT *, round_even({rest!r}::DOUBLE * (n - n_train), 0) AS n_test FROM s)
SELECT token, doc_id, sent_pos, tok_pos, mode, bin, base, stem,
  CASE WHEN rk < n_train THEN 'train' WHEN rk < n_train + n_test THEN 'test' ELSE 'dev' END AS split
FROM s2""",
    )


def _monthly() -> str:
    return f"""{analysis_ctes()},
mcounts AS (SELECT doc_id % 12 AS month, token, count(*) AS count FROM toks
  WHERE lower(token) NOT IN (SELECT token FROM fx_vocab) GROUP BY ALL),
msum AS (SELECT a.*, c.month, c.count FROM analyses a JOIN mcounts c USING (token))"""


def _monthly_merge(increment: bool) -> str:
    base = _monthly()
    if not increment:
        return _with(base, f"""SELECT token, affix, base, in_lexica, stem, mode, prefix, suffix, sum(count)::BIGINT AS count
FROM msum GROUP BY ALL""")
    return _with(base + """,
old AS (SELECT token, affix, base, in_lexica, stem, mode, prefix, suffix, sum(count)::BIGINT AS count
  FROM msum WHERE month < 11 GROUP BY ALL),
new AS (SELECT token, affix, base, in_lexica, stem, mode, prefix, suffix, sum(count)::BIGINT AS count
  FROM msum WHERE month = 11 GROUP BY ALL)""", """SELECT token, affix, base, in_lexica, stem, mode, prefix, suffix, sum(count)::BIGINT AS count
FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY ALL""")


def _duplicates() -> str:
    a = analysis_ctes(lexicon=True)
    b = analysis_ctes(lexicon=False)
    return f"""WITH runa AS (WITH {a} SELECT {SUMMARY_COLS} FROM summary),
runb AS (WITH {b} SELECT {SUMMARY_COLS} FROM summary),
merged AS (SELECT token, affix, base, in_lexica, stem, mode, prefix, suffix, sum(count)::BIGINT AS count
  FROM (SELECT * FROM runa UNION ALL SELECT * FROM runb) GROUP BY ALL)
SELECT {SUMMARY_COLS} FROM merged
WHERE token IN (SELECT token FROM merged GROUP BY token HAVING count(*) > 1)"""


ANALYSIS_KEYS = "token, affix, base, in_lexica, stem, mode"


def _wide(keys: list[str], most: int) -> str:
    """Contexts per analysis in rows of about ``most``; ``keys`` name an occurrence."""
    h = "('0x' || substr(md5(concat_ws('|', " + ", ".join(f"{k}::VARCHAR" for k in keys) + ")), 1, 8))::BIGINT"
    return _with(analysis_ctes() + ",", f"""whole AS (SELECT {ANALYSIS_KEYS}, count(*)::BIGINT AS count FROM long GROUP BY ALL),
lp AS (SELECT l.*, w.count, CASE WHEN w.count > {most} THEN ceil(w.count / {most}::DOUBLE) ELSE 1 END::INTEGER AS n_parts
  FROM (SELECT *, doc_id % 12 AS month FROM long) l JOIN (SELECT token, count FROM whole) w USING (token)),
parts AS (SELECT *, ({h} % n_parts)::INTEGER AS part FROM lp)
SELECT {ANALYSIS_KEYS}, part, n_parts, count, count(*)::BIGINT AS part_count,
  string_agg(context, '␞' ORDER BY {", ".join(keys)}, context) AS contexts
FROM parts GROUP BY {ANALYSIS_KEYS}, part, n_parts, count""")


def _sentence_ctes() -> str:
    """Words of all documents, scores of types and of words behind others."""
    spaces = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
    opening, closing, marks = "\"'([{<„“”‚‘»«›‹*_~", "\"')]}>“”’‘»«›‹*_~", ".,;:!?…"
    piece = f"[^{WS[1:-1]}]+[{WS[1:-1]}]*"

    def lnl(k: str, n: str, p: str) -> str:
        return f"(CASE WHEN {k} > 0 THEN {k} * ln({p}) ELSE 0 END + CASE WHEN {n} > {k} THEN ({n} - {k}) * ln(1 - {p}) ELSE 0 END)"

    return f"""WITH sm_lists AS (SELECT doc_id, regexp_extract_all(text, {q(piece)}) AS ps FROM documents),
sm_pieces AS (SELECT doc_id, unnest(range(len(ps))) AS i, unnest(ps) AS piece FROM sm_lists),
sm_cores AS (SELECT *, ltrim(rtrim(piece, {q(spaces + closing)}), {q(opening)}) AS core FROM sm_pieces),
sm_bare AS (SELECT *, rtrim(core, {q(marks)}) AS bare FROM sm_cores),
sm_typed AS (SELECT doc_id, i, piece, substr(core, length(bare) + 1) AS tail, regexp_matches(core, '^\\p{{Lu}}') AS up, contains(piece, chr(10)) AS nl,
  CASE WHEN regexp_full_match(bare, '[0-9]+([.,:][0-9]+)*') THEN '#' ELSE lower(bare) END AS type FROM sm_bare),
sm_words AS (SELECT *, type = '#' OR regexp_matches(type, '\\p{{L}}') AS known, regexp_full_match(tail, '[.][,;:]*') AS dot,
  regexp_matches(tail, '[.!?]$') AND NOT regexp_full_match(tail, '[.]+') AS sure FROM sm_typed),
sm_next AS (SELECT *, lead(type) OVER w AS next_type, lead(known) OVER w AS next_known, lead(up) OVER w AS next_up
  FROM sm_words WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
sm_types AS (SELECT type, count(*) AS n, count(*) FILTER (WHERE dot) AS n_dot FROM sm_words WHERE known GROUP BY type),
sm_all AS (SELECT sum(n)::DOUBLE AS words, (sum(n_dot) + 1)::DOUBLE / (sum(n) + 2) AS p FROM sm_types),
sm_long AS (SELECT sm_types.*, words, p, length(replace(type, '.', '')) AS letters FROM sm_types, sm_all),
sm_scored AS (SELECT type, n, n_dot, round(1000 * 2 * (n_dot * (ln(0.99) - ln(p)) + (n - n_dot) * (ln(0.01) - ln(1 - p)))
  * (length(type) - letters + 1) * exp(-letters - (n - n_dot) * ln(letters)))::BIGINT AS score FROM sm_long),
sm_abbr AS (SELECT type, n, n_dot, score, type <> '#' AND score >= 300 AS abbreviation FROM sm_scored),
sm_short AS (SELECT type FROM sm_abbr WHERE abbreviation AND n_dot >= 2),
sm_left AS (SELECT CASE WHEN dot AND (type = '#' OR regexp_full_match(type, '\\p{{L}}') OR type IN (FROM sm_short)) THEN type
  WHEN sure OR tail = '.' THEN '' END AS lft, next_type AS rgt FROM sm_next WHERE known AND NOT nl AND next_known),
sm_both AS (SELECT lft, rgt, count(*) AS k FROM sm_left WHERE lft IS NOT NULL GROUP BY ALL),
sm_odds AS (SELECT lft, rgt, k, sum(k) OVER (PARTITION BY lft) AS nl, n AS nr, words FROM sm_both JOIN sm_types ON type = rgt, sm_all),
sm_rates AS (SELECT *, k / nl AS p1, CASE WHEN words > nl THEN (nr - k) / (words - nl) ELSE 0 END AS p2, nr / words AS p FROM sm_odds),
sm_follow AS (SELECT lft, rgt, nl, nr, k, round(1000 * CASE WHEN p1 > p THEN 1 ELSE -1 END * 2 * ({lnl('k', 'nl', 'p1')}
  + {lnl('(nr - k)', '(words - nl)', 'p2')} - {lnl('k', 'nl', 'p')} - {lnl('(nr - k)', '(words - nl)', 'p')}))::BIGINT AS score FROM sm_rates)"""


def _sentences_learned() -> str:
    return f"""{_sentence_ctes()},
sm_start AS (SELECT rgt FROM sm_follow WHERE lft = '' AND k >= 2 AND score >= 30000),
sm_ordinal AS (SELECT rgt FROM sm_follow WHERE lft = '#' AND k >= 2 AND score >= 7880 AND rgt NOT IN (FROM sm_start)),
sm_ends AS (SELECT doc_id, i, piece, CASE WHEN next_type IS NULL OR nl THEN true
  WHEN tail = '.' AND type = '#' THEN next_up AND next_type NOT IN (FROM sm_ordinal)
  WHEN tail = '.' AND (regexp_full_match(type, '\\p{{L}}') OR type IN (FROM sm_short)) THEN next_up AND next_type IN (FROM sm_start)
  WHEN tail = '.' THEN true
  WHEN regexp_full_match(tail, '[.][.]+|…') THEN next_up
  ELSE sure END AS ends FROM sm_next),
sm_placed AS (SELECT *, coalesce(sum(ends::INTEGER) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM sm_ends)
SELECT doc_id, place::INTEGER AS sent_pos, regexp_replace(string_agg(piece, '' ORDER BY i), {q(WS + '+$')}, '') AS sentence FROM sm_placed GROUP BY doc_id, place"""


# exceptions of the rule tokeniser
EXCEPTIONS = (
    "abs. allg. bspw. bzgl. bzw. ca. dipl. dr. ebd. etc. evtl. exkl. fr. ggf. hr. hrsg. inkl. jh. kap. max. min. "
    "mio. mrd. nr. prof. s. sog. st. str. tel. u. usf. usw. v. vgl. vs. zzgl. :) :( ;) :D :P :/ :-) :-( ;-) :-D <3 ^^"
).split()
TWO_TOKENS = "z.B. d.h. u.a. z.T. i.d. s.o. s.u. o.ä. v.a. m.E. i.A. n.Chr. v.Chr.".split()


def _tokens_ruled() -> str:
    """Distinct words are peeled mark by mark in a recursive CTE."""
    opening, closing = "\"'([{<„“”‚‘’»«›‹¿¡§#*_~", ".,;:!?…\"')]}>“”‘’»«›‹%€$°*_~"
    whole = sorted({x for w in EXCEPTIONS for x in (w, w[0].upper() + w[1:])} | {x for w in TWO_TOKENS for x in (w, w[0].upper() + w[1:])})
    two = sorted({x for w in TWO_TOKENS for x in (w, w[0].upper() + w[1:])})
    number, address = "[+-]?[0-9]+([.,:/–-][0-9]+)*", "^([A-Za-z][A-Za-z0-9+.-]*://|www[.])|^[^@]+@[^@]+[.][^@]+$"
    inner = '([/&=<>:;,!?…()\\[\\]{}"“”„«»]|--+)'
    stop = f"""(rest IN {inlist(whole)} OR regexp_full_match(rest, '\\p{{L}}[.]') OR (regexp_full_match(rest, '[0-9]+[.]') AND NOT (final AND rgt = '')))"""
    front = f"(rest <> '' AND contains({q(opening)}, substr(rest, 1, 1)))"
    back = f"(rest <> '' AND contains({q(closing)}, right(rest, 1)))"
    cut = f"""regexp_replace(regexp_replace(regexp_replace(rest, {q(inner)}, chr(31) || '\\1' || chr(31), 'g'),
    '(\\p{{Ll}})[.](\\p{{Lu}})', '\\1' || chr(31) || '.' || chr(31) || '\\2', 'g'), '(\\p{{L}})([''’][sS])$', '\\1' || chr(31) || '\\2')"""
    return f"""WITH RECURSIVE rt_lists AS (SELECT doc_id, regexp_extract_all(text, {q(NOT_WS + '+')}) AS ws FROM documents WHERE text IS NOT NULL),
rt_words AS (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS w, len(ws) AS n FROM rt_lists),
rt_peel(w, final, lft, rest, rgt) AS (
  SELECT DISTINCT w, i = n - 1, '', w, '' FROM rt_words
  UNION ALL
  SELECT w, final, CASE WHEN {front} THEN lft || substr(rest, 1, 1) ELSE lft END,
    CASE WHEN {front} THEN substr(rest, 2) ELSE left(rest, length(rest) - 1) END,
    CASE WHEN {front} THEN rgt ELSE right(rest, 1) || rgt END
  FROM rt_peel WHERE NOT {stop} AND ({front} OR {back})),
rt_left AS (SELECT * FROM rt_peel WHERE {stop} OR NOT ({front} OR {back})),
rt_tokens AS (SELECT w, final, list_concat(list_concat(regexp_extract_all(lft, '[.][.]+|.'),
  CASE WHEN rest IN {inlist(two)} THEN [split_part(rest, '.', 1) || '.', split_part(rest, '.', 2) || '.']
    WHEN {stop} OR regexp_full_match(rest, {q(number)}) OR regexp_matches(rest, {q(address)}) THEN [rest]
    ELSE [x FOR x IN string_split({cut}, chr(31)) IF x <> ''] END), regexp_extract_all(rgt, '[.][.]+|.')) AS toks FROM rt_left),
rt_docs AS (SELECT doc_id, sum(len(toks)) AS n, string_agg(array_to_string(toks, ' '), ' ' ORDER BY i) AS joined
  FROM rt_words JOIN rt_tokens ON rt_words.w = rt_tokens.w AND (i = n - 1) = final GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::INTEGER AS n_tokens, md5(coalesce(joined, '')) AS tokens_md5 FROM rt_lists LEFT JOIN rt_docs USING (doc_id)"""


def _language_ctes() -> str:
    """Hashed character trigrams of every document and the weights learned from four of five."""
    letters = r"regexp_replace(regexp_replace(lower(text), '\P{L}+', ' ', 'g'), '[\x{10000}-\x{10FFFF}]', chr(65533), 'g')"
    return f"""WITH lm_text AS (SELECT doc_id, lang, ' ' || trim({letters}) || ' ' AS s FROM documents),
lm_grams AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3))) AS g FROM lm_text),
lm_hits AS (
  SELECT doc_id, lang, (unicode(substr(g, 1, 1)) * 17161 + unicode(substr(g, 2, 1)) * 131 + unicode(substr(g, 3, 1))) % 8192 AS bucket
  FROM lm_grams),
lm_counts AS (SELECT lang, bucket, count(*) AS n FROM lm_hits WHERE doc_id % 5 <> 0 AND lang IS NOT NULL GROUP BY ALL),
lm_totals AS (SELECT lang, sum(n)::BIGINT AS total FROM lm_counts GROUP BY lang),
lm_weights AS (
  SELECT t.lang, b.bucket::INTEGER AS bucket, floor(1000 * ln((coalesce(c.n, 0) + 1)::DOUBLE / (t.total + 8192)))::BIGINT AS weight
  FROM lm_totals t CROSS JOIN (SELECT unnest(range(8192)) AS bucket) b
  LEFT JOIN lm_counts c ON c.lang = t.lang AND c.bucket = b.bucket)"""


def _language_learned() -> str:
    return f"""{_language_ctes()},
lm_sums AS (
  SELECT h.doc_id, w.lang, sum(h.k * w.weight) AS total
  FROM (SELECT doc_id, bucket, count(*) AS k FROM lm_hits GROUP BY ALL) h JOIN lm_weights w USING (bucket) GROUP BY ALL),
lm_best AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY total DESC, lang) AS place FROM lm_sums)
SELECT d.doc_id, d.doc_id % 5 = 0 AS held_out, b.lang AS lang_pred
FROM documents d LEFT JOIN (SELECT * FROM lm_best WHERE place = 1) b USING (doc_id)"""


def _corpora() -> str:
    return f"""SELECT 'shared' AS condition, * FROM ({_shared()})
UNION ALL SELECT 'split_base' AS condition, * FROM ({_key_split('base')})
UNION ALL SELECT 'split_stem' AS condition, * FROM ({_key_split('stem')})"""


def _conversations() -> str:
    pre = f"""conv_clean AS (SELECT conv_id, turn, text, {sanitize_body('text')} AS clean_body FROM conversations),
conv_scored AS (SELECT conv_id, turn, text, clean_body,
    {_stop_counts('clean_body')} FROM conv_clean),
conv_de AS (SELECT conv_id, turn, text FROM conv_scored
  WHERE length(clean_body) >= 31 AND clean_body <> '[deleted]' AND {_lang_pred()} = 'de')"""
    return _with(analysis_ctes(pre=pre, source="conv_de", keys=("conv_id", "turn")), f"SELECT {SUMMARY_COLS} FROM summary")


def _kept(text: str) -> str:
    """Comments that pass the comment filter, with ``clean_body``."""
    return f"""SELECT * FROM (SELECT *, {_stop_counts('clean_body')} FROM (
      SELECT *, {sanitize_body(text)} AS clean_body FROM documents WHERE source IN {_communities()}))
WHERE length(clean_body) >= 31 AND clean_body <> '[deleted]' AND {_lang_pred()} = 'de'"""


def _context_list() -> str:
    sentences = f"regexp_extract_all(replace(replace(text, chr(39), ''), chr(92), ''), {q(SENTENCE_RE)})"
    between = "', '"
    cuts = q(r"', '|'\]\['")
    return f"""SELECT doc_id, array_to_string(string_split_regex(substr(p, 3, length(p) - 4), {cuts}), '␞') AS contexts
FROM (SELECT doc_id, one || one AS p FROM (
  SELECT doc_id, '[' || chr(39) || array_to_string({sentences}, {q(between)}) || chr(39) || ']' AS one FROM documents))"""


ALL_WORDS = """fx_all_words AS (
  SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '\\p{L}+')) AS w FROM documents) GROUP BY w)"""


def oracle_queries() -> dict[str, str]:
    A = analysis_ctes()
    ev_cols = "token, prefix, suffix, stem"
    sample_key = (
        f"md5(concat_ws('|', '{SAMPLE_SEED}', "
        + ", ".join(f"coalesce({c}::VARCHAR, {q(NULL_KEY)})" for c in ["token", "affix", "base", "in_lexica", "stem", "mode"])
        + "))"
    )
    return {
        "community_filter": f"SELECT doc_id, source FROM documents WHERE source IN {_communities()}",
        "sanitize_body": f"SELECT page_id, {sanitize_body('html')} AS body, {sanitize_body('url')} AS url FROM pages",
        "sanitize_text": f"SELECT page_id, {sanitize_text('html')} AS text, {sanitize_text('url')} AS url FROM pages",
        "body_length_filter": f"""SELECT doc_id, length(c)::INTEGER AS n_clean FROM (SELECT doc_id, {sanitize_body('text')} AS c FROM documents)
WHERE length(c) >= 31 AND c <> '[deleted]'""",
        "lang_filter": f"SELECT doc_id, lang FROM (SELECT doc_id, lang, {_stop_counts()} FROM documents) WHERE {_lang_pred()} = 'de'",
        "language_labels": f"SELECT doc_id, lang, {_lang_pred()} AS lang_pred FROM (SELECT doc_id, lang, {_stop_counts()} FROM documents)",
        "language_weights": f"{_language_ctes()} SELECT lang, bucket, weight FROM lm_weights",
        "language_learned": _language_learned(),
        "comment_filter": f"SELECT doc_id, source AS subreddit, length(clean_body)::INTEGER AS n_clean FROM ({_kept('text')})",
        "sentences": _with(
            segment_ctes("documents"),
            "SELECT doc_id, sent_pos, sentence, len(toks)::INTEGER AS n_tokens, len(toks) BETWEEN 10 AND 100 AS kept FROM sents_tok",
        ),
        "tokens": _with(segment_ctes("documents"), "SELECT doc_id, sent_pos, tok_pos, token FROM toks"),
        "abbreviation_scores": f"{_sentence_ctes()} SELECT type, n, n_dot, score, abbreviation FROM sm_abbr",
        "follower_scores": f"""{_sentence_ctes()} SELECT lft AS "left", rgt AS "right", nl::BIGINT AS n_left, nr AS n_right, k AS n_both, score FROM sm_follow""",
        "sentences_learned": _sentences_learned(),
        "tokens_ruled": _tokens_ruled(),
        "lexicon_clean": _with(
            FIXTURE_LEX.replace("FROM fx_words WHERE n >= 3 AND length(w) >= 3", "FROM fx_all_words").replace("fx_lex_raw AS (", ALL_WORDS + ",\nfx_lex_raw AS (", 1),
            "SELECT word, base, pos, frequency FROM fx_lex",
        ),
        "vocab_gate": _with(A, "SELECT token, count FROM types"),
        "vocab_gate_bloom": _with(A, "SELECT token, count FROM types"),
        "affix_match": _with(A, """SELECT token,
  coalesce(string_agg(affix, ',' ORDER BY affix) FILTER (WHERE kind = 'prefix'), '') AS prefixes,
  coalesce(string_agg(affix, ',' ORDER BY affix) FILTER (WHERE kind = 'suffix'), '') AS suffixes
FROM m GROUP BY token"""),
        "candidates": _with(A, "SELECT token, mode, prefix, suffix, stem FROM cand"),
        "lexicon_probe": _with(A, f"SELECT {ev_cols}, in_lexica, lstem_base AS lex_base, bad_pos FROM ev"),
        "prefix_elimination": _with(A, f"SELECT {ev_cols}, eliminated FROM ev WHERE prefix IS NOT NULL"),
        "suffix_elimination": _with(A, f"SELECT {ev_cols}, eliminated FROM ev WHERE suffix IS NOT NULL"),
        "prefix_base": _with(A, "SELECT token, prefix, stem, rule_base FROM ev WHERE mode = 'prefix'"),
        "suffix_base": _with(A, f"SELECT {ev_cols}, rule_base FROM ev WHERE mode <> 'prefix'"),
        "analyses": _with(A, "SELECT token, mode, prefix, suffix, affix, base, stem, in_lexica FROM analyses"),
        "analyses_bloom": _with(A, "SELECT token, mode, prefix, suffix, affix, base, stem, in_lexica FROM analyses"),
        "derivatives": _with(A, f"SELECT {SUMMARY_COLS} FROM summary"),
        "derivative_contexts": _with(
            A, "SELECT doc_id, sent_pos, tok_pos, token, mode, prefix, suffix, affix, base, stem, in_lexica, context FROM long"
        ),
        "derivative_contexts_shuffled": _with(
            A, "SELECT doc_id, sent_pos, tok_pos, token, mode, prefix, suffix, affix, base, stem, in_lexica, context FROM long"
        ),
        "derivatives_no_vocab": _with(analysis_ctes(vocab=False), f"SELECT {SUMMARY_COLS} FROM summary"),
        "month_merge": _monthly_merge(False),
        "stream_merge": _monthly_merge(False),
        "month_merge_contexts": _wide(["month", "doc_id", "sent_pos", "tok_pos"], 2),
        "merge_increment": _monthly_merge(True),
        "duplicate_analyses": _duplicates(),
        "review_sample": _with(_merged(A), f"SELECT {SUMMARY_COLS} FROM merged ORDER BY {sample_key} LIMIT 100"),
        "productivity": _with(_merged(A), """SELECT mode, affix, count(*) AS v, sum(count)::BIGINT AS n,
  count(*) FILTER (WHERE count = 1) AS abshapax FROM merged GROUP BY mode, affix"""),
        "productivity_by_mode": _with(_merged(A), """SELECT mode, affix, count(*) AS v, sum(count)::BIGINT AS n,
  count(*) FILTER (WHERE count = 1) AS abshapax FROM merged WHERE mode IN ('suffix', 'both') GROUP BY mode, affix"""),
        "frequency_bins": _with(ALL_WORDS + "," + _bins(), """SELECT w, n, bin FROM fx_all_words
JOIN bins ON n >= lo AND (hi IS NULL OR n <= hi)"""),
        "mode_split": _with(_merged(A), "SELECT mode, count(*) AS types, sum(count)::BIGINT AS tokens FROM merged GROUP BY mode"),
        "shared_split": _shared(),
        "split_by_base": _key_split("base"),
        "split_by_stem": _key_split("stem"),
        "derivatives_wide": _wide(["doc_id", "sent_pos", "tok_pos"], 10_000),
        "corpora": _corpora(),
        "conversation_derivatives": _conversations(),
        "comments_scan": """SELECT doc_id::VARCHAR AS id, source AS subreddit, length(text)::INTEGER AS n_body, md5(text) AS body_md5, 2019 AS year,
  (doc_id % 12 + 1)::INTEGER AS month, text IS NULL AS corrupt FROM documents
UNION ALL SELECT NULL, NULL, NULL, NULL, 2019, (doc_id % 12 + 1)::INTEGER, true FROM documents WHERE doc_id % 10 = 0""",
        "line_status": """SELECT month, status, count(*) AS n FROM (
  SELECT 0 AS month, CASE WHEN doc_id % 3 = 0 THEN 'no_body' WHEN doc_id % 5 = 0 THEN 'null_body' WHEN text IS NULL THEN 'no_body' ELSE 'comment' END AS status FROM documents
  UNION ALL SELECT (doc_id % 12 + 1)::INTEGER, CASE WHEN text IS NULL THEN 'no_body' ELSE 'comment' END FROM documents
  UNION ALL SELECT (doc_id % 12 + 1)::INTEGER, 'not_json' FROM documents WHERE doc_id % 10 = 0) GROUP BY month, status""",
        "dump_source": """SELECT doc_id::VARCHAR AS id, source AS subreddit, md5(text) AS body_md5, 2019 AS year,
  (doc_id % 12 + 1)::INTEGER AS month, text IS NULL AS corrupt FROM documents
UNION ALL SELECT NULL, NULL, NULL, 2019, (doc_id % 12 + 1)::INTEGER, true FROM documents WHERE doc_id % 10 = 0""",
        "dump_source_pushed": """SELECT doc_id::VARCHAR AS id, source AS subreddit, md5(text) AS body_md5, (doc_id % 12 + 1)::INTEGER AS month
FROM documents WHERE doc_id % 12 + 1 IN (3, 7) AND source IN ('src2', 'src3', 'src14')""",
        "comments_months": "SELECT doc_id::VARCHAR AS id, 2019 AS year, 3 AS month FROM documents WHERE doc_id % 12 + 1 = 3 AND text IS NOT NULL",
        "filtered_roundtrip": f"""SELECT doc_id::VARCHAR AS id, length(text)::INTEGER AS n_body, md5(text) AS body_md5, 2019 AS year, (doc_id % 12 + 1)::INTEGER AS month
FROM ({_kept('text')})""",
        "community_scan": "SELECT source, count(*) AS n FROM documents WHERE trim(source) <> '' GROUP BY source",
        "vocab_scan": "SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS token FROM documents",
        "lexicon_scan": _with(FIXTURE_LEX, "SELECT word, base, pos, frequency FROM fx_lex"),
        "monthly_tables": _with(_monthly(), f"SELECT 2019 AS year, month::INTEGER AS month, {SUMMARY_COLS} FROM msum"),
        "joined_table": _with(_merged(A), f"SELECT {SUMMARY_COLS} FROM merged"),
        "shared_roundtrip": f"SELECT 'shared' AS condition, * FROM ({_shared()})",
        "corpora_roundtrip": f"SELECT 'split_base' AS condition, * FROM ({_key_split('base')})",
        "productivity_roundtrip": _with(_merged(A), """SELECT mode, affix, count(*) AS v, sum(count)::BIGINT AS n,
  count(*) FILTER (WHERE count = 1) AS abshapax FROM merged WHERE mode = 'suffix' GROUP BY mode, affix"""),
        "corpus_run": _with(analysis_ctes(pre=f"run_docs AS ({_kept('text')})", source="run_docs"), f"SELECT {SUMMARY_COLS} FROM summary"),
        "context_list_import": _context_list(),
    }
