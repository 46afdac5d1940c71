"""The registered queries once more, as SQL for an independent engine.

The texts are taken apart into rows (sentences, words, tokens, positions) and
every rule is a join, a window or a recursive query, so nothing is shared with
the array expressions under test but the fixed word lists and patterns.
"""

from __future__ import annotations

from pathlib import Path

from tidemark.operators import ner, normalize, sentences, tagger, tokens
from tidemark.plans.pipeline import BUNDLED

# Frequent words of the documents become social-text constructs, so that every
# rule has work on the given tables. Plain replacements, the same in both engines.
NOISE = (
    (" was ", " wasn't "),
    (" have ", " can't "),
    (" from ", " not good "),
    (" this ", " very bad "),
    (" by ", " http://t.co/x "),
    (" as ", " @me "),
    (" with ", " :) "),
    (" or ", " :-( "),
    (" are ", " hahaha "),
    (" be ", " 5 million dollars "),
    (" at ", " 3 of May , 2015 "),
    (" for ", " Anna Smith of London "),
    (" an ", " I'd "),
    (" it ", " John's "),
    (" you ", " niiice "),
    (" that ", ' "Big Apple" '),
    (" and ", " not "),
    (" on ", " 1,000 kg "),
    (" is ", " she's not love "),
    (" to ", " U.S.A. ... "),
    (" he ", " May of 2015 "),
    (" thre ", " gooood "),
    (" in ", " we've won't they're "),
    (" nd ", " wanna gonna musta "),
    (" wh ", " quiiick D: ]] #tag "),
    (" sh ", " << so >> `` be '' "),
    (" re ", " she'll I'm 3.5 "),
    (" ed ", " THE DOG "),
    (" ti ", " 3 kg May the 3 , 2015 "),
    (" th ", " 7 kg june 7 2016 and May 3 2015 "),
    (" st ", " e.g. Dr. Smith A.B. "),
    (" er ", " not very good "),
    (" ea ", " hate that dog "),
)


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(words) -> str:
    return ", ".join(lit(w) for w in words)


def _re2(replacement: str) -> str:
    return replacement.replace("$1", "\\1").replace("$2", "\\2").replace("$3", "\\3")


def _sub(expr: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(_re2(replacement))}, 'g')"


def _subs(expr: str, rules) -> str:
    for pattern, replacement in rules:
        expr = _sub(expr, pattern, replacement)
    return expr


def _noisy(column: str) -> str:
    for old, new in NOISE:
        column = f"replace({column}, {lit(old)}, {lit(new)})"
    return column


def _resource(name: str) -> list[str]:
    return Path(BUNDLED, f"{name}.txt").read_text().splitlines()


def _values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(lit(v) if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) v({columns})"


def _dictionary() -> list[tuple]:
    rows = []
    for line in _resource("dictionary"):
        form, *rest = line.split()
        rows += [(form, k // 2, rest[k], rest[k + 1]) for k in range(0, len(rest) - 1, 2)]
    return rows


def _model(name: str):
    lines = _resource(name)
    prior = [tuple(x[5:-6].split()) for x in lines if x.startswith("<cat>")]
    lists = [x[6:-7].split() for x in lines if x.startswith("<list>")]
    cond = [tuple(x.split()) for x in lines if not x.startswith("<")]
    return (
        [(c, float(p)) for c, p in prior],
        [(n, w) for n, ws in lists for w in ws.split("|")],
        [(f, c, float(p), int(n)) for f, c, p, n in cond],
        int(lines[0].split(">")[1].split("<")[0]),
    )


POS_PRIOR, _, POS_COND, POS_N = _model("pos_model")
NB_PRIOR, NB_LISTS, NB_COND, NB_N = _model("polarity_model")
LEXICON = [tuple(line.split("\t")) for line in _resource("polarity")]

POSTS = f"""
posts AS (SELECT CAST(doc_id AS VARCHAR) AS rowkey, {_noisy("text")} AS content, lang AS language FROM documents),
en AS (SELECT rowkey, content FROM posts WHERE language = 'en' AND rowkey IS NOT NULL AND content IS NOT NULL)
"""


def _cut_sentences() -> str:
    cut = _subs("content", sentences.SUBSTITUTIONS)
    cut = f"regexp_replace({cut} || chr(10), '\\n\\s+', chr(10), 'g')"
    return f"replace(replace({cut}, {lit(sentences.ABBREVIATION_DOT)}, '.'), {lit(sentences.DOT)}, '.')"


SENTENCES = f"""
cut AS (SELECT rowkey, rtrim({_cut_sentences()}, chr(10)) AS cut FROM en),
sent AS (
  SELECT rowkey, si - 1 AS si, s[si] AS sentence
  FROM (SELECT rowkey, string_split_regex(cut, '\\n+') AS s FROM cut WHERE cut <> '') x,
       LATERAL (SELECT unnest(generate_series(1, len(s))) AS si) y
)
"""


def _collapse_levels(source: str) -> str:
    level = source
    out = []
    for n, (letter, run) in enumerate(normalize.TRIGGERS):
        pattern = f"^.*?([^{letter}]*){letter}{letter}+(.*)$"
        out.append(
            f"w{n} AS (SELECT * REPLACE (CASE WHEN contains(w, {lit(run)}) "
            f"THEN regexp_replace(w, {lit(pattern)}, '\\1{letter}\\2') ELSE w END AS w) FROM {level})"
        )
        level = f"w{n}"
    return ",\n".join(out)


def _word_case(w: str) -> str:
    rules = " ".join(f"WHEN regexp_matches({w}, {lit(p)}) THEN {lit(r)}" for p, r in normalize.WORD_RULES)
    return f"CASE {rules} ELSE regexp_replace({w}, '^\\s*(.*\\S)\\s*$', '\\1') END"


NORMALIZED = f"""
word AS (
  SELECT rowkey, si, wi, CASE WHEN regexp_matches(w, {lit(normalize.TAIL)}) THEN right(w, 1) ELSE '' END AS tail,
         CASE WHEN regexp_matches(w, {lit(normalize.TAIL)}) THEN left(w, length(w) - 1) ELSE w END AS w
  FROM (SELECT rowkey, si, unnest(string_split(sentence, ' ')) AS w,
               unnest(generate_series(1, len(string_split(sentence, ' ')))) AS wi FROM sent) x
),
{_collapse_levels("word")},
kept AS (SELECT rowkey, si, wi, tail, {_word_case("w")} AS w FROM w9),
norm AS MATERIALIZED (
  SELECT s.rowkey, s.si, coalesce(n.normalized, '') AS normalized
  FROM sent s LEFT JOIN (
    SELECT rowkey, si, string_agg(w || CASE WHEN tail = '' THEN '' ELSE ' ' || tail END || ' ', '' ORDER BY wi) AS normalized
    FROM kept WHERE w <> '' GROUP BY rowkey, si) n USING (rowkey, si)
)
"""


def _restored(t: str) -> str:
    for mark, text in tokens.STAND_INS:
        t = f"regexp_replace({t}, {lit(mark)}, {lit(text)})"
    return t


def _clitics(t: str) -> str:
    c = tokens.CLITIC
    cases = [
        (f"regexp_matches({t}, '{c}t$') AND regexp_matches({t}, '^([Cc]a|[Ww]o)n{c}')",
         f"regexp_replace(regexp_replace({t}, '^(.)an{c}t', '\\1an' || chr(10) || 'not'), '^(.)on{c}t', '\\1ill' || chr(10) || 'not')"),
        (f"regexp_matches({t}, '{c}t$') AND contains({t}, 'n{c}')", f"regexp_replace({t}, 'n{c}t', chr(10) || 'not')"),
        (f"regexp_matches({t}, '{c}t$')", f"regexp_replace({t}, '([a-z]){c}([a-z])', '\\1' || chr(10) || 'not', 'g')"),
    ]
    for end, word in (("ve", "have"), ("re", "are"), ("ll", "will"), ("m", "am")):
        cases.append((f"regexp_matches({t}, '{c}{end}$')", f"replace({t}, '{c}{end}', chr(10) || '{word}')"))
    for words, rest in tokens.CONTRACTIONS:
        head = "'1'" if words[0] == "wanna" else f"left({t}, 1)"
        cases.append((f"{t} IN ({lits(words)})", f"{head} || {lit(rest)}"))
    cases.append((f"{t} IN ({lits(tokens.HAVE_CONTRACTIONS)})", f"regexp_replace({t}, 'a$', chr(10) || 'have')"))
    body = " ".join(f"WHEN {a} THEN {b}" for a, b in cases)
    return f"CASE {body} ELSE regexp_replace({t}, '([a-z]){c}([a-z])', '\\1' || chr(10) || '''2', 'g') END"


TOKENS = f"""
marked AS (SELECT rowkey, si, rtrim({_subs("trim(normalized)", tokens.SUBSTITUTIONS)}) AS marked FROM norm),
raw AS (
  SELECT rowkey, si, ti, {_clitics("t")} AS t
  FROM (SELECT rowkey, si, ti, {_restored("t")} AS t
        FROM (SELECT rowkey, si, unnest(string_split_regex(marked, '\\s+')) AS t,
                     unnest(generate_series(1, len(string_split_regex(marked, '\\s+')))) AS ti FROM marked) a) b
),
part AS (
  SELECT rowkey, si, ti, unnest(string_split(t, chr(10))) AS token,
         unnest(generate_series(1, len(string_split(t, chr(10))))) AS pi FROM raw
),
first_part AS (SELECT rowkey, arg_min(token, (si, ti, pi)) AS token FROM part GROUP BY rowkey),
tok AS MATERIALIZED (
  SELECT rowkey, row_number() OVER (PARTITION BY rowkey ORDER BY si, ti, pi) - 1 AS pos, token
  FROM (SELECT rowkey, si, ti, pi, token FROM part WHERE token <> ''
        UNION ALL
        SELECT rowkey, -1, 0, 0, '' FROM first_part f WHERE f.token = ''
          AND EXISTS (SELECT 1 FROM part p WHERE p.rowkey = f.rowkey AND p.token <> '')) x
)
"""

_DICT = _dictionary()
_STOP = {f for f, _, _, t in _DICT if t.startswith(("P", "SP", "R", "D", "I", "C"))}
_NOAMB = {f for f, k, _, t in _DICT if k == 0 and t.startswith("NP")}


def _chain(rules, value: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {value.format(*r)}" for c, *r in rules) + " ELSE NULL END"


_QUANT, _MEAS, _CURR = lits(ner.QUANTITY), lits([m + s for m in ner.MEASURE for s in ("", "s", ".")]), lits(ner.CURRENCY)
_MONTHS = lits(ner.MONTHS)
_NUMBER_RULES = (
    (f"l1 IN ({_MEAS})", 1, "'Zu'"),
    (f"l1 IN ({_QUANT}) AND l2 IN ({_MEAS})", 2, "'Zu'"),
    (f"l1 IN ({_CURR}, '$')", 1, "'Zm'"),
    (f"l1 IN ({_QUANT}) AND l2 = 'de' AND l3 IN ({_CURR})", 3, "'Zm'"),
    (f"l1 IN ({_QUANT}) AND l2 IN ({_CURR})", 2, "'Zm'"),
    (f"l1 = 'de' AND l2 IN ({_CURR})", 2, "'Zm'"),
    (f"l1 IN ({_QUANT})", 1, "'Z'"),
    (f"l1 = 'of' AND l2 IN ({_MONTHS}) AND l3 = ',' AND regexp_matches(l4, '[0-9][0-9][0-9][0-9]')", 4, "'W'"),
    (f"l1 = 'of' AND l2 IN ({_MONTHS}) AND regexp_matches(l3, '[0-9][0-9][0-9][0-9]')", 3, "'W'"),
    (f"l1 IN ({_MONTHS}) AND regexp_matches(l2, '^[0-9]{{4,}}$')", 2, "'W'"),
    (f"l1 = 'of' AND l2 IN ({_MONTHS})", 2, "'W'"),
    (f"l1 IN ({_MONTHS})", 1, "'W'"),
)

_year = lambda c: f"coalesce(regexp_matches({c}, '^[0-9]{{4,}}$'), false)"
_PREP_END, _PREP_ART_END = ner._PREP_END, ner._PREP_ART_END
_BOUND = lits([*ner.BOUNDARY, ""])
_caps = lambda k: f"regexp_matches(t{k}, '^{ner.UPPER}')"
_closes = lambda k: f"regexp_matches(t{k}, {lit(ner.QUOTE_CLOSE)})"
_QUOTED = (
    f"CASE WHEN NOT capsrun AND up AND left(p, 1) IN ({lits(ner.QUOTE_OPEN)}) THEN CASE "
    f"WHEN {_caps(1)} AND {_closes(2)} THEN 2 "
    f"WHEN {_caps(1)} AND {_caps(2)} AND {_closes(3)} THEN 3 "
    f"WHEN {_caps(1)} AND {_caps(2)} AND {_caps(3)} AND {_closes(4)} THEN 4 "
    f"WHEN {_caps(1)} AND {_caps(2)} AND {_caps(3)} AND {_caps(4)} AND {_closes(5)} THEN 5 "
    f"WHEN {_caps(1)} AND {_caps(2)} AND {_caps(3)} AND {_caps(4)} AND t5 NOT IN ('', '0') AND {_closes(6)} THEN 6 "
    f"ELSE 0 END ELSE 0 END"
)

RECOGNISED = f"""
dict AS ({_values(_DICT, "form, k, lemma, tag")}),
listed AS (SELECT form, string_agg(lemma || '/' || tag, ' ' ORDER BY k) AS an FROM dict GROUP BY form),
ambiguous AS ({_values([(w,) for w in _resource("ambiguous")], "word")}),
marks AS ({_values([*ner.PUNCT_TAGS.items(), *[(m, "") for m in ner.UNTAGGED]], "mark, marktag")}),
f0 AS (
  SELECT t.*, lower(token) AS lo, d.an, d.an IS NOT NULL AS known, a.word IS NOT NULL AS amb, m.marktag,
         lower(token) IN ({lits(sorted(_STOP))}) AS stop, token IN ({lits(sorted(_NOAMB))}) AS noamb,
         regexp_matches(token, '^{ner.UPPER}') AS up, regexp_matches(token, '^{ner.UPPER}{ner.LOWER}') AS cap,
         regexp_matches(token, '^{ner.UPPER}+$') AS caps,
         lower(token) IN ({lits(ner.PREPOSITIONS)}) AS prep, lower(token) IN ({lits(ner.ARTICLES)}) AS art,
         regexp_matches(token, '[0-9]') OR token IN ({lits(ner.NUMBER_WORDS)}) AS num,
         lower(token) IN ({_MONTHS}) AS month
  FROM tok t LEFT JOIN listed d ON d.form = lower(t.token) LEFT JOIN ambiguous a ON a.word = lower(t.token)
       LEFT JOIN marks m ON m.mark = t.token
),
f1 AS (
  SELECT *, lag(token) OVER w AS p, coalesce(lag(prep) OVER w, false) AS pprep, count(*) OVER (PARTITION BY rowkey) AS n,
         {", ".join(f"lead(token, {k}) OVER w AS t{k}" for k in range(1, ner.MAX_NAME + 1))},
         {", ".join(f"lead(lo, {k}) OVER w AS l{k}" for k in range(1, 5))},
         coalesce(lead(num, 1) OVER w, false) AS num1, coalesce(lead(num, 2) OVER w, false) AS num2,
         coalesce(lead(caps) OVER w, false) AS ncaps, coalesce(lead(known) OVER w, false) AS nknown,
         coalesce(lag(caps) OVER w, false) AS pcaps, coalesce(lag(known) OVER w, false) AS pknown
  FROM f0 WINDOW w AS (PARTITION BY rowkey ORDER BY pos)
),
f2 AS (
  SELECT *, NOT ((NOT art OR pprep) AND (cap OR prep OR art)) AS brk,
         coalesce(p IN ({_BOUND}), false) AS bound,
         coalesce(caps AND known AND ((ncaps AND nknown) OR (pcaps AND pknown AND t1 IN ({lits(ner.CAPS_END)}))), false) AS capsrun
  FROM f1
),
f3 AS MATERIALIZED (
  SELECT *, coalesce({_QUOTED}, 0) AS q,
         coalesce(min(CASE WHEN brk THEN pos END) OVER (PARTITION BY rowkey ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), n) - pos AS run
  FROM f2
),
f4 AS MATERIALIZED (
  SELECT f3.*, CASE WHEN token = 'I' THEN 'UNK' WHEN capsrun THEN 'UNK' WHEN up AND noamb THEN 'NNP'
                 WHEN up AND NOT stop AND p IS NOT NULL AND NOT bound AND p <> '...' THEN 'NNP'
                 WHEN ((up AND NOT stop AND bound) OR pos = 0) AND (NOT known OR amb) THEN 'NNP' ELSE 'UNK' END AS tag0,
         CASE WHEN q = 0 AND cap AND NOT (bound AND known AND NOT amb) AND run BETWEEN 2 AND {ner.MAX_NAME} THEN run ELSE 0 END AS cnt,
         CASE WHEN q > 0 OR cap OR num OR month THEN [token, {", ".join(f"t{k}" for k in range(1, ner.MAX_NAME + 1))}] END AS toks
  FROM f3
),
f5 AS (
  SELECT *, CASE WHEN q > 0 THEN array_to_string(toks[1:q], '_')
                 WHEN cnt > 0 THEN array_to_string(toks[1:cnt], '_') ELSE token END AS cand FROM f4
),
f6 AS (
  SELECT *, CASE WHEN q > 0 THEN pos + q - 1
                 WHEN cnt > 0 AND regexp_matches(cand, {lit(_PREP_END)}) THEN pos + cnt - 2
                 WHEN cnt > 0 AND regexp_matches(cand, {lit(_PREP_ART_END)}) THEN pos + cnt - 3
                 WHEN cnt > 0 THEN pos + cnt - 1 ELSE pos END AS name_end,
         CASE WHEN cnt > 0 AND regexp_matches(cand, {lit(_PREP_END)}) THEN regexp_replace(cand, {lit(_PREP_END)}, '')
              WHEN cnt > 0 THEN regexp_replace(cand, {lit(_PREP_ART_END)}, '') ELSE cand END AS text
  FROM f5
),
f7 AS MATERIALIZED (
  SELECT *, name_end = pos AND month AND l1 = 'the' AND num2 AND t3 = ',' AND {_year("l4")} AS late4,
         name_end = pos AND month AND l1 = 'the' AND num2 AND {_year("l3")} AS late3,
         name_end = pos AND month AND num1 AND {_year("l2")} AS late2,
         CASE WHEN name_end > pos THEN regexp_matches(text, '[0-9]') ELSE num END AS counts,
         CASE WHEN name_end > pos THEN 0 WHEN num THEN coalesce({_chain(_NUMBER_RULES, "{0}")}, 0)
                 WHEN month AND l1 = 'of' AND regexp_matches(l2, '^[0-9]{{4,}}$') THEN 2 ELSE 0 END AS nlen,
         CASE WHEN num THEN {_chain(_NUMBER_RULES, "{1}")} ELSE 'W' END AS ntag
  FROM f6
),
claim AS (
  SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY pos) AS r FROM (
    SELECT rowkey, pos, name_end, name_end + nlen AS last, text, counts,
           CASE WHEN late4 THEN 4 WHEN late3 THEN 3 WHEN late2 THEN 2 END AS reach,
           CASE WHEN late4 OR late3 THEN t2 WHEN late2 THEN t1 END AS day
    FROM f7) x WHERE last > pos OR counts OR reach IS NOT NULL),
-- The claim that comes next depends on where this one ends: as it is, or as a late date.
jump AS MATERIALIZED (
  SELECT c.*, n.r AS nxt, m.r AS nxt_late
  FROM claim c ASOF LEFT JOIN claim n ON n.rowkey = c.rowkey AND n.pos > c.last
       ASOF LEFT JOIN claim m ON m.rowkey = c.rowkey AND m.pos > c.pos + coalesce(c.reach, 0)),
-- days: the texts of numbers that reached over more than themselves when last read.
walk AS (
  SELECT rowkey, pos, last, false AS late, nxt, CASE WHEN counts AND last > name_end THEN [text] ELSE [] END AS days FROM jump WHERE r = 1
  UNION ALL
  SELECT j.rowkey, j.pos, CASE WHEN l THEN j.pos + j.reach ELSE j.last END, l, CASE WHEN l THEN j.nxt_late ELSE j.nxt END,
         list_filter(w.days, lambda d: d <> j.text) || CASE WHEN j.counts AND j.last > j.name_end THEN [j.text] ELSE [] END
  FROM walk w JOIN jump j ON j.rowkey = w.rowkey AND j.r = w.nxt,
       LATERAL (SELECT coalesce(list_contains(w.days, j.day), false) AS l) x
),
hidden AS (SELECT rowkey, unnest(generate_series(pos + 1, last)) AS pos FROM walk WHERE last > pos),
entry0 AS (
  SELECT f.rowkey, f.pos, f.name_end, f.nlen, f.n,
         CASE WHEN w.late THEN array_to_string(toks[1:w.last - f.pos + 1], '_')
              WHEN nlen > 0 THEN array_to_string(toks[1:1 + nlen], '_') ELSE text END AS token,
         CASE WHEN w.late THEN lower(array_to_string(toks[1:w.last - f.pos + 1], '_')) || '/W'
              WHEN nlen > 0 THEN lower(array_to_string(toks[1:1 + nlen], '_')) || '/' || ntag
              WHEN name_end = f.pos AND marktag IS NOT NULL THEN f.token || '/' || marktag
              WHEN name_end = f.pos AND num THEN f.token || '/Z'
              WHEN regexp_matches(text, '\\S_\\S') THEN lower(text) || '/NNP'
              WHEN tag0 = 'UNK' AND known THEN an
              ELSE lower(text) || '/' || tag0 END AS an
  FROM f7 f LEFT JOIN walk w ON w.rowkey = f.rowkey AND w.pos = f.pos AND w.late
       ANTI JOIN hidden h ON f.rowkey = h.rowkey AND f.pos = h.pos WHERE f.token <> ''
),
closing AS (
  SELECT rowkey, n AS pos, '<blank>' AS token, '<blank>/Fp' AS an FROM (
    SELECT rowkey, any_value(n) AS n, arg_max(name_end, pos) AS name_end, arg_max(token, pos) AS token FROM entry0 GROUP BY rowkey)
  WHERE name_end = n - 1 AND token <> '.'
),
entry AS MATERIALIZED (SELECT rowkey, pos, token, an FROM entry0 UNION ALL SELECT rowkey, pos, token, an FROM closing)
"""

_coarse = lambda tag: (
    f"CASE WHEN regexp_matches({tag}, '^(V|NNP|PRP)') THEN regexp_extract({tag}, '([A-Z][A-Z][A-Z]?[A-Za-z$]?)', 1) "
    f"ELSE regexp_extract({tag}, '([A-Z][A-Za-z$0-9]?)', 1) END"
)
_VETO = " OR ".join(
    f"(starts_with(c.c, {lit(cat)}) AND f.feat IN ({lits(feats)}))" for cat, feats in tagger.VETOES
)

TAGGED = f"""
pprior AS ({_values(POS_PRIOR, "c, p")}),
pcond AS ({_values(POS_COND, "feat, c, p, freq")}),
line0 AS (
  SELECT rowkey, row_number() OVER (PARTITION BY rowkey ORDER BY pos) AS ln, token, an,
         regexp_matches(an, '/(Fp|<blank>)$') AND NOT contains(an, ' ') AS border, NOT contains(an, ' ') AS single
  FROM entry WHERE NOT regexp_matches(an, '/$')
),
ana AS (
  SELECT rowkey, ln, token, k, regexp_replace(a, '^(.*)/[^/]*$', '\\1') AS lemma, regexp_extract(a, '/([^/]*)$', 1) AS tag
  FROM (SELECT rowkey, ln, token, unnest(string_split(an, ' ')) AS a, unnest(generate_series(1, len(string_split(an, ' ')))) AS k FROM line0) x
),
line AS (
  SELECT l.*, l.single AND a.tag = 'UNK' AND NOT regexp_matches(l.token, '\\w(ly|ing)$') AS unknown,
         l.single AND a.tag = 'UNK' AND regexp_matches(l.token, '\\wly$') AS adverb,
         l.single AND a.tag = 'UNK' AND regexp_matches(l.token, '\\wing$') AS gerund,
         l.single AND a.tag <> 'UNK' AS fixed, a.lemma AS lemma1, a.tag AS tag1,
         coalesce(lag(l.border) OVER w, true) AS starts,
         sum(CASE WHEN l.border THEN 1 ELSE 0 END) OVER w - CASE WHEN l.border THEN 1 ELSE 0 END AS sent
  FROM line0 l JOIN ana a ON a.rowkey = l.rowkey AND a.ln = l.ln AND a.k = 1
  WINDOW w AS (PARTITION BY l.rowkey ORDER BY l.ln)
),
closed AS MATERIALIZED (SELECT l.* FROM line l WHERE l.ln <= (SELECT max(ln) FROM line b WHERE b.rowkey = l.rowkey AND b.border)),
vis AS MATERIALIZED (
  SELECT rowkey, ln, c, arg_max(fine, k) AS fine, arg_max(lemma, k) AS lemma FROM (
    SELECT a.rowkey, a.ln, a.k, {_coarse("a.tag")} AS c, a.tag AS fine, a.lemma FROM ana a
    UNION ALL SELECT rowkey, ln, 9, 'RB', 'RB', lemma1 FROM line WHERE adverb
    UNION ALL SELECT rowkey, ln, 9, 'VB', 'VBG', '' FROM line WHERE gerund) x
  WHERE c <> '' GROUP BY rowkey, ln, c
),
cand AS MATERIALIZED (
  SELECT v.rowkey, v.ln, v.c, v.fine, v.lemma FROM vis v JOIN closed l USING (rowkey, ln) WHERE NOT l.unknown AND NOT l.fixed AND NOT l.border
  UNION ALL
  SELECT l.rowkey, l.ln, o.c, o.c, l.token FROM closed l, (VALUES {", ".join(f"({lit(c)})" for c in tagger.OPEN_CLASSES)}) o(c) WHERE l.unknown
),
open_line AS (SELECT rowkey, ln, token, starts, CASE WHEN starts THEN lower(token) ELSE token END AS word FROM closed WHERE NOT fixed AND NOT border),
lefts AS MATERIALIZED (
  SELECT rowkey, ln, word, 'BEGIN' AS lt FROM open_line WHERE starts
  UNION ALL SELECT o.rowkey, o.ln, o.word, '' FROM open_line o JOIN closed b ON b.rowkey = o.rowkey AND b.ln = o.ln - 1 WHERE NOT o.starts AND b.unknown
  UNION ALL SELECT o.rowkey, o.ln, o.word, v.c FROM open_line o JOIN closed b ON b.rowkey = o.rowkey AND b.ln = o.ln - 1
            JOIN vis v ON v.rowkey = b.rowkey AND v.ln = b.ln WHERE NOT o.starts AND NOT b.unknown
),
feats AS (
  SELECT rowkey, ln, lt, 'L_' || lt AS feat FROM lefts WHERE lt <> ''
  UNION ALL SELECT rowkey, ln, lt, 'L_' || lt || '_' || word FROM lefts WHERE lt NOT IN ('', 'BEGIN')
  UNION ALL SELECT f.rowkey, f.ln, f.lt, unnest(['R_' || v.c, 'R_' || v.c || '_' || f.word])
            FROM lefts f JOIN closed a ON a.rowkey = f.rowkey AND a.ln = f.ln + 1 AND NOT a.border
            JOIN vis v ON v.rowkey = a.rowkey AND v.ln = a.ln
),
seen AS MATERIALIZED (SELECT f.* FROM feats f SEMI JOIN pcond p ON p.feat = f.feat AND p.freq <> 0),
score AS MATERIALIZED (
  SELECT c.rowkey, c.ln, f.lt, c.c, any_value(c.fine) AS fine, any_value(c.lemma) AS lemma, any_value(coalesce(pr.p, 0)) AS prior,
         2 * any_value(CASE WHEN coalesce(pr.p, 0) > 0 THEN ln(pr.p) ELSE -1e9 END)
         + sum(CASE WHEN {_VETO} THEN -1e9 WHEN coalesce(p.p, 0) = 0 THEN ln(CAST(CAST(1.0 / {POS_N} AS FLOAT) AS DOUBLE)) ELSE ln(p.p) END) AS s
  FROM cand c JOIN seen f USING (rowkey, ln) LEFT JOIN pcond p ON p.feat = f.feat AND p.c = c.c LEFT JOIN pprior pr ON pr.c = c.c
  GROUP BY c.rowkey, c.ln, f.lt, c.c
),
ranked AS (
  SELECT c.rowkey, c.ln, l.lt, c.c, c.fine, c.lemma,
         row_number() OVER (PARTITION BY c.rowkey, c.ln, l.lt ORDER BY
           CASE WHEN coalesce(s.s, -1e9) > -1e8 THEN round(s.s, 9) ELSE -1e9 END DESC, coalesce(pr.p, 0) DESC, c.c) AS r
  FROM cand c JOIN (SELECT DISTINCT rowkey, ln, lt FROM lefts) l USING (rowkey, ln)
       LEFT JOIN score s ON s.rowkey = c.rowkey AND s.ln = c.ln AND s.lt = l.lt AND s.c = c.c LEFT JOIN pprior pr ON pr.c = c.c
),
best AS MATERIALIZED (SELECT * FROM ranked WHERE r = 1),
-- An open word's choice is already settled unless its left neighbour is open too.
chain AS (
  SELECT b.rowkey, b.ln, b.lt, b.c, b.fine, b.lemma FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM open_line o JOIN closed x ON x.rowkey = o.rowkey AND x.ln = o.ln
                    WHERE o.rowkey = b.rowkey AND o.ln = b.ln - 1 AND NOT x.unknown AND b.lt <> 'BEGIN')
  UNION ALL
  SELECT b.rowkey, b.ln, b.lt, b.c, b.fine, b.lemma FROM chain a JOIN open_line o ON o.rowkey = a.rowkey AND o.ln = a.ln + 1
    JOIN closed x ON x.rowkey = a.rowkey AND x.ln = a.ln
    JOIN best b ON b.rowkey = o.rowkey AND b.ln = o.ln AND b.lt = a.c WHERE NOT o.starts AND NOT x.unknown
),
tagged AS (
  SELECT rowkey, ln, token, lemma1 AS lemma, tag1 AS tag FROM closed WHERE fixed OR border
  UNION ALL
  SELECT c.rowkey, c.ln, o.token, c.lemma, c.fine FROM chain c JOIN open_line o USING (rowkey, ln)
)
"""

_names = lambda name: lits([w for n, w in NB_LISTS if n == name])
_SMOOTH = f"ln(CAST(CAST(1.0 / {NB_N} AS FLOAT) AS DOUBLE))"

SCORED = f"""
lex AS ({_values(LEXICON, "word, cat")}),
nb AS ({_values(NB_COND, "word, cat, p, freq")}),
pol AS (SELECT word, sign(sum(CASE cat WHEN 'POSITIVE' THEN 1 WHEN 'NEGATIVE' THEN -1 ELSE 0 END)) AS polarity FROM lex GROUP BY word HAVING polarity <> 0),
prob AS (
  SELECT w.word, k.cat, coalesce(CASE WHEN EXISTS (SELECT 1 FROM lex x WHERE x.word = w.word AND x.cat = k.cat) THEN ln(0.1) END,
         (SELECT ln(p) FROM nb n WHERE n.word = w.word AND n.cat = k.cat AND p <> 0), {_SMOOTH}) AS lp
  FROM (SELECT word FROM lex UNION SELECT word FROM nb) w, (VALUES ('POSITIVE'), ('NEGATIVE')) k(cat)
),
gated AS (SELECT * FROM tagged WHERE lemma <> '' AND tag <> '' AND (regexp_matches(token, '\\w$') OR regexp_matches(lemma, '\\w$'))),
emot AS (SELECT rowkey, sum(CASE token WHEN 'EMOT_POS' THEN 1 ELSE -1 END) AS balance FROM gated WHERE token IN ('EMOT_POS', 'EMOT_NEG') GROUP BY rowkey),
content AS (
  SELECT g.rowkey, g.ln, CASE WHEN regexp_matches(tag, '^[FI]') THEN '' ELSE lemma END AS lemma, tag
  FROM gated g WHERE regexp_matches(tag, '^[FI]')
     OR (regexp_matches(tag, '^(V|N|AQ|R|JJ)') AND lemma NOT IN ({_names("light_words")}))
),
prev AS (
  SELECT c.*, coalesce(p.polarity, 0) AS polarity, row_number() OVER w AS i, coalesce(lag(c.lemma) OVER w, '') AS before
  FROM content c LEFT JOIN pol p ON p.word = c.lemma WINDOW w AS (PARTITION BY rowkey ORDER BY ln)
),
eligible AS (
  SELECT *, CASE WHEN polarity = 0 THEN NULL
      WHEN regexp_matches(tag, '^(AQ|JJ)') AND before IN ({_names("quant_adj")}) THEN 'quant'
      WHEN regexp_matches(tag, '^(N|AQ|JJ)') AND before IN ({_names("neg_noun")}) THEN 'negation'
      WHEN regexp_matches(tag, '^V') AND before IN ({_names("neg_verb")}) THEN 'negation' END AS maybe
  FROM prev
),
-- In a run of words that could each join the one before, every other one does.
absorbed AS (
  SELECT *, CASE WHEN maybe IS NOT NULL AND (i - max(CASE WHEN maybe IS NULL THEN i ELSE 0 END) OVER (PARTITION BY rowkey ORDER BY i)) % 2 = 1
            THEN maybe END AS kind
  FROM eligible
),
weighed AS (
  SELECT a.rowkey, a.i, a.lemma, a.kind, a.polarity,
         CASE WHEN kind IS NULL THEN lemma ELSE before || '_' || lemma END AS word, k.cat,
         CASE WHEN kind = 'negation' THEN CASE WHEN (polarity > 0) = (k.cat = 'POSITIVE') THEN {_SMOOTH} ELSE ln(0.1) END
              WHEN kind = 'quant' THEN CASE WHEN (polarity > 0) = (k.cat = 'POSITIVE') THEN ln(0.1)
                   ELSE coalesce((SELECT lp FROM prob q WHERE q.word = before || '_' || lemma AND q.cat = k.cat), {_SMOOTH}) END
              WHEN polarity <> 0 OR EXISTS (SELECT 1 FROM nb n WHERE n.word = lemma AND n.freq <> 0)
                   THEN (SELECT lp FROM prob q WHERE q.word = lemma AND q.cat = k.cat) ELSE 0 END AS lp
  FROM absorbed a, (VALUES ('POSITIVE'), ('NEGATIVE')) k(cat) WHERE lemma <> ''
),
total AS (
  SELECT e.rowkey, coalesce(m.balance, 0) AS balance, coalesce(s.hits, 0) AS hits,
         2 * ln({dict(NB_PRIOR)["POSITIVE"]}) + coalesce(s.pos, 0) AS pos, 2 * ln({dict(NB_PRIOR)["NEGATIVE"]}) + coalesce(s.neg, 0) AS neg
  FROM en e LEFT JOIN emot m USING (rowkey) LEFT JOIN (
    SELECT rowkey, sum(CASE WHEN cat = 'POSITIVE' AND polarity <> 0 THEN 1 ELSE 0 END) AS hits,
           sum(CASE WHEN cat = 'POSITIVE' THEN lp ELSE 0 END) AS pos, sum(CASE WHEN cat = 'NEGATIVE' THEN lp ELSE 0 END) AS neg
    FROM weighed GROUP BY rowkey) s USING (rowkey)
),
sentiment AS (
  SELECT rowkey, CAST(CASE WHEN balance > 0 THEN 1 WHEN balance < 0 THEN -1 WHEN hits = 0 THEN 0
         WHEN abs(pos - neg) < 1e-9 THEN 0 WHEN pos > neg THEN 1 ELSE -1 END AS INTEGER) AS sentiment FROM total
)
"""

STAGES = {
    "posts": (POSTS,),
    "sentences": (POSTS, SENTENCES),
    "normalized": (POSTS, SENTENCES, NORMALIZED),
    "tokens": (POSTS, SENTENCES, NORMALIZED, TOKENS),
    "recognised": (POSTS, SENTENCES, NORMALIZED, TOKENS, RECOGNISED),
    "tagged": (POSTS, SENTENCES, NORMALIZED, TOKENS, RECOGNISED, TAGGED),
    "scored": (POSTS, SENTENCES, NORMALIZED, TOKENS, RECOGNISED, TAGGED, SCORED),
}


def after(stage: str, select: str, posts: str = POSTS, stages: dict = STAGES) -> str:
    return "WITH RECURSIVE " + ",\n".join(s.strip() for s in (posts, *stages[stage][1:])) + "\n" + select
