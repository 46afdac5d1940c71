"""What differs in fixed mode, as changes to the SQL of the other mode."""

from __future__ import annotations

from checks import oracle as o
from checks.oracle import lit, lits
from tidemark.operators import normalize, sentences


def _but(sql: str, *changes: tuple[str, str]) -> str:
    """``sql`` with each change made; a change that finds nothing is an error."""
    for old, new in changes:
        if old not in sql:
            raise ValueError(f"not found: {old}")
        sql = sql.replace(old, new)
    return sql


def _part(sql: str, start: str, end: str) -> str:
    at = sql.index(start)
    return sql[at : sql.index(end, at)]


def _runs() -> str:
    w = "w"
    for letter, run in normalize.FIXED_RUNS:
        w = f"regexp_replace({w}, '{run}+', '{letter}', 'g')"
    return f"w9 AS (SELECT * REPLACE ({w} AS w) FROM word)"


_ABBREVIATIONS = lits([line.split()[0] for line in o._resource("abbreviations") if "." in line])
_PROTECTED = (
    f"array_to_string(list_transform(string_split(content, ' '), lambda w: CASE WHEN w IN ({_ABBREVIATIONS}) "
    f"THEN regexp_replace(w, '\\.$', {lit(sentences.ABBREVIATION_DOT)}) ELSE w END), ' ')"
)
SENTENCES = _but(o.SENTENCES, ("FROM en),", f"FROM (SELECT rowkey, {_PROTECTED} AS content FROM en) protected),"))

_TRIMMED = "regexp_replace(w, '^\\s*(.*\\S)\\s*$', '\\1')"
NORMALIZED = _but(
    o.NORMALIZED,
    (o._collapse_levels("word"), _runs()),
    ("THEN ' '", "THEN ''"),
    (_TRIMMED, f"regexp_replace({_TRIMMED}, '^([A-Z])\\.([A-Z])$', '\\1\\2')"),
    ("ELSE ' ' || tail END || ' ', '' ORDER BY wi)", "ELSE ' ' || tail END, ' ' ORDER BY wi)"),
)

# Each sentence is read on its own from here on: it takes the post's place.
TOKENS = _but(
    o.TOKENS,
    (
        "'([a-z])APOTEMP([a-z])', '\\1' || chr(10) || '''2'",
        "'([A-Za-z])APOTEMP([a-z])', '\\1' || chr(10) || '''\\2'",
    ),
    ("THEN '1' ||", "THEN left(t, 1) ||"),
    (
        "SELECT rowkey, row_number() OVER (PARTITION BY rowkey ORDER BY si, ti, pi) - 1 AS pos, token",
        "SELECT rowkey || '#' || si AS rowkey, row_number() OVER (PARTITION BY rowkey, si ORDER BY ti, pi) - 1 AS pos, token",
    ),
    (_part(o.TOKENS, "        UNION ALL", ") x\n"), ""),
)

RECOGNISED = _but(
    o.RECOGNISED,
    ("CASE WHEN late4 THEN 4 WHEN late3 THEN 3 WHEN late2 THEN 2 END AS reach", "CAST(NULL AS BIGINT) AS reach"),
    ("CASE WHEN late4 OR late3 THEN t2 WHEN late2 THEN t1 END AS day", "CAST(NULL AS VARCHAR) AS day"),
    ("AS late4", "AS first4"),
    ("AS late3", "AS first3"),
    ("AS late2", "AS first2"),
    ("THEN 2 ELSE 0 END AS nlen", "THEN 2 WHEN first4 THEN 4 WHEN first3 THEN 3 WHEN first2 THEN 2 ELSE 0 END AS nlen"),
    (
        _part(o.RECOGNISED, "  SELECT rowkey, n AS pos, '<blank>'", "),\nentry AS"),
        "  SELECT rowkey, max(pos) + 1 AS pos, '<blank>' AS token, '<blank>/Fp' AS an FROM tok GROUP BY rowkey HAVING arg_max(token, pos) <> '.'\n",
    ),
    (
        o.RECOGNISED[o.RECOGNISED.index("entry AS MATERIALIZED (") :],
        "entry AS MATERIALIZED (\n"
        "  SELECT split_part(rowkey, '#', 1) AS rowkey, token, an, row_number() OVER (PARTITION BY split_part(rowkey, '#', 1) "
        "ORDER BY CAST(split_part(rowkey, '#', 2) AS INTEGER), pos) AS pos\n"
        "  FROM (SELECT rowkey, pos, token, an FROM entry0 UNION ALL SELECT rowkey, pos, token, an FROM closing) x)\n",
    ),
)

TAGGED = _but(
    o.TAGGED,
    ("9, 'VB', 'VBG', ''", "9, 'VB', 'VBG', lower(token)"),
    ("2 * any_value", "any_value"),
    (
        "(SELECT f.* FROM feats f",
        "(SELECT f.* FROM (SELECT * FROM feats UNION ALL SELECT f.rowkey, f.ln, f.lt, 'R_END' FROM lefts f "
        "JOIN closed a ON a.rowkey = f.rowkey AND a.ln = f.ln + 1 AND a.border) f",
    ),
)

SCORED = _but(
    o.SCORED,
    (" AND (regexp_matches(token, '\\w$') OR regexp_matches(lemma, '\\w$'))", ""),
    ("absorbed AS (\n", "joined AS (\n"),
    # A quantified word after a negation counts as negated.
    (
        "weighed AS (\n",
        f"absorbed AS (SELECT * REPLACE (CASE WHEN kind = 'quant' AND lag(lemma, 2) OVER w IN ({o._names('neg_noun')}) "
        "AND lag(kind, 2) OVER w IS NULL THEN 'negation' ELSE kind END AS kind) FROM joined WINDOW w AS (PARTITION BY rowkey ORDER BY i)),\n"
        "weighed AS (\n",
    ),
    ("2 * ln(", "ln("),
)

STAGES = {
    "tagged": (o.POSTS, SENTENCES, NORMALIZED, TOKENS, RECOGNISED, TAGGED),
    "scored": (o.POSTS, SENTENCES, NORMALIZED, TOKENS, RECOGNISED, TAGGED, SCORED),
}
