import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from tidemark.llm import queries, secrets


def base(text):
    """The contract's patterns, matched and then sifted."""
    word = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    out = []
    for m in re.finditer(f"""({word})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    for kind, i, pattern, least in (("access", 1, "AKIA[A-Z0-9]+", 16), ("hex", 2, "[0-9a-f]+", 32)):
        out += [(m.start(), i, kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def test_query_equals_brute_force(spark, sf):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op10_secrets(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    for r in got:
        want = base(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("guess")] == want
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex"))


def test_base_patterns_on_hard_texts():
    rng = random.Random(4)
    pieces = ["password", "Token", "API_KEY", "ſecret", "toKen", "api", "key", '"', "'", " ", "=", ":", "AKIA", "AKIA" + "Z9" * 6, "0123456789abcdef" * 2, "f", "abc", "é", "\n", "x" * 9]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=12))
        assert [f"{k}:{s}:{e}" for s, e, k in secrets.base_spans(text)] == base(text)


def slow_cost(text):
    """All cuts into cheap spans and single brute-force letters, tried in turn."""
    n, cheap = len(text), {}
    for i, j, _, c in secrets.spans(text):
        cheap[i, j] = min(c, cheap.get((i, j), math.inf))
    letter, best = math.log10(secrets._alphabet(text)), math.inf

    def walk(at, cost, brute):
        nonlocal best
        if at == n:
            best = min(best, cost)
            return
        join = math.log10(2) if at else 0.0
        walk(at + 1, cost + letter + (0 if brute else join), True)
        for (i, j), c in cheap.items():
            if i == at:
                walk(j, cost + c + join, False)

    walk(0, 0.0, False)
    return best


def test_cost_equals_all_segmentations():
    rng = random.Random(9)
    pieces = ["pass", "word", "123", "qwe", "1999", "aaa", "x", "K", "7", "!", "dragon", "P@ss"]
    for _ in range(60):
        text = "".join(rng.choices(pieces, k=4))[:11]
        assert abs(secrets.guess_cost(text) - slow_cost(text)) < 1e-9


def test_costs_are_ordered():
    cost = secrets.guess_cost
    for weak in ("password123", "qwertyuiop", "aaaaaaaaaaaa", "2019-05-21", "abcdefgh", "P@ssw0rd1999"):
        assert cost(weak) < secrets.LEAST_COST, weak
    for strong in ("xK9#mQ2$vL7p", "tR5vB8nW3kZ6", "g7Hq-29xZ!pLm4"):
        assert cost(strong) >= secrets.LEAST_COST, strong
    assert cost("") == 0.0


def test_added_spans():
    text = "pwd: xK9#mQ2$vL7p and pwd: password1! and key = prose words; passphrase='tR5!vB8nW3kZ6'"
    got = [text[s:e] for s, e, k in secrets.added_spans(text, secrets.base_spans(text))]
    assert got == ["xK9#mQ2$vL7p", "tR5!vB8nW3kZ6"]


def test_edge_cases(docs):
    long = "z " * 200_000 + "password=abcdefgh12 " + "é" * 5
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "AKIA" + "A" * 12), (4, "pin: " + "xY3$" * 9000)]
    got = {r.doc_id: r.spans for r in secrets.find_secrets(docs(*rows).withColumn("spans", F.lit(1))).collect()}
    assert got[1] == got[2] == [] and [tuple(s) for s in got[3]] == [("assign", 400_000, 400_019)]
    assert [tuple(s) for s in got[None]] == [("access", 0, 16)] and [s.kind for s in got[4]] == ["guess"]
    assert secrets.find_secrets(docs().limit(0)).count() == 0


def test_values_of_letters_and_context_inside_dropped_values():
    def found(text):
        return [text[s:e] for s, e, _ in secrets.added_spans(text, secrets.base_spans(text))]

    assert found("pwd: QxZkVbNmLpTr") == ["QxZkVbNmLpTr"]
    assert found("login: password is xK9#mQ2$vL7p") == ["xK9#mQ2$vL7p"]
    assert found("key: token=abcdefgh12;pwd:tR5!vB8nW3kZ6") == ["tR5!vB8nW3kZ6"]
    assert found("the key: international pressure; auth: government, login: Something") == []


def test_words_of_any_language_and_addresses_are_no_secrets():
    def found(text):
        return [text[s:e] for s, e, _ in secrets.added_spans(text, secrets.base_spans(text))]

    for prose in (
        "login: Verantwortlichkeiten", "key: internationalization", "key: donneespersonnelles", "auth: см.документацию",
        "Key: https://example.com/path/to/page", "key: responsabilidades", "key: " + "-" * 400, "token: requestHandlerConfiguration",
    ):
        assert found(prose) == [], prose
    for secret in ("pwd: QxZkVbNmLpTr", "key: https://example.com/t?k=xK9mQ2vL7pR4tW8z", "auth: tR5vB8nW3kZ6"):
        assert len(found(secret)) == 1, secret


def test_cost_grows_with_one_repeat():
    for unit in ("-", "ab", "xyz", "k9#q"):
        costs = [secrets.guess_cost(unit * k) for k in (4, 8, 32, 64, 128, 129, 200, 400, 2000)]
        assert costs == sorted(costs) and costs[-1] - costs[0] < 3


def test_long_values_against_the_slow_program():
    """Cuts of values up to 600 characters by the recurrence written out."""
    rng = random.Random(31)
    pieces = ["password", "1999-12-31", "aaaa", "qwertyuiop", "abcdef", "X", "9#", "Zuständigkeit", "--------", "K7m", "www"]
    for n in (100, 300, 600):
        text = "".join(rng.choices(pieces, k=n))[:n]
        cheap, join, letter = list(secrets.spans(text)), math.log10(2), math.log10(secrets._alphabet(text))
        free, cut = {0: math.inf}, {0: 0.0}
        for j in range(1, n + 1):
            free[j] = letter + min(free[j - 1], cut[j - 1] + (join if j > 1 else 0))
            cut[j] = min((c + min(free[i], cut[i]) + (join if i else 0) for i, e, _, c in cheap if e == j), default=math.inf)
        assert abs(secrets.guess_cost(text) - min(free[n], cut[n])) < 1e-9
        assert len(cheap) < 40 * n


def test_costs_of_base_values(docs):
    rows = [(1, "password=password1 and token: xK9mQ2vL7pR4tW8z and AKIA" + "Q" * 12), (2, "secret = aaaaaaaaaaaa"), (3, None)]
    got = {r.doc_id: (r.spans, r.costs) for r in secrets.find_secrets(docs(*rows)).collect()}
    spans, costs = got[1]
    assert [s.kind for s in spans] == ["assign", "assign", "access"] and costs[2] is None
    assert costs[0] < 4 < secrets.LEAST_COST < costs[1]
    assert got[2][1][0] < 4 and got[3] == ([], [])
