"""Secret scans: base patterns, and guess cost of values in credential context.

The cost of a value is the least number of guesses, as a power of ten, over all
ways to cut it into words, dates, repeats, keyboard walks, sequences and
brute-force spans; dynamic programming over end positions finds it, in one pass
over the whole value. A value after a credential word that would take too many
guesses is a secret.
"""

from __future__ import annotations

import base64
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import column_of, parts, plain

#: Guesses, as a power of ten, from which a value counts as a secret.
LEAST_COST = 10.0
#: Letters in a row that read like a word of some language cost this, and this more for each letter.
WORDLIKE, WORDLIKE_LETTER = 4.0, 0.04
#: What it takes to read like one: letters, how often each pair of them is seen, the share of triples that are.
_LEAST_LETTERS, _LEAST_PAIR, _LEAST_TRIPLES = 5, 5, 0.85
_REMEMBERED_LENGTH = 128
KINDS = ("assign", "access", "hex", "guess")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Words that announce a credential, beyond those of the base pattern, and what may join them to it.
_CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|bearer|credentials?|auth|login|private[_-]?key|access[_-]?key|api[_-]?key|key)(?![A-Za-z])["']?\x20*(?::=|=>|[:=]|\x20is\x20)\x20*(["']?)([^\s"'<>,;]{6,})""",
    re.I | re.A,
)

# Keyboard rows and common words (fixed values).
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_WORDS = (
    "password pass word admin login welcome secret letmein master dragon monkey shadow sunshine princess football baseball "
    "hello love test user root guest default change example sample dummy demo your here none null true false value string "
    "enter insert replace placeholder redacted removed hidden unknown summer winter spring autumn january february march april "
    "may june july august september october november december monday tuesday wednesday thursday friday saturday sunday "
    "token api key access auth bearer basic private public server client database mysql postgres oracle redis cloud local host "
    "http https www com org net file path config env variable the and for with this that from are was have not you all"
).split()


def _common_words() -> list[str]:
    """The whole words, of four letters or more, among the public ranks: the most frequent first."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        tokens = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    return [t[1:].decode().lower() for t in tokens if len(t) > 4 and t[:1] == b" " and t[1:].isalpha()]


def _letter_groups() -> tuple[Counter, set[str]]:
    """Pairs of letters, counted over the words and word parts of both public vocabularies, and triples."""
    pairs, triples = Counter(), set()
    for name in ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"):
        with open(public_tokenizers.path(name), "rb") as lines:
            for line in filter(bytes.strip, lines):
                word = base64.b64decode(line.split()[0]).decode(errors="replace").strip().lower()
                if word.isalpha():
                    pairs.update(map("".join, zip(word, word[1:])))
                    triples.update(map("".join, zip(word, word[1:], word[2:])))
    return pairs, triples


_PAIRS, _TRIPLES = _letter_groups()
_LETTERS = re.compile(r"[^\W\d_]+")
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://")
#: Marks that part the words of names, paths and the like; as a piece of its own one is cheap.
_MARKS, _MARK_COST = frozenset("._-/:+,;|#@&=?"), 1.0
_RANK = {w: i + 1 for i, w in enumerate(dict.fromkeys([*_WORDS, *_common_words()]))}
_LONGEST_WORD = max(map(len, _RANK))
_PLAIN = str.maketrans("@4310$57!", "aaeiosstl")
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:[0-2]?\d|3[01])|(?:[0-2]?\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d)")


def _neighbours() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for y, row in enumerate(_ROWS):
        for x, c in enumerate(row):
            near[c] = {
                _ROWS[b][a] for b in (y - 1, y, y + 1) for a in (x - 1, x, x + 1) if (a, b) != (x, y) and 0 <= b < len(_ROWS) and 0 <= a < len(_ROWS[b])
            }
    return near


_NEAR = _neighbours()


def _alphabet(text: str) -> int:
    """Characters that a brute-force guess has to try for each place."""
    size = 0
    for test, n in ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10)):
        size += n * any(map(test, text))
    return size + 33 * any(not c.isalnum() for c in text) or 10


def _reads_like_a_word(low: str) -> bool:
    if len(low) < _LEAST_LETTERS or any(_PAIRS[a + b] < _LEAST_PAIR for a, b in zip(low, low[1:])):
        return False
    return sum(t in _TRIPLES for t in map("".join, zip(low, low[1:], low[2:]))) >= _LEAST_TRIPLES * (len(low) - 2)


def _humps(text: str, start: int) -> Iterator[tuple[int, int]]:
    """A run of letters, cut before each large letter that follows a small one."""
    last = 0
    for k in range(1, len(text)):
        if text[k].isupper() and text[k - 1].islower():
            yield start + last, start + k
            last = k
    yield start + last, start + len(text)


def spans(text: str) -> Iterator[tuple[int, int, str, float]]:
    """(start, end, kind, cost) of each cheap span of a text, as many as its length allows a few times.

    Words and dates are short. A repeat goes from where it starts as far as it
    does; a walk or sequence starts where its run does or ends where that ends.
    """
    low = text.lower()
    if len(low) != len(text):  # a letter whose small form is longer stays as it is
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    plain_ = low.translate(_PLAIN)
    n = len(text)
    for i in range(n):
        for j in range(i + 3, min(n, i + _LONGEST_WORD) + 1):
            rank = _RANK.get(low[i:j])
            swapped = rank is None
            rank = rank or _RANK.get(plain_[i:j])
            if rank:
                case = 0 if text[i:j] in (low[i:j], low[i:j].upper(), low[i:j].capitalize()) else j - i
                yield i, j, "word", math.log10(rank + 1) + 0.3 * (case + 2 * swapped)
        if (m := _DATE.match(text, i)) and m.end() - i >= 4:
            yield i, m.end(), "date", 2.1 if m.end() - i == 4 else 4.6
        if text[i] in _MARKS:
            yield i, i + 1, "mark", _MARK_COST
    for m in _LETTERS.finditer(text):
        for i, j in _humps(m[0], m.start()):
            word = text[i:j]
            if word[1:] in (low[i + 1 : j], low[i + 1 : j].upper()) and _reads_like_a_word(low[i:j]):
                yield i, j, "wordlike", WORDLIKE + WORDLIKE_LETTER * (j - i)
    for size in (1, 2, 3, 4):
        same = [0] * (n + 1)
        for i in range(n - size - 1, -1, -1):
            same[i] = same[i + 1] + 1 if text[i] == text[i + size] else 0
            times = 1 + same[i] // size
            if times * size >= max(3, 2 * size):
                yield i, i + times * size, "repeat", size * math.log10(_alphabet(text[i : i + size])) + math.log10(times)
    for kind, joined, base in (
        ("walk", lambda a, b: b in _NEAR.get(a, ()), math.log10(47)),
        ("sequence", lambda a, b: ord(b) - ord(a) == 1, math.log10(62)),
        ("sequence", lambda a, b: ord(a) - ord(b) == 1, math.log10(62)),
    ):
        turn = math.log10(4.6) if kind == "walk" else 0.0
        start = 0
        while start < n:
            end = start + 1
            while end < n and joined(low[end - 1], low[end]):
                end += 1
            for i, j in {*((start, j) for j in range(start + 3, end + 1)), *((i, end) for i in range(start, end - 2))}:
                yield i, j, kind, base + turn * (j - i - 1) / 2 + math.log10(j - i)
            start = end


def guess_cost(text: str) -> float:
    """The least cost, as a power of ten, of guessing the whole text.

    Each further piece adds the cost of guessing where the pieces join. Time
    grows with the text's length, and so does the cost of one repeat. What an
    address names is not guessed letter by letter: it costs what its costliest
    part does.
    """
    if m := _URL.match(text):
        return max(map(guess_cost, re.split(r"[/?&=:#@.,;+_-]+", text[m.end() :])))
    n, join = len(text), math.log10(2)
    letter = math.log10(_alphabet(text)) if text else 0.0
    ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, j, _, cost in spans(text):
        ending[j].append((i, cost))
    # free[j]: the last character was guessed by brute force; cut[j]: a cheap span ends here.
    free, cut = [math.inf] * (n + 1), [math.inf] * (n + 1)
    cut[0] = 0.0
    for j in range(1, n + 1):
        free[j] = min(free[j - 1], cut[j - 1] + (join if j > 1 else 0)) + letter
        cut[j] = min((min(free[i], cut[i]) + cost + (join if i else 0) for i, cost in ending[j]), default=math.inf)
    return min(free[n], cut[n])


_remembered = lru_cache(maxsize=1 << 14)(guess_cost)


def value_cost(value: str) -> float:
    """:func:`guess_cost`; short values are remembered."""
    return _remembered(value) if len(value) <= _REMEMBERED_LENGTH else guess_cost(value)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches, leftmost and apart in each kind."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def added_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Values in credential context that cost too much and no base match holds."""
    found, at = [], 0
    while m := _CONTEXT.search(text, at):
        start = m.start(2)
        value = m[2].rstrip(".!?)]}:")
        end = start + len(value)
        at = start  # a credential word inside a dropped value has a value of its own
        if len(value) < 6 or any(s < end and start < e for s, e, _ in base):
            continue
        if value_cost(value) >= LEAST_COST:
            found.append((start, end, "guess"))
            at = m.end()
    return found


def costs_of(text: str, found: list[tuple[int, int, str]]) -> list[float | None]:
    """What guessing the values of ``found`` costs; null for kinds that are no password."""

    def cost(start: int, end: int, kind: str) -> float | None:
        if kind == "guess":
            return value_cost(text[start:end])
        return value_cost(_ASSIGN.match(text, start, end)[2]) if kind == "assign" else None

    return [cost(*span) for span in found]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches, "text"):
        rows, costs = [], []
        for t in column_of(part, "text"):
            text = t.as_py() or ""
            base = base_spans(text)
            every = sorted(base + added_spans(text, base), key=lambda s: (s[0], KINDS.index(s[2])))
            rows.append([{"kind": k, "start": s, "end": e} for s, e, k in every])
            costs.append(costs_of(text, every))
        yield pa.RecordBatch.from_arrays(
            [column_of(part, "doc_id").cast(pa.int64()), pa.array(rows, _SPANS), pa.array(costs, pa.list_(pa.float64()))], ["doc_id", "spans", "costs"]
        )


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans, costs): for each row of ``docs`` its secrets, in order of place.

    Places count code points, the end is exclusive. Null counts as empty, which
    has no spans; repeated rows are scanned each; whole texts are scanned,
    whatever their length; an empty table gives an empty one and extra columns
    are ignored. Spans of kinds assign, access and hex are the base matches;
    kind guess is added. ``costs`` has for each span of kind assign or guess what
    guessing its value costs, as a power of ten, and null for the others.
    """
    schema = "doc_id bigint, spans array<struct<kind:string,start:int,end:int>>, costs array<double>"
    return plain(docs, "doc_id", "text").mapInArrow(_scan, schema)
