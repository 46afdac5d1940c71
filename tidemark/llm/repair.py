"""Repair of conversations whose structure is damaged, at the least cost.

Turns are kept (0), given another role (3), deleted (4) or inserted (3) until
their role initials read ``(s?(ua)+)?``; what must go and what is cut short
costs as stated at :func:`cheapest`. The search is branch-and-bound, depth
first, over nodes (rows read, state); states are the start and the last initial.

Texts stay where they are until the edits are known: the first pass moves one
slim row per distinct turn, the second one streams texts in order past the
edits. A task holds one byte per turn of the conversation at hand, as long as
the audit that it returns, and never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_of, parts, plain, settled

BLANKS = " \t\n\x0b\f\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after a system, a user and an assistant turn. A row's code is the state that
#: keeping it leads to (0: none), plus bits for one that has to go and for one that is cut short.
START, SYSTEM, USER, ASSISTANT = range(4)
GO, CUT = 4, 8
_STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NEVER = 1 << 60
_LEGAL = {"su", "ua", "au"}
_ROLES = {USER: "user", ASSISTANT: "assistant"}


def _moves(code: int, state: int) -> list[tuple[int, int, int]]:
    """(edit, cost, next state) of a row, edits in ASCII order."""
    found = [(ord("D"), DELETE, state)]
    if not code & GO:
        extra = TRUNCATED if code & CUT else 0
        kept, turn = code & 3, _AFTER[state]
        if kept == turn or (kept == SYSTEM and state == START):
            found.append((ord("K"), extra, kept))
        found.append((ord("R"), REROLE + extra, turn))
    return found


def bounds(codes: bytes) -> list[list[int]]:
    """For each suffix and state the least that its edits cost, whatever their order."""

    def inserted(row: list[int]) -> list[int]:
        for _ in range(2):
            row = [min(row[q], INSERT + row[_AFTER[q]]) for q in range(4)]
        return row

    out = [inserted([0, _NEVER, _NEVER, 0])]
    table = {c: [_moves(c, q) for q in range(4)] for c in set(codes)}
    for code in reversed(codes):
        below = out[-1]
        out.append(inserted([min(cost + below[to] for _, cost, to in moves) for moves in table[code]]))
    out.reverse()
    return out


def cheapest(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits; of equal ones, the audit that sorts first.

    The audit has K, R, D or I for each edit. Edits are tried in ASCII order, so
    of two prefixes with one node and cost the one met first sorts first, and
    the table of nodes drops the later one and any that costs more. Of two
    prefixes with one node and cost neither begins the other, so what follows
    cannot change their order. A prefix is also dropped if it and the bound of
    its suffix reach the incumbent's cost; when the stack is empty, the
    incumbent is proved. The bounds are attained, so the first incumbent to
    beat is one more than the root's. The path is kept once, cut back and grown
    as the stack is walked.
    """
    ahead, n = bounds(codes), len(codes)
    best, audit = ahead[0][START] + 1, b""
    least: dict[int, int] = {}
    path = bytearray()
    stack = [(0, 0, 0, START, 0)]
    while stack:
        depth, edit, at, state, cost = stack.pop()
        if edit:
            del path[depth - 1 :]
            path.append(edit)
        if cost + ahead[at][state] >= best or least.get(at * 4 + state, _NEVER) <= cost:
            continue
        least[at * 4 + state] = cost
        if at == n and state in (START, ASSISTANT):
            best, audit = cost, bytes(path)
            continue
        nexts = [(ord("I"), INSERT, _AFTER[state], at)]
        if at < n:
            nexts += [(e, c, to, at + 1) for e, c, to in _moves(codes[at], state)]
        for e, c, to, place in sorted(nexts, reverse=True):
            stack.append((depth + 1, e, place, to, cost + c))
    return best, audit.decode()


def _usable(rows: DataFrame) -> DataFrame:
    """The rows with nulls of role and text as one space, and what orders rows of one turn."""
    read = [F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn")]
    filled = plain(rows, "conv_id", "turn", "role", "text").select(*read, *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    return filled.withColumn("digest", F.unhex(F.sha2("text", 256)))




def _in_order(df: DataFrame, *first: str) -> DataFrame:
    keys = [F.asc_nulls_first("conv_id"), *first, F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("digest")]
    return df.repartition("conv_id").sortWithinPartitions(*keys)


def _coded(rows: DataFrame) -> DataFrame:
    """One row per distinct turn: its number, whether an earlier turn says the same, and its faults.

    Copies are counted before the shuffle. The first turn of a role and text is
    found by an aggregate and joined back, both sides by plain exchanges, so a
    text that fills a conversation is split like any other.
    """
    said = F.rtrim("text", F.lit(BLANKS))
    seen = rows.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        (said == "").alias("blank"),
        (~F.substring(said, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    keys = ["conv_id", "role", "digest"]
    counted = settled(seen.groupBy("turn", *keys, "blank", "cut").agg(F.count("*").alias("copies")), "turns")
    first = counted.groupBy(*keys).agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn"))["turn"].alias("first"))
    first = settled(first.select(*[F.col(k).alias(f"_{k}") for k in keys], "first"), "first")
    on = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    fresh = F.col("turn").eqNullSafe(F.col("first")).alias("fresh")
    return counted.join(first, on).select("conv_id", "turn", "role", "digest", "blank", "cut", "copies", fresh)


_PLAN = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_PLAN_TYPES = [pa.int64()] * 7 + [pa.string()]
_PLAN_NAMES = [c.split()[0] for c in _PLAN.split(", ")]


class _Reading:
    """The counts and codes of one conversation, row by row in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes = conv_id, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.last = None

    def read(self, turn: int | None, role: str, blank: bool, cut: bool, copies: int, fresh: bool) -> None:
        if turn is not None and turn != self.most:
            self.turns, self.most = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.last + initial not in _LEGAL
        self.illegal += copies - 1
        self.last = initial
        live = fresh and not blank
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - live
        self.truncated += live and cut
        self.codes += bytes([_STATE.get(initial, START) | (CUT if cut else 0)]) * live + bytes([GO]) * (copies - live)

    def plan(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *cheapest(bytes(self.codes)))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], most: int = 1 << 12) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _batch(held, names, types)
            held = []
    if held:
        yield _batch(held, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _planned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        now: _Reading | None = None
        for batch in batches:
            names = ("conv_id", "turn", "role", "blank", "cut", "copies", "fresh")
            for conv_id, *turn in zip(*[column_of(batch, c).to_pylist() for c in names]):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        yield now.plan()
                    now = _Reading(conv_id)
                now.read(*turn)
        if now is not None:
            yield now.plan()

    yield from _batches(rows(), _PLAN_NAMES, _PLAN_TYPES)


def plans(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation of ``rows``.

    A conversation is read by turn, nulls first; rows of one turn come by role
    and by their texts' sha256, equal rows side by side. A null conv_id is a
    conversation of its own; nulls of role and text are read as one space. A
    row's first fault counts: ``blank``, ``duplicate`` (an earlier row has its
    role and text), ``truncated`` (its last character that is not white space
    is none of ``.!?``). ``gaps`` are the numbers missing between the first and
    last turn, ``illegal`` the neighbours whose initials are not su, ua or au.
    A role with another initial, or none, cannot be kept. Very long texts and
    conversations are read like others; extra columns are ignored; an empty
    table has no conversations.
    """
    return _in_order(_coded(_usable(rows))).mapInArrow(_planned, _PLAN)


class _Edits:
    """Walks the audit of one conversation as its rows pass."""

    def __init__(self, header: tuple, audit: str):
        self.header, self.audit = header, audit
        self.at, self.state, self.place = 0, START, 0

    def _turn(self, state: int, role: str, text: str, edit: str) -> tuple:
        self.state, self.place = state, self.place + 1
        return self.place - 1, role, text, edit

    def inserts(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            state = _AFTER[self.state]
            yield self._turn(state, _ROLES[state], "", "I")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield self._turn(_STATE[role[:1]], role, text, edit)
        elif edit == "R":
            state = _AFTER[self.state]
            yield self._turn(state, _ROLES[state], text, edit)


def _passed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[_Edits, Iterator[tuple], bool]]:
    """Each conversation's edits with the turns that a row gives, and whether they are the last."""
    now: _Edits | None = None
    for part in parts(batches, "text"):
        headers = zip(*[column_of(part, c).to_pylist() for c in _PLAN_NAMES])
        for header, role, text in zip(headers, column_of(part, "role").to_pylist(), column_of(part, "text").to_pylist()):
            if header[-1] is not None:
                if now is not None:
                    yield now, now.inserts(), True
                now = _Edits(header, header[-1])
            else:
                yield now, now.row(role, text), False
    if now is not None:
        yield now, now.inserts(), True


def _with_plans(rows: DataFrame, found: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` over the rows of each conversation in order, its plan ahead of them."""
    head = found.select(*_PLAN_NAMES, *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "bigint"), ("role", "string"), ("text", "string"), ("digest", "binary"))])
    body = _usable(rows).select(
        "conv_id", *[F.lit(None).cast("string" if c == "audit" else "bigint").alias(c) for c in _PLAN_NAMES[1:]], "turn", "role", "text", "digest"
    )
    return _in_order(head.union(body), F.col("audit").isNull()).mapInArrow(run, schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the turns that stay or come in, in order.

    ``found`` is what :func:`plans` gave for the same rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = ((of.header[0], *t) for of, some, _ in _passed(batches) for t in some)
        yield from _batches(turns, ["conv_id", "place", "role", "text", "edit"], [pa.int64(), pa.int64(), *[pa.string()] * 3], 256)

    return _with_plans(rows, found, run, "conv_id bigint, place bigint, role string, text string, edit string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``repaired_sha256``: the digest of ``role:text`` of all repaired turns, joined by newlines."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed() -> Iterator[tuple]:
            digest = hashlib.sha256()
            for of, some, last in _passed(batches):
                for place, role, text, _ in some:
                    digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
                if last:
                    yield (*of.header, digest.hexdigest())
                    digest = hashlib.sha256()

        yield from _batches(hashed(), [*_PLAN_NAMES, "repaired_sha256"], [*_PLAN_TYPES, pa.string()])

    return _with_plans(rows, found, run, _PLAN + ", repaired_sha256 string")


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The plan and digest of every conv_id of ``conversations``; one without ``rows`` needs nothing."""
    found = settled(plans(rows), "plans")
    done = settled(digests(rows, found), "repaired")
    ids = plain(conversations, "conv_id").select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    met = ids.join(done.withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    nothing = {**{c: 0 for c in _PLAN_NAMES[1:-1]}, "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return met.fillna(nothing)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with one fault in a quarter of the rows, by a checksum of conv_id and turn.

    Of 20 classes 0 drops the row, 1 empties its text, 2 takes its ``.!?``
    away, 3 repeats it and 4 makes it a user's; nulls are one space.
    """
    filled = plain(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = filled.withColumn("fault", F.crc32(key) % 20).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("time")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times).drop("time")
