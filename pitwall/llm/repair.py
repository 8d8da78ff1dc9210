"""Operator 12: conversation structure repair by a square-root checkpointed dynamic programme.

The cheapest edits (Keep 0, Rerole 1, Delete 2, Insert 5; an undeleted truncated row adds 5)
that give role initials ``(s?(ua)+)?`` follow from backward *state costs*: what it costs to
finish from each of four states (nothing yet, after s, after u, after a).  Of a run of n rows
only about sqrt(n) of these vectors are kept; the walk forward recomputes one block of them
at a time and takes, of the edges that are tight, the one whose initial comes first, so that
the edits are the ASCII-least of the cheapest.

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation of any size
is spread over as many tasks as it fills.  One that lies inside a task is finished there.
Of the others each task's *segment* is summed up as a 4 x 4 cost matrix; these (one per task
and conversation) give the vectors at the segments' ends; segments tell where each entry
state leaves them; that gives the states they are entered in; then each is walked.  Only the
digest of a whole repaired conversation is one stream, by definition of SHA-256: it reads
pieces of bounded size in order and keeps no more than the state of the hash (and the audit).

Order: turn (nulls first), then role, then text.  Faults, the first that applies: blank (no
``[^\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier in that order), truncated (the
last such character is not one of ``.!?``).  Null roles and texts are one space; a null
conversation id is a conversation of its own.  A role's initial is its first character.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.llm.common import bounded_batches, written

#: The costs, and the states that inserts and reroles lead to, with their role.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
#: State after a kept row of class s, u, a or other (-1: does not fit), by state before it.
KEPT = ((1, -1, -1, -1), (2, 2, -1, 2), (-1, -1, 3, -1), (-1, -1, -1, -1))
LEGAL = {(0, 1), (1, 2), (2, 1)}
INFINITE, NEVER = 1 << 60, 1 << 59
#: A conversation may end in the states 0 and 3.
END = (0, INFINITE, INFINITE, 0)
#: Rows and bytes of a piece of text.
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 20

#: A row's code is 3 * class + (0 sound, 1 truncated, 2 to be deleted).
SOUND, CUT, GONE = 0, 1, 2

Vector = tuple[int, int, int, int]


def _closed(a: list[int]) -> Vector:
    """State costs when inserts may come first."""
    two, three = min(a[2], INSERT + a[3]), min(a[3], INSERT + a[2])
    return min(a[0], INSERT + two), min(a[1], INSERT + two), two, three


def edges(code: int, state: int) -> list[tuple[str, int, int]]:
    """The edits of a row in a state, in order of their initials: (initial, cost, next state)."""
    kind, fault = divmod(code, 3)
    out = [("D", DELETE, state)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        if KEPT[kind][state] >= 0:
            out.append(("K", KEEP + more, KEPT[kind][state]))
        out.append(("R", REROLE + more, NEXT[state]))
    return out


EDGES = [[edges(code, state) for state in range(4)] for code in range(12)]
FINISH = _closed(list(END))
_STEPS: dict[tuple[int, Vector], tuple[int, Vector]] = {}


def back(code: int, after: Vector) -> Vector:
    """State costs before a row from those after it (a small automaton of normalised vectors)."""
    low = min(after)
    a, b, c, d = after
    key = (code, (a - low if a < NEVER else INFINITE, b - low if b < NEVER else INFINITE,
                  c - low if c < NEVER else INFINITE, d - low if d < NEVER else INFINITE))
    known = _STEPS.get(key)
    if known is None:
        best = _closed([min(cost + key[1][to] for _, cost, to in EDGES[code][s]) for s in range(4)])
        if len(_STEPS) > 1 << 16:
            _STEPS.clear()
        known = _STEPS[key] = best
    return known[0] + low, known[1] + low, known[2] + low, known[3] + low


def matrix(codes: bytes) -> list[list[int]]:
    """Cheapest cost of a run of rows from each state before it to each after its last row."""
    columns = []
    for t in range(4):
        v: Vector = tuple(0 if s == t else INFINITE for s in range(4))
        for code in reversed(codes):
            v = back(code, v)
        columns.append(v)
    return [[min(columns[t][s], INFINITE) for t in range(4)] for s in range(4)]


def checkpoints(codes: bytes, end: Vector) -> tuple[int, list[Vector]]:
    """The block length (square root of the rows) and the vectors at the blocks' ends, in order."""
    size = max(1, math.isqrt(len(codes)))
    kept, v = [], end
    for i in range(len(codes) - 1, -1, -1):
        if (i + 1) % size == 0 or i == len(codes) - 1:
            kept.append(v)
        v = back(codes[i], v)
    return size, kept[::-1]


def walk(codes: bytes, state: int, end: Vector, last: bool = True) -> tuple[str, int]:
    """The ASCII-least cheapest edits of a run of rows entered in ``state``, and the state after it.

    ``end`` are the state costs after the run; ``last``: nothing follows, so inserts may end it.
    """
    size, kept = checkpoints(codes, end)
    out: list[str] = []
    for b, after in enumerate(kept):
        block = codes[b * size:(b + 1) * size]
        vectors = [after]
        for code in reversed(block):
            vectors.append(back(code, vectors[-1]))
        vectors.reverse()
        for i, code in enumerate(block):
            here, then = vectors[i], vectors[i + 1]
            while True:
                move = None
                for edit in EDGES[code][state]:
                    if edit[1] + then[edit[2]] == here[state]:
                        move = edit
                        break
                # D comes before I, and I before K and R
                if (move is None or move[0] != "D") and INSERT + here[NEXT[state]] == here[state]:
                    out.append("I")
                    state = NEXT[state]
                    continue
                out.append(move[0])
                state = move[2]
                break
    while last and END[state] != end[state]:
        out.append("I")
        state = NEXT[state]
    return "".join(out), state


def edited(audit: str, roles: list[str], texts: list[str], state: int, codes: bytes) -> tuple[list[tuple[str, str]], int]:
    """Roles and texts that remain, in order, and the state after them."""
    out, row = [], 0
    for edit in audit:
        if edit == "I":
            out.append((ROLE[state], ""))
            state = NEXT[state]
            continue
        if edit == "K":
            out.append((roles[row], texts[row]))
            state = KEPT[codes[row] // 3][state]
        elif edit == "R":
            out.append((ROLE[state], texts[row]))
            state = NEXT[state]
        row += 1
    return out, state


# ---------------------------------------------------------------- rows and faults

def _spaced(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(df: DataFrame) -> DataFrame:
    """The contract's damage by crc32 of ``conv_id:turn`` modulo 20: (conv_id, turn, role, text)."""
    d = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                  _spaced(F.col("role")).alias("role"), _spaced(F.col("text")).alias("text"))
    how = F.crc32(F.concat(_spaced(F.col("conv_id")), F.lit(":"), _spaced(F.col("turn"))).cast("binary")) % 20
    d = d.withColumn("how", how).filter("how <> 0")
    d = d.withColumns({
        "text": F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("how") == 4, "user").otherwise(F.col("role"))})
    return d.withColumn("copy", F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))) \
            .select("conv_id", "turn", "role", "text")


def _same(a: DataFrame, b: DataFrame, names: dict[str, str]) -> Column:
    cond = F.lit(True)
    for x, y in names.items():
        cond = cond & a[x].eqNullSafe(b[y])
    return cond


def faulty(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number ``n``, class, and whether they are blank, cut, or seen at an earlier turn."""
    digest = F.sha2(F.col("text"), 256)
    seen = rows.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), digest.alias("d")).agg(
        F.min(F.struct("turn")).alias("early"), F.max(F.struct("turn")).alias("late"))
    seen = written(seen.filter(~F.col("early").eqNullSafe(F.col("late"))).select("c", "r", "d", F.col("early.turn").alias("early")), "seen")
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("digest", digest)
    one = one.join(seen, _same(one, seen, {"conv_id": "c", "role": "r", "digest": "d"}), "left")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    spaces = r"\x20\x09-\x0D"
    return one.select(
        "conv_id", "turn", "role", "text", "n", kind.cast("int").alias("kind"),
        (~F.col("text").rlike(f"[^{spaces}]")).alias("blank"), (~F.col("text").rlike(rf"[.!?][{spaces}]*\z")).alias("cut"),
        # nulls come first, so a key of two turns was seen before at any turn but its earliest
        (F.col("d").isNotNull() & ~F.col("turn").eqNullSafe(F.col("early"))).alias("again"))


COUNTS = ("blank", "duplicate", "truncated", "illegal")
_LONGS = [*COUNTS, "gaps", "cost"]
SEGMENT = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in _LONGS], T.StructField("audit", T.StringType()), T.StructField("sha", T.StringType()),
    T.StructField("codes", T.BinaryType()), T.StructField("matrix", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.StringType())), T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType()))])
_ARROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), *[(c, pa.int64()) for c in _LONGS],
                    ("audit", pa.string()), ("sha", pa.string()), ("codes", pa.binary()), ("matrix", pa.list_(pa.int64())),
                    ("ends", pa.list_(pa.string())), ("starts", pa.list_(pa.int64())),
                    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, (1 << 63) - 1)


def _digest(pairs: list[tuple[str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in pairs).encode()).hexdigest()


class _Segment:
    """The rows of one conversation in one task, as they come."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.codes = conv, bytearray()
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first = self.low = self.high = self.turn = self.early = None
        self.kind, self.distinct, self.rows = -1, 0, 0
        self.starts, self.size, self.seq = [0], 0, 0
        self.roles: list[str] = []
        self.texts: list[str] = []

    def add(self, turn, role, text, n, kind, blank, cut, again) -> None:
        if self.rows == 0:
            self.first, self.early = kind, turn
        if turn is not None and (self.low is None or turn != self.turn):
            self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.turn = turn
        copies = n - 1 if not (blank or again) else n
        self.counts["illegal"] += ((self.kind, kind) not in LEGAL) * (self.rows > 0) + ((kind, kind) not in LEGAL) * (n - 1)
        self.kind = kind
        self.rows += n
        if copies < n:
            self.codes.append(3 * kind + (CUT if cut else SOUND))
            self.counts["truncated"] += cut
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(text)
        if copies:
            self.codes.extend(bytes([3 * kind + GONE]) * copies)
            self.counts["blank" if blank else "duplicate"] += copies

    def full(self) -> bool:
        return len(self.texts) >= PIECE_ROWS or self.size >= PIECE_BYTES

    def piece(self, part: int) -> dict:
        """The texts since the last piece; rows to be deleted have none."""
        out = {"conv_id": self.conv, "part": part, "seq": self.seq, "roles": self.roles, "texts": self.texts}
        self.seq += 1
        self.starts.append(len(self.codes))
        self.roles, self.texts, self.size = [], [], 0
        return out

    def whole(self, texts: bool) -> dict:
        """The repaired conversation, if all of it is here."""
        codes = bytes(self.codes)
        audit, _ = walk(codes, 0, FINISH)
        pairs, _ = edited(audit, *_spread(codes, self.roles, self.texts), 0, codes)
        start = FINISH
        for code in reversed(codes):
            start = back(code, start)
        out = {"conv_id": self.conv, "part": -1, "seq": 0, **self.counts, "gaps": _gaps(self.low, self.high, self.distinct),
               "cost": start[0], "audit": audit, "sha": _digest(pairs)}
        return out | ({"roles": [r for r, _ in pairs], "texts": [t for _, t in pairs]} if texts else {})

    def open(self, part: int) -> dict:
        """What other segments need to know of this one."""
        codes = bytes(self.codes)
        ends = [self.low, self.high, self.early, self.turn, self.distinct, self.first, self.kind]
        return {"conv_id": self.conv, "part": part, "seq": -1, **self.counts, "codes": codes,
                "matrix": sum(matrix(codes), []), "ends": [None if x is None else str(x) for x in ends], "starts": self.starts}


def _spread(codes: bytes, roles: list[str], texts: list[str]) -> tuple[list, list]:
    """Roles and texts by row: rows to be deleted have none."""
    if len(roles) == len(codes):
        return roles, texts
    r, t = iter(roles), iter(texts)
    flags = [code % 3 != GONE for code in codes]
    return [next(r) if f else None for f in flags], [next(t) if f else None for f in flags]


def _batches(rows: Iterator[dict], size: int = 256) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 1 + sum(map(len, row.get("texts") or ())) // 4096 + len(row.get("codes") or b"") // 4096
        if weight >= size * 8 or len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, _ARROW)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _ARROW)


def _segments(rows: DataFrame, texts: bool) -> DataFrame:
    """Finished conversations (part -1), and the segments (seq -1) and text pieces of the others."""

    def run(batches):
        part = TaskContext.get().partitionId()

        def each():
            now, first = None, True
            for batch in batches:
                for conv, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if now is None or conv != now.conv:
                        if now is not None:
                            # the first conversation of a task may have begun in the one before
                            yield from finish(now, first)
                            first = False
                        now = _Segment(conv)
                    now.add(*row)
                    if now.full():
                        yield now.piece(part)
            if now is not None:
                yield from finish(now, True)

        def finish(s, reaches):
            if reaches or s.seq:
                yield s.piece(part)
                yield s.open(part)
            else:
                yield s.whole(texts)

        yield from _batches(each())

    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "turn", "role", "text", "n", "kind", "blank", "cut", "again").mapInArrow(run, SEGMENT)


# ---------------------------------------------------------------- conversations over several tasks

def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """State costs after each segment, from the matrices of those behind it, and the totals."""
    group = group.sort_values("part")
    v, out = FINISH, []
    for m in reversed(group["matrix"].tolist()):
        out.append(list(v))
        v = _closed([min(int(m[4 * s + t]) + v[t] for t in range(4)) for s in range(4)])
    return pd.DataFrame({"conv_id": group["conv_id"].array, "part": group["part"].array, "after": out[::-1], "cost": v[0]})


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """The state each segment is entered in, from where each state leaves those before it; the totals in the first row."""
    group = group.sort_values("part")
    state, states, last = 0, [], None
    total = {c: int(group[c].sum()) for c in COUNTS}
    low = high = None
    distinct = 0
    for e, exits in zip(group["ends"], group["exits"], strict=True):
        own_low, own_high, early, late, n, first, kind = (None if x is None else int(x) for x in e)
        states.append(state)
        state = int(exits[state])
        distinct += n
        if last is not None:
            distinct -= early is not None and early == last[0]
            total["illegal"] += (last[1], first) not in LEGAL
        last = (late, kind)
        low = own_low if low is None else low
        high = own_high if own_high is not None else high
    out = pd.DataFrame({"conv_id": group["conv_id"].array, "part": group["part"].array, "state": states,
                        "last": [False] * (len(group) - 1) + [True]})
    return out.assign(gaps=_gaps(low, high, distinct), **total)


def _joined(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on columns that may be null."""
    other = b.select(*[F.col(c).alias(f"o_{c}") if c in on else F.col(c) for c in b.columns])
    return a.join(other, _same(a, other, {c: f"o_{c}" for c in on})).drop(*[f"o_{c}" for c in on])


def _walked(segments: DataFrame, pieces: DataFrame) -> DataFrame:
    """Per piece of text of the open conversations: edits, state before, and the totals."""
    light = segments.select("conv_id", "part", "matrix")
    ends = written(light.groupBy("conv_id").applyInPandas(_ends, "conv_id long, part int, after array<long>, cost long"), "ends")
    known = _joined(segments.select("conv_id", "part", "codes", "starts", "ends", *COUNTS), ends, ["conv_id", "part"])

    def leave(batches):
        for batch in batches:
            codes, after = batch.column("codes").to_pylist(), batch.column("after").to_pylist()
            exits = [[walk(c, s, tuple(v), False)[1] for s in range(4)] for c, v in zip(codes, after, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(exits, pa.list_(pa.int64())),
                                              batch.column("ends"), *[batch.column(c) for c in COUNTS]],
                                             ["conv_id", "part", "exits", "ends", *COUNTS])

    counts = ", ".join(f"{c} long" for c in COUNTS)
    exits = known.mapInArrow(leave, f"conv_id long, part int, exits array<long>, ends array<string>, {counts}")
    entries = exits.groupBy("conv_id").applyInPandas(_entries, f"conv_id long, part int, state int, last boolean, gaps long, {counts}")
    entered = _joined(known.drop("ends", *COUNTS), written(entries, "entries"), ["conv_id", "part"])

    def cut(batches):
        """The walk of each segment, cut where its pieces of text are."""
        for batch in batches:
            for row in batch.to_pylist():
                codes, state = row["codes"], row["state"]
                audit, _ = walk(codes, state, tuple(row["after"]), row["last"])
                rows = np.flatnonzero(np.frombuffer(audit.encode(), np.uint8) != ord("I"))
                starts = row["starts"]
                out = []
                for seq in range(len(starts) - 1):
                    a, b = starts[seq], starts[seq + 1]
                    # inserts go with the row behind them, at the end with the last piece
                    at = (rows[a - 1] + 1 if a else 0)
                    to = len(audit) if seq == len(starts) - 2 else rows[b - 1] + 1 if b else 0
                    piece, part_codes = audit[at:to], codes[a:b]
                    out.append((row["conv_id"], row["part"], seq, piece, state, part_codes, row["cost"], row["gaps"], *[row[c] for c in COUNTS]))
                    state = _state_after(piece, part_codes, state)
                yield pa.RecordBatch.from_pylist([dict(zip(_CUT.names, x, strict=True)) for x in out], _CUT)

    cuts = entered.mapInArrow(cut, f"conv_id long, part int, seq int, audit string, state int, codes binary, cost long, gaps long, {counts}")
    return _joined(pieces.select("conv_id", "part", "seq", "roles", "texts"), cuts, ["conv_id", "part", "seq"])


_CUT = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("audit", pa.string()), ("state", pa.int32()),
                  ("codes", pa.binary()), ("cost", pa.int64()), ("gaps", pa.int64()), *[(c, pa.int64()) for c in COUNTS]])


def _state_after(audit: str, codes: bytes, state: int) -> int:
    row = 0
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            continue
        if edit == "K":
            state = KEPT[codes[row] // 3][state]
        elif edit == "R":
            state = NEXT[state]
        row += 1
    return state


def _streamed(walked: DataFrame) -> DataFrame:
    """Audit and digest of each open conversation: its pieces in order through one hash."""

    def run(batches):
        conv, state, rows = None, None, []

        def line():
            return {"conv_id": conv, "part": -1, "seq": 0, **state["totals"], "audit": "".join(state["audit"]), "sha": state["hash"].hexdigest()}

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != conv:
                    if state is not None:
                        rows.append(line())
                    conv, state = row["conv_id"], {"hash": hashlib.sha256(), "audit": [], "any": False,
                                                   "totals": {c: row[c] for c in _LONGS}}
                pairs, _ = edited(row["audit"], *_spread(row["codes"], row["roles"], row["texts"]), row["state"], row["codes"])
                state["audit"].append(row["audit"])
                if pairs:
                    state["hash"].update((("\n" if state["any"] else "") + "\n".join(f"{r}:{t}" for r, t in pairs)).encode())
                    state["any"] = True
            if len(rows) >= 64:
                yield pa.RecordBatch.from_pylist(rows, _RESULT)
                rows = []
        if state is not None:
            rows.append(line())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _RESULT)

    ordered = walked.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return ordered.mapInArrow(run, T.StructType([f for f in SEGMENT.fields if f.name in _RESULT.names]))


_RESULT = pa.schema([f for f in _ARROW if f.name in ("conv_id", "part", "seq", *_LONGS, "audit", "sha")])


def _listed(walked: DataFrame) -> DataFrame:
    """The repaired rows of each piece of text."""

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                pairs, _ = edited(row["audit"], *_spread(row["codes"], row["roles"], row["texts"]), row["state"], row["codes"])
                rows.append({"conv_id": row["conv_id"], "part": row["part"], "seq": row["seq"],
                             "roles": [r for r, _ in pairs], "texts": [t for _, t in pairs]})
            yield pa.RecordBatch.from_pylist(rows, _LISTED)

    return walked.mapInArrow(run, "conv_id long, part int, seq int, roles array<string>, texts array<string>")


_LISTED = pa.schema([f for f in _ARROW if f.name in ("conv_id", "part", "seq", "roles", "texts")])


def _prepared(rows: DataFrame, texts: bool) -> DataFrame:
    return written(_segments(faulty(bounded_batches(rows)), texts), "segments")


def _open(table: DataFrame) -> DataFrame:
    return _walked(table.filter("seq = -1"), table.filter("part >= 0 and seq >= 0"))


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (ascending within a conversation), role, text.

    ``rows`` holds conv_id, turn, role and text.
    """
    table = _prepared(rows, True)
    done = table.filter("part = -1").select("conv_id", "part", "seq", "roles", "texts").unionByName(_listed(_open(table)))
    pairs = F.posexplode(F.arrays_zip("roles", "texts")).alias("row", "pair")
    return done.select("conv_id", "part", "seq", pairs).select(
        "conv_id", F.struct("part", "seq", "row").alias("place"), F.col("pair.roles").alias("role"), F.col("pair.texts").alias("text"))


def audited(rows: DataFrame, ids: DataFrame, finish: Callable[[DataFrame], DataFrame] = _streamed) -> DataFrame:
    """One row per id of ``ids``: gaps, fault counts, cost, audit and digest of the repaired text."""
    table = _prepared(rows, False)
    columns = ["conv_id", *_LONGS, "audit", "sha"]
    done = table.filter("part = -1").select(*columns).unionByName(finish(_open(table)).select(*columns))
    every = ids.select(F.col("conv_id").cast("long").alias("id")).distinct()
    out = every.join(done, every["id"].eqNullSafe(done["conv_id"]), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("id").alias("conv_id"), *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", *COUNTS, "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(empty)).alias("repaired_sha256"))
