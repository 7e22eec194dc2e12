"""Repair of conversations whose roles must read ``(s?(ua)+)?``, by aligning turns to the alternating grammar string.

The turns of a conversation are aligned to every feasible length of the alternating string by Wagner-Fischer tables. Rows
are read from the end, so that one table holds all lengths: cell (i, r) is the least cost of turning rows i.. into the last
r letters. Only cells within a band (Ukkonen) around the rows still to be kept are filled; its width follows from the cost
of an incumbent repair, which a single pass finds. The cheapest audits of all lengths are read off the tables and compared.

A conversation of more than ``SEGMENT`` rows is cut into segments. Each is aligned from every state of the grammar to every
other; a small table of costs picks the states at the cuts, and segments are then repaired independently. No task holds
more than a segment's texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.operators.ordinals import row_ordinal
from carelake.session import materialise

#: Costs of edits; an undeleted truncated turn adds ``CUT``.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: Rows of a segment.
SEGMENT = 1024

START, SYSTEM, USER, ASSISTANT = range(4)
_STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What ends a conversation from each state.
_CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_LEGAL = {"su", "ua", "au"}
_BLANK = " \t\n\x0b\x0c\r"
_FAR = 1 << 29

TURNS = "array<struct<role:string,text:string>>"
SEGMENTS = (
    "conv_id long, segment long, audit string, cost long, blank long, duplicate long, truncated long, illegal long, "
    f"first string, last string, low_turn long, high_turn long, n_turns long, repaired {TURNS}"
)
DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def faults(rows: list[tuple], repeated: list[bool] | None = None) -> list[str]:
    """The first fault of each (turn, role, text): blank, duplicate, truncated, or an empty string.

    ``repeated`` tells which rows equal an earlier one in role and text; without it, the rows given are all there are.
    """
    out, seen = [], set()
    for k, (_, role, text) in enumerate(rows):
        end = text.rstrip(_BLANK)[-1:]
        again = repeated[k] if repeated is not None else (role, text) in seen
        out.append("blank" if not end else "duplicate" if again else "truncated" if end not in ".!?" else "")
        if repeated is None:
            seen.add((role, text))
    return out


def _expected(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _incumbent(states: list[int | None], entry: int) -> int:
    """Cost of a plain repair from ``entry`` of the rows that may stay: what is out of turn gets the missing turn before it."""
    cost, state = 0, entry
    for s in states:
        if s == _expected(state) or (s == SYSTEM and state == START):
            state = s
        elif s in (USER, ASSISTANT):
            cost, state = cost + INSERT, s
        else:
            cost, state = cost + REROLE, _expected(state)
    return cost


class _Table:
    """Least costs to turn rows i.. into the last r letters of a string that ends in state ``end``, within a band.

    Rows that must go, and the extra cost of truncated rows that stay, are in no cell; deleting a truncated row saves it.
    """

    def __init__(self, states: np.ndarray, must: np.ndarray, cut: np.ndarray, budget: int, end: int):
        n = len(states)
        self.states, self.must, self.cut, self.end = states, must, cut, end
        self.low = budget // (DELETE - CUT) + 2
        self.width = self.low + budget // INSERT + 2
        stay = np.concatenate((np.cumsum(~must[::-1])[::-1], [0]))
        self.base = stay - self.low
        at, steps = np.arange(self.width), INSERT * np.arange(self.width)
        g = self.cost = np.full((n + 1, self.width + 1), _FAR, np.int64)
        lead = self.lead = np.full((n + 1, self.width + 1), _FAR, np.int64)  # the same with the system turn still to come
        if self.low < self.width:
            g[n, self.low] = 0
        for i in range(n - 1, -1, -1):
            after, r = g[i + 1], self.base[i] + at
            if must[i]:
                best = after[:-1].copy()
                lead[i] = lead[i + 1]
            else:
                fit = np.where(self._user(r) == (states[i] == USER), 0, REROLE) if states[i] in (USER, ASSISTANT) else REROLE
                best = np.minimum(np.where(r > 0, after[:-1] + fit, _FAR), after[1:] + DELETE - cut[i])
                lead[i, :-1] = lead[i + 1, 1:] + DELETE - cut[i]
                if states[i] == SYSTEM:
                    lead[i, :-1] = np.minimum(lead[i, :-1], after[1:])
            best[r < 0] = _FAR
            g[i, :-1] = np.minimum(np.minimum.accumulate(best - steps) + steps, _FAR)
        np.minimum(lead, _FAR, out=lead)

    def _user(self, r):
        """Whether the letter with ``r`` to go is a user's."""
        return (r % 2 == 0) == (self.end == ASSISTANT)

    def _at(self, table: np.ndarray, i: int, r: int) -> int:
        k = r - int(self.base[i])
        return int(table[i, k]) if r >= 0 and 0 <= k < self.width else _FAR

    def lengths(self, entry: int) -> list[int]:
        """String lengths in the band whose first letter may follow ``entry``."""
        user = _expected(entry) == USER
        least = 0 if entry == self.end else 1
        first = max(least, int(self.base[0]))
        return [r for r in range(first, int(self.base[0]) + self.width) if (r == 0 and entry == self.end) or (r > 0 and bool(self._user(r)) == user)]

    def audit(self, r: int, lead: bool) -> str:
        """The ASCII-least cheapest audit of all rows to ``r`` letters."""
        out, i, n = [], 0, len(self.states)
        while i < n or r:
            table = self.lead if lead else self.cost
            here = self._at(table, i, r)
            gone = 0 if i < n and self.must[i] else DELETE - (int(self.cut[i]) if i < n else 0)
            if i < n and self._at(table, i + 1, r) + gone == here:
                out.append("D")
                i += 1
            elif lead:
                out.append("K")
                lead, i = False, i + 1
            elif r and self._at(table, i, r - 1) + INSERT == here:
                out.append("I")
                r -= 1
            else:
                same = self.states[i] == (USER if self._user(r) else ASSISTANT)
                out.append("K" if same else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def _deleted(states, must, cut, keep: int | None = None) -> int:
    gone = ~must & (np.arange(len(must)) != (-1 if keep is None else keep))
    return int((DELETE - cut[gone]).sum())


def alignments(letters: list[str], found: list[str], entries: tuple[int, ...] = (START, SYSTEM, USER, ASSISTANT)) -> dict[tuple[int, int], tuple[int, str]]:
    """For each pair of grammar states that the rows can lead from and to: the least cost, and the ASCII-least audit of it.

    No audit ends with an insertion, so none is the beginning of another and audits of neighbouring segments compare in turn.
    ``letters`` are role initials, ``found`` the rows' faults.
    """
    n = len(letters)
    states = np.array([_STATE.get(x, -1) for x in letters], np.int64)
    must = np.array([f in ("blank", "duplicate") for f in found], bool)
    cut = np.array([CUT if f == "truncated" else 0 for f in found], np.int64)
    fixed = DELETE * int(must.sum()) + int(cut[~must].sum())
    out: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(entry: int, leave: int, cost: int, audit: str) -> None:
        out[entry, leave] = min(out.get((entry, leave), (_FAR, "")), (cost + fixed, audit))

    nothing = _deleted(states, must, cut)
    for entry in entries:
        offer(entry, entry, nothing, "D" * n)
    if START in entries:
        for i in np.flatnonzero((states == SYSTEM) & ~must):
            offer(START, SYSTEM, _deleted(states, must, cut, i), "D" * int(i) + "K" + "D" * (n - int(i) - 1))
    if not n:
        return out
    staying = [int(s) for s, m in zip(states, must, strict=True) if not m]
    budget = max(_incumbent(staying, e) for e in entries) + INSERT
    for leave in (USER, ASSISTANT):
        pending = list(entries)
        while pending:
            table, later = _Table(states, must, cut, budget, leave), []
            for entry in pending:
                lengths = table.lengths(entry)
                options = [(table._at(table.cost, 0, r), r, False) for r in lengths] + ([(table._at(table.lead, 0, r), r, True) for r in lengths] if entry == START else [])
                best = min((c for c, _, _ in options), default=_FAR)
                known = out.get((entry, leave), (_FAR, ""))[0] - fixed
                if best > budget and known > budget:
                    later.append(entry)
                    continue
                for c, r, lead in options:
                    if c == best <= known:
                        offer(entry, leave, c, table.audit(r, lead))
            pending, budget = later, budget * 2 if later else budget
    return out


def cheapest(letters: list[str], found: list[str]) -> str:
    """The audit of a whole conversation: least cost, then ASCII-least."""
    ways = alignments(letters, found, (START,))
    return min((cost + INSERT * len(_CLOSING[leave]), audit + _CLOSING[leave]) for (_, leave), (cost, audit) in ways.items())[1]


def apply(rows: list[tuple], found: list[str], audit: str, entry: int = START) -> tuple[list[dict], int]:
    """The repaired turns and the cost of an audit over (turn, role, text) rows that follow ``entry``."""
    out, cost, state, i = [], 0, entry, 0
    for edit in audit:
        if edit == "I":
            state = _expected(state)
            out.append({"role": _ROLE[state], "text": ""})
            cost += INSERT
            continue
        _, role, text = rows[i]
        if edit == "D":
            cost += DELETE
        else:
            cost += CUT if found[i] == "truncated" else 0
            state = _STATE[role[0]] if edit == "K" else _expected(state)
            out.append({"role": role if edit == "K" else _ROLE[state], "text": text})
            cost += 0 if edit == "K" else REROLE
        i += 1
    return out, cost


def _row(conv_id, segment: int, rows: list[tuple], found: list[str], audit: str, entry: int = START) -> dict:
    repaired, cost = apply(rows, found, audit, entry)
    initials = [r[1][:1] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    return {
        "conv_id": conv_id, "segment": segment, "audit": audit, "cost": cost,
        "blank": found.count("blank"), "duplicate": found.count("duplicate"), "truncated": found.count("truncated"),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "first": initials[0], "last": initials[-1],
        "low_turn": turns[0] if turns else None, "high_turn": turns[-1] if turns else None, "n_turns": len(set(turns)),
        "repaired": repaired,
    }


_SEGMENT_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("audit", pa.string()), *[(c, pa.int64()) for c in ("cost", "blank", "duplicate", "truncated", "illegal")],
    ("first", pa.string()), ("last", pa.string()), *[(c, pa.int64()) for c in ("low_turn", "high_turn", "n_turns")], ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of at most a segment, their rows one after the other in order."""
    conv_id, rows, done, held = None, [], [], 0

    def close() -> None:
        found = faults(rows)
        done.append(_row(conv_id, 0, rows, found, cheapest([r[1][:1] for r in rows], found)))

    for batch in batches:
        for key, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if rows and key != conv_id:
                close()
                rows = []
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(done, _SEGMENT_ARROW)
                    done, held = [], 0
            conv_id = key
            rows.append((turn, role, text))
            held += len(text) + 100
    if rows:
        close()
    if done:
        yield pa.RecordBatch.from_pylist(done, _SEGMENT_ARROW)


def _rows_of(part: pd.DataFrame) -> tuple[list[tuple], list[str]]:
    part = part.sort_values("place")
    rows = [(None if pd.isna(t) else int(t), r, x) for t, r, x in zip(part["turn"], part["role"], part["text"], strict=True)]
    return rows, faults(rows, list(part["place"] > part["first_place"]))


def _key(value) -> int | None:
    return None if pd.isna(value) else int(value)


def _ways(part: pd.DataFrame) -> pd.DataFrame:
    rows, found = _rows_of(part)
    ways = alignments([r[1][:1] for r in rows], found)
    order = {audit: k for k, audit in enumerate(sorted({a for _, a in ways.values()}))}
    return pd.DataFrame([(_key(part["conv_id"].iloc[0]), int(part["segment"].iloc[0]), e, x, c, order[a], a) for (e, x), (c, a) in ways.items()], columns=["conv_id", "segment", "entry", "leave", "cost", "place", "audit"]).astype({"conv_id": "Int64"})


def _route(part: pd.DataFrame) -> pd.DataFrame:
    """The states at the cuts of one conversation: least cost, ties decided by the order of audits, segment by segment."""
    tables = [(int(s), g[["entry", "leave", "cost", "place"]].to_numpy()) for s, g in part.groupby("segment", sort=True)]
    rest = {state: INSERT * len(closing) for state, closing in _CLOSING.items()}
    steps = []
    for segment, ways in reversed(tables):
        best: dict[int, tuple] = {}
        for entry, leave, cost, place in ways.tolist():
            best[entry] = min(best.get(entry, (_FAR, 0, 0)), (cost + rest[leave], place, leave))
        rest = {e: best[e][0] if e in best else _FAR for e in rest}
        steps.append((segment, {e: b[2] for e, b in best.items()}))
    state, out = START, []
    for segment, leave in reversed(steps):
        out.append((_key(part["conv_id"].iloc[0]), segment, state, leave[state], ""))
        state = leave[state]
    out[-1] = (*out[-1][:4], _CLOSING[state])
    return pd.DataFrame(out, columns=["conv_id", "segment", "entry", "leave", "closing"]).astype({"conv_id": "Int64"})


def _mended(part: pd.DataFrame) -> pd.DataFrame:
    rows, found = _rows_of(part)
    first = part.iloc[0]
    row = _row(_key(first["conv_id"]), int(first["segment"]), rows, found, first["audit"] + first["closing"], int(first["entry"]))
    return pd.DataFrame([row]).astype({c: "Int64" for c in ("conv_id", "low_turn", "high_turn")})


def _cut_up(rows: DataFrame, segment: int) -> DataFrame:
    """Segments of conversations of any length. Rows are dealt by their place in the whole order, so no conversation is one task."""
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    placed = row_ordinal(rows, ["conv_id", "turn", "role", "text"], "place").withColumn("segment", F.floor(F.col("place") / segment).cast("long")).withColumn("said", said)
    first = placed.groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s")).agg(F.min("place").alias("first_place"))
    joined = placed.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")))
    flagged = materialise(joined.select("conv_id", "segment", "place", "turn", "role", "text", "first_place"), "turns-flagged")
    ways = flagged.groupBy("conv_id", "segment").applyInPandas(_ways, "conv_id long, segment long, entry int, leave int, cost long, place long, audit string")
    ways = materialise(ways, "turns-ways")
    # one row of a few numbers for each of a segment's pairs of states: a thousandth of the conversation's rows, without texts
    route = ways.drop("audit").groupBy("conv_id").applyInPandas(_route, "conv_id long, segment long, entry int, leave int, closing string")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s"))
    chosen = route.select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), F.col("entry").alias("e"), F.col("leave").alias("l"), "closing")
    chosen = ways.join(chosen, same & (F.col("entry") == F.col("e")) & (F.col("leave") == F.col("l"))).select("c", "s", "entry", "audit", "closing")
    whole = flagged.join(chosen, same).drop("c", "s")
    return whole.groupBy("conv_id", "segment").applyInPandas(_mended, SEGMENTS)


def _parts(conversations: DataFrame, segment: int) -> tuple[DataFrame, DataFrame | None]:
    """Repaired conversations of one segment, and the segments of longer ones (None if there are none)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role"), text("text"))
    sizes = rows.groupBy(F.col("conv_id").alias("c")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > segment).select("c")
    sizes = materialise(sizes, "turns-long")
    long = not sizes.isEmpty()
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    short = rows.join(sizes, same, "left_anti") if long else rows
    short = short.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return short.mapInArrow(_whole, SEGMENTS), _cut_up(rows.join(sizes, same, "left_semi"), segment) if long else None


def repair(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The repaired turns of every conversation, in segments of at most ``segment`` rows, with audit, cost and faults.

    Rows are taken by turn (nulls first), then role and text; null roles and texts are one space; rows without conv_id are one
    conversation. A role is known by its first letter, in lower case; an empty role fits nothing. Repeated rows are
    duplicates; other columns are ignored; an empty table gives no rows. Texts of any length are held one segment at a time.
    Conversations beyond a segment are counted first and repaired by segments, with the same result.
    """
    short, long = _parts(conversations, segment)
    return short if long is None else short.unionByName(long)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its segments, which come one after the other in order; texts are hashed as they pass."""
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    key, open_ = None, None
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")

    def close() -> dict:
        low, high = open_["low"], open_["high"]
        return {"conv_id": key, "gaps": 0 if low is None else high - low + 1 - open_["turns"], **{c: open_[c] for c in sums}, "audit": "".join(open_["audit"]), "repaired_sha256": open_["sha"].hexdigest()}

    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if open_ is None or row["conv_id"] != key or row["segment"] == 0:
                if open_ is not None:
                    done.append(close())
                key, open_ = row["conv_id"], {"low": None, "high": None, "turns": 0, "last": None, "audit": [], "sha": hashlib.sha256(), "started": False, **dict.fromkeys(sums, 0)}
            for c in sums:
                open_[c] += row[c]
            if open_["last"] is not None:
                open_["illegal"] += open_["last"] + row["first"] not in _LEGAL
            open_["last"] = row["last"]
            if row["low_turn"] is not None:
                open_["turns"] += row["n_turns"] - (row["low_turn"] == open_["high"])
                open_["low"] = row["low_turn"] if open_["low"] is None else open_["low"]
                open_["high"] = row["high_turn"]
            open_["audit"].append(row["audit"])
            for turn in row["repaired"]:
                open_["sha"].update((b"\n" if open_["started"] else b"") + f"{turn['role']}:{turn['text']}".encode())
                open_["started"] = True
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if open_ is not None:
        yield pa.RecordBatch.from_pylist([close()], schema)


def digests(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``repair``: faults, cost, audit and the SHA-256 of its turns.

    The digest of a conversation is one sequential hash: the segments of a long one pass through one task in order, and none
    is held. A conversation of one segment stays where it was repaired.
    """
    short, long = _parts(conversations, segment)
    done = short.mapInArrow(_finish, DIGEST)
    if long is None:
        return done
    return done.unionByName(long.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(_finish, DIGEST))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, by a hash of conversation and turn (nulls: one space)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("kind")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role").alias("role"), text("text").alias("text"), kind)
    copies = F.when(F.col("kind") == 0, F.lit(0)).when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1))
    changed = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), changed.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def damaged_and_repaired(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The digest of every conversation after damage and repair; one left without rows has zeros and an empty audit."""
    done = digests(damaged(conversations), segment)
    ids = conversations.select(F.col("conv_id").cast("long").alias("original")).distinct()
    joined = ids.join(done, F.col("original").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return joined.select(F.col("original").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
