"""Conversation repair against a plain search over grammar states."""

import hashlib
import os
import random
import re
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from carelake.llm import queries, turns  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_audit(letters, found):
    """The least (cost, audit) over all edits, state by state; insertions come one at a time, at most three in a row."""
    moves = {"": "su", "s": "u", "u": "a", "a": "u"}
    n = len(letters)
    best = {(n, st, k): (0, "") if st in ("", "a") else (10**9, "") for st in moves for k in range(4)}
    for i in range(n, -1, -1):
        for k in range(3, -1, -1):
            for st in moves:
                options = [best[i, st, k]] if i == n else []
                if k < 3:
                    for letter in moves[st].replace("s", ""):
                        c, a = best[i, letter, k + 1]
                        options.append((c + 2, "I" + a))
                if i < n:
                    must, cut = found[i] in ("blank", "duplicate"), int(found[i] == "truncated")
                    c, a = best[i + 1, st, 0]
                    options.append((c + 3, "D" + a))
                    for letter in moves[st]:
                        if not must and letter == letters[i]:
                            c, a = best[i + 1, letter, 0]
                            options.append((c + cut, "K" + a))
                        if not must and letter != "s":
                            c, a = best[i + 1, letter, 0]
                            options.append((c + 2 + cut, "R" + a))
                best[i, st, k] = min(options)
    return best[0, "", 0]


def plain_repair(rows):
    """Counts, cost, audit and hash of one conversation's (turn, role, text) rows in order."""
    found, seen = [], set()
    for _, role, text in rows:
        end = text.strip(BLANK)[-1:]
        found.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    letters = [r[1][:1] for r in rows]
    cost, audit = plain_audit(letters, found)
    out, state, i = [], "", 0
    for edit in audit:
        following = "a" if state == "u" else "u"
        if edit == "I":
            state = following
            out.append(("user" if state == "u" else "assistant") + ":")
            continue
        if edit in "KR":
            state = letters[i] if edit == "K" else following
            out.append((rows[i][1] if edit == "K" else "user" if state == "u" else "assistant") + ":" + rows[i][2])
        i += 1
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain_query(rows):
    kept = {r[0]: [] for r in rows}
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept[conv_id] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return sorted(((c, *(plain_repair(sorted(v, key=order)) if v else empty)) for c, v in kept.items()), key=repr)


def random_rows(rng, conversations, longest, wild=False):
    out = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 6 + ["system", "tool", "", None]) if wild else ("user", "assistant")[t % 2]
            out.append((c, t, role, rng.choice(["Yes.", "No", " \n", "So?", f"Word {rng.randrange(5)}.", f"{c} {t}!", None if wild else "ok."])))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_audits_against_search(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n = rng.randint(0, 14)
        letters = [rng.choice("uuuaaas" + "x ") for _ in range(n)]
        found = [rng.choice(["", "", "", "", "blank", "truncated", "duplicate"]) for _ in range(n)]
        rows = [(k, {"u": "user", "a": "assistant", "s": "system"}.get(x, x), "t") for k, x in enumerate(letters)]
        cost, audit = plain_audit(letters, found)
        assert turns.cheapest(letters, found) == audit
        assert turns.apply(rows, found, audit)[1] == cost


def test_long_conversation_against_search():
    rng = random.Random(3)
    letters = ["s"] + [rng.choice("ua") if rng.random() < 0.2 else "ua"[k % 2] for k in range(700)]
    found = [rng.choice([""] * 12 + ["blank", "truncated", "duplicate"]) for _ in letters]
    assert turns.cheapest(letters, found) == plain_audit(letters, found)[1]


@pytest.mark.parametrize("segment", [3, 1024])
def test_query_against_search(spark, segment):
    rows = random_rows(random.Random(segment), 60, 12, wild=True) + [(None, None, None, None), (None, 3, "user", "So."), (None, None, "assistant", "So."), (7, 1, "user", "Yes."), (7, 1, "user", "Yes."), (9, None, "user", "x" * 300_000), (-1, 5, "system", "Only.")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("place", "segment", "c", "s", "copy", "kind", "n"):
        df = df.withColumn(c, cases.F.lit("clash"))
    got = cases.collected(turns.damaged_and_repaired(df, segment))
    assert got == plain_query(rows)


def test_one_conversation_holds_a_third_of_all_rows(spark):
    rows = random_rows(random.Random(1), 200, 8) + [(999, t, ("user", "assistant")[t % 2], f"Turn {t % 400}.") for t in range(600)]
    got = cases.collected(turns.damaged_and_repaired(spark.createDataFrame(rows, SCHEMA), 64))
    assert got == plain_query(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", "Yes"), (2, 0, "system", "Be.")]
    out = {r.conv_id: r for r in turns.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (out[1].audit, out[1].cost) == ("KIKK", 3)
    assert [(t.role, t.text) for t in out[1].repaired] == [("user", "Hi."), ("assistant", ""), ("user", "There."), ("assistant", "Yes")]
    assert (out[2].audit, out[2].cost, out[2].repaired) == ("D", 3, [])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turns.repair(empty).count() == 0
    assert turns.damaged_and_repaired(empty).count() == 0


def test_whole_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert cases.collected(queries.op11_turn_repair(spark, SF)) == plain_query(rows)
