"""Conversation repair against an enumeration of all edits and a plain version of the whole query."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import common, dialogue

GOOD = re.compile(r"(s?(ua)+)?")


def enumerated(symbols, most_inserts=3):
    """The cheapest edits of a few symbols by trying all."""
    found = []
    for edits in itertools.product("KRD", repeat=len(symbols)):
        if any(s == "X" and e != "D" for s, e in zip(symbols, edits)):
            continue
        cost = sum({"K": 0, "R": 3, "D": 4}[e] + 3 * (s.isupper() and s != "X" and e != "D") for s, e in zip(symbols, edits))
        for inserts in itertools.product(range(most_inserts), repeat=len(symbols) + 1):
            if sum(inserts) > most_inserts:
                continue
            audit = "I" * inserts[0] + "".join(e + "I" * n for e, n in zip(edits, inserts[1:]))
            kept = [s.lower() if e == "K" else "?" for s, e in zip(symbols, edits) if e != "D"]
            out, at = [], 0
            for letter in audit:
                if letter != "D":
                    out.append("?" if letter == "I" else kept[at])
                    at += letter != "I"
            for roles in itertools.product(*["ua" if o == "?" else o for o in out]):
                if GOOD.fullmatch("".join(roles)):
                    found.append((cost + 3 * sum(inserts), audit))
    return min(found)


def test_matrices_give_the_cheapest_edits():
    rng = random.Random(3)
    some = ["", "X", "s", "S", "uu", "aa", "sua", "oUa", "aXu", "sS", "usa"] + ["".join(rng.choices(dialogue.SYMBOLS, k=4)) for _ in range(60)]
    for symbols, whole in zip(some, dialogue.Rules().solved(some)):
        assert dialogue.best(whole) == enumerated(symbols), symbols


def plain_best(symbols):
    """Dijkstra's table over rows, with whole audits."""
    moves = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    def widened(ways):
        for _ in range(3):
            for i, (cost, audit) in list(ways.items()):
                for kind in "ua":
                    if i in moves[kind]:
                        j = moves[kind][i]
                        ways[j] = min(ways.get(j, (10**9, "")), (cost + 3, audit + "I"))
        return ways

    ways = widened({0: (0, "")})
    for s in symbols:
        new = {}
        for i, (cost, audit) in ways.items():
            steps = [(i, 4, "D")]
            if s != "X":
                more = 3 * s.isupper()
                steps += [(moves[s.lower()][i], more, "K")] if i in moves.get(s.lower(), {}) else []
                steps += [(moves[k][i], 3 + more, "R") for k in "ua" if i in moves[k]]
            for j, more, letter in steps:
                new[j] = min(new.get(j, (10**9, "")), (cost + more, audit + letter))
        ways = widened(new)
    return min(ways[i] for i in (0, 3) if i in ways)


def test_long_sequences_and_their_pieces_agree():
    rng = random.Random(5)
    base = ["".join(rng.choices("sua", k=7)) for _ in range(5)]
    some = ["".join(rng.choices(base + ["X", "uaua", "oU", "uuuuuuu"], k=rng.randint(1, 150))) for _ in range(40)]
    rules = dialogue.Rules()
    for symbols, whole in zip(some, rules.solved(some)):
        cost, audit = plain_best(symbols)
        assert dialogue.best(whole) == (cost, audit)
        cut = len(symbols) // 3
        left, right = rules.solved([symbols[:cut], symbols[cut:]])
        assert dialogue.best(dialogue.product(left, right)) == (cost, audit)


def test_rules_stand_for_their_sequences_and_are_evaluated_once():
    sequences = [np.array(s) for s in ([1, 2, 3] * 30, [1, 1, 1, 1, 1], [], [4], [2, 2, 2, 2, 2, 2, 1, 2, 3])]
    rules, written = dialogue.grammar(sequences, least=2)

    def spelled(symbol):
        if symbol < len(dialogue.SYMBOLS):
            return [symbol]
        return [s for part in rules[symbol - len(dialogue.SYMBOLS)] for s in spelled(part)]

    assert [[s for x in w.tolist() for s in spelled(x)] for w in written] == [s.tolist() for s in sequences]
    assert rules and len(written[0]) <= 6
    shared = dialogue.Rules()
    shared.solved(["suaua" * 40, "ua" * 50])
    before = len(shared.known)
    shared.solved(["ua" * 50, "suaua" * 40])
    assert 0 < before == len(shared.known)


def plain_repair(table):
    """table: (conv, turn, role, text); one result per conversation."""
    convs, out = {}, []
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        spaced = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        role, text = ("user" if kind == 4 else spaced[2]), spaced[3]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, symbols, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for turn, role, text in rows:
            letters = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else ""
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "X" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
            if fault:
                faults[fault] += 1
        initials = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [t for t, _, _ in rows if t is not None]
        cost, audit = plain_best(symbols)
        lines, at, after = [], 0, ""
        for letter in audit:
            turn, role, text = (None, None, "") if letter == "I" else rows[at]
            at += letter != "I"
            if letter != "D":
                role = role if letter == "K" else "assistant" if after == "u" else "user"
                after = role[:1]
                lines.append(f"{role}:{text}")
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults.values(), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, table):
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    df = df.withColumns({"key": F.lit("clash"), "kind": F.lit(1), "times": F.lit(9), "a.b": F.lit(2), "audit": F.lit(3)})
    return sorted((tuple(r) for r in dialogue.repair(dialogue.damaged(df)).collect()), key=repr)


def conversations(seed, count, longest):
    rng = random.Random(seed)
    says = ["Yes.", "No!", "Why?", "and then", "", " \t", "Some text.\n", "É. 春天", "end;"]
    for conv in range(count):
        for turn in range(rng.randint(1, longest)):
            if rng.random() < 0.9:
                role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "USER"])
                yield conv, turn * rng.choice([1, 1, 2]), role, rng.choice(says) + rng.choice(["", f" {turn}."])


ODD = [(900, None, None, None), (900, None, "user", "Null turn."), (900, 3, None, "x."), (None, 1, "user", "Null conversation."),
       (None, None, "assistant", "Both."), (901, 0, "user", "word " * 40_000 + "."), (901, 1, "assistant", "word " * 40_000),
       *[(902, 5, "user", "Same.")] * 50, *[(903, t, "user", "Same at all turns.") for t in range(200)], (-904, 7, "system", "Alone.")]


def test_equals_the_plain_version(spark):
    table = [*conversations(1, 120, 12), *ODD]
    random.Random(2).shuffle(table)
    assert found(spark, table) == plain_repair(table)


@pytest.mark.parametrize("share", [1e-4, 0.9])
def test_a_conversation_with_most_rows_is_cut_into_pieces(spark, monkeypatch, share):
    monkeypatch.setattr(common, "HOT_KEYS", share)
    monkeypatch.setattr(dialogue, "PIECE", 50)
    rng = random.Random(7)
    table = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "Text", "", f"No {t}.", f"Why {t}?"])) for t in range(1500)]
    table += conversations(4, 60, 9)
    parts = dialogue.plans(dialogue.damaged(spark.createDataFrame(table, "conv_id long, turn long, role string, text string")))
    assert "rangepartitioning" in parts._jdf.queryExecution().executedPlan().toString()
    assert found(spark, table) == plain_repair(table)


def test_query_equals_the_plain_version(spark, sf_dir):
    from plumbline.llm.queries import QUERIES

    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_conversations"](spark, sf_dir).collect()), key=repr)
    assert got == plain_repair(table) and any(r[6] for r in got)


def test_repaired_rows_and_an_undamaged_table(spark):
    table = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (2, 0, "system", "Be kind."), (2, 1, "user", "Why?"), (2, 2, "tool", "So.")]
    rows = dialogue.as_rows(spark.createDataFrame(table, "conv_id long, turn long, role string, text string"))
    out = [tuple(r) for r in dialogue.repaired_rows(rows, common.store(dialogue.plans(rows), "plans")).orderBy("key", "position").collect()]
    assert out == [(":1", 0, "insert", "user", ""), (":1", 1, "keep", "assistant", "Hello."), (":1", 2, "keep", "user", "Hi."),
                   (":1", 3, "insert", "assistant", ""), (":2", 0, "keep", "system", "Be kind."), (":2", 1, "keep", "user", "Why?"),
                   (":2", 2, "rerole", "assistant", "So.")]


def test_dropped_conversations_stay_and_an_empty_table_has_no_rows(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(gone, 0, "user", "Gone.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]
    assert found(spark, []) == []
