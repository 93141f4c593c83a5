"""Conversation repair against a plain search, on all paths."""

import hashlib
import random
import re
import zlib
from itertools import product as every

import pytest

from rigcast.llm import chat_repair as cr

SF = "/root/testdata/sf0.001"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def search(symbols):
    """Least (cost, audit) by suffixes: from the last row back, the least audit is known for every state."""
    best = {s: (0, "") if s in ("", "a") else None for s in ("", "s", "u", "a")}

    def inserts(best):
        for _ in range(4):
            for (s, r), t in NEXT.items():
                if r != "s" and best[t] is not None:
                    way = (best[t][0] + 2, "I" + best[t][1])
                    best[s] = way if best[s] is None else min(best[s], way)
        return best
    best = inserts(best)
    for c in reversed(symbols):
        new = {}
        for s in best:
            ways = [(best[s][0] + 3, "D" + best[s][1])]
            if c != "X":
                for r in "sua":
                    t = NEXT.get((s, r))
                    if t is not None and (r == c.lower() or r != "s"):
                        kept = r == c.lower()
                        ways.append((best[t][0] + (0 if kept else 2) + c.isupper(), ("K" if kept else "R") + best[t][1]))
            new[s] = min(ways)
        best = inserts(new)
    return best[""]


def brute(rows):
    """The whole query in plain Python."""
    convs = {c: [] for c, *_ in rows}
    for c, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[c] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, signs, count = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, role, text in turns:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            sign = role[:1] if role[:1] in list("sua") else "o"
            signs += "X" if fault in ("b", "d") and fault else sign.upper() if fault else sign
            if fault:
                count[fault] += 1
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        numbers = {t[0] for t in turns if t[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = search(signs)
        lines, at, state = [], 0, ""
        for e in audit:
            if e == "I":
                lines.append("assistant:" if state == "u" else "user:")
            else:
                _, role, text = turns[at]
                at += 1
                if e == "D":
                    continue
                lines.append(f"{role if e == 'K' else 'assistant' if state == 'u' else 'user'}:{text}")
            state = lines[-1][0]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines)) and at == len(turns)
        out.append((c, gaps, count["b"], count["d"], count["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def ask(df):
    return sorted((tuple(r) for r in cr.repair(df).collect()), key=str)


def test_search_agrees_with_full_enumeration():
    """All edit strings of short conversations, spelled out."""
    def results(symbols):
        ways, todo = [], [("", 0, 0, "")]
        while todo:
            audit, at, cost, roles = todo.pop()
            if cost > 3 * len(symbols) + 4 or len(audit) > len(symbols) + 3:
                continue
            if at == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
                ways.append((cost, audit))
            todo += [(audit + "I", at, cost + 2, roles + r) for r in "ua"]
            if at < len(symbols):
                c = symbols[at]
                todo.append((audit + "D", at + 1, cost + 3, roles))
                if c != "X":
                    todo.append((audit + "K", at + 1, cost + c.isupper(), roles + c.lower()))
                    todo += [(audit + "R", at + 1, cost + 2 + c.isupper(), roles + r) for r in "ua"]
        return min(ways)
    for n in range(4):
        for symbols in every("suaoUX", repeat=n):
            assert search("".join(symbols)) == results("".join(symbols)), symbols


@pytest.mark.parametrize("rules", [[], ["ua", "uu", "Ā" + "Ā", "aX", "ā" + "u"]])
def test_matrices_agree_with_the_search(rules):
    rng, grammar = random.Random(len(rules)), cr.Grammar(rules)
    strings = ["".join(s) for n in range(5) for s in every("suaoX", repeat=n)]
    strings += ["".join(rng.choices("suaoSUAOX", k=rng.randint(5, 40))) for _ in range(400)]
    strings += ["".join(rng.choices("uaUAs", weights=(8, 8, 2, 2, 1), k=rng.randint(5, 200))) for _ in range(100)]
    strings += ["u" * 50, "a" * 51, "s" * 30, "uus" * 20, "ua" * 60 + "u"]
    for s in strings:
        assert grammar.solve(grammar.shrink(s)) == search(s), s


def test_chain_keeps_what_can_still_win():
    def rope(s):
        out = cr.Rope()
        for c in s:
            out = out + cr.Rope(c)
        return out
    rng = random.Random(3)
    for _ in range(300):
        texts = ["".join(rng.choices("DIK", k=rng.randint(0, 5))) for _ in range(4)]
        left = [str(r) for r in cr.chain([rope(t) for t in texts])]
        assert all(b.startswith(a) for a, b in zip(left, left[1:]))
        for tail in ["", "D", "I", "K", "IK", "KD"]:
            assert min(t + tail for t in texts) == min(t + tail for t in left)


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", None, "us"]
TEXTS = ["Yes.", "No!", "Why?  \n", "cut off", "", " \t", None, "é ü", "Ende.\n\n", "same.", "same."]
COLUMNS = "conv_id long, turn long, role string, text string, n long, symbols string, audit string, seen boolean"


def odd_rows(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, 12)):
            rows.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice(ROLES), rng.choice(TEXTS)))
    rows += [(None, t, "user", f"x{t}.") for t in range(4)] + [(None, None, None, None)] + rows[:10]
    return rows + [(900 + c, 3, "user", "Hi.") for c in range(60)]          # some lose their only row


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", "a", True) for r in rows], COLUMNS)


def test_odd_conversations(spark):
    rows = odd_rows(1)
    got = ask(frame(spark, rows))
    assert got == brute(rows)
    assert any(r[7] == "" and r[6] == 0 for r in got)
    assert ask(frame(spark, rows).limit(0)) == []


def test_long_conversations_take_the_ordered_path(spark, monkeypatch):
    monkeypatch.setattr(cr, "PIECE", 5)
    rows = odd_rows(2)
    rng = random.Random(7)
    rows += [(500, t, rng.choice(ROLES[:5]), f"{rng.choice(TEXTS[:4])}{t % 90}") for t in range(700)]
    rows += [(501, t // 3, "user", "again.") for t in range(60)]
    assert ask(frame(spark, rows)) == brute(rows)
    monkeypatch.setattr(cr, "PIECE", 4096)
    monkeypatch.setattr(cr, "LONG", 40)
    assert ask(frame(spark, rows)) == brute(rows)


def test_the_table(spark):
    got = [tuple(r) for r in cr.op11_chat_repair(spark, SF).collect()]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(got, key=str) == brute(rows)


def test_grammar_is_re_pair(spark):
    strings = spark.createDataFrame([("uauauaua", 10), ("suauaX", 3), ("uu", 1)], "symbols string, n long")
    rules = cr.fit_grammar(strings)
    assert rules[0] == "ua" and len(rules) >= 3
    grammar = cr.Grammar(rules)

    def expand(s):
        for i in range(len(rules) - 1, -1, -1):
            s = s.replace(chr(256 + i), rules[i])
        return s
    assert all(expand(grammar.shrink(s)) == s for s in ("uauauaua", "suauaX", "uu", ""))
    assert len(grammar.shrink("uauauaua")) == 1
    assert cr.next_rules([("ab", 9), ("bc", 8), ("cd", 7), ("xx", 1)], 9, 1) == ["ab", "cd"]
