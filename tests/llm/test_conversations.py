"""Conversation repair against exhaustive search and against whole-string search from the end."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

pytest.importorskip("loomframe.llm")
from loomframe.llm import conversations as cv  # noqa: E402

SPACE = " \t\n\x0b\x0c\r"


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def exhaustive(turns):
    """The cheapest, then least audit over all edits with up to two inserts in each gap."""
    found, best = faults(turns), None
    for ops in itertools.product("KRD", repeat=len(turns)):
        if any(op != "D" and f in ("blank", "duplicate") for op, f in zip(ops, found)):
            continue
        for gaps in itertools.product(range(3), repeat=len(turns) + 1):
            audit = "".join("I" * g + op for g, op in zip(gaps, [*ops, ""]))
            cost = 5 * sum(gaps) + sum({"K": 0, "R": 1, "D": 2}[op] + 5 * (op != "D" and f == "truncated") for op, f in zip(ops, found))
            slots = [s for g, op, t in zip(gaps, [*ops, "D"], [*turns, ("", "")]) for s in ["ua"] * g + ([] if op == "D" else [t[0][:1] or "-"] if op == "K" else ["ua"])]
            if re.fullmatch("(s?(ua)+)?", shape(slots)):
                best = min(best or (cost, audit), (cost, audit))
    return best


def shape(slots):
    """The only roles that free slots may have: user and assistant in turn behind what is before them."""
    out = ""
    for s in slots:
        out += s if len(s) == 1 else "a" if out.endswith("u") else "u"
    return out


def backward(turns):
    """The same by search over whole strings from the end; also the repaired roles and texts."""
    found = faults(turns)

    @lru_cache(None)
    def rest(i, state, room):
        options = [(0, "", ())] if i == len(turns) and state in ("", "a") else []
        after = "a" if state == "u" else "u"
        if room:
            c, a, t = rest(i, after, room - 1)
            options.append((5 + c, "I" + a, ((("user" if after == "u" else "assistant"), ""), *t)))
        if i < len(turns):
            (role, text), f = turns[i], found[i]
            c, a, t = rest(i + 1, state, 2)
            options.append((2 + c, "D" + a, t))
            if f not in ("blank", "duplicate"):
                more = 5 * (f == "truncated")
                c, a, t = rest(i + 1, after, 2)
                options.append((1 + more + c, "R" + a, ((("user" if after == "u" else "assistant"), text), *t)))
                if role[:1] == after:
                    options.append((more + c, "K" + a, ((role, text), *t)))
                if role[:1] == "s" and not state:
                    c, a, t = rest(i + 1, "s", 2)
                    options.append((more + c, "K" + a, ((role, text), *t)))
        return min(options, default=(10**9, "~", ()))

    return rest(0, "", 2)


def some(rng, n, roles=("user", "assistant", "system", "tool", "", " ")):
    return [(rng.choice(roles[: rng.choice((2, 3, 6))]), rng.choice(["Ja.", "No", "ok!", "what? ", "", " \n", f"x{rng.random()}.", f"y{rng.random()}"])) for _ in range(n)]


def found(turns):
    items = [cv.TURN_WAYS[r[:1] if r[:1] in ("s", "u", "a") else "", cv.FAULTS.index(f)] for (r, _), f in zip(turns, faults(turns))]
    report = cv.Report()
    for (role, text), f, (frm, to, symbol) in zip(turns, faults(turns), cv.chosen(items, cv.START, None)):
        report.add(None, role, text, cv.FAULTS.index(f), frm, to, cv.SYMBOLS[symbol])
    return report.closed()


def test_against_exhaustive_search():
    rng = random.Random(4)
    for _ in range(150):
        turns = some(rng, rng.randint(0, 4))
        want = exhaustive(turns)
        assert backward(turns)[:2] == want
        assert found(turns)[5:7] == want


def test_against_search_from_the_end():
    rng = random.Random(5)
    for _ in range(150):
        turns = some(rng, rng.randint(5, 60))
        cost, audit, kept = backward(turns)
        got = found(turns)
        assert got[5:7] == (cost, audit)
        assert got[7] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in kept))


def test_blocks_give_the_ways_of_the_whole():
    rng = random.Random(6)
    for _ in range(40):
        turns = some(rng, 40)
        items = [cv.TURN_WAYS[r[:1] if r[:1] in ("s", "u", "a") else "", cv.FAULTS.index(f)] for (r, _), f in zip(turns, faults(turns))]
        blocks = [items[i : i + 7] for i in range(0, 40, 7)]
        summed = [cv.summary(b) for b in blocks]
        picks = cv.chosen(summed, cv.START, None)
        assert [w for b, (frm, to, _) in zip(blocks, picks) for w in cv.chosen(b, frm, to)] == cv.chosen(items, cv.START, None)


def test_clashing_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(cv, "_MOD", 3)
    rng = random.Random(7)
    for _ in range(60):
        turns = some(rng, rng.randint(5, 40))
        assert found(turns)[5:7] == backward(turns)[:2]


def conversations(seed=8):
    rng = random.Random(seed)
    rows = []
    for c in range(60):
        for turn, (role, text) in enumerate(some(rng, rng.choice((1, 2, 4, 8, 30)))):
            rows.append((rng.choice((c, c, c, None)) if c < 5 else c, rng.choice((turn, turn, turn, turn + 1, None)), role if role else None, text if text else None))
    return rows + rows[:7]


def brute(rows):
    groups = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        groups.setdefault(conv, []).extend([(turn is not None, turn or 0, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1))
    out = []
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        pairs = [t[2:] for t in turns]
        known = [t[1] for t in turns if t[0]]
        f = faults(pairs)
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, kept = backward(tuple(pairs))
        out.append((str(conv), gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("long_", [False, True])
def test_damaged_conversations(spark, tmp_path, long_, monkeypatch):
    if long_:  # conversations in blocks of blocks, keys beyond the broadcast bound
        for name, value in (("LONG_TURNS", 3), ("LONG_BYTES", 60), ("BLOCK", 3), ("FAN", 2), ("BROADCAST_ROWS", 2)):
            monkeypatch.setattr(cv, name, value)
    rows = conversations()
    path = str(tmp_path)
    spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, audit int").repartition(3).write.parquet(f"{path}/conversations.parquet")
    got = cv.op11_conversation_repair(spark, path).collect()
    assert sorted((str(r.conv_id), *r[1:]) for r in got) == brute(rows)


def test_repaired_turns(spark, monkeypatch):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Well?"), (1, 2, "tool", ""), (2, 0, "system", "Be kind."), (2, 1, "user", "Yes."), (3, None, None, None)] + [(4, t, "ua"[t % 2], f"Turn {t}.") for t in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    want = [(1, 0, 0, "user", "Hi.", "K"), (1, 1, 0, "assistant", "Well?", "R"), (1, 2, 0, "tool", "", "D"), (2, 0, 0, "user", "Be kind.", "R"), (2, 1, 0, "assistant", "Yes.", "R"), (3, 0, 0, " ", " ", "D")]
    want += [(4, t, 0, "ua"[t % 2], f"Turn {t}.", "K") for t in range(20)]
    for limit in (4096, 5):
        monkeypatch.setattr(cv, "LONG_TURNS", limit)
        monkeypatch.setattr(cv, "BLOCK", 6)
        got = [(r.conv_id, r.place, r.step, r.role, r.text, r.edit) for r in cv.repair_conversations(df).collect()]
        assert sorted(got) == want


def test_empty_table(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    assert cv.op11_conversation_repair(spark, path).collect() == []
