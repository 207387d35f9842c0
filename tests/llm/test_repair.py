import hashlib
import random
import zlib

from citygrain.llm import repair as r


def brute(initials, faults):
    """All states row by row, with the least (cost, audit) of each."""
    due = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put(states, state, cost, audit):
        if state not in states or (cost, audit) < states[state]:
            states[state] = (cost, audit)

    def widen(states):
        for _ in range(4):
            for q, (c, a) in list(states.items()):
                put(states, due[q], c + 2, a + "I")
        return states

    states = widen({"": (0, "")})
    for k, f in zip(initials, faults):
        then: dict = {}
        for q, (c, a) in states.items():
            put(then, q, c + 3, a + "D")
            if f in (r.BLANK, r.DUPLICATE):
                continue
            extra = f == r.TRUNCATED
            if k == due[q] or k == "s" and q == "":
                put(then, k, c + extra, a + "K")
            put(then, due[q], c + extra + 2, a + "R")
        states = widen(then)
    return min(states[q] for q in ("", "a") if q in states)


def test_search_from_both_ends_against_all_states():
    random.seed(5)
    for _ in range(4000):
        n = random.randint(0, 9)
        initials = [random.choice(["s", "s", "u", "u", "a", "a", "x", ""]) for _ in range(n)]
        faults = [random.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        assert r.Lattice(initials, faults).cheapest() == brute(initials, faults), (initials, faults)


def test_long_conversations():
    random.seed(6)
    n = 5000
    initials, faults = [random.choice("suuaaax") for _ in range(n)], [random.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n)]
    assert r.Lattice(initials, faults).cheapest() == brute(initials, faults)
    assert r.Lattice(["u", "a"] * n, [0] * 2 * n).cheapest() == (0, "K" * 2 * n)


def expected(rows):
    """What the contract says, row by row: rows are (conv, turn, role, text)."""
    space = "\x20\x09\x0a\x0b\x0c\x0d"
    out = {}
    for conv in dict.fromkeys(x[0] for x in rows):
        held = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            role, text, d = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
            if d == 0:
                continue
            text = "" if d == 1 else "".join(x for x in text if x not in ".!?") if d == 2 else text
            held += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
        held.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in held:
            bare = text.rstrip(space)
            faults.append(
                r.BLANK if not bare else r.DUPLICATE if (role, text) in seen else r.TRUNCATED if bare[-1] not in ".!?" else r.FINE
            )
            seen.add((role, text))
        initials = [x[1][:1] for x in held]
        known = [x[0] for x in held if x[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = brute(initials, faults)
        lines, i, state = [], 0, ""
        for e in audit:
            due = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            if e != "D":
                role = held[i][1] if e == "K" else due
                lines.append(f"{role}:{'' if e == 'I' else held[i][2]}")
                state = role[0]
            i += e != "I"
        counts = [faults.count(f) for f in (r.BLANK, r.DUPLICATE, r.TRUNCATED)]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_report_against_the_contract(spark):
    random.seed(7)
    roles = ["user", "assistant", "system", "tool", "", "User", None]
    texts = ["Yes.", "No", "", " \t", "Why?\n", "é . ", None, "a.b", "Yes."]
    rows = [
        (conv, random.choice([None, t, t, t, t // 2]), random.choice(roles[:3] * 3 + roles), random.choice(texts))
        for conv in [*range(300), None]
        for t in range(random.randint(1, 9))
    ]
    rows += rows[:20] + [(900, 1 << 40, "user", "x" * 300000 + "."), (901, None, None, None)]
    table = spark.createDataFrame([(*x, "kept") for x in rows], "conv_id long, turn long, role string, text string, cost string")
    got = {x.conv_id: tuple(x[n] for n in NAMES) for x in r.repair_report(r.damage(table), table).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    assert all(got[k] == want[k] for k in want), [(k, got[k], want[k]) for k in want if got[k] != want[k]][:3]


def test_one_large_conversation_beside_small_ones(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"{t % 700}.") for t in range(6000)]
    rows += [(c, t, "user" if t % 2 else "assistant", "Ja!") for c in range(2, 60) for t in range(4)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x.conv_id: tuple(x[n] for n in NAMES) for x in r.repair_report(r.damage(table), table).collect()}
    assert got == expected(rows)


def test_repaired_rows_are_in_order(spark):
    rows = [(5, 0, "assistant", "Hi."), (5, 1, "assistant", "Again."), (5, 2, "user", "Well"), (6, 0, "system", "S.")]
    table = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    found = r.audits(table)
    left = [(x.conv_id, x.edit, x.role, x.text) for x in r.repaired(table, found).orderBy("conv_id").collect()]
    assert [x for x in left if x[0] == 5] == [(5, "R", "user", "Hi."), (5, "K", "assistant", "Again.")]
    assert {x.conv_id: (x.cost, x.audit) for x in found.collect()}[5] == (5, "RKD")
    assert {x.conv_id: (x.cost, x.audit) for x in found.collect()}[6] == brute(["s"], [0])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert r.repair_report(r.damage(none), none).collect() == []
    ids = spark.createDataFrame([(4,), (4,)], "conv_id long")
    assert [tuple(x) for x in r.repair_report(none, ids).collect()] == [(4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
