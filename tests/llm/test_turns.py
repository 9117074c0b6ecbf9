"""Repair of conversations against plain versions: all edits of short ones, whole edit texts of long ones."""

import hashlib
import itertools
import random
import re
import zlib

from lectern.llm import queries, turns

SPACE = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?").fullmatch


def faults(rows):
    """(role, text, fault) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def by_all_edits(rows):
    """The best of all edits, each tried; for a few rows alone."""
    best = None
    runs = [x for n in range(4) for x in itertools.product("ua", repeat=n)]
    for gaps in itertools.product(runs, repeat=len(rows) + 1):
        if sum(map(len, gaps)) > 4:
            continue
        for edits in itertools.product(["D", "K", "Ru", "Ra"], repeat=len(rows)):
            cost, audit, roles = 0, "", ""
            for gap, edit, (role, _, fault) in zip(gaps, [*edits, None], [*rows, (None, None, None)], strict=True):
                cost, audit, roles = cost + 3 * len(gap), audit + "I" * len(gap), roles + "".join(gap)
                if edit is None:
                    continue
                if edit != "D" and fault in ("blank", "duplicate"):
                    break
                cost += {"D": 4, "K": 0}.get(edit, 3) + 3 * (edit != "D" and fault == "truncated")
                audit += edit[0]
                roles += "" if edit == "D" else role[:1] or "?" if edit == "K" else edit[1]
            else:
                if LEGAL(roles):
                    best = min(best or (cost, audit), (cost, audit))
    return best


def by_texts(rows):
    """(cost, audit, repaired): the cheapest and then least edit text for each state, texts and all."""
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(states):
        for _ in range(5):
            for st, (c, t, out) in list(states.items()):
                for r, name in (("u", "user"), ("a", "assistant")):
                    if (st, r) in go:
                        new = (c + 3, t + "I", out + ((name, ""),))
                        if go[st, r] not in states or new[:2] < states[go[st, r]][:2]:
                            states[go[st, r]] = new
        return states

    states = {"": (0, "", ())}
    for role, text, fault in rows:
        new = {}

        def offer(st, c, t, out):
            if st not in new or (c, t) < new[st][:2]:
                new[st] = (c, t, out)

        # Every state is left by each number of inserts, as a shorter text may lose to a longer one.
        front, every = dict(states), []
        for _ in range(4):
            every += list(front.items())
            nxt = {}
            for st, (c, t, out) in front.items():
                for r, name in (("u", "user"), ("a", "assistant")):
                    if (st, r) in go and (go[st, r] not in nxt or (c + 3, t + "I") < nxt[go[st, r]][:2]):
                        nxt[go[st, r]] = (c + 3, t + "I", out + ((name, ""),))
            front = nxt
        for st, (c, t, out) in every:
            offer(st, c + 4, t + "D", out)
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if (st, role[:1]) in go:
                    offer(go[st, role[:1]], c + more, t + "K", (*out, (role, text)))
                for r, name in (("u", "user"), ("a", "assistant")):
                    if (st, r) in go:
                        offer(go[st, r], c + 3 + more, t + "R", (*out, (name, text)))
        states = new
    ends = inserted(states)
    return min(ends[s] for s in ("", "a") if s in ends)


def plain_report(rows):
    """The report of one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    marked = faults([r[1:] for r in rows])
    numbers = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    cost, audit, repaired = by_texts(marked) if rows else (0, "", ())
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *[sum(m[2] == k for m in marked) for k in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
    )


def plain_damage(rows):
    """{conv_id: rows} after the damage that the contract names."""
    out = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        held = out.setdefault(conv, [])
        if fault:
            held += [(turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)] * (2 if fault == 3 else 1)
    return out


def test_edits_against_all_edits():
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("Done.", "cut", "")]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            marked = faults([(r, t and f"{i} {t}") for i, (r, t) in enumerate(rows)])
            assert by_texts(marked)[:2] == by_all_edits(marked), rows


def test_layers_tables_and_fragments():
    rng = random.Random(12)
    for _ in range(400):
        rows = faults([(rng.choice(["system", "user", "assistant", "assistant", "user", "tool", ""]), rng.choice(["A b.", "cut off", " ", "Same.", f"Own {rng.random()}!"])) for _ in range(rng.randrange(14))])
        codes = bytes(8 if f in ("blank", "duplicate") else turns.INITIALS.get(r[:1], 3) + 4 * (f == "truncated") for r, _, f in rows)
        cuts = [0, *sorted(rng.randrange(len(rows) + 1) for _ in range(rng.randrange(4))), len(rows)]
        spans = list(zip(cuts, cuts[1:], strict=False))
        cost, path = turns.chained([turns.table_of(codes[a:z]) for a, z in spans])
        audit, repaired = "", []
        for i, ((a, z), (entry, leave)) in enumerate(zip(spans, path, strict=True)):
            some, text = turns.applied([r[:2] for r in rows[a:z]], turns.edits_of(codes[a:z], entry, leave), entry, i == len(spans) - 1)
            audit, repaired = audit + text, repaired + some
        assert (cost, audit, tuple(repaired)) == by_texts(rows)
        assert LEGAL("".join(r[:1] for r, _ in repaired))


def odd_rows():
    rng = random.Random(3)
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (7, None, "user", "A."), (7, None, "assistant", None), (7, 2, "tool", "x!"), (7, 2, "tool", "x!"), (8, -5, "system", "S."), (8, 9_000_000_000, "assistant", " \t")]
    rows += [(9, t, ("user", "assistant")[t % 2], f"turn {rng.randrange(40)}{rng.choice('.!?,')}" + " w" * rng.randrange(90)) for t in range(400)]
    rows += [(10, 5, "user", "the same text at one turn" + "." * (i % 3)) for i in range(60)] + [(11, t, "user", "again and again.") for t in range(90)] + [(12 + i // 4, i % 4, "user", f"u{i}?") for i in range(40)]
    return rows


def test_fragments_of_any_size(spark):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, block string, conv int").repartition(5)
    want = {k: plain_report(v) for k, v in plain_damage(rows).items()}
    for block in (4096, 3):
        got = {r[0]: tuple(r)[1:] for r in turns.repair_conversations(turns.damaged(frame), block).collect()}
        assert got == want
    assert {r[0]: tuple(r)[1:] for r in turns.repair_conversations(turns.damaged(frame), 4096, 60).collect()} == want
    made = turns.repaired_turns(turns.damaged(frame), 3, 50).orderBy("part", "block", "position").collect()
    for k in want:
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in made if r["conv_id"] == k).encode()).hexdigest() == want[k][-1]
    assert turns.repair_conversations(turns.damaged(frame.limit(0))).count() == 0
    undamaged = {k: plain_report([r[1:] for r in rows if r[0] == k]) for k in (8, 9)}
    got = {r[0]: tuple(r)[1:] for r in turns.repair_conversations(frame.filter("conv_id in (8, 9)").drop("block", "conv")).collect()}
    assert got == undamaged


def test_query(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in queries.op12_turn_repair(spark, d).collect()}
    assert got == {k: plain_report(v) for k, v in plain_damage(rows).items()}
