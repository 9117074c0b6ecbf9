"""Repair of conversations whose turns are missing, repeated, blank, cut off or under the wrong role.

A repaired conversation's role initials read (s?(ua)+)?. Edits are those of least cost, and of
equal ones those whose initials come first. A layer stands after each turn: for each of four
states the least cost of coming there and, in place of the edits so far, their rank among the layer's
states. One step is a macro edit, up to two inserts and then the turn kept, re-roled or deleted;
the macros' texts are prefix-free, so two histories compare by the ranks they start from and then
by their macros. Parent pointers lead back, and the texts of the edits are made afterwards.

Rows are put in order by ranges, so a conversation of any length is cut into fragments. What a
fragment does from each state that it may be entered in is a table of four by four; the tables
of a conversation chain to the states between its fragments, and each fragment is then repaired by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import ASCII_SPACE, hash_pair, materialise

START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER, CUT, MUST_GO = 3, 4, 8
COST = {"I": 3, "D": 4, "K": 0, "R": 3}
CUT_COST = 3
#: The macro edits in order of their texts, none of which begins another. A third insert would only go round again.
MACROS = sorted("I" * n + last for n in range(3) for last in "DKR")
AFTER_INSERT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAME = {USER: "user", ASSISTANT: "assistant"}
#: What ends a conversation in each state.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
HEAD = 64


def stepped(state: int, macro: str, code: int) -> tuple[int, int] | None:
    """(state, cost) after a macro edit of a turn with this code, or None where it isn't allowed."""
    cost = sum(COST[x] for x in macro)
    for _ in range(len(macro) - 1):
        state = AFTER_INSERT[state]
    last, role = macro[-1], code % 4
    if last == "D":
        return state, cost
    if code >= MUST_GO:
        return None
    cost += CUT_COST * (code >= CUT)
    if last == "R":
        return (ASSISTANT if state == USER else USER), cost
    if role == 0:
        return (SYSTEM, cost) if state == START else None
    if role == 1:
        return (USER, cost) if state != USER else None
    return (ASSISTANT, cost) if role == 2 and state == USER else None


@cache
def layer_after(layer: tuple, code: int) -> tuple[tuple, int, tuple]:
    """The layer after a turn, what the least cost grew by, and for each state (parent, macro). A layer is
    four pairs (cost above the least, rank), None for states that can't be. Few layers exist."""
    best: list[tuple | None] = [None] * 4
    for parent, held in enumerate(layer):
        if held is not None:
            for m, macro in enumerate(MACROS):
                if (to := stepped(parent, macro, code)) is not None:
                    key = (held[0] + to[1], held[1], m, parent)
                    if best[to[0]] is None or key < best[to[0]]:
                        best[to[0]] = key
    least = min(b[0] for b in best if b)
    order = {x: r for r, x in enumerate(sorted((x for x in range(4) if best[x]), key=lambda x: best[x][1:3]))}
    return tuple(b and (b[0] - least, order[x]) for x, b in enumerate(best)), least, tuple(b and (b[3], b[2]) for b in best)


def entered(state: int) -> tuple:
    return tuple((0, 0) if x == state else None for x in range(4))


def table_of(codes: bytes) -> tuple[list[int], list[int]]:
    """For each entry and exit the least cost and its rank among the exits of that entry; -1 where there is none."""
    costs, ranks = [], []
    for e in range(4):
        layer, spent = entered(e), 0
        for code in codes:
            layer, more, _ = layer_after(layer, code)
            spent += more
        costs += [-1 if x is None else spent + x[0] for x in layer]
        ranks += [-1 if x is None else x[1] for x in layer]
    return costs, ranks


def chained(tables: list[tuple[list[int], list[int]]]) -> tuple[int, list[tuple[int, int]]]:
    """The least cost over all fragments of a conversation, and each fragment's entry and exit."""
    layer: list[tuple | None] = [(0, 0), None, None, None]
    back = []
    for costs, ranks in tables:
        best = [min(((h[0] + costs[4 * e + x], h[1], e) for e, h in enumerate(layer) if h is not None and costs[4 * e + x] >= 0), default=None) for x in range(4)]
        order = {x: r for r, x in enumerate(sorted((x for x in range(4) if best[x]), key=lambda x: (best[x][1], ranks[4 * best[x][2] + x])))}
        layer = [b and (b[0], order[x]) for x, b in enumerate(best)]
        back.append([b and b[2] for b in best])
    cost, _, state = min((h[0] + 3 * len(ENDING[x]), h[1], x) for x, h in enumerate(layer) if h is not None)
    path = []
    for parents in reversed(back):
        path.append((parents[state], state))
        state = parents[state]
    return cost, path[::-1]


def edits_of(codes: bytes, entry: int, leave: int) -> list[str]:
    """The macro edits of least cost, then least text, from one state to another."""
    layer, back = entered(entry), []
    for code in codes:
        layer, _, parents = layer_after(layer, code)
        back.append(parents)
    found, state = [], leave
    for parents in reversed(back):
        state, macro = parents[state]
        found.append(MACROS[macro])
    return found[::-1]


def applied(turns: list[tuple[str, str]], edits: list[str], state: int, last: bool) -> tuple[list[tuple[str, str]], str]:
    """The repaired turns and the edits' initials; the last fragment gets what ends the conversation."""
    out = []

    def insert():
        nonlocal state
        state = AFTER_INSERT[state]
        out.append((NAME[state], ""))

    for (role, text), macro in zip(turns, edits, strict=True):
        for _ in macro[:-1]:
            insert()
        if macro[-1] == "R":
            state = ASSISTANT if state == USER else USER
            out.append((NAME[state], text))
        elif macro[-1] == "K":
            state = (SYSTEM, USER, ASSISTANT)[INITIALS[role[0]]]
            out.append((role, text))
    ending = ENDING[state] if last else ""
    for _ in ending:
        insert()
    return out, "".join(edits) + ending


def last_word(c: Column) -> Column:
    """The last character that isn't white space; empty if there is none."""
    return F.right(F.rtrim(c, F.lit(ASCII_SPACE)), F.lit(1))


_COUNTS = ["n", "blank", "duplicate", "truncated", "illegal", "distinct_turns"]
_FRAGMENT = (
    "there boolean, conv long, part int, block int, whole boolean, first_turn long, last_turn long, first_initial string, last_initial string, "
    + "".join(f"{c} long, " for c in _COUNTS)
    + "cost long, audit string, repaired_sha256 string, codes binary, costs array<long>, ranks array<long>, turns array<struct<role:string,text:string>>"
)
_NAMES = [x.split()[0] for x in _FRAGMENT.split(", ")]


class Fragment:
    """Turns of one conversation in order, up to a bounded number and size."""

    def __init__(self, key: tuple, block: int):
        self.key, self.block = key, block
        self.turns: list[tuple[str, str]] = []
        self.codes, self.size = bytearray(), 0
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first_turn = self.last_turn = None

    def add(self, role: str, text: str, code: int, repeat: bool, turn: int | None) -> None:
        c = self.counts
        c["n"] += 1
        blank = code >= MUST_GO
        c["blank"] += blank
        c["duplicate"] += repeat and not blank
        c["truncated"] += not blank and not repeat and code >= CUT
        if self.turns and self.turns[-1][0][:1] + role[:1] not in ("su", "ua", "au"):
            c["illegal"] += 1
        if turn is not None:
            c["distinct_turns"] += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.turns.append((role, text))
        self.codes.append(MUST_GO if repeat else code)
        self.size += len(text)

    def row(self, part: int, whole: bool, with_turns: bool) -> list:
        codes, cost, audit, digest, costs, ranks, turns = bytes(self.codes), None, None, None, None, None, self.turns
        if whole:
            costs, ranks = table_of(codes)
            cost, [(entry, leave)] = chained([(costs, ranks)])
            turns, audit = applied(turns, edits_of(codes, entry, leave), entry, True)
            digest = sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
            codes = costs = ranks = None
        else:
            costs, ranks = table_of(codes)
        ends = [self.turns[0][0][:1], self.turns[-1][0][:1]] if self.turns else [None, None]
        held = [{"role": r, "text": t} for r, t in turns] if with_turns or not whole else None
        return [*self.key, part, self.block, whole, self.first_turn, self.last_turn, *ends, *self.counts.values(), cost, audit, digest, codes, costs, ranks, held]


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped) with the faults that crc32("conv_id:turn") % 20 names: 0 drops a row (it
    stays, marked), 1 empties its text, 2 takes its sentence marks, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    own = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    done = own.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fault") == 0).alias("dropped"), F.explode(copies).alias("copy"))
    return done.drop("copy")


def fragments(rows: DataFrame, block_rows: int, block_chars: int, with_turns: bool) -> DataFrame:
    """The written fragments: whole conversations with their repair, others with their turns, codes and tables."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    one, two = hash_pair(F.struct("role", "text"))
    initial, last = F.left("role", F.lit(1)), last_word(F.col("text"))
    code = F.when(last == "", MUST_GO).otherwise(F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER) + F.when(last.isin(".", "!", "?"), 0).otherwise(CUT))
    plain = rows.select(
        F.col("conv_id").isNotNull().alias("there"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), F.col("turn").isNotNull().alias("numbered"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), F.when(dropped, "").otherwise(role).alias("role"), F.when(dropped, "").otherwise(text).alias("text"), dropped.alias("dropped"),
    )
    coded = plain.select("there", "conv", "numbered", "turn", "role", F.left("text", F.lit(HEAD)).alias("head"), "text", one.alias("h1"), two.alias("h2"), code.alias("code"), "dropped")
    # A turn met again under another number: its hashes go ahead of it, so that texts move once.
    light = coded.filter(~F.col("dropped") & (F.col("code") < MUST_GO)).select("there", "conv", "numbered", "turn", "role", "head", "h1", "h2")
    number = F.struct("numbered", "turn")
    firsts = light.groupBy("there", "conv", "h1", "h2").agg(F.min(number).alias("least"), F.max(number).alias("most")).filter(F.col("most") > F.col("least"))
    later = light.join(firsts, ["there", "conv", "h1", "h2"]).filter(number > F.col("least")).select(*light.columns).distinct()
    marks = later.select("there", "conv", "numbered", "turn", "role", "head", F.lit(None).cast("string").alias("text"), "h1", "h2", F.lit(0).alias("code"), F.lit(False).alias("dropped"))
    order = ["there", "conv", "numbered", "turn", "role", "head"]
    columns = coded.columns
    ordered = coded.unionByName(marks).repartitionByRange(*order).sortWithinPartitions(*order, F.col("text").asc_nulls_first())

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, done, own, first_key = TaskContext.get().partitionId(), [], None, None
        group, known, before = None, set(), None

        waiting = 0

        def close(fragment: Fragment, whole: bool):
            """Takes a fragment's row; rows leave once they are many, or their turns are long."""
            nonlocal waiting
            done.append(fragment.row(part, whole, with_turns))
            waiting += fragment.size if done[-1][-1] is not None else 0
            if len(done) >= 256 or waiting > block_chars:
                yield from flushed()

        def flushed():
            nonlocal waiting
            if done:
                out = pd.DataFrame(done, columns=_NAMES).astype({n: object for n in ("first_turn", "last_turn", "cost")})
                done.clear()
                waiting = 0
                yield out

        for f in frames:
            for there, conv, numbered, turn, role, head, text, h1, h2, code, gone in zip(*[f[c].tolist() for c in columns], strict=True):
                key = (there, conv)
                if own is None or own.key != key:
                    if own is not None:
                        # The first and the last conversation of a range may go on in another one.
                        yield from close(own, own.block == 0 and own.key != first_key)
                    else:
                        first_key = key
                    own, group, before = Fragment(key, 0), None, None
                if group != (numbered, turn, role, head):
                    group, known, before = (numbered, turn, role, head), set(), None
                if text is None:
                    known.add((h1, h2))
                elif not gone:
                    if len(own.turns) >= block_rows or own.size > block_chars:
                        yield from close(own, False)
                        own = Fragment(key, own.block + 1)
                    own.add(role, text, code, (h1, h2) in known or before == (h1, h2), turn if numbered else None)
                    before = (h1, h2)
        if own is not None:
            yield from close(own, False)
        yield from flushed()

    return materialise(ordered.mapInPandas(cut, _FRAGMENT), "turns")


def _chain(frame: pd.DataFrame) -> pd.DataFrame:
    """The fragments of one conversation, a row of a few numbers each: sums, cost, and each one's entry and exit."""
    frame = frame.sort_values(["part", "block"])
    cost, path = chained(list(zip(frame["costs"].tolist(), frame["ranks"].tolist(), strict=True)))
    rows = frame[frame["n"] > 0]
    illegal = int(frame["illegal"].sum()) + sum(a + b not in ("su", "ua", "au") for a, b in zip(rows["last_initial"].tolist()[:-1], rows["first_initial"].tolist()[1:], strict=True))
    turned = [(int(a), int(z)) for a, z in zip(frame["first_turn"], frame["last_turn"], strict=True) if pd.notna(a)]
    distinct = int(frame["distinct_turns"].sum()) - sum(a[1] == b[0] for a, b in zip(turned, turned[1:], strict=False))
    out = frame[["there", "conv", "part", "block"]].copy()
    out["entry"], out["leave"], out["last"] = [a for a, _ in path], [z for _, z in path], [False] * (len(path) - 1) + [True]
    for name in ("blank", "duplicate", "truncated"):
        out[name] = int(frame[name].sum())
    out["illegal"], out["cost"], out["gaps"] = illegal, cost, turned[-1][1] - turned[0][0] + 1 - distinct if turned else 0
    return out


_CHAIN = "there boolean, conv long, part int, block int, entry int, leave int, last boolean, blank long, duplicate long, truncated long, illegal long, cost long, gaps long"
_REPORT = ["there", "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _repaired(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        for r in f.itertuples(index=False):
            codes = bytes(r.codes)
            turns, audit = applied([(t["role"], t["text"]) for t in r.turns], edits_of(codes, r.entry, r.leave), r.entry, r.last)
            yield pd.DataFrame({"there": [r.there], "conv": [r.conv], "part": [r.part], "block": [r.block], "audit": [audit], "turns": [[{"role": a, "text": b} for a, b in turns]]})


def _digested(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits and the running digest of each conversation whose fragments come in order."""
    key, held, digest, any_turn = None, [], sha256(), False

    def close():
        return pd.DataFrame({"there": [key[0]], "conv": [key[1]], "audit": ["".join(held)], "repaired_sha256": [digest.hexdigest()]})

    for f in frames:
        for r in f.itertuples(index=False):
            if key != (r.there, r.conv):
                if key is not None:
                    yield close()
                key, held, digest, any_turn = (r.there, r.conv), [], sha256(), False
            held.append(r.audit)
            for t in r.turns:
                digest.update(f"{chr(10) * any_turn}{t['role']}:{t['text']}".encode())
                any_turn = True
    if key is not None:
        yield close()


def _parts(rows: DataFrame, block_rows: int, block_chars: int, with_turns: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Whole fragments, the reports of the conversations that are in several, and the latter's repaired fragments."""
    own = fragments(rows, block_rows, block_chars, with_turns)
    split = own.filter(~F.col("whole"))
    chain = materialise(split.drop("turns", "codes", "audit", "repaired_sha256", "cost").groupBy("there", "conv").applyInPandas(_chain, _CHAIN), "chain")
    placed = split.select("there", "conv", "part", "block", "codes", "turns").join(chain.select("part", "block", "there", "conv", "entry", "leave", "last"), ["there", "conv", "part", "block"])
    repaired = placed.mapInPandas(_repaired, "there boolean, conv long, part int, block int, audit string, turns array<struct<role:string,text:string>>")
    return own.filter("whole"), chain, repaired


def repair_conversations(rows: DataFrame, block_rows: int = 4096, block_chars: int = 4_000_000) -> DataFrame:
    """One row for each conv_id of ``rows`` (conv_id, turn, role, text and, if given, dropped: rows that count for
    nothing but their conv_id): gaps, blank, duplicate, truncated, illegal, cost (long), audit, repaired_sha256.

    A conversation's turns are taken by turn (nulls first), ties by role and then text. Null roles and texts are one
    space; a null conv_id is a conversation of its own. Equal rows are duplicates after the first; role and text
    are compared by 128 bits of hash. An empty table gives an empty one, and a conversation of dropped rows zeros, an
    empty audit and the digest of nothing. Extra columns are left out. Conversations of any length are repaired in
    fragments of ``block_rows`` turns or ``block_chars`` characters; only the digest of a conversation that is cut runs through its
    repaired text in one task, as a digest must, fragment after fragment.
    """
    whole, chain, repaired = _parts(rows, block_rows, block_chars, False)
    digests = repaired.repartition("there", "conv").sortWithinPartitions("there", "conv", "part", "block").mapInPandas(_digested, "there boolean, conv long, audit string, repaired_sha256 string")
    gaps = F.when(F.col("first_turn").isNull(), 0).otherwise(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct_turns")).cast("long")
    done = whole.withColumn("gaps", gaps).select(*_REPORT, "audit", "repaired_sha256")
    done = done.unionByName(chain.filter("last").select(*_REPORT).join(digests, ["there", "conv"]))
    return done.select(F.when(F.col("there"), F.col("conv")).alias("conv_id"), *_REPORT[2:], "audit", "repaired_sha256")


def repaired_turns(rows: DataFrame, block_rows: int = 4096, block_chars: int = 4_000_000) -> DataFrame:
    """(conv_id, part, block, position, role, text): the repaired turns themselves, in the order of part, block and position
    within a conversation. What is said of rows at ``repair_conversations`` holds here."""
    whole, _, repaired = _parts(rows, block_rows, block_chars, True)
    columns = ["there", "conv", "part", "block", "turns"]
    both = whole.select(*columns).unionByName(repaired.select(*columns))
    out = both.select("*", F.posexplode("turns").alias("position", "t"))
    return out.select(F.when(F.col("there"), F.col("conv")).alias("conv_id"), "part", "block", "position", F.col("t.role").alias("role"), F.col("t.text").alias("text"))
