"""Conversation repair against a left-to-right search and an enumeration, and the registered query against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

from ensemblage.llm import queries, repair

TURNS = "conv_id bigint, turn bigint, role string, text string, pos string, block int, fault string"


def damage(rows):
    """The contract's damage, row by row."""
    found = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        found += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return found


def faults(rows):
    seen, kinds = set(), []
    for _, _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = "b" if not said else "d" if (role, text) in seen else "." if said[-1] in ".!?" else "t"
        seen.add((role, text))
        kinds.append(kind)
    return kinds


def cheapest(initials, kinds):
    """(cost, audit) by states of the last speaker, from left to right; insertions in a closure at each place."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    def closed(states):
        states = dict(states)
        for _ in range(4):
            for state, (cost, audit) in list(states.items()):
                for role in follows[state]:
                    new = (cost + 2, audit + "I")
                    if role != "s" and (role not in states or new < states[role]):
                        states[role] = new
        return states

    states = closed({"": (0, "")})
    for initial, kind in zip(initials, kinds, strict=True):
        following = {}

        def offer(state, cost, audit):
            if state not in following or (cost, audit) < following[state]:
                following[state] = (cost, audit)

        for state, (cost, audit) in states.items():
            offer(state, cost + 3, audit + "D")
            if kind in ".t":
                more = kind == "t"
                if initial and initial in follows[state]:
                    offer(initial, cost + more, audit + "K")
                for role in follows[state]:
                    if role != "s":
                        offer(role, cost + 2 + more, audit + "R")
        states = closed(following)
    return min(found for state, found in states.items() if state in ("", "a"))


def expected(originals):
    found, conversations = {}, {}
    for row in damage(originals):
        conversations.setdefault(row[0], []).append(row)
    for conv in {row[0] for row in originals}:
        rows = sorted(conversations.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        kinds, turns = faults(rows), {r[1] for r in rows} - {None}
        cost, audit = cheapest([r[2][:1] for r in rows], kinds)
        left, shown, last = iter(rows), [], ""
        for edit in audit:
            row = next(left) if edit != "I" else None
            if edit == "D":
                continue
            role = row[2] if edit == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            shown.append(f"{role}:{row[3] if row else ''}")
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        found[conv] = (gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(shown).encode()).hexdigest())
    return found


def collected(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    found = {r["conv_id"]: tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def invented(seed, conversations, longest):
    rng = random.Random(seed)
    said = ["", " ", None, "Yes.", "No", "Why?", "x" * 3_000 + ".", "\t\x0b", "é.", "Yes. \n", "...and"]
    return [(conv if conv else None, rng.choice([None, turn, turn, turn, turn // 2, 3 * turn]),
             rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""]), rng.choice(said) if rng.random() < 0.6 else f"{rng.random()}.",
             "p", 1, "f") for conv in range(conversations) for turn in range(rng.randint(1, longest))]


def test_cells_against_a_search_and_all_edits():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(0, 40)
        kinds = [(rng.choice("suaua-"), rng.choice("...btd")) for _ in range(n)]
        want = cheapest([i for i, _ in kinds], [k for _, k in kinds])
        cells = [repair.parse("".join(i + k for i, k in kinds[at : at + repair.BLOCK])) for at in range(0, n, repair.BLOCK)]
        cell = repair.INSERTED
        for more in cells:
            cell = repair.join_cells(cell, more)
        assert min(cell[z] for z in repair.START if z in cell) == want
    # every string of edits over short rows
    for roles in itertools.product("sua-", repeat=3):
        for kinds in itertools.product(".t", repeat=3):
            best = None
            for audit in ("".join(x) for n in range(3, 7) for x in itertools.product("DIKR", repeat=n) if len("".join(x).replace("I", "")) == 3):
                shown, rows = "", iter(zip(roles, kinds, strict=True))
                cost = 0
                for edit in audit:
                    role, kind = next(rows) if edit != "I" else ("", "")
                    cost += {"D": 3, "I": 2, "K": 0, "R": 2}[edit] + (kind == "t" and edit != "D")
                    shown += "" if edit == "D" else role if edit == "K" else "."
                if re.fullmatch(r"([s]?([u.][a.])+)?", shown) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
            cell = repair.parse("".join(r + k for r, k in zip(roles, kinds, strict=True)))
            assert min(cell[z] for z in repair.START if z in cell) == best


def test_report_against_plain_python(spark):
    rows = invented(1, 60, 9) + invented(2, 3, 150)
    table = spark.createDataFrame(rows, TURNS)
    want = expected([r[:4] for r in rows])
    assert collected(repair.report(repair.damaged(table), table)) == want


def test_long_conversations_are_joined_in_rounds_and_spread(spark, monkeypatch):
    monkeypatch.setattr(repair, "FAN_IN", 3)
    rows = invented(5, 2, 500) + invented(6, 8, 20)
    table = spark.createDataFrame(rows, TURNS)
    want = expected([r[:4] for r in rows])
    spark.conf.set("spark.ensemblage.maxGroupRows", "30")
    try:
        assert collected(repair.report(repair.damaged(table), table)) == want
    finally:
        spark.conf.unset("spark.ensemblage.maxGroupRows")


def test_nothing_and_rows_that_all_go(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repair.report(repair.damaged(empty), empty).count() == 0
    blank = spark.createDataFrame([(7, 1, "user", " ", "p", 1, "f"), (7, 1, "user", " ", "p", 1, "f")], TURNS)
    assert collected(repair.report(blank, blank)) == {7: (0, 2, 0, 0, 1, 6, "DD", hashlib.sha256(b"").hexdigest())}


def test_repaired_rows_are_in_order_and_keep_texts(spark):
    rows = spark.createDataFrame([(1, 2, "assistant", "Hello."), (1, 3, "user", "Oh?"), (1, 4, "user", "So."), (1, 5, "assistant", "Yes.")],
                                 "conv_id bigint, turn bigint, role string, text string")
    numbered = repair.numbered(rows)
    found = repair.parsed(numbered)
    assert [(r["cost"], r["audit"]) for r in found.collect()] == [(4, "IKKIKK")]
    shown = [(r["edit"], r["turn"], r["role"], r["text"]) for r in repair.repaired(numbered, found).orderBy("seq").collect()]
    assert shown == [("I", None, "user", ""), ("K", 2, "assistant", "Hello."), ("K", 3, "user", "Oh?"), ("I", None, "assistant", ""),
                     ("K", 4, "user", "So."), ("K", 5, "assistant", "Yes.")]


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(queries.QUERIES["op11_repair"](spark, folder)) == expected(given)
