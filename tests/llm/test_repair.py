"""Conversation repair against a plain search over all edits, and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib

from postlens.llm import queries, repair

FOLDER = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"


def plain_edits(initials, faults):
    """The least ``(cost, audit, roles)`` over all edits, by a table from the front."""
    accepted = re.compile(r"(s?(ua)*u?)?\Z")  # what can still become (s?(ua)+)?
    best = {"": (0, "")}  # by the roles written so far, shortened to what matters

    def short(roles):
        return roles if len(roles) < 2 else "u" * (roles[-1] == "u") + "ua" * (roles[-1] == "a")

    def closed(table):
        for _ in range(3):
            for roles, (cost, audit) in list(table.items()):
                for role in "ua":
                    offer(table, roles + role, cost + 3, audit + "I")
        return table

    def offer(table, roles, cost, audit):
        if accepted.match(roles):
            key = short(roles)
            table[key] = min(table.get(key, (10**9, "")), (cost, audit))

    closed(best)
    for initial, fault in zip(initials, faults):
        after = {}
        for roles, (cost, audit) in best.items():
            offer(after, roles, cost + 4, audit + "D")
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                offer(after, roles + initial, cost + extra, audit + "K")
                for role in "ua":
                    offer(after, roles + role, cost + 3 + extra, audit + "R")
        best = closed(after)
    return min(v for k, v in best.items() if k == "" or k.endswith("a"))


def plain(rows):
    """Results by conversation, from the given rows as the contract words it."""
    out, by_id = {}, {}
    for conv, turn, role, text in rows:
        by_id.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by_id[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv, own in by_id.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in own:
            end = text.rstrip(WHITE)[-1:]
            faults.append(
                "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""
            )
            seen.add((role, text))
        initials = [role[:1] or " " for _, role, _ in own]
        cost, audit = plain_edits(initials, faults)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        written, at = [], 0
        for edit in audit:
            following = "assistant" if written and written[-1][0][:1] == "u" else "user"
            if edit == "I":
                written.append((following, ""))
                continue
            _, role, text = own[at]
            at += 1
            if edit != "D":
                written.append((role if edit == "K" else following, text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in written).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in written))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def found(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


def test_auction_finds_the_least_edits():
    rng = random.Random(1)
    names = {repair.SOUND: "", repair.IS_BLANK: "blank", repair.IS_DUPLICATE: "duplicate", repair.IS_TRUNCATED: "truncated"}
    for n in [*range(8)] * 30 + [15, 16, 17, 60, 200]:
        initials = "".join(rng.choice("suaaux ") for _ in range(n))
        faults = bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        assert repair.cheapest(initials, faults) == plain_edits(initials, [names[f] for f in faults]), (initials, faults)


def test_prices_are_feasible_and_their_number_grows_with_the_rows(monkeypatch):
    calls = []
    arcs = repair._arcs
    monkeypatch.setattr(repair, "_arcs", lambda *a: calls.append(1) or arcs(*a))
    for n in (1_000, 4_000):
        calls.clear()
        price = repair.prices("u" * n, bytes(n))
        assert all(price[4 * i + s] <= c + price[4 * (i + d) + t] for i in range(n + 1) for s in range(4) for _, c, d, t in arcs(i, s, "u" * n, bytes(n)))
        assert len(calls) < 250 * n


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op12_repair(spark, FOLDER)) == plain(rows)


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(1, None, None, None), (1, None, "user", "x."), (None, 1, "user", "a."), (None, None, "assistant", "b!"), (2, 5, "", " \n")]
    rows += [(3, 4, "user", "same?")] * 3 + [(3, 9, "user", "same?"), (3, 9, "assistant", "same?"), (4, -2, "tool", "é."), (4, 7, "system", "")]
    roles = ["user", "assistant", "system", "User", "agent", None]
    texts = ["Yes.", "no", "", "Ok! ", "Yes.", "\x0b", None, "long " * 50_000]
    rows += [(10 + rng.randrange(30), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for _ in range(300)]
    rows += [(50, i, "user", "again.") for i in range(700)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({"kind": repair.F.lit("x"), "digest": repair.F.lit(1), "fault": repair.F.lit(1)})
    assert found(repair.repair(repair.damage(frame), frame)) == plain(rows)
    assert repair.repair(repair.damage(frame.limit(0)), frame.limit(0)).count() == 0
