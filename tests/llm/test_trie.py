"""The conversation trie against plain dictionaries of prefixes, with shards of all widths."""

import hashlib
import random
import zlib

import pytest
from postlens.llm import queries, trie

FOLDER = "/root/testdata/sf0.001"


def plain(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends, children, chars = {}, {}, {}, {(): 0}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
            if d:
                children.setdefault(path[: d - 1], set()).add(path[:d])
                chars[path[:d]] = len(path[d - 1][1])
        ends.setdefault(path, []).append(c)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = int(node not in children)
        saved = (len(members[node]) - 1) * chars[node]
        for child in children.get(node, ()):
            leaves, saved = leaves + totals[child][0], saved + totals[child][1]
        totals[node] = leaves, saved
    out = []
    for node, own in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), len(children.get(node, ())), *totals[node], digest))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_trie(spark, FOLDER)) == plain(rows)


def corpus():
    """Families, copies, common starts, ids far apart, and one conversation much longer than all others."""
    rng = random.Random(8)
    rows = [(None, 0, "user", "lost"), (-205, 0, "user", "a"), (-200, 0, "user", "b"), (-200, 1, None, None)]
    ids = [*range(95, 330), 10**6, 10**6 + 7, 10**18, 10**18 + 5, -(10**18)]
    for c in ids:
        for turn in range(rng.randint(0, 7)):
            text = "hello" if turn == 0 and rng.random() < 0.6 else rng.choice(["x", "yy", "é", "", None])
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", None]), text))
    rows += [(c, t, "user", "same") for c in range(5_000, 5_400, 3) for t in range(4)]
    rows += [(7_000, t, "user", f"t{t % 3}") for t in range(900)] + [(7_000, 3, "user", "t0")] * 4
    rows += [(7_001, t, "user", f"t{t % 3}") for t in range(600)]
    return rows


@pytest.mark.parametrize("block, band", [(1_000, 4_096), (10, 3), (1, 1)])
def test_shards_and_odd_rows(spark, monkeypatch, block, band):
    monkeypatch.setattr(trie, "WIDER", 8)
    rows = corpus()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    frame = frame.withColumns({"depth": trie.F.lit("x"), "pos": trie.F.lit(1), "a": trie.F.lit(None).cast("string")})
    assert found(trie.prefix_trie(frame, block=block, band=band)) == plain(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(empty).count() == 0


def test_queue_spills_and_keeps_order():
    rng = random.Random(3)
    queue, plainly = trie.SpillingQueue(limit=10), []
    for _ in range(300):
        message = (rng.randrange(5), rng.randrange(5), rng.randrange(100), -7)
        queue.push(*message)
        plainly.append(message)
    for key in sorted({m[:2] for m in plainly}):
        assert sorted(queue.take(*key)) == sorted(m[2:] for m in plainly if m[:2] == key)
    assert not queue
