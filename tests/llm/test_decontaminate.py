"""Decontamination against brute force: every window of every document with every item."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from postlens.llm import decontaminate as dc


def plain(docs, items):
    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    def runs(w):
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))

    found = {}
    for d, (doc_id, text) in enumerate(docs):
        own = words(text)
        for item_id, item in items:
            sought = words(item)
            best = (0, 0)
            for at in range(len(own) - len(sought) + 1) if sought else ():
                a, b = runs(own[at : at + len(sought)]), runs(sought)
                if len(sought) < 5:
                    a, b = Counter([tuple(own[at : at + len(sought)])]), Counter([tuple(sought)])
                best = max(best, (sum((a & b).values()) / sum((a | b).values()), -at))
            if best[0] >= 0.8:
                found[d, doc_id, item_id] = (round(best[0], 9), -best[1], len(sought))
    return sorted(((k[1], k[2], *v) for k, v in found.items()), key=str)


def corpus():
    rng = random.Random(3)
    vocabulary = [a + b for a in "bcdfgh" for b in ("a", "ei", "ou", "an")]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([12, 30, 31, 60])))) for i in range(30)]
    items += [(30, None), (31, "!?"), (32, "one two three"), (33, items[0][1]), (34, "a b c d e " * 6)]
    docs = []
    for i in range(160):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if i % 2:
            part = items[rng.randrange(30)][1].split()
            for _ in range(rng.randint(0, 2)):
                part[rng.choice([0, 1, -1, -2, len(part) // 2])] = "zzz"
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() + "!!" if i % 3 else w for w in part]
        docs.append((i, " ".join(text)))
    docs += [(200, None), (201, ""), (None, items[1][1]), (202, items[2][1]), (202, items[2][1])]
    docs += [(203, "One, two; THREE"), (204, "a b c d e " * 9), (205, "filler " * 1_500 + items[3][1] + " x" * 99)]
    return docs, [(i, t) for i, t in items]


@pytest.mark.parametrize("chars", [dc.BLOCK_CHARS, 2_000])
def test_equals_brute_force(spark, monkeypatch, chars):
    docs, items = corpus()
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", dc.F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = dc.contaminated(table, bench, chars=chars).collect()
    got = [(r.doc_id, r.item_id, round(r.similarity, 9), r.start, r.n_words) for r in rows]
    assert sorted(got, key=str) == plain(docs, items)
    assert len(got) > 40
    leaking = {r[0] for r in got}
    kept = dc.without_contaminated(table, bench, chars=chars)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in leaking)
    assert dc.contaminated(table.limit(0), bench).count() == 0
    assert dc.contaminated(table, bench.limit(0)).count() == 0


def test_stretches_cut_no_window(monkeypatch):
    docs, items = corpus()
    index = dc.Items([i for i in items if i[1]])
    whole = [index.search(t) for _, t in docs]
    monkeypatch.setattr(dc, "STRETCH", 50)
    assert [index.search(t) for _, t in docs] == whole


def test_blocks_find_all_within_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for radius in (0, 3, 24, 64):
        blocks = dc._Blocks(prints, radius)
        for p in prints[:20] ^ rng.integers(0, 1 << 12, 20, dtype=np.uint64):
            assert blocks.near(p).tolist() == [i for i, q in enumerate(prints) if (int(p) ^ int(q)).bit_count() <= radius]


def plain_short(text, item):
    """Similarity of a whole text that is shorter than the item."""
    a, b = (re.findall(r"[^\W_]+", t.lower()) for t in (text, item))
    a, b = (Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (a, b))
    return sum((a & b).values()) / sum((a | b).values()) if a else 0.0


def test_texts_shorter_than_an_item(spark, monkeypatch):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice("abcdefghijkl") + str(rng.randrange(9)) for _ in range(n))) for i, n in enumerate([9, 12, 30, 50, 50, 60])]
    items += [(6, items[3][1] + " tail"), (7, "x y z v w " * 8), (8, "one two three")]
    docs = []
    for _, item in items:
        words = item.split()
        for cut in (1, 2, 3, 5, 8, 9, 10, 11):
            docs += [words[:-cut], words[cut:], words[cut // 2 : cut // 2 - cut], words[: len(words) // 2] + words[len(words) // 2 + cut :]]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    want = {(d, i, round(s, 9), 0, len(text.split())) for d, text in docs for i, item in items
            if len(text.split()) < len(item.split()) and (s := plain_short(text, item)) >= 0.8}
    assert len(want) > 60 and max(s for _, _, s, *_ in want) > 0.97
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = dc.contaminated(table, bench).collect()
    got = {(r.doc_id, r.item_id, round(r.similarity, 9), r.start, r.n_words) for r in rows}
    assert sorted(got) == sorted(want | set(plain(docs, items)))
    kept = {r.doc_id for r in dc.without_contaminated(table, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, *_ in got}
    index = dc.Items(items)
    whole = [index.search(t) for _, t in docs]
    monkeypatch.setattr(dc, "STRETCH", 40)
    assert [index.search(t) for _, t in docs] == whole
