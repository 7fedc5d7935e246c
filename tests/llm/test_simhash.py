"""SimHash against brute force: fingerprints bit by bit, components by comparing all pairs."""

import random

import pytest
import xxhash
from postlens.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(doc)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(((d, f"{p:016x}", least[find(i)]) for i, (d, p) in enumerate(prints)), key=str)


def corpus():
    rng = random.Random(7)
    base = [rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "Word"), (4, "two words"), (None, "word"), (5, "WORD"), (5, "WORD")]
    for i in range(6, 90):
        words = list(base)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(400)] = rng.choice("xyz")
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60)))) for i in range(90, 140)]
    return rows + [(None, None), (140, "äÖ ÄÖ é"), (141, "long " * 300_000)]


@pytest.mark.parametrize("paired", [256, 2])
def test_components_equal_all_pairs(spark, paired):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", simhash.F.lit(1))
    found = simhash.near_duplicates(docs, paired=paired).select(
        "doc_id", simhash.as_hex(simhash.F.col("fp")), "component_id"
    )
    assert sorted(map(tuple, found.collect()), key=str) == plain_components(rows)


def test_empty_table_and_stage(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").withColumn("fp", simhash.F.lit("x"))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.without_copies(docs)
    assert kept.columns == docs.columns
    rows = {(d, c) for d, _, c in plain_components(corpus())}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({d for d, c in rows if d is not None and d == c})
    assert ids.count(None) == 2
