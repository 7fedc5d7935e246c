"""Near copies of the pipeline against brute force: Jaccard similarity of all pairs of texts."""

import random

import corpus_pipeline
import pytest
from postlens.llm import near


def runs(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*(words[i:] for i in range(5)))) or frozenset([tuple(words)] * bool(words))


def plain(rows):
    sets = [runs(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(((d, least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    rows = [(0, None), (1, " \n"), (2, "one Two"), (3, "ONE two"), (None, "one two"), (4, "one two three"), (4, "again")]
    for _ in range(8):
        base = [word() for _ in range(rng.randint(20, 200))]
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randint(0, len(base) // 25)):
                words[rng.randrange(len(words))] = word()
            rows.append((len(rows), " ".join(words[: rng.randint(len(words) * 9 // 10, len(words))])))
    # A chain: each text is near the next only.
    rows += [(len(rows) + i, " ".join(f"c{j}" for j in range(10 * i, 10 * i + 120))) for i in range(12)]
    rows += [(1000 + i, " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(40)]
    return rows + [(None, rows[20][1]), (2000, rows[20][1])]


@pytest.mark.parametrize("paired, leaders", [(64, 16), (2, 16), (2, 1)])
def test_components_equal_all_pairs(spark, monkeypatch, paired, leaders):
    monkeypatch.setattr(near, "LEADERS", leaders)
    rows = corpus()
    found = near.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), paired=paired)
    assert sorted(((r.doc_id, r.component_id) for r in found.collect()), key=str) == plain(rows)


def test_fingerprints_find_copies_by_themselves(spark, monkeypatch):
    """Without any shared shingle that is looked at, SimHash still links what the similarity confirms."""
    base = [f"w{i}" for i in range(2000)]
    changed = [w if i != 700 else "other" for i, w in enumerate(base)]
    rows = [(1, " ".join(base)), (2, " ".join(changed)), (3, " ".join(reversed(base))), (4, None), (5, "one")]
    by_hash, by_frequency = near._by_hash, near._by_frequency

    def sets_only(*given):
        again, sets = by_frequency(*given)
        return again.limit(0), sets

    monkeypatch.setattr(near, "_by_hash", lambda *given: by_hash(*given).limit(0))
    monkeypatch.setattr(near, "_by_frequency", sets_only)
    found = near.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 5)]


def test_stage_drops_copies_with_a_few_changed_words(spark):
    words = [f"w{i}" for i in range(300)]
    changed = [w if i % 75 else "other" for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()] == [1]


def test_stage_equals_all_pairs_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {least for _, least in plain([(r.doc_id, r.text) for r in docs.collect()])}
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept) == sorted(want)


def test_texts_of_one_template_are_hardly_compared(spark, monkeypatch):
    """Each text shares most of its shingles with all others, and no pair reaches the threshold."""
    template = [f"t{i}" for i in range(400)]

    def text(i):
        return " ".join(w if j % 45 else f"own{i}x{j} and{i}x{j} more{i}x{j}" for j, w in enumerate(template))

    rows = [(i, text(i)) for i in range(2_000)]
    a, b = runs(rows[0][1]), runs(rows[1][1])
    assert 0.7 < len(a & b) / len(a | b) < 0.8
    compared, count = near._compared, []

    def counted(pairs, *given):
        count.append(pairs.select("u", "v").distinct().count())
        return compared(pairs, *given)

    monkeypatch.setattr(near, "_compared", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near.near_copies(docs).collect()
    assert all(r.doc_id == r.component_id for r in found) and len(found) == 2_000
    assert sum(count) <= 2_000


def test_sets_and_first_shingles_are_not_kept(spark, monkeypatch):
    """Sets hold more bytes than the texts: where no row repeats another, no step stores them."""
    existed, by_frequency = [], near._by_frequency

    def looked(session, sets, least, folder):
        existed.extend(name for name in ("marks", "sets") if near.commits.exists(session, f"{folder}/{name}"))
        return by_frequency(session, sets, least, folder)

    monkeypatch.setattr(near, "_by_frequency", looked)
    rows = [(1000 + i, text) for i, (_, text) in enumerate(corpus())]
    found = near.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), paired=2).collect()
    assert sorted(((r.doc_id, r.component_id) for r in found), key=str) == plain(rows) and existed == []
