"""Mixing to target weights: flows against enumeration, targets and documents against plain versions."""

import itertools
import random
from collections import defaultdict

from postlens.llm import quotas, queries
from postlens.session import fresh_folder
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def plain_targets(sizes):
    order = sorted(sizes, key=lambda k: (k is None, (k or "").encode()))
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        level = left / sum(weight[k] for k in free)
        above = {k for k in free if weight[k] * level > 2 * sizes[k]}
        if not above:
            return target | {k: weight[k] * level for k in free}
        target |= {k: 2.0 * sizes[k] for k in above}
        left -= sum(2 * sizes[k] for k in above)
        free -= above
    return target


def check(rows, found):
    """Every row once; sizes, targets and what was taken are right."""
    white = " \t\n\x0b\x0c\r"
    size = lambda t: len("".join(" " if c in white else c for c in t or "").split(" ")) - "".join(" " if c in white else c for c in t or "").split(" ").count("")
    assert sorted(((r.doc_id, r.source, r.size) for r in found), key=str) == sorted(((d, s, size(t)) for d, t, s in rows), key=str)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size(text)
    target = plain_targets(sizes)
    for r in found:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) <= 1e-9 * max(1, r.target)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in sizes)


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").collect()]
    found = queries.op13_quotas(spark, FOLDER).collect()
    check(rows, found)
    assert sorted(map(tuple, found)) == sorted(map(tuple, queries.op13_quotas(spark, FOLDER).collect()))
    whole = sum(r.taken % r.size == 0 for r in found if r.size)
    assert whole >= sum(r.size > 0 for r in found) - len({r.source for r in found})


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(quotas, "BUCKET", 8)
    rng = random.Random(4)
    rows = [(1, None, "a"), (2, "", None), (None, "x y", None), (None, "x y", None), (3, " \x0b\tone word\n", "é"), (4, "w", ""), (5, "w w", "~"), (6, "w", "Z")]
    rows += [(9, "same words here", "hot")] * 700
    rows += [(100 + i, "w " * rng.choice([0, 1, 3, 50, 4_000]), rng.choice(["a", "b", "hot", None, "zz"])) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    frame = frame.withColumns({"size": F.lit("x"), "key": F.lit(1), "rank": F.lit(2), "members": F.lit(3)})
    found = quotas.mix(frame).collect()
    check(rows, found)
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, quotas.mix(frame.repartition(3)).collect()), key=str)
    assert quotas.mix(frame.limit(0)).count() == 0
    nothing = quotas.mix(frame.where("size(split(trim(text), ' ')) = 1 AND trim(text) = ''")).collect()
    assert all(r.taken == r.target == 0 for r in nothing)


def value_and_cost(words, flow):
    total = [sum(f.values()) for f in flow]
    return sum(total), sum(max(0, t - w) for t, w in zip(total, words))


def test_flow_equals_enumeration():
    rng = random.Random(2)
    for _ in range(150):
        p, s = rng.randint(1, 3), rng.randint(1, 3)
        words = [rng.randint(0, 3) for _ in range(p)]
        members = [sorted(rng.sample(range(s), rng.randint(1, min(2, s)))) for _ in range(p)]
        wanted = [rng.randint(0, 5) for _ in range(s)]
        flow = quotas.least_cost_flow(words, members, wanted)
        for i in range(p):
            assert set(flow[i]) <= set(members[i]) and sum(flow[i].values()) <= 2 * words[i]
        for j in range(s):
            assert sum(f.get(j, 0) for f in flow) <= wanted[j]
        arcs = [(i, j) for i in range(p) for j in members[i]]
        best = max(
            (lambda v, c: (v, -c))(*value_and_cost(words, split))
            for amounts in itertools.product(*(range(min(2 * words[i], wanted[j]) + 1) for i, j in arcs))
            for split in [[{j: a for (k, j), a in zip(arcs, amounts) if k == i} for i in range(p)]]
            if all(sum(f.values()) <= 2 * w for f, w in zip(split, words))
            and all(sum(f.get(j, 0) for f in split) <= wanted[j] for j in range(s))
        )
        value, cost = value_and_cost(words, flow)
        assert (value, -cost) == best


def test_documents_of_several_sources_fill_what_lacks(spark):
    """``a`` has words enough; those shared by ``a`` and ``b`` go to ``b``, and none is repeated."""
    docs = [(i, ["=a"], 10) for i in range(30)] + [(i, ["=a", "=b"], 10) for i in range(30, 50)] + [(i, ["=c"], 10) for i in range(50, 60)]
    docs = spark.createDataFrame(docs, "doc_id long, members array<string>, size long")
    targets = spark.createDataFrame([("=a", 0, 300.0), ("=b", 1, 200.0), ("=c", 2, 150.0)], "key string, rank long, target double")
    found = quotas.select_documents(docs, targets, fresh_folder(spark, "mix-test")).collect()
    by = defaultdict(int)
    for r in found:
        assert r.taken == sum(t.words for t in r.taken_by) <= (10 if r.members != ["=c"] else 20)
        for t in r.taken_by:
            assert t.key in r.members
            by[t.key] += t.words
    assert by == {"=a": 300, "=b": 200, "=c": 150}
