"""The pipeline against plain Python versions of its stages, each on its own input."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
from postlens.llm import langid

from tests.llm.test_lines import plain as plain_lines
from tests.llm.test_near import plain as plain_near

FOLDER = "/root/testdata/sf0.001"


def stage_inputs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return out


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def leaks(text, items):
    own = words(text)
    for item in items:
        runs = Counter(tuple(item[i : i + 5]) for i in range(max(1, len(item) - 4)))
        for at in range(len(own) - len(item) + 1):
            window = own[at : at + len(item)]
            if tuple(window[len(item) // 2 : len(item) // 2 + 1]) != tuple(item[len(item) // 2 : len(item) // 2 + 1]):
                continue
            mine = Counter(tuple(window[i : i + 5]) for i in range(max(1, len(window) - 4)))
            if sum((runs & mine).values()) >= 0.8 * sum((runs | mine).values()):
                return True
    return False


def test_stages(spark):
    given, known, lined, single, clean, packed = stage_inputs(spark)
    columns = given.columns
    assert all(t.columns == columns for t in (known, lined, single, clean))
    model = langid.train(given.where(~langid.held_out()))
    rows = given.collect()
    found = zip(rows, langid.decide([r.text for r in rows], model))
    want = {r.doc_id for r, (_, score, excess) in found if langid.is_language(r.text, score, excess, 0.5)}
    assert {r.doc_id for r in known.collect()} == want and len(want) >= 190

    before = [(r.doc_id, r.text) for r in known.collect()]
    assert sorted((r.doc_id, r.text) for r in lined.collect()) == sorted((d, t) for d, _, _, t in plain_lines(before))

    before = [(r.doc_id, r.text) for r in lined.collect()]
    want = {least for _, least in plain_near(before)}
    assert {r.doc_id for r in single.collect()} == want and single.count() == len(want) < len(before)

    items = [words(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = {r.doc_id for r in single.collect() if not leaks(r.text, items)}
    assert {r.doc_id for r in clean.collect()} == want and len(want) < single.count()

    pieces = defaultdict(list)
    for r in packed.collect():
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert pieces.keys() == want
    for parts in pieces.values():
        assert sum(n for _, n, _ in parts) == parts[0][2]
    run = corpus_pipeline.run(spark, FOLDER)
    assert run.columns == packed.columns and sorted(map(tuple, run.collect())) == sorted(map(tuple, packed.collect()))


def test_stages_take_odd_rows(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "und der die und", "de", "s", 1), (3, None, "en", "s", 0), (3, "", None, None, None)],
        given.schema,
    )
    docs = given.union(odd).union(given.limit(5))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() > 0
    empty = given.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.count() == 0
