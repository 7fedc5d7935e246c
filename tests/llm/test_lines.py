"""Line dedup against a dictionary of lines, with odd rows, and the levels of its runs."""

from collections import defaultdict

import pytest
from postlens.llm import lines

LONG = "A line that many documents share, long enough to count. Ü"
ROWS = (
    [(i, f"own {i} " * 8 + f"\n {LONG.swapcase() if i % 2 else LONG}\t\n\nshort\nshort") for i in range(9)]
    + [(20 + i, f"{LONG}{i % 3}\n{LONG}{i % 3}\nx") for i in range(12)]
    + [(7, LONG), (7, LONG), (None, LONG), (None, None), (40, None), (41, ""), (42, "\n\n"), (43, "z" * 500_000)]
)


def plain(rows, min_docs=5):
    blanks = " \t\n\x0b\x0c\r"
    lower = {i: i + 32 for i in range(65, 91)}

    def key(line):
        return line.strip(blanks).translate(lower)

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40 and doc is not None:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        split = (text or "").split("\n")
        kept = [
            s for s in split if doc is None or len(holders[key(s)]) < min_docs or doc == max(holders[key(s)])
        ]
        out.append((doc, len(split), len(split) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_equals_dictionary(spark, batches):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    got = lines.drop_shared_lines(docs.withColumn("row_id", lines.F.lit(0)), batches=batches).collect()
    assert sorted(map(tuple, got), key=str) == plain(ROWS)


def test_stage_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    docs = docs.withColumn("n_chars", lines.F.length("text").cast("long")).withColumn("gone", lines.F.lit(1))
    kept = lines.without_shared_lines(docs)
    assert kept.columns == docs.columns
    want = {(d, t) for d, _, _, t in plain(ROWS)}
    got = kept.collect()
    assert len(got) == len(ROWS) and {(r.doc_id, r.text or "") for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)


def test_empty_table(spark):
    assert lines.drop_shared_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_are_levelled_and_disjoint(spark, tmp_path):
    store = lines.LineRuns(spark, str(tmp_path))
    for batch in range(6):
        store.add(spark.range(batch * 5, batch * 5 + 10).selectExpr("id AS h1", "id AS h2", f"{-batch} AS top"))
    assert [len(level) for level in store.levels] == [0, 1, 1]
    found = store.lines().collect()
    assert sorted(r.h1 for r in found) == list(range(35))
    assert all(r.top == -max(0, (r.h1 - 5) // 5) for r in found)
