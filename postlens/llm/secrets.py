"""Secret scan with DataFrame functions only: patterns, then entropy in sliding windows.

Patterns find the usual forms of keys. The entropy scan looks at every other long run of token
characters: a window of ``WINDOW`` characters slides over it, the counts of its characters change
by one that enters and one that leaves, and the window is random enough when its Shannon entropy
reaches the level of the run's character class. Well-known harmless forms are on an allow list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kind, pattern, least length of the token and the group that holds it.
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", r"AKIA[A-Z0-9]{16,}", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
]
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
HEX_RUN = r"^[0-9A-Fa-f]+$"
# Character classes: kind, alphabet, least bits a character. A run of hexadecimal digits belongs to
# the first class, any other to the second.
CLASSES = [
    ("entropy_hex", "0123456789ABCDEFabcdef", 3.05),
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.81),
]
# Runs that match one of these are no secrets, whatever their entropy.
ALLOW = [
    r"^[^0-9]*$",  # words and paths without digits
    r"^[^A-Za-z]*$",  # numbers, dates, phone numbers
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",  # UUIDs name things, they open nothing
    r"(?i)example|sample|placeholder|changeme|xxxx|your[_-]?(api|key|token)",
    r"^[a-z]+([_/-][a-z]+)*[_/-]?[0-9]{1,4}$",  # numbered names
]
UNIT = 1_000_000
SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _spans(matches: Column, gaps: Column) -> Column:
    """``start, end`` of each match; ``gaps`` are the pieces between the matches."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return F.aggregate(
        F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, F.size(matches)).alias("g")),
        start,
        lambda s, x: F.struct(
            (s["at"] + F.length(x["g"]) + F.length(x["m"])).alias("at"),
            F.array_append(
                s["out"],
                F.struct(
                    (s["at"] + F.length(x["g"])).alias("start"),
                    (s["at"] + F.length(x["g"]) + F.length(x["m"])).alias("end"),
                ),
            ).alias("out"),
        ),
        lambda s: s["out"],
    )


def _found(text: Column, pattern: str) -> Column:
    """``match, start, end`` of each leftmost match of ``pattern``, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    return F.transform(
        F.arrays_zip(matches.alias("match"), _spans(matches, F.split(text, pattern)).alias("span")),
        lambda x: F.struct(x["match"].alias("match"), x["span"]["start"].alias("start"), x["span"]["end"].alias("end")),
    )


def _window_ends(run: Column, alphabet: str, level: float, window: int) -> Column:
    """``first, last``: start of the first and end of the last window of ``run`` at the level.

    The entropy of counts c is log2(w) - sum(c log2 c) / w, so the scan keeps that sum, in whole
    millionths, and the counts of the alphabet; -1 and -1 when no window reaches the level.
    """
    cost = [round(c * math.log2(c) * UNIT) if c else 0 for c in range(window + 1)]
    most = math.floor(window * (math.log2(window) - level) * UNIT)
    weight = F.array(*map(F.lit, cost))
    chars = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(alphabet), c))

    def step(s: Column, i: Column) -> Column:
        new, old = F.get(s["chars"], i), F.get(s["chars"], i - window)
        counts = F.transform(
            s["counts"],
            lambda c, k: c + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0),
        )
        grown = F.get(s["counts"], new)
        lost = F.get(s["counts"], old)
        change = F.when(F.coalesce(new == old, F.lit(False)), F.lit(0)).otherwise(
            F.get(weight, grown + 1)
            - F.get(weight, grown)
            + F.coalesce(F.get(weight, lost - 1) - F.get(weight, lost), F.lit(0))
        )
        total = s["total"] + change
        hit = (i >= window - 1) & (total <= most)
        return F.struct(
            s["chars"].alias("chars"),
            counts.alias("counts"),
            total.alias("total"),
            F.when(hit & (s["first"] < 0), i - window + 1).otherwise(s["first"]).alias("first"),
            F.when(hit, i + 1).otherwise(s["last"]).alias("last"),
        )

    start = F.struct(
        chars.alias("chars"),
        F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"),
        F.lit(0).alias("total"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.length(run) - 1),
        start,
        step,
        lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")),
    )


def _allowed(run: Column) -> Column:
    hit = F.lit(False)
    for pattern in ALLOW:
        hit = hit | run.rlike(pattern)
    return hit


def _entropy_spans(runs: Column, kind: str, order: int, alphabet: str, level: float, window: int) -> Column:
    scanned = F.transform(
        runs,
        lambda x: F.struct(x["start"].alias("at"), _window_ends(x["match"], alphabet, level, window).alias("w")),
    )
    return F.transform(
        F.filter(scanned, lambda x: x["w"]["first"] >= 0),
        lambda x: _span(x["at"] + x["w"]["first"], kind, order, x["at"] + x["w"]["last"]),
    )


def _span(start: Column, kind: str, order: int, end: Column) -> Column:
    return F.struct(
        start.alias("start"), F.lit(order).alias("rank"), F.lit(kind).alias("kind"), end.alias("end")
    )


def _base_spans(hits: Column, kind: str, order: int, pattern: str, least: int, group: int) -> Column:
    long_enough = F.filter(hits, lambda x: F.length(F.regexp_extract(x["match"], pattern, group)) >= least)
    return F.transform(long_enough, lambda x: _span(x["start"], kind, order, x["end"]))


def find_secrets(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``base`` and ``found`` to ``doc_id, text``: spans ``start, rank, kind, end``, by start.

    ``base`` holds the pattern spans; ``found`` also the entropy spans that overlap none of them.
    Spans count code points, the end is exclusive. A null text has no spans. Rows are independent,
    so null ids and repeated rows keep theirs.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select(
        "doc_id",
        *[F.when(F.col("text").rlike(p), _found(F.col("text"), p)).alias(kind) for kind, p, _, _ in BASE],
        F.when(F.col("text").rlike(CANDIDATE), _found(F.col("text"), CANDIDATE)).alias("runs"),
    )
    parts = []
    for order, (kind, pattern, least, group) in enumerate(BASE):
        hits = F.coalesce(F.col(kind), F.array().cast("array<struct<match:string,start:int,end:int>>"))
        parts.append(_base_spans(hits, kind, order, pattern, least, group))
    rows = rows.select("doc_id", "runs", F.array_sort(F.concat(*parts)).alias("base"))
    doubtful = F.filter(
        F.col("runs"),
        lambda x: ~_allowed(x["match"])
        & ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    rows = rows.select("doc_id", "base", F.when(F.col("runs").isNotNull(), doubtful).alias("runs"))
    is_hex = [lambda x: x["match"].rlike(HEX_RUN), lambda x: ~x["match"].rlike(HEX_RUN)]
    more = []
    for order, ((kind, alphabet, level), mine) in enumerate(zip(CLASSES, is_hex), len(BASE)):
        spans = _entropy_spans(F.filter("runs", mine), kind, order, alphabet, level, window)
        more.append(F.coalesce(F.when(F.size("runs") > 0, spans), F.array().cast(SPANS)))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", *more)).alias("found"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
