"""WARC: exact round trips, the shape of the files, and errors of damaged archives."""

import hashlib
import struct

import pytest
import zstandard
from postlens.llm import warc

BODY = "<p>" + "same payload " * 20 + "</p>"
ROWS = (
    [(i, f"http://a/{i}", f"<html>{i} " + f"text {i * 7919} " * (i % 90)) for i in range(700)]
    + [(1000, None, BODY), (1001, "x y\r\nz: 1", BODY), (1001, "again", BODY), (None, "n", BODY), (1002, "u", "short")]
    + [(1003, "u", "short"), (1004, "u", None), (None, None, None), (1005, "ü", "Ü" * 99), (1006, "long", "abc" * 400_000)]
    + [(1000, None, BODY)]
)


def plain(rows):
    payloads = [(p, u, (h or "").encode()) for p, u, h in rows]
    out = []
    for page, url, data in payloads:
        ids = [p for p, _, d in payloads if d == data and p is not None]
        first = min(ids, default=None) if len(data) >= 100 else page
        again = page != first
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [warc.ARCHIVE_BYTES, 2_000])
def test_round_trip(spark, tmp_path, size):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("digest", warc.F.lit("x"))
    rows = warc.typed(pages, str(tmp_path)).coalesce(1)
    listed = warc.write_archives(rows, str(tmp_path), size)
    (tmp_path / "archives" / "stray.warc.zst").write_bytes(b"left by a lost task")
    got = warc.read_archives(spark, f"{tmp_path}/archives", listed).collect()
    assert not [r.error for r in got if r.error]
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == plain(ROWS)
    by_digest = {r.payload_digest: bytes(r.payload) for r in got if r.record_type == "response"}
    assert {d.decode() for d in by_digest.values()} == {h or "" for _, _, h in ROWS}
    assert {r.url for r in got} >= {None, "x%20y%0D%0Az:%201", "ü"}
    assert (listed.count() > 1) == (size == 2_000)


def test_query_and_empty_table(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    got = warc.round_trip(pages, with_payload=False).drop("payload")
    assert got.count() == len(ROWS)
    assert warc.round_trip(pages.limit(0)).count() == 0


def some_archive():
    rows = [(f"page {i} " + "and much more of it " * 30).encode() for i in range(60)]
    made = [warc.record(i, "u", d, hashlib.sha256(d).hexdigest(), None, False) for i, d in enumerate(rows)]
    return list(warc.archive_frames(iter(made)))


def test_dictionary_leads_and_is_needed():
    frames = some_archive()
    assert struct.unpack_from("<I", frames[0])[0] == warc.DICTIONARY
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(frames[1])
    packed = zstandard.ZstdCompressor().compress(frames[0][8:])
    archive = struct.pack("<II", warc.DICTIONARY, len(packed)) + packed + b"".join(frames[1:])
    found = list(warc.records(archive))
    assert [n for n, _, _ in found] == list(range(60)) and not any(e for _, _, e in found)
    at, ends = 0, []
    whole = memoryview(b"".join(frames))
    while at < len(whole):
        ends.append(at := warc.frame_end(whole, at))
    assert ends == [sum(map(len, frames[: i + 1])) for i in range(len(frames))]


def test_damage_is_reported():
    frames = some_archive()
    found = list(warc.records(b"".join(frames)[:-7]))
    assert len(found) == 60 and found[-1][1] is None and "cut off" in found[-1][2]
    assert list(warc.records(b"junk that is no frame"))[0][2].startswith("no frame")
    assert list(warc.records(b"")) == []
    good = warc.record(1, "u", b"data", hashlib.sha256(b"data").hexdigest(), None, False)
    for old, new in [
        (b"WARC/1.1", b"WARC/9"), (b"data", b"dat"), (b"data", b"dada"), (b"WARC-Date", b"X"), (b"WARC-Type: response", b"WARC-Type: odd"),
        (b"sha256:", b"sha1:"), (b"x-page:1", b"x-page:a"), (b"WARC-Type: response", b"WARC-Type"),
    ]:
        codec = zstandard.ZstdCompressor()
        ((_, row, error), (_, next_row, none)) = warc.records(codec.compress(good.replace(old, new)) + codec.compress(good))
        assert row is None and error and next_row[0] == 1 and none is None
