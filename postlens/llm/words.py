"""Words of a text as the operators see them: bytes between ASCII white space."""

from __future__ import annotations

import re
from collections.abc import Iterator

_BLANK = re.compile(rb"[ \t-\r]")
# A long text is cut at white space, so that its words never stand in memory all at once.
CHUNK = 1 << 20


def words(text: str | None, lower: bool = True) -> Iterator[list[bytes]]:
    """The words of ``text`` in order, in lists of about ``CHUNK`` bytes; none for null.

    ``lower`` turns A-Z, and nothing else, into small letters.
    """
    data = (text or "").encode("utf-8", "replace")
    if lower:
        data = data.lower()
    start = 0
    while start < len(data):
        cut = _BLANK.search(data, start + CHUNK) if len(data) - start > CHUNK else None
        end = cut.start() if cut else len(data)
        found = data[start:end].split()
        if found:
            yield found
        start = end


def shingles(text: str | None, size: int) -> Iterator[list[bytes]]:
    """Runs of ``size`` words joined by spaces, repeats included; a shorter text is one run."""
    tail: list[bytes] = []
    full = False
    for part in words(text):
        joined = tail + part
        if len(joined) >= size:
            full = True
            yield [b" ".join(run) for run in zip(*(joined[i:] for i in range(size)))]
        tail = joined[-(size - 1) :] if size > 1 else []
    if tail and not full:
        yield [b" ".join(tail)]
