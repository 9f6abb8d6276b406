"""Terms of a text: maximal runs of digits, letters and bytes from 0x80 on, with A-Z as a-z."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

CHUNK = 1 << 20  # bytes whose terms are held as a list at once
_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_FOLD = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def term_lists(data: bytes, chunk: int = CHUNK) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded length; a term longer than a chunk stays whole."""
    if len(data) <= chunk:
        yield data.translate(_FOLD).split()
        return
    start = 0
    while start < len(data):
        end = min(start + chunk, len(data))
        while end < len(data) and _FOLD[data[end]] != 0x20:
            end += 1
        yield data[start:end].translate(_FOLD).split()
        start = end


def features(data: bytes, longest: int = 1) -> Counter:
    """Counts of all runs of 1 to `longest` consecutive terms, joined by one space."""
    counts: Counter = Counter()
    tail: list = []
    for terms in term_lists(data):
        counts.update(terms)
        if longest > 1:
            row = tail + terms
            for size in range(2, longest + 1):
                first = max(0, len(tail) - size + 1)
                counts.update(b" ".join(row[i:i + size]) for i in range(first, len(row) - size + 1))
            tail = row[-(longest - 1):]
    return counts
