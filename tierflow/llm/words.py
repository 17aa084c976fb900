"""Words of whole texts as bytes, for operators that count them in Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

_LETTERS = bytes(range(0x41, 0x5B))
#: Bytes of a text split at a time.
_BLOCK = 1 << 20


def table_of(*kept: range) -> bytes:
    """A translation that lower-cases A-Z and turns ASCII outside ``kept`` into spaces; other bytes stay."""
    whole = {b for r in kept for b in r} | set(range(0x80, 0x100))
    lower = lambda b: b + 32 if b in _LETTERS else b
    return bytes(lower(b) if lower(b) in whole else 0x20 for b in range(256))


#: Runs of ASCII letters, digits and characters outside ASCII; and the same without digits.
WORDS = table_of(range(0x30, 0x3A), range(0x61, 0x7B))
LETTERS = table_of(range(0x61, 0x7B))


def blocks(text: str | None, table: bytes, size: int = _BLOCK) -> Iterator[list[bytes]]:
    """The words of ``text`` in order, in lists of about ``size`` bytes each; none for a null or wordless text."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(table)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        some = data[at:end].split()
        if some:
            yield some
        at = end
