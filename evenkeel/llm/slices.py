"""Words of one text as byte strings, slice by slice, so that a very long text takes no more room than a short one."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

#: Runs of anything but ASCII white space.
SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
#: Runs of lower-case ASCII letters, digits and all characters beyond ASCII.
ALPHANUMERIC = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bytes of text whose words are listed at a time.
SLICE_BYTES = 1 << 20


def folded(column: pa.Array) -> Iterator[bytes]:
    """The texts of a string column as UTF-8 with A-Z in lower case. Null reads as empty."""
    for text in column.cast(pa.large_binary()):
        yield (text.as_py() or b"").lower()


def word_lists(data: bytes, word: re.Pattern, limit: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in order, those of a slice at a time. Slices end between words."""
    first = 0
    while first < len(data):
        last = first + limit
        if cut := word.match(data, last):
            last = cut.end()
        yield word.findall(data, first, last)
        first = last
