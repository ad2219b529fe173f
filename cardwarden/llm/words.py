"""Words of a text as bytes, in blocks, for use inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BLOCK = 1 << 22


def word_blocks(data: bytes, block: int = _BLOCK) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in order, a few megabytes of text at a time.

    ``bytes.split`` takes exactly the six ASCII white-space characters as separators.
    """
    if len(data) <= block:
        yield data.split()
        return
    start = 0
    while start < len(data):
        cut = _SPACE.search(data, min(start + block, len(data)))
        end = cut.start() if cut else len(data)
        yield data[start:end].split()
        start = end
