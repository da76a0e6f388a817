"""Words of a text, as several operators cut them: runs of anything but space and the control characters 9 to 13."""

from __future__ import annotations

import re
from collections.abc import Iterator

# Bytes of a text whose words are held at once.
PIECE_BYTES = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def words_in_pieces(data: bytes, piece_bytes: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """All words of the UTF-8 bytes in order, in lists of a bounded size (but for a single longer word)."""
    begin = 0
    while begin < len(data):
        gap = _GAP.search(data, begin + piece_bytes) if len(data) - begin > piece_bytes else None
        end = gap.start() if gap else len(data)
        yield data[begin:end].split()  # splits at just these characters
        begin = end + 1
