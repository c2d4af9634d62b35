"""Words of letters and digits, as numbers of a given vocabulary.

A word is a longest run of A-Z, a-z, 0-9 and anything beyond ASCII, with only A-Z lower-cased. In UTF-8
every byte of a character beyond ASCII is 0x80 or more, so words are cut on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np

PART_BYTES = 1 << 20
#: Every byte as it is in a word, or a space where no word has it.
FOLD = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))


def words(text: bytes, part_bytes: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists from about ``part_bytes`` each, so that a long text is never one list."""
    folded, at = text.translate(FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + part_bytes)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def numbers(text: bytes, vocabulary: dict[bytes, int], part_bytes: int = PART_BYTES) -> np.ndarray:
    """The number of each word of a text, -1 for words that the vocabulary does not have."""
    parts = [np.fromiter(map(vocabulary.get, part, repeat(-1)), np.int32, len(part)) for part in words(text, part_bytes)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)
