"""Cuts of a text at places where no tokenizer rule reaches across."""

from __future__ import annotations

import re
from collections.abc import Iterator

# The Unicode White_Space characters, as the patterns of the tokenizers see them.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# White space that follows other text begins a unit, and a unit ends before the next such place.
# The split of a text into words looks no further than that, so units encode independently.
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_CUT = re.compile(f"[^{WHITE}](?=[{WHITE}])")


def blocks(text: str, size: int) -> Iterator[str]:
    """Blocks of about `size` characters, each a run of whole units."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]
