"""Byte-level BPE helpers: ranks of a vocabulary file, ids of whole texts by way of cached chunks."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

from millrace.llm.common import Cache

#: A space that other white space stands before and behind, or that ends the text after white space: only there may one
#: match of the pattern reach over the beginning of a space.
RUN = re.compile(r"\s (?:\s|\Z)")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one `base64 rank` a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def whole_text(encode: Callable[[str], bytes], limit: int = 400_000) -> Callable[[str], bytes]:
    """An encoder of whole texts from one of strings, both to little-endian unsigned 32-bit ids.

    The split pattern never matches across the beginning of a single space, so a text is cut there and what stands
    between two spaces is encoded once and remembered.  Texts with runs of spaces go through `encode` as a whole.
    """
    spaced = Cache(lambda chunk: encode(" " + chunk), limit)

    def run(text: str) -> bytes:
        if not text:
            return b""
        if RUN.search(text):
            return encode(text)
        first, *rest = text.split(" ")
        return b"".join([encode(first) if first else b"", *[spaced[chunk] for chunk in rest]])

    return run
