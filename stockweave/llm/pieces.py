"""Splitting text into the pieces within which byte-level BPE merges."""

from __future__ import annotations

from functools import lru_cache

import public_tokenizers
import regex

#: White space as Unicode defines it, whatever version of ``regex`` reads the pattern (fixed values).
WHITE = r"\t-\r\x20\x85\xa0  -     　"


@lru_cache(maxsize=8)
def splitter(pattern: str = public_tokenizers.PATTERN):
    """A function from a text to the list of its pieces."""
    explicit = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"(?!\S)", f"(?![^{WHITE}])")
    return regex.compile(explicit).findall
