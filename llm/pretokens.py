"""The common pre-tokenizer pattern of byte-level BPE, by vector operations over a text's code points.

A text's characters are letters, numbers, white space and others. A match of the pattern begins wherever the kind changes,
with three exceptions: one space goes with what follows it; of a run of white space that something follows, the last
character is a match of its own or goes with what follows; and a few English endings stay with their apostrophe.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

#: The pattern that `matches` is written for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
_ENDINGS = {"s": 1, "t": 1, "m": 1, "d": 1, "re": 2, "ve": 2, "ll": 2}


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, what in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(what, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1]) + 1
            out[a:b] = kind
    out[0xD800:0xE000] = _OTHER
    return out


def matches(text: str) -> list[str]:
    """What findall of PATTERN gives."""
    if len(text) < 2:
        return [text] if text else []
    at = np.flatnonzero(_begins(text)[0]).tolist()
    out = [text[a:b] for a, b in zip(at, at[1:])]
    out.append(text[at[-1] :])
    return out


def _begins(text: str, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Where matches begin, and the text's code points. starts: where texts begin that are encoded apart, but stand in one string."""
    n = len(text)
    code = np.frombuffer(text.encode("latin-1"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds()[code]
    blank = kind == _SPACE
    first = np.zeros(n + 1, bool)
    first[0] = first[n] = True
    if starts is not None:
        first[starts] = True
    first, last = first[:n], first[1:]  # a character that begins a text, one that ends one
    inner = ~first[1:]
    begins = first.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    begins[1:] &= ~((code[:-1] == 32) & ~blank[1:] & inner)  # goes with the space before it
    begins[:-1] |= blank[:-1] & ~blank[1:] & inner  # the last of a run of white space that something follows
    if "'" in text:
        for i in np.flatnonzero(begins & (code == 39)).tolist():
            size = _ENDINGS.get(text[i + 1 : i + 2]) or _ENDINGS.get(text[i + 1 : i + 3])
            if size and not last[i : i + size].any():
                begins[i + 1] = False
                if i + 1 + size < n:
                    begins[i + 1 + size] = True
    return begins, code


def batch_matches(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The matches of PATTERN of all texts in order, dictionary-encoded, and where each text's begin (one more entry than texts)."""
    text = "".join(texts)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    if not text:
        return pa.array([], pa.string()).dictionary_encode(), np.zeros(len(texts) + 1, np.int64)
    begins, code = _begins(text, starts)
    at = np.flatnonzero(begins)
    data = text.encode("utf-8", "surrogatepass")
    if len(data) == len(text):
        places = at
    else:
        width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        places = (np.cumsum(width) - width)[at]
    offsets = np.append(places, len(data)).astype(np.int64)
    # matches tile the text, so their bytes are its bytes
    array = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
    return array.dictionary_encode(), np.searchsorted(at, starts)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function from a text to the pattern's matches in order."""
    return matches if pattern == PATTERN else regex.compile(pattern).findall
