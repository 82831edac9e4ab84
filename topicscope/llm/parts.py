"""Texts cut where byte-level BPE always cuts, so that ids need be found once per distinct part.

Its pre-tokenizer ends a token before a single blank between two characters that
are no white space, whatever lies around.  So a text's ids are those of its parts
between such blanks (each with the blank before it) in a row, and parts can be
encoded many at a time, as one text of parts with blanks between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

#: The bytes that byte-level BPE shows as themselves; the others follow from 256 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Characters encoded in one call.
CALL_CHARS = 1 << 16


def in_calls(parts: Iterable[str]) -> Iterator[list[str]]:
    """Parts that may stand beside each other, in lists of about ``CALL_CHARS``
    characters; one that begins or ends with white space is alone."""
    held, size = [], 0
    for p in parts:
        if p[0].isspace() or p[-1].isspace():
            yield [p]
            continue
        held.append(p)
        size += len(p) + 1
        if size >= CALL_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def byte_sizes(parts: list[str]) -> np.ndarray:
    """Bytes of each part and the blank before it."""
    return np.array([(len(p) if p.isascii() else len(p.encode())) + 1 for p in parts], np.int64)


def byte_tokenizer(path: str):
    """A ``tokenizers`` file of byte-level BPE; special tokens' strings are plain text."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


def byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level BPE's vocabulary stands for."""
    rest = (b for b in range(0x100) if b not in PRINTABLE)
    return {chr(b): b for b in PRINTABLE} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def cuts_at(ends: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How many of the tokens lie before each of the ``wanted`` ends."""
    at = np.searchsorted(ends, wanted, "right")
    if len(wanted) and not (at.all() and (ends[at - 1] == wanted).all()):
        raise ValueError("the tokenizer does not end a token before each single blank")
    return at
