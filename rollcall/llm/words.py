"""Words of a text, as bytes: the small helpers that tasks share.

Each takes one whole text and is linear in it. Null texts have no words.
"""

import re

_UPPER, _WORD = range(0x41, 0x5B), (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100))

#: Lower-cases A-Z and blanks every ASCII byte that is neither digit nor letter.
_TO_WORDS = bytes(c + 32 if c in _UPPER else c if c in _WORD else 32 for c in range(256))

#: The characters of one word, after lower-casing A-Z: digits, a-z, all beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER_TO_LOWER = {c: c + 32 for c in _UPPER}


def alnum_words(text: str | None) -> list[bytes]:
    """Matches of ``WORD`` in the text with A-Z lower-cased, in UTF-8."""
    return (text or "").encode().translate(_TO_WORDS).split()


def alnum_word_spans(text: str) -> list[tuple[int, int]]:
    """Start and end of each word of :func:`alnum_words`, in code points."""
    return [m.span() for m in WORD.finditer(text.translate(UPPER_TO_LOWER))]


def spaced_words(text: str | None) -> list[bytes]:
    """Words between the ASCII blanks space, \\t, \\n, \\v, \\f and \\r, with A-Z lower-cased."""
    return (text or "").encode().lower().split()
