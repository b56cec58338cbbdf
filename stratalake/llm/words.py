"""Words of a text as bytes."""

from __future__ import annotations

_LETTER = frozenset(range(0x61, 0x7B)) | frozenset(range(0x80, 0x100))
_FOLD = bytes(b if b in _LETTER else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def letter_words(text: str) -> list[bytes]:
    """Lower-case runs of letters; what is no letter in ASCII divides words."""
    raw = text.encode()
    return (raw if len(raw) == len(text) else text.lower().encode()).translate(_FOLD).split()
