"""Letters and numbers as the tokenizer library's Unicode version knows them.

The ``regex`` module follows a later Unicode version.  What that version added counts as neither letter nor number
for the library, so the classes here leave it out.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

# Letters and numbers (first, last) that the library's Unicode version does not have yet.
LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686),
    (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)

_set = "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in LATER)
has_later = regex.compile(f"[{_set}]").search


def pinned(pattern: str) -> regex.Pattern:
    """A split pattern whose letters and numbers are the library's."""
    for own, exact in (
        (r"[^\p{White_Space}\p{L}\p{N}]", rf"[[^\p{{White_Space}}\p{{L}}\p{{N}}]||[{_set}]]"),
        (r"[\p{L}]", rf"[\p{{L}}--[{_set}]]"),
        (r"[\p{N}]", rf"[\p{{N}}--[{_set}]]"),
    ):
        pattern = pattern.replace(own, exact)
    return regex.compile(pattern, regex.V1)


# Capitals (first, last) that the library knows and ``str.lower`` does not, with the first one's small letter.
NEWER_CAPITALS = (
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
    (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
)
_small = {first + i: small + i for first, last, small in NEWER_CAPITALS for i in range(last - first + 1)}
_has_newer_capital = regex.compile("[" + "".join(map(chr, _small)) + "]").search


def lowered(text: str) -> str:
    """Lower case letter by letter (no final sigma), as the library has it."""
    text = text.replace("Σ", "σ").lower()
    return text.translate(_small) if _has_newer_capital(text) else text


LETTER, NUMBER, OTHER, SPACE, BREAK = range(5)
TEXT_BREAK = "\ud800"  # stands between texts; no text holds it


@cache
def kinds() -> np.ndarray:
    """The class of every code point."""
    everything = "".join(map(chr, range(0xD800))) + "\ue000" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, name in ((LETTER, "L"), (NUMBER, "N"), (SPACE, "White_Space")):
        for m in regex.finditer(rf"\p{{{name}}}+", everything):
            out[m.start() : m.end()] = kind
    for first, last in LATER:
        out[first : last + 1] = OTHER
    out[ord(TEXT_BREAK)] = BREAK
    return out
