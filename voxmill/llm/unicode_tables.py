"""Mapping tables for text that looks alike, built by rule from Python's Unicode database.

Only the look-alike letters are stated; every other entry follows from the code point's own properties:
its decomposition, category and combining class.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

# Letters of other scripts whose shape is that of a Latin letter, and the Latin letter.
LOOK_ALIKES = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ρ": "p", "ν": "v", "ι": "ı", "ϳ": "j", "ϲ": "c", "Ϲ": "C", "Ϳ": "J",
    "Ѕ": "S", "І": "I", "Ј": "J", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ү": "Y", "Ԁ": "d", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ӏ": "I", "Ԍ": "G",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "ӏ": "l", "ѵ": "v",
    "ɡ": "g", "ɑ": "a",
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "Օ": "O", "Ս": "U",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
}
# Kinds of compatibility decomposition that change no visible shape.
SAME_SHAPE = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>")
# Characters without ink that the category "format" does not cover.
NO_INK = (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0))
#: Line breaks are visible; these write the same break with another character.
LINE_BREAKS = {"\u2028": "\n", "\u2029": "\n", "\x85": "\n"}


def _once(ch: str) -> str:
    cat = unicodedata.category(ch)
    if ch in LINE_BREAKS:
        return LINE_BREAKS[ch]
    if cat == "Cf" or ord(ch) in NO_INK:
        return ""
    if cat == "Zs":
        return " "
    if ch in LOOK_ALIKES:
        return LOOK_ALIKES[ch]
    decomposed = unicodedata.decomposition(ch)
    if not decomposed:
        if 0xAC00 <= ord(ch) <= 0xD7A3:
            return unicodedata.normalize("NFD", ch)
        return ch
    kind, _, rest = decomposed.partition(" ")
    if kind.startswith("<"):
        # A compatibility sequence that begins with a blank writes a free-standing accent, which is a sign of its own.
        if kind not in SAME_SHAPE or (rest.startswith("0020") and len(rest) > 4):
            return ch
        return "".join(chr(int(x, 16)) for x in rest.split())
    return "".join(chr(int(x, 16)) for x in decomposed.split())


def decomposed(ch: str) -> str:
    """The code points that stand for one character, followed to the end."""
    out, seen = ch, set()
    while out not in seen:
        seen.add(out)
        out = "".join(map(_once, out))
    return out


def _code_points():
    return (chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)


@lru_cache(maxsize=1)
def tables() -> dict:
    """decomposition: character -> its code points where they differ; compose: full canonical decomposition -> character;
    followers: characters that may join the one before (marks and what begins with one, vowel and final jamo); classes."""
    decomposition, compose, followers, classes = {}, {}, set(), {}
    for ch in _code_points():
        cat = unicodedata.category(ch)
        if cat in ("Cn", "Co"):
            if ord(ch) not in NO_INK:
                continue
        if (klass := unicodedata.combining(ch)) and ch not in LOOK_ALIKES:
            classes[ch] = klass
            followers.add(ch)
        if (d := decomposed(ch)) != ch:
            decomposition[ch] = d
        canonical = unicodedata.decomposition(ch)
        if (canonical and not canonical.startswith("<")) or 0xAC00 <= ord(ch) <= 0xD7A3:
            full = unicodedata.normalize("NFD", ch)
            if unicodedata.normalize("NFC", full) == ch:
                compose[full] = ch
                if not 0xAC00 <= ord(ch) <= 0xD7A3:
                    pair = canonical.split()
                    if len(pair) == 2:
                        followers.add(chr(int(pair[1], 16)))
    followers |= {ch for ch, d in decomposition.items() if d and unicodedata.combining(d[0])}
    followers |= {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    return {"decomposition": decomposition, "compose": compose, "followers": followers, "classes": classes}


def _is_stable(ch: str, d: str) -> bool:
    """Decomposed and put together again it is the same character."""
    return unicodedata.normalize("NFC", d) == ch


@lru_cache(maxsize=1)
def unsettled() -> tuple[frozenset, frozenset, frozenset]:
    """(starters that change, characters that vanish, followers). Any other character stays as it is wherever no follower comes next."""
    t = tables()
    gone = {c for c, d in t["decomposition"].items() if d == ""}
    followers = t["followers"] - gone
    changed = {c for c, d in t["decomposition"].items() if d and c not in followers and not _is_stable(c, d)}
    return frozenset(changed), frozenset(gone), frozenset(followers)


def char_class(chars) -> str:
    """The inside of a regular expression's character class, in ranges."""
    codes, out, i = sorted(map(ord, chars)), [], 0
    while i < len(codes):
        j = i
        while j + 1 < len(codes) and codes[j + 1] == codes[j] + 1:
            j += 1
        out.append(f"\\x{{{codes[i]:X}}}" + (f"-\\x{{{codes[j]:X}}}" if j > i else ""))
        i = j + 1
    return "".join(out)


class _Translate(dict):
    def __missing__(self, code: int) -> str:
        out = self[code] = decomposed(chr(code))
        return out


_TRANSLATE = _Translate()


def folded(text: str) -> str:
    """One string's consistent form, as the distributed operator gives it; for use inside other operators' Python workers."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", text.translate(_TRANSLATE))
