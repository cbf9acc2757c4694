"""Splitting a text into fields that a byte-level tokenizer treats one by one.

The public pattern lets a space belong only to the match that it begins, unless
white space surrounds it. So a space between two other characters always starts
a match, and the text between such spaces can be encoded, and remembered, alone.
"""

from __future__ import annotations

from collections.abc import Callable

#: Fields that each of two generations of one worker holds, and the longest that is.
KEEP_FIELDS, KEEP_CHARS = 200_000, 40
#: Marks that are one match of their own between a word and a space.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class FieldEncoder:
    """Ids of whole texts as little-endian 32-bit integers, by ``encode(chunk) -> bytes`` on fields.

    A full generation of remembered fields becomes the old one, from which fields
    that come again are taken over.
    """

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if len(self.known) > KEEP_FIELDS:
            self.old, self.known = self.known, {}
        fields = text.split(" ")
        found: list = list(map(self.known.get, fields))
        found[0] = None
        self.fill(fields, found)
        return b"".join(found)

    def word(self, f: str) -> bytes:
        """Ids of a field that stands after a space."""
        got = self.known.get(f) or self.old.get(f)
        if got is None:
            got = self.encode(" " + f)
        if len(f) <= KEEP_CHARS:
            self.known[f] = got
        return got

    def field(self, f: str) -> bytes:
        """The same; marks behind a word are encoded for themselves."""
        stem = f.rstrip(MARKS)
        if len(stem) == len(f) or not stem.isalpha():
            return self.word(f)
        tail = f[len(stem) :]
        sent = self.marks.get(tail)
        if sent is None:
            sent = self.encode(tail)
            if len(tail) <= KEEP_CHARS and len(self.marks) < KEEP_FIELDS:
                self.marks[tail] = sent
        often = stem in self.known
        got = self.word(stem) + sent
        if often and len(f) <= KEEP_CHARS:
            self.known[f] = got
        return got

    def fill(self, fields: list[str], found: list) -> None:
        n = len(fields)
        after = 0
        for i in [k for k, v in enumerate(found) if v is None]:
            if i < after:
                continue
            f = fields[i]
            if i and f and not f[0].isspace() and not f[-1].isspace():
                before = fields[i - 1]
                if before and not before[-1].isspace():
                    found[i] = self.field(f)
                    continue
            a, b = i, i + 1  # white space joins fields until both sides of a space are clear
            while a > 0 and (not fields[a] or fields[a][0].isspace() or not fields[a - 1] or fields[a - 1][-1].isspace()):
                a -= 1
            while b < n and (not fields[b] or fields[b][0].isspace() or not fields[b - 1] or fields[b - 1][-1].isspace()):
                b += 1
            found[a:b] = [b""] * (b - a)
            found[b - 1] = self.encode((" " if a else "") + " ".join(fields[a:b]))
            after = b
