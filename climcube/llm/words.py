"""Cutting texts where no token can span the cut, and remembering what the parts gave.

Both tokenisers used here never form a token across a single space that stands between two
characters that are not white space: one splits texts there before merging, the vocabulary of the other
has the space only at the start of a piece.  So a text's tokens are those of its parts in turn.
The memory of parts is bounded; parts that do not fit in are encoded each time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r"(?<=\S) (?=\S)")
_DOUBLE = re.compile(r"\s\s")
_LOOSE = re.compile(r" \s|\s ")
#: A space at an end or beside white space, as above, in the syntax of Arrow.
_SPACE_RE2 = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_LOOSE_RE2 = rf"\A | \z| {_SPACE_RE2}|{_SPACE_RE2} "


def parts_of(text: str) -> list[str]:
    """The text split at its safe spaces; those spaces are left out."""
    if text[:1].isspace() or text[-1:].isspace() or _DOUBLE.search(text):
        return _CUT.split(text)
    return text.split(" ")


def loose_space(text: str) -> bool:
    """Does a space stand beside other white space?  Then not every space is a safe one.  The end counts as a space."""
    return _LOOSE.search(text + " ") is not None


def split(texts: list[str] | pa.Array) -> pa.Array:
    """The parts of each text as a list, by ``parts_of`` or, where every space is safe, by Arrow."""
    texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
    loose = pc.match_substring_regex(texts, _LOOSE_RE2)
    if not pc.any(loose).as_py():
        return pc.split_pattern(texts, " ")
    parts = [parts_of(t) if slow else t.split(" ") for t, slow in zip(texts.to_pylist(), loose.to_pylist(), strict=True)]
    return pa.array(parts, pa.list_(pa.large_string()))


def slices_of(text: str, size: int) -> Iterator[str]:
    """Consecutive slices of about ``size`` characters; each but the first starts with a safe space."""
    start = 0
    while len(text) - start > size and (found := _CUT.search(text, start + size)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Memo(dict):
    """What ``encode`` (of many strings at once) gives for each string."""

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 800_000):
        self.encode, self.limit = encode, limit

    def of(self, parts: list[str]) -> list:
        found = list(map(self.get, parts))
        if None not in found:
            return found
        missing = list({x for x, value in zip(parts, found, strict=True) if value is None})
        new = dict(zip(missing, self.encode(missing), strict=True))
        if len(self) + len(new) <= self.limit:
            self.update(new)
        return [new[x] if value is None else value for x, value in zip(parts, found, strict=True)]


class Generations:
    """What ``encode`` gives for each string, remembered in two generations of at most ``limit`` strings together.

    When the younger one is full the older one goes, and what is met again moves to the younger one.  So
    frequent strings stay whatever came before them.
    """

    def __init__(self, encode: Callable[[list[str]], list], limit: int):
        self.encode, self.half = encode, limit // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, parts: list[str]) -> list:
        found = list(map(self.young.get, parts))
        places = [i for i, value in enumerate(found) if value is None]
        if not places:
            return found
        absent = [parts[i] for i in places]
        values = list(map(self.old.get, absent))
        unseen = list(dict.fromkeys(x for x, value in zip(absent, values, strict=True) if value is None))
        new = dict(zip(unseen, self.encode(unseen), strict=True))
        values = [new[x] if value is None else value for x, value in zip(absent, values, strict=True)]
        for i, value in zip(places, values, strict=True):
            found[i] = value
        if len(absent) <= self.half:
            if len(self.young) + len(absent) > self.half:
                self.young, self.old = {}, self.young
            self.young.update(zip(absent, values, strict=True))
        return found
