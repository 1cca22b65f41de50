"""Texts as repeated segments, so that each distinct segment is tokenised once.

The pattern of the byte-level vocabularies never matches across a space that
stands between two characters other than white space, except that the space begins
the match to its right. Texts are therefore cut before such spaces, and the
pieces of equal segments are the same in every text.
"""

from __future__ import annotations

from collections.abc import Callable

#: Segments kept in a worker's memory; beyond, the worker forgets them and starts anew.
KEPT_SEGMENTS = 500_000
#: Longer segments are worked out where they stand and not kept.
KEPT_LENGTH = 64


def _key(unit: str) -> str:
    """A key without the leading space that nearly all segments have."""
    return unit[1:] if unit[:1] == " " and unit[1:2] not in ("", " ") else " " + unit


def literal(key: str) -> str:
    """The segment of a key."""
    return key[1:] if key[0] == " " else " " + key


def _clean(key: str) -> bool:
    return key != "" and not key[0].isspace() and not key[-1].isspace()


def _careful(parts: list[str]) -> list[str]:
    units, current = [], parts[0]
    for part in parts[1:]:
        if not current or not part or current[-1].isspace() or part[0].isspace():
            current += " " + part
        else:
            units.append(_key(current))
            current = " " + part
    return [*units, _key(current)]


class Segments:
    """Numbers segments as they are met; ``learn`` is told of each new one."""

    def __init__(self) -> None:
        self.codes: dict[str, int] = {}
        self.fresh: list[str] = []
        self.size = 0

    def full(self) -> bool:
        return self.size > KEPT_SEGMENTS

    def numbers(self, text: str) -> list[int]:
        """The segment numbers of one text, new segments being numbered on the way."""
        if not text:
            return []
        parts = text.split(" ")
        first = parts[0]
        if not _clean(first):
            return self._all(_careful(parts))
        known = self.codes.get
        parts[0] = " " + first
        found = [known(part, -1) for part in parts]
        if -1 not in found:
            return found
        for i, number in enumerate(found):
            if number < 0 and i and not _clean(parts[i]):
                parts[0] = first
                return self._all(_careful(parts))
        return self._all(parts)

    def _all(self, keys: list[str]) -> list[int]:
        codes, out = self.codes, []
        for key in keys:
            number = codes.get(key)
            if number is None:
                number = codes[key] = self.size
                self.size += 1
                self.fresh.append(key)
            out.append(number)
        return out

    def take_fresh(self) -> list[str]:
        """Segments numbered since the last call, in order of their numbers."""
        fresh, self.fresh = self.fresh, []
        return fresh

    def forget_long(self, keys: list[str]) -> None:
        """Drop the keys of long segments; their numbers stay valid."""
        for key in keys:
            if len(key) > KEPT_LENGTH:
                self.codes.pop(key, None)


_worker_state: dict = {}


def once_per_worker(name: str, key: object, make: Callable):
    """What ``make`` builds, kept for the later tasks of the same Python worker."""
    if (name, key) not in _worker_state:
        _worker_state[name, key] = make()
    return _worker_state[name, key]
