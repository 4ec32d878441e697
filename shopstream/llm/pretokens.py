"""Cutting text into the pieces that byte-pair merges work on, with a bounded memory of results."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

# White space before a space: there a cut at the space would not be a piece boundary.
_SPACED = re.compile(r"\s ")


class Pieces:
    """Pieces of a text by a pattern of the usual kind (optional leading space, no look-behind).

    Such a pattern always starts a piece at a space that follows a visible character. Words
    cut at those spaces are therefore independent of each other, and a word seen before need
    not be matched again.
    """

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall

    def words(self, text: str) -> tuple[list[str], list[str]]:
        """(pieces, words): the pieces that start the text, then words that each follow a space."""
        if _SPACED.search(text):
            return self.find(text), []
        first, *rest = text.split(" ")
        return self.find(first), rest

    def word(self, word: str) -> list[str]:
        """Pieces of a word and the space before it."""
        return self.find(" " + word)


class Memory(dict):
    """Results by key, made on demand. Holds two generations of ``size`` entries at most.

    Entries not asked for since the older generation was filled are forgotten, so a task
    that meets ever new words keeps a fixed amount of memory. Long keys are not kept.
    """

    def __init__(self, make: Callable | None = None, size: int = 200_000, longest: int = 64):
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value

    def known(self, keys: set) -> tuple[dict, list]:
        """(results held for these keys, keys without one)."""
        found, rest = {}, []
        for key in keys:
            value = self.get(key)
            if value is None:
                value = self.old.get(key)
                if value is None:
                    rest.append(key)
                    continue
                self.keep(key, value)
            found[key] = value
        return found, rest

    def learn(self, made: dict) -> dict:
        for key, value in made.items():
            self.keep(key, value)
        return made
