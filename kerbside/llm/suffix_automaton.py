"""Suffix automata over words, and matching statistics against them."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    """All substrings of some passages, as sequences of words. No substring runs over two passages."""

    def __init__(self, passages: Iterable[Sequence[Hashable]] = ()):
        self._next: list[dict] = [{}]
        self._link = [-1]
        self._length = [0]
        self._last = 0
        for number, passage in enumerate(passages):
            for word in passage:
                self._extend(word)
            self._extend(number)  # no word is a number, so nothing matches here

    def _extend(self, word: Hashable) -> None:
        following, link, length = self._next, self._link, self._length
        new = len(following)
        following.append({})
        length.append(length[self._last] + 1)
        link.append(0)
        at = self._last
        while at >= 0 and word not in following[at]:
            following[at][word] = new
            at = link[at]
        if at >= 0:
            target = following[at][word]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                clone = len(following)
                following.append(following[target].copy())
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and following[at].get(word) == target:
                    following[at][word] = clone
                    at = link[at]
                link[target] = link[new] = clone
        self._last = new

    def spans(self, words: Sequence[Hashable], least: int) -> list[tuple[int, int]]:
        """Maximal runs of ``words`` covered by matches of ``least`` words or more, as (start, end).

        The matching statistic of a word is the length of the longest match that ends with it.
        """
        following, link, length = self._next, self._link, self._length
        state = matched = 0
        found: list[tuple[int, int]] = []
        for i, word in enumerate(words):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            if matched >= least:
                start = i + 1 - matched
                if found and start <= found[-1][1]:
                    found[-1] = (min(found[-1][0], start), i + 1)
                else:
                    found.append((start, i + 1))
        return found
