"""Suffix automaton over word ids, with the owner of every substring."""

from __future__ import annotations


class SuffixAutomaton:
    """All substrings of the sequences added so far. Sequences must be added
    in ascending order of their owner: a state keeps the owner it was made
    with, which is then the smallest owner of all its substrings."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]

    def _state(self, nxt: dict[int, int], link: int, length: int, owner) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.link) - 1

    def _split(self, state: int, symbol: int, target: int) -> int:
        """The state of the substrings of ``target`` that end a walk from ``state``."""
        length = self.length[state] + 1
        if self.length[target] == length:
            return target
        clone = self._state(dict(self.next[target]), self.link[target], length, self.owner[target])
        self.link[target] = clone
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = clone
            state = self.link[state]
        return clone

    def add(self, sequence: list[int], owner) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for symbol in sequence:
            target = nxt[last].get(symbol)
            if target is not None:
                last = self._split(last, symbol, target)
                continue
            new = self._state({}, 0, length[last] + 1, owner)
            state = last
            while state >= 0:
                target = nxt[state].get(symbol)
                if target is not None:
                    link[new] = self._split(state, symbol, target)
                    break
                nxt[state][symbol] = new
                state = link[state]
            last = new

    def owners(self, sequence: list[int], window: int) -> list:
        """Matching statistics of a sequence, capped at ``window``: for each
        window of it, in order, the smallest owner of that very word sequence
        (None: no sequence that was added holds it)."""
        nxt, link, length, owner = self.next, self.link, self.length, self.owner
        out, state, matched = [], 0, 0
        for i, symbol in enumerate(sequence):
            target = nxt[state].get(symbol)
            while target is None and state:
                state = link[state]
                matched = length[state]
                target = nxt[state].get(symbol)
            if target is None:
                matched = 0
            else:
                state, matched = target, matched + 1
            if matched >= window:
                matched = window
                while length[link[state]] >= window:
                    state = link[state]
            if i >= window - 1:
                out.append(owner[state] if matched == window else None)
        return out
