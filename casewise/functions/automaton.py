"""Many patterns found at once: an Aho-Corasick automaton in a double array, run over many pieces of text side by side.

A state's next state for a byte lies at ``base[state] + byte``, and is real if ``check`` there names the state; else the
failure link leads to the longest suffix that is a state. So a byte costs a step, and failures are paid for by steps
before, however long the list is. Texts are cut into pieces that overlap by the longest pattern, and a step is taken in all
pieces at a time.
"""

from collections import deque
from collections.abc import Sequence

import numpy as np

PIECE = 256  # bytes of a text that are gone through in one lane


class Automaton:
    """Finds which of ``patterns`` a text contains. Empty patterns are in every text; a repeated one is found under each number."""

    def __init__(self, patterns: Sequence[str]):
        raw = [p.encode("utf-8", "surrogatepass") for p in patterns]
        self.everywhere = np.array([i for i, p in enumerate(raw) if not p], np.int64)
        self.longest = max(map(len, raw), default=0)
        children: list[dict[int, int]] = [{}]
        ends: dict[int, list[int]] = {}
        for number, pattern in enumerate(raw):
            node = 0
            for byte in pattern:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            if pattern:
                ends.setdefault(node, []).append(number)
        order, fail = _failures(children)
        place = self._place(children, order)
        # per slot: its failure slot, and the slot of the longest suffix, or itself, that ends a pattern
        self.fail = np.zeros(len(self.base), np.int64)
        self.hit = np.full(len(self.base), -1, np.int64)
        self.shorter = np.full(len(self.base), -1, np.int64)
        # the patterns that end in a slot: so many of ``numbers``, from ``firsts`` on
        self.counts, self.firsts = np.zeros(len(self.base), np.int64), np.zeros(len(self.base), np.int64)
        self.numbers = np.array([number for numbers in ends.values() for number in numbers], np.int64)
        upto = 0
        for node, numbers in ends.items():
            self.counts[place[node]], self.firsts[place[node]] = len(numbers), upto
            upto += len(numbers)
        for node in order:
            at, below = place[node], place[fail[node]]
            self.fail[at] = below
            self.shorter[at] = self.hit[below] if node else -1
            self.hit[at] = at if node in ends else self.shorter[at]

    def _place(self, children: list[dict[int, int]], order: list[int]) -> list[int]:
        """Slots of all nodes: children of a node at its base plus their byte, on slots that are free."""
        place = [0] * len(children)
        size = len(children) + 512
        base, check, taken = [0] * size, [-1] * size, bytearray(size)
        taken[0] = 1
        free = 1
        for node in order:
            codes = sorted(children[node])
            if not codes:
                continue
            while taken[free]:
                free += 1
            slot = free
            while True:
                start = slot - codes[0]
                if start + 256 >= size:
                    more = size
                    base += [0] * more
                    check += [-1] * more
                    taken += bytearray(more)
                    size += more
                if start > 0 and not any(taken[start + code] for code in codes):
                    break
                slot += 1
                while taken[slot]:
                    slot += 1
            base[place[node]] = start
            for code in codes:
                child = children[node][code]
                place[child] = start + code
                check[start + code] = place[node]
                taken[start + code] = 1
        self.base, self.check = np.array(base + [0] * 256, np.int64), np.array(check + [-1] * 256, np.int64)
        return place

    def found(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, pattern) of all patterns in texts, which lie in ``data`` between ``starts``; each pair once, in order."""
        lengths = np.diff(starts)
        pieces = np.maximum(1, -(-lengths // PIECE)) * (lengths > 0)
        text = np.repeat(np.arange(len(lengths)), pieces)
        at = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
        last = np.minimum(at + PIECE, lengths[text]) + starts[text]
        first = np.maximum(at - max(0, self.longest - 1), 0) + starts[text]
        order = np.argsort(first - last, kind="stable")  # the longest lanes first: those still running are a prefix
        text, first, size = text[order], first[order], (last - first)[order]
        running = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0))
        state = np.zeros(len(text), np.int64)
        hits = []
        for step, lanes in enumerate(running.tolist()):
            byte = data[first[:lanes] + step].astype(np.int64)
            now = state[:lanes]
            after = self.base[now] + byte
            open_lanes = np.flatnonzero(self.check[after] != now)
            while len(open_lanes):
                at_root = now[open_lanes] == 0
                after[open_lanes[at_root]] = 0
                open_lanes = open_lanes[~at_root]
                now[open_lanes] = self.fail[now[open_lanes]]
                after[open_lanes] = self.base[now[open_lanes]] + byte[open_lanes]
                open_lanes = open_lanes[self.check[after[open_lanes]] != now[open_lanes]]
            state[:lanes] = after
            ending = np.flatnonzero(self.hit[after] >= 0)
            if len(ending):
                hits.append(np.stack([text[ending], self.hit[after[ending]]]))
        return self._patterns(hits, len(lengths))

    def _patterns(self, hits: list[np.ndarray], n_texts: int) -> tuple[np.ndarray, np.ndarray]:
        """The patterns that end in the states met, and in their suffixes."""
        size = len(self.base)
        texts, numbers = [np.repeat(np.arange(n_texts), len(self.everywhere))], [np.tile(self.everywhere, n_texts)]
        seen = np.unique(np.concatenate([t * size + s for t, s in hits])) if hits else np.zeros(0, np.int64)
        while len(seen):
            slots = seen % size
            counts = self.counts[slots]
            texts.append(np.repeat(seen // size, counts))
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            numbers.append(self.numbers[np.repeat(self.firsts[slots], counts) + within])
            shorter = self.shorter[slots]
            seen = np.unique((seen - slots + shorter)[shorter >= 0])
        pairs = np.unique(np.stack([np.concatenate(texts), np.concatenate(numbers)]), axis=1)
        return pairs[0], pairs[1]


def _failures(children: list[dict[int, int]]) -> tuple[list[int], list[int]]:
    """Nodes from the root downward, and the longest proper suffix of each that is a node."""
    fail, order, waiting = [0] * len(children), [], deque([0])
    while waiting:
        node = waiting.popleft()
        order.append(node)
        for byte, child in children[node].items():
            if node:
                below = fail[node]
                while below and byte not in children[below]:
                    below = fail[below]
                fail[child] = children[below].get(byte, 0)
            waiting.append(child)
    return order, fail
