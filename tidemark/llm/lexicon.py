"""Minimal acyclic transducer of words: shared prefixes and suffixes, numbers as outputs.

Sorted words are added one by one; states that can no longer change are merged with an equal one.
An arc carries how many words are passed over by taking it, so the sum along a word's path is its
rank, whatever suffixes it shares. Tables are flat arrays, made to be memory-mapped.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


def _minimal_states(words: Sequence[bytes]) -> tuple[list[tuple[bool, tuple]], int]:
    """([(final, ((byte, state), ...))], start) for sorted distinct words; a state's targets come first."""
    known: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []

    def settle(final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    path: list[list] = [[False, []]]  # of the last word: final, arcs that are settled
    last = b""
    for word in [*words, None]:
        common = 0
        if word is not None:
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
        for depth in range(len(last), common, -1):
            final, arcs = path.pop()
            path[-1][1].append((last[depth - 1], settle(final, arcs)))
        if word is None:
            break
        path += [[False, []] for _ in range(len(word) - common)]
        path[-1][0] = True
        last = word
    return states, settle(*path[0])


@dataclass
class Lexicon:
    """next and skip are (states x symbols); a missing arc leads to state 0, which has no arcs.
    Word number w has the outputs `ids[at[w]:at[w + 1]]`."""

    symbol: np.ndarray
    next: np.ndarray
    skip: np.ndarray
    final: np.ndarray
    at: np.ndarray
    ids: np.ndarray
    start: int

    def ranks(self, words: Sequence[bytes]) -> np.ndarray:
        """Number of each word, -1 where the lexicon doesn't have it; all words take a step at once."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = self.symbol[np.frombuffer(b"".join(words), np.uint8)]
        begin = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        begin, length = begin[order], sizes[order]
        state = np.full(len(words), self.start, np.int64)
        rank = np.zeros(len(words), np.int64)
        width = self.next.shape[1]
        step, n = 0, int(np.searchsorted(-length, 0, "left"))
        while n:
            cell = state[:n] * width + data[begin[:n] + step]
            rank[:n] += self.skip.ravel()[cell]
            state[:n] = self.next.ravel()[cell]
            step += 1
            n = int(np.searchsorted(-length, -step, "left"))
        out = np.empty(len(words), np.int64)
        out[order] = np.where(self.final[state], rank, -1)
        return out


def compile_lexicon(entries: dict[bytes, Sequence[int]]) -> Lexicon:
    words = sorted(w for w in entries if w)
    states, start = _minimal_states(words)
    used = sorted({b for w in words for b in w})
    symbol = np.zeros(256, np.uint8)
    symbol[used] = np.arange(1, len(used) + 1)
    shape = (len(states) + 1, len(used) + 1)
    next_, skip = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
    final, below = np.zeros(len(states) + 1, bool), np.zeros(len(states) + 1, np.int64)
    for number, (is_final, arcs) in enumerate(states, 1):
        final[number] = is_final
        passed = int(is_final)
        for byte, target in arcs:
            next_[number, symbol[byte]] = target + 1
            skip[number, symbol[byte]] = passed
            passed += int(below[target + 1])
        below[number] = passed
    sizes = np.array([len(entries[w]) for w in words], np.int64)
    ids = np.array([i for w in words for i in entries[w]], np.uint32)
    return Lexicon(symbol, next_, skip, final, np.concatenate([[0], np.cumsum(sizes)]), ids, start + 1)


def pack(lexicon: Lexicon) -> list[tuple[str, tuple, bytes]]:
    """Plain values, small enough to be broadcast: the word list they are made from is bounded."""
    parts = [("start", (1,), np.array([lexicon.start]))]
    parts += [(name, value.shape, value) for name, value in vars(lexicon).items() if name != "start"]
    return [(name, (str(v.dtype), shape), v.tobytes()) for name, shape, v in parts]


def mapped(parts: list[tuple[str, tuple, bytes]]) -> Lexicon:
    """The lexicon, memory-mapped from an unnamed file of the worker that goes with the mapping."""
    arrays = {}
    with tempfile.TemporaryFile() as file:
        places = []
        for name, (kind, shape), data in parts:
            file.write(b"\0" * (-file.tell() % 64))
            places.append((name, kind, shape, file.tell()))
            file.write(data)
        file.flush()
        for name, kind, shape, place in places:
            empty = 0 in shape
            arrays[name] = np.zeros(shape, kind) if empty else np.memmap(file, kind, "r", place, shape)
    return Lexicon(**{**arrays, "start": int(arrays["start"][0])})
