"""Minimal acyclic transducer from words to id lists, as flat arrays that can be memory-mapped.

Words with equal continuations share states. A word's number is the sum of the skips on its path,
which leaves the outputs out of the states, so that suffixes are shared whatever the ids are.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

_PARTS = (("edges", np.uint64), ("targets", np.int32), ("skips", np.int32), ("final", np.uint8), ("ends", np.int64), ("ids", np.uint32))


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file of a lexicon; `entries` are sorted by word, words are distinct and not empty."""
    known: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((byte, state), ...))
    path: list[list] = [[False, []]]  # states still open: [final, edges]
    before, ends, ids = b"", [0], []

    def close(down_to: int) -> None:
        while len(path) > down_to:
            final, edges = path.pop()
            key = (final, tuple(edges))
            if key not in known:
                known[key] = len(states)
                states.append(key)
            path[-1][1].append((before[len(path) - 1], known[key]))

    for word, found in entries:
        common = 0
        while common < min(len(before), len(word)) and before[common] == word[common]:
            common += 1
        close(common + 1)
        path.extend([False, []] for _ in word[common:])
        path[-1][0] = True
        before = word
        ids.extend(found)
        ends.append(len(ids))
    close(1)
    states.append((False, tuple(path[0][1])))  # the start
    words_from = np.zeros(len(states), dtype=np.int64)
    edges, targets, skips = [], [], []
    for number, (final, out) in enumerate(states):
        count = int(final)
        for byte, target in out:
            edges.append(number << 8 | byte)
            targets.append(target)
            skips.append(count)
            count += int(words_from[target])
        words_from[number] = count
    arrays = [edges, targets, skips, [final for final, _ in states], ends, ids]
    parts = [np.array(a, dtype=kind).tobytes() for a, (_, kind) in zip(arrays, _PARTS)]
    padded = [p + bytes(-len(p) % 8) for p in parts]
    return struct.pack("<6q", *map(len, parts)) + b"".join(padded)


class Lexicon:
    def __init__(self, path: str):
        """Maps the file; nothing is read before it is used."""
        whole = np.memmap(path, dtype=np.uint8, mode="r")
        at = 48
        for (name, kind), size in zip(_PARTS, struct.unpack("<6q", bytes(whole[:48]))):
            setattr(self, name, whole[at : at + size].view(kind))
            at += size + -size % 8
        self.start = len(self.final) - 1

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The numbers of the words data[start:end], -1 for unknown ones; all words step together."""
        result = np.full(len(starts), -1, dtype=np.int64)
        alive = np.arange(len(starts))
        if not len(self.edges):
            return result
        state = np.full(len(starts), self.start, dtype=np.uint64)
        number = np.zeros(len(starts), dtype=np.int64)
        place = starts.astype(np.int64)
        while len(alive):
            wanted = state[alive] << np.uint64(8) | data[place[alive]].astype(np.uint64)
            edge = np.searchsorted(self.edges, wanted)
            edge[edge == len(self.edges)] = 0
            hit = self.edges[edge] == wanted
            alive, edge = alive[hit], edge[hit]
            state[alive] = self.targets[edge]
            number[alive] += self.skips[edge]
            place[alive] += 1
            done = place[alive] == ends[alive]
            over = alive[done]
            accepted = over[self.final[state[over].astype(np.int64)] == 1]
            result[accepted] = number[accepted]
            alive = alive[~done]
        return result
