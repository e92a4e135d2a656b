"""Linear-chain conditional random field over word-shape features, in numpy batches."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

LABELS = ("", "email", "ip", "card", "phone")

_UNIT = re.compile(r"[0-9]+|[A-Za-z\x80-\U0010ffff]+|.", re.DOTALL)
_TRAILING = re.compile(r"[^0-9A-Za-z)\x80-\U0010ffff]+$")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}$")
_DIGITS = re.compile(r"[0-9]")

#: Words that say something about the number or name beside them.
CUES = frozenset(
    "at call card dot email fax ip isbn mail no order page phone server tel token total version year".split()
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit)
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _bucket(count: int) -> str:
    for limit in (1, 2, 3, 4, 6, 8, 12, 19):
        if count <= limit:
            return str(limit)
    return "more"


def shape(word: str) -> str:
    """9 and a for runs of digits and letters with their length class, other characters as they are."""
    units = []
    for unit in _UNIT.findall(word):
        if "0" <= unit[0] <= "9":
            units.append("9" + _bucket(len(unit)))
        elif unit.isalpha() or unit[0] >= "\x80":
            units.append("a" + ("1" if len(unit) == 1 else "+"))
        elif not (len(units) > 1 and units[-1] == units[-2] == unit):
            units.append(unit)
    return "".join(units)


def word_features(words: list[str]) -> list[list[str]]:
    """Features of every word of a sequence, with those of its neighbours."""
    own, digit_runs, run = [], [0] * len(words), []
    cores = [_TRAILING.sub("", w) for w in words]
    for place, core in enumerate([*cores, ""]):
        if core and core.replace("-", "").isdecimal() and core.isascii():
            run.append(place)
            continue
        if run:
            digits = "".join(cores[p] for p in run).replace("-", "")
            valid = 13 <= len(digits) <= 19 and luhn(digits)
            for p in run:
                digit_runs[p] = f"run={_bucket(len(digits))}{'luhn' if valid else ''}"
            run = []
    for word, core, digits in zip(words, cores, digit_runs):
        found = [f"shape={shape(core)}"]
        if digits:
            found.append(digits)
        if len(core) < len(word):
            found.append("ends")
        if "@" in core:
            found.append("@." if "." in core.rpartition("@")[2].strip(".") and core[0] != "@" else "@")
        if core[:1] in ("+", "("):
            found.append("opens" + core[0])
        if _DOTTED.match(core):
            found.append("octets" if all(len(p) < 4 and int(p) <= 255 for p in core.split(".")) else "not octets")
        cue = core.strip("[]():.,").lower()
        if cue in CUES:
            found.append(f"cue={cue}")
        elif not _DIGITS.search(core):
            found.append("plain")
        own.append(found)
    result = []
    for place, found in enumerate(own):
        before = own[place - 1] if place else ["edge"]
        after = own[place + 1] if place + 1 < len(own) else ["edge"]
        result.append([*found, *("<" + f for f in before), *(">" + f for f in after), "bias"])
    return result


@dataclass
class Crf:
    names: dict[str, int]
    weights: np.ndarray  # feature x label; the last row, zeros, is for features not seen in training
    moves: np.ndarray  # label x next label

    def emissions(self, sequences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Padded label scores (sequence, place, label) and the lengths."""
        lengths = np.array([len(s) for s in sequences])
        unknown = len(self.weights) - 1
        ids, owners = [], []
        for row, words in enumerate(sequences):
            for place, found in enumerate(word_features(words)):
                numbers = [self.names[f] for f in found if f in self.names]
                ids += numbers or [unknown]
                owners += [(row, place)] * max(1, len(numbers))
        scores = np.zeros((len(sequences), int(lengths.max(initial=0)), len(LABELS)))
        if owners:
            at = np.array(owners)
            np.add.at(scores, (at[:, 0], at[:, 1]), self.weights[np.array(ids)])
        return scores, lengths

    def decode(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """The best labels of every sequence: Viterbi over all sequences of the batch at once."""
        scores, lengths = self.emissions(sequences)
        count, longest, size = scores.shape
        best = scores[:, 0] if longest else np.zeros((count, size))
        back = np.zeros((count, longest, size), dtype=np.int8)
        for place in range(1, longest):
            paths = best[:, :, None] + self.moves[None]
            back[:, place] = paths.argmax(axis=1)
            moved = paths.max(axis=1) + scores[:, place]
            # A sequence that has ended keeps its scores, and its labels point to themselves.
            ended = lengths <= place
            moved[ended] = best[ended]
            back[ended, place] = np.arange(size)
            best = moved
        labels = np.zeros((count, longest), dtype=np.int64)
        label = best.argmax(axis=1)
        for place in range(longest - 1, -1, -1):
            labels[:, place] = label
            label = back[np.arange(count), place, label]
        return [row[:n] for row, n in zip(labels, lengths)]


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    most = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - most).sum(axis=axis)) + most.squeeze(axis)


def train(table: list[tuple[list[str], list[int]]], rounds: int = 120, penalty: float = 0.02) -> Crf:
    """Fits a field to (words, labels) rows: gradient steps on the penalised likelihood, a rate per weight."""
    features = [word_features(words) for words, _ in table]
    names: dict[str, int] = {}
    for row in features:
        for found in row:
            for f in found:
                names.setdefault(f, len(names))
    size, count, longest = len(LABELS), len(table), max(len(words) for words, _ in table)
    owners = np.array([(r, p, names[f]) for r, row in enumerate(features) for p, found in enumerate(row) for f in found])
    mask = np.zeros((count, longest), dtype=bool)
    truth = np.zeros((count, longest, size))
    for r, (_, labels) in enumerate(table):
        mask[r, : len(labels)] = True
        truth[r, np.arange(len(labels)), labels] = 1
    weights, moves = np.zeros((len(names) + 1, size)), np.zeros((size, size))
    weight_squares, move_squares = np.full(weights.shape, 1e-8), np.full(moves.shape, 1e-8)
    true_moves = np.einsum("rpi,rpj->ij", truth[:, :-1], truth[:, 1:])
    for _ in range(rounds):
        scores = np.zeros((count, longest, size))
        np.add.at(scores, (owners[:, 0], owners[:, 1]), weights[owners[:, 2]])
        forward = np.empty_like(scores)
        forward[:, 0] = scores[:, 0]
        for p in range(1, longest):
            moved = _logsum(forward[:, p - 1, :, None] + moves[None], 1) + scores[:, p]
            forward[:, p] = np.where(mask[:, p, None], moved, forward[:, p - 1])
        total = _logsum(forward[:, -1], 1)
        backward = np.zeros_like(scores)
        pair = np.zeros((size, size))
        for p in range(longest - 2, -1, -1):
            ahead = moves[None] + (scores[:, p + 1] + backward[:, p + 1])[:, None, :]
            inside = mask[:, p + 1, None]
            backward[:, p] = np.where(inside, _logsum(ahead, 2), backward[:, p + 1])
            both = np.exp(forward[:, p, :, None] + ahead - total[:, None, None])
            pair += (both * mask[:, p + 1, None, None]).sum(axis=0)
        likely = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
        slope = np.zeros_like(weights)
        np.add.at(slope, owners[:, 2], (truth - likely)[owners[:, 0], owners[:, 1]])
        slope -= penalty * weights
        move_slope = true_moves - pair - penalty * moves
        weight_squares += slope**2
        move_squares += move_slope**2
        weights += 0.5 * slope / np.sqrt(weight_squares)
        moves += 0.5 * move_slope / np.sqrt(move_squares)
    return Crf(names, weights, moves)
