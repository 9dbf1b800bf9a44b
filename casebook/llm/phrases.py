"""Document fingerprints from Lempel-Ziv phrases.

A document is parsed into dictionary phrases: each is the shortest run of characters that is not
yet a phrase. Documents that compress each other well share phrases. The fingerprint keeps the
smallest hashes of the phrase set; of two fingerprints the smallest hashes of both together, and
how many of them occur in both, estimate the Jaccard similarity of the phrase sets.
"""

from __future__ import annotations

import numpy as np

from casebook.llm.common import mixed

#: Hashes of a fingerprint.
KEPT = 64
#: Bits of a dictionary key that hold the letter; the others hold the number of the phrase before it.
LETTER_BITS = 21
#: Base of the phrases' hashes.
BASE = 0x9E3779B97F4A7C15


class Parse:
    """The phrases of a text so far; parsing goes on where it stopped.

    The dictionary is flat: the number of a phrase by the number of the phrase without its last
    letter and that letter. Phrases are numbered from 1 in the order they are met, so its keys, in
    order, tell how each continues an earlier one.
    """

    def __init__(self):
        self.found: dict[int, int] = {}
        self.node = 0

    def feed(self, text: str) -> None:
        """Parses further text. Its end, if it completes no phrase, equals a phrase that is there already."""
        found, node = self.found, self.node
        number, step, get = len(found) << LETTER_BITS, 1 << LETTER_BITS, found.get
        for letter in letters(text):
            key = node + letter
            node = get(key, 0)
            if not node:
                number += step
                found[key] = number
        self.node = node

    def mark(self) -> tuple[int, int]:
        return self.node, len(self.found)

    def back(self, mark: tuple[int, int]) -> None:
        """Undoes what was parsed since the mark."""
        self.node, n = mark
        for _ in range(len(self.found) - n):
            self.found.popitem()

    def hashes(self) -> np.ndarray:
        """The smallest ``KEPT`` distinct 32-bit hashes of the phrases, sorted.

        A phrase's hash is a polynomial of its letters; phrases take over what the phrases they
        continue have, in steps that double.
        """
        keys = np.fromiter(self.found, np.int64, len(self.found))
        before = np.concatenate((np.zeros(1, np.int64), keys >> LETTER_BITS))
        value = np.zeros(len(before), np.uint64)
        value[1:] = mixed((keys & (1 << LETTER_BITS) - 1).astype(np.uint64) + np.uint64(1))
        power = BASE
        while before.any():
            value += value[before] * np.uint64(power)
            before = before[before]
            power = power * power & (1 << 64) - 1
        marks = (mixed(value[1:] + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
        if len(marks) > 4 * KEPT:
            least = np.unique(np.partition(marks, 2 * KEPT)[: 2 * KEPT])
            if len(least) >= KEPT:
                return least[:KEPT]
        return np.unique(marks)[:KEPT]


def letters(text: str) -> bytes | list[int]:
    """The code points of a text."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").tolist()


def fingerprint(text: str) -> np.ndarray:
    """The fingerprint of a whole text; empty for the empty text."""
    parse = Parse()
    parse.feed(text)
    return parse.hashes()


def shown(marks: np.ndarray) -> str:
    """A fingerprint as hexadecimal digits, 8 for each hash."""
    return marks.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated similarity of two phrase sets, 0 to 1: 1 for equal fingerprints, empty ones too."""
    both = np.union1d(a, b)[:KEPT]
    if not len(both):
        return 1.0
    return float(np.isin(both, a).__and__(np.isin(both, b)).sum()) / len(both)


def edited_pair(text: str, other: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Fingerprints of a text and of its edited text, and that text.

    The edited text has the last half of the characters (rounded down) replaced by the first as
    many of the other text, or all of it. The common beginning is parsed once.
    """
    half = len(text) // 2
    begin, end, tail = text[: len(text) - half], text[len(text) - half :], other[:half]
    parse = Parse()
    parse.feed(begin)
    mark = parse.mark()
    parse.feed(end)
    own = parse.hashes()
    parse.back(mark)
    parse.feed(tail)
    return own, parse.hashes(), begin + tail
