"""BPE encoding and decoding with a tokenization automaton.

The automaton is compiled from the merges in order. Its arcs carry vocabulary entries; a path spells
a word, and exactly one path of each word is accepted: its BPE encoding. The gadget of merge
``u + v -> w``

* cuts the arc ``v`` out of the state that ``u`` enters,
* adds an arc ``w`` wherever there is an arc ``u`` at that time, and
* lets ``w`` enter a copy of the state that ``v`` enters at that time.

A copied state shares the rows of the state it was copied from, but for the cuts made since
(``Automaton``). ``Transitions`` makes it deterministic over letters: a table from (state, letter) to
state, filled entry by entry in the order of the merges when the encoder is made, and later for
contexts that no entry spells when they are first met. A state also says which entry the encoding of
what was read ends with. So encoding is one pass with one look-up for each letter, for all words of a
batch at once, and the entries are then read off from each word's end.
"""

from __future__ import annotations

import functools
import itertools
import json
import pickle
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer as Library

from casebook.llm.common import with_columns

#: Stands for the suffix of word-final entries; no byte maps to it.
END = "\x00"
#: Letters beside the bytes of a word: its end, and bytes that no UTF-8 text holds, which stand for special entries.
ENDED, FIRST_SPECIAL = 256, 0xF8
#: Letters that are encoded at once; a longer text is handled alone, its words in such groups.
GROUP = 1 << 17
#: Spreads the keys of transitions.
SPREAD = 0x9E3779B97F4A7C15
#: States that are kept; beyond them the table starts anew before the next group, which adds at most a state a letter.
STATES = 300_000
#: Nodes of states after a special entry, and after a word's end.
SPECIAL, DONE = -1, -2
#: Letters of a word after which it is read by itself.
LONG = 96
#: Below this, which characters are letters does not depend on the version of Unicode.
STABLE = "\u0250"


#: The supported split pattern: contractions, runs of letters, single digits, runs of anything else but white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTED = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
#: Kinds of bytes: between words, letters, digits, anything else, and bytes of words that are split already.
GAP, LETTER, DIGIT, OTHER, SPLIT = range(5)
#: Parts words that are split already; no UTF-8 text holds it.
PARTED = b"\xff"
#: Characters after which a long text is encoded in parts, cut at the next space.
PART = 1 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class Automaton:
    """Automaton and pre-splitting of a tokenizer file.

    Supported: byte-level BPE with an end-of-word suffix, the normalizers NFC, white space and
    lower case, a split pattern, special entries that are matched as they are, and no decoder. Other
    files raise ``ValueError``.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a lower-cased byte-level BPE with word ends")
        if spec.get("decoder") or any(t.get(k) for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "normalized", "single_word")):
            raise ValueError("a decoder, or special entries that are not matched as they are")
        if len(spec["added_tokens"]) > ENDED - FIRST_SPECIAL:
            raise ValueError(f"more than {ENDED - FIRST_SPECIAL} special entries")
        suffix = model["end_of_word_suffix"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = split["pattern"]["Regex"]
        if self.pattern != PATTERN:
            raise ValueError("another split pattern")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        inner = lambda t: t[: -len(suffix)] + END if t.endswith(suffix) else t
        self.ids = {inner(t): i for t, i in model["vocab"].items()}
        self.cuts: dict[int, int] = {}
        self.size = max(self.labels) + 1
        self.born: dict[int, int] = {}
        self.state_of: dict[int, int] = {}
        self.arc_of: dict[int, int] = {}
        for k, pair in enumerate(model["merges"]):
            u, v = pair.split(" ") if isinstance(pair, str) else pair
            self.add_gadget(k, self.ids[inner(u)], self.ids[inner(v)], self.ids[inner(u) + inner(v)])

    def add_gadget(self, k: int, u: int, v: int, w: int) -> None:
        """Merge number k, of u and v to w."""
        self.cuts[u * self.size + v] = k
        if w not in self.born:
            self.born[w], self.arc_of[w], self.state_of[w] = k, u, v

    def allowed(self, state: int, arc: int) -> bool:
        """Whether the finished automaton has this arc out of this state.

        The arc is missing if some cut reached it: one of the state, or of a state it was copied
        from before the copy, against the arc, or an arc it was added beside. A cut of the very
        merge that made the arc counts: runs of one letter pair from the left.
        """
        cuts, born, size = self.cuts.get, self.born, self.size
        made = late = len(self.cuts)
        while True:
            over, other, row = late, arc, state * size
            while True:
                k = cuts(row + other, late)
                if k < made and k <= over:
                    return False
                if other not in born:
                    break
                over, other = born[other], self.arc_of[other]
            if state not in born:
                return True
            made, state = born[state], self.state_of[state]


class Transitions:
    """The automaton over letters: a table from (state, letter) to state.

    After some letters of a word, only the entries still in reach matter: those that begin with a
    suffix of what was read. The suffixes that begin entries are a node of a trie of the entries and
    the nodes its suffix links lead to. A state is such a node, and for it and each node down its links
    the entry that the encoding of all before that suffix ends with (-1 at the word's beginning). The
    next letter completes entries; exactly one of them may, by the automaton, follow the entry before
    it. State 0 is the word's beginning; ``last`` holds the entry a state's encoding ends with.

    Transitions lie in two arrays, ``keys`` and ``targets``, at a place that their state and letter
    give (open addressing). Those that spell the entries are made in the order of the merges; for the
    file of the queries they are 111,039 in arrays of 3 MB. Others are made when they are first met.
    """

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        codes = {letter: code for code, letter in enumerate([*byte_letters(), END])}
        codes[END] = ENDED
        named = {name: [codes[letter] for letter in name] for name in automaton.ids}
        # Bytes from FIRST_SPECIAL on occur in no text.
        named = {name: letters for name, letters in named.items() if not any(FIRST_SPECIAL <= c < ENDED for c in letters)}
        self.span = np.full(automaton.size, 2, np.int64)
        self.special = {FIRST_SPECIAL + k: i for k, i in enumerate(automaton.special.values())}
        self.below: dict[int, int] = {}
        self.entry: dict[int, int] = {}
        spelled = sorted((automaton.ids[name], letters) for name, letters in named.items())
        nodes = 1
        for i, letters in spelled:
            self.span[i] = len(letters)
            node = 0
            for letter in letters:
                child = self.below.setdefault(node << 9 | letter, nodes)
                nodes += child == nodes
                node = child
            self.entry[node] = i
        self.inner = {key >> 9 for key in self.below}
        self.links = self.suffix_links(nodes)
        self.ready: dict[int, bool] = {}
        self.restart()
        for _, letters in spelled:
            self.read(0, letters)

    def suffix_links(self, nodes: int) -> list[tuple[int, ...]]:
        """For each node itself and the nodes its suffix links lead to, the longest first, the root last."""
        links: list[tuple[int, ...]] = [(0,)] * nodes
        # Children have larger numbers than their parents, but links lead to shorter ones: by depth.
        level = [(0, 0, 0)]
        children: dict[int, list[tuple[int, int]]] = {}
        for key, child in self.below.items():
            children.setdefault(key >> 9, []).append((key & 511, child))
        while level:
            after = []
            for _, node, _ in level:
                for letter, child in children.get(node, ()):
                    shorter = (self.below.get(n << 9 | letter) for n in links[node][1:])
                    link = next((n for n in shorter if n is not None and n in self.inner), 0) if node else 0
                    links[child] = (child, *links[link])
                    after.append((letter, child, node))
            level = after
        return links

    def restart(self) -> None:
        """The table with its first state only."""
        self.states: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.last = np.zeros(1024, np.int32)
        self.made = 0
        self.keys = np.full(1 << 12, -1, np.int64)
        self.targets = np.zeros(1 << 12, np.int32)
        self.state((0, -1))

    def state(self, found: tuple[int, ...]) -> int:
        number = self.numbers.setdefault(found, len(self.states))
        if number == len(self.states):
            self.states.append(found)
            if number == len(self.last):
                self.last = np.concatenate((self.last, np.zeros_like(self.last)))
            self.last[number] = found[-1]
        return number

    def slot(self, key: int) -> int:
        """Where a transition stands, or the free place where it belongs."""
        at, mask = (key * SPREAD & (1 << 64) - 1) >> 65 - len(self.keys).bit_length(), len(self.keys) - 1
        while self.keys.item(at) not in (key, -1):
            at = at + 1 & mask
        return at

    def read(self, state: int, letters: Iterable[int]) -> int:
        for letter in letters:
            at = self.slot(state << 9 | letter)
            state = self.make(state, letter, at) if self.keys.item(at) < 0 else self.targets.item(at)
        return state

    def make(self, state: int, letter: int, at: int) -> int:
        """Makes one transition."""
        node, *before = self.states[state]
        if FIRST_SPECIAL <= letter < ENDED:
            found: tuple[int, ...] = (SPECIAL, self.special[letter])
        elif node == SPECIAL:
            found = (DONE, before[0])
        else:
            found = self.after(node, before, letter)
        number = self.state(found)
        self.keys[at], self.targets[at] = state << 9 | letter, number
        self.made += 1
        if 2 * self.made > len(self.keys):
            self.grow()
        return number

    def after(self, node: int, before: list[int], letter: int) -> tuple[int, ...]:
        arc, kept = -1, []
        for shorter, entry in zip(self.links[node], before, strict=True):
            child = self.below.get(shorter << 9 | letter)
            if child is None:
                continue
            if child in self.inner:
                kept.append((child, entry))
            if arc < 0:
                found = self.entry.get(child, -1)
                if found >= 0 and (entry < 0 or self.fits(entry, found)):
                    arc = found
        if letter == ENDED:
            return DONE, arc
        return (kept[0][0] if kept else 0, *(entry for _, entry in kept), arc)

    def fits(self, entry: int, arc: int) -> bool:
        key = entry * self.automaton.size + arc
        found = self.ready.get(key)
        if found is None:
            if len(self.ready) >= STATES:
                self.ready.clear()
            found = self.ready[key] = self.automaton.allowed(entry, arc)
        return found

    def grow(self) -> None:
        kept = self.keys >= 0
        keys, targets = self.keys[kept], self.targets[kept]
        self.keys, self.targets = np.full(4 * len(self.keys), -1, np.int64), np.zeros(4 * len(self.keys), np.int32)
        for key, target in zip(keys.tolist(), targets.tolist(), strict=True):
            at = self.slot(key)
            self.keys[at], self.targets[at] = key, target

    def mark(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each letter the entry of its word's encoding that ends there, or -1."""
        marks, upto = np.full(len(letters), -1, np.int32), np.empty(len(letters), np.int32)
        group = np.cumsum(ends - starts) // GROUP
        edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
        for a, b in itertools.pairwise(edges):
            if len(self.states) > STATES:
                self.restart()
            self._mark(letters, starts[a:b], ends[a:b], upto, marks)
        return marks

    def _mark(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, upto: np.ndarray, marks: np.ndarray) -> None:
        sizes = np.minimum(ends - starts, LONG + 1)
        order = np.argsort((LONG + 1 - sizes).astype(np.uint8), kind="stable")
        starts, ends = starts[order], ends[order]
        # How many words are longer than each number of letters; they come first.
        longer = len(sizes) - np.cumsum(np.bincount(sizes, minlength=LONG + 2))
        state = np.zeros(len(sizes), np.int64)
        for j in range(min(LONG, int(sizes.max(initial=0)))):
            n = int(longer[j])
            at = starts[:n] + j
            state[:n] = after = self.step(state[:n], letters[at])
            upto[at] = self.last[after]
        n = int(longer[LONG])
        arc = np.empty(len(sizes), np.int32)
        after = self.step(state[n:], np.full(len(sizes) - n, ENDED))
        arc[n:] = self.last[after]
        rest = [self.states[k] for k in state[:n].tolist()]
        for k, found in enumerate(rest):
            at = int(starts[k]) + LONG
            upto[at : ends[k]], arc[k] = self.alone(found, letters[at : ends[k]].tolist())
        # Entry by entry from the end of each word.
        at, size = ends - 1, self.span[arc] - 1
        while len(at):
            marks[at] = arc
            at = at - size
            more = at >= starts
            at, starts = at[more], starts[more]
            arc = upto[at]
            size = self.span[arc]

    def alone(self, found: tuple, letters: list[int]) -> tuple[list[int], int]:
        """Reads the rest of a long word from a state on: the entries up to each letter, and of the whole."""
        state, out = self.state(found), []
        for letter in letters:
            if len(self.states) > 2 * STATES:
                found = self.states[state]
                self.restart()
                state = self.state(found)
            state = self.read(state, (letter,))
            out.append(self.last.item(state))
        state = self.read(state, (ENDED,))
        return out, self.last.item(state)

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states after one letter each."""
        key = state << 9 | letter
        at = ((key.view(np.uint64) * np.uint64(SPREAD)) >> np.uint64(65 - len(self.keys).bit_length())).view(np.int64)
        other = np.flatnonzero(self.keys[at] != key)
        while len(other):
            # The place is another transition's: the next one. A free place: the transition is made.
            free = self.keys[at[other]] < 0
            if free.any():
                for k in np.unique(key[other[free]]).tolist():
                    self.read(k >> 9, (k & 511,))
                return self.step(state, letter)
            at[other] = at[other] + 1 & len(self.keys) - 1
            other = other[self.keys[at[other]] != key[other]]
        return self.targets[at]


@functools.cache
def kinds() -> np.ndarray:
    """The kind of each character below ``STABLE`` and of those they become in lower case."""
    stable = [chr(c) for c in range(ord(STABLE))]
    shown = {c for letter in stable for c in letter.lower()} | set(stable)
    out = np.full(max(map(ord, shown)) + 1, OTHER, np.uint8)
    for c in shown:
        if _WHITE.fullmatch(c):
            out[ord(c)] = GAP
        elif regex.fullmatch(r"\p{L}", c):
            out[ord(c)] = LETTER
        elif regex.fullmatch(r"\p{N}", c):
            out[ord(c)] = DIGIT
    return out


def words_of(data: np.ndarray, split: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of lower-cased UTF-8 bytes, as the pattern parts them.

    The ranges ``split`` hold words that are parted by ``PARTED``. The other ranges hold no characters
    from ``STABLE`` on but those that lower case makes.
    """
    of = kinds()
    kind = np.concatenate((of[:128], np.full(127, OTHER, np.uint8), np.full(1, GAP, np.uint8)))[data]
    lead = np.flatnonzero((data >= 0xC0) & (data < FIRST_SPECIAL))
    if len(lead):
        code = ((data[lead] & 0x1F).astype(np.int64) << 6) | (data[lead + 1] & 0x3F)
        three = np.flatnonzero(data[lead] >= 0xE0)
        code[three] = ((code[three] & 0x3FF) << 6) | (data[np.minimum(lead[three] + 2, len(data) - 1)] & 0x3F)
        found = of[np.minimum(code, len(of) - 1)]
        kind[lead] = kind[lead + 1] = found
        kind[np.minimum(lead[three] + 2, len(data) - 1)] = found[three]
    for a, b in split:
        kind[a:b] = np.where(data[a:b] == PARTED[0], GAP, SPLIT)
    before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
    change = kind != before
    start = change | ((kind == DIGIT) & ((data & 0xC0) != 0x80))
    for p in np.flatnonzero((data == 0x27) & (kind == OTHER) & (before != OTHER)).tolist():
        after = data[p + 1 : p + 3].tobytes()
        for ending in CONTRACTED:
            if after.startswith(ending) and kind[p + 1] == LETTER:
                end = p + 1 + len(ending)
                start[p + 1 : end] = False
                if end < len(kind) and kind[end] == LETTER:
                    start[end] = True
                break
    start &= kind != GAP
    starts = np.flatnonzero(start)
    # A word ends where the next begins or a gap does.
    stops = np.flatnonzero(start | (change & (kind == GAP)))
    ends = np.append(stops, len(kind))[np.searchsorted(stops, starts, side="right")]
    return starts, ends


class Encoder:
    """Encodes and decodes texts with an automaton."""

    def __init__(self, automaton: Automaton, spec: bytes):
        self.automaton = automaton
        self.transitions = Transitions(automaton)
        self.spec = spec
        self.specials = re.compile("(" + "|".join(map(re.escape, automaton.special)) + ")") if automaton.special else None
        self.marker = {name: bytes((FIRST_SPECIAL + k,)) for k, name in enumerate(automaton.special)}
        self.byte = {letter: code for code, letter in enumerate(byte_letters())}
        self.names = [automaton.labels.get(i, "") for i in range(max(automaton.labels) + 1)]

    @functools.cached_property
    def splitter(self) -> Library:
        """The library's own normalizer and splitter, loaded when a text needs it."""
        return Library.from_str(self.spec.decode())

    def odd_words(self, text: str) -> bytes:
        """Text with letters that some versions of Unicode do not know, split as the library's version does."""
        normal = self.splitter.normalizer.normalize_str(text)
        return PARTED.join(bytes(map(self.byte.__getitem__, w)) for w, _ in self.splitter.pre_tokenizer.pre_tokenize_str(normal))

    def segments(self, text: str) -> list[tuple[bytes, bool]]:
        """A text as bytes of lower-cased words, and whether these are split already."""
        if not (self.specials and "<|" in text and self.specials.search(text)):
            if text.isascii():
                return [(text.lower().encode(), False)]
            if not _HIGH.search(text):
                return [(unicodedata.normalize("NFC", text).lower().encode(), False)]
        out: list[tuple[bytes, bool]] = []
        for k, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if k % 2:
                out.append((self.marker[part], True))
                continue
            plain: list[str] = []
            for piece in [*(_WHITE.split(part) if _SEPARATORS.search(part) else part.split()), None]:
                if piece is not None and (piece.isascii() or not _HIGH.search(piece)):
                    plain.append(piece)
                    continue
                if plain:
                    out.append((unicodedata.normalize("NFC", " ".join(plain)).lower().encode(), False))
                    plain = []
                if piece:
                    out.append((self.odd_words(piece), True))
        return out

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of texts as little-endian unsigned 32-bit integers. Null is an empty text."""
        out: list[bytes] = []
        held: list[bytes] = []
        split: list[tuple[int, int]] = []
        ends: list[int] = []
        size = 0

        def done() -> None:
            nonlocal held, split, ends, size
            out.extend(self._ids(PARTED.join(held), split, ends))
            held, split, ends, size = [], [], [], 0

        for text in texts:
            if not text:
                ends.append(size)
                continue
            if len(text) > PART and len(pieces := list(parts(text))) > 1:
                done()
                out.append(b"".join(map(self.encode, pieces)))
                continue
            for data, is_split in self.segments(text):
                held.append(data)
                if is_split:
                    split.append((size, size + len(data)))
                size += len(data) + 1
            ends.append(size)
            if size > GROUP:
                done()
        done()
        return out

    def _ids(self, data: bytes, split: list[tuple[int, int]], ends: list[int]) -> list[bytes]:
        letters = np.frombuffer(data, np.uint8)
        marks = self.transitions.mark(letters, *words_of(letters, split))
        at = np.flatnonzero(marks >= 0)
        ids = marks[at].astype("<u4").tobytes()
        cuts = [0, *(4 * np.searchsorted(at, ends)).tolist()]
        return [ids[a:b] for a, b in itertools.pairwise(cuts)]

    def encode(self, text: str | None) -> bytes:
        """The ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        """The labels of the arcs, parted by spaces; the file names no other decoder."""
        return " ".join(map(self.names.__getitem__, ids))


def parts(text: str) -> Iterator[str]:
    """A long text in parts that end at spaces, as far as it has any."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + PART) + 1 or len(text)
        yield text[at:end]
        at = end


# Python parts words at these four too; they are not white space in the pattern's sense.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WHITE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_HIGH = re.compile(f"[{STABLE}-\U0010ffff]")


@functools.lru_cache(maxsize=4)
def compiled(path: str) -> bytes:
    """The encoder of a tokenizer file, pickled. Its size follows from the vocabulary alone."""
    with open(path, "rb") as file:
        data = file.read()
    if len(data) > 64 << 20:
        raise ValueError("vocabulary files of over 64 MB are not broadcast")
    return pickle.dumps(Encoder(Automaton(json.loads(data)), data), protocol=5)


class Tokenizer:
    """A tokenizer file for use in tasks. It is compiled once, on the driver, and goes to the workers
    as a broadcast that does not grow with the data."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self.sent: Broadcast = spark.sparkContext.broadcast(compiled(path))

    def encoder(self) -> Encoder:
        """The worker's own encoder, kept between its tasks."""
        if self.path not in _ENCODERS:
            _ENCODERS[self.path] = pickle.loads(self.sent.value)
        return _ENCODERS[self.path]


_ENCODERS: dict[str, Encoder] = {}


def encode(df: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens") -> DataFrame:
    """Adds the ids of a text column (binary: little-endian unsigned 32-bit) and their number.

    One pass without a shuffle. Null and empty texts have no ids; texts are encoded whole, however
    long; equal texts get equal ids, repeated rows stay; an empty table stays empty. Other columns
    pass unchanged; columns of the added names are replaced.
    """

    def task():
        coder = tokenizer.encoder()

        def compute(texts):
            found = coder.encode_all(texts)
            return found, [len(f) // 4 for f in found]

        return compute

    return with_columns(df, [text], {ids: "binary", n_tokens: "long"}, task)


def decode(df: DataFrame, tokenizer: Tokenizer, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the text of a column of ids (binary as from ``encode``): the labels of the arcs.

    No ids give an empty text, null ids a null. Other columns pass unchanged; a column of the added
    name is replaced.
    """

    def task():
        coder = tokenizer.encoder()
        return lambda all_ids: ([None if b is None else coder.decode(memoryview(b).cast("I")) for b in all_ids],)

    return with_columns(df, [ids], {decoded: "string"}, task)
