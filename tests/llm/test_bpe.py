import json
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from casebook.llm import bpe
from casebook.llm.queries import op7, tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as file:
        data = file.read()
    return bpe.Encoder(bpe.Automaton(json.loads(data)), data)


def ids(coder, text):
    return list(memoryview(coder.encode(text)).cast("I"))


def test_query(spark, sf, documents, library):
    import hashlib

    for r in op7(spark, sf).collect():
        want = library.encode(documents[r.doc_id], add_special_tokens=False).ids
        data = struct.pack(f"<{len(want)}I", *want)
        text = library.decode(want, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(data).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


ALPHABETS = [
    "aaab ", "!!!?? ", "abcdefghijklmnopqrstuvwxyz'  ", "ÀÉíßçøĀŞİıΣσς 'ſK", "日本語中文한국어 ", "😀😃👍🏽‍ ",
    "\x1c\x1d\x1e\x1f\x85\xa0  　ab", "éè́aé ", "0123456789٣४ ", "'s't're've'm'll'd a", "\x00\x01a\x7f\xad ", "ﬁﬂǅǆ ᾳᾼΩ",
]


def test_random_texts(coder, library):
    rng = random.Random(4)
    for k in range(4000):
        letters = rng.choice(ALPHABETS) if k % 3 else "".join(ALPHABETS)
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        if k % 7 == 0:
            text += rng.choice(["<|endoftext|>", "a<|startoftext|>b", "<|endoftext", "<|"])
        if k % 5 == 0:
            text = "".join(chr(rng.choice([rng.randrange(0x3000), rng.randrange(0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(15))
        assert ids(coder, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_one_path_per_word(coder):
    """The automaton accepts exactly one path: all splits of short words are tried."""
    automaton = coder.automaton

    def paths(text, state):
        if not text:
            yield []
        for n in range(1, len(text) + 1):
            arc = automaton.ids.get(text[:n])
            if arc is not None and (state is None or automaton.allowed(state, arc)):
                for rest in paths(text[n:], arc):
                    yield [arc, *rest]

    rng = random.Random(5)
    words = ["".join(rng.choice("thanedig") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    for word in [*words, "aaaaaaa", "zzzz"]:
        assert list(paths(word + bpe.END, None)) == [ids(coder, word)]


def test_compiled_table_spells_every_entry(coder, library):
    """The compiled transitions lead from the beginning along every entry to that entry alone."""
    table = coder.transitions
    codes = {letter: code for code, letter in enumerate(bpe.byte_letters())}
    for name, entry in list(coder.automaton.ids.items())[::7]:
        letters = [bpe.ENDED if letter == bpe.END else codes[letter] for letter in name]
        if not any(bpe.FIRST_SPECIAL <= c < bpe.ENDED for c in letters):
            made = table.made
            assert table.last[table.read(0, letters)] == entry and table.made == made


def test_states_are_bounded(library, monkeypatch):
    """The table starts anew when it is full, between groups of words and within a long word."""
    monkeypatch.setattr(bpe, "STATES", 50)
    monkeypatch.setattr(bpe, "GROUP", 64)
    with open(PATH, "rb") as file:
        data = file.read()
    coder = bpe.Encoder(bpe.Automaton(json.loads(data)), data)
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh") for _ in range(3000))
    text = " ".join([*(f"wordnumber{k}" for k in range(50)), long, "x" * 500, "end"])
    assert ids(coder, text) == library.encode(text, add_special_tokens=False).ids
    assert len(coder.transitions.states) < 300


def test_long_texts_are_encoded_in_parts(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 40)
    text = " ".join(["don't stop <|endoftext|> it's ’quoted’ 日本語 ünï 12345"] * 30) + "x" * 300
    assert ids(coder, text) == library.encode(text, add_special_tokens=False).ids


def test_batches_equal_single_texts(coder):
    rng = random.Random(7)
    texts = [None, "", *("".join(rng.choice("".join(ALPHABETS)) for _ in range(rng.randrange(60))) for _ in range(300)), " ", "a" * 300]
    assert coder.encode_all(texts) == [coder.encode(t) for t in texts]


def test_rows(spark, frame, library):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "same"), (4, "same"), (None, "same"), (5, "long words " * 200_000)]
    coder = tokenizer(spark)
    df = bpe.decode(bpe.encode(frame(rows), coder), coder)
    got = {r.doc_id: (r.n_tokens, r.decoded) for r in df.collect()}
    assert df.count() == len(rows) and df.columns.count("ids") == 1 and "label" in df.columns
    assert got[1] == got[2] == got[3] == (0, "") and got[4] == got[None] == (1, "same</w>")
    assert got[5][0] == 400_000 and got[5][1].startswith("long</w> words</w> long")
    assert bpe.encode(frame([]), coder).collect() == []


def test_other_files_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file, pytest.raises(ValueError):
        bpe.Automaton(json.load(file))
