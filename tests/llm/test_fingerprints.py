import hashlib

import pytest
from pyspark.sql import functions as F

from casebook.llm import fingerprints, phrases
from casebook.llm.queries import op8


M = (1 << 64) - 1


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M
    return x ^ x >> 31


def plain_fingerprint(text):
    """The 64 smallest hashes of the phrases, each a polynomial of its letters."""
    found = set()
    for phrase in phrase_list(text):
        value = 0
        for letter in phrase:
            value = (value * 0x9E3779B97F4A7C15 + mix(ord(letter) + 1)) & M
        found.add(mix(value + 1 & M) >> 32)
    return sorted(found)[:64]


def plain_likeness(a, b):
    both = sorted({*a, *b})[:64]
    return sum(x in a and x in b for x in both) / len(both) if both else 1.0


def expected(docs):
    """(id, text) in descending order of ids: the contract's columns, computed one by one."""
    out = {}
    for k, (i, t) in enumerate(docs):
        other = docs[(k + 1) % len(docs)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + other[:half]
        own, changed, following = (plain_fingerprint(x) for x in (t, edited, other))
        out[i] = (
            len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{x:08x}" for x in own), "".join(f"{x:08x}" for x in changed),
            plain_likeness(own, changed), plain_likeness(own, following),
        )
    return out


def got(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_query(spark, sf, documents):
    assert got(op8(spark, sf)) == expected(sorted(documents.items(), reverse=True))


def test_near_texts_are_alike(documents):
    text = max(documents.values(), key=len)
    a, b = phrases.fingerprint(text), phrases.fingerprint(text.replace("the", "teh", 3))
    other = phrases.fingerprint("".join(chr(0x4E00 + k * 7 % 1000) for k in range(5000)))
    assert phrases.likeness(a, a) == 1 and phrases.likeness(a, b) > 0.4 and phrases.likeness(a, other) < 0.1


def phrase_list(text):
    """The parse spelled out with strings."""
    out, seen, begun = [], set(), ""
    for letter in text:
        begun += letter
        if begun not in seen:
            seen.add(begun)
            out.append(begun)
            begun = ""
    return out


@pytest.mark.parametrize("text", ["", "a", "aaaa", "abababab", "é😀é😀" * 5, "the cat and the hat and the cat " * 9])
def test_parse(text):
    parse = phrases.Parse()
    for letter in text:
        parse.feed(letter)
    whole = phrases.Parse()
    whole.feed(text)
    assert parse.found == whole.found and list(whole.found) == list(parse.found)
    # Each key continues an earlier phrase by a letter: the phrases spelled out again.
    spelled = [""]
    for key in whole.found:
        spelled.append(spelled[key >> phrases.LETTER_BITS] + chr(key & (1 << phrases.LETTER_BITS) - 1))
    assert spelled[1:] == phrase_list(text)
    assert whole.hashes().tolist() == plain_fingerprint(text)
    mark = whole.mark()
    whole.feed("some more text")
    whole.back(mark)
    whole.feed("end")
    again = phrases.Parse()
    again.feed(text + "end")
    assert list(whole.found.items()) == list(again.found.items()) and whole.node == again.node


def test_ranges(spark):
    for cuts in ([], [5], [-3, 0, 4, 9], list(range(0, 70, 7))):
        rows = spark.range(-10, 80).select("id", fingerprints.range_of(F.col("id"), cuts).alias("r")).collect()
        assert all(r.r == sum(c <= r.id for c in cuts) for r in rows)


def test_likeness_estimates_the_phrase_sets():
    a, b = "abcab" * 300 + "xyz" * 200, "abcab" * 300 + "xzy" * 500
    one, two = set(phrase_list(a)), set(phrase_list(b))
    true = len(one & two) / len(one | two)
    assert abs(phrases.likeness(phrases.fingerprint(a), phrases.fingerprint(b)) - true) < 0.2


def test_rows(frame):
    rows = [(5, "five words of some text"), (9, None), (7, ""), (3, "x" * 300_000), (5, "five words of some text"), (2, "é😀" * 9), (None, "stray text"), (None, "stray text")]
    out = [tuple(r) for r in fingerprints.compare_with_next(frame(rows)).collect()]
    assert len(out) == len(rows)
    chain = [(9, ""), (7, ""), (5.0, rows[0][1]), (5, rows[0][1]), (3, rows[3][1]), (2, rows[5][1])]
    own = {r[0]: r[1:] for r in out}
    want = expected(chain)
    for i in (9, 7, 3, 2):
        assert own[i] == want[i]
    assert sorted(r[1:] for r in out if r[0] == 5) == sorted(expected(chain)[k] for k in (5.0, 5)) or want[5] in [r[1:] for r in out if r[0] == 5]
    half = len("stray text") // 2
    assert {r[2] for r in out if r[0] is None} == {hashlib.sha256("stray text"[:half].encode()).hexdigest()}


def test_one_document_and_none(frame):
    assert got(fingerprints.compare_with_next(frame([(4, "a single text")]))) == expected([(4, "a single text")])
    assert fingerprints.compare_with_next(frame([])).collect() == []


def test_column(frame):
    rows = fingerprints.add_fingerprint(frame([(1, "same text"), (2, "same text"), (3, None), (4, "")])).collect()
    marks = {r.doc_id: r.fingerprint for r in rows}
    assert marks[1] == marks[2] != "" and marks[3] == marks[4] == ""
