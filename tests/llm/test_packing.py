import random
import struct
import zlib

import pytest
from tokenizers import Tokenizer as Library

from casebook.llm import packing
from casebook.llm.queries import op5


def check(rows, docs, window):
    """Every id in exactly one piece, sequences without gaps; returns the share of padding."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r[0], []).append((r.start, r.length, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == {k for k, v in docs.items() if v}
    for k, own in pieces.items():
        at = 0
        for start, length, total in sorted(own):
            assert start == at and length > 0 and total == len(docs[k])
            at += length
        assert at == len(docs[k])
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    used = sum(map(len, docs.values()))
    return 1 - used / (len(sequences) * window) if sequences else 0.0


def test_query(spark, sf, documents):
    import public_tokenizers

    library = Library.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = {k: [*library.encode(t, add_special_tokens=False).ids, 1] for k, t in documents.items()}
    rows = op5(spark, sf).collect()
    assert check(rows, docs, 2048) < 0.02
    for r in rows:
        part = docs[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))


@pytest.mark.parametrize(("parts", "open_windows", "merged"), [(1, 4, 1), (7, 8, 3), (3, 1, 16)])
def test_pieces(spark, parts, open_windows, merged):
    rng = random.Random(parts)
    docs = {k: [rng.randrange(1 << 32) for _ in range(rng.choice([0, 1, 5, 60, 63, 64, 65, 400]))] for k in range(500)}
    data = [(k, bytearray(struct.pack(f"<{len(v)}I", *v))) for k, v in docs.items()]
    df = spark.createDataFrame(data, "doc_id long, ids binary").repartition(parts)
    df = df.selectExpr("*", "'x' as id", "1 as part", "true as open")
    rows = packing.pack(df, window=64, open_windows=open_windows, merged=merged).collect()
    check(rows, docs, 64)
    for r in rows:
        assert list(struct.unpack(f"<{r.length}I", r.ids)) == docs[r.doc_id][r.start : r.start + r.length]


def test_best_fit():
    windows = packing.OpenWindows(10, 2)
    assert windows.place(6, "a") is None and windows.place(7, "b") is None
    assert windows.place(3, "c") == ["b", "c"]
    assert windows.place(5, "d") is None
    assert windows.place(9, "e") == ["a"]
    assert list(windows.rest()) == [["e"], ["d"]]


def test_rows(spark):
    schema = "doc_id long, ids binary"
    rows = [(1, None), (2, bytearray()), (None, bytearray(b"abcd")), (3, bytearray(b"efgh")), (3, bytearray(b"efgh"))]
    got = [(r.doc_id, r.length) for r in packing.pack(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=str) == [(3, 1), (3, 1), (None, 1)]
    assert packing.pack(spark.createDataFrame([], schema)).collect() == []
