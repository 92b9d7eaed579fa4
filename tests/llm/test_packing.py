import zlib

import numpy as np
import pytest

from ledgerloom.llm import packing

SCHEMA = "doc_id long, text string, tokens string"


def brute(rows, window=2048):
    """Ids of every document by the tokenizer alone."""
    enc = packing.encoder().tokenizer
    return {i: [*enc.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}


def check(pieces, ids, window):
    by_doc, sequences = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids[doc])
            want = np.array(ids[doc][at : at + p["length"]], "<u4").tobytes()
            assert bytes(p["tokens"]) == want
            at += p["length"]
        assert at == len(ids[doc])
    for k, own in sequences.items():
        end = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == end
            end += p["length"]
        assert end == window or k == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))


def test_pieces_round_trip(spark):
    rows = [(1, "one two three " * 50), (2, None), (3, ""), (4, "Ä ö  ü\n\n x<|endoftext|>y"), (5, "a" * 5000), (6, "w " * 3000)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA).repartition(3)
    pieces = packing.pack(df, window=64).collect()
    check(pieces, brute(rows), 64)


def test_repeated_and_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "x y", ""), (7, "x y", ""), (7, "x y", "")], SCHEMA)
    pieces = packing.pack(df).collect()
    assert len(pieces) == 3 and {p["sequence_id"] for p in pieces} == {0}
    assert packing.pack(df.filter("false")).count() == 0


def test_fast_encoder_agrees_with_the_tokenizer():
    e = packing.encoder()
    for t in ["a  b", " a b", "x\n y", "it's  we'll\t\t12 3.5", "é ñ   x", "\0 z", "日本語 text", "a<|endoftext|>b"]:
        assert list(e.encode(t)) == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_query(spark, folder):
    from ledgerloom.llm.catalog import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = brute(docs.items())
    for p in QUERIES["op1_pack"](spark, folder).collect():
        part = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4").tobytes()
        assert zlib.crc32(part) == p["ids_crc32"]


@pytest.fixture
def folder(folder):
    return folder
