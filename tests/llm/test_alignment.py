import random
from bisect import bisect_left
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerloom.llm import alignment
from ledgerloom.llm.catalog import QUERIES

SCHEMA = "doc_id long, text string, row long, pairs string, n long"
COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def byte_of():
    """Bytes of the characters that byte-level vocabularies are written in."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out, extra = {chr(b): b for b in keep}, 256
    for b in range(256):
        if b not in keep:
            out[chr(extra)] = b
            extra += 1
    return out


def tokens(text):
    """(id, bytes) by each tokenizer, from the tokenizer files themselves."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    byte = byte_of()
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def both(text):
        e = a.encode(" " + text, add_special_tokens=False)
        one = [(i, bytes(byte[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        two = []
        for i in b.encode(text, num_threads=1):
            piece = b.id_to_piece(i)
            two.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return one, two

    return [both(t) if t else None for t in text]


def brute(rows):
    links, done = Counter(), []
    for (d, t), x in zip(rows, tokens([t for _, t in rows])):
        if x is None or any(b"".join(y for _, y in side) != (" " + t).encode() for side in x):
            done.append((d, 0, 0, [], ""))
            continue
        ends = []
        for side in x:
            at, e = 0, {}
            for i, y in side:
                at += len(y)
                e[at] = i
            ends.append(e)
        shared = sorted(ends[0].keys() & ends[1].keys())
        own = [(ends[0][s], ends[1][s]) for s in shared]
        links.update(own)
        groups = {s: ([], []) for s in shared}
        for k, e in enumerate(ends):
            for s, i in e.items():
                groups[shared[bisect_left(shared, s)]][k].append(str(i))
        done.append((d, len(x[0]), len(x[1]), own, ";".join("|".join(map(",".join, g)) for g in groups.values())))
    most = Counter()
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    return sorted(
        (
            (d, na, nb, len(own), len(own), sum(links[p] == most[p[1]] for p in own), sum(links[p] for p in own), sha256(g.encode()).hexdigest() if g else "")
            for d, na, nb, own, g in done
        ),
        key=str,
    )


def corpus():
    r = random.Random(4)
    words = "the model's 1234 straße naïve 東京 emoji😀 \t <s> </s> <0x0A> <|endoftext|> tokenisation  x\n\n über é \x00 ﬁ ".split(" ")
    rows = [(i, " ".join(r.choice(words) for _ in range(r.choice([1, 2, 8, 60])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " "), (103, "▁x"), (104, "a" * 3000), (105, "word and " * 20_000), (None, "the null id"), (None, None)]
    rows += [(7, "the seventh")] * 3 + [(106, "\r\n　​ "), (107, "﻿x")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 20, 0])
def test_against_brute_force(spark, monkeypatch, frequent):
    """With all pairs sent to the tasks, with the most frequent ones, and with none."""
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1, "p", 2) for d, t in rows], SCHEMA).repartition(3)
    aligned = alignment.stage(alignment.align(df, groups=True))
    got = alignment.scored(aligned, alignment.pair_counts(aligned))
    want = brute(rows)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=str) == want
    assert {100, 101, 103, None} <= {r["doc_id"] for r in got.collect() if not r["groups"]}
    assert all(sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in got.collect() if r["groups"])


@pytest.mark.parametrize("chunk", [1, 300])
def test_chunks(monkeypatch, chunk):
    """However the texts are cut into chunks, and by which of the two A encoders, nothing changes."""
    both = alignment.tokenizers()
    slow = alignment._TokenizerA(public_tokenizers.path("byte_bpe_50k.json"), None)
    texts = [t for _, t in corpus()]
    whole = alignment.aligned_chunk(texts, *both)
    monkeypatch.setattr(alignment, "_CHUNK", chunk)
    for a in (both[0], slow):
        parts = [alignment.aligned_chunk(texts[lo:hi], a, both[1]) for lo, hi in alignment._chunks(texts)]
        for name in ("n_a", "n_b", "n_groups", "n_links", "groups"):
            assert [x for p in parts for x in p[name].to_pylist()] == whole[name].to_pylist()
        pairs = lambda p: [sorted(zip(x, n)) for x, n in zip(p["pairs"].to_pylist(), p["links"].to_pylist())]
        assert [x for p in parts for x in pairs(p)] == pairs(whole)


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1, "p", 2), (2, "", 1, "p", 2)]):
        aligned = alignment.stage(alignment.align(spark.createDataFrame(rows, SCHEMA)))
        got = alignment.scored(aligned, alignment.pair_counts(aligned)).collect()
        assert len(got) == len(rows) and all(r["n_a"] == r["count_sum"] == 0 and r["groups_sha256"] == "" for r in got)


def test_query(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op11_align"](spark, folder)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
