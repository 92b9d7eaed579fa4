import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import suffix

SCHEMA = "doc_id long, text string, lang string, kept string"


def brute(rows, length=50):
    """Spans to remove, for rows of (id, bytes); null ids last, equal ids one document."""
    last = 2**63 - 1
    first = {}
    for i, t in rows:
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            first[s] = min(first.get(s, last), last if i is None else i)
    out = []
    for i, t in rows:
        mark = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < (last if i is None else i):
                mark[p : p + length] = b"\1" * length
        spans, p = [], 0
        while p < len(t):
            if mark[p]:
                e = p
                while e < len(t) and mark[e]:
                    e += 1
                spans.append((p, e))
                p = e
            else:
                p += 1
        out.append((i, t, spans))
    return out


def results(df):
    return sorted(((r["doc_id"], r["text"], [tuple(x) for x in r["spans"]], bytes(r["kept"])) for r in suffix.dedup(df).collect()), key=str)


def wanted(rows):
    out = []
    for i, t, spans in brute([(i, (t or "").encode()) for i, t in rows]):
        kept = bytes(c for p, c in enumerate(t) if not any(a <= p < b for a, b in spans))
        out.append((i, t, spans, kept))
    return sorted(((i, next(x for j, x in rows if j == i and (x or "").encode() == t), s, k) for i, t, s, k in out), key=str)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé ") for _ in range(r.randint(1, 7)))
    passages = [" ".join(word() for _ in range(r.randint(5, 60))) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [r.choice(passages) if r.random() < 0.5 else " ".join(word() for _ in range(r.randint(1, 40))) for _ in range(r.randint(1, 5))]
        rows.append((i, "\n".join(parts)))
    rows += [(100 + i, rows[5][1]) for i in range(40)]  # a hot text
    rows += [(200 + i, passages[0] + word() * 3 + passages[1][:60]) for i in range(40)]  # a hot passage
    rows += [(300, None), (301, ""), (302, "a" * 49), (303, "a" * 50), (304, "a" * 500), (305, "ab" * 300), (306, "ab" * 30)]
    rows += [(None, passages[2]), (None, passages[2] + "x"), (400, "z" * 60), (400, "z" * 60), (400, "z" * 70), (401, "z" * 55)]
    rows += [(500, " ".join(word() for _ in range(40_000)) + passages[3])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", "clash") for i, t in rows], SCHEMA).repartition(4)
    assert results(df) == wanted(rows)


def test_kept_text(spark):
    shared = "é" * 40
    rows = [(1, "one " + shared, "en", "k"), (2, shared + " two", "en", "k"), (3, None, None, "k"), (3, "", None, "k")]
    done = suffix.kept_text(spark.createDataFrame(rows, SCHEMA))
    assert done.columns == ["doc_id", "text", "lang", "kept"]
    got = sorted(map(tuple, done.collect()), key=str)
    assert got == sorted([(1, "one " + shared, "en", "k"), (2, " two", "en", "k"), (3, None, None, "k"), (3, "", None, "k")], key=str)


def test_empty_table(spark):
    assert suffix.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, folder):
    from ledgerloom.llm.catalog import QUERIES

    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {}
    for i, t, spans in brute(docs):
        kept = b"".join(t[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(t)]))
        want[i] = (len(t), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES["op5_suffix"](spark, folder).collect()}
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=12), min_size=1, max_size=20), st.integers(0, 3))
def test_suffix_sort(words, groups):
    """Against Python's own order of the same strings."""
    raw = "".join(words).encode()
    ends = np.cumsum([len(w) for w in words])
    at = np.array([e - len(w) for e, w in zip(ends, words)])
    limit = np.array([len(w) for w in words])
    group = np.array([i % (groups + 1) for i in range(len(words))])
    order, common = suffix.suffix_sort(np.frombuffer(raw, np.uint8), at, limit, group)
    want = sorted(range(len(words)), key=lambda i: (group[i], words[i].encode(), i))
    assert [(group[i], words[i]) for i in order] == [(group[i], words[i]) for i in want]
    for n, (i, j) in enumerate(zip(order, order[1:])):
        if group[i] == group[j]:
            a, b = words[i], words[j]
            lcp = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert common[n + 1] == lcp
        else:
            assert common[n + 1] == -1


def test_collisions_are_found(monkeypatch):
    """With a hash that calls everything equal, verification refuses the order."""
    buffer = np.frombuffer(b"abcabdabe", np.uint8)
    suffixes = suffix._Suffixes(buffer, np.array([0, 3]), np.array([3, 3]), 0)
    assert not suffixes.verified(np.array([0]), np.array([1]), np.array([3]))
    assert suffixes.verified(np.array([0]), np.array([1]), np.array([2]))


def test_anchors_cover_every_string():
    rng = np.random.default_rng(4)
    buffer = rng.integers(97, 100, 5000).astype(np.uint8)
    ends = np.array([0, 30, 49, 120, 2000, 5000])
    start, end, at, h = suffix.anchors(buffer, ends, 50)
    seen = set()
    for s, e, a in zip(start, end, at):
        for q in range(s, e - 49):
            assert q <= a <= q + 50 - suffix.K and q not in seen
            seen.add(q)
    lo = 0
    for hi in ends:
        assert all((q in seen) == (q + 50 <= hi) for q in range(lo, hi))
        lo = hi


def _hot_blocks(n, length=50):
    """Contexts of one anchor in documents that have hardly more than it in common."""
    rng = random.Random(5)
    middle = bytes(rng.randrange(97, 123) for _ in range(suffix.K))
    sides = lambda k: bytes(rng.randrange(97, 123) for _ in range(k))
    kept = [sides(30) for _ in range(40)]
    contexts = []
    for i in range(n):
        left, right = (kept[rng.randrange(40)][-rng.randrange(31) :] if i % 9 == 0 else sides(30) for _ in range(2))
        contexts.append((sides(30) + left)[-30:] + middle + (right + sides(30))[:30])
    blocks = []
    for part in (contexts[::2], contexts[1::2]):
        number = range(len(blocks), n, 2)
        u4 = lambda x: np.array(x, np.uint32)
        one = [np.full(len(part), 7, np.uint64), np.array(number, np.int64), np.full(len(part), 30, np.uint8), np.full(len(part), 80, np.uint8)]
        blocks.append(suffix._pack(*one, u4([1] * len(part)), u4(range(len(part))), u4([0] * len(part)), np.frombuffer(b"".join(part), np.uint8)))
    return contexts, blocks


@pytest.mark.parametrize("most", [3, 50, 1 << 15])
def test_a_hot_anchor_is_sorted_in_portions(monkeypatch, most):
    monkeypatch.setattr(suffix, "MOST", most)
    contexts, blocks = _hot_blocks(4000)
    seen, expected = {}, [set(), set()]
    for i, c in enumerate(contexts):
        for a in range(31):
            if seen.setdefault((a, c[a : a + 50]), i) < i:
                expected[i % 2].add((i // 2, a, a + 50))
    found = suffix._sorted_spans(blocks, 50)
    assert [set(map(tuple, x.tolist())) for x in found] == expected and all(expected)


def test_memory_of_a_hot_anchor_is_bounded(monkeypatch):
    monkeypatch.setattr(suffix, "MOST", 1000, raising=False)
    _, blocks = _hot_blocks(30_000)
    tracemalloc.start()
    suffix._sorted_spans(blocks, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000 * 800
