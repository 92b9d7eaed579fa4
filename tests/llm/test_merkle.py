import random
import zlib
from hashlib import sha256

import pytest
from oracle import compare, connect

from ledgerloom.llm import merkle
from ledgerloom.llm.catalog import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root string, tree string, pos long"


def h(*digests):
    return sha256("".join(digests).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return out


def leaf_of(row, add=0):
    d, text, lang, source, n, *_ = row
    parts = [d, source, lang, n if n is None else n + add, text]
    return h("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = levels([leaf_of(r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for i, g in enumerate(order):
        for j, r in enumerate(groups[g]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            fold, proof = leaf_of(r, int(tampered)), ""
            for tree, at in ((trees[g], j), (top, i)):
                for level in tree[:-1]:
                    pair = level[at - at % 2 : at - at % 2 + 2]
                    other = [x for k, x in enumerate(pair) if k != at % 2]
                    proof += "".join(other)
                    pair[at % 2] = fold
                    fold, at = h(*pair), at // 2
            root = top[-1][0]
            out.append((r[0], trees[g][0][j], trees[g][-1][0], root, h(proof), fold, fold == root))
    return sorted(out, key=str)


def rows_of(n, langs, seed=1):
    r = random.Random(seed)
    rows = [(i * 3, r.choice(["", "x", "é\n" * 9, None, "w " * 20_000]), r.choice(langs), r.choice([None, "a"]), r.choice([None, i]), "r", "t", 7) for i in range(n)]
    rows += [rows[0]] * 5 + [(None, *rows[1][1:])] * 2 if n > 1 else []
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [2, 10])
@pytest.mark.parametrize("n,langs", [(0, ["a"]), (1, [None]), (90, ["en"] * 8 + ["é", "z", "", None]), (70, [str(i) for i in range(50)])])
def test_against_brute_force(spark, tmp_path, monkeypatch, height, n, langs):
    """Blocks of four leaves need many rounds; nulls, repeated rows and ids, clashing names."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = rows_of(n, langs)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_merkle"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_frontier():
    """Every size of tree, and that a witness never changes once it is complete."""
    for n in range(1, 40):
        digests = [sha256(str(i).encode()).digest() for i in range(n)]
        frontier = merkle.Frontier()
        for d in digests:
            frontier.append(d)
        root = frontier.close(None)
        assert root.hex() == levels([d.hex() for d in digests])[-1][0]
        for d, s, sides in zip(digests, frontier.siblings, frontier.sides, strict=True):
            assert merkle.folded(d, b"".join(s), "".join(sides)) == root
            if s:
                assert merkle.folded(d, b"".join([*s[:-1], d]), "".join(sides)) != root


def test_sql_on_odd_rows(spark, tmp_path):
    rows = rows_of(60, ["en", "en", None, "", "é"])
    rows = [r for i, r in enumerate(rows) if r not in rows[:i]]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, str(tmp_path), QUERIES["op12_merkle"], ORACLES["op12_merkle"]) is None


def test_query(spark, folder):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op12_merkle"](spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert any(not r["verified"] for r in got) and any(r["verified"] for r in got)
