import random
from hashlib import sha256

import duckdb
import pytest
from oracle import compare

from ledgerloom.llm import lines
from ledgerloom.llm.catalog import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, key string, row long, lines string, keep string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows, min_documents=10, min_chars=1, keep_first=False):
    """doc_id, n_lines, n_dropped and kept text; rows are in the order of their ids."""
    having = {}
    for i, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            having.setdefault(key_of(line), set()).add(i)
    out, seen = [], set()
    for d, text in rows:
        kept = []
        parts = (text or "").split("\n")
        for line in parts:
            k = key_of(line)
            go = len(k) >= min_chars and len(having[k]) >= min_documents
            if go and keep_first and k not in seen:
                go = False
            seen.add(k)
            if not go:
                kept.append(line)
        out.append((d, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def corpus(seed=3, n=400):
    r = random.Random(seed)
    pool = ["common line", " Common LINE\t", "Ärger", "ärger", "x", "", " ", "\x0b\x0c", " ", "line\rwith return"] + [f"line {i}" for i in range(60)]
    rows = []
    for i in range(n):
        text = "\n".join(r.choice(pool) if r.random() < 0.5 else f"own {r.random()}" for _ in range(r.choice([0, 1, 3, 12])))
        rows.append((i, text if i % 3 else "hot line\n" + text))
    rows += [(n, None), (n + 1, ""), (n + 2, "\n" * 5000 + "hot line\n" * 5000), (n + 3, "w " * 200_000 + "\nline 3")]
    return rows


def frame(spark, rows, seed=1):
    mixed = list(rows)
    random.Random(seed).shuffle(mixed)
    return spark.createDataFrame([(d, t, "k", 1, "l", "p") for d, t in mixed], SCHEMA).repartition(5)


@pytest.mark.parametrize("options", [{}, {"min_documents": 1, "keep_first": True}, {"min_documents": 3, "min_chars": 6}, {"min_documents": 10, "keep_first": True}])
def test_against_brute_force(spark, setting, options):
    """With many partitions most runs touch a border."""
    setting("spark.sql.shuffle.partitions", 40)
    rows = corpus()
    df = frame(spark, rows)
    want = brute(rows, **options)
    found = lines.line_dedup(df, **options).collect()
    assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in found) == sorted(w[:3] for w in want)
    texts = dict(rows)
    assert sorted((r["doc_id"], lines.cut(texts[r["doc_id"]], r["keep"], r["n_lines"])) for r in found) == sorted((w[0], w[3]) for w in want)
    back = lines.kept_text(df, **options)
    assert back.columns == df.columns
    assert {r["doc_id"]: r["text"] or "" for r in back.collect()} == {w[0]: w[3] for w in want}


def test_query_on_odd_rows(spark, tmp_path):
    """Repeated rows and ids, null ids; query, SQL and brute force agree."""
    rows = corpus(5, 120)
    rows += [rows[0]] * 12 + [(None, "null id\nline 3")] * 3 + [(7, "other text of seven\nnull id")] * 8
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["op13_lines"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(d, n, m, sha256(t.encode()).hexdigest()) for d, n, m, t in brute(rows)], key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, str(tmp_path), QUERIES["op13_lines"], ORACLES["op13_lines"]) is None


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lines.line_dedup(empty).count() == 0 and lines.kept_text(empty).count() == 0


def test_one_line_in_all_documents(spark, setting):
    """The hot line's run is spread over the partitions and still decided as one."""
    setting("spark.sql.shuffle.partitions", 16)
    rows = [(i, f"hot\nown {i}") for i in range(3000)]
    entries = lines.stage(lines.documents(frame(spark, rows), "doc_id", "text", 1))
    exploded = entries.selectExpr("row", "doc_id", "doc_id is null as no_id", "inline(arrays_zip(hashes, lines))").withColumnRenamed("hashes", "hash")
    parts = lines.streamed(exploded, 10).filter("row is not null").groupBy("part").count().collect()
    assert len(parts) >= 5 and max(r["count"] for r in parts) < 1000
    assert all(r["n_dropped"] == 1 for r in lines.line_dedup(frame(spark, rows)).collect())
