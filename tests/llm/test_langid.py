import zlib

import numpy as np

from ledgerloom.llm import langid
from ledgerloom.llm.catalog import QUERIES


def test_held_out_accuracy(spark, folder):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op8_langid"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


SCHEMA = "doc_id long, text string, lang string, score string, lang_pred string"


def test_odd_texts(spark):
    rows = [(i, ["the cat and the dog", "der Hund und die Katze"][i % 2] * 3, ["en", "de"][i % 2], "s", "p") for i in range(40)]
    odd = [(100, None, "en", "", ""), (101, "", None, "", ""), (102, "123 !? ...", None, "", ""), (None, "the dog", None, "", ""), (103, "und die Katze " * 100_000, None, "", ""), (104, "漢字 ß", None, "", "")]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    done = langid.identify(df, langid.learn_documents(df))
    assert done.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in done.collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[None][0] == "en" and got[103][0] == "de"
    assert all(got[i][0] == ["en", "de"][i % 2] for i in range(40))
    assert langid.identify(df.filter("false"), {}).count() == 0
    assert {r["lang_pred"] for r in langid.identify(df, {}).collect()} == {"und"}


def test_slices_count_like_the_whole(monkeypatch):
    text = "Some words, of  a text\n\nwith gaps - and more. " * 40
    whole = dict(zip(*[x.tolist() for x in langid.gram_counts(text)]))
    for size in (7, 64, 1000):
        monkeypatch.setattr(langid, "_SLICE", size)
        assert dict(zip(*[x.tolist() for x in langid.gram_counts(text)])) == whole


def test_learning_is_bounded(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "'the cat' as text", "'en' as lang")
    assert abs(np.linalg.norm(langid.learn(df, "text", "lang", langid.F.xxhash64("doc_id"), rows=500)["en"]) - 500) < 100


def test_rare_languages_and_repeated_rows(spark):
    """Every language gets its share of the sample; ids that are null or repeated do not break the bound."""
    rows = [(None, f"the cat {i}", "en") for i in range(3000)] + [(7, "the same row", "en")] * 3000 + [(1, "кошка и собака", "ru"), (1, "собака", "ru")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.learn_documents(df, rows=200)
    assert set(found) == {"en", "ru"}
    assert np.linalg.norm(found["en"]) < 150 and np.linalg.norm(found["ru"]) > 0
    got = {r["text"]: r["lang_pred"] for r in langid.identify(df, found).collect()}
    assert got["собака"] == "ru" and got["the cat 5"] == "en"


def plain_vector(text, dimensions):
    """A text's vector, letter by letter."""
    words = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text).split()
    if not words:
        return np.zeros(dimensions)
    padded, counts = f" {' '.join(words)} ", {}
    for i in range(len(padded) - 2):
        counts[padded[i : i + 3]] = counts.get(padded[i : i + 3], 0) + 1
    total = np.zeros(dimensions)
    for gram, n in counts.items():
        vector = np.ones(dimensions)
        for place, c in enumerate(reversed(gram)):  # the last letter is not rotated
            signs = np.random.default_rng([7, ord(c)]).integers(0, 2, dimensions) * 2 - 1
            vector = vector * np.concatenate([signs[dimensions - place :], signs[: dimensions - place]])
        total += np.sqrt(n) * vector
    return total


def test_vectors_prototypes_and_cosines_against_brute_force(spark):
    texts = [("the cat and the dog, the cat", "en"), ("A dog!", "en"), ("der Hund und die Katze", "de"), ("Straße über ÄÖ", "de"), ("le chat et le chien", None), ("123", None), ("東京 x", None)]
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string")
    size = 64
    prototypes = langid.learn(df, "text", "lang", langid.F.xxhash64("doc_id"), dimensions=size)
    vectors = [plain_vector(t, size) for t, _ in texts]
    unit = lambda v: v / np.linalg.norm(v) if v.any() else v
    want = {x: sum(unit(v) for v, (_, lang) in zip(vectors, texts) if lang == x) for x in ("de", "en")}
    for x in want:
        assert np.allclose(prototypes[x], want[x], atol=1e-5)
    for r in langid.identify(df, prototypes, dimensions=size).collect():
        v = unit(vectors[r["doc_id"]])
        cosines = {x: float(v @ unit(want[x])) for x in want}
        best = max(sorted(cosines), key=cosines.get)
        assert (r["lang_pred"], round(r["score"], 5)) == ((best, round(min(1, max(0, cosines[best])), 5)) if v.any() else ("und", 0.0))
