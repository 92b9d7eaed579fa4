"""Types of CSV files from all their values."""

import pytest

from ledgerloom.sources import infer


def write(path, text):
    path.mkdir()
    (path / "part.csv").write_text(text)
    return str(path)


COLUMNS = {
    "tiny": (["-128", "127", "+5", None], "tinyint"),
    "small": (["-129", "1"], "smallint"),
    "int": (["2147483647", "007"], "int"),
    "big": (["9223372036854775807"], "bigint"),
    "huge": (["9223372036854775808"], "double"),
    "endless": (["1" * 40], "double"),
    "real": (["1", "2.5", ".5", "1.", "-1e5", "NaN"], "double"),
    "late": (["1", "2", "3", "4", "5", "6x"], "string"),
    "blank": ([" 5"], "string"),
    "flag": (["T", "F"], "string"),
    "none": ([], "double"),
}


def test_types(spark, tmp_path):
    rows = [[v[i] if i < len(v) and v[i] is not None else "" for v, _ in COLUMNS.values()] for i in range(6)]
    text = "\n".join(",".join(r) for r in [list(COLUMNS), *rows]) + "\n"
    (schema,) = infer.infer_schemas(spark, write(tmp_path / "a", text))
    assert {f.name: f.dataType.simpleString() for f in schema} == {c: t for c, (_, t) in COLUMNS.items()}


def test_common_types_and_round_trip(spark, tmp_path):
    train = write(tmp_path / "train", 'id,label,x,"odd,name"\n1,0,5,"a ""b"", c"\n2,1,6,\n')
    test = write(tmp_path / "test", 'id,x,"odd,name"\n70000,1.5,7\n')
    one, two = infer.read_csv_inferred(spark, train, test)
    assert one.dtypes == [("id", "int"), ("label", "tinyint"), ("x", "double"), ("odd,name", "string")]
    assert two.dtypes == [one.dtypes[0], *one.dtypes[2:]]
    assert sorted(map(tuple, one.collect())) == [(1, 0, 5.0, 'a "b", c'), (2, 1, 6.0, None)]
    assert list(map(tuple, two.collect())) == [(70000, 1.5, "7")]


def test_without_rows(spark, tmp_path):
    (df,) = infer.read_csv_inferred(spark, write(tmp_path / "e", "a,b\n"))
    assert df.dtypes == [("a", "double"), ("b", "double")] and df.count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_many_columns_in_one_pass(spark, parts):
    df = spark.range(200).repartition(parts).selectExpr(*[f"CAST(id * {i} AS STRING) AS c{i}" for i in range(430)])
    states = {r["column"]: r for r in infer.column_states(df).collect()}
    assert len(states) == 430 and all(states[f"c{i}"]["high"] == 199 * i and not states[f"c{i}"]["text"] for i in range(430))
