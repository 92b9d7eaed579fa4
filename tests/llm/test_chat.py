from ledgerloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, message string"


def messages(spark, rows):
    return {(r["conv_id"], r["turn"]): r for r in chat.link(spark.createDataFrame([(*x, "clash") for x in rows], SCHEMA)).collect()}


def test_replies(spark):
    rows = [
        (1, 0, "user", "How are  you?\nAnd the rest?"),
        (1, 1, "assistant", "> how are you?\n\nFine, thanks."),
        (1, 2, "user", "Ann wrote:\n> Fine, thanks.\n>> How are you?\nGood to hear.\n\n"),
        (1, 3, "user", ">And the rest?\nWell?"),
        (1, 4, "assistant", ">>> How are you?\n>> Fine, thanks.\n> Good to hear.\nYes."),
        (1, 5, "user", "Bob wrote: a book.\nIt is a > b."),
        (1, 6, "user", "> nobody said that\nok"),
        (2, 0, "user", "> Fine, thanks.\nElsewhere."),
        (2, 1, "user", "Later words"),
        (2, 2, None, None),
        (None, 0, "user", "Here"),
        (None, 1, "user", "> here\nreply"),
        (3, 0, "user", "> Said later\nfirst"),
        (3, 1, "user", "Said later"),
    ]
    got = messages(spark, rows)
    view = {k: (r["parent_turn"], r["root_turn"], r["depth"], r["text"]) for k, r in got.items()}
    assert view == {
        (1, 0): (None, 0, 0, "How are  you?\nAnd the rest?"),
        (1, 1): (0, 0, 1, "Fine, thanks."),
        (1, 2): (1, 0, 2, "Good to hear."),
        (1, 3): (0, 0, 1, "Well?"),
        (1, 4): (2, 0, 3, "Yes."),
        (1, 5): (None, 5, 0, "Bob wrote: a book.\nIt is a > b."),
        (1, 6): (None, 6, 0, "ok"),
        (2, 0): (None, 0, 0, "Elsewhere."),
        (2, 1): (None, 1, 0, "Later words"),
        (2, 2): (None, 2, 0, ""),
        (None, 0): (None, 0, 0, "Here"),
        (None, 1): (0, 0, 1, "reply"),
        (3, 0): (None, 0, 0, "first"),
        (3, 1): (None, 1, 0, "Said later"),
    }
    assert list(got[1, 4]["path"]) == [0, 1, 2, 4]
    assert (got[1, 4]["n_quoted"], got[1, 4]["n_linked"]) == (3, 3)


def test_long_chain_hot_line_and_repeats(spark):
    rows = [(1, 0, "u", "line 0\ncommon")] + [(1, i, "u", f"> line {i - 1}\n> common\nline {i}") for i in range(1, 40)]
    rows += [(1, 100 + i, "u", "> common\n" + "word " * 2000) for i in range(50)] + [(1, 100, "u", "> common\nagain"), (1, None, "u", "> common\nno turn")]
    df = spark.createDataFrame([(*x, "clash") for x in rows], SCHEMA)
    got = chat.link(df).collect()
    assert len(got) == len(rows)
    assert max(r["depth"] for r in got if r["turn"] is not None and r["turn"] < 40) == 39
    assert all(r["parent_turn"] == 0 for r in got if r["turn"] is not None and r["turn"] >= 100)


def test_empty(spark):
    assert chat.link(spark.createDataFrame([], SCHEMA)).count() == 0


def test_write(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "user", "a", ""), (1, 1, "assistant", "> a\nb", "")], SCHEMA)
    chat.write_chats(chat.link(df), str(tmp_path / "chats"))
    got = [r["chat"] for r in spark.read.parquet(str(tmp_path / "chats")).orderBy("conv_id", "path").collect()]
    assert got == ["<|user|>\na", "<|assistant|>\nb"]


QUOTES = [
    (1, 1, "u", "Yes"),
    (1, 2, "u", "Thanks"),
    (1, 5, "u", "Yes\nThanks"),
    (1, 6, "u", "> Yes\n> Thanks\nwelcome"),
    (2, 0, "u", "A long sentence that a mailer will break over lines. Another one here!\nA third."),
    (2, 1, "u", "> A long sentence that a mailer\n> will break over lines.\n> Another\n> one here!\nyes"),
    (2, 2, "u", "A third."),
    (2, 3, "u", "> A third.\nlatest"),
    (2, 4, "u", "> Another one here! A third.\nrun of two"),
    (2, 5, "u", "> A long sentence that a mailer will break over lines. Another one here! Changed.\ncut"),
    (2, 6, "u", "> a mailer will break\nneither line nor sentence"),
    (2, 7, "u", ">> A third.\n> latest\n\n> cut\ntwo passages"),
    (None, -70, "u", "old words"),
    (None, 200, "u", "> old words\nfar off"),
    (None, 5000, "u", "> far off\n>\n> nobody said\nfurther"),
    (None, 9000, "u", "> old words\nfurthest"),
    (None, None, "u", "> old words\nno turn"),
    (3, 0, None, None),
    (3, 1, "u", ""),
    (3, 2, "u", "> \n>\nblank quotes"),
]


def test_passages(spark):
    got = {k: r["parent_turn"] for k, r in messages(spark, QUOTES).items()}
    want = {(1, 6): 5, (2, 1): 0, (2, 3): 2, (2, 4): 0, (2, 5): 0, (2, 7): 5, (None, 200): -70, (None, 5000): 200, (None, 9000): -70}
    assert {k: v for k, v in got.items() if v is not None} == want


def test_sql_on_quotes(spark, tmp_path):
    import duckdb

    rows = QUOTES + [(9, 10 * i, "u", f"> common line\n> line {i // 2}. And. More\n> of it {i % 3}\ncommon line\nline {i}. And. More of it 1.") for i in range(30)]
    rows += [(8, i, "u", "".join(f"> word {j}.\n" for j in range(i, i + 300)) + "".join(f"word {j}.\n" for j in range(1500))) for i in range(2)]
    folder = str(tmp_path)
    spark.createDataFrame([(*x, "clash") for x in rows], SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    df = chat.op4_chat(spark, folder)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{folder}/conversations.parquet/*.parquet'")
    want = con.execute(f"select {', '.join(df.columns)} from ({chat._SQL})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.collect())
    assert sum(r[4] is not None for r in want) > 30
