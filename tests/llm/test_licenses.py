import re

from ledgerloom.llm import licenses

SCHEMA = "doc_id long, text string, row string, score string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(str.maketrans(licenses._UPPER, licenses._LOWER)))


def brute(text):
    ws = words(text)
    base, places = set(), []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i : i + len(p)] == p:
                base.add(label)
                places.append(i)
    labels, score = set(base), 1.0 if base else 0.0
    for label, t in licenses.TEMPLATES:
        size = -(-len(t.split()) // licenses.CHUNK) * licenses.CHUNK
        t = set(t.split())
        for at in range(0, len(ws), size):
            own = set(ws[at : at + 2 * size])
            if len(own & t) >= (len(t) if len(t) < licenses.WHOLE else licenses.THRESHOLD * len(t) - 1e-9):
                labels.add(label)
                score = max(score, len(own & t) / len(t))
    return (len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9))


TEXTS = [
    None,
    "",
    "The MIT License and the mit\nlicense; Apache-License. admit license, MIT licenses",
    "GNU general public  license general public",
    "é mit licenseKelvin KELVIN İ apache license",
    "Licensed under CC BY-NC 4.0.",
    "licensed by someone under cc by nc",
    "word " * 30_000 + "mit license",
    " ".join(reversed(licenses.TEMPLATES[1][1].split())),
    " ".join(licenses.TEMPLATES[6][1].split()[:-4]) + "\nmore",
    "Released under the MIT License.",
    "Released under the MIT License.",
]


def test_against_brute_force(spark):
    rows = [(None if i == 2 else i, t, "x", "y") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9)) for r in licenses.scan(df).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(map(brute, TEXTS), key=key)


NOTICES = [
    "Released under the Apache License",
    "Released under the BSD license.",
    "Licensed under CC BY 4.0",
    "Licensed under CC BY-NC 4.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
]


def test_query_sql_and_brute_force_state_one_rule(spark, tmp_path):
    """On notices that the given tables do not hold."""
    import duckdb
    from oracle import compare

    from ledgerloom.llm.catalog import ORACLES, QUERIES

    texts = NOTICES + [f"Some words.\n{t}\nMore words." for t in NOTICES] + TEXTS
    spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, str(tmp_path), QUERIES["op9_licenses"], ORACLES["op9_licenses"]) is None
    got = {r["doc_id"]: r["labels"] for r in QUERIES["op9_licenses"](spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(texts))] == [brute(t)[5] for t in texts]
    assert [got[i] for i in range(5)] == ["apache", "", "", "cc-by-nc", "mpl"]


#: Notices as they stand in files: wrapped, behind comment signs, far into the text.
WRAPPED = {
    """# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal
# in the Software without restriction, including without limitation the rights
# to use, copy, modify, merge, publish, distribute, sublicense""": "mit",
    """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:""": "bsd",
    """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */""": "mpl",
    """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.""": "apache",
    """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or""": "gpl",
    """Released
under the MIT
License""": "mit",
    # The words are there, but too far from each other.
    "released " + "x " * 30 + "under " + "x " * 30 + "the " + "x " * 30 + "mit " + "x " * 30 + "license": "",
    "The committee released its findings in spring. All work under review is the property of its authors.": "",
}


def test_wrapped_notices(spark, tmp_path):
    """A notice is found wherever it starts, in the operator, the SQL and brute force alike."""
    import duckdb
    from oracle import compare

    from ledgerloom.llm.catalog import ORACLES, QUERIES

    texts = [("word " * before + t + " more" * 50, label) for t, label in WRAPPED.items() for before in (0, 7, 35, 1000)]
    spark.createDataFrame([(i, t, "x", "y") for i, (t, _) in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, str(tmp_path), QUERIES["op9_licenses"], ORACLES["op9_licenses"]) is None
    got = {r["doc_id"]: r["labels"] for r in QUERIES["op9_licenses"](spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(texts))] == [label for _, label in texts] == [brute(t)[5] for t, _ in texts]


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_short_templates_need_all_words(spark):
    texts = {
        "Released under the Apache License": "apache",
        "Released under the BSD license.": "",
        "Licensed under CC BY 4.0": "",
        "Released under the MIT License": "mit",
        "Licensed under CC BY-NC 4.0": "cc-by-nc",
    }
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    assert {r["doc_id"]: r["labels"] for r in licenses.scan(df).collect()} == dict(enumerate(texts.values()))
