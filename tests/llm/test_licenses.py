"""Licence texts are found however their lines break."""

from __future__ import annotations

import textwrap

from odd_rows import documents

from plantmart.llm import licenses


def test_licences_are_found_at_any_width(ready):
    rows, want = [], []
    for name, body in (("MIT", licenses.MIT_BODY), ("ISC", licenses.ISC_BODY)):
        for width in (40, 72, 79, 100, 120, 10_000):
            text = textwrap.fill(body, width)
            for notice in ("", "Copyright (c) 2020 Someone\n", "Copyright 2019-2021 Some One\nAll rights reserved.\n"):
                rows.append((len(rows), notice + text))
                want.append(name)
    rows.append((len(rows), licenses.MIT_BODY.replace("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "COPYRIGHT")))
    got = {r["doc_id"]: r["license_id"] for r in licenses.license_units(documents(ready, rows)).where("unit = 0").collect()}
    assert got == dict(enumerate(want))


HEADS = ["", "Copyright (c) 2020 Someone\n", "# Copyright (c) 2020 Someone\n", " * Copyright Jane Doe 2020\n", "(c) 2021 x\n// Copyright 2019 y\n"]


def cases():
    """Documents that hold known texts: alone, behind notices, in comments, and inside longer files."""
    rows, want = [], []
    for name, body in licenses.KNOWN:
        for head in HEADS:
            for width in (60, 200):
                # Lines as in the known text, each broken anew.
                text = "\n".join(textwrap.fill(line, width) for line in body.split("\n"))
                for before, after in (("", ""), ("import os\n\n", "\n\nprint(os.name)\n")):
                    whole = before + head + "\n".join("# " + x for x in text.split("\n")) + after
                    rows.append((len(rows), whole))
                    want.append(name)
    return rows, want


def test_every_known_text_is_found_in_comments_behind_notices_and_inside_files(ready):
    rows, want = cases()
    found = {}
    for r in licenses.license_units(documents(ready, rows)).collect():
        found.setdefault(r["doc_id"], set()).add(r["license_id"])
    assert all(want[k] in found.get(k, ()) for k in range(len(rows)))


def test_sql_gives_the_same_answer_on_licence_texts(ready):
    import duckdb

    rows, _ = cases()
    rows = rows[::3] + [(None, rows[4][1]), (7, None), (8, ""), (9, licenses.MIT_BODY + " and more"), (9, rows[4][1])]
    body = licenses.MIT_BODY.replace("\n", " ")
    at = body.index(" ", 100)
    rows += [(10_000, "x\n" + body.replace("NONINFRINGEMENT", "NON-\nINFRINGEMENT") + "\ny"), (10_001, "a\n" + body[:at] + "\nCopyright 2020 z\n" + body[at:])]
    docs = documents(ready, rows)
    got = sorted(map(tuple, licenses.license_units(docs).collect()), key=repr)
    con = duckdb.connect()
    documents_table = docs.select("doc_id", "text").toArrow()  # noqa: F841 - read by name
    con.execute("CREATE TABLE documents AS SELECT * FROM documents_table")
    want = con.execute(f"SELECT doc_id, unit, license_id, digest FROM ({licenses._sql()})").fetchall()
    assert got == sorted(want, key=repr)
    assert {10_000, 10_001} <= {r[0] for r in got}
