import hashlib
import re

from citylens.llm import licenses as L


def brute(text):
    out = []
    for line in (text or "").lower().split("\n"):
        if re.match(r"[ \t*#/;-]*(?:copyright\b|\(c\)|©|all rights reserved)", line):
            line = ""
        for a, b in L.SPELLINGS:
            line = line.replace(a, b)
        out.append(" ".join(re.sub(L.SIGNS.replace(r"\x{A0}", "\xa0"), " ", line).split(" ")).strip(" "))
    dig = lambda x: hashlib.sha256(x.encode()).hexdigest() if (x := re.sub("[ \n]+", " ", x).strip(" ")) else None
    return dig("\n".join(out)), {dig(x) for x in out} - {None}


def test_scan_against_brute_force(spark):
    mit = L.KNOWN["MIT"]
    rows = [(1, mit), (2, "Copyright (c) 2020 X\n\n" + mit.upper().replace("SUBLICENSE", "sub-licence")), (3, "A text.\n  released under the MIT licence \nMore."),
            (4, None), (5, "...\n\t"), (6, "Licensed under CC BY-NC 4.0."), (6, "Licensed under CC BY-NC 4.0."), (None, "Released under the MIT License. Not."),
            (7, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.\nx"), (8, mit.replace("\n", " ").replace(",", " ,")), (9, "né © ½ —x—")]
    docs = spark.createDataFrame([(a, t, "d") for a, t in rows], "doc_id long, text string, digest string")
    known = {}
    for name, t in L.KNOWN.items():
        known[brute(t)[0]] = name
    want = [(i, brute(t)[0], known.get(brute(t)[0]), ",".join(sorted(known[d] for d in brute(t)[1] if d in known))) for i, t in rows]
    got = [tuple(r) for r in L.scan(docs, L.default_known(spark)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[0]: r[2] for r in got if r[0] in (1, 2, 6, 8)} == {1: "MIT", 2: "MIT", 6: "CC-BY-NC-4.0 notice", 8: "MIT"}
    assert L.scan(docs.limit(0), L.default_known(spark)).count() == 0
    assert L.scan(docs, L.default_known(spark).limit(0)).where("license_id is not null or notices <> ''").count() == 0


def test_entries_with_equal_digests_are_all_named(spark):
    known = spark.createDataFrame([("b", "Some Licence."), ("a", "some license"), ("c", "")], "license_id string, text string")
    docs = spark.createDataFrame([(1, "SOME LICENSE!")], "doc_id long, text string")
    assert L.scan(docs, known).first()["license_id"] == "a,b"


def test_usual_files_are_known(spark):
    import textwrap

    mit, bsd = L.KNOWN["MIT"], L.KNOWN["BSD-3-Clause"]
    files = {"MIT": [f"MIT License\n\nCopyright (c) 2020 Some One\n\n{mit}", f"The MIT License (MIT)\n\nCopyright Acme Labs\n\n{mit}"],
             "BSD-3-Clause": [f"BSD 3-Clause License\n\nCopyright (c) 2019, X\nAll rights reserved.\n\n{bsd}", L._text("BSD"),
                              "Copyright The Foo Authors. \n" + bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")]}
    for width in range(30, 100, 5):           # wherever the lines break, also before "copyright holders" and "copyright notice"
        files["MIT"].append("Copyright 2021 X\n" + textwrap.fill(mit, width))
        files["BSD-3-Clause"].append(textwrap.fill(bsd, width))
        files.setdefault("Apache-2.0", []).append(textwrap.fill(L._text("Apache-2.0").split("   APPENDIX")[0], width))
    for name, (license_id, _) in L.FILES.items():
        files.setdefault(license_id, []).append(L._text(name))
    files["Apache-2.0"].append(L._text("Apache-2.0").replace("[yyyy] [name of copyright owner]", "2022 Some One"))
    files["GPL-2.0"] += [L._text("GPL-2").replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA"),
                         L._text("GPL-2").split("            How to Apply")[0]]
    rows = [(i, t, want) for i, (want, t) in enumerate((k, t) for k, v in files.items() for t in v)]
    docs = spark.createDataFrame([*rows, (-1, mit + " But not here.", None), (-2, "MIT License", None)], "doc_id long, text string, want string")
    got = {r["doc_id"]: r["license_id"] for r in L.scan(docs, L.default_known(spark)).collect()}
    assert got == {-1: None, -2: None} | {i: want for i, _, want in rows}


def test_copyright_notices():
    notices = ["copyright (c) 2020 x", "copyright 1999-2003 x", "copyright: x y", "copyright by x", "(c) 2011 x", "© x", "copyright [yyyy] [name]", "copyright <year> x",
               " * copyright the go authors. all rights reserved.", "copyright acme labs", "(c) acme inc.", "all rights reserved.", "copyright the go authors"]
    texts = ["copyright holders be liable for any claim", "copyright notice, this list of conditions", "copyright owner or by an individual", "copyright law: that is",
             "(c) you must retain, in the source form", "copyright, patent, trademark", "copyright on the program", "copyrighted by x", "copyright the software, and"]
    assert [bool(re.search(L.COPYRIGHT_NOTICE, x)) for x in notices + texts] == [True] * len(notices) + [False] * len(texts)


def test_sql_answer_has_the_same_rule(spark, tmp_path):
    """Copyright lines, spellings over two lines, running text that begins like a notice."""
    import duckdb

    mit = L.KNOWN["MIT"]
    heads = ["Copyright (c) 2020 X", "copyright 2020, X", "(C) 1999 by Y", "© Z", "All Rights Reserved", "Copyright: Jane Doe", "Copyright by Jane", "copyright by by x",
             "Copyright the Foo Authors.", "Copyright the holder of it", "COPYRIGHT HOLDERS BE LIABLE", "copyright and related rights", "copyright [yyyy] name",
             "(c) the Apache Software Foundation", "(c) a claim", "(c) and other", "* Copyright  (c)  me", "# copyright <year> x", "copyright", "copyright ", "no copyright 2020",
             "Copyright the University of X, all rights reserved", "copyright notices and", "Copyright noticed", "(c)", "&copy; 2001", "copyright of x", "copyright\tQ"]
    rows = [(i, f"{h}\n{mit}\n  {h}") for i, h in enumerate(heads)] + [(100, mit.replace("copyright holders", "copyright\nholders")), (101, None), (102, "a\n\nReleased under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    known = spark.createDataFrame(list(L.KNOWN.items()), "license_id string, text string")
    cols = ["doc_id", "digest", "license_id", "notices"]
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({L.oracle()})").fetchall())
    got = sorted(tuple(r) for r in L.scan(df, known).select(*cols).collect())
    assert got == want and 10 < sum(r[2] == "MIT" for r in got) < len(heads)
