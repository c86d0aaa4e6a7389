import hashlib

from barloom.llm import licences

MIT = licences.TEXTS["MIT"]
ROWS = [
    (1, MIT),
    (2, "MIT License\n".replace("MIT License\n", "") + "Copyright (c) 2019 Somebody\n" + MIT.upper().replace(",", " ;")),
    (3, MIT.replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace("copyright holders", "copyright owners")),
    (4, MIT + " and more"),
    (5, "Prose.\nReleased under the MIT License.\nMore prose."),
    (6, "This work is licensed under the GNU General Public Licence, version 3.\nThis software is released under the MIT License"),
    (7, "Licensed under the Apache License, Version 2.0."),
    (8, "SPDX-License-Identifier: BSD-3-Clause"),
    (9, "All rights reserved."), (10, None), (11, ""), (12, "Licensed under CC BY-NC 4.0."),
    (13, "word " * 500_000 + "\nLicensed under the MIT License"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, licence string, digest string")


def test_scan(spark):
    found = {r.doc_id: r for r in licences.scan(frame(spark, ROWS)).collect()}
    assert set(found) == {r[0] for r in ROWS}
    assert [found[i].licence for i in (1, 2, 3, 4)] == ["MIT", "MIT", "MIT", None]
    assert found[1].digest == found[2].digest == found[3].digest != found[4].digest
    assert (found[5].licence, found[5].notices, found[5].licences) == (None, 1, "MIT")
    assert (found[6].notices, found[6].licences) == (2, "GPL-3.0,MIT")
    assert (found[7].licence, found[7].notices) == ("Apache-2.0", 1)
    assert found[8].licences == "BSD-3-Clause"
    for i in (9, 10, 11):
        assert (found[i].digest, found[i].licence, found[i].notices, found[i].licences) == (None, None, 0, "")
    assert (found[12].licence, found[12].notices) == ("CC-BY-NC-4.0", 1)
    assert found[13].licences == "MIT"


def test_rows_without_an_id_or_with_the_same_one_stay_apart(spark):
    rows = [(None, MIT), (None, "plain words"), (None, "Licensed under the Apache License, Version 2.0."),
            (4, "The licence of a poet."), (4, "Licensed under CC BY-NC 4.0."), (4, "The licence of a poet.")]
    found = licences.scan(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.licence), r.notices, r.licences) for r in found) == [
        ("4", "CC-BY-NC-4.0", 1, "CC-BY-NC-4.0"), ("4", "None", 0, ""), ("4", "None", 0, ""),
        ("None", "Apache-2.0", 1, "Apache-2.0"), ("None", "MIT", 1, "MIT"), ("None", "None", 0, ""),
    ]


def test_a_table_of_ones_own(spark):
    own = spark.createDataFrame([("House", "You may read this."), ("House", "Read at will!")], "licence string, text string")
    found = licences.scan(frame(spark, [(1, "you may READ this"), (2, "a\nread at will"), (3, MIT)]), own).collect()
    assert {r.doc_id: (r.licence, r.notices) for r in found} == {1: ("House", 1), 2: (None, 1), 3: (None, 0)}


def test_against_a_plain_lookup(spark):
    known = {}
    for name, text in sorted(licences.known_licences(spark).collect(), reverse=True):
        known[tuple(w for line in text.split("\n") for w in licences.words_of(line))] = name
    for r in licences.scan(frame(spark, ROWS[:8])).collect():
        text = dict(ROWS)[r.doc_id]
        whole = tuple(w for line in text.split("\n") for w in licences.words_of(line))
        assert r.licence == known.get(whole)
        assert r.digest == hashlib.sha256(" ".join(whole).encode()).hexdigest()


def found_in(spark, texts):
    rows = licences.scan(frame(spark, list(enumerate(texts)))).collect()
    return [r.licence for r in sorted(rows, key=lambda r: r.doc_id)]


def test_whole_texts_with_their_headings(spark):
    who = "Copyright (c) 2019 Somebody"
    files = dict(licences.whole_texts())
    bsd = licences._resource("BSD-3-Clause.txt")
    apache = licences._resource("Apache-2.0.txt")
    texts = [
        f"MIT License\n\n{who}\n{MIT}", f"The MIT License (MIT)\n\n{who}\n{MIT}",
        f"ISC License\n\n{who}\n{licences.TEXTS['ISC']}", f"BSD 3-Clause License\n{who}\n{bsd}",
        f"{who}. All rights reserved.\n{bsd}", apache, apache[: apache.index("APPENDIX")],
        apache.replace("[yyyy] [name of copyright owner]", "2020 Somebody"),
        files["GPL-3.0"], files["MPL-2.0"], files["CC0-1.0"], files["CC-BY-SA-4.0"],
        "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: EUPL-1.2",
        f"Some License\n{who}\n{MIT}",
    ]
    assert found_in(spark, texts) == [
        "MIT", "MIT", "ISC", "BSD-3-Clause", "BSD-3-Clause", "Apache-2.0", "Apache-2.0", "Apache-2.0",
        "GPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "GPL-3.0-only", "EUPL-1.2", None,
    ]


def test_only_the_copyright_clause_goes(spark):
    one_line = " ".join(MIT.split())
    words, at = one_line.split(), one_line.split().index("COPYRIGHT")
    texts = [
        f"Copyright (c) 2020 X {one_line}",
        f"MIT License Copyright (c) 2020, 2021 X, Inc. All rights reserved. {one_line}",
        " ".join(words[:at]) + "\n" + " ".join(words[at:]),
        f"{MIT}\nCopyright holders may not sell copies of it by 2020.",
        f"Copyright (c) 2020 X. You may not sell this software.\n{MIT}",
        f"(c) 2019-2021 X\n\u00a9 Y and others <y@y.org>\nCopyright by Z\n{MIT}",
    ]
    assert found_in(spark, texts) == ["MIT", "MIT", "MIT", None, None, "MIT"]
    assert licences.words_of("Copyright holders may not sell it") == "copyright holders may not sell it".split()
    assert licences.words_of("(c) You must retain all 2020 notices")[0] == "c"
    assert licences.words_of("Copyright [yyyy] [name of copyright owner]") == []


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "licence string, text string")
    assert licences.scan(frame(spark, [])).count() == 0
    assert [r.notices for r in licences.scan(frame(spark, ROWS[:2]), nothing).collect()] == [0, 0]
