import random

import pytest

from cueloom.llm.license_scan import SENTENCES, license_scan
from cueloom.llm.line_dedup import dedup_lines


def brute_lines(rows, percent):
    lines = [(d, p, x, set(w for w in x.encode().split())) for d, t in rows if t is not None for p, x in enumerate(t.split("\n"))]
    lines.sort(key=lambda x: x[:2])
    out = {d: None for d, _ in rows}
    for d, t in rows:
        if t is not None:
            out[d] = []
    for d, p, x, s in lines:
        late = False
        for e, q, _, r in lines:
            if (e, q) >= (d, p):
                break
            if s and r and 100 * len(s & r) >= percent * len(s | r):
                late = True
                break
        out[d].append((x, late))
    return {d: None if v is None else ("\n".join(x for x, late in v if not late), len(v), sum(late for _, late in v)) for d, v in out.items()}


@pytest.mark.parametrize("percent", [80, 50])
def test_line_dedup_equals_brute_force(spark, texts, percent):
    rows = [(d, t if t is None or len(t) > 20000 else t.replace(". ", ".\n")) for d, t in texts]
    docs = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in rows], "doc_id long, text string, p int, k int, w string").repartition(4)
    got = {r.doc_id: r for r in dedup_lines(docs, percent, bucket_bits=12).collect()}
    assert len(got) == len(rows) and [*docs.columns, "n_lines", "n_removed"] == list(next(iter(got.values())).asDict())
    want = brute_lines(rows, percent)
    for d, v in want.items():
        assert (None if v is None else (got[d].text, got[d].n_lines, got[d].n_removed)) == (v if v else None), d
    assert sum(v[2] for v in want.values() if v) > 20


def test_line_dedup_edges(spark, empty):
    assert dedup_lines(empty, bucket_bits=10).count() == 0
    rows = [(1, "a b\n\na b"), (1, "a b\n\na b"), (2, None), (None, "a b"), (3, "b a\nc"), (3, "b  a\nd"), (4, "")]
    got = sorted(((r.doc_id or 99), r.text or "-", r.n_lines, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), bucket_bits=10).collect())
    assert got == [(1, "a b\n", 3, 1), (1, "a b\n", 3, 1), (2, "-", 0, 0), (3, "c", 2, 1), (3, "d", 2, 1), (4, "-", 1, 0), (99, "-", 1, 1)]
    left = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), bucket_bits=10, drop_emptied=True)
    assert left.where("doc_id IS NULL").count() == 0 and left.count() == 6


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = ["doc_id", "text", "d", "t", "P", "gone", "lines", "_gone", "n_lines", "n_removed", "w"]
    rows = [(1, "a b c\nd e f", *range(9)), (2, "d e f\ng h i", *range(9))]
    docs = spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n == 'text' else 'long'}" for n in names))
    got = dedup_lines(docs, counts=False).orderBy("doc_id")
    assert got.columns == names and [tuple(r) for r in got.collect()] == [rows[0], (2, "g h i", *range(9))]
    assert [(r.n_lines, r.n_removed, r.gone) for r in dedup_lines(docs).orderBy("doc_id").collect()] == [(2, 0, 3), (2, 1, 3)]


def test_line_dedup_settles_a_large_family(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(40)]
    texts = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(40)] = f"x{rng.randrange(60)}"
        texts.append((i, " ".join(w) + "\n" + " ".join(rng.choice(base) for _ in range(rng.randint(1, 30)))))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == brute_lines(texts, 80)


def test_line_dedup_drops_copies_with_blank_lines(spark):
    rows = [(1, "a b c\n\nd e f\n"), (2, "a b c\n\nd e f\n"), (3, "a b c\n"), (4, "\n"), (5, "\na b c\n\ng h i\n")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), bucket_bits=10, drop_emptied=True).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed) for r in got) == [(1, 4, 0), (4, 2, 0), (5, 5, 1)]


def test_license_scan(spark, empty):
    rows = [
        (1, "Some prose.\nReleased under the MIT License."),
        (2, "Licensed under the Apache License, Version 2.0."),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Licensed under CC BY-NC 4.0."),
        (5, "Copyright (c) 2019 Someone. All rights reserved."),
        (6, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that:\n Redistributions of source code must retain the above copyright notice.\nRedistributions in binary form must reproduce the above copyright notice.\nNeither the name of X nor the names of its contributors may be used to endorse products."),
        (7, "He has a driving licence and software."),
        (8, None),
        (8, ""),
        (None, "Licensed under CC BY 4.0.\nReleased under the MIT License.\nReleased under the MIT License."),
    ]
    got = [(r.doc_id, r.licenses, r.versions, r.n_known) for r in license_scan(spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, found string")).collect()]
    assert got == [(1, "MIT", "", 1), (2, "Apache", "2.0", 1), (3, "GPL", "3", 1), (4, "CC", "4.0", 1), (5, "Proprietary", "", 2), (6, "BSD-3-Clause", "", 4), (7, "", "", 0), (8, "", "", 0), (8, "", "", 0), (None, "MIT,CC", "4.0", 3)]
    assert license_scan(empty).count() == 0


MIT = """MIT License

Copyright (c) 2021 Jane Roe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above
   copyright notice, this list of conditions and the following disclaimer.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
GPL = """ * This program is free software%s you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version %s of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY.
"""


def test_license_scan_wrapped_notices(spark):
    texts = [
        (MIT, "MIT", "", "Copyright;MitGrant;MitCondition;AsIs"),
        (MIT.replace("\n", "\r\n"), "MIT", "", "Copyright;MitGrant;MitCondition;AsIs"),
        (BSD, "BSD-3-Clause", "", "BsdGrant;BsdSource;BsdBinary;BsdEndorse;AsIs"),
        (GPL % (":", "3"), "GPL", "3", "GplGrant;GplAsIs"),
        (GPL % (";", "2"), "GPL", "2", "GplGrant;GplAsIs"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.", "GPL", "", "GplGrant"),
        ("This project is licensed under the MIT License.", "MIT", "", "MitName"),
        ("All code here is released under the\nMIT License - see LICENSE.md", "MIT", "", "MitName"),
        ("Title without a stop\nCopyright 2020 A\nReleased under the MIT License\nmore prose here", "MIT", "", "Copyright;MitName"),
        ("Copyright 2020 A\nAll rights reserved", "Proprietary", "", "Copyright;Reserved"),
        ("It is not licensed under the MIT License.", "", "", ""),
    ]
    rows = spark.createDataFrame([(i, t[0]) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.versions, r.sentence_ids) for r in license_scan(rows).collect()}
    assert [got[i] for i in range(len(texts))] == [t[1:] for t in texts]


def test_license_scan_examples_of_every_sentence_pass_the_prefilter(spark):
    examples = [
        ("MitName", "Available under the MIT Licence"),
        ("MitGrant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
        ("MitCondition", "The above copyright notice and this permission notice shall be included in all copies"),
        ("AsIs", "The software is provided as is, without warranty"),
        ("ApacheName", "Licensed under the Apache License, Version 2.0"),
        ("ApacheCondition", "You may not use this file except in compliance with the License"),
        ("ApacheAsIs", "Unless required by applicable law or agreed to in writing, software distributed under the License is free"),
        ("GplName", "Distributed under the GNU General Public License"),
        ("GplGrant", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
        ("GplAsIs", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
        ("LgplName", "the GNU Lesser General Public Licence"),
        ("AgplName", "the GNU Affero General Public License"),
        ("MplName", "the Mozilla Public License"),
        ("CcName", "Released under CC BY-SA 4.0."),
        ("CcName", "Available under Creative Commons Attribution 4.0"),
        ("CcName", "This work is released under the\n * CC BY 4.0"),
        ("CcName", "Available under a Creative\nCommons Zero"),
        ("BsdGrant", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
        ("BsdSource", "Redistributions of source code must retain the above copyright notice"),
        ("BsdBinary", "Redistributions in binary form must reproduce the above copyright notice"),
        ("BsdEndorse", "Neither the name of X nor the names of its contributors may be used to endorse"),
        ("Reserved", "All\n * rights reserved"),
        ("Copyright", "Copyright 2020 X"),
    ]
    assert {x for x, _ in examples} == {name for name, _ in SENTENCES}
    got = {r.doc_id: r.sentence_ids for r in license_scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(examples)], "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(examples))] == [x for x, _ in examples]


def test_line_dedup_tells_words_apart_by_every_white_space(spark):
    rows = [(1, "a b c d e"), (2, "a\tb c d e\nf g\x0bh"), (3, "a b\x0cc d\re\n\tf g h"), (4, "\r\n\t"), (5, "a\x1cb c d e")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), bucket_bits=10).collect()}
    assert got == brute_lines(rows, 80)


def test_line_dedup_finds_pairs_at_their_first_shared_token_only(spark):
    from cueloom.llm.line_dedup import _near

    # sets of 20 tokens share 18 at least: the first of these has 17 behind it
    rows = spark.createDataFrame([(0,), (2,), (3,)], "i int").selectExpr("i", "struct(i, 20 AS n, 0L AS s1, 0L AS s2) AS a", "struct(i, 20 AS n, 0L AS s1, 0L AS s2) AS b")
    assert {r.i: r.found for r in rows.selectExpr("i", f"{_near('a', 'b', 80)} AS found").collect()} == {0: True, 2: True, 3: False}


def test_line_dedup_of_long_lines_equals_brute_force(spark):
    rng = random.Random(8)
    texts, base = [], []
    for i in range(80):
        if i % 4 == 0:
            base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(60, 180))]
        w = [x if rng.random() > 0.02 * (i % 4) ** 2 else f"w{rng.randrange(400)}" for x in base]
        texts.append((i, " ".join(w) + "\n" + " ".join(w[: len(w) * 9 // 10])))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(spark.createDataFrame(texts, "doc_id long, text string"), bucket_bits=14).collect()}
    assert got == brute_lines(texts, 80)
    assert 20 < sum(x[2] for x in got.values()) < 140
