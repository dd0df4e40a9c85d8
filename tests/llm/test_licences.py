import re

import duckdb
from cases import docs, odd_docs

from rivulet.llm import licences


def by_doc(df):
    return {r["doc_id"]: (r["n_sentences"], r["sentence_ids"], r["licences"]) for r in df.collect()}


def test_rules_need_their_order(spark):
    texts = [
        "Some code.\nReleased under the MIT License.", "RELEASED!! UNDER!! THE!! MIT!! LICENSE!!",
        "Licensed under the Apache License, Version 2.0 (the \"License\"). You may not use this file except in compliance with the License. You may obtain a copy of the License at\nhttp://x",
        "You may obtain a copy of the License at\nLicensed under the Apache License, Version 2.0 (the License).",
        "This work is licensed under the GNU General Public License, version 3. Own words here. Licensed under CC BY-NC 4.0.",
        "A licence of no kind. Permission is hereby denied.", None, "",
    ]
    got = by_doc(licences.scan_licences(docs(spark, *texts)))
    assert got == {
        0: (1, "1", "MIT"), 1: (1, "1", "MIT"), 2: (3, "7,8,9", "Apache-2.0"), 3: (2, "9,7", ""),
        4: (2, "10,17", "CC-BY-NC-4.0,GPL-3.0"), 5: (0, "", ""), 6: (0, "", ""), 7: (0, "", ""),
    }


def test_every_sentence_is_found_by_the_hint_and_used(spark):
    assert all(re.search(licences.HINT, s) for s in licences.SENTENCES)
    assert len(set(licences.SENTENCES)) == len(licences.SENTENCES)
    assert {i for _, rule in licences.RULES for i in rule} == set(range(1, len(licences.SENTENCES) + 1))
    filled = [s.replace("**", "anything").replace("*", "some body or other") for s in licences.SENTENCES]
    texts = [". ".join(filled[i - 1].capitalize() for i in rule) + "." for _, rule in licences.RULES]
    got = by_doc(licences.scan_licences(docs(spark, *texts)))
    assert [got[i][2] for i in range(len(texts))] == [name for name, _ in licences.RULES]


def test_odd_rows(spark):
    assert len(licences.scan_licences(odd_docs(spark)).collect()) == 10
    assert licences.scan_licences(odd_docs(spark).limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version %d of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""


def test_wrapped_texts(spark):
    wrapped = {
        "MIT": (MIT, "4,5"), "GPL-3.0": (GPL % 3, "12,14"), "GPL-2.0": (GPL % 2, "13,14"),
        "BSD-2-Clause": (BSD, "19,20,21"), "MPL-2.0": (MPL, "22"), "Apache-2.0": (APACHE, "7,8,9"),
    }
    dressed = [
        lambda t: t,
        lambda t: t.replace("\n", "\r\n"),
        lambda t: "".join(f"# {line}\n" for line in t.splitlines()),
        lambda t: "".join(f"// {line}".rstrip() + "\n" for line in t.splitlines()),
        lambda t: "/*\n" + "".join(f" * {line}".rstrip() + "\n" for line in t.splitlines()) + " */\nint main() {}\n",
        lambda t: "Some header\n" + t,
    ]
    texts = [dress(text) for text, _ in wrapped.values() for dress in dressed]
    got = by_doc(licences.scan_licences(docs(spark, *texts)))
    expected = [(ids.count(",") + 1, ids, name) for name, (_, ids) in wrapped.items() for _ in dressed]
    assert [got[i] for i in range(len(texts))] == expected


def test_lines_are_a_second_reading(spark):
    texts = [
        "A title\nReleased under the MIT License\nby someone", "Licensed under the Apache License, Version 2.0\n(the License)",
        "Released under\n\nthe MIT License", "Released under. The MIT License", "This project is\nlicensed under the MIT license\n",
    ]
    got = by_doc(licences.scan_licences(docs(spark, *texts)))
    assert [got[i][1] for i in range(5)] == ["1", "6,7", "", "", "3,2"]


CLAUSE_3 = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
CLAUSE_AD = """3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement: This product includes it.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
CC0 = """To the extent possible under law, Jane Q. Author
has waived all copyright and related or neighboring rights to
this work.
"""
CC0_ONE = CC0.replace("Q. ", "")
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/
"""
CASES = {
    BSD + CLAUSE_3: "BSD-3-Clause", BSD + "Some other words.\n" + CLAUSE_3: "BSD-3-Clause", BSD + CLAUSE_AD + CLAUSE_3: "BSD-4-Clause",
    BSD + CLAUSE_3 + BSD: "BSD-2-Clause,BSD-3-Clause", ISC: "ISC", LGPL: "LGPL-2.1", CC0_ONE: "CC0-1.0", ZLIB: "Zlib", EPL: "EPL-2.0",
    (GPL % 3).replace("GNU General", "GNU Affero General"): "AGPL-3.0",
    "# SPDX-License-Identifier: MIT\nimport os\n": "MIT", "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0",
    "Licensed under the MIT license, see LICENSE for details.": "MIT", "Released under the ISC license.": "ISC",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "Neither the name may be used. SPDX-License-Identifier: none of these": "",
}


def test_longer_rules_win_and_more_licences_are_known(spark):
    got = by_doc(licences.scan_licences(docs(spark, *CASES)))
    assert [got[i][2] for i in range(len(CASES))] == list(CASES.values())


def test_own_sentences_have_their_own_hint(spark):
    own = ["this work is in the public domain", "do as * like"]
    texts = ["This work is in the public domain!", "Do as you would like.", "Do as like.", "nothing"]
    got = by_doc(licences.scan_licences(docs(spark, *texts), sentences=own, rules=[("PD", [1]), ("Free", [2])]))
    assert [got[i][2] for i in range(4)] == ["PD", "Free", "", ""]
    assert {i: got[i][1] for i in range(4)} == {0: "1", 1: "2", 2: "", 3: ""}
    none = by_doc(licences.scan_licences(docs(spark, *texts), sentences=[], rules=[]))
    assert set(none.values()) == {(0, "", "")}


def test_sql_joins_wrapped_lines_as_the_query_does(spark, tmp_path):
    texts = [*CASES, MIT, APACHE, GPL % 2, CC0, "a.\n\n\nb", "Released under\n\nthe MIT License", "Released\r\nunder the MIT\rLicense"]
    texts += ["".join(f" * {line}".rstrip() + "\n" for line in t.splitlines()) for t in texts] + [None, ""]
    docs(spark, *texts).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    columns = ["doc_id", "n_sentences", "sentence_ids", "licences"]
    got = licences.scan_licences(spark.read.parquet(str(tmp_path / "documents.parquet"))).select(columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({licences.sql()})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_clashing_names_change_nothing(spark):
    plain = by_doc(licences.scan_licences(docs(spark, *CASES).select("doc_id", "text")))
    assert by_doc(licences.scan_licences(docs(spark, *CASES))) == plain
