from __future__ import annotations

import cases
import duckdb

from forgelens.llm import licenses


def test_query_as_in_sql(spark):
    extra = [
        (50, "Code.\nReleased under the MIT License.\nReleased under the MIT License.", "en", "z", 1),
        (51, " ".join(["filler"] * 60), "en", "z", 1),
        (52, "Licensed under CC BY-NC 4.0. " + "words " * 50, "en", "z", 1),
        (53, "A licence of another sort altogether.", "en", "z", 1),
    ]
    awkward = cases.awkward(spark).unionAll(spark.createDataFrame(extra, cases.SCHEMA))
    for docs in (awkward, cases.driver_rows(spark, sf="0.01")):
        con = duckdb.connect()
        con.register("documents", docs.toArrow())
        rows = [tuple(r) for r in licenses.op5_license_scan(docs).collect()]
        if docs is awkward:  # rows repeated under one id: the SQL joins by id
            assert {r[0]: r[2:] for r in rows}[51] == ("MIT", None, "z/en")
            assert {r[0]: r[2] for r in rows}[52] == "CC-BY-NC-4.0" and len(rows) == docs.count()
        assert sorted(set(rows), key=str) == sorted(set(con.execute(licenses.OP5_SQL).fetchall()), key=str)


def test_nearest_ancestor(spark):
    files = [
        (1, "LICENSE", "Released under the MIT License."), (2, "src/a.py", "code"), (3, "src/lib/COPYING.txt", "Licensed under the Apache License, Version 2.0."),
        (4, "src/lib/deep/er/b.py", "code"), (5, "src/lib/c.py", "# Licensed under CC BY-SA 4.0.\ncode"), (6, None, "x"), (7, "src/library/d.py", None), (7, "src/library/d.py", None),
        (8, "other/LICENSE", "nothing known"), (9, "other/e.py", ""),
    ]
    rows = {r.file: (r.license, r.found_in) for r in licenses.scan(spark.createDataFrame(files, "file long, path string, text string")).collect()}
    assert rows == {
        1: ("MIT", "file"), 2: ("MIT", ""), 3: ("Apache-2.0", "file"), 4: ("Apache-2.0", "src/lib"), 5: ("CC-BY-SA-4.0", "file"),
        6: (None, None), 7: ("MIT", ""), 8: ("MIT", ""), 9: ("MIT", ""),
    }


def test_python_is_not_used(spark, plan_of):
    plan = plan_of(licenses.op5_license_scan(cases.awkward(spark)))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert licenses.op5_license_scan(cases.empty(spark)).count() == 0


GPL_HEADER = """#!/usr/bin/env python
# Frobnicator - frobs things
# Copyright (C) 2019  Jo Doe
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.

import os
"""
APACHE_HEADER = """/*
 * Copyright 2021 The Frob Authors
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     https://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
package frob;
"""


def test_headers_spdx_lines_and_whole_texts(spark):
    texts = dict(licenses._texts())
    lgpl = GPL_HEADER.replace("General", "Lesser General").replace("version 3", "version 2.1").replace("# ", "// ").replace("#\n", "//\n")
    agpl = texts["AGPL-3.0-only"].replace("13. Use with", "13. Remote Network Interaction; Use with")
    files = {
        "a/frob.py": (GPL_HEADER, "GPL-3.0-or-later"), "b/frob.py": (GPL_HEADER.replace("version 3", "version 2"), "GPL-2.0-or-later"), "c/frob.c": (lgpl, "LGPL-2.1-or-later"),
        "d/Frob.java": (APACHE_HEADER, "Apache-2.0"), "e/frob.c": ("/* SPDX-License-Identifier: GPL-2.0-only */\nint x;", "GPL-2.0-only"),
        "f/frob.rs": ("// SPDX-License-Identifier: MIT OR (Apache-2.0 WITH LLVM-exception)\nfn f() {}", "MIT OR (Apache-2.0 WITH LLVM-exception)"),
        "g/frob.py": ("# SPDX-License-Identifier: MIT.\n", "MIT"), "h/LICENSE": ("Copyright (c) 2020 Jo Doe\n\n" + texts["MIT"], "MIT"),
        "i/frob.js": ("/*\nCopyright (c) 2020 Jo Doe\n\n" + texts["MIT"] + "*/\nlet x;", "MIT"), "j/COPYING": (agpl, "AGPL-3.0-only"),
        "k/LICENSE.txt": ("Copyright 2020, Frob Inc.\n\n" + texts["BSD-2-Clause"], "BSD-2-Clause"), "l/LICENSE.md": ("# License\n\nCopyright 2020, Frob Inc.\n\n" + texts["BSD-3-Clause"], "BSD-3-Clause"),
        "m/essay.txt": ("A licence is a promise.\n\nThe General was free to publish his terms, and the public read them.", None),
        **{f"whole/{spdx}/LICENSE": (" ".join(text.split()), spdx) for spdx, text in texts.items()},
    }
    rows = spark.createDataFrame([(k, p, t) for k, (p, (t, _)) in enumerate(files.items())], "file long, path string, text string")
    found = {r.path: r.license for r in licenses.scan(rows).collect()}
    assert found == {p: want for p, (_, want) in files.items()}
