"""Licences in lines, wrapped, in comments, by tag and by name."""

import time

from pyspark.sql import functions as F

from tidegate.llm.licenses import licenses

GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""


def test_lines_and_wrapped_sentences(spark):
    line = "Title\nReleased under the MIT License\nCopyright 2020 X"
    cases = [
        (f"{line}\n\n{BSD}", "mit_line,bsd_grant"), (f"{BSD}\n{line}", "bsd_grant,mit_line"),
        (f"Licensed under CC BY 4.0\n{BSD}Licensed under the\nMIT License\n\nAll rights reserved\nno more", "cc_by_4_0_line,bsd_grant,mit_line,reserved"),
        ("Released under the MIT License\r\n" + BSD.replace("\n", "\r\n"), "mit_line,bsd_grant"),
        ("Licensed under the Apache License, Version 2.0\n(the \"License\"); a", "apache2_grant"),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    assert [r.sentences for r in licenses(df).orderBy("doc_id").collect()] == [want for _, want in cases]
    both = licenses(spark.createDataFrame([(1, f"{line}\n\n{GPL}"), (2, GPL)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert both[0].sentences == "mit_line," + both[1].sentences and "MIT" in both[0].licenses.split(",")


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""


def commented(text, first, each, last):
    return "\n".join([first, *(each + line for line in text.splitlines()), last])


def test_comments_tags_and_names(spark):
    cases = [
        (commented(MIT, "/*", " * ", " */"), "MIT"), ("Copyright (c) 2020 A. Person\n" + MIT, "MIT"),
        (commented(GPL, "", "// ", ""), "GPL-3.0-or-later"), (commented(BSD, "<!--", "# ", "-->"), "BSD-2-Clause"),
        ("# SPDX-License-Identifier: Apache-2.0\nx", "Apache-2.0"), ("SPDX-License-Identifier: MIT-0", "MIT-0"),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0-or-later"),
        ("This file is released under the MIT license", "MIT"), ("Distributed under the BSD 3-Clause License.", "BSD-3-Clause"),
        ("Licensed under the GNU General Public License, version 2 or later", "GPL-2.0-or-later"),
        ("Licensed under the terms of the GNU General Public License version 2.", "GPL-2.0-only"),
        (GPL.replace("program", "library").replace("General", "Lesser General").replace("version 3", "version 2.1"), "LGPL-2.1-or-later"),
        (GPL.replace("GNU General", "GNU Affero General"), "AGPL-3.0-or-later"),
        ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "EPL-2.0"),
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", "MPL-2.0"),
        ("It is not released under the MIT license", ""), ("unlicensed under the mit licenses", ""), ("", ""), (None, ""),
        ("All rights reserved.", "Proprietary"), ("Released under the MIT license. Licensed under CC BY-SA 4.0", "MIT,CC-BY-SA-4.0"),
        ("released under the mit license all rights reserved released under gplv3", "MIT,GPL-3.0-only,Proprietary"),
    ]
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(cases)], "doc_id long, text string, licenses string")
    got = [r.licenses for r in licenses(df).orderBy("doc_id").collect()]
    assert [sorted(g.split(",")) for g in got] == [sorted(want.split(",")) for _, want in cases]


def test_long_texts_take_time_in_proportion(spark):
    def seconds(lines):
        text = "\n".join(f"a licensed line of some plain words without an end {i}" for i in range(lines)) + "\n" + MIT
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        assert licenses(df).select(F.col("licenses")).first().licenses == "MIT"
        return time.perf_counter() - start

    seconds(100)
    assert seconds(80_000) < 8 * max(seconds(20_000), 1.0)
