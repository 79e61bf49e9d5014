import random
import textwrap
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import licenses, topk


def brute(rows, k, scale=1024):
    held = []
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v):
            continue
        held.append((i, np.floor(scale * np.array(v, np.float64))))
    out = []
    for q in sorted({i for i, _ in held if i % 100 == 0}):
        mine = next(v for i, v in held if i == q)
        scored = sorted((-int(mine @ v), i) for i, v in held if i != q and len(v) == len(mine))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("case", ["normal", "ties", "few", "hot"])
def test_search_equals_brute_force(spark, monkeypatch, case):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 150)
    draw = np.random.default_rng(3)
    n = 5 if case == "few" else 700
    values = draw.normal(size=(n, 8))
    if case == "ties":
        values = np.round(values)
    if case == "hot":
        values[: n // 3] = values[0]
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(values)]
    rows += [(1000, None), (1001, []), (1002, [1.0, None] + [0.0] * 6), (1003, [float("nan")] * 8), (1004, [float("inf")] * 8),
             (None, [1.0] * 8), (1100, [0.0] * 8), (1200, [1.0, 2.0]), (1201, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS rank", "2 AS score").repartition(3)
    rows = [(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows]
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0, 10).collect())
    assert got == sorted(brute(rows, 10))


def test_queries_in_groups(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BYTES", 300)
    rows = [(100 * i, [float(i), 1.0]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0, 3).collect())
    assert got == brute(rows, 3)
    assert topk.search(df.limit(0), F.col("vec_id") % 100 == 0, 3).collect() == []


def test_lists_are_read_for_many_queries_together():
    """Bounds of 512 queries cost less than 40 sortings of the block, and no row of a query's best is left out."""
    draw = np.random.default_rng(5)
    rows = np.floor(1024 * draw.normal(size=(2_048, 64)) / 8)
    ids, asked = np.arange(2_048), np.arange(0, 2_048, 4)
    scores = rows[asked] @ rows.T
    scores[np.arange(len(asked)), asked] = -np.inf
    tenth = np.sort(scores, 1)[:, -10]
    sorting, bounds = [], []
    for _ in range(3):
        start = time.thread_time()
        block = topk.Block(ids, rows)
        sorting.append(time.thread_time() - start)
        start = time.thread_time()
        found = list(block.best(asked, rows[asked], 10, np.full(len(asked), -np.inf)))
        bounds.append(time.thread_time() - start)
    assert sorted(at for at, _, _ in found) == list(range(len(asked)))
    for at, got, of in found:
        assert (scores[at, of] == got).all() and set(np.flatnonzero(scores[at] >= tenth[at])) <= set(of.tolist())
    assert min(bounds) < 40 * min(sorting)


MIT = """Copyright (c) X
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software. The above copyright notice and this permission notice shall be included in
all copies.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""
CASES = [
    (1, "Words.\nReleased under the MIT License.", ["mit"], ["MIT"], []),
    (2, MIT, ["mit_grant", "mit_notice", "as_is"], ["MIT"], []),
    (3, "Licensed under CC BY-NC 4.0. This work is licensed under the GNU General Public License, version 3.",
     ["cc_by_nc", "gpl3"], ["CC-BY-NC-4.0", "GPL-3.0"], []),
    (4, "All rights reserved. The above copyright notice and this permission notice shall be kept", ["reserved", "mit_notice"], [], ["reserved", "mit_notice"]),
    (5, None, [], [], []),
    (6, "", [], [], []),
    (7, "Nothing here, licensed under a tree.", [], [], []),
    (8, "Released under the MIT License. " * 3, ["mit"] * 3, ["MIT"], []),
    (9, "x. " * 50_000 + "LICENSED under the Apache License, Version 2.0.", ["apache2"], ["Apache-2.0"], []),
    (None, "Released under the MIT License", ["mit"], ["MIT"], []),
    (1, "Words.\nReleased under the MIT License.", ["mit"], ["MIT"], []),
]


def test_license_cases(documents):
    df = documents([(c[0], c[1]) for c in CASES])
    found = licenses.scan(df)
    got = sorted(((r.doc_id, r.sentence_ids, r.licenses, r.unclaimed) for r in found.collect()), key=repr)
    assert got == sorted(((c[0], *c[2:]) for c in CASES), key=repr)
    assert licenses.scan(df.limit(0)).collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_sentence_keys_are_normal_forms(spark):
    keys = list(licenses.SENTENCES)
    df = spark.createDataFrame([(k,) for k in keys], "text string")
    got = [r[0] for r in df.select(licenses.sentence_keys(F.col("text"))).collect()]
    assert got == [[k] for k in keys]
    assert {i for ids, _ in licenses.RULES for i in ids} <= set(licenses.SENTENCES.values())


GNU = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {0}General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {0}General Public License for more details.

You should have received a copy of the GNU {0}General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
BSD = """Copyright (c) 2020, X

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{0}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
NOTICES = {
    "Apache-2.0": """Copyright 2020 X

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "MIT": """MIT License

Copyright (c) 2020 X

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.""",
    "BSD-2-Clause": BSD.format(""),
    "BSD-3-Clause": BSD.format("""
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""),
    "GPL-3.0": GNU.format(""),
    "LGPL-3.0": GNU.format("Lesser "),
    "AGPL-3.0": GNU.format("Affero "),
    "GPL-2.0": GNU.format("").replace("version 3", "version 2"),
    "LGPL-2.1": GNU.format("Lesser ").replace("version 3", "version 2.1"),
    "GPL": GNU.format("").replace("either version 3 of the License", "in some version"),
    "LGPL": GNU.format("Lesser ").replace("as published by\nthe Free Software Foundation, either version 3 of the License", "in some version"),
    "AGPL": GNU.format("Affero ").replace("either version 3 of the License", "in some version"),
    "EPL-2.0": """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
http://www.eclipse.org/legal/epl-2.0.""",
    "OFL-1.1": """Copyright (c) 2020, X, with Reserved Font Name Y.

This Font Software is licensed under the SIL Open Font License, Version 1.1.
This license is copied below.""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications.""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt)""",
    "CDDL-1.0": """The contents of this file are subject to the terms of the
Common Development and Distribution License (the "License").
You may not use this file except as allowed.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software.""",
}
SHORT = {  # sentences that go on after the key
    "MIT": "Licensed under the MIT License in 2020 by us.",
    "BSD-2-Clause": "This project is licensed under the BSD 2-Clause License, as in the file.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License (see below).",
    "GPL-2.0": "Licensed under the GNU General Public License, version 2 or later.",
    "GPL-3.0": "Released under the GNU General Public License, version 3 or later.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License v3.0 only.",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3, as published.",
    "CC0-1.0": "This work is licensed under CC0 1.0 Universal.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
}


def test_standard_notices_wrapped_and_unwrapped(documents):
    tagged = {name: f"// SPDX-License-Identifier: {name}" for name in licenses.TAGGED}
    assert {name for _, name in licenses.RULES + licenses.MORE_RULES} == NOTICES.keys() | SHORT.keys() | tagged.keys()
    wants, rows = [], []
    for name, text in [*NOTICES.items(), *SHORT.items(), *tagged.items()]:
        flat = "\n\n".join(" ".join(p.split()) for p in text.split("\n\n"))
        narrow = "\n\n".join("\n".join(textwrap.wrap(p, 30)) for p in flat.split("\n\n"))
        comment = "\r\n".join(f" * {line}".rstrip() for line in text.split("\n"))
        for form in (text, flat, narrow, comment):
            wants.append(name)
            rows.append((len(rows), f"Some words\n\n{form}\n\nMore words."))
    got = {r.doc_id: (list(r.licenses), list(r.unclaimed)) for r in licenses.scan(documents(rows)).collect()}
    assert [(w, got[i], rows[i][1]) for i, w in enumerate(wants) if got[i] != ([w], [])] == []


def test_statements_about_a_licence_are_no_grants(documents):
    rows = [(1, "Licensed under the MIT License is what others say, we do not."), (2, "Licensed under the Apache License, Version 2.0 was a mistake."),
            (3, "Licensed under the MIT License, isolated from the rest."), (4, "Licensed under the MIT License. Is it so?"),
            (5, "SPDX-License-Identifier: MIT"), (6, "SPDX-License-Identifier: GPL-2.0-or-later\nint main"), (7, "SPDX-License-Identifier: Unknown-1.0")]
    got = {r.doc_id: list(r.licenses) for r in licenses.scan(documents(rows)).collect()}
    assert got == {1: [], 2: [], 3: ["MIT"], 4: ["MIT"], 5: ["MIT"], 6: ["GPL-2.0-or-later"], 7: []}


def test_known_sentences_end_and_start_with_their_words(documents):
    rows = [(1, "Licensed under the MIT Licenses"), (2, "It is not licensed under the MIT License"), (3, "All rights.\nReserved"),
            (4, "All rights\n\nreserved"), (5, "All rights\nreserved"), (6, "x" + " . ! \n" * 50_000 + "all rights" + " ;\t" * 50_000 + "reserved"),
            (7, ("." * 50_000 + " \n" + "\u65e5" * 50_000) * 2 + "all rights reserved")]
    got = {r.doc_id: list(r.sentence_ids) for r in licenses.scan(documents(rows)).collect()}
    assert got == {1: [], 2: [], 3: [], 4: [], 5: ["reserved"], 6: ["reserved"], 7: ["reserved"]}


def test_components_of_any_size(spark):
    """Sums beyond what floats add up exactly, beyond 64 bits and beyond all floats."""
    import math

    draw = random.Random(4)
    sizes = [1.0, 1.0, 3000.0, 2.0**40, 1e15, 1e200, 1.7e308]
    rows = [(i, [draw.choice([-1, 1]) * draw.random() * draw.choice(sizes) for _ in range(3)]) for i in range(60)]
    rows += [(100, [2.0**43, 1.0, 2.0**-10]), (101, [2.0**43, 1.0, 0.0]), (102, [2.0**43, 1.0, 2.0**-9]), (200, [float("inf"), 0.0, 0.0])]
    whole = {i: [int(x) * 1024 if abs(x) > 1e300 else math.floor(1024 * x) for x in v] for i, v in rows if i != 200}
    want = []
    for q, a in whole.items():
        if q % 10 == 0:
            scores = [(max(-(1 << 63), min(sum(x * y for x, y in zip(a, b)), (1 << 63) - 1)), i) for i, b in whole.items() if i != q]
            want += [(q, r, i, s) for r, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:7], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = [tuple(r) for r in topk.search(table, F.col("vec_id") % 10 == 0, 7).collect()]
    assert sorted(got) == sorted(want)


def test_text_ids_take_no_part(spark):
    table = spark.createDataFrame([("1", [1.0]), ("x", [9.0]), ("2", [2.0])], "vec_id string, embedding array<double>")
    assert [tuple(r) for r in topk.search(table, F.lit(True), 1).sort("query_id").collect()] == [(1, 1, 2, 2 * 1024 * 1024), (2, 1, 1, 2 * 1024 * 1024)]
