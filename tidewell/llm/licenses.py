"""Licence scans: known licence sentences, then ordered rules over the sequence of their identifiers.

Known sentences are looked for where a sentence or a line starts: their opening words in lower case,
whatever stands between the words, a subject before them or not. They go on over single line ends,
colons and semicolons, but not over a sentence end or an empty line; of several the longest counts. A notice that a verb
follows is a statement about a licence and is left. Licence tags are sentences like others.
Rules are tried in order over the sequence found: the first that finds its identifiers next to each
other claims them. All of it is column expressions on one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

KEY_WORDS = 10

#: Opening words of known licence sentences, normalised, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2",
    "licensed under the apache license version 2 0 the license": "apache2",
    "released under the apache license version 2 0": "apache2",
    "you may not use this file except in compliance with": "apache2_comply",
    "you may obtain a copy of the license at": "apache2_copy",
    "unless required by applicable law or agreed to in writing": "apache2_unless",
    "see the license for the specific language governing permissions and": "apache2_see",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "distributed under the mit license": "mit",
    "permission is hereby granted free of charge to any person": "mit_grant",
    "the above copyright notice and this permission notice shall be": "mit_notice",
    "provided as is without warranty of any kind express or": "as_is",
    "in no event shall the authors or copyright holders be": "mit_no_event",
    "redistribution and use in source and binary forms with or": "bsd_grant",
    "redistributions of source code must retain the above copyright notice": "bsd_source",
    "1 redistributions of source code must retain the above copyright": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd_binary",
    "2 redistributions in binary form must reproduce the above copyright": "bsd_binary",
    "neither the name of the copyright holder nor the names": "bsd_names",
    "3 neither the name of the copyright holder nor the": "bsd_names",
    "provided by the copyright holders and contributors as is and": "bsd_as_is",
    "provided by the copyright holders and contributors as is": "bsd_as_is",
    "licensed under the bsd 2 clause license": "bsd2",
    "licensed under the bsd 3 clause license": "bsd3",
    "licensed under the gnu general public license version 3": "gpl3",
    "licensed under the gnu general public license version 2": "gpl2",
    "released under the gnu general public license version 3": "gpl3",
    "free software you can redistribute it and or modify it": "gpl_free",
    "distributed in the hope that it will be useful but": "gpl_hope",
    "you should have received a copy of the gnu general": "gpl_copy",
    "licensed under the gnu lesser general public license version 3": "lgpl3",
    "licensed under the gnu affero general public license version 3": "agpl3",
    "subject to the terms of the mozilla public license v": "mpl2",
    "licensed under the mozilla public license version 2 0": "mpl2",
    "permission to use copy modify and or distribute this software": "isc_grant",
    "provided as is and the author disclaims all warranties with": "isc_as_is",
    "provided as is and the author disclaims all warranties": "isc_as_is",
    "free and unencumbered software released into the public domain": "unlicense",
    "licensed under cc by 4 0": "cc_by",
    "licensed under cc by sa 4 0": "cc_by_sa",
    "licensed under cc by nc 4 0": "cc_by_nc",
    "licensed under cc by nd 4 0": "cc_by_nd",
    "licensed under cc by nc sa 4 0": "cc_by_nc_sa",
    "licensed under cc by nc nd 4 0": "cc_by_nc_nd",
    "licensed under cc0 1 0": "cc0",
    "licensed under a creative commons attribution 4 0 international license": "cc_by",
    "licensed under the creative commons attribution 4 0 international license": "cc_by",
    "all rights reserved": "reserved",
}

#: Further openings, for notices whose wording differs from those above.
MORE_SENTENCES = {
    "the asf licenses this file to you under the apache license version 2 0": "apache2",
    "you should have received a copy of the gnu lesser general public license": "lgpl_copy",
    "you should have received a copy of the gnu library general public license": "lgpl_copy",
    "you should have received a copy of the gnu affero general public license": "agpl_copy",
    "released under the gnu general public license version 2": "gpl2",
    "licensed under the gnu general public license v2": "gpl2",
    "licensed under the gnu general public license v3": "gpl3",
    "licensed under the gnu lesser general public license v3": "lgpl3",
    "licensed under the gnu affero general public license v3": "agpl3",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and distribute this software": "isc_grant",
    "marked with cc0 1 0": "cc0",
} | {
    f"licensed under {article} creative commons attribution {words} 4 0 international license": f"cc_{name}"
    for article in ("a", "the")
    for words, name in (
        ("sharealike", "by_sa"), ("noncommercial", "by_nc"), ("noderivatives", "by_nd"),
        ("noncommercial sharealike", "by_nc_sa"), ("noncommercial noderivatives", "by_nc_nd"),
    )
}

#: The header of the GNU licences with its version, and notices of further licences.
VERSIONED = {
    f"free software you can redistribute it and or modify it under the terms of the gnu {words}general public license as published by "
    f"the free software foundation either version {version} of the license": f"{name}_free_{version[0]}"
    for words, name in (("", "gpl"), ("lesser ", "lgpl"), ("library ", "lgpl"), ("affero ", "agpl"))
    for version in ("2", "2 1", "3")
}
FURTHER = {
    "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0": "epl2",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0": "epl2",
    "licensed under the eclipse public license version 2 0": "epl2",
    "licensed under the eclipse public license v 2 0": "epl2",
    "licensed under the eclipse public license 2 0": "epl2",
    "this font software is licensed under the sil open font license version 1 1": "ofl",
    "licensed under the sil open font license version 1 1": "ofl",
    "this software is provided as is without any express or implied warranty": "zlib_as_is",
    "permission is granted to anyone to use this software for any purpose": "zlib_grant",
    "licensed under the zlib license": "zlib",
    "distributed under the boost software license version 1 0": "bsl",
    "licensed under the boost software license version 1 0": "bsl",
    "permission is hereby granted free of charge to any person or organization obtaining a copy": "bsl_grant",
    "the contents of this file are subject to the terms of the common development and distribution license": "cddl",
    "licensed under the common development and distribution license": "cddl",
}
#: Names in tags, as they are written.
TAGGED = (
    "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0",
    "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "EPL-2.0", "OFL-1.1", "Zlib", "BSL-1.0",
    "CDDL-1.0",
)


def _tag(name: str) -> str:
    return name.lower().replace("-", " ").replace(".", " ")


TAGS = {f"spdx license identifier {_tag(name)}": f"spdx_{_tag(name).replace(' ', '_')}" for name in TAGGED}
#: All known sentences.
KNOWN = SENTENCES | MORE_SENTENCES | VERSIONED | FURTHER | TAGS
#: After a short notice these make a statement about the licence of it, not a grant.
STATEMENT = "(?:is|was|are|were|isn|wasn|would|could|might|may|does|do|did|has|had|says?|said|means?|meant)"

#: Rules in the order in which they are tried, longer ones of a family first.
RULES = (
    (("apache2", "apache2_comply", "apache2_copy", "apache2_unless", "apache2_see"), "Apache-2.0"),
    (("apache2", "apache2_comply", "apache2_copy", "apache2_unless"), "Apache-2.0"),
    (("mit", "mit_grant", "mit_notice", "as_is", "mit_no_event"), "MIT"),
    (("mit_grant", "mit_notice", "as_is", "mit_no_event"), "MIT"),
    (("mit_grant", "mit_notice", "as_is"), "MIT"),
    (("bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is"), "BSD-3-Clause"),
    (("bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is"), "BSD-2-Clause"),
    (("gpl_free", "gpl_hope", "gpl_copy"), "GPL"),
    (("isc_grant", "isc_as_is"), "ISC"),
    (("apache2",), "Apache-2.0"),
    (("mit",), "MIT"),
    (("bsd2",), "BSD-2-Clause"),
    (("bsd3",), "BSD-3-Clause"),
    (("gpl3",), "GPL-3.0"),
    (("gpl2",), "GPL-2.0"),
    (("lgpl3",), "LGPL-3.0"),
    (("agpl3",), "AGPL-3.0"),
    (("mpl2",), "MPL-2.0"),
    (("unlicense",), "Unlicense"),
    (("cc_by",), "CC-BY-4.0"),
    (("cc_by_sa",), "CC-BY-SA-4.0"),
    (("cc_by_nc",), "CC-BY-NC-4.0"),
    (("cc_by_nd",), "CC-BY-ND-4.0"),
    (("cc_by_nc_sa",), "CC-BY-NC-SA-4.0"),
    (("cc_by_nc_nd",), "CC-BY-NC-ND-4.0"),
    (("cc0",), "CC0-1.0"),
)

#: Rules tried after those above.
MORE_RULES = (
    (("gpl_free", "gpl_hope", "lgpl_copy"), "LGPL"),
    (("gpl_free", "gpl_hope", "agpl_copy"), "AGPL"),
    (("gpl_free_2", "gpl_hope", "gpl_copy"), "GPL-2.0"),
    (("gpl_free_3", "gpl_hope", "gpl_copy"), "GPL-3.0"),
    (("lgpl_free_2", "gpl_hope", "lgpl_copy"), "LGPL-2.1"),
    (("lgpl_free_3", "gpl_hope", "lgpl_copy"), "LGPL-3.0"),
    (("agpl_free_3", "gpl_hope", "agpl_copy"), "AGPL-3.0"),
    (("gpl_free_2",), "GPL-2.0"),
    (("gpl_free_3",), "GPL-3.0"),
    (("lgpl_free_2",), "LGPL-2.1"),
    (("lgpl_free_3",), "LGPL-3.0"),
    (("agpl_free_3",), "AGPL-3.0"),
    (("epl2",), "EPL-2.0"),
    (("ofl",), "OFL-1.1"),
    (("zlib_as_is", "zlib_grant"), "Zlib"),
    (("zlib",), "Zlib"),
    (("bsl",), "BSL-1.0"),
    (("bsl_grant",), "BSL-1.0"),
    (("cddl",), "CDDL-1.0"),
) + tuple(((TAGS[f"spdx license identifier {_tag(name)}"],), name) for name in TAGGED)

#: Fixed values of the check SQL: where sentences end, what is no word, and subjects before "licensed", "released" and so on.
BREAK = r"[.!?:;]+[ \t\r]+|[ \t\r]*\n[ \t\r\n]*"
NO_WORD = "[^a-z0-9]+"
SUBJECT = "^(this|the) (work|file|software|program|project|document|code|text|library|source code form) (is|was) "


#: Where a known sentence may start: at the start of the text, after a sentence end or a line end.
START = r"(?:^|[.!?:;][^a-z0-9.!?:;\n]|\n)[^a-z0-9.!?:;\n]*+[.!?:;]*+"
#: What may stand between its words: no sentence end and no empty line.
BETWEEN = r"(?:[^a-z0-9.!?\n]|[.!?][.!?:;]*+(?=[a-z0-9])|\n(?![ \t\r]*\n))++"


def sentence_keys(text: Column, sentences: dict[str, str] | None = None) -> Column:
    """The known sentences of a text, as their keys, in order."""
    known = sentences or KNOWN
    words = "|".join(sorted(known, key=len, reverse=True)).replace(" ", BETWEEN)
    subject = SUBJECT.removeprefix("^").replace("(", "(?:").replace(" ", BETWEEN)
    pattern = f"{START}(?:{subject})?({words})(?![a-z0-9])(?!{BETWEEN}{STATEMENT}(?![a-z0-9]))"
    found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))
    return F.transform(found, lambda s: F.regexp_replace(s, NO_WORD, " "))


def claimed(sequence: Column, rules: tuple = RULES + MORE_RULES) -> Column:
    """The sequence text (",a,,b,") with what each rule claims replaced by "<licence>"."""
    pattern = lambda ids: "".join(f",{i}," for i in ids)  # noqa: E731  identifiers hold no special characters
    return reduce(lambda col, rule: F.regexp_replace(col, pattern(rule[0]), f"<{rule[1]}>"), rules, sequence)


def scan(docs: DataFrame, sentences: dict[str, str] | None = None, rules: tuple = RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentence_ids array, licenses array, unclaimed array) of every row.

    ``sentence_ids`` are the known sentences in text order; ``licenses`` the rules that claimed
    some of them, each once, by name; ``unclaimed`` known sentences left over, in order. Null and
    empty texts have empty arrays. Repeated rows stay repeated; other columns are left out.
    Narrow: nothing is shuffled, and the whole text is read.
    """
    sentences = sentences or KNOWN
    table = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    keys = sentence_keys(F.coalesce(F.col(text_col), F.lit("")), sentences)
    known = F.transform(keys, lambda k: F.try_element_at(table, k))
    # one short row per document from here on: the generator keeps the lookup from being repeated per use
    found = docs.select(F.col(id_col), F.explode(F.array(known)).alias("sentence_ids"))
    sequence = F.array_join(F.transform("sentence_ids", lambda i: F.concat(F.lit(","), i, F.lit(","))), "")
    ruled = found.select(id_col, "sentence_ids", F.explode(F.array(claimed(sequence, rules))).alias("_ruled"))
    return ruled.select(
        id_col, "sentence_ids",
        F.array_sort(F.array_distinct(F.regexp_extract_all("_ruled", F.lit("<([^>]*)>"), F.lit(1)))).alias("licenses"),
        F.regexp_extract_all("_ruled", F.lit(",([a-z0-9_]+),"), F.lit(1)).alias("unclaimed"),
    )


def check_sql() -> str:
    """The registered query in SQL: arrays as text joined by ' | '."""
    quoted = lambda s: "'" + s.replace("'", "''").replace("\t", "\\t") + "'"
    table = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in SENTENCES.items()) + "}"
    first = quoted(NO_WORD.replace("0-9", r"0-9\n.!?:; \t\r"))
    key = (
        f"array_to_string(string_split(regexp_replace(trim(regexp_replace(s, {quoted(NO_WORD)}, ' ', 'g')), "
        f"{quoted(SUBJECT)}, ''), ' ')[1:{KEY_WORDS}], ' ')"
    )
    ruled = "seq"
    for ids, name in RULES:
        ruled = f"replace({ruled}, '{''.join(f',{i},' for i in ids)}', '<{name}>')"
    return f"""
        WITH known AS (
            SELECT doc_id, list_filter(list_transform(
                string_split_regex(trim(regexp_replace(lower(coalesce(text, '')), {first}, ' ', 'g')), {quoted(BREAK)}),
                lambda s: ({table})[{key}]), lambda i: i IS NOT NULL) AS ids
            FROM documents),
        ruled AS (
            SELECT doc_id, ids, array_to_string(list_transform(ids, lambda i: ',' || i || ','), '') AS seq FROM known),
        named AS (SELECT doc_id, ids, {ruled} AS r FROM ruled)
        SELECT doc_id, coalesce(array_to_string(ids, ' | '), '') AS sentence_ids,
            coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(r, '<([^>]*)>', 1))), ' | '), '') AS licenses,
            coalesce(array_to_string(regexp_extract_all(r, ',([a-z0-9_]+),', 1), ' | '), '') AS unclaimed
        FROM named
    """
