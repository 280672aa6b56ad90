"""License scan by sentence rules, in native expressions.

A text is cut into sentences, each is normalised and looked up among the known sentences of
licences, and the sequence of identifiers found is matched against ordered licence rules: the
first rule whose identifiers stand next to each other takes them away, then the next one looks at
what is left. Identifiers that no rule takes are reported as such.

Sentences end at ``.``, ``!``, ``?`` or ``;`` before white space (but not behind "software;" and
"foundation;", as the GPL has them) and with the paragraph: at lines without letters or digits,
before list marks, copyright notices and SPDX tags, after copyright notices, after ``:`` at the end
of a line, and before a line that opens as known sentences do. Other lines are joined, whatever
they begin with; indentation and comment marks go with all other punctuation. What is not known as
a whole is looked up line by line. An SPDX expression gives an identifier for each of its licences;
headings are known where they stand alone. Sentences of no licence do not come between
identifiers. Null and empty texts have no sentences. Every row is judged by itself, so repeated
rows are alike. Added columns replace columns of the same names; all others stay.

``duckdb_sql`` is the narrower form that this scan had before: it joins a line to the one before
only if it begins with a small letter at its first column, and knows neither headings nor SPDX
tags. Both agree on texts without these.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words without which a sentence is of no licence; known sentences, normalised, as
#: patterns; rules in the order in which they are tried.
KEYWORDS = "licen[sc]e|permission|redistribut|warrant|copyright|public domain|software is provided|apache org|spdx|unlicense"
_BY = "(this (work|program|software|file|project|library|document|text) is )?(licen[sc]ed|released|distributed|available|provided|published) under (the )?(terms of )?(the )?"
SENTENCES: tuple[tuple[str, str], ...] = (
    ("apache2-name", rf"^{_BY}apache licen[sc]e( version)? 2( 0)?( the license)?$"),
    ("apache2-comply", r"^you may not use this file except in compliance with the license$"),
    ("apache2-copy", r"^you may obtain a copy of the license at( https? www apache org licenses license 2 0)?$"),
    ("apache2-warranty", r"^unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind( either express or implied)?$"),
    ("apache2-see", r"^see the license for the specific language governing permissions and limitations under the license$"),
    ("mit-name", rf"^{_BY}(mit|expat) licen[sc]e$"),
    ("mit-grant", r"^permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files( the software)? to deal in the software without restriction"),
    ("mit-notice", r"^the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software$"),
    ("mit-warranty", r"^the software is provided as is without warranty of any kind express or implied"),
    ("mit-liability", r"^in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("isc-name", rf"^{_BY}isc licen[sc]e$"),
    ("isc-grant", r"^permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies$"),
    ("bsd-name", rf"^{_BY}(3 clause |new |modified )?bsd( 3 clause)? licen[sc]e$"),
    ("bsd2-name", rf"^{_BY}(2 clause |simplified )bsd licen[sc]e$"),
    ("bsd-grant", r"^redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", r"^(1 )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer$"),
    ("bsd-binary", r"^(2 )?redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd-endorse", r"^(3 )?neither the name of .* may be used to endorse or promote products derived from this software without specific prior written permission$"),
    ("bsd-warranty", r"^this software is provided by the .* as is and any express or implied warranties"),
    ("gpl3-name", rf"^{_BY}gnu general public licen[sc]e( as published by the free software foundation)?( either)? version 3( of the license)?( or at your option any later version| or later)?$"),
    ("gpl2-name", rf"^{_BY}gnu general public licen[sc]e( as published by the free software foundation)?( either)? version 2( of the license)?( or at your option any later version| or later)?$"),
    ("gpl-grant3", r"^this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-grant2", r"^this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-hope", r"^this (program|library) is distributed in the hope that it will be useful but without any warranty"),
    ("gpl-see", r"^see the gnu (lesser |affero )?general public license for more details$"),
    ("gpl-copy", r"^you should have received a copy of the gnu (lesser |affero )?general public license along with this (program|library)$"),
    ("lgpl3-name", rf"^{_BY}gnu lesser general public licen[sc]e version 3( 0)?( or later)?$"),
    ("lgpl21-name", rf"^{_BY}gnu lesser general public licen[sc]e version 2 1( or later)?$"),
    ("agpl3-name", rf"^{_BY}gnu affero general public licen[sc]e version 3( or later)?$"),
    ("mpl2-name", rf"^({_BY}|this source code form is subject to the terms of the )mozilla public licen[sc]e v(ersion)? 2 0$"),
    ("mpl2-copy", r"^if a copy of the mpl was not distributed with this file you can obtain one at https? mozilla org mpl 2 0$"),
    ("cc0-name", rf"^{_BY}(creative commons )?(zero |cc0 |cc zero )(1 0)?( universal)?( licen[sc]e| public domain dedication)?$"),
    ("cc-by-nc-nd-4", rf"^{_BY}(cc|creative commons) (by nc nd|attribution noncommercial noderivatives) 4 0( international)?( licen[sc]e)?$"),
    ("cc-by-nc-sa-4", rf"^{_BY}(cc|creative commons) (by nc sa|attribution noncommercial sharealike) 4 0( international)?( licen[sc]e)?$"),
    ("cc-by-nc-4", rf"^{_BY}(cc|creative commons) (by nc|attribution noncommercial) 4 0( international)?( licen[sc]e)?$"),
    ("cc-by-sa-4", rf"^{_BY}(cc|creative commons) (by sa|attribution sharealike) 4 0( international)?( licen[sc]e)?$"),
    ("cc-by-nd-4", rf"^{_BY}(cc|creative commons) (by nd|attribution noderivatives) 4 0( international)?( licen[sc]e)?$"),
    ("cc-by-4", rf"^{_BY}(cc|creative commons) (by|attribution) 4 0( international)?( licen[sc]e)?$"),
    ("unlicense", r"^this is free and unencumbered software released into the public domain$"),
    ("any-later", r"^(either version .* of the license or )?at your option any later version$"),
    ("all-rights", r"^(copyright .* )?all rights reserved$"),
)
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("apache2-name", "apache2-comply", "apache2-copy", "apache2-warranty", "apache2-see")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("GPL-3.0-or-later", ("gpl-grant3", "gpl-hope", "gpl-see", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl-grant2", "gpl-hope", "gpl-see", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl3-name", "any-later")),
    ("GPL-2.0-or-later", ("gpl2-name", "any-later")),
    ("MPL-2.0", ("mpl2-name", "mpl2-copy")),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-name",)),
    ("Apache-2.0", ("apache2-name",)),
    ("MIT", ("mit-name",)),
    ("BSD-2-Clause", ("bsd2-name",)),
    ("BSD-3-Clause", ("bsd-name",)),
    ("GPL-3.0", ("gpl3-name",)),
    ("GPL-2.0", ("gpl2-name",)),
    ("LGPL-3.0", ("lgpl3-name",)),
    ("LGPL-2.1", ("lgpl21-name",)),
    ("AGPL-3.0", ("agpl3-name",)),
    ("MPL-2.0", ("mpl2-name",)),
    ("CC0-1.0", ("cc0-name",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("Unlicense", ("unlicense",)),
    ("all rights reserved", ("all-rights",)),
)

#: What stands alone as a heading, and what SPDX tags name, normalised; each is a rule of its own, tried after the others.
HEADINGS: tuple[tuple[str, str, str], ...] = (
    ("apache2-head", r"^apache licen[sc]e version 2 0( january 2004)?( https? www apache org licenses)?$", "Apache-2.0"),
    ("mit-head", r"^(the )?(mit|expat) licen[sc]e( mit)?$", "MIT"),
    ("isc-head", r"^(the )?isc licen[sc]e( isc)?$", "ISC"),
    ("bsd2-head", r"^(the )?(bsd 2 clause( simplified)? licen[sc]e|(2 clause|simplified) bsd licen[sc]e)$", "BSD-2-Clause"),
    ("bsd3-head", r"^(the )?(bsd 3 clause( new or revised| new| revised)? licen[sc]e|(3 clause|new|modified) bsd licen[sc]e)$", "BSD-3-Clause"),
    ("gpl3-head", r"^(the )?gnu general public licen[sc]e version 3( 0)?( 29 june 2007)?$", "GPL-3.0"),
    ("gpl2-head", r"^(the )?gnu general public licen[sc]e version 2( 0)?( june 1991)?$", "GPL-2.0"),
    ("lgpl3-head", r"^(the )?gnu lesser general public licen[sc]e version 3( 0)?( 29 june 2007)?$", "LGPL-3.0"),
    ("lgpl21-head", r"^(the )?gnu lesser general public licen[sc]e version 2 1( february 1999)?$", "LGPL-2.1"),
    ("agpl3-head", r"^(the )?gnu affero general public licen[sc]e version 3( 0)?( 19 november 2007)?$", "AGPL-3.0"),
    ("mpl2-head", r"^(the )?mozilla public licen[sc]e version 2 0$", "MPL-2.0"),
    ("unlicense-head", r"^the unlicense$", "Unlicense"),
)
SPDX: tuple[str, ...] = (
    "Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC0-1.0", "Unlicense",
    "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-ND-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0",
    *(f"{name}{later}" for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for later in ("", "-or-later")),
)
ALL_RULES = (*RULES, *((name, (k,)) for k, _, name in HEADINGS), *((name, (f"spdx-{name.lower()}",)) for name in SPDX))

#: Texts without these words have no known sentence.
MAYBE = "(?i)licen[sc]e|permission|redistribut|warrant|copyright|domain|provided|apache|spdx"
#: Lines that begin a sentence, behind punctuation; copyright notices and SPDX tags.
_NOTICE = r"(?:(?i:copyright[ \t]*(?:\(c\)|©|[12][0-9]{3}))|(?i:spdx-))"
_OPENS = (
    r"(?:[0-9]{1,2}[.)][ \t]|(?<=\()[A-Za-z0-9]{1,2}\)[ \t]|(?<=[\n \t][-+•][ \t]{1,8})[A-Z]"
    r"|Permission (?:is hereby|to use)|Redistribution and use|Redistributions (?:of|in)|This (?:program|library|software|work|file) is"
    r"|The above copyright|THE SOFTWARE IS|(?:Licen[sc]ed|Released|Distributed) under)"
)
#: Line breaks inside a sentence and ends of sentences; texts have neither character after the first step.
LINE, END = "\x01", "\x02"
#: From text to sentences, in order.
CUTS: tuple[tuple[str, str], ...] = (
    (r"[\x01\x02]", ","),
    (r"\r\n", "\n"),
    (r"(^|\n)[ \t]*[.!?;]+", "$1,"),
    (r"(GPL-[0-9.]+)\+", "$1-or-later"),
    (r"(?i)(SPDX-License-Identifier)", f"{END}$1"),
    (r"\n(?:[^A-Za-z0-9\n\x02]*\n)+", END),
    (rf"\n(?=[^A-Za-z0-9\n\x02]*{_NOTICE})", END),
    (rf"((?:^|[\n\x02])[^A-Za-z0-9\n\x02]*{_NOTICE}[^\n\x02]*)\n", f"$1{END}"),
    (r"\n([a-z])", " $1"),
    (rf"\n(?=[^A-Za-z0-9\n\x02]*{_OPENS})", END),
    (r":[^A-Za-z0-9\n\x02]*\n", END),
    (r"(?i)(software;|foundation;)[\x20\x09-\x0D]+", f"$1{LINE}"),
    (r"([.!?;])[\x20\x09-\x0D]+", f"$1{END}"),
    (r"\n", LINE),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = r"[\x20\x09-\x0D]"


def _sentence_id(sentence: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(SENTENCES):
        out = F.when(sentence.rlike(pattern), name).otherwise(out)
    return F.when(sentence.rlike(KEYWORDS), out)


def _normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), "[^a-z0-9]+", " "))


def _spdx_ids(sentence: Column) -> Column:
    """Of each licence in the expression of a tag; exceptions (``WITH``) are left out."""
    named = F.split(F.regexp_replace(sentence, "^spdx license identifier ", ""), " or (?!later)| and ")

    def one(part: Column) -> Column:
        part = F.regexp_replace(part, "( only)?( with .*)?$", "")
        out = F.lit("spdx-other")
        for name in SPDX:
            out = F.when(part == re.sub("[^a-z0-9]+", " ", name.lower()), f"spdx-{name.lower()}").otherwise(out)
        return out

    return F.transform(named, one)


def _heading_id(sentence: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern, _ in reversed(HEADINGS):
        out = F.when(sentence.rlike(pattern), name).otherwise(out)
    return out


def _ids(raw: Column) -> Column:
    """Identifiers of a sentence that may go over several lines."""
    whole = _normal(raw)
    by_line = F.transform(F.split(raw, LINE), lambda line: _sentence_id(_normal(line)))
    known = F.coalesce(_sentence_id(whole), _heading_id(whole))
    return (
        F.when(~whole.rlike(KEYWORDS), F.array().cast("array<string>"))
        .when(whole.startswith("spdx license identifier "), _spdx_ids(whole))
        .when(known.isNotNull(), F.array(known))
        .otherwise(F.filter(by_line, lambda s: s.isNotNull()))
    )


def _written(names: tuple[str, ...]) -> str:
    return "".join(f"<{n}>" for n in names)


def with_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``license_sentences`` (place and id of each known sentence), ``licenses`` (the
    names of the rules that matched, in the order of the rules, each once) and ``unmatched``
    (identifiers that no rule took)."""
    added = ("license_sentences", "licenses", "unmatched")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    cut = t
    for pattern, by in CUTS:
        cut = F.regexp_replace(cut, pattern, by)
    sentences = F.filter(F.split(cut, END), lambda s: s.rlike("[A-Za-z0-9]"))
    df = docs.select(*kept, F.when(t.rlike(MAYBE), sentences).otherwise(F.array().cast("array<string>")).alias("_sentences"))
    found = F.flatten(F.transform("_sentences", lambda s, i: F.transform(_ids(s), lambda name: F.struct(i.alias("at"), name.alias("id")))))
    df = df.select(*kept, found.alias("license_sentences"))
    sequence = F.concat_ws("", F.transform("license_sentences", lambda s: F.concat(F.lit("<"), s["id"], F.lit(">"))))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_written(ids)).alias("ids")) for name, ids in ALL_RULES])
    matched = F.aggregate(
        rules,
        F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("names")),
        lambda seen, rule: F.struct(
            # What is taken leaves a mark: its neighbours do not become neighbours of each other.
            F.replace(seen["left"], rule["ids"], F.lit("|")).alias("left"),
            F.when(F.contains(seen["left"], rule["ids"]), F.array_append(seen["names"], rule["name"])).otherwise(seen["names"]).alias("names"),
        ),
    )
    df = df.withColumn("_matched", matched)
    rest = F.filter(F.split(F.col("_matched.left"), "[<>|]+"), lambda s: s != "")
    return df.select(*kept, "license_sentences", F.array_distinct("_matched.names").alias("licenses"), rest.alias("unmatched"))


def duckdb_sql(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """SQL of (key, n_known, licenses, unmatched) by the same two tables."""
    cases = " ".join(f"WHEN regexp_matches(s, '{pattern}') THEN '{name}'" for name, pattern in SENTENCES)
    steps = [
        f"""cut AS (SELECT {key}, list_filter(list_transform(string_split(regexp_replace(regexp_replace(coalesce({text}, ''),
              '\\r?\\n([a-z])', ' \\1', 'g'), '([.!?;]){WHITE}+', '\\1' || chr(10), 'g'), chr(10)),
              lambda x: trim(regexp_replace(translate(x, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') AS ss FROM {table})""",
        f"""known AS (SELECT {key}, list_filter(list_transform(ss, lambda s: CASE WHEN regexp_matches(s, '{KEYWORDS}') THEN CASE {cases} END END),
              lambda x: x IS NOT NULL) AS ids FROM cut)""",
        f"r0 AS (SELECT {key}, len(ids) AS n_known, array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '') AS seq, '' AS names FROM known)",
    ]
    for k, (name, ids) in enumerate(RULES):
        w = _written(ids)
        steps.append(
            f"r{k + 1} AS (SELECT {key}, n_known, replace(seq, '{w}', '|') AS seq, CASE WHEN contains(seq, '{w}') AND NOT contains(names, '[{name}]') "
            f"THEN names || '[{name}]' ELSE names END AS names FROM r{k})"
        )
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT {key}, n_known, names AS licenses, "
        f"regexp_replace(regexp_replace(replace(seq, '|', ''), '><', ',', 'g'), '[<>]', '', 'g') AS unmatched FROM r{len(RULES)}"
    )
