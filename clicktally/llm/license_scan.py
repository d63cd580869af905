"""Licences named in documents: ordered signature rules with keywords, priorities and suppression.

A text becomes its words, lower-cased and parted by single blanks. Rules are regular expressions over
that, made of the licences and the forms below, or signatures of licence bodies and notices; a rule is
only tried on texts that hold its keyword.
Of detections that overlap one stays. They are taken in this order: first those that lie in no other,
then the others; by the better (smaller) priority, the longer one, the earlier rule. One that overlaps
a taken one goes, and only then: what a beaten detection hid comes to light again. A name that follows
a detection directly, with 'and', 'or' or nothing between, is one more of a list. Phrases of
``PHRASES`` are found wherever they stand, and always stay.

Everything is made of built-in functions; only numbers of detections are moved, not texts. Detections
are settled in groups that overlap each other, so a long list of licences is many small ones.

Defined results: null is an empty text, which names nothing; whole texts are searched, however long;
rows with the same id and text have the same result, each of them is returned; a row without id is
treated like any other; no documents give no rows. Words are counted from 0. Other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktally.llm.store import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BOTH_CASES = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # of texts that are not lower-cased

# Phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Label, keyword, the words that name the licence (a regular expression), versions.
LICENSES = (
    ("mit", "mit", r"mit(?: x11)?", ()),
    ("apache", "apache", r"apache(?: software)?", ("1", "2")),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", ()),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", ()),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)", ()),
    ("bsd", "bsd", r"bsd", ()),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("1", "2", "3")),
    ("gpl", "general public", r"(?:gnu )?general public", ("1", "2", "3")),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ("2", "2 1", "3")),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public", ("2", "2 1", "3")),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("3",)),
    ("agpl", "affero", r"(?:gnu )?affero general public", ("3",)),
    ("mpl", "mozilla", r"mozilla public", ("1", "1 1", "2")),
    ("epl", "eclipse", r"eclipse public", ("1", "2")),
    ("cddl", "common development", r"common development and distribution", ("1", "1 1")),
    ("eupl", "european union", r"european union public", ("1 1", "1 2")),
    ("artistic", "artistic", r"artistic", ("1", "2")),
    ("isc", "isc", r"isc", ()),
    ("zlib", "zlib", r"zlib(?: libpng)?", ()),
    ("boost", "boost", r"boost software", ("1",)),
    ("unlicense", "unlicense", r"unlicense", ()),
    ("ofl", "open font", r"(?:sil )?open font", ("1", "1 1")),
    ("odbl", "open database", r"open database", ("1",)),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation", ("1 1", "1 2", "1 3")),
    ("ms-pl", "microsoft public", r"microsoft public", ()),
    ("cc0", "cc0", r"(?:cc0|cc zero)", ("1",)),
    *(
        (f"cc-{code}", keyword, pattern, ("1", "2", "2 5", "3", "4"))
        for code, short, long in (
            ("by", "by", "attribution"),
            ("by-sa", "by sa", "attribution share ?alike"),
            ("by-nc", "by nc", "attribution non ?commercial"),
            ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s"),
            ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
            ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
        )
        for keyword, pattern in ((f"cc {short}", f"cc {short}"), ("creative commons attribution", f"creative commons {long}"))
    ),
)

# Priority, weight and form of a rule. NAME stands for the licence, VERSION for its version.
_VERSION = "(?: (?:version |v)?VERSION(?: 0)?)?"
FORMS = (
    (0, 1.0, "spdx license identifier NAME(?: VERSION(?: 0)?(?: only| or later)?)?"),
    (1, 0.95, "licen[sc]ed under (?:the )?(?:terms of )?(?:the )?NAME(?: (?:public )?licen[sc]e)?" + _VERSION),
    (
        1,
        0.95,
        "(?:released|distributed|published|available|provided) under (?:the )?(?:terms of )?(?:the )?"
        "NAME (?:public )?licen[sc]e" + _VERSION,
    ),
    (2, 0.9, "NAME licen[sc]e" + _VERSION),
)
#: Names that say enough without the word licence.
BARE = (3, 0.6, "NAME(?: VERSION(?: 0)?)?")
BARE_KEYWORDS = ("cc ", "creative commons", "cc0")

#: Names that are licences after 'under' without the word licence: label, keyword, name, versions, and
#: whether they need no verb before 'under' and stand by themselves with a version.
UNDER = (
    ("mit", "mit", r"mit(?: x11)?", (), False),
    ("apache", "apache", r"apache", ("1", "1 1", "2"), False),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|bsd2)", (), False),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd|bsd3)", (), False),
    ("bsd", "bsd", r"bsd", (), False),
    ("isc", "isc", r"isc", (), False),
    ("zlib", "zlib", r"zlib(?: libpng)?", (), False),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("1", "2", "3"), True),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ("2", "2 1", "3"), True),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("3",), True),
    ("mpl", "mpl", r"mpl", ("1", "1 1", "2"), True),
    ("epl", "epl", r"epl", ("1", "2"), True),
    ("cddl", "cddl", r"cddl", ("1", "1 1"), True),
    ("eupl", "eupl", r"eupl", ("1 1", "1 2"), True),
    ("gfdl", "fdl", r"(?:gnu fdl|gfdl)", ("1 1", "1 2", "1 3"), True),
    ("wtfpl", "wtfpl", r"wtfpl", ("2",), True),
    ("cecill", "cecill", r"cecill", ("1", "2", "2 1"), True),
)
_VERBS = "(?:(?:re)?(?:licen[sc]ed|released|distributed|distributable|published|available|provided|covered|issued) )"
#: Glued versions too: gplv3, lgpl2. In words 2.1 is 2 1.
_GLUED = "(?: version | v| |v)?VERSION(?: 0)?(?: only| or later| or any later version)?"
_NEXT = "(?:and or |or |and )?(?:(?:the|at your option|alternatively) )?NAME(?: licen[sc]e)?"
_UNDER = "under (?:both |either )?(?:the )?(?:terms (?:and conditions )?of )?(?:both |either )?(?:the )?NAME"

#: Label, signature: words of a licence's body or of the notice that refers to it. Each is its own keyword.
SIGNATURES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("x11", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"),
    ("json", "the software shall be used for good not evil"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "this notice may not be removed or altered from any source distribution"),
    ("boost-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("ncsa", "to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed"),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at https www apache org licenses license 2 0"),
    ("apache-2", "www apache org licenses license 2 0"),
    ("apache-2", "terms and conditions for use reproduction and distribution 1 definitions license shall mean the terms and conditions"),
    ("apache-2", "a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of"),
    ("apache-1.1", "this product includes software developed by the apache software foundation http www apache org"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-2", "gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3", "gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-2", "gnu general public license as published by the free software foundation version 2"),
    ("gpl-3", "gnu general public license as published by the free software foundation version 3"),
    ("gpl", "you should have received a copy of the gnu general public license along with"),
    ("gpl", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl", "it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("lgpl-2.1", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license"),
    ("lgpl-3", "gnu lesser general public license as published by the free software foundation either version 3 of the license"),
    ("lgpl-2", "gnu library general public license as published by the free software foundation either version 2 of the license"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license along with"),
    ("lgpl-2", "you should have received a copy of the gnu library general public license along with"),
    ("lgpl-3", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("agpl-3", "gnu affero general public license as published by the free software foundation either version 3 of the license"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with"),
    ("agpl-3", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1", "the contents of this file are subject to the mozilla public license version 1 0"),
    ("epl-1", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0"),
    ("epl", "the accompanying program is provided under the terms of this eclipse public license"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl-1", "the accompanying program is provided under the terms of this common public license"),
    ("eupl", "this european union public licence the eupl applies to the work"),
    ("artistic-1", "the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control"),
    ("artistic-2", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1"),
    ("ofl", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("odbl", "is made available under the open database license http opendatacommons org licenses odbl"),
    ("odc-by", "is made available under the open data commons attribution license"),
    ("pddl", "is made available under the public domain dedication and license"),
    ("cc0-1", "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights"),
    ("cc0-1", "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("cc0-1", "creativecommons org publicdomain zero 1 0"),
    ("cc", "the work as defined below is provided under the terms of this creative commons public license"),
    ("cc", "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons"),
    ("psf-2", "this license agreement is between the python software foundation psf and the individual or organization"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php", "products derived from this software may not be called php nor may php appear in their name without prior written permission"),
    ("ruby", "you may make and give away verbatim copies of the source form of the software without restriction provided that you duplicate all of the original copyright notices"),
    ("unicode", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files and any associated documentation"),
    ("icu", "copyright notice s and this permission notice appear in all copies of the software and that both the above copyright notice s and this permission notice appear in supporting documentation"),
    ("ftl", "the freetype project is copyright c 1996 2000 by david turner robert wilhelm and werner lemberg"),
    ("ijg", "this software is based in part on the work of the independent jpeg group"),
    ("osl-3", "licensed under the open software license version 3 0"),
    ("afl-3", "licensed under the academic free license version 3 0"),
    ("cecill", "this software is governed by the cecill license under french law and abiding by the rules of distribution of free software"),
    ("upl-1", "subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data"),
    ("vim", "there are no restrictions on distributing unmodified copies of vim except that they must include this license text"),
    ("sspl-1", "licensed under the server side public license"),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("elastic-2", "you may not provide the software to third parties as a hosted or managed service where the service provides users with access to any substantial set"),
    ("commons-clause", "the software is provided to you by the licensor under the license as defined below subject to the following condition"),
)

#: Label, keyword, signature with gaps for names and years.
GAPPED = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of", r"permission is hereby granted free of charge to any person obtaining a copy of(?: \S+){1,8}? to deal in"),
    ("bsd", "and any express or implied warranties", r"this software is provided by(?: \S+){1,12}? as is and any express or implied warranties"),
    ("bsd", "this list of conditions and the following disclaimer", r"redistributions (?:of source code|in binary form) must(?: \S+){1,8}? this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "to endorse or promote products derived from", r"neither the names?(?: \S+){1,14}? may be used to endorse or promote products derived from"),
    ("isc", "for any purpose with or without fee is hereby granted", r"permission to use copy modify (?:and (?:or )?)?distribute(?: \S+){1,5}? for any purpose with or without fee is hereby granted"),
    ("zlib", "without any express or implied warranty", r"(?:software|library|code|program) is provided as is without any express or implied warranty in no event(?: \S+){1,6}? be held liable"),
    ("gpl", "gnu general public license as published by", r"it under the terms of (?:version \S+ of )?the gnu general public license as published by"),
    ("ftl", "the freetype project is copyright", r"the freetype project is copyright(?: c)?(?: [0-9]{4}){1,3} by david turner robert wilhelm and werner lemberg"),
    ("apache-1.1", "the apache software foundation", r"copyright c [0-9]{4}(?: [0-9]{4})? the apache software foundation all rights reserved redistribution and use"),
    ("x11", "or otherwise to promote the sale use or other dealings", r"the name of(?: \S+){1,8}? shall not be used in advertising or otherwise to promote the sale use or other dealings"),
)


@dataclass(frozen=True)
class Rule:
    pattern: str
    keyword: str
    label: str
    priority: int
    weight: float
    base: bool = False
    follows: bool = False  # one more name of a list


def _rules() -> list[Rule]:
    rules = [Rule(f"(?<= ){words}(?= )", words, label, 0, 0.9, True) for words, label in PHRASES]
    for label, keyword, name, versions in LICENSES:
        for version in ("", *versions):
            for priority, weight, form in (*FORMS, BARE) if keyword.startswith(BARE_KEYWORDS) else FORMS:
                body = form.replace("NAME", name)
                if version:  # the version is a part of this rule, not an option
                    for optional in (_VERSION, "(?: VERSION(?: 0)?(?: only| or later)?)?", "(?: VERSION(?: 0)?)?"):
                        body = body.replace(optional, optional[:-1])
                    body = body.replace("VERSION", version)
                else:
                    body = body.split("(?: VERSION")[0].split("(?: (?:version")[0]
                full = label + (f"-{version.replace(' ', '.')}" if version else "")
                rules.append(Rule(f"(?<= ){body}(?= )", keyword, full, priority, weight))
    for label, keyword, name, versions, known in UNDER:
        for version in ("", *versions):
            tail = _GLUED.replace("VERSION", version) if version else ""
            full = label + (f"-{version.replace(' ', '.')}" if version else "")
            body = _VERBS + ("?" if known else "") + _UNDER.replace("NAME", name) + tail
            rules.append(Rule(f"(?<= ){body}(?= )", keyword, full, 3, 0.9))
            if known and version:
                rules.append(Rule(f"(?<= ){name}{tail}(?= )", keyword, full, 4, 0.6))
            rules.append(Rule(f"(?<= ){_NEXT.replace('NAME', name)}{tail}(?= )", keyword, full, 5, 0.8, follows=True))
    rules += [Rule(f"(?<= ){words}(?= )", words, label, 0, 0.95) for label, words in SIGNATURES]
    rules += [Rule(f"(?<= ){pattern}(?= )", keyword, label, 0, 0.95) for label, keyword, pattern in GAPPED]
    for code in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):  # addresses of the deeds
        address = f"creativecommons org licenses {code.replace('-', ' ')} "
        for version in ("1", "2", "2 5", "3", "4"):
            full = f"cc-{code}-{version.replace(' ', '.')}"
            rules.append(Rule(f"(?<= ){address}{version}(?: 0)?(?= )", address, full, 0, 0.95))
    return rules


RULES = _rules()
#: Every text with a match holds all words of one of these.
KEYWORDS = (
    ("licen",),
    ("cc", "by"),
    ("creative", "commons"),
    ("cc0",),
    ("permission",),
    ("redistribut",),
    ("warrant",),
    ("promote",),
    ("freetype",),
    ("copyright",),
    ("software",),
    ("public", "domain"),
    ("this", "notice"),
    ("invariant", "sections"),
    *((keyword,) for _, keyword, *_, known in UNDER if known),
    *(("under", keyword) for keyword in sorted({k for _, k, *_, known in UNDER if not known})),
)


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _words(text: Column) -> Column:
    """Words with single blanks between them."""
    return F.trim(F.regexp_replace(_lower(text), SEPARATORS, " "))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.xxhash64(text).alias("mark"))


def _likely(text: Column) -> Column:
    """Whether a text holds all words of one of ``KEYWORDS``; it is lower-cased once for all of them."""

    def any_of(lower: Column) -> Column:
        found = F.lit(False)
        for keyword in KEYWORDS:
            found = found | reduce(Column.__and__, (lower.contains(word) for word in keyword))
        return found

    return F.exists(F.array(F.lower(text)), any_of)


def matches(docs: DataFrame) -> DataFrame:
    """All matches of all rules: ``doc_id, mark, rule, start, end`` in words.

    A keyword is looked for once, whatever the number of its rules.
    """
    by_keyword: dict[str, list[int]] = {}
    for i, rule in enumerate(RULES):
        by_keyword.setdefault(rule.keyword, []).append(i)
    gates = F.array(*(F.struct(F.lit(k).alias("keyword"), F.array(*map(F.lit, own)).alias("rules")) for k, own in by_keyword.items()))
    patterns = F.array(*(F.lit(r.pattern) for r in RULES))
    texts = _keyed(docs).where(_likely(F.col("text"))).select(
        "doc_id", "mark", F.concat(F.lit(" "), _words(F.col("text")), F.lit(" ")).alias("words")
    )
    opened = F.filter(gates, lambda g: F.col("words").contains(g["keyword"]))
    tried = texts.select("doc_id", "mark", "words", F.explode(F.flatten(F.transform(opened, lambda g: g["rules"]))).alias("rule"))
    tried = tried.withColumn("pattern", F.get(patterns, F.col("rule")))

    def blanks(s: Column) -> Column:
        return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))

    found = F.arrays_zip(
        F.transform(F.split("words", F.col("pattern"), -1), blanks).alias("before"),
        F.transform(F.regexp_extract_all("words", F.concat(F.lit("("), F.col("pattern"), F.lit(")")), F.lit(1)), blanks).alias("inside"),
    )
    places = tried.select("doc_id", "mark", "rule", F.posexplode(found).alias("at", "f")).where("f.inside IS NOT NULL")
    places = places.select("doc_id", "mark", "rule", "at", "f.before", "f.inside").distinct()
    along = Window.partitionBy("doc_id", "mark", "rule").orderBy("at")
    passed = F.sum(F.col("before").cast("bigint") + F.col("inside")).over(along)
    return places.select("doc_id", "mark", "rule", (passed - F.col("inside") - 1).alias("start"), passed.alias("end"))


def _settled(found: DataFrame) -> DataFrame:
    """Of detections that overlap those that stay."""
    by_place = Window.partitionBy("doc_id", "mark").orderBy("start", F.desc("end"), "priority", "rule")
    reach = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("reach", reach)
    opens = (F.col("reach").isNull() | (F.col("start") >= F.col("reach"))).cast("bigint")
    found = found.withColumn("island", F.sum(opens).over(by_place))
    hidden = F.coalesce(F.col("reach") >= F.col("end"), F.lit(False)).alias("hidden")
    order = F.struct(hidden, "priority", (F.col("start") - F.col("end")).alias("short"), "rule", "start", "end")
    islands = found.groupBy("doc_id", "mark", "island").agg(F.array_sort(F.collect_list(order)).alias("all"))

    def take(taken: Column, one: Column) -> Column:
        meets = F.exists(taken, lambda t: (t["start"] < one["end"]) & (one["start"] < t["end"]))
        place = F.struct(one["rule"].alias("rule"), one["start"].alias("start"), one["end"].alias("end"))
        return F.when(meets, taken).otherwise(F.concat(taken, F.array(place)))

    kept = F.aggregate("all", F.array().cast("array<struct<rule:int,start:bigint,end:bigint>>"), take)
    return islands.select("doc_id", "mark", F.inline(kept))


def _listed(settled: DataFrame, names: DataFrame) -> DataFrame:
    """The names that go on a list which a settled detection begins."""
    best = F.struct((F.col("start") - F.col("end")).alias("short"), "rule", "end")
    names = names.groupBy("doc_id", "mark", "start").agg(F.min(best).alias("b"))  # the longest of a place
    names = names.select("doc_id", "mark", "b.rule", "start", "b.end", F.lit(True).alias("follows"))
    every = settled.select("doc_id", "mark", "rule", "start", "end", F.lit(False).alias("follows")).unionByName(names)
    along = Window.partitionBy("doc_id", "mark").orderBy("start", "follows", "rule")
    before = F.max(F.when(~F.col("follows"), F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(F.when(~F.col("follows"), F.col("start")), ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing))
    meets = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    free = every.withColumn("meets", meets).where("NOT (follows AND meets)")
    goes_on = F.coalesce(F.lag("end").over(along) == F.col("start"), F.lit(False))
    chains = free.withColumn("chain", F.sum((~(F.col("follows") & goes_on)).cast("bigint")).over(along))
    led = F.min("follows").over(Window.partitionBy("doc_id", "mark", "chain"))
    return chains.withColumn("led", ~led).where("follows AND led").select("doc_id", "mark", "rule", "start", "end")


def detections(docs: DataFrame) -> DataFrame:
    """All detections that stay: ``doc_id, mark, start, end`` in words, and the rule's fields."""
    fields = ("label", "priority", "weight", "base", "follows")
    rules = F.array(*(F.struct(*(F.lit(getattr(r, f)).alias(f) for f in fields)) for r in RULES))
    columns = ("doc_id", "mark", "rule", "start", "end")

    def named(df: DataFrame) -> DataFrame:
        return df.select(*columns, F.get(rules, F.col("rule")).alias("r")).select(*columns, "r.*")

    found = stored(named(matches(docs)), "matches")  # numbers only, of few documents
    settled = stored(_settled(found.where("NOT base AND NOT follows")), "settled")
    listed = _listed(settled, found.where("follows"))
    kept = named(settled.select(*columns).unionByName(listed))
    return found.where("base").unionByName(kept).drop("follows")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with its phrases, labels and score."""
    base = F.col("base")
    labels = F.array_sort(F.collect_set("label"))
    found = (
        detections(docs)
        .groupBy("doc_id", "mark")
        .agg(
            F.count_if(base).alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"),
            F.max(F.when(base, F.col("start"))).alias("last_word"),
            F.concat_ws(",", F.array_sort(F.collect_set(F.when(base, F.col("label"))))).alias("base_labels"),
            F.concat_ws(",", labels).alias("labels"),
            F.max("weight").alias("score"),
        )
        .withColumnsRenamed({"doc_id": "o_doc_id", "mark": "o_mark"})
    )
    n_words = F.size(F.array_remove(F.split("text", BOTH_CASES), ""))
    counted = _keyed(docs).select("doc_id", "mark", n_words.cast("bigint").alias("n_words"))
    joined = counted.join(found, F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("mark") == F.col("o_mark")), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
