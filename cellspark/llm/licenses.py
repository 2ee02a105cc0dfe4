r"""License scans with ordered signature rules, in DataFrame functions only.

A text is brought to words (`[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing) joined by single spaces.  A rule is a
regular expression over that form with a keyword; a rule runs only where its keyword occurs, and rules run at all only on
texts that a cheap gate lets through.  Rules are products of names, versions and wordings, and clauses of license texts.  A detection is the interval of words that a rule covers.  A detection inside a
longer one goes; of equal intervals the rule of higher priority (earlier in order) stays.  There is no shuffle and no
join: rules are a constant array, each text is scanned once, in the task that reads it.

Cases: a null or empty text has no words, no labels and score 0; ties are settled by rule order; hits of one rule are
taken from left to right without overlaps; repeated rows get equal rows; very long texts are scanned whole; an empty table
gives an empty table; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Fixed values of the query: phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HITS = "array<struct<start:int,back:int,rank:int,label:string>>"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NAMES = "cc0?|0?bsd|spdx|wtfpl|copyleft|freebsd|(?:[al]?gpl|g?fdl|mpl|epl|cddl|eupl|apache|afl|osl|ofl|lppl|odbl|cecill)(?:v?[0-9]+)?"
_PHRASES = [
    "public domain", "creative commons", "rights reserved", "permission is hereby granted", "permission is granted", "hereby granted", "redistribution and use", "redistributions (?:of|in)", "free software", "unencumbered software",
    "implied warranty", "warranty of any kind", "unless required by applicable law", "shall be included in all copies", "to endorse or promote", "advertising materials", "plainly marked as such", "misrepresented",
    "waived all copyright", "anyone is free to copy", "just do what", "same terms as perl", "this product includes", "advertising without", "x consortium", "deal with the software", "as a service", "a beer", "jpeg group",
    "a package may be copied", "confidential and proprietary", "may be reproduced", "openrail", "mulan", "mit no attribution",
]
#: What a text must hold for any rule to run on it: a beginning of "license", a licence's name, or one of a few phrases.
GATE = rf"(?i)licen[cs]|(?<![A-Za-z0-9\u0080-\uFFFF])(?:{_NAMES}|{'|'.join(p.replace(' ', SEPARATORS) for p in _PHRASES)})(?![A-Za-z0-9\u0080-\uFFFF])"

#: label stem, (keyword, name) pairs, versions
VERSIONED = [
    ("agpl", [("affero", "(?:gnu )?affero general public license"), ("agpl", "(?:gnu )?agpl")], ["1.0", "3.0"]),
    ("lgpl", [("lesser", "(?:gnu )?(?:lesser|library) general public license"), ("lgpl", "(?:gnu )?lgpl")], ["2.0", "2.1", "3.0"]),
    ("gpl", [("general public license", "(?:gnu )?general public license"), ("gpl", "(?:gnu )?gpl")], ["1.0", "2.0", "3.0"]),
    ("gfdl", [("free documentation license", "(?:gnu )?free documentation license"), ("fdl", "g?fdl")], ["1.1", "1.2", "1.3"]),
    ("apache", [("apache license", "apache (?:software )?license"), ("apache", "apache")], ["1.0", "1.1", "2.0"]),
    ("mpl", [("mozilla public license", "mozilla public license"), ("mpl", "mpl")], ["1.0", "1.1", "2.0"]),
    ("epl", [("eclipse public license", "eclipse public license"), ("epl", "epl")], ["1.0", "2.0"]),
    ("cddl", [("common development", "common development and distribution license"), ("cddl", "cddl")], ["1.0", "1.1"]),
    ("eupl", [("european union public", "european union public licen[cs]e"), ("eupl", "eupl")], ["1.0", "1.1", "1.2"]),
    ("afl", [("academic free license", "academic free license"), ("afl", "afl")], ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("osl", [("open software license", "open software license"), ("osl", "osl")], ["1.0", "2.0", "2.1", "3.0"]),
    ("artistic", [("artistic license", "artistic license")], ["1.0", "2.0"]),
    ("lppl", [("latex project", "latex project public license"), ("lppl", "lppl")], ["1.0", "1.1", "1.2", "1.3"]),
    ("ofl", [("open font license", "(?:sil )?open font license"), ("ofl", "ofl")], ["1.0", "1.1"]),
    ("bsl", [("boost software license", "boost software license"), ("business source license", "business source license")], ["1.0", "1.1"]),
    ("cecill", [("cecill", "cecill(?: [bc])?")], ["1.0", "2.0", "2.1"]),
    ("odc-odbl", [("open database license", "open (?:data commons )?open database license|open database license"), ("odbl", "odbl")], ["1.0"]),
]
CREATIVE = {
    "cc-by-nc-sa": ("by nc sa", "attribution non ?commercial share ?alike"),
    "cc-by-nc-nd": ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    "cc-by-nc": ("by nc", "attribution non ?commercial"),
    "cc-by-sa": ("by sa", "attribution share ?alike"),
    "cc-by-nd": ("by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    "cc-by": ("by", "attribution"),
}
CREATIVE_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
#: label, keyword, name
PLAIN = [
    ("mit", "mit license", "(?:the )?mit license"),
    ("mit", "expat license", "(?:the )?expat license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd)(?: license)?"),
    ("bsd-2-clause", "freebsd", "freebsd(?: license)?"),
    ("bsd-3-clause", "bsd", "(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd)(?: license)?"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)(?: license)?"),
    ("bsd-zero-clause", "bsd", "(?:zero clause bsd|bsd zero clause)(?: license)?"),
    ("bsd-zero-clause", "0bsd", "0bsd(?: license)?"),
    ("bsd", "bsd license", "bsd license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification"),
    ("isc", "isc license", "(?:the )?isc license"),
    ("zlib", "zlib", "zlib(?: libpng)? license"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl(?: license)?"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "creative commons zero", "creative commons zero(?: v?1 0)?"),
    ("public-domain", "public domain", "(?:released|placed|dedicated|put|is) (?:in|into|to) the public domain"),
    ("postgresql", "postgresql license", "(?:the )?postgresql license"),
    ("python", "python software foundation license", "python software foundation license(?: version 2)?"),
    ("php", "php license", "php license(?: version 3(?: 01?)?)?"),
    ("ruby", "ruby license", "ruby license"),
    ("openssl", "openssl license", "openssl license"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa (?:open source )?license"),
    ("vim", "vim license", "vim license"),
    ("x11", "x11 license", "x11 license"),
    ("beerware", "beer", "beer ?ware license"),
    ("json", "json license", "json license"),
    ("ms-pl", "microsoft public license", "microsoft public license"),
    ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal license"),
    ("sspl", "server side public license", "server side public license"),
    ("proprietary", "all rights reserved", "all rights reserved"),
]
#: The identifiers of labels that have no versions of their own, in word form.
SPDX = {
    "mit": "mit", "bsd-2-clause": "bsd 2 clause", "bsd-3-clause": "bsd 3 clause", "bsd-4-clause": "bsd 4 clause", "bsd-zero-clause": "0bsd", "isc": "isc", "zlib": "zlib", "unlicense": "unlicense",
    "wtfpl": "wtfpl", "cc0": "cc0 1 0", "postgresql": "postgresql", "python": "(?:python|psf) 2 0", "php": "php 3 01?", "ruby": "ruby", "openssl": "openssl", "ncsa": "ncsa", "vim": "vim", "x11": "x11",
    "beerware": "beerware", "json": "json", "ms-pl": "ms pl", "ms-rl": "ms rl", "sspl": "sspl 1 0",
}


#: Clauses of license texts and notices: label, keyword, wording.  `some` stands for a few words that differ.
_SOME = "(?: [^ ]+){1,8}"
CLAUSES = [
    ("gpl", "this program is free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license(?: as published by the free software foundation)?"),
    ("gpl-2.0-or-later", "this program is free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "this program is free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "without even the implied warranty", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("gpl", "copy of the gnu general public license", "you should have received a copy of the gnu general public license along with this (?:program|software)"),
    ("gpl", "for most software are designed", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "free copyleft license", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl-2.1-or-later", "this library is free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl", "this library is free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl", "copy of the gnu lesser", "you should have received a copy of the gnu lesser general public license along with this (?:library|program)"),
    ("agpl", "copy of the gnu affero", "you should have received a copy of the gnu affero general public license along with this program"),
    ("agpl-3.0", "gnu affero general public license is", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("gfdl", "distribute and or modify this document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache-2.0", "you may not use this file except", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache", "apache software foundation asf", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-1.1", "developed by the apache software foundation", "this product includes software developed by the apache software foundation"),
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "shall be included in all copies", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "software is provided as is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit-0", "mit no attribution", "mit no attribution(?: license)?"),
    ("x11", "x consortium", "except as contained in this notice the name of(?: the)? x consortium shall not be used in advertising"),
    ("bsd", "redistributions of source code must retain", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "to endorse or promote products", f"neither the names? of{_SOME} nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials mentioning features", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-zero-clause", "with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "provided that the above copyright notice", "with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "altered source versions must", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "origin of this software must", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("bsl-1.0", "any person or organization obtaining", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("bsl-1.1", "production use", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "you just do what", "you just do what the [^ ]+ you want to"),
    ("cc0", "to the extent possible under law", f"to the extent possible under law{_SOME} (?:has|have) waived all copyright and related or neighboring rights"),
    ("cc-by", "creative commons attribution", "(?:this work is )?licensed under a creative commons attribution(?: [0-9] [0-9])?(?: international)? license"),
    ("cc-by-sa", "creative commons attribution share", "(?:this work is )?licensed under a creative commons attribution share ?alike(?: [0-9] [0-9])?(?: international)? license"),
    ("mpl-2.0", "this source code form", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "contents of this file are subject", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("cddl-1.0", "contents of this file are subject", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("epl-1.0", "accompanying materials are made available", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "accompanying materials are made available", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cpl-1.0", "common public license", "(?:ibm )?common public license(?: (?:version|v))?(?: v?1 0)?"),
    ("ipl-1.0", "ibm public license", "ibm public license(?: version 1 0)?"),
    ("eupl", "licensed under the eupl", f"licensed under the eupl(?: version [0-9] [0-9])?{_SOME} you may not use this work except in compliance with the licen[cs]e"),
    ("artistic", "conditions under which a package", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", "same terms as perl", "(?:you can redistribute it and or modify it )?under the same terms as perl(?: itself)?"),
    ("lppl", "conditions of the latex project", "this work may be distributed and or modified under the conditions of the latex project public license"),
    ("ofl-1.1", "this font software is licensed", "this font software is licensed under the sil open font license version 1 1"),
    ("openssl", "for use in the openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "cryptographic software written by", "this product includes cryptographic software written by eric young"),
    ("php", "php software freely", "this product includes php software freely available from"),
    ("python", "psf hereby grants licensee", "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform"),
    ("ncsa", "deal with the software without restriction", "to deal with the software without restriction including without limitation the rights to use copy modify"),
    ("sspl", "if you make the functionality", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2.0", "elastic license", "elastic license(?: v?2 0)?"),
    ("beerware", "buy me a beer", "you can buy me a beer in return"),
    ("ms-pl", "governs use of the accompanying software", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("curl", "curl license", "curl license"),
    ("ftl", "freetype license", "(?:the )?freetype (?:project )?license"),
    ("ijg", "independent jpeg group", "this software is based in part on the work of the independent jpeg group"),
    ("unicode", "unicode license", "unicode(?: inc)? license(?: agreement)?(?: v?3)?"),
    ("w3c", "w3c software", "w3c software(?: and document)?(?: notice and)? license"),
    ("zpl", "zope public license", "zope public license(?: (?:version|v))?(?: [0-9] [0-9])?"),
    ("qpl", "q public license", "q public license(?: version 1 0)?"),
    ("rpl", "reciprocal public license", "reciprocal public license(?: [0-9] [0-9])?"),
    ("upl", "universal permissive license", "universal permissive license(?: v? ?1 0)?"),
    ("mulan-psl", "mulan", "mulan (?:permissive software license|psl)(?: v ?[0-9])?"),
    ("odc-by", "open data commons attribution", "open data commons attribution license(?: v?1 0)?"),
    ("pddl", "public domain dedication and license", "public domain dedication and license"),
    ("cdla-permissive", "community data license agreement", "community data license agreement permissive(?: version)?(?: [0-9] 0)?"),
    ("openrail", "openrail", "(?:creativeml |bigscience |bigcode )?openrail(?: m)?(?: license)?"),
    ("llama", "community license agreement", "llama [0-9](?: [0-9])? community license agreement"),
    ("proprietary", "confidential and proprietary", "confidential and proprietary(?: information)?"),
    ("proprietary", "may be reproduced", "no part of this (?:publication|document|work|book) may be reproduced (?:stored|distributed|or transmitted)"),
]


def rules() -> list[tuple[str, str, str]]:
    """(label, keyword, regex over words) in order of priority: the most specific wording first."""
    out: list[tuple[str, str, str]] = []
    grant = "(?:is |are )?(?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?"
    for stem, names, versions in VERSIONED:
        for v in versions:
            major, minor = v.split(".")
            number = f"{major}(?: {minor})?" if minor == "0" else f"{major} {minor}"
            for word, name in names:
                tail = f"(?:{name})(?: licen[cs]e)?(?: (?:version|v))? ?v?{number}"
                out.append((f"{stem}-{v}-or-later", word, f"{tail} or (?:\\(?at your option\\)? )?(?:any )?later(?: version)?"))
                out.append((f"{stem}-{v}", word, f"{grant}{tail}"))
                out.append((f"{stem}-{v}", word, f"{tail}(?: only)?"))
            out.append((f"{stem}-{v}", "spdx license identifier", f"spdx license identifier {stem.replace('-', ' ')} {major} {minor}(?: only)?"))
    for stem, (short, long) in CREATIVE.items():
        for v in CREATIVE_VERSIONS:
            number = v.replace(".", " ")
            out.append((f"{stem}-{v}", "cc " + short, f"cc {short}(?: license)? v?{number}"))
            out.append((f"{stem}-{v}", "creative commons", f"creative commons {long} {number}(?: (?:international|unported|generic))?(?: license)?"))
        out.append((stem, "cc " + short, f"cc {short}"))
        out.append((stem, "creative commons", f"creative commons {long}(?: license)?"))
    for stem, names, _ in VERSIONED:
        for word, name in names:
            if word != "apache":
                out.append((stem, word, f"(?:{grant})?(?:{name})"))
    out += [(label, "spdx license identifier", f"spdx license identifier {name}") for label, name in SPDX.items()]
    out += CLAUSES
    for label, word, name in PLAIN:
        out.append((label, word, f"{grant}{name}"))
        out.append((label, word, name))
    return out


def word_form(text: Column) -> Column:
    """' w1 w2 ... wn ', or one space where there are no words; only A-Z are lowered."""
    inner = F.trim(F.regexp_replace(F.translate(text, UPPER, UPPER.lower()), SEPARATORS, " "))
    return F.when(inner == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def detections(form: Column, families: Column) -> Column:
    """array<struct<start, back, rank, label>> of all rules' hits; back is minus one past the last word.

    Of a rule, each hit's first word is marked in front and its last one behind, from left to right without overlaps; the
    places of marked words are the starts and stops, in order, so the work follows the text's words.
    """

    def hits(r: Column) -> Column:
        hit = F.concat(F.lit("(?<= )(?:"), r["regex"], F.lit(")(?= )"))

        def at(words: Column) -> Column:
            numbered = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda x: F.startswith(x["w"], F.lit("\x01")) | F.endswith(x["w"], F.lit("\x02")))
            starts, stops = (F.transform(F.filter(numbered, test), lambda x: x["i"]) for test in (lambda x: F.startswith(x["w"], F.lit("\x01")), lambda x: F.endswith(x["w"], F.lit("\x02"))))
            # words are split at single spaces, and the form begins with one
            return F.zip_with(starts, stops, lambda a, b: F.struct((a - 1).alias("start"), (-b).alias("back"), r["rank"].alias("rank"), r["label"].alias("label")))

        return F.when(F.regexp_like(form, hit), let(F.split(F.regexp_replace(form, hit, F.lit("\x01$0\x02")), " ", -1), at)).otherwise(F.array().cast(HITS))

    near = F.filter(families, lambda f: F.contains(form, F.concat(F.lit(" "), f["keyword"])))
    return F.flatten(F.transform(F.flatten(F.transform(near, lambda f: f["rules"])), hits))


def resolved(found: Column) -> Column:
    """Detections that no other one contains: longer wins, then the earlier rule; by start.

    Sorted by start, the longest first, a detection can only be contained by one before it.  One of each start is left after
    the first test, and none reaches further than the longest detection, so a bounded number is looked at for each.
    """

    def sift(s: Column) -> Column:
        firsts = F.filter(s, lambda x, i: ~F.coalesce(F.get(s, i - 1)["start"] == x["start"], F.lit(False)))

        def far(u: Column) -> Column:
            def test(reach: Column) -> Column:
                before = lambda i: F.slice(u, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, reach))
                return F.filter(u, lambda x, i: F.coalesce(F.array_min(F.transform(before(i), lambda y: y["back"])) > x["back"], F.lit(True)))

            return let(F.coalesce(F.array_max(F.transform(u, lambda x: -x["back"] - x["start"])), F.lit(0)), test)

        return let(firsts, far)

    kept = let(F.array_sort(found), sift)
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), (-x["back"]).alias("stop"), x["rank"].alias("rank"), x["label"].alias("label")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_of_rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """One row a document: n_words, the base phrases' count and places, labels, detections (array of word intervals), score."""
    listed = rules() if table_of_rules is None else table_of_rules
    families: dict[str, list[str]] = {}  # the rules of a keyword, which is looked for once
    for i, (label, word, regex) in enumerate(listed):
        families.setdefault(word, []).append(f"named_struct('rank', {i}, 'label', '{label}', 'regex', r'{regex}')")
    consts = F.expr("array(" + ", ".join(f"named_struct('keyword', '{k}', 'rules', array({', '.join(x)}))" for k, x in families.items()) + ")")
    phrases = "|".join(BASE)
    kind = "struct<n_base:bigint,first_word:bigint,last_word:bigint,base:array<string>,detections:array<struct<start:int,stop:int,rank:int,label:string>>>"

    def look(form: Column) -> Column:
        def of_base(parts: Column) -> Column:
            n = F.size(parts) - 1
            return F.struct(
                n.cast("long").alias("n_base"),
                F.when(n > 0, spaces(F.element_at(parts, 1))).cast("long").alias("first_word"),
                F.when(n > 0, spaces(form) - 1 - spaces(F.element_at(parts, -1))).cast("long").alias("last_word"),
                F.when(n > 0, F.array_compact(F.array(*[F.when(F.contains(form, F.lit(f" {p} ")), F.lit(a)) for p, a in BASE.items()]))).otherwise(F.array().cast("array<string>")).alias("base"),
                resolved(detections(form, consts)).alias("detections"),
            )

        return let(F.split(form, f" (?=(?:{phrases}) )", -1), of_base)

    nothing = F.struct(F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"), F.lit(None).cast("long").alias("last_word"), F.array().cast("array<string>").alias("base"), F.array().alias("detections")).cast(kind)
    text = F.coalesce(docs[text_col], F.lit(""))
    found = F.when(F.regexp_like(text, F.lit(GATE)), let(word_form(text), look).cast(kind)).otherwise(nothing)
    wide = docs.select(docs[id_col].alias("doc_id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), found.alias("f"))
    names = F.array_sort(F.array_distinct(F.concat(F.col("f.base"), F.transform("f.detections", lambda d: d["label"]))))
    longest = F.greatest(F.coalesce(F.array_max(F.transform("f.detections", lambda d: d["stop"] - d["start"])), F.lit(0)), F.when(F.col("f.n_base") > 0, 2).otherwise(0))
    return wide.select(
        "doc_id", "n_words", "f.n_base", "f.first_word", "f.last_word", F.array_join(F.array_sort(F.array_distinct("f.base")), ",").alias("base_labels"), F.array_join(names, ",").alias("labels"),
        F.when(longest == 0, 0.0).otherwise(F.least(F.lit(1.0), 0.5 + 0.1 * longest)).alias("score"), F.col("f.detections").alias("detections"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("detections")
