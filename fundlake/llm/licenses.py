"""License scan: ordered signature rules on the words of a text.

A rule is a sequence of words (``a|b`` alternatives, ``?`` optional) that a
passage of a license, a notice, name, tag, address or clue consists of; between two words stands any run
of separators, as between the words of a comment block. A text passes the
keyword prefilter or is done; of a passing text, only rules whose own keyword
stands in it run. Each match is an interval of words. Intervals are taken by
start, longest first; one that lies within an interval of equal or higher
priority is suppressed, and of equal intervals the earlier rule of the list wins.

All of it is one projection of DataFrame functions: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import fold_rows

# Separators and word characters: ASCII letters and digits, all non-ASCII characters.
SEP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
# The phrases and labels that are always scanned for.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

TEXT, NOTICE, VERSIONED, NAMED, CLUE = 4, 3, 2, 1, 0
RELEVANCE = {TEXT: 1.0, NOTICE: 1.0, VERSIONED: 0.9, NAMED: 0.7, CLUE: 0.3}


@dataclass(frozen=True)
class Family:
    label: str
    keyword: str          # gates those of its rules whose words hold it; see gate()
    names: tuple[str, ...]
    versions: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()


FAMILIES = (
    Family("gpl", "gnu", ("gnu general public license|licence", "gnu gpl"), ("1", "2", "2 0", "3", "3 0"), ("gpl 2 0", "gpl 3 0", "gpl 2 0 only", "gpl 2 0 or later", "gpl 3 0 only", "gpl 3 0 or later")),
    Family("lgpl", "lesser", ("gnu lesser general public license|licence", "gnu library|lesser general public license|licence"), ("2", "2 1", "3"), ("lgpl 2 1", "lgpl 3 0", "lgpl 2 1 or later", "lgpl 3 0 or later")),
    Family("agpl", "affero", ("gnu affero general public license|licence", "affero general public license|licence"), ("1", "3"), ("agpl 3 0", "agpl 3 0 only", "agpl 3 0 or later")),
    Family("gfdl", "free documentation", ("gnu free documentation license|licence",), ("1 1", "1 2", "1 3"), ("gfdl 1 2", "gfdl 1 3")),
    Family("apache", "apache", ("apache license|licence", "apache software license|licence"), ("1 0", "1 1", "2", "2 0"), ("apache 1 1", "apache 2 0")),
    Family("mit", "mit", ("mit license|licence", "mit x11 license|licence", "expat license|licence"), (), ("mit", "mit 0")),
    Family("bsd", "bsd", ("bsd license|licence", "bsd style license|licence", "new bsd license|licence", "simplified bsd license|licence", "revised bsd license|licence"), (), ("bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "0bsd")),
    Family("mpl", "mozilla", ("mozilla public license|licence",), ("1 0", "1 1", "2", "2 0"), ("mpl 1 1", "mpl 2 0")),
    Family("epl", "eclipse", ("eclipse public license|licence", "eclipse distribution license|licence"), ("1 0", "2 0"), ("epl 1 0", "epl 2 0")),
    Family("cddl", "distribution", ("common development and distribution license|licence",), ("1 0", "1 1"), ("cddl 1 0", "cddl 1 1")),
    Family("cpl", "common public", ("common public license|licence",), ("1 0",), ("cpl 1 0",)),
    Family("eupl", "european union", ("european union public license|licence",), ("1 1", "1 2"), ("eupl 1 1", "eupl 1 2")),
    Family("artistic", "artistic", ("artistic license|licence", "perl artistic license|licence"), ("1 0", "2 0"), ("artistic 1 0", "artistic 2 0")),
    Family("zlib", "zlib", ("zlib license|licence", "zlib libpng license|licence"), (), ("zlib",)),
    Family("boost", "boost", ("boost software license|licence",), ("1 0",), ("bsl 1 0",)),
    Family("isc", "isc", ("isc license|licence",), (), ("isc",)),
    Family("unlicense", "unlicense", ("the? unlicense",), (), ("unlicense",)),
    Family("wtfpl", "want to public", ("do what the fuck|f ck|k|fuck? you want to public license|licence",), ("2",), ("wtfpl",)),
    Family("python", "python", ("python software foundation license|licence", "python license|licence"), ("2", "2 0"), ("psf 2 0", "python 2 0")),
    Family("php", "php", ("php license|licence",), ("3 0", "3 01"), ("php 3 0", "php 3 01")),
    Family("ruby", "ruby", ("ruby license|licence", "ruby s license|licence"), (), ("ruby",)),
    Family("openssl", "openssl", ("openssl license|licence",), (), ("openssl",)),
    Family("postgresql", "postgresql", ("postgresql license|licence",), (), ("postgresql",)),
    Family("ofl", "open font", ("sil? open font license|licence",), ("1 0", "1 1"), ("ofl 1 0", "ofl 1 1")),
    Family("odbl", "open database", ("open database license|licence",), ("1 0",), ("odbl 1 0",)),
    Family("odc-by", "data commons", ("open data commons attribution license|licence",), ("1 0",), ("odc by 1 0",)),
    Family("pddl", "public domain dedication", ("public domain dedication and license|licence",), ("1 0",), ("pddl 1 0",)),
    Family("ncsa", "ncsa", ("university of illinois ncsa open source license|licence", "ncsa open source license|licence"), (), ("ncsa",)),
    Family("ms-pl", "microsoft", ("microsoft public license|licence", "microsoft reciprocal license|licence"), (), ("ms pl", "ms rl")),
    Family("osl", "open software", ("open software license|licence",), ("2 1", "3 0"), ("osl 2 1", "osl 3 0")),
    Family("afl", "academic free", ("academic free license|licence",), ("2 1", "3 0"), ("afl 2 1", "afl 3 0")),
    Family("qpl", "q public", ("q public license|licence",), ("1 0",), ("qpl 1 0",)),
    Family("cecill", "cecill", ("cecill license|licence", "cecill free software license|licence"), ("2 0", "2 1"), ("cecill 2 0", "cecill 2 1")),
    Family("mulan", "mulan", ("mulan permissive software license|licence", "mulan psl"), ("2",), ("mulanpsl 2 0",)),
    Family("cc-by", "cc by", ("cc by", "cc by license|licence"), ("2 0", "2 5", "3 0", "4 0"), ("cc by 3 0", "cc by 4 0")),
    Family("cc-by-sa", "cc by sa", ("cc by sa", "cc by sa license|licence"), ("2 0", "2 5", "3 0", "4 0"), ("cc by sa 3 0", "cc by sa 4 0")),
    Family("cc-by-nc", "cc by nc", ("cc by nc", "cc by nc license|licence"), ("2 0", "2 5", "3 0", "4 0"), ("cc by nc 3 0", "cc by nc 4 0")),
    Family("cc-by-nd", "cc by nd", ("cc by nd", "cc by nd license|licence"), ("2 0", "2 5", "3 0", "4 0"), ("cc by nd 3 0", "cc by nd 4 0")),
    Family("cc-by-nc-sa", "cc by nc sa", ("cc by nc sa", "cc by nc sa license|licence"), ("2 0", "2 5", "3 0", "4 0"), ("cc by nc sa 4 0",)),
    Family("cc-by-nc-nd", "cc by nc nd", ("cc by nc nd", "cc by nc nd license|licence"), ("2 0", "2 5", "3 0", "4 0"), ("cc by nc nd 4 0",)),
    Family("cc0", "cc0", ("cc0", "cc0 universal"), ("1 0",), ("cc0 1 0",)),
    Family("cc-attribution", "creative commons", ("creative commons attribution", "creative commons attribution license|licence"), ("2 0", "2 5", "3 0", "4 0")),
    Family("cc-attribution-sa", "creative commons", ("creative commons attribution share|sharealike alike? license|licence?",), ("3 0", "4 0")),
    Family("cc-attribution-nc", "creative commons", ("creative commons attribution non|noncommercial commercial? license|licence?",), ("3 0", "4 0")),
)
CLUES = (
    ("proprietary", "rights reserved", "all rights reserved"), ("proprietary", "proprietary", "proprietary and confidential"),
    ("proprietary", "permission", "may not be reproduced without prior? written? permission"),
    ("copyright", "copyright", "copyright c?"), ("public-domain", "public domain", "released|dedicated|placed into|to|in the public domain"),
    ("public-domain", "public domain", "public domain"), ("permissive-notice", "permission", "permission is hereby granted free of charge"),
    ("permissive-notice", "redistribution", "redistribution and use in source and binary forms"),
    ("warranty-notice", "warranty", "without warranty of any kind"), ("warranty-notice", "warranty", "provided as is without warranty"),
    ("see-license", "licen", "see the? license|licence|copying file? for details"), ("unknown-license", "licen", "licensed|licenced under"),
    ("unknown-license", "licen", "license|licence agreement"), ("unknown-license", "licen", "open source license|licence"),
)
# Passages of the licenses themselves and of their standard
# notices, and where their texts are published: (label, keyword, words).
TEXTS = (
    ("mit", "obtaining", "permission is hereby granted free of charge to any person obtaining a copy of this software and? associated? documentation? files? the software to deal in the software without restriction"),
    ("ncsa", "obtaining", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction"),
    ("boost-1.0", "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("x11", "advertising", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", "nor the names? of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledgement|acknowledgment"),
    ("isc", "without fee", "permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0bsd", "without fee", "permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("postgresql", "written agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "without fee", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("zlib", "held liable", "provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", "irrevocable", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright|patent license"),
    ("apache-1.1", "apache", "this product includes software developed by the apache software foundation"),
    ("openssl", "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php", "php", "this product includes php software freely available from"),
    ("gpl-2.0", "verbatim", "gnu general public license version 2 june 1991"),
    ("gpl-2.0", "freedom to share", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3.0", "affero", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl-3.0", "lesser", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("gnu-license-text", "verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("wtfpl", "verbatim", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("gfdl-1.3-or-later", "documentation", "copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3 or any later version"),
    ("gfdl-1.2-or-later", "documentation", "copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2 or any later version"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("cddl", "distribution", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("epl-1.0", "eclipse", "accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "eclipse", "accompanying materials are made available under the terms of the eclipse public license v|version? 2 0"),
    ("artistic-2.0", "redistributed", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("python-2.0", "licensee", "psf hereby grants|is granting licensee a nonexclusive royalty free world wide license to reproduce analyze test perform"),
    ("ofl-1.1", "font", "this font software is licensed under the sil open font license version 1 1"),
    ("cc0-1.0", "waived", "waived all copyright and related or neighboring|neighbouring rights"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("beerware", "retain", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("classpath-exception-2.0", "statically", "linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gcc-exception", "runtime library", "gcc runtime library exception"),
    ("sspl", "server side", "server side public license|licence"), ("busl", "business source", "business source license|licence"),
    ("elastic", "elastic", "elastic license|licence 2 0"),
    ("commons-clause", "commons clause", "the software is provided to you by the licensor under the license as defined below subject to the following condition"),
    ("apache-2.0", "apache org", "apache org licenses license 2 0"), ("mit", "opensource org", "opensource org licenses|license mit"),
    ("bsd-2-clause", "opensource org", "opensource org licenses|license bsd 2 clause"), ("bsd-3-clause", "opensource org", "opensource org licenses|license bsd 3 clause"),
    ("isc", "opensource org", "opensource org licenses|license isc"), ("mpl-2.0", "mozilla org", "mozilla org mpl 2 0"),
    ("gpl-3.0", "gnu org", "gnu org licenses gpl 3 0"), ("gpl-2.0", "gnu org", "gnu org licenses old licenses gpl 2 0"),
    ("gpl", "gnu org", "gnu org licenses gpl"), ("lgpl", "gnu org", "gnu org licenses lgpl"), ("agpl", "gnu org", "gnu org licenses agpl"),
    ("boost-1.0", "boost org", "boost org license 1 0 txt"), ("epl-2.0", "eclipse org", "eclipse org legal epl 2 0"), ("epl-1.0", "eclipse org", "eclipse org legal epl v10"),
    ("cc-by-4.0", "creativecommons", "creativecommons org licenses by 4 0"), ("cc-by-3.0", "creativecommons", "creativecommons org licenses by 3 0"),
    ("cc-by-sa-4.0", "creativecommons", "creativecommons org licenses by sa 4 0"), ("cc-by-sa-3.0", "creativecommons", "creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-4.0", "creativecommons", "creativecommons org licenses by nc 4 0"), ("cc-by-nd-4.0", "creativecommons", "creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-sa-4.0", "creativecommons", "creativecommons org licenses by nc sa 4 0"), ("cc-by-nc-nd-4.0", "creativecommons", "creativecommons org licenses by nc nd 4 0"),
    ("cc0-1.0", "publicdomain", "creativecommons org publicdomain zero 1 0"), ("ofl-1.1", "scripts sil", "scripts sil org ofl"),
)
# The version clauses of the GNU licenses: (label, words of the name, versions).
GNU = (("gpl", "gnu general public license|licence", ("1", "2", "3")), ("agpl", "gnu affero general public license|licence", ("3",)),
       ("lgpl", "gnu lesser general public license|licence", ("2 1", "3")), ("lgpl", "gnu library general public license|licence", ("2",)))
PUBLISHED = "{} as published by the free software foundation"
MODIFY = "redistribute it and or modify it under the terms of the "
# Short names with their versions, also written in one word (GPLv3).
SHORT = (("gpl", ("2", "3", "2 0", "3 0")), ("lgpl", ("2", "2 1", "3", "3 0")), ("agpl", ("3", "3 0")), ("mpl", ("1 1", "2 0")),
         ("epl", ("1 0", "2 0")), ("cddl", ("1 0", "1 1")), ("eupl", ("1 1", "1 2")))
# Tags of license expressions besides those of the families: exceptions and newer licenses.
TAGS = ("classpath exception 2 0", "gcc exception 3 1", "llvm exception", "linux syscall note", "autoconf exception 3 0", "bison exception 2 2",
        "font exception 2 0", "openvpn openssl exception", "busl 1 1", "bsl 1 1", "sspl 1 0", "elastic 2 0", "hpnd", "x11", "blueoak 1 0 0", "upl 1 0")
NOTICES = ("licensed|licenced under the? terms|conditions? of? the? {}", "released|distributed|available|published under the? terms|conditions? of? the? {}",
           "redistribute it and or modify it under the terms of the {}")


def pattern(phrase: str) -> str:
    """The regex of a word sequence, between word bounds, ASCII case ignored.
    The first word is never optional unless a required word follows it."""
    out, need_gap = "", False
    for token in phrase.split():
        optional = token.endswith("?")
        word = "(?:" + token.rstrip("?") + ")" if "|" in token else token.rstrip("?")
        if optional and not need_gap:
            out += f"(?:{word}{SEP}+)?"
        elif optional:
            out += f"(?:{SEP}+{word})?"
        else:
            out += (f"{SEP}+" if need_gap else "") + word
            need_gap = True
    return f"(?i)(?<!{WORD}){out}(?!{WORD})"


def _required(phrase: str) -> list[str]:
    """Texts of which a match of the phrase holds each, separators as one space:
    the runs of words that are neither optional nor one of several."""
    out, run = [], []
    for token in [*phrase.split(), "?"]:
        if "|" in token or token.endswith("?"):
            out += [" ".join(run)] if run else []
            run = []
        else:
            run.append(token)
    return out


def holds(phrase: str, keyword: str) -> bool:
    """Whether the keyword stands in every match of the phrase."""
    choices = [t.split("|") for t in phrase.split() if "|" in t and not t.endswith("?")]
    return any(keyword in run for run in _required(phrase)) or any(all(keyword in w for w in c) for c in choices)


def gate(phrase: str, keyword: str) -> str:
    """The keyword, if every match of the phrase holds it, or else the longest text that one does."""
    return keyword if holds(phrase, keyword) else max(_required(phrase), key=len)


def listed() -> list[tuple[str, str, str, int]]:
    """(keyword, phrase, label, priority), in order: what precedes wins ties."""
    out = []

    def add(keyword: str, phrase: str, label: str, priority: int) -> None:
        out.append((gate(phrase, keyword), phrase, label, priority))

    for f in FAMILIES:
        for name in f.names:
            for v in f.versions:
                said = f"{name} version|v? {v}"
                add(f.keyword, said, f"{f.label}-{v.replace(' ', '.')}", VERSIONED)
                for n in NOTICES[:2]:
                    add(f.keyword, n.format(said), f"{f.label}-{v.replace(' ', '.')}", NOTICE)
            for n in NOTICES:
                add(f.keyword, n.format(name), f.label, NOTICE)
            add(f.keyword, name, f.label, NAMED)
            for v in f.versions:
                add(f.keyword, f"{name} v{v}", f"{f.label}-{v.replace(' ', '.')}", VERSIONED)
    for t in tags():
        add("spdx", f"spdx license identifier {t}", f"spdx-{t.replace(' ', '-')}", NOTICE)
    for label, k, p in TEXTS:
        add(k, p, label, TEXT)
    for label, name, versions in GNU:
        for v in versions:
            for start in ("", MODIFY):
                told = start + PUBLISHED.format(name)
                add("free software", f"{told} either version {v} of the license|licence or at? your? option? any later version", f"{label}-{v.replace(' ', '.')}-or-later", TEXT)
                add("free software", f"{told} version {v}", f"{label}-{v.replace(' ', '.')}", TEXT)
    for name, versions in SHORT:
        for v in versions:
            for said in (f"{name} version|v? {v}", f"{name} v{v}", f"{name}v{v}"):
                add(name, said, f"{name}-{v.replace(' ', '.')}", VERSIONED)
                add(name, f"licensed|licenced|released|distributed|available under the? {said}", f"{name}-{v.replace(' ', '.')}", NOTICE)
        add(name, f"licensed|licenced|released|distributed|available under the? {name}", name, NOTICE)
    for label, k, p in CLUES:
        add(k, p, label, CLUE)
    return out


def tags() -> list[str]:
    return [t for f in FAMILIES for t in f.tags] + list(TAGS)


#: What stands before a later member of a license expression, on its line.
EXPRESSION = r"(?<=spdx-license-identifier:[^\n]{0,200}[ )](?:or|and|with)[ (]{1,3})"


def rules() -> list[tuple[str, str, str, int]]:
    """(keyword, regex, label, priority) of the listed rules, and of each tag as
    a later member of a license expression (``A OR B``, ``A WITH B``)."""
    later = [("spdx", "(?i)" + EXPRESSION + pattern(t).removeprefix("(?i)"), f"spdx-{t.replace(' ', '-')}", NOTICE) for t in tags()]
    return [(k, pattern(p), label, priority) for k, p, label, priority in listed()] + later


#: A text without any of these words, or "cc by", holds no match of any rule.
PREFILTER = ("licen", "spdx", "cc0", "reserved", "proprietary", "permission", "copyright", "domain", "warranty",
             "redistribut", "creative", "reproduced", "gpl", "mulan", "copying", "endorse", "advertising", "openssl", "apache",
             "verbatim", "evil", "retain", "statically", "mozilla", "php", "published", "runtime", "dealings", "neighbo", "mpl", "epl",
             "cddl", "eupl", "scripts", "freedom")


def _count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, f"{SEP}+"), ""))


def _spaced(text: Column) -> Column:
    """The text lower-cased with one space for each run of separators: keywords
    of several words are looked up here."""
    return F.lower(F.regexp_replace(text, f"{SEP}+", " "))


_SPANS = "array<struct<at:int,n:int>>"


def _spans(text: Column, regex: Column) -> Column:
    """array<struct<at, n>>: first word and number of words of each match."""
    # One piece more than matches: the last pair has no match and gives nothing.
    pairs = F.zip_with(F.split(text, regex), F.regexp_extract_all(text, regex, F.lit(0)),
                       lambda p, m: F.struct(_count(p).alias("p"), F.when(m.isNotNull(), _count(m)).alias("m")))

    def step(words: Column, x: Column) -> tuple[Column, Column]:
        hit = F.array(F.struct((words + x["p"]).alias("at"), x["m"].alias("n")))
        return words + x["p"] + F.coalesce(x["m"], F.lit(0)), F.when(x["m"].isNotNull(), hit).otherwise(F.array().cast(_SPANS))

    return fold_rows(pairs, F.lit(0), _SPANS, step)


_HIT = "array<struct<at:int,till:int,priority:int,rule:int,label:string>>"


def _detections(text: Column) -> Column:
    """All matches of the rules whose keyword the text holds."""
    listed = F.array(*[F.struct(F.lit(k).alias("keyword"), F.lit(r).alias("regex"), F.lit(label).alias("label"),
                                F.lit(p).alias("priority"), F.lit(i).alias("rule")) for i, (k, r, label, p) in enumerate(rules())])
    keywords = F.array(*[F.lit(k) for k in sorted({k for k, *_ in rules()})])
    present = F.transform(F.array(_spaced(text)), lambda low: F.filter(keywords, lambda k: F.contains(low, k)))
    ready = F.transform(present, lambda ks: F.filter(listed, lambda r: F.array_contains(ks, r["keyword"])))[0]
    found = F.filter(ready, lambda r: F.rlike(text, r["regex"]))
    return F.flatten(F.transform(found, lambda r: F.transform(
        _spans(text, r["regex"]),
        lambda s: F.struct(s["at"].alias("at"), (s["at"] + s["n"]).alias("till"), r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label")))))


def _kept(found: Column) -> Column:
    """Matches that no match of equal or higher priority contains."""
    ordered = F.array_sort(F.transform(found, lambda d: F.struct(
        d["at"].alias("at"), (-d["till"]).alias("back"), (-d["priority"]).alias("low"), d["rule"].alias("rule"), d["label"].alias("label"))))

    def step(reach: Column, d: Column) -> tuple[Column, Column]:
        till, priority = -d["back"], -d["low"]
        inside = F.get(reach, priority) >= till
        hit = F.array(F.struct(d["at"].alias("at"), till.alias("till"), priority.alias("priority"), d["rule"].alias("rule"), d["label"].alias("label")))
        return (F.transform(reach, lambda r, p: F.when(~inside & (p <= priority), F.greatest(r, till)).otherwise(r)),
                F.when(inside, F.array().cast(_HIT)).otherwise(hit))

    return fold_rows(ordered, F.array(*[F.lit(-1)] * len(RELEVANCE)), _HIT, step)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, detections (at, till, label: words
    from ``at`` up to ``till``).

    Null and empty texts have no words, no places (first and last null), empty
    labels and score 0. The score is the relevance of the strongest detection.
    Repeated rows stay; an empty table gives no rows; other columns are not read."""
    base_regex = F.lit("|".join(pattern(p) for p, _ in BASE))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    low = F.lower("text")
    passes = F.transform(F.array(low), lambda x: _any(x))[0] | F.col("text").rlike(f"(?i)cc{SEP}+by")
    given = given.withColumn("passes", passes).withColumn("n_words", _count(F.col("text")).cast("long"))
    given = given.withColumn("places", F.when(F.col("passes"), _spans(F.col("text"), base_regex)).otherwise(F.array().cast(_SPANS))) \
        .withColumn("hits", F.when(F.col("passes"), _kept(_detections(F.col("text")))).otherwise(F.array().cast(_HIT)))
    given = given.withColumn("base", F.array_sort(F.filter(F.array(*[
        F.when(F.col("passes") & F.col("text").rlike(pattern(p)), F.lit(label)) for p, label in BASE]), lambda x: x.isNotNull())))
    score = F.aggregate("hits", F.lit(0.0), lambda a, h: F.greatest(a, F.element_at(
        F.array(*[F.lit(RELEVANCE[p]) for p in sorted(RELEVANCE)]), h["priority"] + 1)))
    return given.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.get("places", F.lit(0))["at"].cast("long").alias("first_word"),
        F.get("places", F.size("places") - 1)["at"].cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.transform("hits", lambda h: h["label"])))), ",").alias("labels"),
        score.alias("score"),
        F.transform("hits", lambda h: F.struct(h["at"].alias("at"), h["till"].alias("till"), h["label"].alias("label"))).alias("detections"))


def _any(low: Column) -> Column:
    out = F.contains(low, F.lit(PREFILTER[0]))
    for k in PREFILTER[1:]:
        out = out | F.contains(low, F.lit(k))
    return out
