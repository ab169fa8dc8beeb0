"""License scan: ordered signature rules behind a keyword prefilter, overlaps settled by priority and containment.

A text is reduced to its words (ASCII letters folded, everything that is no ASCII letter, digit or other
letter a separator), joined by single spaces. Every rule is a regex over that form. Spans count words.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import ascii_lower


class Rule(NamedTuple):
    tier: int  # 0 is the strongest
    label: str
    keyword: str  # a text without it cannot match the regex
    regex: str
    weight: float


# Base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Words of which a text with any license notice holds at least one.
MASTER = ["licen", "copyright", "redistribution", "public domain", "creative", " cc by", "cc0", "warranty", "free software", "gpl", "what the fuck", "hereby granted", "endorse or promote", "advertising materials", "all rights reserved"]

# License families: label, regex of the name, keyword, versions ("" for none).
FAMILIES = [
    ("mit", r"mit", " mit ", [""]),
    ("mit", r"(?:the )?expat", " expat ", [""]),
    ("x11", r"x11", " x11 ", [""]),
    ("mit-0", r"mit (?:no attribution|0)", " mit ", [""]),
    ("apache", r"apache(?: software)?", "apache", ["1.0", "1.1", "2.0"]),
    ("gpl", r"(?:gnu )?general public", "general public", ["1.0", "2.0", "3.0"]),
    ("gpl", r"(?:gnu )?gpl", " gpl", ["1.0", "2.0", "3.0"]),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public", "general public", ["2.0", "2.1", "3.0"]),
    ("lgpl", r"(?:gnu )?lgpl", " lgpl", ["2.0", "2.1", "3.0"]),
    ("agpl", r"(?:gnu )?affero general public", "affero", ["1.0", "3.0"]),
    ("agpl", r"(?:gnu )?agpl", " agpl", ["1.0", "3.0"]),
    ("gfdl", r"(?:gnu )?free documentation", "documentation", ["1.1", "1.2", "1.3"]),
    ("mpl", r"mozilla public", "mozilla", ["1.0", "1.1", "2.0"]),
    ("epl", r"eclipse public", "eclipse", ["1.0", "2.0"]),
    ("edl", r"eclipse distribution", "eclipse", ["1.0"]),
    ("cddl", r"common development and distribution", "common development", ["1.0", "1.1"]),
    ("cpl", r"common public", "common public", ["1.0"]),
    ("eupl", r"european union public", "european union", ["1.0", "1.1", "1.2"]),
    ("osl", r"open software", "open software", ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", r"academic free", "academic free", ["1.2", "2.0", "2.1", "3.0"]),
    ("artistic", r"artistic", "artistic", ["1.0", "2.0"]),
    ("bsl", r"boost software", "boost", ["1.0"]),
    ("busl", r"business source", "business source", ["1.1"]),
    ("sspl", r"server side public", "server side", ["1.0"]),
    ("elastic", r"elastic", "elastic", ["2.0"]),
    ("ofl", r"(?:sil )?open font", "open font", ["1.0", "1.1"]),
    ("php", r"php", " php ", ["3.0", "3.01"]),
    ("psf", r"python software foundation", "python", ["2.0"]),
    ("zpl", r"zope public", "zope", ["2.0", "2.1"]),
    ("lppl", r"latex project public", "latex", ["1.0", "1.3"]),
    ("ms-pl", r"microsoft public", "microsoft", [""]),
    ("ms-rl", r"microsoft reciprocal", "microsoft", [""]),
    ("isc", r"isc", " isc ", [""]),
    ("zlib", r"(?:zlib|zlib libpng)", "zlib", [""]),
    ("ncsa", r"(?:university of illinois )?ncsa(?: open source)?", "ncsa", [""]),
    ("bsd-2-clause", r"(?:bsd 2 clause|(?:simplified|freebsd) bsd|2 clause bsd)", "bsd", [""]),
    ("bsd-3-clause", r"(?:bsd 3 clause|(?:new|revised|modified) bsd|3 clause bsd)", "bsd", [""]),
    ("bsd-4-clause", r"(?:bsd 4 clause|(?:original|old) bsd|4 clause bsd)", "bsd", [""]),
    ("0bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)", "bsd", [""]),
    ("wtfpl", r"wtfpl", "wtfpl", [""]),
    ("wtfpl", r"do what the fuck you want to public", "what the fuck", [""]),
    ("vim", r"vim", " vim ", [""]),
    ("upl", r"universal permissive", "universal permissive", ["1.0"]),
    ("odbl", r"open (?:data commons open )?database", "database", ["1.0"]),
    ("odc-by", r"open data commons attribution", "open data", ["1.0"]),
    ("pddl", r"(?:open data commons )?public domain dedication and", "public domain dedication", ["1.0"]),
]

# Creative commons terms: label, regex of the long name, regex of the short one.
COMMONS = [
    ("cc-by", r"attribution", r"by"),
    ("cc-by-sa", r"attribution share ?alike", r"by sa"),
    ("cc-by-nc", r"attribution non ?commercial", r"by nc"),
    ("cc-by-nd", r"attribution no ?deriv(?:ative)?s?", r"by nd"),
    ("cc-by-nc-sa", r"attribution non ?commercial share ?alike", r"by nc sa"),
    ("cc-by-nc-nd", r"attribution non ?commercial no ?deriv(?:ative)?s?", r"by nc nd"),
]
COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

# Sentences that only one license has: label, keyword, regex.
SENTENCES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "above copyright notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("apache-2.0", "apache", r"you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "free software", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", r"neither the name of .{1,800}? may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following"),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain"),
    ("bsl-1.0", "boost", r"boost software license version 1 0 august 17th 2003"),
    ("wtfpl", "what the fuck", r"you just do what the fuck you want to"),
    ("cc0-1.0", "cc0", r"creative commons (?:legal code )?cc0 1 0 universal"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "public domain", r"(?:has been |is |are )?(?:placed|dedicated|released) (?:in|to|into) the public domain"),
    ("proprietary", "all rights reserved", r"copyright .{0,800}?all rights reserved"),
]


def _version(v: str) -> str:
    """2.0 as the words of "2", "2.0", "v2.0", "version 2"."""
    if not v:
        return ""
    major, minor = v.split(".")
    tail = "(?: 0)?" if minor == "0" else f" {minor}"
    return rf"(?: version| v)? v?{major}{tail}"


def _rules() -> list[Rule]:
    """Every family in every version by four forms of notice, then the terms of creative commons and the sentences."""
    out = [Rule(0, label, keyword, regex, 1.0) for label, keyword, regex in SENTENCES]
    terms = r"under (?:the )?(?:terms of (?:the )?)?"
    grant = r"(?:released|distributed|available|published|provided|covered)"
    for label, name, keyword, versions in FAMILIES:
        for v in versions:
            full, tail = f"{label}-{v}" if v else label, _version(v)
            forms = [
                (1, rf"licen[sc]ed {terms}{name}(?: licen[sc]e)?{tail}", 0.95),
                (1, rf"{grant} {terms}{name} licen[sc]e{tail}", 0.95),
                (2, rf"{name} licen[sc]e{tail}", 0.8),
            ]
            if label in ("gpl", "lgpl", "agpl"):
                short = "gpl" in name
                forms.append((2, rf"{name}{'(?: licen[sc]e)?' if short else ' licen[sc]e'}{tail} or (?:at your option )?any later version", 0.9))
                forms += [(2, rf"{name}{tail}", 0.7)] * short
            for tier, regex, weight in forms:
                out.append(Rule(tier, f"{full}-or-later" if "later" in regex else full, keyword, regex, weight))
            out.append(Rule(1, full, "spdx", rf"spdx license identifier {re.sub('[-.]', ' ', full)}(?: only)?", 1.0))
        if versions != [""]:
            out.append(Rule(3, label, keyword, rf"{name} licen[sc]e", 0.6))
    for label, name, short in COMMONS:
        for v in ["", *COMMONS_VERSIONS]:
            full, spaced = f"{label}-{v}" if v else label, v.replace(".", " ")
            tail = f" {spaced}" if v else ""
            place = r"(?: international| unported| generic)?"
            out += [
                Rule(2 if v else 3, full, "commons", rf"creative commons {name}{tail}{place}(?: public)?(?: licen[sc]e)?", 0.9),
                Rule(2 if v else 3, full, "cc by", rf"cc {short}{tail}", 0.8),
            ]
            if v:
                out.append(Rule(1, full, "creativecommons", rf"creativecommons org licenses {short} {spaced}", 1.0))
    out += [
        Rule(1, "apache-2.0", "apache", r"www apache org licenses license 2 0", 1.0),
        Rule(1, "mit", "opensource", r"opensource org licenses mit(?: license php)?", 1.0),
        Rule(2, "cc0-1.0", "cc0", r"cc0(?: 1 0)?", 0.8),
        Rule(2, "unlicense", "unlicense", r"(?:the )?unlicense", 0.7),
    ]
    return list(dict.fromkeys(out))


RULES = _rules()
#: More characters than any rule can match.
LONGEST = 2000

# What parts words: all of ASCII but digits and letters (capitals are folded before).
GAPS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"


def words_of(text: Column) -> Column:
    """The words of a text, one space before and after each; one space alone when there are none."""
    body = ascii_lower(F.coalesce(text, F.lit("")))
    # A single blank is left as it stands, which is most of them.
    return F.regexp_replace(F.concat(F.lit(" "), body, F.lit(" ")), rf" [{GAPS}]+|[{GAPS}&&[^ ]][{GAPS}]*", " ")


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _found(words: Column, rule: Column) -> Column:
    """All places of one rule: the words are cut where a match begins, so each cut tells how many came before."""
    parts = F.split(words, F.concat(F.lit("(?= (?:"), rule["regex"], F.lit(") )")))
    start = F.struct(F.lit(0).alias("at"), F.lit(1).alias("char"), F.array().cast("array<struct<start:int,less_end:int,tier:int,label:string,weight:double>>").alias("spans"))

    def step(so_far: Column, part: Column) -> Column:
        # From the whole text, as a match may go on past the place where the next one begins.
        match = F.regexp_substr(F.substr(words, so_far["char"], F.lit(LONGEST)), F.concat(F.lit("^ (?:"), rule["regex"], F.lit(")(?= )")))
        span = F.struct(
            so_far["at"].alias("start"),
            (-(so_far["at"] + _spaces(match))).alias("less_end"),
            rule["tier"].alias("tier"),
            rule["label"].alias("label"),
            rule["weight"].alias("weight"),
        )
        spans = F.when(match.isNull(), so_far["spans"]).otherwise(F.concat(so_far["spans"], F.array(span)))
        return F.struct((so_far["at"] + _spaces(part)).alias("at"), (so_far["char"] + F.char_length(part)).alias("char"), spans.alias("spans"))

    return F.aggregate(parts, start, step, lambda s: s["spans"])


def _settled(spans: Column) -> Column:
    """Drop each span inside one of its own or a stronger tier; sorted by start and longest first, one sweep does it."""
    kept = F.array().cast("array<struct<start:int,end:int,tier:int,label:string,weight:double>>")
    first = F.struct(*[F.lit(-1).alias(f"e{t}") for t in range(4)], kept.alias("kept"))

    def step(so_far: Column, span: Column) -> Column:
        end = -span["less_end"]
        reach = F.greatest(*[F.when(span["tier"] >= t, so_far[f"e{t}"]).otherwise(-1) for t in range(4)])
        mine = F.array(F.struct(span["start"].alias("start"), end.alias("end"), span["tier"].alias("tier"), span["label"].alias("label"), span["weight"].alias("weight")))
        seen = [F.when(span["tier"] == t, F.greatest(so_far[f"e{t}"], end)).otherwise(so_far[f"e{t}"]).alias(f"e{t}") for t in range(4)]
        return F.struct(*seen, F.when(reach >= end, so_far["kept"]).otherwise(F.concat(so_far["kept"], mine)).alias("kept"))

    return F.aggregate(F.sort_array(spans), first, step, lambda s: s["kept"])


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    rules: Sequence[Rule] = RULES,
    master: Sequence[str] = MASTER,
) -> DataFrame:
    """For each row: number of words, places of the base phrases, detections of the rules, labels and a score.

    Nothing is shuffled and no row meets another. A text without any master word skips the rules, and a rule
    runs only where its keyword stands. `detections` are (start, end, tier, label, weight), in words.
    Null or empty text has no words, no label and score 0. Repeated rows each give a row; other columns of the
    input are left out.
    """
    texts = docs.select(F.col(key).alias("doc_id"), words_of(F.col(text)).alias("w"))
    either = "|".join(re.escape(p) for p in phrases)
    base = F.split("w", rf" (?=(?:{either}) )")
    texts = texts.withColumn("has_base", _any("w", [f" {p} " for p in phrases])).withColumn("has_rule", _any("w", master))
    texts = texts.withColumn("parts", F.when(F.col("has_base"), base))
    table = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(Rule._fields, r, strict=True)]) for r in rules])
    gated = F.filter(table, lambda r: F.contains(F.col("w"), r["keyword"]))
    found = F.flatten(F.transform(gated, lambda r: _found(F.col("w"), r)))
    texts = texts.withColumn("spans", F.when(F.col("has_rule"), found))
    texts = texts.withColumn("detections", F.when(F.size("spans") > 0, _settled(F.col("spans"))))
    texts = texts.withColumn("n_words", F.greatest(_spaces(F.col("w")) - 1, F.lit(0)).cast("long"))
    labels = F.array_compact(F.array(*[F.when(F.contains("w", F.lit(f" {p} ")), F.lit(label)) for p, label in phrases.items()]))
    texts = texts.withColumn("base", F.when(F.col("has_base"), F.array_sort(F.array_distinct(labels))).otherwise(F.array().cast("array<string>")))
    own = F.coalesce(F.transform("detections", lambda d: d["label"]), F.array().cast("array<string>"))
    strongest = F.coalesce(F.array_max(F.transform("detections", lambda d: d["weight"])), F.lit(0.0))
    return texts.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("parts") - 1, F.lit(0)).cast("long").alias("n_base"),
        _spaces(F.get("parts", F.lit(0))).cast("long").alias("first_word"),
        (F.col("n_words") - _spaces(F.element_at("parts", -1))).cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", own))), ",").alias("labels"),
        F.when(F.col("has_base"), F.lit(1.0)).otherwise(strongest).alias("score"),
        "detections",
    )


def _any(column: str, needles: Sequence[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(F.col(column), F.lit(n))
    return out


def license_digest(docs: DataFrame) -> DataFrame:
    found = scan_licenses(docs)
    spans = F.transform("detections", lambda d: F.concat_ws(":", d["label"], d["start"].cast("string"), d["end"].cast("string")))
    return found.withColumn("spans", F.coalesce(F.array_join(spans, ","), F.lit(""))).drop("detections")
