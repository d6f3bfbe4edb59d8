"""License scans by ordered signature rules, with built-in functions only.

A text is reduced to its words. A table of licence families, each with a few
forms in which it is spoken of, gives a few hundred regular expressions over
the words. A rule is tried only where its keyword, which all its matches
contain, stands in the text. Of two detections one of which lies within the other, the inner one is
dropped unless its rule has priority: tags come before grants, grants before
names, names before mentions. All of it happens within the row: nothing is
joined or shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The phrases every scan looks for, and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TAG, GRANT, NAME, MENTION = 1, 2, 3, 4  # priorities, strongest first
CONFIDENCE = {TAG: 1.0, GRANT: 0.9, NAME: 0.75, MENTION: 0.5}

_LIC = "licen[sc]e"
_V = r"(?: v(?:ersion)?)?"
_LATER = "(?: or (?:any )?later(?: version)?)?"

# label; keyword that stands in every match of name and mention; name; tag words
# (none for texts that no identifier names); mention.
FAMILIES: tuple[tuple[str, str, str, str | None, str], ...] = (
    ("gpl-2.0", "gnu", rf"gnu general public {_LIC}{_V} 2(?: 0)?{_LATER}", "gpl 2 0(?: only| or later)?", r"gnu gpl ?v?2"),
    ("gpl-3.0", "gnu", rf"gnu general public {_LIC}{_V} 3(?: 0)?{_LATER}", "gpl 3 0(?: only| or later)?", r"gnu gpl ?v?3"),
    ("gpl", "gnu", rf"(?:the )?gnu general public {_LIC}", "gpl", "gnu gpl"),
    ("lgpl", "gnu", rf"gnu (?:lesser|library) general public {_LIC}(?:{_V} [23](?: [01])?)?{_LATER}", "lgpl [23] [01](?: only| or later)?", "gnu lgpl"),
    ("agpl", "gnu", rf"gnu affero general public {_LIC}(?:{_V} 3(?: 0)?)?{_LATER}", "agpl 3 0(?: only| or later)?", "gnu agpl"),
    ("gfdl", "gnu", rf"gnu free documentation {_LIC}(?:{_V} 1 [1-3])?", "gfdl 1 [1-3]", "gnu fdl"),
    ("gpl-mention", "gpl", r"gpl ?v?[23](?: 0)?", "gpl [123] 0", "(?:a|l)?gpl(?:v[23])?"),
    ("apache-2.0", "apache", rf"apache {_LIC}{_V} 2(?: 0)?", "apache 2 0", "apache 2(?: 0)?"),
    ("apache-1.1", "apache", rf"apache software {_LIC}(?:{_V} 1 [01])?", "apache 1 [01]", "apache 1 [01]"),
    ("apache", "apache", rf"apache {_LIC}", "apache", "apache licensed"),
    ("mit", "mit licen", rf"mit {_LIC}", "mit", "mit licensed"),
    ("mit-text", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", None, "permission is hereby granted"),
    ("mit-0", "mit 0", rf"mit 0(?: {_LIC})?", "mit 0", "mit 0 licensed"),
    ("x11", "x11", rf"x11 {_LIC}", "x11", "mit x11"),
    ("bsd-2-clause", "bsd", rf"(?:simplified|freebsd|2 clause) bsd {_LIC}|bsd 2 clause(?: {_LIC})?", "bsd 2 clause(?: patent)?", "bsd 2"),
    ("bsd-3-clause", "bsd", rf"(?:new|revised|modified|3 clause) bsd {_LIC}|bsd 3 clause(?: {_LIC})?", "bsd 3 clause(?: clear)?", "bsd 3"),
    ("bsd-4-clause", "bsd", rf"(?:original|old|4 clause) bsd {_LIC}|bsd 4 clause(?: {_LIC})?", "bsd 4 clause", "bsd 4"),
    ("bsd", "bsd", rf"(?:berkeley software distribution|bsd) {_LIC}", "bsd", "bsd (?:style|licensed)"),
    ("bsd-text", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted", None, "redistribution and use"),
    ("0bsd", "bsd", rf"(?:zero clause bsd|0bsd)(?: {_LIC})?", "0bsd", "0bsd licensed"),
    ("isc", "isc licen", rf"isc {_LIC}", "isc", "isc licensed"),
    ("mpl-1.1", "mozilla", rf"mozilla public {_LIC}{_V} 1 [01]", "mpl 1 [01]", "mozilla public 1 [01]"),
    ("mpl-2.0", "mozilla", rf"mozilla public {_LIC}{_V} 2(?: 0)?", "mpl 2 0", "mozilla public 2 0"),
    ("mpl", "mozilla", rf"mozilla public {_LIC}", "mpl", "mozilla public"),
    ("epl", "eclipse", rf"eclipse public {_LIC}(?:{_V} [12] 0)?", "epl [12] 0", "eclipse public"),
    ("edl", "eclipse", rf"eclipse distribution {_LIC}(?:{_V} 1 0)?", "edl 1 0", "eclipse distribution"),
    ("cddl", "common development", rf"common development and distribution {_LIC}(?:{_V} 1 [01])?", "cddl 1 [01]", "common development and distribution"),
    ("cpl", "common public", rf"common public {_LIC}(?:{_V} 1 0)?", "cpl 1 0", "common public license"),
    ("cc-by-sa", "attribution", r"(?:creative commons )?attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?", "cc by sa [1-4] [05]", "attribution share ?alike"),
    ("cc-by-nc", "attribution", r"(?:creative commons )?attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?", "cc by nc [1-4] [05]", "attribution non ?commercial"),
    ("cc-by-nd", "attribution", r"(?:creative commons )?attribution no ?deriv(?:ative|s|atives)(?: [1-4] [05])?", "cc by nd [1-4] [05]", "attribution no ?derivs"),
    ("cc-by-4.0", "creative commons", r"creative commons attribution 4 0(?: international)?", "cc by 4 0", "creative commons attribution 4"),
    ("cc-by-3.0", "creative commons", r"creative commons attribution 3 0(?: unported)?", "cc by 3 0", "creative commons attribution 3"),
    ("cc-by", "cc by", rf"cc by(?: {_LIC})?", "cc by", "cc by"),
    ("cc-by-sa", "cc by sa", rf"cc by sa(?: [1-4] [05])?(?: {_LIC})?", "cc by sa", "cc by sa"),
    ("cc-by-nc", "cc by nc", rf"cc by nc(?: [1-4] [05])?(?: {_LIC})?", "cc by nc", "cc by nc"),
    ("cc-by-nc-sa", "cc by nc sa", rf"cc by nc sa(?: [1-4] [05])?(?: {_LIC})?", "cc by nc sa [1-4] [05]", "cc by nc sa"),
    ("cc-by-nd", "cc by nd", rf"cc by nd(?: [1-4] [05])?(?: {_LIC})?", "cc by nd", "cc by nd"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "cc0"),
    ("creative-commons", "creative commons", rf"creative commons {_LIC}", "cc", "creative commons"),
    ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", None, "public domain"),
    ("unlicense", "unlicense", "the unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", rf"do what the \w+ you want to public {_LIC}|wtfpl {_LIC}", "wtfpl", "wtfpl"),
    ("zlib", "zlib", rf"zlib(?: libpng)? {_LIC}", "zlib(?: acknowledgement)?", "zlib licensed"),
    ("boost", "boost", rf"boost software {_LIC}(?:{_V} 1 0)?", "bsl 1 0", "boost licensed"),
    ("artistic-2.0", "artistic", rf"artistic {_LIC}{_V} 2 0", "artistic 2 0", "artistic 2"),
    ("artistic", "artistic", rf"(?:perl )?artistic {_LIC}", "artistic 1 0", "artistic licensed"),
    ("python", "python", rf"python (?:software foundation )?{_LIC}(?:{_V} 2)?", "(?:psf|python) 2 0", "psf licensed"),
    ("postgresql", "postgresql", rf"postgresql {_LIC}", "postgresql", "postgresql licensed"),
    ("openssl", "openssl", rf"openssl {_LIC}", "openssl", "openssl licensed"),
    ("ofl", "open font", rf"(?:sil )?open font {_LIC}(?:{_V} 1 [01])?", "ofl 1 [01]", "open font"),
    ("odbl", "open database", rf"open (?:data commons )?(?:open )?database {_LIC}", "odbl 1 0", "open database license"),
    ("elastic", "elastic", rf"elastic {_LIC}(?: 2 0)?", "elastic 2 0", "elastic licensed"),
    ("busl", "business source", rf"business source {_LIC}(?: 1 1)?", "busl 1 1", "business source"),
    ("all-rights-reserved", "rights reserved", "all rights reserved", "licenseref all rights reserved", "rights reserved"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?", "licenseref copyright", "copyright notice"),
    ("proprietary", "proprietary", "proprietary and confidential", "licenseref proprietary", rf"proprietary {_LIC}"),
    ("no-warranty", "without warranty", "without warranty of any kind", "licenseref as is", "as is without warranty"),
)


# Forms whose matches need not contain their family's keyword.
NAME_KEYWORDS = {"bsd": "licen", "wtfpl": "licen", "odbl": "database licen"}
MENTION_KEYWORDS = {"python": "psf"}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int


def _whole_words(body: str) -> str:
    return rf"(?<![^ ])(?:{body})(?![^ ])"


def rules(families: Sequence[tuple[str, str, str, str | None, str]] = FAMILIES) -> list[Rule]:
    """The families' rules in order: a tag if there is one, two kinds of grant,
    the name and a mention each."""
    made = []
    for label, family_keyword, name, tag, mention in families:
        keyword = NAME_KEYWORDS.get(label, family_keyword)
        if tag is not None:
            made.append(Rule(label, "spdx", _whole_words(rf"spdx {_LIC} identifier (?:{tag})"), TAG))
        made += [
            Rule(
                label,
                keyword,
                _whole_words(
                    r"(?:licensed|released|distributed|published|provided|available|made available) under (?:the )?"
                    rf"(?:terms (?:and conditions )?of (?:the )?)?(?:{name})"
                ),
                GRANT,
            ),
            Rule(label, keyword, _whole_words(rf"(?:subject to|governed by|under the terms of) (?:the )?(?:{name})"), GRANT),
            Rule(label, keyword, _whole_words(name), NAME),
            Rule(label, MENTION_KEYWORDS.get(label, family_keyword), _whole_words(mention), MENTION),
        ]
    return made


def license_words(text: Column | str) -> Column:
    """The words of a text, A-Z lower-cased, with single spaces between; empty
    for null."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), NO_WORD, " "))


def count_words(words: Column) -> Column:
    spaces = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
    return F.when(words == "", 0).otherwise(spaces + 1).cast("long")


def _words_before(words: Column, chars: Column) -> Column:
    """The index of the word that begins after ``chars`` characters."""
    head = F.substring(words, F.lit(1), chars)
    return F.length(head) - F.length(F.replace(head, F.lit(" "), F.lit("")))


def base_columns(words: Column) -> dict[str, Column]:
    """``n_base``, ``first_word``, ``last_word`` and ``base_labels`` (an array)."""
    any_phrase = _whole_words("|".join(p for p, _ in BASE_PHRASES))
    gate = words.contains("license") | words.contains("cc by")
    n = F.when(gate, F.regexp_count(words, F.lit(any_phrase))).otherwise(0)
    first = F.regexp_instr(words, F.lit(any_phrase)) - 1
    last = F.length(F.regexp_extract(words, rf"(?s)^(.*){any_phrase}", 1))
    has = F.when(gate, words.rlike(any_phrase)).otherwise(False)
    labels = F.array_compact(
        F.array(*[F.when(has & words.rlike(_whole_words(p)), F.lit(label)) for p, label in BASE_PHRASES])
    )
    return {
        "n_base": n.cast("long"),
        "first_word": F.when(has, _words_before(words, first)).cast("long"),
        "last_word": F.when(has, _words_before(words, last)).cast("long"),
        "base_labels": F.sort_array(F.when(has, labels).otherwise(F.array().cast("array<string>"))),
    }


_DETECTION = "struct<start:int,inner:int,priority:int,rule:int,label:string>"


def _rule_hits(words: Column, rule: Column) -> Column:
    """All places of one rule: between the pieces that its matches cut out."""
    matches = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    sizes = F.zip_with(
        F.transform(F.split(words, rule["pattern"], -1), F.length),
        F.transform(matches, F.length),
        lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_DETECTION}>").alias("found"))

    def step(state: Column, size: Column) -> Column:
        begin = state["at"] + size["gap"]
        hit = F.struct(
            begin.alias("start"),
            (-(begin + size["hit"])).alias("inner"),
            rule["priority"].alias("priority"),
            rule["rule"].alias("rule"),
            rule["label"].alias("label"),
        )
        return F.struct(
            (begin + F.coalesce(size["hit"], F.lit(0))).alias("at"),
            F.when(size["hit"].isNull(), state["found"])
            .otherwise(F.concat(state["found"], F.array(hit)))
            .alias("found"),
        )

    return F.aggregate(sizes, start, step, lambda state: state["found"])


def detections(words: Column, table: Sequence[Rule]) -> Column:
    """Kept detections of ``table``'s rules over the words of a text: an array
    of ``(start, end, priority, rule, label)``, positions in characters of the
    words, sorted by start."""
    groups: dict[str, list[dict]] = {}
    for i, r in enumerate(table):
        item = {"pattern": r.pattern, "priority": r.priority, "rule": i, "label": r.label}
        groups.setdefault(r.keyword, []).append(item)
    listed = F.from_json(
        F.lit(json.dumps([{"keyword": k, "rules": v} for k, v in groups.items()])),
        "array<struct<keyword:string,rules:array<struct<pattern:string,priority:int,rule:int,label:string>>>>",
    )
    tried = F.flatten(F.transform(F.filter(listed, lambda g: words.contains(g["keyword"])), lambda g: g["rules"]))
    hit = F.filter(tried, lambda r: F.regexp_like(words, r["pattern"]))
    found = F.array_sort(F.flatten(F.transform(hit, lambda r: _rule_hits(words, r))))

    kept = "struct<start:int,end:int,priority:int,rule:int,label:string>"
    levels = sorted({r.priority for r in table})
    ends = [F.lit(-1).alias(f"end{p}") for p in levels]
    start = F.struct(*ends, F.array().cast(f"array<{kept}>").alias("kept"))

    def step(state: Column, d: Column) -> Column:
        end = -d["inner"]
        covered = F.lit(False)
        for p in levels:
            covered = covered | ((d["priority"] >= p) & (state[f"end{p}"] >= end))
        item = F.struct(d["start"].alias("start"), end.alias("end"), *[d[c].alias(c) for c in ("priority", "rule", "label")])
        grown = [
            F.when(~covered & (d["priority"] == p), F.greatest(state[f"end{p}"], end)).otherwise(state[f"end{p}"]).alias(f"end{p}")
            for p in levels
        ]
        return F.struct(*grown, F.when(covered, state["kept"]).otherwise(F.concat(state["kept"], F.array(item))).alias("kept"))

    return F.aggregate(found, start, step, lambda state: state["kept"])


def scan_licenses(docs: DataFrame, table: Sequence[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``detections``, ``labels`` and ``score``.

    A detection gives its first and last word, its label, rule and priority. A
    detection that lies within an earlier or equal one of the same or a
    stronger priority is left out. ``score`` is the confidence of the strongest
    detection, 0 without any. Whole texts; null and empty ones have no words.
    """
    made = ("n_words", "n_base", "first_word", "last_word", "base_labels", "detections", "labels", "score")
    kept = [c for c in docs.columns if c != text_col and c not in made]
    words = F.col("__words")
    table = rules() if table is None else table
    keywords = sorted({r.keyword for r in table})
    gate = F.lit(False)
    for k in keywords:
        gate = gate | words.contains(k)
    empty = F.array().cast("array<struct<start:int,end:int,priority:int,rule:int,label:string>>")
    strongest = F.array_min(F.transform(F.col("__found"), lambda d: d["priority"]))
    confidence = F.lit(0.0)
    for priority, value in CONFIDENCE.items():
        confidence = F.when(strongest == priority, F.lit(value)).otherwise(confidence)
    named = F.when(F.size("base_labels") > 0, F.lit(CONFIDENCE[NAME])).otherwise(F.lit(0.0))
    return (
        docs.select(*kept, license_words(text_col).alias("__words"))
        .withColumns(base_columns(words))
        .withColumn("__found", F.when(gate, detections(words, table)).otherwise(empty))
        .select(
            *kept,
            count_words(words).alias("n_words"),
            "n_base",
            "first_word",
            "last_word",
            "base_labels",
            F.transform(
                "__found",
                lambda d: F.struct(
                    _words_before(words, d["start"]).cast("long").alias("first"),
                    _words_before(words, d["end"]).cast("long").alias("last"),
                    d["label"].alias("label"),
                    d["rule"].alias("rule"),
                    d["priority"].alias("priority"),
                ),
            ).alias("detections"),
            F.array_sort(
                F.array_distinct(F.concat("base_labels", F.transform("__found", lambda d: d["label"])))
            ).alias("labels"),
            F.greatest(confidence, named).alias("score"),
        )
    )
