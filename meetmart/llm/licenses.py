"""License scan: ordered signature rules behind a keyword gate, overlaps resolved by containment.

A rule is a regular expression over the folded words of a text, joined by single spaces. It runs only on
texts that hold its key words; those are derived from all spellings of the pattern, so no match is lost. A detection is dropped if a kept one of a higher tier, or a longer one
of its own tier, spans all of its words. Base phrases are reported always.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from functools import cache
from re import _constants as sre, _parser as parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetmart.llm.texts import folded_words, id_and_text, map_batches, utf8


class Rule(NamedTuple):
    name: str
    label: str
    tier: int
    confidence: float
    need: tuple[frozenset[bytes], ...]  # of each set, every match holds a word
    pattern: str


#: label, name as folded words (regular expression), word that marks a name that ordinary texts hold too.
FAMILIES = (
    ("apache-2.0", r"apache(?: software)?(?: license| licence)?(?: version| v)? ?2(?: 0)?", "apache"),
    ("apache-1.1", r"apache(?: software)? license(?: version)? 1 1", "apache"),
    ("mit", r"mit(?: x11| expat)?", "mit"),
    ("x11", r"x11", "x11"),
    ("isc", r"isc", "isc"),
    ("bsd-2-clause", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", ""),
    ("bsd-3-clause", r"(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)", ""),
    ("bsd-4-clause", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)", ""),
    ("0bsd", r"(?:0bsd|zero clause bsd|bsd 0 clause|bsd zero clause)", ""),
    ("bsd", r"(?:bsd|bsd style)", "bsd"),
    ("gpl-2.0", r"(?:gnu )?(?:general public license|gpl)(?: gpl)?(?: version| v)? ?v?2(?: 0)?", ""),
    ("gpl-3.0", r"(?:gnu )?(?:general public license|gpl)(?: gpl)?(?: version| v)? ?v?3(?: 0)?", ""),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser general public license|lgpl)(?: lgpl)?(?: version| v)? ?v?2 1", ""),
    ("lgpl-3.0", r"(?:gnu )?(?:lesser general public license|lgpl)(?: lgpl)?(?: version| v)? ?v?3(?: 0)?", ""),
    ("lgpl-2.0", r"(?:gnu )?library general public license(?: version| v)? ?v?2(?: 0)?", "library"),
    ("agpl-3.0", r"(?:gnu )?(?:affero general public license|agpl)(?: agpl)?(?: version| v)? ?v?3(?: 0)?", ""),
    ("gfdl", r"(?:gnu )?(?:free documentation license|gfdl|fdl)(?:(?: version| v)? ?1 [123])?", ""),
    ("mpl-2.0", r"(?:mozilla public license|mpl)(?: version| v)? ?2 0", ""),
    ("mpl-1.1", r"(?:mozilla public license|mpl)(?: version| v)? ?1 1", ""),
    ("epl-2.0", r"(?:eclipse public license|epl)(?: version| v)? ?2(?: 0)?", ""),
    ("epl-1.0", r"(?:eclipse public license|epl)(?: version| v)? ?1(?: 0)?", ""),
    ("cddl", r"(?:common development and distribution license|cddl)(?:(?: version)? 1 [01])?", ""),
    ("cpl-1.0", r"common public license(?:(?: version)? 1 0)?", "common"),
    ("eupl", r"(?:european union public licen[cs]e|eupl)(?:(?: version| v)? ?1 [12])?", ""),
    ("artistic-2.0", r"artistic license(?: version)? 2 0", "artistic"),
    ("artistic", r"(?:perl )?artistic license", "artistic"),
    ("bsl-1.0", r"boost software license(?:(?: version)? 1 0)?", "boost"),
    ("zlib", r"(?:zlib|zlib libpng)", "zlib"),
    ("libpng", r"libpng", "libpng"),
    ("unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public license)", ""),
    ("postgresql", r"postgresql", "postgresql"),
    ("python-2.0", r"(?:python software foundation|psf)(?: license)?(?: version 2)?", ""),
    ("ruby", r"ruby", "ruby"),
    ("php-3.01", r"php(?: license)?(?: version)? 3 01", "php"),
    ("openssl", r"openssl", "openssl"),
    ("ofl-1.1", r"(?:sil )?open font license(?:(?: version)? 1 1)?", "font"),
    ("ncsa", r"(?:university of illinois ncsa|ncsa)(?: open source)?", "ncsa"),
    ("ms-pl", r"microsoft public license", "microsoft"),
    ("ms-rl", r"microsoft reciprocal license", "microsoft"),
    ("mulan-psl-2.0", r"mulan(?: permissive software license| psl)(?:(?: version| v)? ?2)?", "mulan"),
    ("afl-3.0", r"academic free license(?:(?: version| v)? ?3 0)?", "academic"),
    ("osl-3.0", r"open software license(?:(?: version| v)? ?3 0)?", "open"),
    ("vim", r"vim", "vim"),
    ("beerware", r"beer ?ware", ""),
    ("sspl-1.0", r"(?:server side public license|sspl)(?:(?: version| v)? ?1)?", ""),
    ("busl-1.1", r"business source license(?:(?: version)? 1 1)?", "business"),
    ("elastic-2.0", r"elastic license(?:(?: version)? 2 0)?", "elastic"),
    ("odbl", r"(?:open database license|odbl)(?:(?: version| v)? ?1 0)?", ""),
    ("odc-by", r"(?:open data commons attribution|odc by)(?:(?: version| v)? ?1 0)?", ""),
    ("pddl", r"(?:public domain dedication and license|pddl)", ""),
    ("cc0", r"(?:cc0|creative commons zero|cc zero)(?: 1 0)?", ""),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)(?: (?:international|unported))?(?: [1-4] [05])?", ""),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] [05])?", ""),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] [05])?", ""),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)(?: [1-4] [05])?", ""),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] [05])?", ""),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: [1-4] [05])?", ""),
)

#: Sentences of license texts and notices: label, pattern, words that must be there.
SENTENCES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", "notice"),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", "hereby"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd-3-clause", r"neither the names? of .{1,120}? may be used to endorse or promote products derived from this software", "endorse"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising"),
    ("apache-2.0", r"you may not use this file except in compliance with the license", "compliance"),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "basis"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "redistribute"),
    ("agpl-3.0", r"under the terms of the gnu affero general public license", "affero"),
    ("lgpl", r"gnu lesser general public license", "lesser"),
    ("gpl", r"(?:either version [123](?: 0| 1)? of the license or at your option any later version)", "option"),
    ("gpl", r"you should have received a copy of the gnu general public license", "received"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "liable"),
    ("zlib", r"altered source versions must be plainly marked as such", "altered"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "organization"),
    ("beerware", r"you can do whatever you want with this stuff", "stuff"),
    ("public-domain", r"(?:released|placed|dedicated|put) (?:in|into|to) the public domain", "domain"),
    ("public-domain", r"(?:this work|this document|this text) is in the public domain", "domain"),
    ("public-domain", r"no rights reserved", "reserved"),
    ("reserved", r"all rights (?:are )?reserved", "rights"),
    ("reserved", r"some rights reserved", "rights"),
    ("reserved", r"copyright(?: c)?(?: [12][0-9]{3})?(?: [^ ]+){0,6}? all rights reserved", "copyright"),
    ("copyright", r"copyright c(?: [12][0-9]{3})?", "copyright"),
    ("copyright", r"copyright [12][0-9]{3}", "copyright"),
    ("proprietary", r"(?:confidential and proprietary|proprietary and confidential)", "proprietary"),
    ("proprietary", r"unauthori[sz]ed copying of this file", "copying"),
    ("proprietary", r"(?:may not be|do not) (?:reproduced?|redistributed?|copied|copy)(?: [^ ]+){0,8}? without(?: the)?(?: prior| express)?(?: written)? permission", "permission"),
    ("proprietary", r"no part of this (?:publication|book|document|work) may be reproduced", "reproduced"),
    ("non-commercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?", ""),
    ("research-only", r"(?:for )?(?:academic|research) (?:use|purposes) only", "only"),
    ("share-alike", r"(?:distribute|share) your contributions under the same license", "contributions"),
)

#: Words that introduce a licence.
GRANTS = ("licensed", "released", "distributed", "available", "published", "provided", "covered", "governed")
#: Phrases that are always reported: phrase, label.
BASE = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))
#: Tiers of the templates, the strongest first, with the confidence of a detection.
TIERS = {"spdx": (6, 1.0), "url": (5, 0.98), "grant": (4, 0.95), "sentence": (3, 0.9), "named": (2, 0.8),
         "base": (1, 0.6), "vague": (0, 0.3)}

_SCHEMA = (
    "doc_id bigint, n_words bigint, detections array<struct<rule: string, label: string, tier: int, "
    "confidence: double, start: bigint, stop: bigint, base: boolean, kept: boolean>>"
)


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, the strongest tier first: families in each of their contexts, sentences, vague mentions."""

    def rule(kind: str, label: str, pattern: str, *need: frozenset[bytes]) -> Rule:
        tier, confidence = TIERS[kind]
        return Rule(f"{kind}:{label}", label, tier, confidence, need, pattern)

    made = []
    for label, name, word in FAMILIES:
        ident = label.replace("-", " ").replace(".", " ")
        idents, names = [_one_of(w) for w in ident.split()], _key_words(name)
        made.append(rule("spdx", label, rf"spdx license identifier {ident}(?: only| or later)?", *idents, _one_of("spdx")))
        made.append(rule("url", label, rf"(?:org|com|net)(?: [^ ]+)?(?: legal)? licen[cs]es? {ident}", _one_of("org", "com", "net"), *idents, _LICENSES))
        for verb in GRANTS:
            made.append(rule("grant", label, rf"{verb} under(?: the)?(?: terms of)?(?: the| an?)? {name}(?: licen[cs]e)?", _one_of("under"), _one_of(verb), names))
        made.append(rule("named", label, rf"{name} licen[cs]e", names))
        if not word or "licen" in name:  # names that no ordinary text holds
            made.append(rule("named", label, name, names))
    made += [rule("sentence", label, pattern, _one_of(word) if word else _key_words(pattern)) for label, pattern, word in SENTENCES]
    for verb in GRANTS:
        made.append(rule("vague", "unknown", rf"{verb} under(?: the)?(?: [^ ]+){{1,4}}? licen[cs]e", _one_of("under"), _one_of(verb)))
    made.append(rule("vague", "unknown", r"see(?: the)? licen[cs]e(?: file)?(?: for details)?", _one_of("see")))
    return tuple(sorted(made, key=lambda r: -r.tier))


def _one_of(*words: str) -> frozenset[bytes]:
    return frozenset(w.encode() for w in words)


_LICENSES = _one_of("license", "licence", "licenses", "licences")
#: Words that open a rule only where no other does.
_FREQUENT = _LICENSES | _one_of("version", "public", "software", "for", "use", "purposes")
_ANY = "\0"  # stands for a character that is not known


def spellings(pattern: str) -> set[str]:
    """All spellings of a pattern. Of what repeats without bound, the fewest and one more; unknown characters as NUL."""
    return _spelled(parser.parse(pattern))


def _spelled(parsed) -> set[str]:
    out = {""}
    for op, arg in parsed:
        if op is sre.LITERAL:
            part = {chr(arg)}
        elif op is sre.IN and all(kind is sre.LITERAL for kind, _ in arg):
            part = {chr(c) for _, c in arg}
        elif op in (sre.IN, sre.ANY, sre.NOT_LITERAL):
            part = {_ANY}
        elif op is sre.SUBPATTERN:
            part = _spelled(arg[-1])
        elif op is sre.BRANCH:
            part = set().union(*map(_spelled, arg[1]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            once, part = _spelled(body), set()
            for n in range(low, min(high, low + 1) + 1):
                times = {""}
                for _ in range(n):
                    times = {a + b for a in times for b in once}
                part |= times
        else:
            raise ValueError(f"no spellings of {op} in a rule")
        out = {a + b for a in out for b in part}
    return out


def _key_words(pattern: str) -> frozenset[bytes]:
    """Words of which every spelling of the pattern holds one: the rarer ones first, each for as many as it can."""
    left = [{w.encode() for w in text.split() if _ANY not in w} for text in spellings(pattern)]
    chosen = set()
    while left:
        counts = Counter(w for words in left for w in words)
        best = min(counts, key=lambda w: (w in _FREQUENT or len(w) < 3, -counts[w], -len(w), w))
        chosen.add(best)
        left = [words for words in left if best not in words]
    return frozenset(chosen)


@cache
def _compiled():
    """The word set of the gate, rules by the words of one set that open them, patterns."""
    by_word = defaultdict(list)
    for k, r in enumerate(rules()):
        for w in max(r.need, key=lambda words: (not words & _FREQUENT, min(map(len, words)), -len(words))):
            by_word[w].append(k)
    patterns = [re.compile(rf"(?<= )(?:{r.pattern})(?= )".encode()) for r in rules()]
    return frozenset(by_word), dict(by_word), patterns


def detections(words: list[bytes]) -> list[tuple]:
    """(rule, label, tier, confidence, start, stop, base, kept) by word positions."""
    gate, by_word, patterns = _compiled()
    seen = gate.intersection(words)
    base = {w for phrase, _ in BASE for w in phrase.split()}.intersection(words)
    if not seen and not base:
        return []
    joined = b" " + b" ".join(words) + b" "
    spaces = None
    found = []

    def add(rule, label, tier, confidence, match, is_base):
        nonlocal spaces
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        first, last = np.searchsorted(spaces, (match.start() - 1, match.end()))
        found.append((rule, label, tier, confidence, int(first), int(last), is_base))

    for phrase, label in BASE:
        for m in re.finditer(rb"(?<= )" + phrase + rb"(?= )", joined):
            add(f"base:{label}", label, *TIERS["base"], m, True)
    there = set(words) if seen else set()
    for k in sorted({k for w in seen for k in by_word[w]}):
        r = rules()[k]
        if all(not words.isdisjoint(there) for words in r.need):
            for m in patterns[k].finditer(joined):
                add(r.name, r.label, r.tier, r.confidence, m, False)
    return _resolve(found)


def _resolve(found: list[tuple]) -> list[tuple]:
    """Marks what no kept detection of a higher tier, or a longer one of the same tier, contains."""
    starts: list[int] = []
    reach: list[int] = []
    out = []
    for tier in sorted({d[2] for d in found}, reverse=True):
        kept_here, end_here, last = [], -1, None
        for d in sorted((d for d in found if d[2] == tier), key=lambda d: (d[4], -d[5], d[1], d[0])):
            k = bisect_right(starts, d[4])
            inside = (k and reach[k - 1] >= d[5]) or end_here >= d[5]
            if last is not None and (d[4], d[5]) == last[:2] and d[1] != last[2]:
                inside = bool(k and reach[k - 1] >= d[5])  # a tie between labels: both stay
            if not inside:
                kept_here.append((d[4], d[5]))
                last = (d[4], d[5], d[1])
                end_here = max(end_here, d[5])
            out.append((*d, not inside))
        merged = sorted([*zip(starts, reach), *kept_here])
        starts = [s for s, _ in merged]
        reach = list(np.maximum.accumulate([e for _, e in merged])) if merged else []
    return sorted(out, key=lambda d: (d[4], d[5], -d[2], d[1], d[0]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: number of words and all detections with their word positions.

    Null texts count as empty: no words, no detections. Repeated rows give repeated results. Other columns
    of `docs` are not read and not returned.
    """
    kind = pa.struct(
        [("rule", pa.string()), ("label", pa.string()), ("tier", pa.int32()), ("confidence", pa.float64()),
         ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()), ("kept", pa.bool_())]
    )
    names = [f.name for f in kind]

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, found = [], []
        for raw in utf8(batch.column("text")):
            words = folded_words(raw)
            counts.append(len(words))
            found.append([dict(zip(names, d)) for d in detections(words)])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(kind))],
            names=["doc_id", "n_words", "detections"],
        )

    return map_batches(id_and_text(docs, id_col, text_col), rows, _SCHEMA)


def license_digest(docs: DataFrame) -> DataFrame:
    """Counts, places and labels per document from `scan_licenses`."""
    found = scan_licenses(docs)
    base = F.filter("detections", lambda d: d["base"])
    shown = F.filter("detections", lambda d: d["base"] | d["kept"])

    def joined(part):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(part, lambda d: d["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["start"])).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(shown).alias("labels"),
        F.coalesce(F.array_max(F.transform(shown, lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
        F.size(shown).cast("long").alias("n_detections"),
    )
