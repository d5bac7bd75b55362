import re
from random import Random

import pytest
from llm_cases import documents, odd_texts

from meetmart.llm import licenses
from meetmart.llm.texts import folded_words

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = []
    for phrase, label in PHRASES.items():
        want = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(want)] == want]
    starts = [k for k, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


TEXTS = [
    *odd_texts(),
    (20, "CC BY cc-by; CC  by\nCC"),
    (21, "This work is licensed under the GNU General Public License, version 3."),
    (22, "Released under the MIT License. Copyright (c) 2020 Foo Bar, All Rights Reserved."),
    (23, "cc cc by by general public general public license all rights all rights reserved reserved"),
    (24, "SPDX-License-Identifier: Apache-2.0"),
    (25, "Licensed under CC BY-NC 4.0."),
    (26, "wir gehen mit dem hund; isc and vim are words, ruby too"),
    (27, "ccby acc by cc byé écc by"),
]


@pytest.mark.parametrize("extra", [False, True])
def test_base_columns_agree_with_brute_force(spark, extra):
    got = licenses.license_digest(documents(spark, TEXTS, extra)).collect()
    want = sorted(((i, *brute(t)) for i, t in TEXTS), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == want
    assert all(0 <= r.score <= 1 for r in got)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_labels_of_the_rules(spark):
    got = {r.doc_id: r.labels for r in licenses.license_digest(documents(spark, TEXTS)).collect()}
    assert got[21] == "gpl,gpl-3.0"
    assert got[22] == "mit,reserved"
    assert got[24] == "apache-2.0"
    assert got[25] == "cc-by,cc-by-nc"
    assert got[26] == "" and got[0] == ""


def test_a_longer_or_stronger_detection_suppresses_what_it_contains():
    found = licenses.detections(folded_words(b"licensed under the Apache License, Version 2.0"))
    kept = [d for d in found if d[-1]]
    assert [(d[1], d[4], d[5]) for d in kept] == [("apache-2.0", 0, 8)]
    assert len(found) > 1
    apart = licenses.detections(folded_words(b"MIT license. Apache license version 2.0."))
    assert {d[1] for d in apart if d[-1]} == {"mit", "apache-2.0"}


def test_hundreds_of_rules_in_order_of_tiers():
    tiers = [r.tier for r in licenses.rules()]
    assert len(tiers) >= 300 and tiers == sorted(tiers, reverse=True)


def test_every_rule_opens_the_gate_for_its_own_text():
    gate, by_word, _ = licenses._compiled()
    opened = {k for ks in by_word.values() for k in ks}
    assert opened == set(range(len(licenses.rules())))


def test_empty_table(spark):
    assert licenses.license_digest(documents(spark, [])).collect() == []


@pytest.mark.parametrize(
    "text, label",
    [
        ("This is GPLv2 software", "gpl-2.0"),
        ("under the Beerware license", "beerware"),
        ("Beerware", "beerware"),
        ("agplv3", "agpl-3.0"),
        ("lgplv3", "lgpl-3.0"),
        ("apache2 licence", "apache-2.0"),
        ("github.com/licenses/mit", "mit"),
        ("example.net/license/isc", "isc"),
    ],
)
def test_joined_names_and_addresses_are_found(text, label):
    assert label in {d[1] for d in licenses.detections(folded_words(text.encode()))}


def test_the_gate_loses_no_spelling_of_any_rule():
    random = Random(7)
    _, by_word, patterns = licenses._compiled()
    gated = [{w for w, ks in by_word.items() if k in ks} for k in range(len(patterns))]
    for k, rule in enumerate(licenses.rules()):
        parts = sorted(licenses.spellings(rule.pattern))
        for text in random.sample(parts, min(len(parts), 200)):
            words = text.replace("\0", "1").encode().split()
            if not patterns[k].search(b" " + b" ".join(words) + b" "):
                continue  # a class that holds no 1
            assert gated[k].intersection(words), (rule.name, text)
            assert all(need.intersection(words) for need in rule.need), (rule.name, text)


def test_gated_and_ungated_scans_agree(monkeypatch):
    random = Random(11)
    rules, (_, _, patterns) = licenses.rules(), licenses._compiled()
    texts = []
    for rule in rules:
        spelled = random.choice(sorted(licenses.spellings(rule.pattern))).replace("\0", "1")
        texts.append(f"one {spelled} two".encode().split())
    got = [licenses.detections(words) for words in texts]
    # every text opens every rule, whatever words it holds
    free = tuple(r._replace(need=()) for r in rules)
    monkeypatch.setattr(licenses, "rules", lambda: free)
    monkeypatch.setattr(licenses, "_compiled", lambda: (frozenset([b"one"]), {b"one": list(range(len(free)))}, patterns))
    assert got == [licenses.detections(words) for words in texts]
