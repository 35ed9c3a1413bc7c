import re

import pytest

from terracheck.llm import licenses
from terracheck.llm.common import LOWER, UPPER

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TEXTS = [
    "Licensed under CC BY 4.0.\nAll rights  reserved, all rights reserved", "cc by cc by", "cc, by; CC-BY", "ccby acc by", "General\npublic LICENSE", "x\nReleased under the MIT License.\ny",
    "released under the mit licence", "license mit the under released and more words", "Licensed under the Apache License, Version 2.0", None, "", " \n ", "all rights", "İcc by ẞ cc by",
    "This work is licensed under the GNU General Public License, version 3.", "word " * 30000 + "cc by", "under the mit license", "cc by nc 4 0 licensed under",
]


def brute(text):
    lower = (text or "").translate(str.maketrans(UPPER, LOWER))
    words = re.findall(PATTERN, lower)
    base = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    more, best = set(), 0.0
    for line in lower.split("\n"):
        block = set(re.findall(PATTERN, line))
        for label, t in licenses.TEMPLATES:
            want = set(t.split())
            if licenses.DEN * len(want & block) >= licenses.NUM * len(want):
                more.add(label)
                best = max(best, len(want & block) / len(want))
    labels = {b[1] for b in base}
    places = [b[0] for b in base]
    return (len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | more)), 1.0 if base else best)


def test_matches_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, TEXTS[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' AS labels", "1 AS block", "2 AS word").repartition(3)
    got = licenses.scan_licenses(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[r.doc_id if r.doc_id is not None else 1]
        assert tuple(r)[1:-1] == brute(text)[:-1] and r.score == pytest.approx(brute(text)[-1]), text


def test_empty_and_clean(spark, no_docs, docs):
    assert licenses.scan_licenses(no_docs).count() == 0
    assert all(tuple(r)[1:-1] == brute(t)[:-1] for r, t in zip(licenses.scan_licenses(spark.createDataFrame([(1, "nothing of the kind")], "doc_id long, text string")).collect(), ["nothing of the kind"]))
    assert licenses.scan_licenses(docs).count() == docs.count()


def test_rare_words_come_first(spark):
    blocks = spark.createDataFrame([("a", "the license"), ("b", "the"), ("c", "the mit"), ("d", "mit license")], "key string, block string")
    order = licenses.word_order(blocks, (("t", "the mit license under"),))
    assert order[0] == "under" and order[-1] == "the"


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
FILL = "mit apart license " + "some words of prose " * 40
WRAPPED = [MIT, BSD, "x " * 500 + MIT + " y" * 500, "\n".join(BSD.split()), "released " + FILL + "under " + FILL + "the apache version 2 0", "licensed " + FILL * 3 + "licensed under the apache license version 2 0", None, "", "word"]


def brute_windows(text, templates=licenses.TEMPLATES):
    words, found = re.findall(PATTERN, (text or "").translate(str.maketrans(UPPER, LOWER))), {}
    for label, t in templates:
        span, want = 1, set(t.split())
        while span < len(t.split()):
            span *= 2
        for i in range(0, len(words), span):
            share = len(want & set(words[i : i + 2 * span])) / len(want)
            if share >= licenses.NUM / licenses.DEN:
                found[label] = max(found.get(label, 0.0), share)
    return found


def test_notices_wrapped_over_lines_and_in_long_lines(spark):
    texts = WRAPPED + TEXTS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    by_id = {r.doc_id: r for r in licenses.scan_licenses(docs, find=licenses.find_in_windows).collect()}
    assert [by_id[i].labels for i in range(6)] == ["mit", "bsd", "mit", "bsd", "", "apache-2.0"]
    assert by_id[0].score == by_id[3].score == 1.0
    for i, text in enumerate(texts):
        base, found = brute(text)[4], brute_windows(text)
        assert by_id[i].labels == ",".join(sorted(set(filter(None, base.split(","))) | set(found))), text
        assert by_id[i].score == pytest.approx(1.0 if base else max(found.values(), default=0.0)), text


def test_a_whole_license_is_a_template(spark):
    whole = (("long", " ".join(f"w{i}" for i in range(300))),)
    text = "\n".join(f"w{i}" for i in range(300) if i % 10)
    docs = spark.createDataFrame([(1, "a " * 333 + text), (2, " ".join(f"w{i} " + "b " * 9 for i in range(300)))], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(docs, whole, licenses.find_in_windows).collect()}
    assert got == {1: ("long", 0.9), 2: ("", 0.0)}
