import math
import re

import pytest

from oreflow.llm.license_scan import BASE_PHRASES, NOTICES, notice_matches, notice_tokens, scan_licenses, text_blocks, _prepared

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(text, notices, threshold, size=128):
    words = WORD.findall(low(text))
    places = [(label, i) for phrase, label in BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    labels, best = set(), 0.0
    blocks = [words] if len(words) <= size else [words[i : i + size] for i in range(0, len(words) - size // 2, size // 2)]
    for block in blocks:
        carried = {}
        for label, notice, *more in notices:
            tokens, telling, family = set(notice_tokens(notice)), set(low("".join(more[:1])).split()), "".join(more[1:]) or label
            common = len(tokens & set(block))
            if tokens and common >= math.ceil(threshold * len(tokens) - 1e-9) and telling <= set(block):
                carried.setdefault(family, []).append((common / len(tokens), common, label))
        for found in carried.values():
            most = max(found)[:2]
            labels |= {label for *fit, label in found if tuple(fit) == most}
            best = max(best, most[0])
    starts = [i for _, i in places]
    base = sorted({x for x, _ in places})
    return len(words), len(places), min(starts, default=None), max(starts, default=None), base, sorted(labels | set(base)), max(best, 1.0 if places else 0.0)


def texts():
    plain = "the of and a to in it is this " * 3
    out = [None, "", "   ", "...", plain, "Released UNDER the\nMIT license! under the mit license", "cc by nc cc by nc", "CC-BY-NC", "cc by\nnc"]
    for _, notice, *_ in NOTICES:
        words = notice.split()
        out += [notice, notice.upper(), " ".join(words[:-1]), " ".join(words[: len(words) // 2]), plain + notice + " " + plain, " ".join(words[::-1])]
        out += [plain * 5 + notice + " " + plain * 9, "\n".join(words), f"x\n{' , '.join(words)}\n\ny", " ".join(words[1:] + ["other"] * 40 + words[:1])]
    return out + ["word " * 3000 + "under the mit license " + "wörd " * 3000]


@pytest.mark.parametrize("threshold", [0.8, 0.5, 1.0])
def test_matches_brute_force(spark, threshold):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, NOTICES[0].text), (3, NOTICES[1].text), (3, "cc by nc"), (3, "cc by nc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = scan_licenses(docs, threshold=threshold).collect()
    got = sorted(((r["doc_id"], (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base"], r["labels"], round(r["score"], 9))) for r in found), key=str)
    want = sorted(((i, (*(x := brute(t, NOTICES, threshold))[:6], round(x[6], 9))) for i, t in rows), key=str)
    assert got == want


def test_runs_without_python(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table_other_columns_and_bad_notices(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([(1, "cc by nc", "l", 2)], "doc_id long, text string, labels string, text_key int")
    assert scan_licenses(odd).collect()[0]["labels"] == ["cc-by-nc"]
    with pytest.raises(ValueError):
        notice_matches(text_blocks(_prepared(odd)), [("none", "...")])


def test_notices_wrapped_over_lines(spark):
    """The notices of several lines, wrapped at 72 columns with comment signs, and one longer than a block of a line."""
    import textwrap

    long = ("long", " ".join(f"term{i}" for i in range(90)))
    bodies = {
        "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "long": long[1],
    }
    plain = "the of and a to in it is that on " * 20
    rows = []
    for label, body in bodies.items():
        wrapped = "\n".join(f" * {line}" for line in textwrap.wrap(body, 72))
        rows += [(label, wrapped), (label, f"{plain}\n{wrapped}\n{plain}")]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    notices = [*NOTICES, long]
    found = {r["doc_id"]: r for r in scan_licenses(docs, notices).collect()}
    assert [(found[i]["labels"], found[i]["score"]) for i in range(len(rows))] == [([label], 1.0) for label, _ in rows]


def test_lines_alone_on_request(spark):
    docs = spark.createDataFrame([(1, "Permission is hereby granted, free of\ncharge, to any person obtaining a copy of this software"), (2, f"x\n{NOTICES[1].text}\ny")],
                                 "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in scan_licenses(docs, across_lines=False).collect()} == {1: [], 2: ["mit"]}
    assert {r["doc_id"]: r["labels"] for r in scan_licenses(docs).collect()} == {1: ["mit"], 2: ["mit"]}


def test_variants_of_a_license_are_told_apart(spark):
    plain = "some words of a text that stand around it " * 4
    rows = {
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": ["cc-by"],
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["cc-by-sa"],
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": ["cc-by-nc"],
        "This work is licensed under the GNU General Public License, version 2.": ["gpl-2"],
        "This work is licensed under the GNU General Public License, version 3.": ["gpl-3"],
        "All of the documents reserved by the committee stay so, whatever the rights of access": [],
        "Copyright 2020 the authors. All rights reserved.": ["all-rights-reserved"],
        "Released under the MIT License. Licensed under the Apache License, Version 2.0.": ["apache-2", "mit"],
    }
    docs = spark.createDataFrame([(i, f"{plain}\n{text}\n{plain}") for i, text in enumerate(rows)], "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in scan_licenses(docs).collect()}
    assert [found[i] for i in range(len(rows))] == list(rows.values())


def test_telling_words_are_words_of_the_notice(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError, match="telling"):
        scan_licenses(docs, [("none", "some text", "other")])
