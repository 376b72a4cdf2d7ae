"""Notices that run over line ends."""

import textwrap

import pytest

from ledgerlake.llm import license_scan

WRAPPED = [
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed"),
    ("bsd", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0\nInternational License."),
]


@pytest.mark.parametrize("width", [None, 16, 30])
def test_wrapped_notices_are_found(spark, width):
    texts = [t if width is None else "\n".join(f"# {x}" for x in textwrap.wrap(t, width)) for _, t in WRAPPED]
    texts = ["some words\n" + t + "\n\nmore" for t in texts] + [t.replace("\n", " ") for _, t in WRAPPED]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["labels"] for r in license_scan.license_scan(docs).collect()}
    for k, (label, _) in enumerate(WRAPPED):
        assert label in got[k].split(",") and got[k] == got[k + len(WRAPPED)]  # as in one line


def test_blank_lines_end_a_notice(spark):
    docs = spark.createDataFrame([(1, WRAPPED[0][1].replace("\n", "\n\n"))], "doc_id bigint, text string")
    assert [r["labels"] for r in license_scan.license_scan(docs).collect()] == [""]
