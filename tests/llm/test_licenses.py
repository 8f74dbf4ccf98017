from collections import Counter

import pytest

from grainsieve.llm.licenses import PHRASES, TEMPLATES, Template, scan_licenses
from tests.llm.brute import license_places
from tests.llm.cases import ROWS, clashing, documents, empty


def _expected(doc_id, text, templates=TEMPLATES):
    n, places, labels, best = license_places(text, templates)
    starts = [i for _, i in places]
    return (
        doc_id, n, len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for label, _ in places})), ",".join(sorted(labels)), round(best, 9),
    )


def _rows(df):
    return Counter(tuple(r[:7]) + (round(r[7], 9),) for r in df.collect())


def test_places(spark):
    texts = [
        "CC-BY and cc by, cc\nBY",
        "general public License general public licenses",
        "All rights all rights reserved reserved. All Rights Reserved",
        "reserved rights all",
        "This work is licensed under the GNU General Public License, version 3.",
        "work licensed under the gnu general license version 3 of this is",
        "Licensed under the Apache License, Version 2.0.",
        "\u212alicense cc by\u0130 cc\u00a0by",
        "or or or and and binary forms source redistribution use permitted are modification without with",
        None,
        "",
        "cc " * 3000 + "by",
    ]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(scan_licenses(df)) == Counter(_expected(*row) for row in rows)


def test_edge_rows(spark):
    found = _rows(scan_licenses(clashing(spark, documents(spark))))
    assert found == Counter(_expected(r[0], r[1]) for r in ROWS)
    assert scan_licenses(empty(spark)).count() == 0


def test_own_templates(spark):
    templates = [Template("half", "one two three four", 0.5), *PHRASES]
    rows = [(1, "four x x one"), (2, "one x x x two"), (3, "two two two two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(scan_licenses(df, templates)) == Counter(_expected(*r, templates) for r in rows)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_documents_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    expected = Counter(_expected(r["doc_id"], r["text"]) for r in docs.collect())
    assert _rows(scan_licenses(docs)) == expected
