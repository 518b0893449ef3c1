"""op6: addresses without a digit or a plain "@"."""

import pytest

from roadlens.llm import pii as P

FORMS = [
    "jane.doe (at) example (dot) org", "jane.doe(at)example.org", "paul[at]host.example", "jane.doe [at] example dot org", "jane.doe(at)example(dot)org",
    "jane.elisabeth.doe-of-the-northern-valleys @ mail.example.org", "anna (at) long-department-name.of-some.university.example",
]


@pytest.fixture(scope="module")
def tagger(spark):
    return P.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_regions_cover_every_written_form():
    for form in FORMS:
        assert P.holds("email", form)
        text = "so it was " * 9 + f"write to {form} for the rest " + "of the day " * 9
        at = text.index(form)
        assert any(a < at and at + len(form) < b for a, b in P.regions(text)), form


def test_written_out_addresses_are_found(tagger):
    texts = [f"write to {form} for the rest" for form in FORMS]
    base, both = P.all_spans(texts, tagger)
    assert base == [[]] * len(FORMS)
    assert [[t[a:b] for k, a, b in s if k == "email"] for t, s in zip(texts, both)] == [[f] for f in FORMS]
