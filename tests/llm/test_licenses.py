import pytest

from demandcast.llm import licenses
from demandcast.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD

SF_DIR = "/root/testdata/sf0.01"
EXACT = [("MIT", "foo bar. Released under the MIT License. More."), ("Apache-2.0", "x\nLicensed under the Apache License, Version 2.0.\ny z"),
         ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("CC-BY-NC-4.0", "LICENSED UNDER CC BY-NC 4.0."),
         ("CC-BY-4.0", "licensed under CC BY 4.0")]


@pytest.mark.parametrize(("name", "text"), EXACT)
def test_notices_are_told_apart(name, text):
    (at, block), = licenses.candidate_blocks(text)
    (hit,) = licenses.scan_block(block)
    assert hit["license"] == name and hit["covered"] == 1 and not hit["missing"] and not hit["between"] and 0 < hit["saved"] < 1
    assert text[at : at + len(block)] == block


def test_a_wrapped_long_notice():
    text = "intro\n" + licenses.NOTICES["Apache-2.0-text"].replace(", Version", ",\nVersion").replace("; you", ";\nyou") + "\nend"
    ((_, block),) = licenses.candidate_blocks(text)
    assert licenses.scan_block(block)[0]["license"] == "Apache-2.0-text"


def test_differences_are_listed():
    share, missing, between = licenses.compare_wording("released under our own mit licence here", licenses.NOTICES["MIT"])
    assert missing == ["the", "license"] and between == ["our", "own"] and share == 0.6


@pytest.mark.parametrize("text", ["we licensed a song to you", "driver license needed", "", "licence"])
def test_other_texts_have_none(text):
    assert not [h for _, b in licenses.candidate_blocks(text) for h in licenses.scan_block(b)]


def test_awkward_rows(make_docs, awkward, no_docs, store):
    assert licenses.scan_licenses(awkward, store).count() == 0
    assert licenses.scan_licenses(no_docs, store).count() == 0
    notice = licenses.NOTICES["MIT"]
    docs = make_docs([*AWKWARD, (50, f"{'x ' * 90_000}{notice}"), (51, notice), (51, notice), (None, f"{notice}\n{notice}")])
    rows = licenses.scan_licenses(docs, store).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["50", "51", "51", "None"] + (["None"] if len(rows) == 5 else [])
    assert {r.license for r in rows} == {"MIT"}


def test_query_finds_every_notice_line(spark):
    names = ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = sorted((d.doc_id, n) for d in docs for n in names for _ in range((d.text or "").count(licenses.NOTICES[n])))
    found = sorted((r.doc_id, r.license) for r in QUERIES["op2_licenses"](spark, SF_DIR).collect())
    assert found == want and len(want) > 10


@pytest.mark.parametrize("name", list(licenses.NOTICES))
def test_notices_wrapped_at_every_word(name):
    notice = licenses.NOTICES[name]
    for at in [n for n, c in enumerate(notice) if c == " "]:
        text = f"some words before.\n{notice[:at]}\n{notice[at + 1 :]}\nand some behind"
        hits = [h for _, b in licenses.candidate_blocks(text) for h in licenses.scan_block(b)]
        assert [(h["license"], h["covered"], h["missing"], h["between"]) for h in hits] == [(name, 1, [], [])]


def test_all_notices_of_one_line(make_docs, store):
    text = "Released under the MIT License. Licensed under the Apache License, Version 2.0. " + licenses.NOTICES["GPL-text"]
    rows = licenses.scan_licenses(make_docs([(1, "a b " + text), (2, text.replace(" ", "\n"))]), store).collect()
    found = {i: sorted((r.at, r.license) for r in rows if r.doc_id == i) for i in (1, 2)}
    places = [text.index(w) for w in ("Released", "Licensed", "This")]
    assert found == {i: list(zip([p + k for p in places], ["MIT", "Apache-2.0", "GPL-text"])) for i, k in ((1, 4), (2, 0))}
    assert {r.block for r in rows if r.license == "MIT"} == {"Released under the MIT License", "Released\nunder\nthe\nMIT\nLicense"}


def test_a_notice_with_any_fifth_missing_has_a_telling_word():
    book = licenses.Book(licenses.NOTICES)
    for name, words in book.words.items():
        assert sum(w in book.telling for w in words) > len(words) - book.least(name)


def test_given_notices(make_docs, store):
    rows = licenses.scan_licenses(make_docs([(1, "x House rules apply to all guests y"), (2, licenses.NOTICES["MIT"])]), store,
                                  {"house": "house rules apply to all guests"}).collect()
    assert [(r.doc_id, r.license) for r in rows] == [(1, "house")]
