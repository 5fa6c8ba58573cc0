"""Line, title, term and similarity functions on known cases."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import ids, similarity, text
from docloom.functions.wordlists import STOPWORDS, terms_of_art
from docloom.operators import cleaning, headings, terms


def column(spark, values, expr, kind="string"):
    own = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in own.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_page_numbers(spark):
    yes = ["12", "- 12 -", "Page 3 of 200", "xiv", "(7)", "[12]", " 5/9 "]
    no = ["Section 12", "1978 judgment", "Chapter 3", "", "mixed 5"]
    assert column(spark, yes + no, text.is_page_number) == [True] * len(yes) + [False] * len(no)


def test_signature_tidy_and_quality(spark):
    assert column(spark, [" Page 12 of 340 "], text.signature) == ["page # of #"]
    assert column(spark, ["employ-\nment  law\n\n\n\nNext line \n", "A-\nB"], text.tidy) == ["employment law\n\nNext line", "A-\nB"]
    assert column(spark, ["good text 12 --", "", "x y"], text.text_quality) == [0.5, 0.0, 0.0]
    assert column(spark, ["", "abcd" * 5], text.estimate_tokens) == [1, 5]


def test_telegraphic(spark):
    got = column(spark, ["the employee had previously filed an arbitration claim", "it was so", "the the law"], text.telegraphic)
    assert got == ["employee previously filed arbitration claim", "it was so", "the the law"]
    assert len(STOPWORDS) == 88 and "res judicata" in terms_of_art()


def test_numbering(spark):
    values = ["3 Coverage", "3.4 Coverage", "3.4.1 Coverage", "Chapter 2", "A. Something", "IV. Something", "Coverage", "3", "a. thing"]
    assert column(spark, values, headings.numbering_depth) == [1, 2, 3, 1, 1, 1, None, None, 1]
    values = ["3.5. Commercial General Liability", "E. Commercial General Liability:", "(a) [3:298] Commercial  General", "Chapter 2 - Strikes"]
    assert column(spark, values, headings.strip_numbering)[:3] == ["commercial general liability"] * 2 + ["commercial general"]


def test_heading_text(spark):
    values = ["[3:300 - 3:309] Reserved.", "Coverage Under The Policy", "ends with a comma,", "12", "This is a long sentence that goes on and ends here with a stop.", "x" * 121]
    assert column(spark, values, headings.heading_like) == [False, True, False, False, False, False]


def test_ids(spark):
    import hashlib

    got = spark.range(1).select(ids.make_id("sec", F.lit("d"), F.lit(3), F.lit(None).cast("string")).alias("a")).first().a
    assert got == "sec_" + hashlib.sha256(b"d|3|").hexdigest()[:16]


def test_terms_of_indian_and_us_prose():
    found = {(k, v) for k, v, _, _ in terms.terms_in('In Maneka Gandhi v. Union of India, AIR 1978 SC 597, the Supreme Court of India read Article 21 with Section 25F of the Industrial Disputes Act, 1947 on 25 January 1978. "Lock-out" means the closing of a place.')}
    assert ("case_name", "Maneka Gandhi v. Union of India") in found and ("citation", "AIR 1978 SC 597") in found and ("court", "Supreme Court of India") in found
    assert ("provision", "Article 21") in found and ("provision", "Section 25F") in found and ("statute", "Industrial Disputes Act, 1947") in found
    assert ("date", "25 January 1978") in found and ("defined_term", "Lock-out") in found
    found = {(k, v) for k, v, _, _ in terms.terms_in("See Smith v. Jones Co., 109 F3d 642 (9th Cir. 1997); 42 U.S.C. § 1983; Ins.C. § 533.")}
    assert ("citation", "109 F3d 642") in found and ("provision", "42 U.S.C. § 1983") in found and ("provision", "Ins.C. § 533") in found and ("court", "9th Cir.") in found


def test_term_offsets_and_keys(spark):
    sample = "See Roe v. Wade, 410 U.S. 113, and Section 5."
    for _, value, start, end in terms.terms_in(sample):
        assert sample[start:end] == value
    own = spark.createDataFrame([("provision", "S. 25-F", "Section 25F"), ("provision", "Art. 21", "Article 21"), ("case_name", "A vs B Limited", "The A v. B Ltd."), ("statute", "The  Act Company", "act co")], "kind string, a string, b string")
    assert all(r.same for r in own.select((terms.term_key(F.col("kind"), F.col("a")) == terms.term_key(F.col("kind"), F.col("b"))).alias("same")).collect())
    assert own.select(terms.normalise(F.col("kind"), F.col("a")).alias("n")).collect()[2].n == "A v. B Limited"


def naive_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_similarity():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 14))) for _ in range(2))
        assert similarity.common(a, b) == naive_lcs(a, b)
    assert similarity.ratio("", "") == 100 and similarity.ratio("a", "") == 0
    assert similarity.token_set_ratio("b a", "a b c") == 100 and similarity.token_set_ratio("", "a") == 0
    assert similarity.partial_ratio("law", "labour law book") == 100
    assert similarity.best_of("abcd", ["zz", "abce", "abcf"]) == (75.0, 1)


def test_cleaning(spark):
    rows = []
    for page in range(1, 7):
        rows += [(1, page, 0, "LABOUR LAW", 0.04), (1, page, 1, "employ-", 0.3), (1, page, 2, "ment under Section 25F", 0.5), (1, page, 3, str(page), 0.97)]
    rows.append((2, 1, 0, "only page", 0.02))
    lines = spark.createDataFrame(rows, "doc_id int, page int, line_idx int, text string, y double")
    assert [(r.doc_id, r.signature, r.pages) for r in cleaning.repeated_edges(lines).orderBy("signature").collect()] == [(1, "#", 6), (1, "labour law", 6)]
    pages = {(r.doc_id, r.page): r.text for r in cleaning.clean_pages(lines).collect()}
    assert pages[1, 3] == "employment under Section 25F" and pages[2, 1] == "only page"


@pytest.mark.parametrize("levels,want", [([2, 4, 2, 5], [1, 2, 1, 2]), ([1, 3, 3, 2, 1], [1, 2, 3, 2, 1]), ([3], [1])])
def test_levels(spark, levels, want):
    own = spark.createDataFrame([("d", i, x) for i, x in enumerate(levels)], "doc_id string, n int, level int")
    got = [r.level for r in headings.normalise_levels(own).orderBy("n").collect()]
    loop, previous = [], 0
    for x in levels:
        previous = min(x - min(levels) + 1, previous + 1)
        loop.append(previous)
    assert got == loop
