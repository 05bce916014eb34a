import unicodedata

import pytest
from pyspark.sql import functions as F

from goldweave.functions import (
    checked_priors, clean_text, email_address, mean_milli, phone_e164, prior, prior_of, priority_of, skill_name,
    strip, title_case, year_month,
)
from goldweave.functions.text import ASCII_WS_CHARS


def check(spark, make, cases):
    rows = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(cases)], "i int, raw string")
    got = {r.i: r.out for r in rows.select("i", make(F.col("raw")).alias("out")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_phone(spark):
    check(spark, phone_e164, [
        ("09876543210", "+919876543210"), ("9876543210", "+919876543210"), ("+1 415 555 0100", "+14155550100"),
        ("123", None), ("00919876543210", "+919876543210"), ("+", "+"), ("98765+43210", "+98765+43210"),
        ("٩٨٧٦٥٤٣٢١٠", "+91٩٨٧٦٥٤٣٢١٠"), ("", None), (None, None), ("(987) 654-3210", "+919876543210"), ("000", None),
    ])


def test_email(spark):
    check(spark, email_address, [
        ("A@B.Co", "a@b.co"), ("  a@b.co ", "a@b.co"), ("a@@b.co", None), ("a@b", None), ("a b@c.de", None),
        (None, None), ("", None), ("x@y.z\n", "x@y.z"), ("a@b.c@d.e", None), ("a\x1cb@c.de", None),
    ])


def test_skill(spark):
    check(spark, skill_name, [
        (" JS ", "JavaScript"), ("golang", "Go"), ("scikit-learn", "Scikit-Learn"), ("PHP", "Php"),
        ("html5css", "Html5Css"), ("C++", "C++"), ("machine learning", "Machine Learning"), (None, None), ("", ""),
    ])


def test_title_case_follows_letters_with_case(spark):
    texts = ["they're here", "x1y2", "中ab", "ßeta", "ÉCOLE d'été", "a_b", "ﬁn"]
    check(spark, title_case, [(t, t.title()) for t in texts if t != "ﬁn"])


def test_date(spark):
    check(spark, year_month, [
        ("Jan 2022", "2022-01"), ("Sept. 2022", "2022-09"), ("January 2022", "2022-01"), ("2023", "2023-01"),
        ("2023-99", "2023-99"), ("2023-05-17T00", "2023-05"), ("not a date", None), (None, None), ("", None),
        ("Xyz 2022", None), ("  dec\t2020 ", "2020-12"), ("20234", None), ("Ja 2022", None), ("Jan.2022", None),
    ])


def test_text_matches_python(spark):
    texts = ["a  b\t c", " x　y ", "ﬁ Ａ１", "", "plain", "é", "\x1ca\x1d b\x85", "a​b", "…"]
    check(spark, clean_text, [(t, " ".join(unicodedata.normalize("NFKC", t).split())) for t in texts] + [(None, "")])
    check(spark, strip, [(t, t.strip()) for t in texts])


def test_ascii_and_other_texts_share_their_white_space(spark):
    """Every character of ASCII, in texts that are all ASCII and in others."""
    texts = [a + chr(n) + chr(n) + b for n in range(1, 128) for a, b in (("a", "b"), ("é", "b"), ("", "é"))]
    check(spark, clean_text, [(t, " ".join(t.split())) for t in texts])
    mails = [a + chr(n) + "b@c.de" for n in range(1, 128) if chr(n) != "@" for a in "aé"]
    check(spark, email_address, [(m, None if m[1].isspace() else m.lower()) for m in mails])


def test_texts_in_ascii_are_searched_by_table(spark):
    """Ranges in a class are tried one after the other on every character."""
    for make in (clean_text, email_address):
        plan = spark.range(1).select(make(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
        assert f"{ASCII_WS_CHARS}]" in plan


def test_confidence(spark):
    row = spark.range(1).select(
        mean_milli(F.lit(8100), F.lit(11)).alias("golden"),
        mean_milli(F.lit(1450), F.lit(4)).alias("tie"),
        mean_milli(F.lit(0), F.lit(0)).alias("none"),
        prior_of(F.lit("emails"), F.lit("ats_json")).alias("cell"),
        prior_of(F.lit("phones"), F.lit("linkedin")).alias("gap"),
        priority_of(F.lit("github")).alias("known"),
        priority_of(F.lit("elsewhere")).alias("unknown"),
    ).first()
    assert tuple(row) == (736, 363, 0, 850, 500, 4, 6)
    assert prior("experience", "recruiter_csv") == 500
    with pytest.raises(ValueError):
        checked_priors({"emails": {"x": 0.85}})


def test_no_character_that_nfkc_changes_is_missed(spark):
    import random
    import sys
    import unicodedata

    from goldweave.functions import nfkc
    from goldweave.functions.text import open_ranges

    inside = {n for a, b in open_ranges() for n in range(a, b + 1)}
    closed = [chr(n) for n in range(sys.maxunicode + 1) if n not in inside and not 0xD800 <= n < 0xE000]
    # none changes alone, and none changes behind another
    assert all(unicodedata.normalize("NFKC", c) == c for c in closed)
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice(closed) for _ in range(200))
        assert unicodedata.normalize("NFKC", text) == text
    texts = ["plain", "Žluťoučký kůň", "ﬁ", "a\u0301", "ｆｕｌｌ", "한", "\u1112\u1161\u11ab", "½", "中文", "e\u0327\u0301", None, ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(nfkc(rows.t)).collect()]
    assert got == [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]
