"""Forms of secrets, phones and cards beside each other; linked and reversible."""

import re

from strata.llm import pii

CARD = "4337166598464399"
SECRETS = {"password: p@ss!word1": "p@ss!word1", "password = hunter22x": "hunter22x", '{"password": "hunter22x", "a": 1}': "hunter22x",
           "token=" + "aB3" * 70 + " end": "aB3" * 70, "ghp_" + "x9" * 35: "x9" * 35, "sk-proj-" + "Ab1" * 8: "Ab1" * 8,
           "auth: eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl1": "c2lnbmF0dXJl1", "see eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.dBjftJeZ4CVP": "dBjftJeZ4CVP",
           "api_key => 'k3y-w1th_parts'": "k3y-w1th_parts", "secret:abcdefgh.": "abcdefgh"}
PHONES = {"call (319) 555-5132 now": "555-5132", "tel 030 1234567.": "1234567", "or 319-555-5132": "555-5132", "0171/2345678": "2345678",
          "+49 30 1234567": "30 1234567"}
CARDS = {"pin 99 4 3 3 7 1 6 6 5 9 8 4 6 4 3 9 9": "4 3 3 7 1 6 6 5 9 8 4 6 4 3 9 9", "43 37 16 65 98 46 43 99 x": "43 37 16 65 98 46 43 99"}
STAY = ["the token : a word", "secret: the door", "auth = yes", "version 3.14.15 of 2020-13-45", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20",
        "030 12 34", "12 13 14 15 16 17 18 19 20 21 22", "ask-me-anything-about-it", ""]


def test_probes_are_replaced_and_go_back(spark):
    rows = [*SECRETS.items(), *PHONES.items(), *CARDS.items()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*(t for t, _ in rows), *STAY])], "doc_id long, text string")
    out = pii.pseudonymise(df, "key").orderBy("doc_id").checkpoint()
    got = [r.text for r in out.collect()]
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t)))
    for (text, value), new in zip(rows, got):
        assert value not in new and shape(new) == shape(text), (text, new)
    assert got[len(rows):] == STAY
    back = pii.pseudonymise(out, "key", decrypt=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == [r.text for r in df.collect()]


def test_equal_secrets_stay_linked(spark):
    forms = ["password: hunter22x", 'password="hunter22x"', "password = hunter22x.", "password=hunter22x, and"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(forms)], "doc_id long, text string")
    got = [re.search(r"[a-z]{6}\d\d[a-z]", r.text)[0] for r in pii.pseudonymise(df, "key").orderBy("doc_id").collect()]
    assert len(set(got)) == 1 and got[0] != "hunter22x"


def test_a_very_long_secret(spark):
    value = "a1B2" * 25000
    df = spark.createDataFrame([(f"token={value} end",)], "text string")
    out = pii.pseudonymise(df, "key").checkpoint()
    new = out.first().text
    assert len(new) == len(value) + 10 and sum(a == b for a, b in zip(new[6:-4], value)) < 20000
    assert pii.pseudonymise(out, "key", decrypt=True).first().text == df.first().text
