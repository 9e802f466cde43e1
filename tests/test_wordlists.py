"""Stems against the published examples of the rules, and word search against every row."""

import pytest

from millrace.functions.stems import stem
from millrace.operators import wordlists

# Words and their stems as published with the rules.
EXAMPLES = """consign consign, consigned consign, consigning consign, consignment consign, consist consist, consisted consist,
consistency consist, consistent consist, consistently consist, consisting consist, consists consist, consolation consol,
consolations consol, consolatory consolatori, console consol, consoled consol, consolidate consolid, consolidated consolid,
consolidating consolid, consoling consol, consolingly consol, consols consol, consonant conson, consorted consort,
conspicuous conspicu, conspicuously conspicu, conspiracy conspiraci, conspirator conspir, conspirators conspir,
conspire conspir, conspired conspir, constable constabl, constables constabl, constance constanc, constancy constanc,
constant constant, knackeries knackeri, knacks knack, knave knave, knaves knave, knavish knavish, kneaded knead,
kneading knead, knee knee, kneel kneel, kneeled kneel, knees knee, knelt knelt, knif knif, knife knife, knightly knight,
knights knight, knitted knit, knitting knit, knives knive, knocker knocker, knockers knocker, knopp knopp"""
# Worked out by hand from the rules, one for each of their branches.
BRANCHES = """ties tie, cries cri, gas gas, gaps gap, kiwis kiwi, caresses caress, plays play, hoping hope, hopping hop, luxuriated luxuri,
disabled disabl, cry cri, by by, say say, generate generat, generic generic, communism communism, arsenal arsenal,
skies sky, dying die, news news, herring herring, exceeds exceed, proceeded proceed, agreed agre, feed feed, rational ration,
sensational sensat, vietnamization vietnam, digitizer digit, hopefulness hope, apology apolog, geology geolog, ugly ugli, early earli, quickly quick,
decisiveness decis, formative format, electricity electr, adoption adopt, controlling control, controll control, roll roll, youth youth,
yellow yellow, boyish boyish, sing sing, rings ring, bed bed, abed abe, gorges gorg"""


def _pairs(text):
    return [tuple(p.split()) for p in text.replace("\n", " ").split(",")]


def test_stems(spark):
    pairs = _pairs(EXAMPLES) + _pairs(BRANCHES)
    df = spark.createDataFrame(pairs, "word string, wanted string")
    out = df.withColumn("stem", stem(df.word))
    assert [tuple(r) for r in out.where("stem <> wanted").collect()] == []
    assert out.count() == len(pairs)


def test_other_words(spark):
    words = ["", "a", "ab", "é", "straßen", "x9s", "2020s", None, "日本", "coulées"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: r.stem for r in df.select("word", stem(df.word).alias("stem")).collect()}
    assert got[""] == "" and got["ab"] == "ab" and got["x9s"] == "x9s" and got["2020s"] == "2020s" and got[None] is None
    assert got["straßen"] == "straßen" and got["coulées"] == "coulé" and got["日本"] == "日本"


NAMES = [
    "Three Gorges Dam", "three gorge dams", "The Gorge", "Solar farming at Hope", "hoping for solar farms", "farm, farm; FARMS", "of the and", "", None,
    "2020s station 3", "Station-3 2020s", "Grand Coulée", "dam three",
]
SEARCHES = {
    "gorges": [0, 1, 2], "THE gorge of three": [0, 1], "dams three": [0, 1, 12], "farm hope": [3, 4], "farms": [3, 4, 5], "2020s": [9, 10], "3 stations": [9, 10],
    "coulée": [11], "the": [], "nothing": [], "gorge nothing": [], "solar solar": [3, 4],
}


@pytest.fixture(scope="module")
def names(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("words"))
    df = spark.createDataFrame(list(enumerate(NAMES)), "nr bigint, label string").repartition(4)
    wordlists.build_words(df, path, "nr", "label")
    return df, path


def test_every_search(names):
    df, path = names
    for text, wanted in SEARCHES.items():
        assert sorted(r.nr for r in wordlists.search_words(df, path, text, "nr").collect()) == wanted, text
    with pytest.raises(ValueError):
        wordlists.search_words(df, path, " - ", "nr")


def test_each_pair_is_listed_once(spark, names):
    _, path = names
    lists = spark.read.parquet(f"{path}/lists")
    assert lists.count() == lists.distinct().count()
    assert {r["stem"]: r["n"] for r in spark.read.parquet(f"{path}/counts").collect()}["farm"] == 3


def test_a_search_reads_its_lists_alone(names):
    df, path = names
    plan = wordlists.search_words(df, path, "gorges three", "nr")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(stem,gorg)" in plan and "EqualTo(stem,three)" in plan


def test_nothing_listed(spark, tmp_path):
    df = spark.createDataFrame([], "id bigint, name string")
    wordlists.build_words(df, str(tmp_path / "none"))
    assert wordlists.search_words(df, str(tmp_path / "none"), "dam").count() == 0
