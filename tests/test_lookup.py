import random
import re

import pytest
from pyspark.sql import functions as F

from gridsteps.functions.text import lcs_length, lcs_ratio
from gridsteps.operators import lookup


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_against_table(spark):
    rnd = random.Random(1)

    def word(n):
        return "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(0, n)))

    pairs = [(word(90), word(70)) for _ in range(150)] + [("a" * 62, "a" * 62), ("", ""), ("a" * 63, "a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n")).collect():
        assert r.n == lcs(r.a, r.b)


def test_ratio(spark):
    pairs = [("germany", "germany", 100), ("franz", "france", 73), ("nether", "netherlands", 71), ("", "", 0)]
    df = spark.createDataFrame(pairs, "a string, b string, s int")
    assert all(r.s == r.got for r in df.withColumn("got", lcs_ratio(F.col("a"), F.col("b"))).collect())


@pytest.fixture(scope="module")
def names(spark):
    rows = [(0, "France", "FRA"), (1, "Germany", "DEU"), (2, "Niger", "NER"), (3, "Netherlands", "NLD"),
            (4, "Côte d'Ivoire", "CIV"), (5, "Territory of " + "x" * 70, "LNG"), (6, "FRANCE!", "TWO")]
    return spark.createDataFrame(rows, "pos int, name string, code string")


def test_fuzzy(spark, names):
    wanted = {"germany": "DEU", "franz": "FRA", "nether": "NLD", "cote divoire": "CIV",
              "france": "FRA", "qqqq": "FRA", "territory " + "x" * 66: "LNG", "": "FRA"}
    queries = spark.createDataFrame([(q,) for q in wanted] * 2, "q string")
    got = lookup.fuzzy_match(queries, "q", names)
    assert {r.query: r.code for r in got.collect()} == wanted
    assert got.count() == len(wanted)


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for j, d in enumerate(b):
            new.append(row[j] + 1 if c == d else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_fuzzy_over_blocks_is_exact(spark):
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcde-Z") for _ in range(rnd.randint(0, 75))) for _ in range(900)]
    names = spark.createDataFrame(list(enumerate(words)), "pos int, name string").withColumn(
        "code", F.col("pos").cast("string"))
    queries = spark.createDataFrame([(w[3:20],) for w in words[:40]], "q string")
    plain = [re.sub(r"\W", " ", w).lower().strip(" ") for w in words]
    wanted = {}
    for q in {w[3:20] for w in words[:40]}:
        t = re.sub(r"\W", " ", q).lower().strip(" ")
        scores = [round(200 * _lcs(p, t) / (len(p) + len(t))) if p or t else 0 for p in plain]
        best = scores.index(max(scores))
        wanted[q] = (words[best], str(best), scores[best])
    got = {r.query: (r.name, r.code, r.score) for r in lookup.fuzzy_match(queries, "q", names).collect()}
    assert got == wanted


def test_codes(spark):
    dim = spark.createDataFrame([(1, "Germany"), (2, "Atlantis")], "id int, name string")
    iso = spark.createDataFrame([("Germany", "DEU")], "name string, code string")
    df = spark.createDataFrame([(1.0,), (7.0,)], "country_id double")
    assert [r.country for r in lookup.code_to_name(df, dim).collect()] == ["Germany", "7.0"]
    assert [r.country for r in lookup.code_to_iso(df, dim, iso).collect()] == ["DEU", "7.0"]
    lost = spark.createDataFrame([(2,)], "country_id int")
    with pytest.raises(Exception):
        lookup.code_to_iso(lost, dim, iso).collect()
    assert lookup.code_to_iso(lost, dim, iso, strict=False).first().country is None
    assert lookup.iso_to_name(iso.select("code"), iso).first().country == "germany"


def test_input_types(spark):
    reg = lookup.input_type_rules(spark.createDataFrame(
        [(6, "landuse"), (7, "with_tillage"), (18, "fertilizer_nr")], "id int, name string"))
    assert tuple(lookup.find_input_type(reg, id=6).first()) == (6, "landuse", 64, "float", True)
    assert tuple(lookup.find_input_type(reg, name="with_tillage").first())[2:] == (1, "int", False)
    assert tuple(lookup.find_input_type(reg, id=18).first())[2:] == (32, "float", True)
    with pytest.raises(ValueError):
        lookup.find_input_type(reg)
