import pytest
from pyspark.sql import functions as F

from treille.llm import language_mix as lm

LINES = {
    "en": ["The slopes of the valley receive every year a slow ripening", "The wines made in this place reflect the soil and the wind", "The old vines of the hill withstand scarce rainfall"],
    "fr": ["Les coteaux de la vallée reçoivent chaque année une maturité lente", "Les vins issus de ce secteur reflètent le sol et le vent", "Les vieux ceps de la colline supportent bien une pluie rare"],
    "el": ["Οι πλαγιές της κοιλάδας δέχονται κάθε χρόνο αργή ωρίμανση", "Τα κρασιά του τόπου αντανακλούν το έδαφος και τον άνεμο"],
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, k) for k, ts in LINES.items() for t in ts for _ in range(20)] + [(LINES["fr"][0], "en"), (None, "en"), ("Les vins", None)]
    return lm.train(spark.createDataFrame(rows, "text string, lang string"), ["el", "en", "fr"])


def test_mixture_and_segments(spark, model):
    text = "THE WINES MADE IN THIS HILL REFLECT A SLOW RIPENING: “les vieux ceps de la vallee supportent le vent.” The old slopes reflect the soil."
    df = spark.createDataFrame([(1, text, 9), (2, None, 9), (3, "", 9), (4, "12 % ...", 9)], "id int, body string, langs int")
    got = {r["id"]: r for r in lm.identify(df, "id", "body", model).collect()}
    assert [s["lang"] for s in got[1]["segments"]] == ["en", "fr", "en"]
    assert all(0 <= s["confidence"] <= 1 for s in got[1]["segments"]) and abs(sum(x["share"] for x in got[1]["langs"]) - 1) < 1e-9
    assert got[2]["segments"] == got[3]["segments"] == got[4]["segments"] == []


def test_long_text_and_held_out_lines(spark, model):
    assert {s[2] for s in model.segments(" . ".join([LINES["el"][0]] * 2000))} == {"el"}
    assert model.segments("The cellars in this valley reflect the old wind")[0][2] == "en"
    assert model.segments("Les caves de ce coteau reflètent une année de pluie")[0][2] == "fr"


def test_codes(spark):
    df = spark.createDataFrame([(x,) for x in ["fr_FR", "EN", "nld", "und", "", None, " de-DE ", "xyz"]], "l string")
    assert [r[0] for r in df.select(lm.language_code(F.col("l"))).collect()] == ["fr", "en", "nl", None, None, None, "de", None]


def test_no_rows(spark):
    model = lm.train(spark.createDataFrame([], "text string, lang string"), ["en", "fr"])
    assert lm.identify(spark.createDataFrame([], "id long, text string"), "id", "text", model).count() == 0
