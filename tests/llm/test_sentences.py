import pytest

from treille.llm import sentences as s

PLACES = ["Mavo", "Sento", "Buckoc", "Lende", "Korga", "Mielmo"]


@pytest.fixture(scope="module")
def docs(spark):
    rows, i = [], 0
    for k in range(60):
        a, b = PLACES[k % 6], PLACES[(k + 1) % 6]
        en = f"The hamlets of St. {a} and St. {b} appear in No. {k + 1} of the register. The wines, e.g. those of {a}, are dry.\n\nThe rule of No. {k} is clear. What freshness! The board said: “No. The rule is clear.” It ends here."
        de = f"Die Lagen St. {a} und St. {b} sind z. B. im Register von {1900 + k} genannt. Die Weine sind trocken.\n\nDie Regel endet am 3. März des Jahres. Der Boden ist karg."
        rows += [(i, en, "en"), (i + 1, de, "de"), (i + 2, "土はやせている。「木は苦しむ。」と記している。終わり！", "ja")]
        i += 3
    rows += [
        (1000, None, "en"), (1001, "", "en"), (1002, " \n\n ", None), (1003, "1. Permitted kinds\n\n* one: 5 hl/ha;\n* two. Three", "en"),
        (1004, "The report asks “Should one go?” and leaves it there. The wine is dry… and at times saline. 5,700 hectares were\ndeclared in 1907.", "en"),
        (1005, "The wines are dry. " * 20_000, "en"), (1006, "เนินเขาแถบนี้สะท้อนลม ไวน์จากเขตนี้ 47 เฮกตาร์ ดินบางของเขตนี้", "th"),
        (1007, "“The soil is poor. The vine struggles,” notes the board. The wines are dry.The rule is clear.", "en"),
    ]
    return spark.createDataFrame(rows, "id long, text string, lang string").selectExpr("*", "1 as end_pos", "'x' as t")


def test_sentences_are_cut_where_they_end(docs):
    ends = {}
    for r in s.sentence_ends(docs, "id", "text", "lang").collect():
        ends.setdefault(r["id"], []).append(r["end_pos"])
    text = {r["id"]: r["text"] for r in docs.collect()}

    def cut(i):
        at, out = 0, []
        for e in sorted(ends.get(i, [])):
            out.append(text[i][at:e].strip())
            at = e
        return out

    assert len(cut(0)) == 7 and cut(0)[0].endswith("register.") and cut(0)[4].endswith("“No.") and cut(0)[5] == "The rule is clear.”"
    assert len(cut(1)) == 4
    assert cut(2) == ["土はやせている。", "「木は苦しむ。」と記している。", "終わり！"]
    assert [ends.get(i, []) for i in (1000, 1001, 1002)] == [[], [], []]
    assert cut(1003) == ["1. Permitted kinds", "* one: 5 hl/ha;", "* two. Three"]
    assert len(cut(1004)) == 3 and len(cut(1005)) == 20_000
    assert cut(1006) == ["เนินเขาแถบนี้สะท้อนลม", "ไวน์จากเขตนี้ 47 เฮกตาร์", "ดินบางของเขตนี้"]
    assert cut(1007) == ["“The soil is poor. The vine struggles,” notes the board.", "The wines are dry.", "The rule is clear."]


def test_plain_adjectives_are_no_abbreviations(docs):
    """Words that end sentences before one and the same opening word, however often; the count of a repeated sentence doesn't matter."""
    from treille.llm.language_mix import train

    model = train(docs.selectExpr("text", "lang"), s.LANGS)
    know = s.learn(docs, "text", docs.sparkSession.sparkContext.broadcast(model))
    assert {"st", "no", "e.g"} <= {w for lang, w in know.abbreviations if lang == "en"}
    assert not {"clear", "dry", "karg", "jahres", "trocken", "genannt", "freshness"} & {w for _, w in know.abbreviations}
    assert not any(w[0].isdigit() for _, w in know.abbreviations)


def test_words_without_blanks_are_read_once(docs):
    long = docs.limit(1).selectExpr("1 as id", "concat(repeat('aa.A1b', 200000), '. The end.') as text", "'en' as lang")
    assert s.sentence_ends(docs.select("id", "text", "lang").union(long.select("id", "text", "lang")), "id", "text", "lang").where("id = 1").count() >= 1


def test_no_documents(docs):
    assert s.sentence_ends(docs.limit(0), "id", "text", "lang").count() == 0
