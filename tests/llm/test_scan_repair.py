import pytest

from treille.llm import scan_repair as r

BODY = ["Les vieux ceps de la vallée supportent bien une pente moyenne de 12 %. Les coteaux", "reçoivent chaque année des sols caillouteux, pauvres et bien drainés. Les vignes", "plantées autour du village gardent longtemps une maturité lente mais complète."]


def document(i):
    extra = {0: "Les vieux ceps de la va1lée supportent une pente moyenne de 2O %.", 1: "Les coteaux supportent bien une matu-", 2: "Les vignes plantées au-"}.get(i % 5, BODY[0])
    nxt = {1: "rité lente mais complète.", 2: "dessus du village gardent longtemps une pente."}.get(i % 5, BODY[1])
    turn = [BODY[(i + k) % 3] for k in range(3)] * 4
    pages = [["VAL DE MAVO", "", *turn[:6], extra, nxt, *turn[6:]], [*turn[:5], "Les vignes au-dessus de la vallée gardent une maturité.", *turn[5:]], [*turn[2:]]]
    out = []
    for n, page in enumerate(pages):
        out.append(("\f" if n else "") + f"Cahier des charges : Val de Mavo    {n + 1}")
        out += page + ["", f"– {n + 1} –"]
    return "\n".join(out)


@pytest.fixture(scope="module")
def marks(spark):
    rows = [(i, "fr", document(i)) for i in range(40)] + [(100, "fr", ""), (101, "fr", "x " * 30_000)]
    df = spark.createDataFrame(rows, "id long, lang string, text string").selectExpr("*", "1 as line", "'x' as running")
    return [x.collect() for x in r.marks(df)]


def test_furniture(marks):
    lines = document(3).split("\n")
    found = {x["line"] for x in marks[0] if x["id"] == 3}
    assert found == {i for i, x in enumerate(lines) if "Cahier" in x or x.startswith("– ")}


def test_broken_words_keep_true_hyphens(marks):
    assert {x["id"] % 5 for x in marks[1]} == {1} and {x["whole"] for x in marks[1]} == {"maturité"}
    assert len(marks[1]) == 8


def test_misread_lines(marks):
    lines = document(0).split("\n")
    bad = next(i for i, x in enumerate(lines) if "va1lée" in x)
    assert {(x["id"], x["line"]) for x in marks[2]} == {(i, bad) for i in range(0, 40, 5)}


def test_trie_finds_all_and_channel_counts_misreads():
    words = ["maturité", "nature", "mature", "vallée", "vallon"]
    trie = r.Trie(words)
    want = {w for w in words if r.distance(w, "mature", 2) <= 2}
    assert {w for w, _ in trie.near("mature", 2)} >= {"mature", "nature"} and want <= {w for w, _ in trie.near("mature", 2)}
    assert r.channel("moyenne", "moyerine") == 1 and r.channel("vallée", "va1l6e") == 2 and r.channel("vin", "xyz") == 4


def test_no_documents(spark):
    empty = spark.createDataFrame([], "id long, lang string, text string")
    assert [x.count() for x in r.marks(empty)] == [0, 0, 0]


def test_repaired_paragraphs(spark):
    docs = spark.createDataFrame([(i, "fr", document(i)) for i in range(40)], "id long, lang string, text string")
    parts = docs.selectExpr("id", "id as cahier_id", "'raw_text' as field", "0 as first", "text")
    rows = r.repaired(parts, *r.marks(docs)).collect()
    text = {i: " ".join(x["text"] for x in sorted((x for x in rows if x["cahier_id"] == i), key=lambda x: x["para_no"])) for i in range(40)}
    assert "ceps de la vallée supportent une pente moyenne de 20 %." in text[0]
    assert "supportent bien une maturité lente" in text[1] and "plantées au-dessus du village" in text[2]
    assert not any("Cahier" in x or "– 1 –" in x or "\n" in x for x in text.values())
    assert all(x.startswith("VAL DE MAVO ") for x in text.values())
    words = {i: [w for n, line in enumerate(document(i).split("\n")) if "Cahier" not in line and not line.startswith("– ") for w in line.split()] for i in (3, 4)}
    assert all(text[i].split() == words[i] for i in words)


def test_paragraphs_over_pages_and_odd_case():
    text = "a) Titre\n\nLes vieux ceps de la va1lée et l'ap-\n\n12\n\fTITRE 2\n\npellation, sont au-\ndessus. MATUR1TÉ\nlnfluence du nord\n\n– un ;\n– deux ;"
    got = r.paragraphs(text, {4, 5}, {2: "appellation"}, {2: [("va1lée", "vallée")], 8: [("matur1té", "maturité")], 9: [("lnfluence", "influence")]})
    assert got == ["a) Titre", "Les vieux ceps de la vallée et l'appellation, sont au-dessus. MATURITÉ influence du nord", "– un ;", "– deux ;"]
    assert r.paragraphs("", set(), {}, {}) == [] and r.paragraphs("x\n\n\fy", {2}, {}, {}) == ["x"]
    assert r.corrected("gl! alberi e 1O hl, 12g", [("gl", "gli"), ("1O", None), ("12g", None)], True) == "gli alberi e 10 hl, 12g"


def test_language_model_reads_whole_texts(spark):
    head = "12 345 " * 700
    words = {"fr": "les vieux ceps de la vallée gardent une maturité lente ", "de": "die alten Stöcke der Weinberge spiegeln geringe Niederschläge "}
    rows = [(lang, head + words[lang] * (5 + i)) for lang in words for i in range(10)] + [(None, words["fr"] * 2), (None, words["de"] * 2)]
    got = r.with_language(spark.createDataFrame(rows, "label string, text string"), "text", "label", ["de", "fr"]).where("label is null").collect()
    assert {x["text"].split()[0]: x["lang"] for x in got} == {"les": "fr", "die": "de"}


def test_recurring_misreads_long_words_and_long_furniture(spark):
    long = "ab" * 35
    footer = " ".join(f"comité{c * 6} interprofessionnel{c * 3}" for c in "abcd")
    text = "TITRE\n" + "\n".join(["les vieux ceps de la vallée gardent une maturité lente"] * 101 + ["le wqx7zkj est là"] + [f"le {long} est là", "les coteaux gardent une pente"] * 3 + ["les vieux ceps de la vallée gardent une maturité lente"] * 9) + "\n" + footer
    rows = [(i, "fr", text.replace(long, long[:30] + "1" + long[31:], 1) if i == 5 else text) for i in range(30)]
    running, _, glyph = (x.collect() for x in r.marks(spark.createDataFrame(rows, "id long, lang string, text string")))
    assert sum(x["t"] == "wqx7zkj" for x in glyph) == 30
    assert {x["v"] for x in glyph if x["id"] == 5 and x["t"] != "wqx7zkj"} == {long}
    assert len(r.core(r.line_key(footer, set()))) > 80 and {(x["id"], x["line"]) for x in running} == {(i, 118) for i in range(30)}
