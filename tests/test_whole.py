"""Queries that do the whole of what an older one does in part."""

import datetime as dt
import html

from treille.plans import queries

DATA = "/root/testdata/sf0.001"


def test_whole_texts_are_escaped(spark):
    want = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").where("text is not null").collect()}
    got = {r["doc_id"]: r["escaped"] for r in queries.QUERIES["escaped_texts"](spark, DATA).collect()}
    assert any("'" in x[:80] for x in want.values()) and max(map(len, want.values())) > 80
    assert {i: html.unescape(x) for i, x in got.items()} == want
    assert not any(c in x for x in got.values() for c in "<>\"'")


def test_names_with_another_first_letter_match(spark):
    names = {r["slug"]: r["name"] for r in spark.read.parquet(f"{DATA}/gi_register.parquet").collect()}
    slugs = sorted(names)
    limit = lambda x: 1 if len(x) <= 6 else 2 if len(x) <= 12 else 3
    want = {}
    for i, a in enumerate(slugs):
        for b in slugs[i + 1 :]:
            x, y = names[a], names[b]
            if x[0] == y[0] or max(len(x), len(y)) > 6:
                d = edits(x, y, min(limit(x), limit(y)))
                if d <= min(limit(x), limit(y)):
                    want[a, b] = d
    rows = queries.QUERIES["fuzzy_levenshtein_match"](spark, DATA).collect()
    assert {(r["slug_a"], r["slug_b"]): r["edits"] for r in rows} == want and len(rows) == len(want)
    assert sum(names[a][0] != names[b][0] for a, b in want) == 46


def edits(a, b, most):
    if abs(len(a) - len(b)) > most:
        return most + 1
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        if min(row) > most:
            return most + 1
        last = row
    return last[-1]


def test_facts_are_grounded_in_the_specification(spark, tmp_path):
    day = [dt.datetime(2024, 1, n) for n in (1, 2)]
    finding = [(1, 1, "old vines on poor soil"), (2, 2, "old vines on poor soil"), (3, 3, "old vines on poor soil"), (4, 2, "not to be found in either")]
    item = [(1, "fr", "raw/x/val-do-1.json", "old vines on poor soil.", day[0]), (2, "fr", "raw/x/val-do-2.json", "something else", day[0]), (3, "fr", None, "old vines on poor soil", day[0])]
    cahier = [(1, "val-do", "a text before", day[0], day[0]), (2, "val-do", "Old vines\non poor soil", day[1], day[0]), (3, "val-do", None, day[1], day[1])]
    for name, rows, schema in (
        ("audit_finding", finding, "finding_id long, item_id long, snippet string"),
        ("audit_item", item, "item_id long, expected string, file string, text string, loaded_at timestamp"),
        ("cahier_extract", cahier, "cahier_id long, slug string, raw_text string, fetched_at timestamp, loaded_at timestamp"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = queries.QUERIES["fact_grounding"](spark, str(tmp_path)).collect()
    assert {r["finding_id"]: r["provenance"] for r in rows} == {1: "both", 2: "second", 3: "first"}
