import itertools
import math
import re

import pytest

from wayfare.llm import interaction
from wayfare.llm.queries import QUERIES

LETTERS = "ABCDE"
METRICS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def fails(rows):
    """The set of letters that each (key, text) fails, by plain Python."""
    out = []
    for key, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": re.search("[#$%&*|]", text) is not None,
            "E": key is not None and any(k is not None and k < key and (t or "") == text for k, t in rows),
        }
        out.append({letter for letter, failed in found.items() if failed})
    return out


def slow(docs, labels):
    """Each order applied to each document."""
    failed = fails([(key, text) for key, text, _ in docs])
    marks = {}
    for key, quality, toxic in labels:
        good, bad = marks.get(key, (False, False))
        marks[key] = (good or quality == 1, bad or toxic == 1)
    marks.pop(None, None)
    out = {}
    for part in {d[2] or "" for d in docs}:
        rows = [(f, *marks.get(d[0], (False, False))) for d, f in zip(docs, failed) if (d[2] or "") == part]
        sums = dict.fromkeys(LETTERS, 0)
        for order in itertools.permutations(LETTERS):
            gone = [False] * len(rows)
            for step, letter in enumerate(order, 1):
                here = [letter in row[0] and not g for row, g in zip(rows, gone)]
                again = sum(letter in row[0] and g for row, g in zip(rows, gone))
                gone = [g or h for g, h in zip(gone, here)]
                sums[letter] += sum(here)
                out[part, "".join(order), step] = (
                    gone.count(False),
                    sum(here),
                    again,
                    sum(row[0] == {letter} for row in rows),
                    sum(h and row[1] for row, h in zip(rows, here)),
                    sum(h and row[2] for row, h in zip(rows, here)),
                    letter,
                )
        for (p, order, step), row in out.items():
            if p == part:
                out[p, order, step] = (*row[:6], sums[row[6]])
    return out


def audited(spark, docs, labels, **more):
    table = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = interaction.audit(table, marks, **more).collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): tuple(r[m] for m in METRICS) for r in rows}


LONG = " ".join(f"word{k}" for k in range(60))
DOCS = [
    (1, LONG, "web"), (2, LONG, "web"), (3, LONG, None), (3, LONG, ""), (4, "a " * 80, "web"), (5, None, "web"),
    (6, "", "code"), (7, " \n\t", "code"), (8, LONG.upper() + "#", "code"), (9, LONG + " 5%", "web"), (None, LONG, "web"),
    (None, None, None), (10, "Ä" * 99 + "ABCDE", "é"), (11, "Ä" * 95 + "ABCDE", "é"), (12, "a b c d e f g\x0bh i\xa0j " * 20000, "é"),
    (1, LONG, "web"), (13, "same | same", "é"), (14, "Same | same", "é"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (4, None, 1), (4, 1, None), (5, 1, 0), (8, 1, 1), (None, 1, 1), (99, 1, 1), (10, 0, 0)]


def test_against_plain_python(spark):
    assert audited(spark, DOCS, LABELS) == slow(DOCS, LABELS)


def test_every_order_and_step_of_every_part(spark):
    got = audited(spark, DOCS, [])
    assert len(got) == 5 * math.factorial(5) * len({d[2] or "" for d in DOCS})
    for part in {d[2] or "" for d in DOCS}:
        ends = {row[0] for (p, _, step), row in got.items() if p == part and step == 5}
        assert len(ends) == 1
        # What all filters remove, counted over all orders.
        whole = sum(1 for d in DOCS if (d[2] or "") == part) - ends.pop()
        assert sum({o[s - 1]: row[6] for (p, o, s), row in got.items() if p == part}.values()) == 120 * whole


def test_more_parts_than_the_limit_on_rows_holds(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "CAST(id AS string) AS source", "'#' AS text")
    rows = interaction.audit(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert rows.count() == 4000 * 600
    assert rows.where("step = 1 AND filter_order LIKE 'D%'").agg({"removed": "sum"}).first()[0] == 24 * 4000


def test_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string, source string")
    more = docs.selectExpr("*", "1 AS part", "2 AS mask", "3 AS said", "'x' AS key", "true AS good", "0 AS cells")
    marks = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int").selectExpr("*", "1 AS key", "2 AS text")
    rows = interaction.audit(more, marks).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[m] for m in METRICS) for r in rows} == slow(DOCS, LABELS)
    assert interaction.audit(docs.limit(0), marks).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    rows = QUERIES["op11_filter_audit"](spark, folder).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[m] for m in METRICS) for r in rows} == slow(docs, labels)
