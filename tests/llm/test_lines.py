import itertools
import random

import pytest
from pyspark.sql import functions as F

from wayfare.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def slow(rows, least=8):
    """doc, text pairs without repeats -> counts and what is kept, comparing all lines."""
    place = []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, line in enumerate((text or "").split("\n")):
            ws = "".join(c.lower() if c.isascii() else c for c in line).translate(
                str.maketrans("\t\x0b\x0c\r", "    ")
            )
            ws = [w for w in ws.split(" ") if w]
            if ws:
                place.append((doc, k, ws))
    first = {}
    for n, (_, _, ws) in enumerate(place):
        first.setdefault(tuple(ws), n)
    near = set()
    for (a, m), (b, n) in itertools.combinations(first.items(), 2):
        if len(a) >= least and len(b) >= least and abs(len(a) - len(b)) <= 1 and distance(a, b) <= 1:
            near.add(b if n > m else a)
    out = {doc: [0, 0, 0, set()] for doc, _ in rows}
    for n, (doc, k, ws) in enumerate(place):
        out[doc][0] += 1
        if tuple(ws) in near:
            out[doc][2] += 1
            out[doc][3].add(k)
        elif first[tuple(ws)] != n:
            out[doc][1] += 1
            out[doc][3].add(k)
    return [
        (doc, *out[doc][:3], None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in out[doc][3]))
        for doc, text in rows
    ]


@pytest.mark.parametrize("seed", range(300))
def test_one_word_apart_and_keys(seed):
    draw = random.Random(seed)
    a = [draw.choice("abc") for _ in range(draw.randint(2, 9))]
    b = list(a)
    for _ in range(draw.randint(0, 2)):
        at = draw.randrange(len(b)) if b else 0
        b[at : at + draw.randint(0, 1)] = draw.choice([[], ["x"], ["a"]])
    near = distance(a, b) <= 1
    assert lines.one_word_apart(a, b) == near
    ab, bb = [w.encode() for w in a], [w.encode() for w in b]
    if near and min(len(a), len(b)) > 1:
        assert set(lines.half_keys(ab)) & set(lines.half_keys(bb))
    whole = lines.deletion_hashes(ab)
    for p in range(len(a)):
        assert whole[p] == lines.deletion_hashes(ab[:p] + ab[p + 1 :])[-1]


def awkward():
    draw = random.Random(7)
    base = [" ".join(f"w{draw.randint(0, 50)}" for _ in range(n)) for n in (7, 8, 9, 12, 30)]
    rows = []
    for doc in range(60):
        said = []
        for _ in range(draw.randint(0, 5)):
            ws = draw.choice(base).split(" ")
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                at = draw.randrange(len(ws))
                ws[at : at + draw.randint(0, 1)] = draw.choice([[], [f"v{draw.randint(0, 9)}"]])
            said.append(draw.choice([" ", "  ", "\t"]).join(ws).upper() if draw.random() < 0.2 else " ".join(ws))
        rows.append((doc, "\n".join(said + [""] * draw.randint(0, 2))))
    return rows + [(60, None), (61, ""), (62, " \n\n"), (63, "a\na\nA \nb"), (None, base[3] + "\nnull key"), (64, "w " * 40000)]


def test_against_all_pairs(spark):
    rows = awkward()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"line": F.lit(1), "form": F.lit(2), "n_near": F.lit("old")}
    )
    got = lines.dedup(docs.repartition(5)).select("doc_id", "n_lines", "n_exact", "n_near", "kept_text").collect()
    want = slow(rows)
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 10 and sum(w[3] for w in want) > 20


def test_repeated_rows_agree(spark):
    text = "one two three four five six seven eight nine\nshort\nshort"
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id int, text string")
    got = sorted(tuple(r) for r in lines.dedup(docs).select("doc_id", "n_lines", "n_exact", "kept_text").collect())
    kept = text.rsplit("\n", 1)[0]
    assert got == [(1, 3, 1, kept), (1, 3, 1, kept), (2, 3, 3, "")]


def test_links_of_a_large_neighbourhood_are_linear(spark):
    ws = [f"w{k}" for k in range(20)]
    said = [" ".join(ws[:10] + [f"name{k}"] + ws[10:]) for k in range(500)]
    table = spark.createDataFrame(list(enumerate(said)), "rank bigint, said string")
    links = lines.near_links(table).collect()
    assert {r.later for r in links} == set(range(1, 500)) and len(links) == 499


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert lines.dedup(docs).collect() == []


