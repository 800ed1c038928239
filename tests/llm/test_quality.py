import re
from collections import Counter

from pyspark.sql import functions as F

from wayfare.llm import quality

GOOD = "The house of the man is in the old town and it was built by the river. " * 1


def slow(text):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    grams = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(ws)
    return (
        n,
        sum(map(len, ws)),
        sum((text or "").count(c) for c in quality.SYMBOLS),
        len(lines) - len(set(lines)),
        len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


TEXTS = [
    None,
    "",
    " \t\r\n\x0b\x0c ",
    "a b c d e",
    "a b c d e a b c d e",
    "a a a a a a a a a a a a",
    "a b a b a b a b a b c d e f g",
    "x y z w v " + " ".join(f"u{k}" for k in range(40)) + " x y z w v",
    "one\n\n one\none\none \n \none",
    "# * $ % & | < > ### plain \u00a0nbsp\u00a0joined é 😀",
    GOOD,
    " ".join(f"w{k % 3000}" for k in range(20000)),
    "word " * 30000,
    "x" * 200000,
]


def test_counts_against_plain_python(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, TEXTS[4]), (4, TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("quality", F.lit("old"))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    got = quality.judge(docs).select("doc_id", *[f"quality.{n}" for n in names]).collect()
    want = [(k, *slow(t)) for k, t in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def kept(spark, *texts):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    return [r.kept for r in quality.judge(docs).orderBy("k").select("quality.kept").collect()]


def test_thresholds(spark):
    ws = [f"{a}{b}" for a in ("bel", "dor", "fin", "gal") for b in ("an", "en", "in", "on", "un", "ar", "er", "ir")]
    plain = " ".join(f"the {w}" for w in ws)
    symbols = " ".join(f"{w}%%% the" for w in ws)
    loud = " ".join(f"{w}!! the" for w in ws)
    no_stops = " ".join(f"{w} {w}x" for w in ws)
    again = " ".join(f"{w} {w}" for w in ws)
    long = " ".join(w * 6 for w in ws)
    lines = "\n".join(["the same old line"] * 4 + [plain])
    assert kept(spark, plain, symbols, loud, no_stops, again, long, lines, None) == [
        True, False, False, False, False, False, False, False,
    ]


def test_one_projection(spark, plan):
    docs = spark.createDataFrame([(1, GOOD)], "doc_id int, text string")
    text = plan(quality.judge(docs))
    assert "Exchange" not in text and "Python" not in text
    assert quality.judge(docs.limit(0)).collect() == []
