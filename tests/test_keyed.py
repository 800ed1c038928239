"""Keyed tables: what readers see, what they open, and what a crash leaves."""

import random

import pytest

from wayfare.session import settings
from wayfare.sinks.keyed import BUCKET, KeyedTable
from wayfare.sinks.pointer import Pointer, children
from wayfare.sinks.totals import RunningTotals

SCHEMA = "k string, v bigint, x string"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    with settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        yield


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_batches(seed, n, keys=12, size=9):
    rng = random.Random(seed)
    return [
        [(rng.choice([None, *map(str, range(keys))]), rng.randrange(60), f"b{n}r{i}") for i in range(size)]
        for n in range(n)
    ]


def expected(batches, version):
    held = {}
    for batch in batches:
        for row in batch:
            if not version or row[0] not in held or row[1] >= held[row[0]][1]:
                held[row[0]] = row
    return held


def unique_versions(batches):
    """Versions that no key has twice, so that the last row is certain."""
    return [[(k, v * 1000 + 10 * n + i, x) for i, (k, v, x) in enumerate(b)] for n, b in enumerate(batches)]


def test_folded_table_is_the_log(spark, folder):
    batches = unique_versions(random_batches(1, 11))
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=4, fold_after=3)
    for n, batch in enumerate(batches):
        table.upsert(frame(spark, *batch), n)
        assert told(table.current(spark)) == sorted(expected(batches[: n + 1], True).values(), key=repr)


def test_without_version_the_later_batch_wins_over_folds(spark, folder):
    batches = [[(str(k), n * k, f"b{n}") for k in range(5) if (n + k) % 3] for n in range(8)]
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], buckets=3, fold_after=2)
    for n, batch in enumerate(batches):
        table.upsert(frame(spark, *batch), n)
    assert told(table.current(spark)) == sorted(expected(batches, False).values(), key=repr)


def test_a_reader_opens_few_files_after_a_hundred_batches(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=2, fold_after=8)
    for n in range(100):
        table.upsert(frame(spark, *[(str(k), n, "x") for k in range(6)]), n)
    files = table.current(spark).inputFiles()
    per_bucket = [sum(f"{BUCKET}={k}/" in name for name in set(files)) for k in range(2)]
    assert all(0 < count <= 9 for count in per_bucket)
    assert told(table.current(spark)) == [(str(k), 99, "x") for k in range(6)]
    assert len(set(table.lookup(spark, "3").inputFiles())) <= 9
    assert told(table.lookup(spark, "3")) == [("3", 99, "x")]


def test_only_touched_buckets_are_folded(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=8, fold_after=2)
    table.upsert(frame(spark, *[(str(k), 0, "first") for k in range(40)]), 0)
    for n in range(1, 6):
        table.upsert(frame(spark, ("7", n, "again")), n)
    bases = Pointer(f"{folder}/t/pointer.json").read(spark, None)["bases"]
    assert len(bases) == 8
    assert sorted(bases.values()).count("fold-1") == 7
    assert len(told(table.current(spark))) == 40


def test_replays_change_nothing(spark, folder):
    batches = unique_versions(random_batches(2, 9))
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=4, fold_after=3)
    for n, batch in enumerate(batches):
        for _ in range(2):
            table.upsert(frame(spark, *batch), n)
        assert told(table.current(spark)) == sorted(expected(batches[: n + 1], True).values(), key=repr)
    with pytest.raises(ValueError, match="folded already"):
        table.upsert(frame(spark, *batches[0]), 0)


def test_a_replay_may_bring_other_rows(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=2, fold_after=1)
    table.upsert(frame(spark, ("a", 1, "x")), 0)
    table.upsert(frame(spark, ("b", 5, "first try")), 1)
    table.upsert(frame(spark, ("c", 6, "second try")), 1)
    assert told(table.current(spark)) == [("a", 1, "x"), ("c", 6, "second try")]


class Died(Exception):
    pass


@pytest.mark.parametrize("dies_at", ["fold", "batch"])
def test_a_crash_before_the_pointer_moves(spark, folder, monkeypatch, dies_at):
    batches = unique_versions(random_batches(3, 5))
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=4, fold_after=3)
    for n in range(3):
        table.upsert(frame(spark, *batches[n]), n)
    real, calls = Pointer.replace, []

    def replace(self, session, content):
        calls.append(content)
        if len(calls) == (1 if dies_at == "fold" else 2):
            raise Died
        real(self, session, content)

    monkeypatch.setattr(Pointer, "replace", replace)
    with pytest.raises(Died):
        table.upsert(frame(spark, *batches[3]), 3)
    monkeypatch.setattr(Pointer, "replace", real)
    # The fold or the batch is written, but nobody reads it.
    assert "fold-2" in children(spark, f"{folder}/t/rows")
    again = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=4, fold_after=3)
    assert told(again.current(spark)) == sorted(expected(batches[:3], True).values(), key=repr)
    again.upsert(frame(spark, *batches[3]), 3)
    again.upsert(frame(spark, *batches[4]), 4)
    assert told(again.current(spark)) == sorted(expected(batches, True).values(), key=repr)


def test_vacuum_keeps_what_is_valid(spark, folder):
    batches = unique_versions(random_batches(4, 10))
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=4, fold_after=2)
    for n, batch in enumerate(batches):
        table.upsert(frame(spark, *batch), n)
    before = told(table.current(spark))
    assert table.vacuum(spark) > 0
    assert told(table.current(spark)) == before
    assert table.vacuum(spark) == 0
    assert len(children(spark, f"{folder}/t/rows")) <= 4 + 3


def test_state_before_a_batch_and_its_changes(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=2, fold_after=1)
    table.upsert(frame(spark, ("a", 1, "x"), (None, 1, "n")), 0)
    batch = frame(spark, ("a", 3, "y"), ("a", 2, "old"), ("b", 1, "z"), (None, 0, "late"))
    want = [("a", ("a", 1, "x"), ("a", 3, "y")), ("b", None, ("b", 1, "z"))]
    for _ in range(2):
        found = [(r.k, r.old and tuple(r.old), tuple(r.new)) for r in table.changes(batch, 1).collect()]
        assert sorted(found) == want
        assert told(table.before(spark, 1)) == sorted([("a", 1, "x"), (None, 1, "n")], key=repr)
        table.upsert(batch, 1)


def test_empty(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], fold_after=1)
    assert told(table.current(spark)) == told(table.lookup(spark, "a")) == []
    for n in range(3):
        table.upsert(frame(spark), n)
    assert told(table.current(spark)) == []


def test_key_types_and_other_column_names(spark, folder):
    schema = "`a b` decimal(9,2), place__ smallint, bucket double"
    rows = spark.createDataFrame([(1, 2, 3.0), (1, 2, 4.0), (2, 2, 5.0)], "`a b` int, place__ int, bucket double")
    table = KeyedTable(f"{folder}/t", schema, ["a b", "place__"], ["bucket"], buckets=5, fold_after=1)
    for n in range(3):
        table.upsert(rows, n)
    assert sorted((float(r[0]), r[1], r[2]) for r in table.current(spark).collect()) == [(1, 2, 4.0), (2, 2, 5.0)]
    assert table.lookup(spark, __import__("decimal").Decimal("1.00"), 2).count() == 1


# --- sums over a keyed table --------------------------------------------------

AMOUNTS = "id bigint, version bigint, account string, amount bigint"


def totals_of(held):
    out = {}
    for _, _, account, amount in held.values():
        out[account] = out.get(account, 0) + (amount or 0)
    return sorted(out.items(), key=repr)


def amounts(seed, batches=7):
    rng = random.Random(seed)
    return [
        [
            (rng.randrange(15), n * 10 + i, rng.choice([None, "a", "b", f"c{rng.randrange(9)}"]), rng.choice([None, rng.randrange(-50, 99)]))
            for i in range(8)
        ]
        for n in range(batches)
    ]


def totals_table(folder):
    table = KeyedTable(f"{folder}/t", AMOUNTS, ["id"], ["version"], buckets=3, fold_after=2)
    return RunningTotals(table, f"{folder}/sums", "account", "amount", "string")


def test_totals_after_each_batch(spark, folder):
    totals, held = totals_table(folder), {}
    for n, batch in enumerate(amounts(5)):
        totals.upsert(spark.createDataFrame(batch, AMOUNTS), n)
        for row in batch:
            if row[0] not in held or row[1] >= held[row[0]][1]:
                held[row[0]] = row
        assert told(totals.current(spark)) == totals_of(held)


@pytest.mark.parametrize("dies_at", [1, 2])
def test_totals_of_a_batch_that_died_halfway(spark, folder, monkeypatch, dies_at):
    totals, held = totals_table(folder), {}
    real, calls = KeyedTable.upsert, []

    def upsert(self, batch, batch_id):
        calls.append(batch_id)
        real(self, batch, batch_id)
        if batch_id == 3 and calls.count(3) == dies_at:
            raise Died

    monkeypatch.setattr(KeyedTable, "upsert", upsert)
    for n, batch in enumerate(amounts(6, 5)):
        frame = spark.createDataFrame(batch, AMOUNTS)
        if n == 3:
            with pytest.raises(Died):
                totals.upsert(frame, n)
        totals.upsert(frame, n)
        for row in batch:
            if row[0] not in held or row[1] >= held[row[0]][1]:
                held[row[0]] = row
        assert told(totals.current(spark)) == totals_of(held)


def test_a_refresh_reads_the_touched_buckets_only(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, ["k"], ["v"], buckets=40, fold_after=1)
    for n in range(3):
        table.upsert(frame(spark, *[(str(k), n, "x") for k in range(200)]), n)
    touched = table.before(spark, 3, frame(spark, ("5", 9, "y"), ("6", 9, "y")))
    assert len({name.rpartition("/")[0].rpartition("=")[2] for name in touched.inputFiles()}) <= 2
    assert ("5", 2, "x") in told(touched)
