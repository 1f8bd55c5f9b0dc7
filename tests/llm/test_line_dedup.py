"""Line dedup against a plain version."""

import random

import duckdb
import pytest

from trackline.llm import line_dedup

BLANKS = " \t\n\v\f\r"
LONG = [f"A line that is long enough, number {n}" for n in range(12)]


def plain(rows, least=20, enough=3):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            own = holders.get(key(line), ())
            last = max((d for d in own if d is not None), default=None)
            if len(own) < enough or doc == last:
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def documents(seed, n):
    rng = random.Random(seed)
    rows = []
    for doc in range(n):
        lines = [rng.choice(LONG[: rng.randint(1, 12)]) for _ in range(rng.randint(0, 6))]
        lines = [rng.choice([x, x.upper(), "\t" + x + " \r", "short", "", x + "É"]) for x in lines]
        rows.append((doc * 3 - 20, "\n".join(lines)))
    return rows


@pytest.mark.parametrize(("batches", "fan_in"), [(1, 2), (4, 2), (7, 3)])
def test_against_plain(spark, batches, fan_in):
    rows = documents(1, 80) + [(None, LONG[0]), (None, None), (500, LONG[1]), (500, LONG[1] + "\n" + LONG[2]), (501, "")]
    docs = spark.createDataFrame([(k, t, 5, "x") for k, t in rows], "doc_id long, text string, hash int, kept string")
    got = line_dedup.dedupe_lines(docs, batches=batches, fan_in=fan_in)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_nothing(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert line_dedup.dedupe_lines(docs.limit(0)).collect() == []
    assert [tuple(r) for r in line_dedup.dedupe_lines(docs).collect()] == [(1, 1, 0, "x")]


def test_carried_columns(spark):
    docs = spark.createDataFrame([(1, "x", 3.5, "k")], "doc_id long, text string, n_lines double, key string")
    row = line_dedup.dedupe_lines(docs, carry=["n_lines", "key", "doc_id"]).first()
    assert row.carried.n_lines == 3.5 and row.carried.key == "k" and row.carried.doc_id == 1 and row.n_lines == 1


def test_runs_are_compacted_and_settled_lines_not_added(spark):
    runs = line_dedup.Runs(enough=2, fan_in=2)
    added = []
    for batch in ([(b"a", 9), (b"a", 8)], [(b"a", 7), (b"b", 6)], [(b"b", 5)]):
        runs.add(spark.createDataFrame(batch, "hash binary, key long"))
        added.append([sum(1 for _ in run.collect()) for run in runs.all()])
    assert added == [[1], [2], [1, 2]]  # the second batch's a is settled; the first two runs become one
    assert sorted((bytes(h), k) for h, k in runs.shared().collect()) == [(b"a", 9), (b"b", 6)]


def test_sql(spark):
    """Unique, known keys: there the SQL has to agree."""
    import hashlib

    rows = documents(2, 60) + [(900, None)]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in plain(rows)]
    assert sorted(db.execute(line_dedup.sql()).fetchall()) == sorted(want)
