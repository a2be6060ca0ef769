import random
import tempfile

import numpy as np
import pytest

from docgeo.llm import linededup as L
from docgeo.llm import queries


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutated(rnd, s, k):
    s = list(s)
    for _ in range(k):
        i = rnd.randrange(len(s) + 1)
        rnd.choice([lambda: s.insert(i, rnd.choice("abé")), lambda: s[i : i + 1] and s.pop(i), lambda: s.__setitem__(slice(i, i + 1), rnd.choice("abé"))])()
    return "".join(s)


@pytest.mark.parametrize("edits", [1, 2, 3, 4])
def test_banded_distance(edits):
    rnd = random.Random(edits)
    a = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(0, 30))) for _ in range(800)]
    b = [mutated(rnd, x, rnd.randrange(0, edits + 3)) for x in a]
    assert L.within_edits(a, b, edits).tolist() == [distance(x, y) <= edits for x, y in zip(a, b, strict=True)]
    for x, y in zip(a, b, strict=True):
        assert distance(*L.trimmed(x, y)) == distance(x, y)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_a_segment_or_probe_meets(edits):
    rnd = random.Random(edits)
    for _ in range(400):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randrange(edits + 1, 20)))
        b = mutated(rnd, a, rnd.randrange(0, edits + 1))
        if len(b) <= edits or distance(a, b) > edits:
            continue
        keys = [{(a_or_b[s:e], seed, probe) for s, e, seed, probe in L.plan(len(a_or_b), edits)} for a_or_b in (a, b)]
        assert any(x[:2] == y[:2] and 0 in (x[2], y[2]) for x in keys[0] for y in keys[1]), (a, b)


def brute(docs, edits, least, fewer=()):
    """``fewer``: as in line_classes, and lines with other than white space below all of those by equality."""
    lines = [(d, i, x) for d, t in docs if d is not None and t is not None for i, x in enumerate(t.split("\n")) if len(x) >= least or (fewer and x.strip(" \t\n\x0b\x0c\r"))]
    allowed = lambda n: next((e for chars, e in ((least, edits), *fewer) if n >= chars), 0)
    texts = sorted({x for _, _, x in lines})
    label = {x: x for x in texts}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[:i]:
            most = allowed(min(len(a), len(b)))
            if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                label[root(a)] = root(b)
    first = {}
    for d, i, x in sorted(lines):
        first.setdefault(root(x), (d, i))
    return sorted((d, i, *first[root(x)], (d, i) == first[root(x)]) for d, i, x in lines)


@pytest.mark.parametrize(("edits", "cell"), [(1, 256), (2, 256), (1, 4), (2, 4), (2, 2)])
def test_classes_against_brute_force(spark, monkeypatch, edits, cell):
    monkeypatch.setattr(L, "CELL", cell)  # 4: nearly all segments are crowded ones
    monkeypatch.setattr(L, "BLOCK_BYTES", 500)
    rnd = random.Random(3)
    lines = []
    for _ in range(60):
        base = "".join(rnd.choice("ab") for _ in range(rnd.randrange(6, 14)))
        lines += [base, *(mutated(rnd, base, rnd.randrange(0, 4)) for _ in range(3))]
    docs = [(i, "\n".join(lines[i * 6 : i * 6 + 6])) for i in range(40)]
    got = L.line_classes(spark.createDataFrame(docs, "doc_id long, text string"), edits, 5).collect()
    assert sorted(tuple(r) for r in got) == brute(docs, edits, 5)


def test_lines_are_removed(spark, odd_docs, no_docs):
    out = L.drop_duplicate_lines(odd_docs)
    assert out.columns == odd_docs.columns
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert {d for d, _ in texts} == {1, 2, 3, 4, 6, 7, 8, 9, None}  # 5 repeats 4 and holds nothing else
    assert (8, "Zwölf Boxkämpfer jagen Viktor quer über den Sylter Deich") in texts  # its other line is an edit away from 4's
    assert (None, "a row without a key but with the usual words in it") in texts
    assert out.filter("doc_id = 4").count() == 2
    assert L.drop_duplicate_lines(no_docs).collect() == []
    assert L.line_classes(no_docs).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    short = [(d, "\n".join(x for x in t.split("\n") if len(x) < 60)) for d, t in rows]
    got = L.line_classes(spark.createDataFrame(short, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == brute(short, 2, 16)


def test_short_lines_are_classed_by_equality(spark):
    docs = spark.createDataFrame([(1, "Home\n \t\nContact us\nHome"), (2, "Homer\n\nHome\na line of many more characters"), (3, "Contact us\na line of many more charakters")], "doc_id long, text string")
    got = sorted(tuple(r) for r in L.line_classes(docs, short=True).collect())
    assert got == [(1, 0, 1, 0, True), (1, 2, 1, 2, True), (1, 3, 1, 0, False), (2, 0, 2, 0, True), (2, 2, 1, 0, False), (2, 3, 2, 3, True), (3, 0, 1, 2, False), (3, 1, 2, 3, False)]


def test_short_lines_are_joined_with_fewer_edits(spark):
    rnd = random.Random(11)
    lines = []
    for _ in range(80):
        base = "".join(rnd.choice("abcd ") for _ in range(rnd.randrange(1, 19)))
        lines += [base, *(mutated(rnd, base, rnd.randrange(0, 3)) for _ in range(3))]
    docs = [(i, "\n".join(lines[i * 8 : i * 8 + 8])) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for fewer in (((8, 1),), ((9, 2), (5, 1))):
        edits = fewer[0][1] + 1
        got = L.line_classes(df, edits, 14, short=True, fewer=fewer).collect()
        assert sorted(tuple(r) for r in got) == brute(docs, edits, 14, fewer)
    with pytest.raises(ValueError):
        L.line_classes(df, 2, 16, short=True, fewer=((1, 1),))


def test_query_over_all_lines(spark):
    """The registered query on a table of all shorter lines of the documents, of every length from 1 on."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], "\n".join(x for x in (r["text"] or "").split("\n") if len(x) < 50)) for r in docs.collect()]
    path = tempfile.mkdtemp(prefix="lines-")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    got = queries.QUERIES["op10_line_dedup"](spark, path).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2, 16, ((8, 1),))


def crowd(n, seed):
    """Distinct lines that share their first third, and otherwise words at random; some pairs an edit or two apart."""
    rnd = random.Random(seed)
    tail = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(40))
    lines = ["all of these begin a " + tail() for _ in range(n)]
    return lines + [x[:21] + mutated(rnd, x[21:], 2) for x in lines[: n // 10]]


def test_a_crowded_segment_makes_few_rows(spark, monkeypatch):
    """Rows to be compared grow with the lines that share a segment, not with their square."""
    made = {}

    def counted(rows, key, item, limit, name, f=L.cells):
        out = f(rows, key, item, limit, name)
        if name == "lines-crowded":
            made[n] = out.count()
        return out

    monkeypatch.setattr(L, "cells", counted)
    for n in (3000, 12000):
        lines = crowd(n, n)
        docs = spark.createDataFrame([(i, "\n".join(lines[i::50])) for i in range(50)], "doc_id long, text string")
        out = L.line_classes(docs).collect()
        assert sum(not r["kept"] for r in out) >= n // 10 - 1
    assert made[12000] < 5 * made[3000] and made[12000] < 20 * 12000


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_pairs_under_a_crowded_segment_meet_again(edits):
    """Without Spark: two lines that meet under a key and are within the edits meet under a finer key too."""
    rnd = random.Random(edits)
    met = 0
    for _ in range(300):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randrange(3 * edits + 6, 40)))
        b = mutated(rnd, a, rnd.randrange(0, edits + 1))
        if len(b) <= edits or distance(a, b) > edits:
            continue
        rows = []
        for line, text in enumerate((a, b)):
            for s, e, seed, probe in L.plan(len(text), edits):
                rows.append((L.xxhash.xxh64_intdigest(text[s:e], seed), line, text, probe))
        rows = [(k - (k >> 63 << 64), line, t, p) for k, line, t, p in sorted(set(rows))]
        batch = L.pa.RecordBatch.from_arrays([L.pa.array(c) for c in zip(*rows)], names=["key", "line", "text", "probe"])
        fine = [r for out in L._finer(edits)([batch]) for r in zip(*(c.to_pylist() for c in out.columns))]
        groups = {}
        for key, finer, line, probe in fine:
            groups.setdefault((key, finer), set()).add((line, probe))
        met += 1
        assert any({x for x, _ in g} == {0, 1} and any(p == 0 for _, p in g) for g in groups.values()), (a, b)
    assert met > 100


def test_array_positions():
    assert np.array_equal([s for s, _ in L.segments(11, 2)], [0, 3, 7])
