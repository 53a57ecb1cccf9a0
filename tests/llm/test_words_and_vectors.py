"""Spelling variants, vector links and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelframe.llm import grid_join, periodic, spelling

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


# Periodic runs


def _plain_runs(words, exponent=4, least=6):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, exponent * q):
                found.setdefault((i, n), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def _words(rng, n, k):
    w = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_catchers_in_any_portions(seed):
    rng = random.Random(seed)
    for _ in range(150):
        docs = [_words(rng, rng.choice([0, 1, 3, 8, 20, 60, 150]), rng.choice([1, 2, 3, 10])) for _ in range(rng.randint(1, 4))]
        sizes = np.array([len(d) for d in docs])
        starts = np.cumsum(sizes) - sizes
        flat, first = np.array([x for d in docs for x in d], np.int64), np.repeat(starts, sizes)
        whole, online = periodic.Catchers(), periodic.Catchers()
        hits, i = whole.append(flat, first), 0
        while i < len(flat):
            m = rng.randint(1, 5)
            hits -= online.append(flat[i : i + m], first[i : i + m])
            i += m
        want = [(s + a, n, q) for a, d in zip(starts.tolist(), docs) for s, n, q in _plain_runs(d)]
        assert [tuple(r) for r in whole.runs().tolist()] == want == [tuple(r) for r in online.runs().tolist()]
        assert hits == 0


def _planted(doc_id, text):
    words = SPACE.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def _op13_row(doc_id, text):
    words = _planted(doc_id, text)
    runs = _plain_runs(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_op13_on_whole_documents(spark, tmp_path):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "a", "one " * 7, "a b " * 6 + "c d", "x\x1cy " * 9, "w " * 30000]
    for _ in range(150):
        w = _words(rng, rng.randint(1, 120), 4)
        texts.append(rng.choice([" ", "\n", " \x0b "]).join("αbcd"[x] for x in w))
    rows = [(i, t) for i, t in enumerate(texts)] + [(9, texts[9]), (9, "other " * 8)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).withColumn("_text", F.lit(0)).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in periodic.op13_periodic_runs(spark, str(tmp_path)).collect()]
    order = lambda r: (r[0], r[6], r[7])
    want = [_op13_row(d, t if t is None or len(t) < 50000 else t) for d, t in rows if t is None or len(t) < 50000]
    assert sorted((r for r in got if r[0] != 7), key=order) == sorted(want, key=order)
    long = [r for r in got if r[0] == 7]
    assert len(long) == 1 and (zlib.crc32(b"7") % 10 == 0 or long[0][1:6] == (1, 0, 30000, 1, 30000000))


def test_periodic_runs_defined_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.periodic_runs(empty).collect() == []
    rows = spark.createDataFrame([(None, "a b a b a b a b a"), (None, None)], "doc_id string, text string")
    got = {r.n_words: r for r in periodic.periodic_runs(rows).collect()}
    assert got[9].runs[0].asDict() == {"start": 0, "length": 9, "period": 2} and got[9].collapsed == "a b"
    assert got[0].runs == [] and got[0].collapsed == ""
    with pytest.raises(ValueError):
        periodic.Catchers(2)


# Spelling variants


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _plain_variants(counts):
    near = {w: [v for v in counts if _near(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def test_variants_of_words(spark):
    rng = random.Random(3)
    words = {"a" * k for k in range(2, 11)} | {"x" * 3000, "x" * 1500 + "y" + "x" * 1499, "x" * 2999}
    for _ in range(40):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(2, 12)))
        words.add(w)
        for _ in range(5):
            i, c = rng.randrange(len(w) + 1), rng.choice("abéz")
            words.add(rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]]))
    counts = {w: rng.choice([2, 3, 30, 40, 500, 6000]) for w in sorted(words) if len(w) > 1}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(table).collect()}
    assert got == _plain_variants(counts)


def test_op11_on_whole_documents(spark, tmp_path):
    rng = random.Random(8)
    stems = ["".join(rng.choice("abcÀÿ") for _ in range(rng.randint(6, 10))) for _ in range(25)]
    texts = [None, "", "123 _ ž", "Abcdefgh×÷ABCDEFGH"]
    texts += [rng.choice([" ", "-", "ž"]).join(rng.choice(stems[: rng.choice([3, 25])]).upper() if rng.random() < 0.1 else rng.choice(stems) for _ in range(200)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(5, texts[5])]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    want = _plain_variants(counts)
    assert any(v[0] for v in want.values())
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.op11_spelling_variants(spark, str(tmp_path)).collect()}
    assert got == want


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).collect() == []
    docs = spark.createDataFrame([(None, "Wordless wordless")], "doc_id long, text string")
    assert [tuple(r) for r in spelling.vocabulary(docs).collect()] == [("wordless", 2)]


# Vector links


def _plain_links(rows, cosine=0.98):
    able = [l is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, l in rows]
    unit = [np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) if ok else None for (_, v, _), ok in zip(rows, able)]
    groups, links, parent = {}, [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, ok in enumerate(able):
        if ok:
            groups.setdefault((rows[i][2], len(unit[i])), []).append(i)
    for members in groups.values():
        hit = np.array([unit[i] for i in members])
        hit = hit @ hit.T >= cosine
        for a, b in zip(*np.nonzero(hit)):
            if a != b:
                links[members[a]] += 1
                parent[find(members[a])] = find(members[b])
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, links[i], least.get(find(i)), d is not None and d == least[find(i)]) for i, (d, _, _) in enumerate(rows)]
    return sorted(out, key=str)


@pytest.mark.parametrize("interval", [16, 512])
def test_links_and_components(spark, interval):
    rng = np.random.default_rng(1)
    centres, rows = rng.normal(size=(40, 16)), []
    for i in range(500):
        v = centres[rng.integers(40)] + rng.normal(size=16) * rng.choice([0, 0.05, 0.12, 0.2, 0.5])
        rows.append((i, np.float32(v * rng.choice([1, 2.5])).tolist(), int(rng.integers(3))))
    rows += [(i, rows[5][1], rows[5][2]) for i in range(500, 750)]  # a third of all rows
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [1.0, None], 1), (2003, [float("nan")] + [1.0] * 15, 1), (2004, [], 1)]
    rows += [(2005, [1.0, 0.0], 1), (2006, [2.0, -0.0], 1), (2007, [1.0, 0.0], None), (2008, [1.0, -0.0], 1), (2009, [3e38, 0.0], 1)]
    rows += [(None, rows[3][1], rows[3][2]), (7, rows[8][1], rows[8][2]), (2010, None, None), (None, None, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table = table.withColumn("node", F.lit("clash")).withColumn("key", F.lit(0)).withColumn("n", F.lit(0))
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in grid_join.near_vectors(table, interval=interval).collect()), key=str)
    assert got == _plain_links(rows)


def test_no_vectors(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert grid_join.near_vectors(table).collect() == []


def test_distant_intervals_are_skipped(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (np.eye(8)[i % 8] + 0.01 * rng.normal(size=8)).astype(np.float32).tolist(), 1) for i in range(512)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    size, axes = grid_join.principal_axes(table)
    assert size == 8 and np.allclose(axes.T @ axes, np.eye(axes.shape[1]))
    got = grid_join.near_vectors(table, interval=64).collect()
    assert {r.component_id for r in got} == set(range(8)) and all(r.n_links == 63 for r in got)


def test_op12_on_the_given_table(spark, sf_dir):
    rows = [(r.vec_id, None if r.embedding is None else list(r.embedding), r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in grid_join.op12_embedding_near_duplicates(spark, sf_dir).collect()), key=str)
    assert got == _plain_links(rows)


def test_op12_sql_on_vectors_with_links(tmp_path):
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(6)
    centres, rows = rng.normal(size=(12, 8)), []
    for i in range(160):
        v = centres[rng.integers(12)] + rng.normal(size=8) * rng.choice([0, 0.05, 0.12, 0.3])
        rows.append((i, np.float32(v).tolist(), int(rng.integers(3))))
    rows += [(i, rows[5][1], rows[5][2]) for i in range(160, 200)]
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [1.0, None], 1), (203, [float("nan")] * 8, 1), (204, [1.0, 0.0], 1), (205, [2.0, 0.0], 1), (206, [1.0, 0.0], None)]
    ids, vectors, labels = zip(*rows)
    table = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array(labels, pa.int32())})
    pq.write_table(table, tmp_path / "e.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{tmp_path}/e.parquet')")
    got = sorted(con.execute(grid_join.OP12_SQL).fetchall(), key=str)
    assert got == _plain_links(rows) and sum(r[1] for r in got) > 500
