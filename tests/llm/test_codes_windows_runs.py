"""Vector codes, word-window dedup and periodic runs against brute force, odd rows included."""

import hashlib
import re
import uuid
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tradelane.llm import periodic_runs, vector_codes, window_dedup
from tradelane.llm.queries import ORACLE

VECTORS = "vec_id long, embedding array<float>, label int, id long, code string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, _0 string, starts string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- vector codes


def vectors(n, width=16, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, width)) * rng.choice([0.01, 1.0], (n, 1))).astype(np.float32)


def brute_codes(rows):
    """Lloyd's rounds with every entry measured; ``rows``: (id, integer vector)."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(rows[0][1]) // 8
    parts = [[tuple(v[p * w : p * w + w]) for p in range(8)] for _, v in rows]
    books = [[parts[i][p] for i in range(min(16, len(rows)))] for p in range(8)]

    def nearest(p, x):
        far = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return min(far), far.index(min(far))

    for _ in range(6):
        for p in range(8):
            own = {}
            for row in parts:
                own.setdefault(nearest(p, row[p])[1], []).append(row[p])
            for e, xs in own.items():
                books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs))
    out = []
    for (i, _), row in zip(rows, parts):
        best = [nearest(p, row[p]) for p in range(8)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    return out, sha(",".join(str(c) for p in books for e in p for c in e))


def whole(v):
    return [int(np.floor(float(x) * 4096)) for x in v]


@pytest.mark.parametrize("n", [300, 5, 1])
def test_codes_equal_brute_force(spark, tmp_path, n):
    v = vectors(n)
    rows = [(i * 3, x.tolist(), i % 4 or None, 7, "x") for i, x in enumerate(v)]
    rows += [(0, v[0].tolist(), 9, 7, "x"), (0, v[0].tolist(), 9, 7, "x"), (None, v[-1].tolist(), None, 7, "x")]  # ties, null id
    rows += [(1, None, 1, 7, "x"), (2, [None] * 16, 1, 7, "x"), (4, [float("nan")] * 16, 1, 7, "x"), (5, [float("inf")] * 16, 1, 7, "x")]
    rows += [(7, [], 1, 7, "x"), (8, [1.0] * 8, 1, 7, "x")]
    spark.createDataFrame(rows, VECTORS).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = vector_codes.op11_vector_codes(spark, str(tmp_path)).collect()
    good = [(r[0], whole(r[1])) for r in rows if r[1] and len(r[1]) == 16 and all(x is not None and np.isfinite(x) for x in r[1])]
    want, digest = brute_codes(good)
    assert sorted(map(str, [(r.vec_id, r.code, r.error) for r in got])) == sorted(map(str, want))
    assert {r.codebooks_sha256 for r in got} == {digest}
    label = {(r[0]): r[2] for r in rows}
    totals = Counter()
    for i, _, e in want:
        totals[label[i] if i != 0 else None] += e if i != 0 else 0
    if n > 1:
        one = next(r for r in got if r.vec_id == 3)
        assert one.label_error == sum(r.error for r in got if r.vec_id is not None and r.vec_id % 3 == 0 and r.vec_id and label[r.vec_id] == 1)


def test_orchard_meets_ties_and_measures_less():
    rng = np.random.default_rng(4)
    books = rng.integers(-3, 4, (8, 16, 2))
    rows = rng.integers(-4, 5, (500, 16))
    code, far = vector_codes.Orchard(books)(rows)
    every = np.square(rows.reshape(500, 8, 1, 2) - books).sum(axis=-1)
    assert (far == every.min(axis=-1)).all() and (code == every.argmin(axis=-1)).all()


def test_codes_round_trip_and_parameters(spark):
    rows = [(i, x.tolist(), 1, 0, "") for i, x in enumerate(vectors(60, 8))]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("vec_id as id", "label", "embedding as v")
    books = vector_codes.codebooks(frame, 8, parts=4, entries=3, rounds=2)
    out = vector_codes.decode(vector_codes.encode(frame, books), books).collect()
    assert books.shape == (4, 3, 2)
    for r in out:
        gap = np.array(whole(rows[r.id][1])) - np.array(r.approximation)
        assert (gap**2).sum() == r.error
    with pytest.raises(ValueError):
        vector_codes.codebooks(frame, 8, parts=3)
    huge = spark.createDataFrame([(1, [1e30] * 8, 1, 0, "")], VECTORS)
    with pytest.raises(Exception, match="do not fit"):
        vector_codes.compress(huge).collect()


def test_codes_of_nothing(spark):
    assert vector_codes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1, 0, "")], VECTORS)).count() == 0


# --- word windows


def texts():
    rng = np.random.default_rng(8)
    name = lambda k, n: " ".join(f"w{x}" for x in rng.integers(0, k, n))
    passage, base = name(500, 60), name(400, 200)
    out = [None, "", " \n\t", "one two", base, base, base + " tail", base.replace("w7 ", "w8 "), name(3, 900), "é " * 90]
    out += [name(1000, 20) + " " + passage + "\n" + name(1000, 30) for _ in range(5)]
    out += [name(900, 40) + " " + " ".join(passage.split()[:35]), name(900, 40) + " " + " ".join(passage.split()[:34])]
    out += [name(2000, 6000), "a b " * 17 + "a", "a b " * 17 + "a b", "x" * 30_000 + " y", " ".join(["same"] * 35)]
    return out


def frame(spark, some):
    rows = [(i * 2 if i % 7 else None if i % 2 else 4, t, "en", "s", len(t or ""), "k", "z", "s") for i, t in enumerate(some)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def brute_windows(some, window=35):
    split = [words_of(t) for t in some]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = np.zeros(len(w), dtype=bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        out.append([x for x, g in zip(w, gone) if not g])
    return split, out


@pytest.mark.parametrize("window", [35, 8])
def test_windows_equal_brute_force(spark, window):
    some = texts()
    rows = frame(spark, some)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in window_dedup.report(rows, window).collect())
    split, kept = brute_windows(some, window)
    ids = [i * 2 if i % 7 else None if i % 2 else 4 for i in range(len(some))]
    assert got == Counter((i, len(w), len(w) - len(k), sha(" ".join(k))) for i, w, k in zip(ids, split, kept))


def test_windows_cleaned_texts_keep_columns(spark):
    some = texts()
    rows = frame(spark, some)
    out = window_dedup.clean(rows)
    split, kept = brute_windows(some)
    want = Counter(t if len(w) == len(k) else " ".join(k) for t, w, k in zip(some, split, kept))
    got = out.collect()
    assert out.schema == rows.schema and Counter(r.text for r in got) == want
    assert all(r.n_chars == len(r.text or "") and r.key == "k" for r in got)
    assert window_dedup.clean(rows.limit(0)).count() == 0 and window_dedup.report(rows.limit(0)).count() == 0


def test_windows_of_a_full_sketch_are_the_same(spark, monkeypatch):
    """With 64 cells everything is estimated as repeated; the exact pass still decides."""
    rows = frame(spark, texts())
    want = Counter(map(tuple, window_dedup.report(rows).collect()))
    monkeypatch.setattr(window_dedup, "MIN_CELLS", 64)
    monkeypatch.setattr(window_dedup, "MAX_CELLS", 64)
    assert Counter(map(tuple, window_dedup.report(rows).collect())) == want


def test_windows_texts_reach_python_once_and_in_small_batches(spark, tmp_path, monkeypatch):
    """One partition of 6 MB: Spark's batches of 10,000 rows held it whole, the cut held it twice."""
    words = np.random.default_rng(5).integers(0, 10**6, (3000, 300)).astype(str)
    words[1000:1100, :50] = words[:100, 200:250]
    some = [" ".join(w) for w in words.tolist()]
    spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    sizes, plain = tmp_path / "sizes", window_dedup.arrow_map
    sizes.mkdir()

    def spied(df, make, schema):
        def made():
            step = make()

            def noted(batch):
                (sizes / f"{uuid.uuid4().hex}-{batch.nbytes}").touch()
                return step(batch)

            return noted

        return plain(df, made, schema)

    monkeypatch.setattr(window_dedup, "arrow_map", spied)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    got = {r.doc_id: (r.n_words, r.n_removed) for r in window_dedup.report(spark.read.parquet(f"{tmp_path}/docs")).collect()}
    assert got == {i: (300, 50 if i < 100 or 1000 <= i < 1100 else 0) for i in range(3000)}
    found = [int(p.name.split("-")[1]) for p in sizes.iterdir()]
    assert max(found) < window_dedup.SLICE + 10_000 and spark.conf.get(key, None) == before
    assert sum(found) < 6 * sum(map(len, some))  # the texts are read five times, by the cut with its other columns


def test_sketch_overestimates(spark):
    some = [t.encode() for t in texts() if t]
    rows = spark.createDataFrame([(t,) for t in some], "text binary")
    bits = window_dedup.sketch(rows, 1 << 12)
    windows = window_dedup.Windows()
    windows.load(some)
    anchor, start, n, _ = windows.phrases()
    count = Counter(anchor.tolist())
    estimated = window_dedup.estimated_repeated(bits, anchor)
    assert all(e for a, e in zip(anchor.tolist(), estimated) if count[a] > 1)
    assert not estimated.all()
    assert n.sum() == sum(max(0, len(t.split()) - 34) for t in some)


# --- periodic runs


def brute_runs(w, shortest=12):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n, part = j - i + q, w[i : j + q]
            if j > i and n >= max(shortest, 2 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = np.random.default_rng(9)
    for trial in range(400):
        w = rng.integers(0, rng.integers(1, 5), rng.integers(0, 60))
        if trial % 2:
            part = rng.integers(0, 6, rng.integers(1, 25))
            w = np.concatenate([w, np.tile(part, 4)[: rng.integers(1, 4 * len(part) + 1)], rng.integers(0, 6, 9), part])
        assert periodic_runs.runs_of(w, 2) == brute_runs(w.tolist(), 2)
        text = [str(x).encode() for x in w]
        assert periodic_runs.runs_in([[b"1"] * 7, text, [b"0"] * 11]) == [[], brute_runs(text), []]


def test_stretches_leave_prose_alone():
    rng = np.random.default_rng(10)
    line = [f"w{x}".encode() for x in rng.integers(0, 300, 40)]
    other = [f"w{x}".encode() for x in rng.integers(0, 300, 90)]
    word, owner = periodic_runs._numbers([line + other + line, other])
    assert periodic_runs.stretches(word, owner) == []  # repeated, but not next to each other
    word, owner = periodic_runs._numbers([other + line + line])
    assert periodic_runs.stretches(word, owner)[0][0] <= 90


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_periodic_runs_query(spark, tmp_path):
    rng = np.random.default_rng(11)
    some = [None, "", " \t", "a " * 11, "a " * 12, "a b " * 8 + "é " * 14, "x" * 40_000]
    some += [" ".join(f"w{x}" for x in rng.integers(0, k, 300)) for k in [3, 50, 400] * 40]
    some += ["go on " * 9000, "go on " * 9000]
    ids = [None, None, *range(2, len(some))]
    rows = [(i, t, "en", "s", len(t or ""), "k", "z", "s") for i, t in zip(ids, some)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in periodic_runs.op13_periodic_runs(spark, str(tmp_path)).collect())
    want = Counter()
    changed = 0
    for i, t in zip(ids, some):
        w = altered(i, words_of(t))
        changed += w != words_of(t)
        runs = [(0, len(w), 2)] if len(w) > 9000 and w[0] == w[2] else brute_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[(i, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))] += 1
    assert got == want and changed > 5
    out = periodic_runs.collapse(docs)
    assert out.schema == docs.schema and out.count() == len(some)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[4] == "a" and texts[5] == "a b é" and texts[6] == some[6]
    assert periodic_runs.collapse(docs.limit(0)).count() == 0
    assert periodic_runs.report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_window_dedup"])
def test_sql_of_odd_rows(spark, tmp_path, name):
    rows = [(i, x.tolist(), i % 3, 0, "") for i, x in enumerate(vectors(40, 8))] + [(90, None, 1, 0, ""), (91, [None] * 8, 1, 0, "")]
    spark.createDataFrame(rows, VECTORS).select("vec_id", "embedding", "label").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    frame(spark, texts()).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    query = {"op11_vector_codes": vector_codes.op11_vector_codes, "op12_window_dedup": window_dedup.op12_window_dedup}[name]
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = Counter(map(str, con.execute(ORACLE[name]).fetchall()))
    assert Counter(str(tuple(r)) for r in query(spark, str(tmp_path)).collect()) == want
