"""The training-data operators against brute force on small tables, odd rows included."""

import hashlib
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradelane.llm import (
    chat_format,
    fingerprints,
    minhash_dedup,
    packing,
    quality_classifier,
    quality_rules,
    sentencepiece_viterbi,
    suffix_dedup,
    url_filter,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string"
rng = np.random.default_rng(5)
WORD = ["alpha", "beta", "Gamma,", "delta.", "über", "été", "x", "quick", "brown", "fox", "lazy", "dog."]
LONG = " ".join(rng.choice(WORD, 4000))
PASSAGE = " ".join(rng.choice(WORD, 60))


def texts():
    base = " ".join(rng.choice(WORD, 200))
    out = [None, "", " \n\t", "one two", base, base, base + " tail", base.replace("fox", "cat", 2), LONG, LONG[500:9000]]
    out += [" ".join(rng.choice(WORD, 40)) + " " + PASSAGE + " " + " ".join(rng.choice(WORD, 30)) for _ in range(6)]
    out += ["a" * 400, "ab" * 300, "$$$ ### " * 60, "NAV | " * 50, "é" * 130, "€uro " * 60]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, "en", "s", len(t or ""), "clash") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("llm"))
    docs.drop("doc").write.parquet(f"{d}/documents.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], SCHEMA).drop("doc").write.parquet(f"{d}/documents.parquet")
    return d


def test_suffix_dedup(spark, folder, docs):
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op2_suffix_array_dedup(spark, folder).collect()}
    seen = set()
    for r in docs.orderBy("doc_id").collect():
        b = (r.text or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - 99):
            s = b[p : p + 100]
            if s in seen:
                gone[p : p + 100] = True
            seen.add(s)
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        assert got[r.doc_id] == (len(b), gone.sum(), (edge == 1).sum(), hashlib.sha256(kept).hexdigest())


def test_suffix_dedup_tells_rows_of_one_id_apart(spark, tmp_path):
    """Null ids and repeated ids: each row is cut by its own spans, and one of equal texts stays."""
    one, two = (" ".join(f"{w}{i}" for i in range(150)) for w in ("kilo", "lima"))
    b = two[:500] + one[:200] + two[500:]
    late = {None: "".join(f"mike{i} " for i in range(100)), 5: "".join(f"november{i} " for i in range(100))}
    rows = [(None, one), (None, b), (None, late[None]), (5, late[5]), (5, late[5]), (5, "short"), (5, "short"), (7, late[None])]
    schema = "doc_id long, text string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.op2_suffix_array_dedup(spark, str(tmp_path)).collect()]
    kept = sorted((r.doc_id, r.text) for r in suffix_dedup.clean(spark.createDataFrame(rows, schema).repartition(3)).collect() if r.doc_id)
    assert kept == sorted([(5, late[5]), (5, ""), (5, "short"), (5, "short"), (7, "")])
    size = lambda x: len(x.encode())
    sure = [(None, size(late[None]), 0), (5, size(late[5]), 0), (5, size(late[5]), size(late[5])), (5, 5, 0), (5, 5, 0), (7, size(late[None]), size(late[None]))]
    # whichever of the two comes first stays whole, the other loses the 200 bytes they share
    shared = sorted((n, gone) for i, n, gone in got if i is None and n != size(late[None]))
    assert shared in ([(size(one), 0), (size(b), 200)], [(size(one), 200), (size(b), 0)])
    rest = [x for x in got if x[0] is not None or x[1] == size(late[None])]
    assert sorted(map(str, rest)) == sorted(map(str, sure))


def test_repeats_of_one_window_do_not_meet(spark):
    rows = spark.range(200).select(F.lit(9).alias("digest"), F.col("id").alias("doc"), F.lit(4).alias("place"), (F.col("id") > 1).alias("again"))
    assert rows.select(suffix_dedup._group(["doc"])).distinct().count() == 199


def test_suffix_clean_keeps_columns_and_rows(docs):
    out = suffix_dedup.clean(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert all(r.n_chars == len(r.text or "") for r in out.collect())


def shingles(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
    return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()


def components(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_minhash_chain_and_odd_rows(spark):
    words = [f"w{i}" for i in range(160)]
    rows = [(100 + k, " ".join(words[:20 + 3 * k] + ["edit"] + words[20 + 3 * k:])) for k in range(40)]
    rows += [(1, None), (2, ""), (3, "short"), (4, "short"), (None, "no id"), (5, " ".join(words)), (6, " ".join(words[:90]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit("clash"))
    got = {r.doc: (r.n, r.component) for r in minhash_dedup.groups(df.repartition(3), 92).collect()}
    sets = {i: shingles(t) for i, t in rows if i is not None}
    want = components(sets, 92)
    assert got == {i: (len(sets[i]), want[i]) for i in sets}
    kept = minhash_dedup.dedup(df, 92)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in want if want[i] == i} | {None}


def thue_morse(a, b, n=1024):
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


def test_minhash_hub_of_many_in_lots(spark, monkeypatch):
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(100)]  # each shares 91 to 95 of some 101 shingles with the first
    texts += ["quite another text of more than five words", None]
    docs = spark.createDataFrame(list(enumerate([" ".join(base), *texts])), "doc_id long, text string")

    def found():
        return {(r.doc, r.n, r.component) for r in minhash_dedup.groups(docs, 85).collect()}

    whole = found()
    monkeypatch.setattr(minhash_dedup, "LOT", 7)
    lots = found()
    assert lots == whole and {c for d, _, c in lots if d <= 100} == {0} and {c for d, _, c in lots if d > 100} == {101, 102}
    pairs = spark.createDataFrame([(0, i, i % 3) for i in range(1, 103)], "a long, b long, slot long")
    shared = docs.selectExpr("doc_id AS doc", "cast(text AS binary) AS text")
    assert minhash_dedup._with_hub(pairs, shared.withColumnRenamed("doc", "a")).count() == 102
    with_slots = {tuple(r) for r in minhash_dedup.verify(shared, pairs, 85).collect()}
    assert with_slots == {tuple(r) for r in minhash_dedup.verify(shared, pairs.drop("slot"), 85).collect()} == {(0, i) for i in range(1, 101)}


def test_minhash_tells_arranged_words_apart(spark, tmp_path):
    """Polynomials modulo a power of two are equal for these; also null and repeated ids through the query."""
    base = [f"v{i}" for i in range(200)]
    rows = [(1, thue_morse("a", "b")), (2, thue_morse("b", "a")), (3, thue_morse("x", "y") + " z"), (4, thue_morse("y", "x") + " z")]
    rows += [(5, None), (None, "one two three four five six"), (6, " "), (7, "SAME words"), (7, "SAME words"), (8, "same WORDS")]
    rows += [(20 + k, " ".join(base[: 100 + k] + ["new"] * (k % 3) + base[100 + k :])) for k in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.op9_minhash_near_dedup(spark, str(tmp_path)).collect()}
    sets = {i: shingles(t) for i, t in rows if i is not None}
    want = components(sets, 85)
    assert want[2] == 2 and want[4] == 4 and want[8] == 7 and want[49] == 20
    assert got == {(i, len(s), want[i], want[i] == i) for i, s in sets.items()} | {(None, 2, None, True)}


def test_stages_take_clashing_columns(spark, docs):
    odd = docs.withColumnsRenamed({"lang": "_score", "source": "_doc", "doc": "_0"})
    for out in (minhash_dedup.dedup(odd), quality_classifier.keep(odd), quality_classifier.keep(odd, docs)):
        assert out.schema == odd.schema and out.count() > 0


def test_classifier_stage_learns_from_the_whole_table(spark, tmp_path):
    """A bad document that passes the rules goes in the second stage, for which the rules' input is read."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("test tables not there")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = quality_rules.clean(docs).cache()
    out = corpus_pipeline.classifier(spark, kept, sf)
    assert out.schema == kept.schema and 0.9 * kept.count() < out.count() < kept.count()


def plain_posterior(counts, rounds=50):
    """Expectation-maximisation over vote patterns, one document class at a time."""
    import math

    n = len(quality_classifier.LIMITS)
    vote = {c: [c // 3**i % 3 for i in range(n)] for c in counts}
    right, prior, good = [0.8] * n, 0.8, {}
    for _ in range(rounds):
        for c, v in vote.items():
            lean = math.log(prior / (1 - prior))
            for x, r in zip(v, right):
                lean += {2: 1, 1: 0, 0: -1}[x] * math.log(r / (1 - r))
            good[c] = 1 / (1 + math.exp(-min(max(lean, -30), 30)))
        for i in range(n):
            agree = sum(counts[c] * (good[c] if vote[c][i] == 2 else 1 - good[c]) for c in counts if vote[c][i] != 1)
            said = sum(counts[c] for c in counts if vote[c][i] != 1)
            right[i] = min(max((agree + 8) / (said + 10), 0.55), 0.95)
        prior = min(max(sum(good[c] * counts[c] for c in counts) / sum(counts.values()), 0.05), 0.95)
    return good


def test_classifier_against_plain_python(spark, folder):
    """Votes counted, posteriors and scores of the query, each computed anew without numpy's help."""
    import math

    texts_ = [t for t in texts() if t]
    counts = {}
    for t in texts_:
        code = sum(v * 3**i for i, v in enumerate(quality_classifier.votes(quality_classifier.measures(t.encode()))))
        counts[code] = counts.get(code, 0) + 1
    table = spark.createDataFrame([(t,) for t in texts()], "text string")
    assert quality_classifier.patterns(table) == counts
    got = quality_classifier.estimate(counts)
    assert all(abs(got[c] - p) < 1e-9 for c, p in plain_posterior(counts).items())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    weights = quality_classifier.train(docs).tolist()
    found = {r.doc_id: r for r in quality_classifier.op4_quality_classifier(spark, folder).collect()}
    for r in docs.collect():
        data = (r.text or "").encode()
        if not data:
            assert (found[r.doc_id].score, found[r.doc_id].kept) == (0.0, False)
            continue
        x = [0.0] * quality_classifier.SIZE
        for a, b, c in zip(data, data[1:], data[2:]):
            h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32
            h ^= h >> 15
            x[h * 0x2C1B3C6D % 2**32 >> 20] += 1
        norm = math.sqrt(sum(v * v for v in x)) or 1
        x = [v / norm for v in x]
        for i, v in enumerate(quality_classifier.measures(data)):
            x[(i * 16 + min(max(int(v * 10), 0), 15)) * 37 % quality_classifier.SIZE] += 0.5
        lean = sum(a * b for a, b in zip(x, weights)) + weights[-1]
        want = 1 / (1 + math.exp(-min(max(lean, -50), 50)))
        assert abs(found[r.doc_id].score - want) < 1e-4 and found[r.doc_id].kept == (found[r.doc_id].score >= 0.5)


def test_across_links_what_the_hub_misses(spark):
    """Members outside the hub's component are compared with each other, in several blocks."""
    sets = {i: np.arange(i // 3 * 1000, i // 3 * 1000 + 50, dtype=np.uint64) for i in range(9)}
    members = spark.createDataFrame([(7, i, 50, i, 0) for i in sets], "key long, id long, n long, component long, home long")
    frame = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "doc long, set binary")
    block, minhash_dedup.BLOCK = minhash_dedup.BLOCK, 2
    try:
        links = minhash_dedup._across(members, lambda ids: frame, 85).collect()
    finally:
        minhash_dedup.BLOCK = block
    root = {i: i for i in sets}
    for r in sorted((r.a, r.b) for r in links):
        root[r[1]] = root[r[0]]
    assert [root[i] for i in range(9)] == [0, 0, 0, 3, 3, 3, 6, 6, 6]


def test_fingerprints(spark, folder, docs):
    got = {r.doc_id: r for r in fingerprints.op1_document_fingerprints(spark, folder).collect()}
    rows = docs.orderBy(F.desc("doc_id")).collect()
    prints = {}
    for k, r in enumerate(rows):
        text, after = r.text or "", rows[(k + 1) % len(rows)].text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        g = got[r.doc_id]
        assert (g.n_chars, g.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, g.fingerprint) == g.fingerprint
        for other, near in ((edited, g.near_edited), (after, g.near_next)):
            a, b = shingles(text), shingles(other)
            assert abs(near - (len(a & b) / len(a | b) if a | b else 1)) < 0.2


def test_fingerprints_of_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "n " * 30), (None, None), (3, "a b c d e f"), (3, "a b c d e f"), (3, "g"), (9, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = fingerprints.op1_document_fingerprints(spark, str(tmp_path)).collect()
    assert sorted(str((r.doc_id, r.n_chars)) for r in got) == sorted(str((i, len(t or ""))) for i, t in rows)
    order = [(9, ""), (3, "a b c d e f"), (3, "a b c d e f"), (3, "g"), (None, ""), (None, "n " * 30)]
    want = []
    for k, (i, t) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(t) // 2
        want.append((i, hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(map(str, ((r.doc_id, r.edited_sha256) for r in got))) == sorted(map(str, want))
    assert all(r.near_next == 1.0 for r in got if r.doc_id == 3 and r.n_chars == 11 and r.near_next > 0.9)


def test_quality_rules_by_line():
    prose = "the fox ran over the hill and then it came home to rest.\n"
    body = "".join(prose.replace("fox", w) for w in ("cat", "dog", "cow", "hen"))
    good = quality_rules.judge("".join(f"{w} {x}." for w, x in zip("abcdefghijklmnopqrstu", "vwxyzabcdefghijklmnop")))
    assert good["n_words"] == 22 and good["kept"]
    assert quality_rules.judge("buy now!! come!! go!!\n")["base_failed"]
    assert quality_rules.judge_line("a | b | c", 5) == "navigation"
    assert quality_rules.judge_line("see our privacy policy", 4) == "boilerplate"
    assert quality_rules.judge(None)["n_words"] == 0 and not quality_rules.judge("")["kept"]
    assert quality_rules.judge(body + body)["n_dup_lines"] == 4
    words = "a b c d e f g h i a b c d e f g h j".split()
    assert quality_rules.repeated_words([w.encode() for w in words]) == 16


def test_classifier_on_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("test tables not there")
    got = quality_classifier.op4_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right = [r.kept == (r.quality == 1) for r in got.collect()]
    assert sum(right) >= 0.98 * len(right)


def test_rules_and_classifier_keep_columns(docs):
    assert quality_rules.clean(docs).columns == docs.columns
    assert quality_classifier.keep(docs).columns == docs.columns


def test_chat_round_trip(spark):
    hard = [r"\### Assistant: </turn> ok", "", "a:b\\", "<|image:1|>", "### x: y</turn>\n", "\\\\<|image\\:1|>"]
    for role in ("user", "assistant", "a:b ###"):
        for text in hard:
            flat = chat_format.Flattener()
            turn = chat_format.format_turn(role, [{"type": "text", "text": text}], flat)
            assert chat_format.read_turn(turn.text) == (role, text)
    flat = chat_format.Flattener()
    parts = [{"type": "text", "text": "see <|"}, {"type": "image", "ref": "u", "width": 600, "height": 10}, {"type": "audio", "seconds": 2.0}]
    turn = chat_format.format_turn("user", parts, flat)
    assert chat_format.read_turn(turn.text) == ("user", "see <|<|image\\:1|><|audio\\:2|>")
    assert [(a["type"], a["tokens"]) for a in flat.attachments] == [("image", 512), ("audio", 50)]


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.com/en/x", "https://www.example.com/en/?q", "http://a.net/es/1", "http://net/fr/", "http://xnet/fr/",
            "http://h.com", "http://a.example.com/de#/en/", "ftp://x.org?http://a.net/es/"]
    df = url_filter.split_url(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string"))
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(df, rules).collect()}
    want = [None, None, None, "example.com/en/", "www.example.com/en/", "net/es/", "net/fr/", None, None, "com/", None]
    assert [got[i][0] for i in range(len(urls))] == want
    assert [i for i in got if got[i][1] == "block"] and got[4][1] == "allow" and got[7] == (None, "allow")


def test_warc_round_trip(spark, tmp_path):
    big = "<p>ü</p>" * 3000
    rows = [(1, "u", big), (2, "u\r\n", big), (3, None, None), (4, "u", "tiny"), (5, "u", "tiny"), (6, "u", "x\r\n\r\nWARC/1.1\r\n" * 50),
            (1, "u", big), (None, "u", big)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w")
    got = sorted((r.page_id or 99, r.payload_bytes, r.record_type, r.refers_to, r.payload_digest) for r in warc.load(spark, f"{tmp_path}/w").collect())
    want = []
    for page, _, html in rows:
        b = (html or "").encode()
        repeat = html == big and page != 1
        want.append((page or 99, len(b), "revisit" if repeat else "response", 1 if repeat else None, hashlib.sha256(b).hexdigest()))
    key = lambda t: tuple(map(str, t))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_warc_revisits_of_a_page_with_two_payloads(spark, tmp_path):
    a, b = "<p>a</p>" * 40, "<p>bb</p>" * 1000
    rows = [(1, "u", a), (1, "u", b), (2, "u", a), (3, "u", b)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w")
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.load(spark, f"{tmp_path}/w").collect())
    assert got == [(1, len(a), "response", None), (1, len(b), "response", None), (2, len(a), "revisit", 1), (3, len(b), "revisit", 1)]


def test_pieces_are_sentencepieces_own(docs):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path(sentencepiece_viterbi.VOCABULARY)
    other = sentencepiece.SentencePieceProcessor(model_file=path)
    model = sentencepiece_viterbi.Viterbi(path)
    letters = np.array(list("aaeeiinnoostrlhdcumpg  \n.,-ABé漢\U0001f600ß01▁\t"))
    sample = texts() + ["   lead", "trail   ", "a      b", " ", "x" * 3000, "▁", "naïve café " * 50]
    sample += ["".join(rng.choice(letters, n)) for n in (1, 2, 3, 7, 30, 200, 3000) for _ in range(30)]
    if os.path.isdir("/root/testdata/sf0.001"):
        import pandas as pd

        sample += pd.read_parquet("/root/testdata/sf0.001/documents.parquet").text.tolist()
    for text, data in zip(sample, model.encode(sample), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == other.encode(text or "")
        assert model.decode(data) == (text or "").replace("▁", " ")


def test_borders_hold_as_merging_says():
    import public_tokenizers

    model = sentencepiece_viterbi.Viterbi(public_tokenizers.path(sentencepiece_viterbi.VOCABULARY))
    rng = np.random.default_rng(17)
    some = np.flatnonzero(model.size > 1)
    a, b = rng.choice(some, (2, 4000)).astype(np.int32)
    whole = rng.choice(some, 2000)  # borders that merging crosses, and odd pieces of spaces
    a = np.concatenate([a, model.left[whole], np.flatnonzero(~model.plain)[:5]]).astype(np.int32)
    b = np.concatenate([b, model.right[whole], np.flatnonzero(~model.plain)[:5]]).astype(np.int32)
    want = [model._replay(model.piece[x] + model.piece[y]) == [model.piece[x], model.piece[y]] for x, y in zip(a, b)]
    assert model._stay(a, b).tolist() == want and 0 < sum(want) < len(want)
    assert model._holds(a, b).tolist() == want == model._holds(a, b).tolist()
    model.replayed = 0
    model.encode([t for t in texts() if t])
    assert model.replayed <= len(model.known) // 20


def test_viterbi_is_the_best_sum():
    import public_tokenizers

    model = sentencepiece_viterbi.Viterbi(public_tokenizers.path(sentencepiece_viterbi.VOCABULARY))
    model.rank = None  # read as a unigram vocabulary
    score = {p: s for p, s, t in sentencepiece_viterbi.load_pieces(public_tokenizers.path(sentencepiece_viterbi.VOCABULARY)) if t == 1}
    texts = ["hello world  again", "übergrößenträger", "漢字 \U0001f600", "a\nb", ""]
    for text, data in zip(texts, model.encode(texts), strict=True):
        assert model.decode(data) == text
    for word in ("▁hello", "▁strawberries", "▁lynt", "▁Größe"):
        best = [0.0] + [-np.inf] * len(word)
        for e in range(1, len(word) + 1):
            for b in range(e):
                if word[b:e] in score:
                    best[e] = max(best[e], best[b] + score[word[b:e]])
        ids = model.segment([word])[0]
        assert sum(score[model.table[i].decode()] for i in ids) == best[-1]


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.VOCABULARY)
    tok = Tokenizer.from_file(path)
    sample = [t for t in texts() if t] + ["<|endoftext|> A", "İx ΑΣ. c'est 'll a.b.. é. É,"]
    for text, data in zip(sample, packing.Words(path).batch([t.encode() for t in sample]), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
    items = packing.pieces(docs, path)
    out = packing.pack(items, part=7).collect()
    assert len(out) == items.count()
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        v.sort()
        assert all(o == sum(n for _, n in v[:k]) for k, (o, _) in enumerate(v)) and sum(n for _, n in v) <= packing.CAPACITY
    whole = packing.pack(items).select("sequence_id").distinct().count()
    assert whole <= len(by) and whole <= packing.lower_bound(np.array([r.length for r in out])) + 1
    assert packing.lower_bound(np.array([1500, 1500, 400])) == 2


def items(spark, lengths):
    rows = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long")
    zero = F.lit(0).cast("bigint")
    return rows.select("doc_id", F.lit(0).alias("piece"), zero.alias("start"), "length", zero.alias("ids_crc32"))


def test_packing_goes_on_while_bins_are_saved(spark, caplog):
    caplog.set_level("INFO", packing.__name__)
    lengths = np.random.default_rng(3).integers(600, 1100, 400)
    out = packing.pack(items(spark, lengths), part=40).collect()
    assert sorted(r.doc_id for r in out) == list(range(400))
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        v.sort()
        assert all(o == sum(n for _, n in v[:k]) for k, (o, _) in enumerate(v)) and sum(n for _, n in v) <= packing.CAPACITY
    assert caplog.messages == [f"{len(by)} sequences, at least {packing.lower_bound(lengths)} needed"]


def test_equal_pieces_are_dealt_apart_in_every_round(spark):
    # nine hundreds: two to a bin, below the bound in no part
    same = items(spark, [900] * 120).withColumn("doc_id", F.lit(1).cast("bigint"))
    out = packing.pack(same, part=30).collect()
    assert len(out) == 120 and len({r.sequence_id >> 24 & 0xFFFFFF for r in out}) > 1


def test_empty_tables(spark, empty):
    for query in (fingerprints.op1_document_fingerprints, suffix_dedup.op2_suffix_array_dedup, quality_rules.op3_quality_rules,
                  quality_classifier.op4_quality_classifier, sentencepiece_viterbi.op7_sentencepiece_viterbi,
                  minhash_dedup.op9_minhash_near_dedup, packing.op10_best_fit_packing):
        assert query(spark, empty).count() == 0


def test_pipeline_ends_in_gapless_sequences(spark, folder):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, folder).collect()
    total = {}
    for r in out:
        total.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert out and all(sum(n for _, n in v) <= 2048 for v in total.values())


def plain_stages(spark, rows):
    """The pipeline's stages in plain Python on ``(doc_id, text)``: texts left after each, and the pieces."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    left, counts = {}, []
    for i, t in rows:
        found = quality_rules.judge(t)
        if found["kept"]:
            left[i] = found["clean"]
    counts.append(len(left))
    weights = quality_classifier.train(spark.createDataFrame(rows, "doc_id long, text string"))

    def good(text):
        b = text.encode()
        return b and quality_classifier.features(b, quality_classifier.measures(b)) @ weights[:-1] + weights[-1] >= 0

    left = {i: t for i, t in left.items() if good(t)}
    counts.append(len(left))
    group = components({i: shingles(t) for i, t in left.items()}, 80)
    left = {i: t for i, t in left.items() if group[i] == i}
    counts.append(len(left))
    seen, pieces, cut = set(), [], 0
    tok = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    for i, t in sorted(left.items()):
        b = t.encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(b[p : p + 100])
        cut += int(gone.sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]).decode("utf-8", "ignore")
        ids = np.array([*tok.encode(kept, add_special_tokens=False).ids, 0], dtype="<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            pieces.append((i, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    return counts, cut, pieces


@pytest.mark.parametrize("given", [False, True])
def test_pipeline_is_its_plain_stages(spark, folder, given):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001" if given else folder
    if not os.path.isdir(sf):
        pytest.skip("test tables not there")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    counts, cut, want = plain_stages(spark, rows)
    assert not given or (len(rows) > counts[0] and counts[1] > counts[2] and cut)
    out = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        v.sort()
        assert all(o == sum(n for _, n in v[:k]) for k, (o, _) in enumerate(v)) and sum(n for _, n in v) <= 2048


def test_every_row_has_the_next_one(spark, monkeypatch):
    """Slices of eight rows, hot and null ids, equal rows: each row is followed once, round the table."""
    monkeypatch.setattr(fingerprints, "SLICE", 8)
    for n in (0, 1, 2, 8, 9, 300):
        ids = [None if i % 50 == 3 else 7 if i % 3 == 0 else i for i in range(n)]
        rows = [(i, f"t{k % 40}") for k, i in enumerate(ids)]
        placed = fingerprints.in_order(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", ["text"])
        out = fingerprints.with_next(placed, ["doc_id", "text"])
        got = sorted((tuple(r) for r in out.collect()), key=repr)
        order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        assert got == sorted((a + b for a, b in zip(order, order[1:] + order[:1])), key=repr)
    plans = [
        len(re.sub(r"[\d.]+|file:\S+|/\S+", "", fingerprints.with_next(fingerprints.in_order(df, "id", ["t"]), ["t"])
                   ._jdf.queryExecution().optimizedPlan().toString()))
        for df in (spark.range(k).select("id", F.lit("x").alias("t")) for k in (10, 100_000))
    ]
    assert abs(plans[0] - plans[1]) < 40
