"""Where an operator once did a part of its job: whole results by brute force."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from fleetlens.llm import lines, packing, queries, shingles, simhash
from fleetlens.llm.shared import written


def word_sets(text, size=5):
    words = text.lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 0


def edited(rng, text, times):
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("most", [2, 64])
def test_all_similar_texts_are_linked(spark, monkeypatch, most):
    monkeypatch.setattr(shingles, "MOST", most)
    rng = random.Random(11)
    texts = []
    for k in range(12):
        base = " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(30, 150)))
        texts += [base, base.upper()] + [edited(rng, base, rng.randint(1, 3)) for _ in range(8)]
    same = " ".join(f"s{i}" for i in range(60))
    texts += [same + f" end{k} tail{k}" for k in range(90)] + ["", "a b", "a b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [word_sets(t) for t in texts]
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    far = 0
    for i, j in combinations(range(len(texts)), 2):
        apart = (simhash.fingerprint(texts[i], 5) ^ simhash.fingerprint(texts[j], 5)) % (1 << 64)
        close = similarity(sets[i], sets[j]) >= 0.8
        far += close and apart.bit_count() > 3
        if close or apart.bit_count() <= 3:
            x, y = sorted((top(i), top(j)))
            root[y] = x
    assert far > 20  # what the grid alone does not find
    kept = {r.doc_id for r in simhash.one_of_each(docs, least=(4, 5)).collect()}
    assert kept == {top(i) for i in range(len(texts))}


def cut_all_runs(docs, min_words):
    """Every line of every run of ``min_words`` words that an earlier place has too goes."""
    held = {d: [(i, x) for i, x in enumerate(t.split("\n")) if x.split()] for d, t in docs}
    seen, cut = set(), defaultdict(set)
    for d in sorted(held):
        for q in range(len(held[d])):
            runs = [held[d][q : q + n] for n in range(1, len(held[d]) - q + 1)]
            runs = [r for r in runs if sum(len(x.split()) for _, x in r) >= min_words]
            for run in runs:
                if tuple(x for _, x in run) in seen:
                    cut[d] |= {i for i, _ in run}
            seen |= {tuple(x for _, x in run) for run in runs}
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut[d]) for d, t in docs}


@pytest.mark.parametrize("min_words", [3, 6])
def test_runs_are_cut_to_their_last_line(spark, min_words):
    rng = random.Random(12)
    some = ["a", "b b", "c c c", "", "d d d d d d", "  ", "e e", "f"]
    docs = [(i, "\n".join(rng.choice(some) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    run = "one two three four five six seven eight nine ten\nShth ndti."
    docs += [(100, run), (101, run + "\nown"), (102, run)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.deduped(df, min_words).collect()}
    assert got == cut_all_runs(docs, min_words)
    assert got[101] == "own" and got[102] == ""


def test_added_tokens_inside_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a{end}b", end, f"{end}{end}", f"a  {end}  b", f"\n\n{end}\n é", "<|endoftext", f"<|{end}|>", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ranks, split = queries.tokenizer()
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.packed(docs, ranks, split, 64, queries.added()).collect()}
    ids = [np.array([*exact.encode(t, add_special_tokens=False).ids, 0], "<u4") for t in texts]
    assert 50256 in ids[0]
    assert got == {i: (len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)}


def test_short_clean_documents_pass_the_filter(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, sf_dir).collect()}
    found = queries.op2_quality_rules(spark, sf_dir).toPandas()
    short = found[found.n_words < 50]
    clean = short[(short.p_good >= 0.5) & (2 * short.n_repeat_words <= short.n_words)]
    assert len(clean) and set(clean.doc_id) <= kept
    assert kept - set(clean.doc_id) == set(found[found.kept].doc_id)


def test_rows_that_share_an_id(spark):
    run = "one two three four five six seven"
    own = "a text of its own with words enough"
    docs = [(1, run), (2, run), (2, own), (3, own + "\n" + run), (3, "other words here that nobody has said")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in lines.deduped(df, 6).collect())
    assert got == sorted([(1, run), (2, ""), (2, own), (3, ""), (3, docs[4][1])])
    far = [(1, "x1 x2 x3 x4 x5 x6 x7 x8"), (2, "y1 y2 y3 y4 y5 y6 y7"), (2, "z1 z2 z3 z4 z5 z6 z7"), (2, "z1 z2 z3 z4 z5 z6 z7")]
    far += [(3, "Y1 y2 y3 y4 y5 y6 y7"), (None, "x1 x2 x3 x4 x5 x6 x7 x8")]
    kept = simhash.one_of_each(spark.createDataFrame(far, df.schema), least=(4, 5)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted((a or 0, b) for a, b in [*far[:3], far[5]])


def test_repeated_rows_do_not_multiply(spark):
    text = "\n".join(f"line {i} of a text that comes often" for i in range(8))
    docs = [(7, text)] * 100 + [(8, text)] * 50 + [(9, text + "\nown")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    levels = lines.suffix_ranks(written(lines.line_ids(df), "l"))
    assert [x.count() for x in levels] == [24, 21, 15, 3]  # of three documents
    got = [(r.doc_id, r.text) for r in lines.deduped(df, 6).collect()]
    assert sorted(got) == [(7, text)] * 100 + [(8, "")] * 50 + [(9, "own")]


def test_runs_of_any_length(spark):
    rng = random.Random(13)
    long = [f"{rng.choice('abcdefgh')} {i}" for i in range(700)]
    docs = [(1, long), (2, ["x"] + long[100:633] + ["y"]), (3, long[632:] + long[:100]), (4, ["same"] * 300), (5, long[5:8])]
    rows = [(d, "\n".join(x)) for d, x in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, [tuple(x) for x in r.removed_runs]) for r in lines.deduped(df, 6).collect()}
    assert got[1] == (rows[0][1], []) and got[2] == ("x\ny", [(1, 533)]) and got[3] == ("", [(0, 167)])
    assert got[4] == ("same", [(1, 299)]) and got[5] == ("", [(0, 2)])


def test_texts_that_overflow_the_splitter(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" " * 1_500_000, "a" + " " * 1_000_000 + "b <|endoftext|>", "\n" * 1_000_000, "x" * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ranks, split = queries.tokenizer()
    rows = packing.pieces(docs, ranks, split, 1 << 30, added=queries.added(), json_path=queries.vocabulary_json()).collect()
    ids = [np.array([*exact.encode(t, add_special_tokens=False).ids, 0], "<u4") for t in texts]
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {i: (len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)}


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for n, m, both in [(1, 1, 0), (1, 1, 1), (3, 900, 2), (300, 310, 280), (300, 310, 10), (5000, 4000, 3900), (40, 0, 0)]:
        pool = np.unique(rng.integers(0, 1 << 63, n + m, dtype=np.uint64))
        a, b = pool[:n], np.concatenate([pool[:both], pool[n : n + m - both]])
        exact = len(np.setxor1d(a, b))
        bound = shingles.differing(shingles.sketch(a), shingles.sketch(np.sort(b)))
        assert bound <= exact and (exact == 0 or bound > 0 or exact <= 2)
        assert shingles.differing(shingles.sketch(a), shingles.sketch(a)) == 0


@pytest.mark.parametrize("text", [None, "", " \n", "one", "A b c d e", "a b c d e f g a b c d e", "é " * 300 + "ÀB c"])
def test_one_pass_gives_the_known_fingerprints(text):
    words = shingles._joined(text)
    assert simhash.majority(shingles.hashes(words, 5)) == simhash.fingerprint(text, 5)


def test_sketches_lose_no_pair(spark):
    rng = random.Random(11)
    made = []
    for _ in range(25):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([6, 30, 120, 700]))]
        for _ in range(4):
            words = list(base)
            for _ in range(rng.randrange(1 + len(base) // 60 + 1)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(4000)}"
            made.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    sets = [shingles.shingle_set(t, 5) for t in made]
    root = list(range(len(made)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for j in range(len(made)):
        for i in range(j):
            near = shingles.alike(sets[i], sets[j], (4, 5))
            bits = bin((simhash.fingerprint(made[i], 5) ^ simhash.fingerprint(made[j], 5)) & (1 << 64) - 1).count("1")
            if near or bits <= 3:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    kept = {r.doc_id for r in simhash.one_of_each(docs, least=(4, 5)).collect()}
    assert kept == {i for i in range(len(made)) if top(i) == i}


def test_repeated_rows_stay_once(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "other words here"), (3, "q r s t u v"), (3, "q r s t u v"), (1, "x"), (None, "a b c")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), least=(4, 5)).collect()
    expected = [(1, "a b c"), (1, "x"), (2, "other words here"), (3, "q r s t u v"), (None, "a b c")]
    assert sorted(map(tuple, kept), key=str) == sorted(expected, key=str)
