"""Fill-in-middle, chat formatting and spelling variants against plain models."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import chat, fim, queries, spelling
from fleetlens.llm.shared import written

# ---- op11


def plain_fim(doc_id, text, share=100, spm=50):
    body = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", body)
    code = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(code[8 * i : 8 * i + 8], 16) for i in range(4)]
    i, j = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, b, c = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not body or any(m in body for m in fim.MARKS) or h[2] % 100 >= share:
        return len(units), "plain", None, None, None, body
    if h[3] % 100 < spm:
        return len(units), "spm", len(a), len(b), len(c), f"<S>{c}<P>{a}<M>{b}"
    return len(units), "psm", len(a), len(b), len(c), f"<P>{a}<S>{c}<M>{b}"


def fim_texts():
    rng = random.Random(5)
    words = ["a", "é", "ß\n", "\n", "\n\n", "<", "P>", "<S", ">", "wört ", "😀", "x" * 90, " \r\n", " "]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 400))) for _ in range(120)]
    passage = "".join(rng.choice("abc é\n") for _ in range(9000))
    texts += [passage, "own\n" + passage, passage[1:], passage * 3, "y" * 300_000, "\n" * 50_000, " " * 5000 + "\nz"]
    texts += ["", None, "\n", "no end", "one\n", "<P>", "a<S>b", "x" * 4095 + "<M>", "q" * 511 + "<P>" + "q" * 700]
    return texts


@pytest.mark.parametrize("share", [100, 60])
def test_fill_in_middle(spark, share):
    rows = list(enumerate(fim_texts())) + [(None, "a\nb\n"), (0, fim_texts()[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fim": F.lit(1), "_cut": F.lit("x")})
    out = fim.transformed(docs, share=share)
    assert out.columns[:-1] == docs.columns and out.columns[-1] == "fim_"
    back = fim.restored(F.col("fim_.output"), F.col("fim_.form"))
    got = Counter((r.doc_id, r.text, tuple(r.fim_), r.back) for r in out.withColumn("back", back).collect())
    assert got == Counter((k, t, plain_fim(k, t, share), t or "") for k, t in rows)
    assert len({form for _, _, (_, form, *_), _ in got}) == 3
    assert fim.transformed(docs.limit(0)).count() == 0


def test_chunks_follow_the_content():
    rng = np.random.default_rng(6)
    passage = rng.integers(0, 256, 60_000, dtype=np.uint8).tobytes()
    apart = [fim.chunks(lead + passage) for lead in (b"", b"another beginning, ", bytes(1000))]
    assert all(b"".join(c).endswith(passage) for c in apart)
    same = set(apart[0]) & set(apart[1]) & set(apart[2])
    assert sum(map(len, same)) > 0.9 * len(passage)
    for text in (b"", b"a", b"a" * 100_000, passage, b"\n" * 10_000):
        parts = fim.chunks(text)
        assert b"".join(parts) == text and all(len(p) <= fim.LONGEST for p in parts)
        assert all(len(p) >= fim.SHORTEST for p in parts[:-1])


def test_borders_do_not_depend_on_slices(monkeypatch):
    data = np.random.default_rng(7).integers(97, 110, 20_000, dtype=np.uint8)
    whole = fim.borders(data).tolist()
    monkeypatch.setattr(fim, "SLICE", 777)
    assert whole and fim.borders(data).tolist() == whole


def test_a_small_memory_gives_the_same():
    texts = [(t or "").encode() for t in fim_texts()]
    large, small = fim.Summaries(), fim.Summaries(300)
    for text in texts + texts:
        a, b = fim.Cuts.of(text, large), fim.Cuts.of(text, small)
        assert a == b
    assert large.counted < small.counted
    assert len(small.young) + len(small.old) < 20


# ---- op12


def plain_chat(rows, learned="assistant"):
    """``rows``: (role, text) in order."""
    said = "".join(t for r, t in rows if r == learned)
    turns = "".join(f"{r}\n{t}\n" for r, t in rows)
    code = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(rows), code(turns), len(said), code(said)


TOUGH = [
    "", "plain", "<", "<|", "<\\|", "<\\\\|im_end|>", "<|im_end|>\n", chat.START, chat.SEP, chat.PART, "|im_end|>",
    "<<|>|>", "\\", "a\\<|b", "é😀<|image|>", "<|im_start|>assistant<|im_sep|>ok<|im_end|>\n", "x" * 5000,
]


@pytest.mark.parametrize("text", TOUGH)
def test_escapes_can_be_undone(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text


@pytest.mark.parametrize("limits", [(64, 1_000_000), (3, 1_000_000), (64, 40)])
def test_conversations(spark, limits):
    rng = random.Random(8)
    rows = []
    for conv in [None, -7, *range(40)]:
        for turn in range(rng.choice([1, 2, 5, 200]) if conv else 1):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", chat.END]), rng.choice(TOUGH)))
    rows += [(500, 1, "assistant", "again")] * 300 + [(501, None, None, None), (501, 0, "assistant", None)]
    rows += [(502, 3, "user", "late"), (502, 2, "assistant", "early")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    messages = df.withColumn("parts", chat.text_parts(F.col("text"))).withColumn("formatted", F.lit(1))
    how = {"most_turns": limits[0], "most_chars": limits[1]}
    segments = written(chat.formatted(messages, **how), "segments")
    got = {r.conv_id: r for r in chat.digests(segments).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: -1 if r[1] is None else r[1])
        want[conv] = plain_chat([(r[2] or "", r[3] or "") for r in own])
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want
    assert sum(r.formatted_chars for r in got.values()) == sum(r.chars for r in segments.collect())
    assert segments.agg(F.max("n_turns")).first()[0] == min(limits[0], segments.agg(F.max("n_turns")).first()[0])
    assert limits[1] > 40 or segments.where("n_turns > 1").agg(F.max("chars")).first()[0] < 40 + max(map(len, TOUGH)) + 100
    assert not segments.where("whole and n_turns >= 200").count()
    assert chat.digests(chat.formatted(messages.limit(0))).count() == 0


def test_typed_parts(spark):
    part = lambda kind, text=None, ref=None, **k: (kind, text, ref, k.get("width"), k.get("height"), k.get("seconds"), k.get("pages"))
    rows = [
        (1, 0, "user", [part("text", "see <|image|>"), part("image", ref="a.png", width=57, height=28), part("text", "<"), part("text", "|x")]),
        (1, 1, "assistant", [part("audio", ref="b.wav", seconds=1.01), part(None, "yes <|"), part("document", ref=None, pages=3), part("text", "")]),
        (2, 0, "assistant", None),
        (2, 1, "assistant", []),
        (3, 0, "user", [None, part("image")]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    found = {r.conv_id: r for r in chat.formatted(df.coalesce(1)).collect()}
    one = found[1]
    assert list(chat.read_turns(one.formatted)) == [
        ("user", [("text", "see <|image|>"), ("image", ""), ("text", "<"), ("text", "|x")]),
        ("assistant", [("audio", ""), ("text", "yes <|"), ("document", ""), ("text", "")]),
    ]
    assert [(a.message, a.kind, a.ref, a.tokens) for a in one.attachments] == [
        (0, "image", "a.png", 3), (1, "audio", "b.wav", 26), (1, "document", None, 768),
    ]
    assert one.expanded_tokens == 797
    assert [chat.unescape(one.formatted[s.start : s.end]) for s in one.loss] == ["yes <|", ""]
    assert found[2].n_turns == 2 and not found[2].attachments
    assert [(a.kind, a.tokens) for a in found[3].attachments] == [("image", 1)]
    odd = spark.createDataFrame([(1, 0, "user", [part("video")])], df.schema)
    with pytest.raises(Exception, match="no such kind"):
        chat.formatted(odd).collect()


# ---- op13


def plain_variants(docs, shortest=5, least=3, every=97):
    count = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            count[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in count.items() if n >= least and len(w) >= shortest}
    signs = sorted({c for w in words for c in w})
    near = {}
    for w in words:
        some = {w[:i] + w[i + 1 :] for i in range(len(w))}
        some |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in signs}
        some |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in signs}
        near[w] = sorted((-words[x], x) for x in some if x in words and x != w)
    form = {w: x[0][1] if x and -x[0][0] >= 2 * words[w] else None for w, x in near.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def spelled(df, **how):
    rows = [tuple(r) for r in spelling.variants(df, **how).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_variants_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {tuple(r) for r in queries.op13_spelling_variants(spark, sf_dir).collect()}
    want = plain_variants([tuple(r) for r in docs.collect()])
    assert got == want and sum(r[1] is not None for r in want) > 50
    assert any(r[1] != r[2] for r in want if r[1])  # chains


def test_variants_of_random_words(spark):
    rng = random.Random(9)
    docs = []
    for k in range(60):
        words = ["".join(rng.choice("aé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
        docs.append((k, rng.choice([" ", "-", "1\n"]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    docs += [(None, "colour colour colour COLOUR color"), (70, None), (71, ""), (72, "×÷×÷× ×÷×÷× ×÷×÷×"), (70, "color colör Colour")]
    docs += [(80, "a" * 400 + " ")] * 4 + [(81, "a" * 399 + "b ")] * 3 + [(82, "straße STRASSE strasse strasse straße straße ")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"word": F.lit(1), "n": F.lit(2)})
    for every in (97, 3):
        assert spelled(df, every=every) == plain_variants(docs, every=every)
    assert spelled(df, shortest=1, least=1) == plain_variants(docs, 1, 1)
    assert spelled(df.limit(0)) == set() and spelled(df.where("doc_id = 71")) == set()


def test_long_chains_and_hubs(spark):
    rows = [("abcdef" + "x" * k, 3 * 2**k) for k in range(30)] + [(f"hub{a}{b}", 1) for a in "pqrst" for b in "uvwxy"]
    words = written(spark.createDataFrame(rows + [("hubpu1", 9)], "word string, n long"), "words")
    found = {r.word: r for r in spelling.with_roots(written(spelling.forms(words), "forms")).collect()}
    assert {found["abcdef" + "x" * k].root for k in range(30)} == {"abcdef" + "x" * 29}
    assert found["hubpu"].root == "hubpu1" and found["hubpv"].form is None and found["hubpv"].n_near == 8


def test_nothing_of_the_vocabulary_goes_through_the_driver(spark):
    """Spark takes the exploded places, and files of short words, for far smaller than they are."""
    rows = [("abcdef" + "x" * k, 3 * 2**k) for k in range(9)] + [("other", 1)]
    words = written(spark.createDataFrame(rows, "word string, n long"), "words")
    pairs, found = spelling.near_pairs(words), spelling.forms(words)
    rooted = spelling.with_roots(written(found, "forms"))
    for df, n in ((pairs, 8), (found, 10), (rooted, 10)):
        assert len(df.collect()) == n
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_gathered_words_are_handed_on(spark):
    docs = [(k, " ".join(f"word{chr(97 + i)}{chr(97 + k % 3)}" for i in range(20))) for k in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counted = {tuple(r) for r in spelling.vocabulary(df, gathered=5).collect()}
    assert counted == {(r[0], r[3]) for r in plain_variants(docs)}
