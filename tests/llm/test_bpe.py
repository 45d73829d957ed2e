import json
import random

import numpy as np
import pyarrow as pa
import pytest
from genoloom.llm import bpe
from hypothesis import given, settings, strategies as st

tokenizers = pytest.importorskip("tokenizers")
PIECES = ["a", "b", "s", "t", "'", " ", "  ", "\n", "\t", "1", "22", "-", "'s", "'re", "'ll", "'ve", "é", "中文", "😀", "\r\n", " ", "_", "ve", "aaaa", "''", "　", "<|endoftext|>", "\x1c", "​", "٣", "ﬁ", "word", " word", "́"]


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(bpe.default_path())
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def mine(texts, tokenizer=None):
    tokenizer = tokenizer or bpe.load(bpe.default_path())
    out, counts = [], []
    for data, bounds, a, b, goes_on in bpe.slices(pa.array(texts, pa.string())):
        ids, at = tokenizer.encode(data, bounds)
        got = [ids[at[k] : at[k + 1]].tolist() for k in range(b - a)]
        out[-1:] = [out[-1] + got[0]] if goes_on else [*out[-1:], *got]
        assert tokenizer.count(data, bounds).tolist() == [len(x) for x in got]
    return out


def test_random_texts(reference):
    r = random.Random(0)
    texts = [None, "", *("".join(r.choices(PIECES, k=r.randrange(15))) for _ in range(20_000))]
    assert mine(texts) == reference(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text(reference, texts):
    assert mine(texts) == reference(texts)


def test_every_character(reference):
    texts = [f"a{chr(c)} {chr(c)}1" for c in range(0x110000) if not 0xD800 <= c < 0xE000][::3]
    assert mine(texts) == reference(texts)


def test_long_texts(reference, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 1000)
    texts = ["x" * 5000, "short", "ab cd\n" * 2000, " " * 4000, None, "é ü\t" * 1500, "q" * 100 + " " + "r" * 70, ""]
    assert mine(texts) == reference(texts)


def test_forgets_words(monkeypatch, reference):
    monkeypatch.setattr(bpe, "KEPT", 3)
    t = bpe.Tokenizer(bpe.default_path())
    for k in range(5):
        texts = [f"w{k}{j} and more" for j in range(9)]
        assert mine(texts, t) == reference(texts)


def test_equal_keys_are_told_apart(monkeypatch, reference):
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda a, **k: unique(a % 7 if a.dtype == np.uint64 else a, **k))
    texts = ["several different words in one text", "and a word of more than sixty-four letters " + "l" * 70]
    assert mine(texts) == reference(texts)


def test_operator(spark, reference):
    texts = [None, "", "a b", "a b", "it's <|endoftext|>", "z" * 300_000]
    rows = [(k if k != 2 else None, t, 1, 2) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, row_id int").repartition(2)
    got = sorted((tuple(r.ids), -1 if r.doc_id is None else r.doc_id) for r in bpe.encode(df, "doc_id", "text").collect())
    want = sorted((tuple(ids), -1 if r[0] is None else r[0]) for ids, r in zip(reference(texts), rows))
    assert got == want
    counts = {r.doc_id: r.tokens for r in bpe.token_counts(df, "doc_id", "text").collect()}
    assert counts[0] == counts[1] == 0 and counts[3] == 2
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0


def test_file_is_a_parameter(spark, tmp_path, reference):
    with open(bpe.default_path(), encoding="utf-8") as f:
        j = json.load(f)
    j["model"]["merges"] = j["model"]["merges"][:0]
    (tmp_path / "t.json").write_text(json.dumps(j))
    df = spark.createDataFrame([(1, "abc é")], "doc_id long, text string")
    assert len(bpe.encode(df, "doc_id", "text", str(tmp_path / "t.json")).first().ids) == 6
