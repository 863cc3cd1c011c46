import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusforge.llm import packing as pk
from tests.llm.helpers import docs_of

ODD = ["it's don't İ!! X", "a\tb\x0bc\x1cd", "<|endoftext|> hi <|startoftext|>x", "é é ́a ﬁ Å ǅ ß",
       "12abc3.5,,x'll", "日本語 text。ok", "  ", "", None, "ΑΣ Σ. ÀÉ!!! Ünder_score --x-- (y)", "a​b   c", "word " * 9000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(pk.tokenizer_path())


def _expect(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


@pytest.mark.parametrize("window", [64, 4096])
def test_round_trip_of_odd_texts(spark, tokenizer, window):
    docs = docs_of(spark, [(i, t, "x") for i, t in enumerate(ODD)], ", length string").repartition(3)
    rows = pk.pack(docs, window=window, keep_ids=True).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        assert r["sequence_id"] >= 0 and 0 <= r["offset"] and r["offset"] + r["length"] <= window
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
    for i, t in enumerate(ODD):
        parts = sorted(by_doc[i], key=lambda r: r["start"])
        ids = _expect(tokenizer, t)
        assert b"".join(bytes(r["ids"]) for r in parts) == ids.tobytes()
        assert [r["start"] for r in parts] == [0, *np.cumsum([r["length"] for r in parts])[:-1]]
        assert {r["doc_tokens"] for r in parts} == {len(ids)} and [r["last"] for r in parts] == [False] * (len(parts) - 1) + [True]
    # sequences are gapless and full but for the last
    total = sum(r["length"] for r in rows)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    at = 0
    for s, o, n in places:
        assert s * window + o == at
        at += n
    assert at == total


def test_sequences_hold_the_concatenation(spark, tokenizer):
    docs = docs_of(spark, [(i, f"text number {i} with words") for i in range(40)]).coalesce(1)
    pieces = pk.pack(docs, window=32, keep_ids=True)
    seq = sorted(pk.sequences(pieces).collect())
    whole = np.concatenate([_expect(tokenizer, f"text number {i} with words") for i in range(40)])
    assert b"".join(bytes(r["ids"]) for r in seq) == whole.tobytes()
    assert {r["n_ids"] for r in seq[:-1]} == {32}


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = pk.pack(docs_of(spark, [(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "1", "None"]
    assert pk.pack(docs_of(spark, [])).count() == 0


def test_words_remembered_before_a_reset_stay_right(tokenizer, monkeypatch):
    monkeypatch.setattr(pk, "_MEMORY", 5)
    e = pk.Encoder(pk.tokenizer_path())
    texts = ["one two three four", "five six seven!! Eight", "one, TWO; nine ten eleven twelve"]
    for t in texts + texts:
        assert e([t])[0] == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes()


def test_memory_of_a_worker_is_bounded_by_size(spark, tokenizer, monkeypatch):
    e = pk.Encoder(pk.tokenizer_path())
    long = ["x" * 90_000, "abc" * 5000 + "!", "short words, too"]
    for t, ids in zip(long, e(long)):
        assert ids == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes()
    assert max(map(len, [*e.words, *e.parts])) <= pk._LONGEST      # a word is not kept whatever its length
    monkeypatch.setattr(pk, "_AT_ONCE", 7)
    e = pk.Encoder(pk.tokenizer_path())
    monkeypatch.setattr(pk, "_MEMORY", 500)
    for i in range(0, 5000, 100):                                   # neither words nor stems grow beyond the bound
        e([f"w{j:x}{'abcdefghij'[j % 10]}" + "".join(chr(97 + int(c)) for c in str(j)) for j in range(i, i + 100)])
        assert len(e.words) <= 500 and len(e.parts) <= 500 + 2


def test_common_stems_outlive_the_memory_limit(tokenizer, monkeypatch):
    monkeypatch.setattr(pk, "_MEMORY", 50)
    e = pk.Encoder(pk.tokenizer_path())
    asked, ask = [], e._ask
    monkeypatch.setattr(e, "_ask", lambda stem: asked.append(stem) or ask(stem))
    new = ["".join("abcdefghij"[int(c)] for c in str(1000 + i)) for i in range(600)]
    for i in range(0, 600, 20):
        text = " ".join(["Always", "always,", *new[i:i + 20]])
        assert e([text])[0] == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
    assert asked.count("always") == 1 and len(e.parts) + len(e.older) <= 200


def test_capitals_beside_added_tokens(tokenizer):
    e = pk.Encoder(pk.tokenizer_path())
    for t in ["<|ENDOFTEXT|> HI", "<|endoftext|> HI", "HI <|EndOfText|>x It'S", "X" * 70 + "! Yes"]:
        assert e([t])[0] == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes()
