import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.samples import empty_docs, hard_docs, hard_rows, prose
from timeward.llm import packing


def test_pieces_are_binary_digits():
    for n in range(1, 9000, 7):
        found = packing.pieces_of(n)
        assert sum(found) == n
        assert all(x <= 4096 and x & (x - 1) == 0 for x in found)
        assert found == sorted(found, reverse=True)
        assert sum(x < 4096 for x in found) == (n % 4096).bit_count()


def test_ids_come_back(spark):
    whole = Tokenizer.from_file(packing.default_vocabulary())
    docs = hard_docs(spark).withColumns({"length": F.lit("x"), "pieces": F.lit("y"), "place": F.monotonically_increasing_id()})
    packed = packing.pack(docs)
    assert packed.columns.count("length") == 1
    rows = packed.collect()
    assert {r["pieces"] for r in rows} == {"y"}
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    texts = {r["place"]: r["text"] for r in docs.select("place", "text").collect()}
    assert len(texts) == len(hard_rows())
    for place, text in texts.items():
        own = sorted((r for r in rows if r["place"] == place), key=lambda r: r["start"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own])
        want = whole.encode(text or "", add_special_tokens=False).ids + [2]
        assert ids.tolist() == want
        assert all(r["doc_tokens"] == len(want) and r["offset"] == 0 for r in own)
        assert all(r["length"] == len(r["ids"]) // 4 == 1 << r["bucket"] for r in own)
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()


@pytest.mark.parametrize(
    "text",
    [
        "Word, word. WORD! word?! word...", "l'été naïve ÀÉÎ ÿ Ÿ ß ẞ", "<|ENDOFTEXT|> <|EndOfText|>x", "a,., b.-c a--- (x) [y]; É, É. é É", "I'll don't we've 's 'S 'T", "a<|endoftext|>b <|startoftext|>",
        "é å", "ﬁ ΑΣ Σ İ ı K", "1,000.5 3rd x2y", "日本語 текст", " a b​c", "a\x85b\x1cc\x00d", "😀👍🏽", "×÷ a×b",
    ],
)
def test_words_encode_as_the_whole_text_does(text):
    whole = Tokenizer.from_file(packing.default_vocabulary())
    encoder = packing._encoder(packing.default_vocabulary())
    found = np.frombuffer(encoder.ids(text.encode()), "<u4").tolist()
    assert found == whole.encode(text, add_special_tokens=False).ids


def test_forgetting_and_slicing_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "_AT_ONCE", 300)
    monkeypatch.setattr(packing, "_CACHED", 40)
    encoder = packing._Encoder(packing.default_vocabulary())
    texts = [prose(k % 7, 30 * k) + ", x. y," for k in range(30)] + [r[1] or "" for r in hard_rows()]
    coded = encoder.whole.encode_batch(texts, add_special_tokens=False)
    found = encoder.encode([t.encode() for t in texts])
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [c.ids for c in coded]
    assert len(encoder.words.young) < 2000


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED", 3)
    encoder = packing._Encoder(packing.default_vocabulary())
    texts = ["one two three four five", "six one two, seven", "eight nine one"]
    whole = Tokenizer.from_file(packing.default_vocabulary())
    for text in texts * 2:
        assert np.frombuffer(encoder.ids(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_what_is_remembered_is_bounded_in_bytes(monkeypatch):
    """Long words count for what they take: a few of them fill the memory."""
    monkeypatch.setattr(packing, "_CACHED", 100_000)
    encoder = packing._Encoder(packing.default_vocabulary())
    for k in range(40):
        encoder.encode([" ".join(f"{chr(97 + k % 26)}{'xyz' * 500}{n}" for n in range(10)).encode()])
    held = {**encoder.words.old, **encoder.words.young}
    assert sum(len(w) + len(ids) for w, ids in held.items()) < 2 * 100_000 + 100_000


def test_buckets(spark, tmp_path):
    packed = packing.pack(hard_docs(spark).select("doc_id", "text"))
    packing.write_buckets(packed, str(tmp_path / "packed"))
    back = spark.read.parquet(str(tmp_path / "packed"))
    assert back.where("length <> pow(2, bucket)").count() == 0
    sizes = {r["bucket"]: r["ids"] for r in packing.bucket_sizes(packed).collect()}
    assert sum(sizes.values()) == packed.agg(F.sum("length")).first()[0]


def test_no_rows(spark):
    assert packing.pack(empty_docs(spark)).count() == 0
