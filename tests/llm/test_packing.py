"""Packing against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillcast.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", "   ", "Hello, World!!", "it's o'clock 'tis don't.", "a b c \x1c d\x85e",
    "É̀toile ÀÇ éa İSTANBUL ΣΑΣ ß", "12345 3.14 x1y2", "<|endoftext|> a<|startoftext|>. b",
    "word " * 3000, "!!! ... --- a.b.c, (d) [e]; {f}", "日本語 テキスト 中文。", "x" * 5000, "tab\tnew\nline\r\n",
]


def test_pieces_hold_every_id_once(documents):
    tokenizer = Tokenizer.from_file(PATH)
    given = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "no id")]
    rows = packing.pack(documents(given), packing.Packing(PATH)).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    by_row = {}
    for r in sorted(rows, key=lambda r: r.sequence_id):
        assert r.offset == 0 and r.length == 2**r.bucket <= 2048 and len(r.ids) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_row.setdefault(r.doc_id, []).append(r)
    for id, text in given:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = by_row[id]
        joined = [x for p in sorted(pieces, key=lambda p: (p.sequence_id)) for x in p.ids]
        assert joined == ids * (2 if id == 3 else 1)
        assert {p.doc_tokens for p in pieces} == {len(ids)}


def test_lengths_are_binary():
    assert packing.piece_lengths(1, 2048) == [1]
    assert packing.piece_lengths(2048 * 2 + 5, 2048) == [2048, 2048, 4, 1]
    assert packing.piece_lengths(2047, 2048) == [2**k for k in range(10, -1, -1)]


def test_words_are_forgotten_but_not_lost(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    tokenizer = Tokenizer.from_file(PATH)
    memory, method = packing.WordMemory(tokenizer), packing.Packing(PATH)
    for texts in (["one two three", "four"], ["five six one", ""], ["one six seven.", "four <|x|> ONE"], ["seven."]):
        ids, sizes = packing.ids_of([t.encode() for t in texts], memory, method)
        expected = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
        assert ids.tolist() == sum(expected, []) and sizes.tolist() == [len(e) for e in expected]
        assert len(memory.key) <= 5 + 6


def test_strings_of_words_equal_single_words(monkeypatch):
    """Special tokens, in either case and inside words, and strings of few words."""
    monkeypatch.setattr(packing, "STRING_WORDS", 3)
    tokenizer = Tokenizer.from_file(PATH)
    words = "a ab, <|endoftext|> <|ENDOFTEXT|> x<|endoftext|>y \x85 é ' 's don't <|pad|> ｡ zz\x1cz \u0345".split(" ")
    ids, sizes = packing.encoded([w.encode() for w in words], tokenizer, "<|endoftext|>")
    single = [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert ids.tolist() == sum(single, []) and sizes.tolist() == [len(s) for s in single]


def test_very_long_text_and_clashing_columns(documents, monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    long = "A long text, " * 120_000
    docs = documents([(1, long), (2, "b"), (3, None)]).withColumnRenamed("size", "Length")
    docs = docs.withColumnRenamed("source", "sequence_id").withColumnRenamed("lang", "bucket")
    rows = packing.pack(docs, packing.Packing(PATH), with_ids=False).collect()
    expected = len(tokenizer.encode(long, add_special_tokens=False).ids) + 1
    assert sum(r.length for r in rows if r.doc_id == 1) == expected
    assert [r.length for r in rows if r.doc_id == 3] == [1]
    with pytest.raises(ValueError, match="no token"):
        packing.pack(docs, packing.Packing(PATH, parting="<|nothing|>"))


def test_empty_table_and_buckets(spark, documents, tmp_path):
    method = packing.Packing(PATH)
    assert packing.pack(documents([]), method).collect() == []
    pieces = packing.pack(documents([(1, "a b c")]), method)
    packing.write_buckets(pieces, str(tmp_path / "b"))
    assert {r.bucket for r in spark.read.parquet(str(tmp_path / "b")).collect()} == {2}


def test_pipeline_numbers_sequences_in_the_order_of_several_files(spark, documents, tmp_path):
    import corpus_pipeline

    rows = documents([(i, " ".join(f"w{i * 977 + j}" for j in range(3 + 40 * i))) for i in range(40)])
    path = str(tmp_path / "mixed")
    rows.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    docs = spark.read.parquet(path)
    assert len(docs.inputFiles()) > 1
    pieces = corpus_pipeline.packed(spark, docs, "").collect()
    ids = [p.doc_id for p in sorted(pieces, key=lambda p: p.sequence_id)]
    assert set(ids) == set(range(40)) and ids == sorted(ids)
