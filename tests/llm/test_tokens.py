"""Packing, SentencePiece and token counts against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from marquetry.llm import packing, sentencepieces, token_counts
from marquetry.llm.chunks import byte_bpe
from marquetry.llm.registry import vocabulary

BYTE, PIECE = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a", " a", "a  b", "a \n b\n\n c ", "x<|endoftext|> y  <|endoftext|>", "naïve x \x1c y", "日本語 テキスト 😀 á", "it's don't 's 'S.,;", "\t\ta b\r\n", "a" * 3000, " " * 100 + "x", "▁a ▁ b▁", "<s> </s> <unk> <0x0A>", "é\u0085 b", "a\x00b \x00", "\nfoo\nfoo", "日本\n語 x　 y", "same", "same"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    words = ["the", "Über", "of.", "naïve,", "\n", "x1", "<|endoftext|>", "don't", "  "]
    texts = ODD + [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(40)] + [" ".join(rng.choices(words, k=40_000))]
    return texts, spark.createDataFrame([(k, t, "junk", 5) for k, t in enumerate(texts)], "doc_id long, text string, ids string, task int").repartition(3)


def test_packing_loses_no_id(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE)
    texts, df = docs
    rows = packing.pack(df, BYTE, 256).collect()
    want = {k: [*library.encode(t or "", add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    pieces: dict = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.start == pieces.get(r.doc_id, 0) and len(ids) == r.length and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        pieces[r.doc_id] = r.start + r.length
    assert pieces == {k: len(v) for k, v in want.items()}
    fill: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert [fill[k] for k in sorted(fill)][:-1] == [256] * (len(fill) - 1) and fill[max(fill)] <= 256


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), BYTE).collect() == []


def test_sentencepiece(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts, df = docs
    for r in sentencepieces.digests(df, PIECE).collect():
        ids = library.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    both = {r.doc_id: r for r in sentencepieces.encode_decode(df, PIECE).collect()}
    assert len(both) == len(texts) and both[6].ids == library.encode("a  b", add_bos=True, add_eos=True) and both[6].decoded == "a  b"


def test_counts(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE)
    texts, df = docs
    for r in token_counts.token_counts(df, BYTE, chunk=500, overlap=16).collect():
        n = len(library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((texts[r.doc_id] or "").encode()), n > 1024)


@pytest.mark.parametrize("text", ["x" * 5000, "　" * 900 + "a b", "a " * 3000, "ab\n" * 2000, "é" * 3000, ("y" * 700 + " ") * 9])
def test_splices_widen(text):
    bpe = byte_bpe(BYTE)
    assert token_counts.count_spliced(bpe, text.encode(), 300, 8) == len(bpe.library.encode(text, add_special_tokens=False).ids)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sentencepieces.digests(none, PIECE).collect() == [] and token_counts.token_counts(none, BYTE).collect() == []


def test_special_strings_that_chunks_would_cut(tmp_path):
    import json

    from marquetry.llm.chunks import ByteBpe

    spec = json.loads(open(BYTE, encoding="utf-8").read())
    for change in ({"content": "<|a.b|>"}, {"lstrip": True}, {"content": "<| |>"}):
        added = [spec["added_tokens"][0] | change]
        path = tmp_path / "t.json"
        path.write_text(json.dumps(spec | {"added_tokens": added}))
        with pytest.raises(ValueError, match="special"):
            ByteBpe(str(path))
