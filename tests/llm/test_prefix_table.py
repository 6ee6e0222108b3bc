import hashlib
import random

import numpy as np
import pytest

from gridloom.llm import prefix_table

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "\n", " \n ", "a  b", "   a", "▁▁x ▁", "<s>x</s><0x41>", "İ ẞ é 한국 😀 👍🏽 ", "aaaa" * 50, " " * 100, "\t\t a", "a\x00b", "_.,__, ._",
    "日本語のテキスト、テスト。", "a" * 7 + " " * 33 + "b", "�", "x\x85y", "1234567890" * 5, "don't!!'t", "á.b,c",
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 7) for i, t in enumerate(texts)], "doc_id long, text string, decoded string, n_tokens int")


def hostile(library, n):
    draw = random.Random(3)
    signs = [" ", " ", "▁", "a", "th", "e", "in", "\n", "_", ".", ",", "é", "的", "😀", "\t", "0", "ing", "tion", "S", "'"]
    pieces = [library.id_to_piece(i) for i in range(259, library.vocab_size())]
    out = ["".join(draw.choices(signs, k=draw.randint(1, 60))) for _ in range(n)]
    return out + ["".join(draw.choices(pieces, k=draw.randint(1, 8))).replace("▁", " ") for _ in range(n)]


def test_ids_and_decoded_texts_are_the_librarys(spark, small, library):
    from gridloom.llm.common import table

    texts = [r["text"] for r in table(spark, small, "documents").select("text").collect()]
    every = [*texts, *ODD, *hostile(library, 1500), texts[0]]
    got = prefix_table.encode_decode(docs_of(spark, every), MODEL, ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"), ["doc_id", "n_tokens"])
    assert got.columns == ["doc_id", "ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"]
    found = {r["doc_id"]: r for r in got.collect()}
    assert len(found) == len(every)
    for i, text in enumerate(every):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        decoded, r = library.decode(ids), found[i]
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids) and r["decoded"] == decoded
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_texts_of_a_megabyte(spark, library):
    long = ["x" * 300_000, " " * 1_100_000, ("word another, " * 90_000)[: 1 << 20] + " tail", "é的" * 200_000 + " end", "a\n" * 600_000]
    for r in prefix_table.encode_decode(docs_of(spark, long), MODEL, ("n_tokens", "ids_sha256", "decoded_sha256")).collect():
        ids = library.encode(long[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_parts_of_a_long_text_are_as_the_whole(monkeypatch, library):
    """Cuts between parts change no id."""
    monkeypatch.setattr(prefix_table, "PART_CHARS", 7)
    with open(MODEL, "rb") as f:
        encoder = prefix_table.Encoder(prefix_table.Pieces(f.read()))
    texts = [x for x in hostile(library, 400) if x]
    for text, encoded in zip(texts, encoder.encode(texts), strict=True):
        made = list(encoded)
        assert np.frombuffer(b"".join(x for x, _ in made), "<i4").tolist() == library.encode(text)
        assert "".join(x for _, x in made)[1:] == library.decode(library.encode(text))


def test_ids_of_any_make_are_decoded(spark, library):
    draw = random.Random(5)
    rows = [(i, [draw.randrange(library.vocab_size()) if i % 2 else draw.randrange(259) for _ in range(draw.randint(0, 12))]) for i in range(600)] + [(600, None), (601, [1, 35, 2]), (602, [0, 0, 300]), (603, [1, 29871, 0])]
    for r in prefix_table.decode(spark.createDataFrame(rows, "k int, ids array<int>"), MODEL).collect():
        assert r["decoded"] == (None if r["ids"] is None else library.decode(list(r["ids"])))


def test_the_empty_table_and_other_models(spark, tmp_path):
    assert prefix_table.encode_decode(docs_of(spark, []), MODEL).collect() == []
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        spec.ParseFromString(f.read())
    spec.trainer_spec.byte_fallback = False
    with pytest.raises(ValueError, match="byte fallback"):
        prefix_table.Pieces(spec.SerializeToString())
