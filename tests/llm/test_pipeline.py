import pytest

import corpus_pipeline
from gridloom.llm import pii
from gridloom.llm.common import table

from . import brute

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(autouse=True)
def the_key(spark):
    spark.conf.set(pii.KEY_SETTING, brute.KEY)
    yield
    spark.conf.unset(pii.KEY_SETTING)


def test_pii_query_against_brute_force(spark, small):
    texts = {r["doc_id"]: r["text"] for r in table(spark, small.replace("sf0.001", "sf0.01"), "documents").collect()}
    found = pii.op4_pii(spark, small.replace("sf0.001", "sf0.01")).collect()
    assert len(found) == len(texts) and sum(r["n_found"] for r in found) > 50
    for r in found:
        assert r["text"] == brute.pseudonymised(texts[r["doc_id"]])


def test_pipeline_against_brute_force(spark, small):
    """Every stage in plain Python over the same documents; a text with a letter has a language."""
    from tokenizers import Tokenizer

    docs = {r["doc_id"]: (r["text"], r["source"]) for r in table(spark, small, "documents").collect()}
    docs = {i: (t, s) for i, (t, s) in docs.items() if t and any(c.isalpha() for c in t)}
    first = brute.classes({i: t for i, (t, _) in docs.items()})
    docs = {i: x for i, x in docs.items() if first[i] == i}
    rows = [(i, brute.pseudonymised(t), s) for i, (t, s) in docs.items()]
    taken = brute.mixed(rows)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = sorted((i, s, tuple(library.encode(t, add_special_tokens=False).ids)) for i, t, s in rows for _ in range(taken[i][3] // taken[i][0]))
    found = sorted((r["doc_id"], r["source"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, small).collect())
    assert found == wanted


def test_pipeline_of_odd_documents(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, a clashing column; and an empty table."""
    text = " ".join(f"word{i} and" for i in range(50))
    rows = [
        (1, text, "en", "a", 10, "x"), (1, text, "en", "a", 10, "x"), (2, text + " more", None, "a", None, None), (None, "ein Text mit Wörtern und mehr", None, None, None, None),
        (4, None, "de", "b", 0, "y"), (5, "", "de", "b", 0, "y"), (6, "12 34", "de", "b", 0, "y"), (7, "lang " * 100_000, "de", "b", 0, "y"), (8, "kurz und gut a@b.org", "de", None, 0, "y"),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, pii_found string"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} <= {1, None, 7, 8} and {r["lang"] for r in found} <= {"en", "de"} and found
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in found) and {r["pii_found"] for r in found} <= {"x", None, "y"}
    spark.createDataFrame([], names).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
