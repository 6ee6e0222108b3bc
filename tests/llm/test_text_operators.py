import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gridloom.llm import bpe, html, language, mixing, near_dedup, pii, quality, token_counts
from gridloom.llm.common import remainder, table
from gridloom.llm.components import connected

from . import brute

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string"
ODD = ["", "  \n", "ΑΣ ΣΑΣ Σ", "\x1c\x1dab\x1fc", "İ ẞ é 한국", "<|endoftext|>x <|startoftext|>'s it's", "a\x85b　c", "😀 👍🏽", "x" * 3000, "a b " * 3000, "½ ² १२३", "don't!!'t '''re"]


def docs_of(spark, texts, **columns):
    rows = [(i, t, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["s"] * len(texts))[i], 0, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def texts(spark, small):
    return [r["text"] for r in table(spark, small, "documents").orderBy("doc_id").limit(60).collect()]


# BPE and token counts


def test_bpe_equals_the_library(spark, library, texts):
    every = [*texts, *ODD, texts[0], None]
    docs = docs_of(spark, every)
    found = {r["doc_id"]: r for r in bpe.encode_decode(docs, VOCABULARY, ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"), lexicon_words=500).collect()}
    assert len(found) == len(every)
    for i, text in enumerate(every):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert list(found[i]["ids"]) == ids and found[i]["n_tokens"] == len(ids)
        assert found[i]["decoded"] == decoded
        assert found[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_and_token_counts_of_odd_tables(spark, library):
    hostile = ["x" * 1_000_000, "'" * 300_000, " " * 1_000_000, "<|endoftext|>" * 20_000, "é́" * 100_000, "a\n" * 300_000, "1" * 200_000]
    docs = docs_of(spark, [*hostile, "a b", "a b"])
    twice = docs.union(docs)
    found = bpe.encode_decode(twice.withColumnRenamed("size", "n_tokens"), VOCABULARY, ("n_tokens", "decoded_sha256"), ["doc_id", "n_tokens", "source"])
    assert found.columns == ["doc_id", "source", "n_tokens", "decoded_sha256"]
    counted = token_counts.count_tokens(twice, VOCABULARY)
    wanted = [len(library.encode(t, add_special_tokens=False).ids) for t in [*hostile, "a b", "a b"]]
    for rows in (found.collect(), counted.collect()):
        assert sorted((r["doc_id"], r["n_tokens"]) for r in rows) == sorted(2 * list(enumerate(wanted)))
    assert bpe.encode_decode(docs.limit(0), VOCABULARY).count() == token_counts.count_tokens(docs.limit(0), VOCABULARY).count() == 0


def test_token_count_calls_are_balanced_by_bytes():
    texts = ["漢字 " * 30_000, "a", "word " * 50_000, "é" * 100]
    calls = list(token_counts.balanced(texts, 1 << 16, 1 << 14))
    sizes = [sum(len(x.encode()) for x in call) for _, call in calls]
    assert max(sizes) < (1 << 16) + (1 << 15) and min(sizes[:-1]) >= 1 << 16
    assert ["".join(x for o, c in calls for own, x in zip(o, c, strict=True) if own == i) for i in range(4)] == texts


def test_lexicon_knows_its_words_only(tmp_path):
    words = {b"car": [1], b"cars": [2, 3], b"bar": [4], b"bars": [5], b"star": [6]}
    (tmp_path / "x").write_bytes(bpe.compile_lexicon(words))
    lexicon = bpe.Lexicon(str(tmp_path / "x"))
    asked = [*words, b"ca", b"carss", b"", b"zebra"]
    assert lexicon.look_up(asked) == [*words.values(), None, None, None, None]
    assert len(lexicon.final) < 1 + sum(map(len, words))  # suffixes share states
    (tmp_path / "y").write_bytes(bpe.compile_lexicon({}))
    assert bpe.Lexicon(str(tmp_path / "y")).look_up([b"a"]) == [None]


def test_merges_agree_one_by_one_and_together():
    merger = bpe.Merger(open(VOCABULARY, "rb").read())
    words = ["a", "the", "thanedble", "x" * 40, "x" * 400, "é", "ciónñue", "abcabcabcabc" * 3, "!!", "''"]
    assert merger.merge_all(words) == [merger.merge(w) for w in words]


def test_token_counts_equal_the_library(spark, library, texts):
    every = [*texts, *ODD, None]
    found = {r["doc_id"]: r for r in token_counts.count_tokens(docs_of(spark, every), VOCABULARY, limit=100).collect()}
    for i, text in enumerate(every):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[i]["n_tokens"], found[i]["n_bytes"], found[i]["over_limit"]) == (n, len((text or "").encode()), n > 100)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_of_other_vocabularies(spark, name, texts):
    path = public_tokenizers.path(name)
    every = [*texts[:10], "a b " * 30_000, ""]
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs_of(spark, every), path).collect()}
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        wanted = [len(x.ids) for x in Tokenizer.from_file(path).encode_batch(every, add_special_tokens=False)]
    else:
        import sentencepiece

        wanted = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(every)]
    assert [found[i] for i in range(len(every))] == wanted


# Mixing


def test_mixing_against_brute_force(spark, texts):
    every = [*texts, None, "", "one", *ODD]
    source = [["b", "a", None, "c", "é", "Z"][i * i % 6] for i in range(len(every))]
    found = {r["doc_id"]: r for r in mixing.mix(docs_of(spark, every, source=source)).collect()}
    for i, (size, total, target, taken) in brute.mixed(list(zip(range(len(every)), every, source, strict=True))).items():
        r = found[i]
        assert (r["size"], r["source_size"]) == (size, total)
        assert r["target"] == pytest.approx(target, rel=1e-12)
        assert r["taken"] == taken <= 3 * size


def test_mixing_stage_emits_what_is_taken(spark, texts):
    docs = docs_of(spark, texts, source=[f"s{i % 4}" for i in range(len(texts))])
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    out = mixing.mix_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == {i: n for i, n in taken.items() if n}


def test_mixing_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


# PII


def test_pii_values_change_within_their_format(spark):
    text = "a.b@x1.example.com +1 (743) 555-3824 card 4785380592391139 ip 152.143.123.131### 2020-02-29 31.12.1999 12/25/2001 078-05-1120 GB82 WEST 1234 5698 7654 32 +49 30 1234 5678"
    kept = "Version 2.0. BY-NC 4.0 4785380592391138 999.1.1.1 1.2.3.4.5 2020-02-30 000-12-3456 GB83 WEST 1234 5698 7654 32"
    docs = docs_of(spark, [text, kept, None, "", text + " again 4785 3805 9239 1139"])
    found = {r["doc_id"]: r for r in pii.pseudonymise(docs).collect()}
    first = found[0]
    assert [x["kind"] for x in first["pii_found"]] == ["email", "phone", "card", "ip", "date", "date", "date", "ssn", "iban", "phone"]
    for x in first["pii_found"]:
        assert x["value"] not in first["text"] and x["pseudonym"] in first["text"]
        shape = lambda s: re.sub(r"\d+" if x["kind"] == "ip" else r"\d", "9", re.sub("[a-z]", "a", s))  # noqa: B023, E731
        assert shape(x["value"]) == shape(x["pseudonym"])
    again = docs_of(spark, [first["text"]])
    assert [x["kind"] for x in pii.pseudonymise(again).first()["pii_found"]] == [x["kind"] for x in first["pii_found"]]  # still valid
    assert found[1]["text"] == kept and not found[1]["pii_found"]
    assert found[2]["text"] is None and found[3]["text"] == ""
    linked = {re.sub(r"\D", "", x["value"]): re.sub(r"\D", "", x["pseudonym"]) for x in found[4]["pii_found"] if x["kind"] == "card"}
    assert len(linked) == 1 and found[4]["size"] == "clash"


def test_feistel_is_a_permutation(spark):
    numbers = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = numbers.select(pii.permuted_digits(F.col("d"), F.lit("t"), "k").alias("p"))
    assert {r["p"] for r in out.collect()} == {f"{i:03d}" for i in range(1000)}


# Near-duplicates


def test_near_duplicates_against_brute_force(spark, texts):
    import random

    draw = random.Random(3)
    every = [t for t in texts if len(t.split()) < 400][:25]
    for t in every[:12]:
        for n in (1, 3, 8):
            words = t.split()
            for _ in range(n):
                words[draw.randrange(len(words))] = f"new{draw.random()}"
            every.append(" ".join(words))
    every += [every[0], every[0], "one two", "one two", "one two three", "", "", None, None, " \n"]
    found = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs_of(spark, every)).collect()}
    root = brute.classes(dict(enumerate(every)))
    assert [found[i]["class_id"] for i in range(len(every))] == [root[i] for i in range(len(every))]
    assert all(found[i]["is_first"] == (root[i] == i) for i in found)
    assert found[0]["class_size"] == sum(root[i] == 0 for i in range(len(every)))
    kept = near_dedup.near_dedup_stage(spark, docs_of(spark, every), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({root[i] for i in range(len(every))})


def test_repeated_rows_leave_one(spark):
    docs = docs_of(spark, ["a b c d e f", "x y"])
    twice = docs.union(docs)
    assert near_dedup.near_duplicates(twice).count() == 4
    assert sorted(near_dedup.near_dedup_stage(spark, twice, "").collect()) == sorted(docs.collect())
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_ids_that_repeat_or_are_null(spark):
    a, b = "one two three four five six seven eight", "quite another text with no word of the first in it"
    longer = " ".join(f"w{i}" for i in range(100))
    rows = [(1, a), (1, b), (2, longer), (3, longer + " more"), (None, "alone here with a null id"), (None, None), (7, None), (None, longer), (None, b)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, str(k)) for k, (i, t) in enumerate(rows)], DOCS)
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    keys = {r["class_key"] for r in found if r["class_id"] == 1}
    assert len(keys) == 2 and sorted(r["class_size"] for r in found if r["class_id"] == 1) == [1, 2, 2]
    assert sorted((r["class_id"], r["class_size"]) for r in found if r["class_id"] in (2, 3)) == [(2, 3)] * 3
    kept = sorted((r["doc_id"] or -1, r["text"] or "") for r in near_dedup.near_dedup_stage(spark, docs, "").collect())
    assert kept == sorted([(1, a), (1, b), (2, longer), (-1, "alone here with a null id"), (-1, ""), (7, "")])
    assert sum(r["is_first"] for r in found) == len(kept)


@pytest.mark.parametrize("copies", [12, 13, 100, 1000])
def test_groups_of_near_copies_of_any_size(spark, copies):
    import random

    draw = random.Random(copies)
    words = [f"w{draw.randrange(5000)}" for _ in range(120)]
    texts = ["a text by itself that shares nothing", " ".join(words)]
    for i in range(copies):
        own = list(words)
        own[draw.randrange(120)] = f"changed{i}"
        texts.append(" ".join(own))
    apart = [" ".join(words[:60] + [f"x{i}y{j}" for j in range(60)]) for i in range(5)]  # half in common, so no copies
    found = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs_of(spark, texts + apart)).collect()}
    assert {found[i]["class_id"] for i in range(1, copies + 2)} == {1} and found[5]["class_size"] == copies + 1
    assert found[0]["class_size"] == 1 and all(found[len(texts) + i]["class_size"] == 1 for i in range(5))


def test_every_pair_of_the_similarity_is_in_one_class(spark, small):
    """Recall: all pairs of the table's texts by brute force on word shingles."""
    texts = {r["doc_id"]: r["text"] for r in table(spark, small.replace("sf0.001", "sf0.01"), "documents").collect()}
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(table(spark, small.replace("sf0.001", "sf0.01"), "documents")).collect()}
    lists = {i: brute.labelled(t or "") for i, t in texts.items()}
    by_shingle = {}
    for i, own in lists.items():
        for x in set(own):
            by_shingle.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in by_shingle.values() for k, b in enumerate(ids) for a in ids[:k]}
    linked = 0
    for a, b in pairs:
        common = len(set(lists[a]) & set(lists[b]))
        if common >= 0.8 * (len(lists[a]) + len(lists[b]) - common):
            in_order = brute.common_in_order(lists[a], lists[b]) if lists[a] != lists[b] else common
            if in_order >= 0.8 * (len(lists[a]) + len(lists[b]) - in_order):
                linked += 1
                assert found[a] == found[b]
    assert linked > 10


def test_components_of_a_long_chain(spark):
    links = spark.range(60).selectExpr("id + 1 as a", "id as b").union(spark.createDataFrame([(100, 101)], "a long, b long"))
    found = {r["id"]: r["component"] for r in connected(links).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# Language and quality


def test_languages_of_held_out_documents(spark, small):
    docs = table(spark, small.replace("sf0.001", "sf0.01"), "documents")
    field = language.learn(docs, sample_docs=60)
    found = language.label_languages(docs, field, keep=["doc_id", "lang"]).where(remainder("doc_id", 3) == 1)
    right, n = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*")).first()
    assert n > 250 and right > 0.97
    odd = docs_of(spark, [None, "", "12 !! 3", "und die der", "und die " * 40_000])
    rows = language.label_languages(odd, field, with_words=True).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows] == ["und", "und", "und", "de", "de"]
    assert [r["lang_score"] for r in rows[:3]] == [0, 0, 0] and all(0 <= r["lang_score"] <= 1 for r in rows)
    mixed = "une la des pour dans est sur avec qui que les aux une des la " * 4 + "und die der ist mit nicht für auf eine ein als im dem den sich " * 4
    words = language.label_languages(docs_of(spark, [mixed]), field, with_words=True).first()["lang_words"]
    assert {w["lang"] for w in words} >= {"fr", "de"} and " ".join(w["words"] for w in words) == " ".join(mixed.split())


def test_forward_backward_against_enumeration():
    from itertools import product

    import numpy as np

    rng = np.random.default_rng(0)
    lengths, k = np.array([3, 0, 1, 4]), 3
    scores, moves = rng.standard_normal((lengths.sum(), k)), rng.standard_normal((k, k))
    marginals, moved = language.forward_backward(scores, lengths, moves)
    assert np.allclose(marginals, language.forward_backward_marginals(scores, lengths, moves))
    at, total = 0, np.zeros((k, k))
    for n in lengths:
        want, z = np.zeros((n, k)), 0.0
        pairs = np.zeros((k, k))
        for path in product(range(k), repeat=int(n)):
            p = np.exp(sum(scores[at + i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
            z += p
            for i, y in enumerate(path):
                want[i, y] += p
            for a, b in zip(path, path[1:], strict=False):
                pairs[a, b] += p
        assert np.allclose(marginals[at : at + n], want / z)
        total += pairs / z
        at += n
    assert np.allclose(moved, total)


def test_language_without_labels_and_stage(spark):
    docs = docs_of(spark, ["eins zwei", "123", None, "tres"], lang=[None] * 4)
    field = language.learn(docs)
    assert field.labels == [] and {r["lang_pred"] for r in language.label_languages(docs, field).collect()} == {"und"}
    kept = language.language_stage(spark, docs, "")
    assert {r["doc_id"]: r["lang"] for r in kept.collect()} == {0: None, 3: None}  # nothing to learn from is no reason to drop
    known = docs_of(spark, ["the of and", "123", None, "und die der", "the and of it"] * 4, lang=["en", "en", "en", "de", None] * 4)
    kept = language.language_stage(spark, known, "")
    assert kept.columns == known.columns and {r["doc_id"] % 5 for r in kept.collect()} == {0, 3, 4}
    assert {r["lang"] for r in kept.collect()} == {"en", "de"}  # null labels are filled in
    assert language.language_stage(spark, known.limit(0), "").count() == 0
    clash = known.withColumnRenamed("size", "lang_pred")
    assert sorted(language.language_stage(spark, clash, "").collect()) == sorted(kept.collect())
    assert language.label_languages(spark.createDataFrame([], DOCS), field).count() == 0


def test_seventy_labels_are_learnt_with_their_transitions():
    import numpy as np

    rng = np.random.default_rng(8)
    rows = [(f"l{i:02d}", " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + rng.integers(26))}" for _ in range(40))) for i in range(70) for _ in range(3)]
    field = language.train_field(rows)
    assert len(field.labels) == 70 and np.isfinite(field.transitions).all()
    assert field.transitions.min() < 0 < field.transitions.max()  # moves are expected as well as seen
    scores, moves = rng.standard_normal((30, 70)), rng.standard_normal((70, 70))
    _, moved = language.forward_backward(scores, np.array([10, 20]), moves)
    assert abs(moved.sum() - 28) < 1e-9


def test_language_of_each_document_by_hand(spark, small):
    """The chain's marginals in plain Python, a text after another, from the field's weights."""
    import numpy as np

    docs = table(spark, small, "documents")
    field = language.learn(docs, sample_docs=20)
    texts = {r["doc_id"]: r["text"] for r in docs.orderBy("doc_id").limit(40).collect()} | {-1: None, -2: "", -3: "12 . !", -4: "der 12 the"}
    odd = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r for r in language.label_languages(odd, field).collect()}
    k, moves = len(field.labels), np.exp(field.transitions)
    for i, text in texts.items():
        runs = (text or "").split()
        if not any(map(language.bare, runs)):
            assert (found[i]["lang_pred"], found[i]["lang_score"]) == ("und", 0)
            continue
        local, lettered = [], []
        for run in runs:
            word = language.bare(run)
            own = np.zeros(k)
            if word:
                _, bucket = language.hashed_features([word])
                own = field.weights[bucket].sum(axis=0) / np.sqrt(len(bucket))
            local.append(np.exp(own - own.max()))
            lettered.append(bool(word))
        ahead = [local[0] / local[0].sum()]
        for x in local[1:]:
            ahead.append((ahead[-1] @ moves) * x)
            ahead[-1] /= ahead[-1].sum()
        behind = [np.ones(k)]
        for x in local[:0:-1]:
            behind.append(moves @ (behind[-1] * x))
            behind[-1] /= behind[-1].sum()
        both = np.array([a * b / (a @ b) for a, b in zip(ahead, behind[::-1], strict=True)])
        mean = both[lettered].mean(axis=0)
        assert found[i]["lang_pred"] == field.labels[mean.argmax()] and abs(found[i]["lang_score"] - mean.max()) < 1e-5


def test_quality_of_each_document_by_hand(spark, small):
    """Passages, encoder, gated attention and score in plain Python, a text after another, from the model's weights."""
    import numpy as np

    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    model = quality.learn(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.orderBy("doc_id").limit(40).collect()} | {-1: None, -2: "", -3: "x"}
    found = {r["doc_id"]: r["quality_score"] for r in quality.score_quality(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()}
    p = model.p
    for i, text in texts.items():
        runs = (text or "").split()
        hidden, weight = [], []
        for at in range(0, max(1, len(runs)), 48):
            part = runs[at : at + 48]
            own = np.concatenate([
                quality.run_features(part).mean(axis=0) if part else np.zeros(8 + quality.SHAPES + quality.GRAMS),
                [len(set(part)) / max(1, len(part)), len(part) / 48],
            ])
            h = np.tanh((own - model.mean) / model.scale @ p["encode"] + p["encode_b"])
            hidden.append(h)
            weight.append((np.tanh(h @ p["attend"]) / (1 + np.exp(-(h @ p["gate"])))) @ p["weigh"])
        a = np.exp(np.array(weight) - max(weight))
        z = (a / a.sum()) @ np.array(hidden)
        assert abs(found[i] - 1 / (1 + np.exp(-(z @ p["judge"] + p["judge_b"])))) < 1e-4


def test_quality_of_ids_that_repeat_is_learnt_alike(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    more = docs.union(docs.withColumn("text", F.reverse("text")))
    one, two = quality.learn(more, labels, sample_docs=50), quality.learn(more.repartition(7), labels, sample_docs=50)
    assert all((one.p[x] == two.p[x]).all() for x in one.p)


def test_quality_of_held_out_documents(spark, small):
    root = small.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, root, "documents"), table(spark, root, "labels")
    model = quality.learn(docs, labels)
    found = quality.score_quality(docs, model, keep=["doc_id"]).join(labels, "doc_id").where(remainder("doc_id", 5) == 0)
    right, n = found.agg(F.avg((F.col("quality_label") == F.col("quality")).cast("double")), F.count("*")).first()
    assert n > 50 and right > 0.9
    odd = quality.score_quality(docs_of(spark, [None, "", "a", "a b " * 40_000]), model, with_passages=True).orderBy("doc_id").collect()
    assert odd[0]["quality_score"] == odd[1]["quality_score"] and all(0 <= r["quality_score"] <= 1 for r in odd)
    assert all(abs(sum(r["quality_attention"]) - 1) < 1e-9 for r in odd) and odd[0]["size"] == "clash"
    assert quality.score_quality(docs_of(spark, ["a"]), None).first()["quality_score"] == 0.5
    assert quality.score_quality(spark.createDataFrame([], DOCS), model).count() == 0


def test_quality_gradient_against_differences():
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(" ".join(rng.choice(["a", "B!!", "c,", "dd"], 120)), int(i % 2)) for i in range(8)]
    model = quality.train_bags(rows)
    split = [t.split() for t, _ in rows]
    numbers, features = quality.RunTable(quality.run_features).look_up(split)
    x, counts = quality.passages(numbers, np.array(list(map(len, split))), features)
    x, y = x.astype(float), np.array([q for _, q in rows], float)
    loss = lambda: -np.mean(np.log(np.where(y == 1, s := model.forward(x, counts)["score"], 1 - s)))
    gradient = model.gradient(x, counts, y)
    for name in ("encode", "attend", "gate", "weigh", "judge"):
        at = tuple(0 for _ in model.p[name].shape)
        old = model.p[name][at]
        model.p[name][at] = old + 1e-5
        up = loss()
        model.p[name][at] = old - 1e-5
        down = loss()
        model.p[name][at] = old
        assert gradient[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-8)


# HTML


PAGES = "page_id long, url string, html string, text string"


def test_articles_of_marked_pages(spark):
    page = (
        "<html><head><title>no</title></head><body><header><div>Site</div></header><nav><ul><li>menu</ul></nav><div class='cookie-notice'>We use</div><main><article class='post'>"
        "<header><h1>T &eacute;&amp;</h1></header><p>A <span class=ad>buy</span> b<br>c\n d<div class=share-buttons>x</div><form><input></form><ul><li>one<li>two</ul>"
        "<script>var t='</p>';</script><section id=comments><article class=comment>hi</article></section></article></main><aside>side</aside><footer>f</footer>"
    )
    rows = [(1, "http://a.example/1", page, "clash"), (2, None, None, ""), (3, "odd", "", ""), (4, "http://a.example/2", "plain &lt;b> text", ""), (4, "http://a.example/2", "plain &lt;b> text", "")]
    found = html.extract_articles(spark.createDataFrame(rows, PAGES)).orderBy("page_id").collect()
    assert [r["text"] for r in found] == ["T é&\nA b c d\none\ntwo", "", "", "plain <b> text", "plain <b> text"]
    assert [r["n_chars"] for r in found] == [len(r["text"]) for r in found]
    assert html.extract_articles(spark.createDataFrame([], PAGES)).count() == 0


def test_recurring_subtrees_go_and_articles_stay(spark):
    bar = "<div class=x1><p>Follow us everywhere</p></div>"
    own = lambda i: f"<body>{bar}<div><p>Story number {i} is told here at some length for readers.</p><p>It ends.</p></div></body>"
    rows = [(i, "http://b.example/", own(i), "") for i in range(12)] + [(100 + i, "http://c.example/", own(99), "") for i in range(12)] + [(200, "http://d.example/", own(7), "")]
    in_article = lambda i: f"<article><p>Same first line.</p><div class=q><p>Follow us</p></div><p>Story {i} with many words of its own.</p></article>"
    rows += [(300 + i, "http://e.example/", in_article(i), "") for i in range(12)]
    found = {r["page_id"]: r["text"] for r in html.extract_articles(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(found[i] == f"Story number {i} is told here at some length for readers." for i in range(12))  # a block on every page is template
    assert all("Follow" in found[100 + i] and "Story number 99" in found[100 + i] for i in range(12))  # copies of one page are no template
    assert "Story number 7" in found[200]
    assert all(found[300 + i] == f"Same first line.\nStory {i} with many words of its own." for i in range(12))


@pytest.mark.parametrize("page", ["<", "<p", "a<b", "<!-- x", "<script>x", "<div>" * 5000 + "x", "</p></div>x", '<a b="', "<title>t", "\x00<p>\x00"])
def test_broken_pages_do_not_fail(page):
    root = html.parse(page)
    html.hashed(root)
    parts = html.main_parts(root)
    html.candidates(root, parts)
    assert isinstance(html.article_text(parts, set(), parts == [root]), str)


@pytest.mark.parametrize(("page", "text"), [
    ("<body><div class='page-with-sidebar'><div class=sidebar><p>side</p></div><article class='post header-big'><h1>T</h1><p>long text here for all</p></article></div>", "T\nlong text here for all"),
    ("<body><div class='layout no-menu'><div class=menu><a>m</a></div><div class=content><p>The text is long enough here.</p></div></div>", "The text is long enough here."),
    ("<body><article><p>short</p><section class=comments><p>a very long comment that is much longer than the text itself</p></section></article>", "short"),
    ("<body><div class=comments><article><p>c</p></article></div><article><p>real</p></article>", "real"),
])
def test_layout_words_do_not_hide_an_article(page, text):
    root = html.parse(page)
    html.hashed(root)
    parts = html.main_parts(root)
    assert html.article_text(parts, set(), parts == [root]) == text
