import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from gridloom.llm import collocations
from gridloom.llm.registry import QUERIES, SQL

from .. import against_duckdb

DOCS = "doc_id long, text string, lang string, phrase string, n string"


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split(r"[\x20\x09]+", piece) if w] for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded)]


def brute(rows, least, first):
    out = []
    for lang in {"und" if r[2] is None else r[2] for r in rows}:
        pieces = [p for r in rows if ("und" if r[2] is None else r[2]) == lang for p in words_of(r[1])]
        f = Counter(tuple(p[i : i + m]) for p in pieces for m in range(1, 5) for i in range(len(p) - m + 1))
        n = sum(map(len, pieces))
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def made_up(n, seed=4):
    draw = random.Random(seed)
    words = ["the", "THE", "cat", "é", "Été", "x\x1cy", "-", "的", "a's", "rare"]
    text = lambda: "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " the cat "]) for _ in range(draw.randint(0, 30)))
    return [(i % 7, draw.choice([None, "", "...", text(), text(), text(), "same line the cat sat"]), draw.choice(["en", "fr", None, "und", ""]), "clash", "clash") for i in range(n)]


def test_against_sql(spark, small):
    against_duckdb.check(spark, small, QUERIES["op11_collocations"], SQL["op11_collocations"])


@pytest.mark.parametrize("least,first", [(1, 2000), (5, 7)])
def test_odd_texts_ties_and_few_ranks(spark, least, first):
    rows = made_up(160)
    got = collocations.collocations(spark.createDataFrame(rows, DOCS), least=least, first=first).collect()
    assert sorted(map(tuple, got)) == brute(rows, least, first)


def test_one_language_and_one_long_text_hold_most(spark):
    rows = [(1, "a b c d " * 60_000, "en", "", ""), (2, "a b. " * 40, "en", "", ""), *made_up(20)]
    got = collocations.collocations(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 30, 2000)


def test_empty_and_wordless_tables(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, "en", "", ""), (2, " .\n", None, "", "")], DOCS)).collect() == []


def test_windows_are_the_same_however_much_is_held(monkeypatch):
    """Counting within a text, and texts in many parts, change no window."""
    rows = made_up(50)
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([r[1] or "" for r in rows])], ["lang", "text"])

    def windows():
        out = Counter()
        for lang, columns, names in collocations.Words(4).of_batches(iter([batch])):
            out.update((lang, *[names[i] if i else b"" for i in w]) for w in columns.T.tolist())
        return out

    whole = windows()
    assert sum(whole.values()) == sum(len(p) for r in rows for p in words_of(r[1]))
    monkeypatch.setattr(collocations, "HELD_WORDS", 5)
    monkeypatch.setattr(collocations, "PART_BYTES", 9)
    assert windows() == whole
