"""Token counts: batch encoding inside Arrow functions that return lengths only."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, table

BATCH_BYTES = 1 << 20
PIECE_BYTES = 1 << 16
LIMIT = 2048
CACHED_RUNS = 400_000
ASCII_SPACE = dict.fromkeys(map(ord, "\t\n\r\x0b\x0c"), " ")


def utf8_size(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def pieces(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of about ``size`` bytes, cut before a space or line feed.

    No word, no special string and no composed character reaches across white space, so the parts' counts add up. A
    text without white space stays whole.
    """
    at, size = 0, max(1, size * len(text) // max(1, utf8_size(text)))  # as many characters as have so many bytes
    while len(text) - at > size:
        cut = max(text.rfind(" ", at + 1, at + size), text.rfind("\n", at + 1, at + size))
        if cut < 0:
            after = [x for x in (text.find(" ", at + size), text.find("\n", at + size)) if x > 0]
            if not after:
                break
            cut = min(after)
        yield text[at:cut]
        at = cut
    yield text[at:]


def balanced(texts: list[str], batch_bytes: int, piece_bytes: int | None) -> Iterator[tuple[list[int], list[str]]]:
    """(which text, its part) in calls of about ``batch_bytes`` bytes of UTF-8."""
    owners: list[int] = []
    call: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        for piece in pieces(text, piece_bytes) if piece_bytes and len(text) * 4 > piece_bytes and utf8_size(text) > piece_bytes else (text,):
            owners.append(i)
            call.append(piece)
            held += utf8_size(piece)
            if held >= batch_bytes:
                yield owners, call
                owners, call, held = [], [], 0
    if call:
        yield owners, call


def encoder_of(model: bytes, is_json: bool) -> Callable[[list[str]], list[int]]:
    """The library's batch encoding of a vocabulary file, lengths only."""
    if is_json:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_str(model.decode())
        encoder.no_truncation()
        encoder.no_padding()
        return lambda texts: [len(x) for x in encoder.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    return lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)]


def drops_space(model: bytes) -> bool:
    """Whether the file's normaliser makes one space of white space and its splitter keeps no space: then the tokens of
    a text are those of its runs between white space, one after another."""
    spec = json.loads(model)
    first = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    collapsed = any(x["type"] == "Replace" and x["pattern"] == {"Regex": "\\s+"} and x["content"] == " " for x in steps)
    pattern = first.get("pattern", {}).get("Regex", " ")
    return collapsed and first.get("behavior") == "Removed" and bool(first.get("invert")) and " " not in pattern and "\\s+" not in pattern


def runs_of(text: str) -> list[str]:
    """The runs between ASCII white space; other white space stays inside a run, which the encoder splits itself."""
    return text.translate(ASCII_SPACE).split(" ") if any(c in text for c in "\t\n\r\x0b\x0c") else text.split(" ")


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = LIMIT,
    batch_bytes: int = BATCH_BYTES,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text; a null text counts as empty (0, 0, false).

    One narrow stage without a shuffle: each Arrow batch is dealt into calls of about ``batch_bytes``, so that one long
    text does not stand in a call with thousands of short ones; texts over ``piece_bytes`` are cut at white space
    (``tokenizers`` files only: a sentencepiece model joins words by white space and gets whole texts). Where the file
    drops white space, every boundary between words is safe, and a run that recurs is encoded once as long as its
    length stays in a bounded cache. Repeated rows give repeated rows; an empty table gives an empty one; other columns
    are not read.
    """
    with open(tokenizer_path, "rb") as f:
        content = f.read()
    model = docs.sparkSession.sparkContext.broadcast(content)  # a vocabulary file, of fixed size
    is_json = tokenizer_path.endswith(".json")
    by_run = is_json and drops_space(content)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder_of(model.value, is_json)
        known: dict[str, int] = {}
        for whole in batches:
            for batch in sliced(whole, ["text"]):
                texts = pc.fill_null(batch.column("text"), "")
                totals = [0] * batch.num_rows
                for owners, call in balanced(texts.to_pylist(), batch_bytes, piece_bytes if is_json else None):
                    if by_run:
                        split = [runs_of(x) for x in call]
                        runs = set().union(*split)
                        new = [x for x in runs if x not in known]
                        if len(known) + len(new) > CACHED_RUNS:
                            known.clear()
                            new = list(runs)
                        known.update(zip(new, count(new), strict=True))
                        found = [sum(map(known.__getitem__, x)) for x in split]
                    else:
                        found = count(call)
                    for owner, n in zip(owners, found, strict=True):
                        totals[owner] += n
                n_bytes = pc.cast(pc.binary_length(texts), pa.int64())
                n_tokens = pa.array(totals, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), n_bytes, n_tokens, pc.greater(n_tokens, limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lengths, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
