"""BPE encoding and decoding: frequent words through a memory-mapped minimal automaton, the others merged exactly."""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
import uuid
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, shared_dir, sliced, stored, table
from .token_counts import pieces

LEXICON_WORDS = 65_536
CACHED_WORDS = 120_000
PIECE_CHARS = 1 << 20
LONG_WORD = 48
# The pattern of the vocabulary file in the two dialects used, and what counts as white space in it.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Merger:
    """The vocabulary file: exact merges of one word, and the words' decoded forms."""

    def __init__(self, model: bytes):
        spec = json.loads(model)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.ranks = {tuple(x) if isinstance(x, list) else tuple(x.split(" ")): i for i, x in enumerate(spec["model"]["merges"])}
        self.end = spec["model"]["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.byte_ids = np.array([self.ids[self.letters[b]] for b in range(256)])
        self.end_ids = np.array([self.ids[self.letters[b] + self.end] for b in range(256)])
        keys = np.array([self.ids[a] << 20 | self.ids[b] for a, b in self.ranks])
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order
        self.pair_ids = np.array([self.ids[a + b] for a, b in self.ranks])
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.pattern = regex.compile(WORD)
        self.odd_space = regex.compile(f"[{SPACE}]+")

    def merge(self, word: str) -> list[int]:
        """The ids of one normalised word: the pair of lowest rank, leftmost first, until none is left."""
        parts = [self.letters[b] for b in word.encode()]
        parts[-1] += self.end
        if len(parts) > LONG_WORD:
            return [self.ids[x] for x in self.merge_long(parts)]
        ranks, none = self.ranks, len(self.ranks)
        while len(parts) > 1:
            pairs = [ranks.get(x, none) for x in zip(parts, parts[1:], strict=False)]
            low = min(pairs)
            if low == none:
                break
            at = pairs.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[x] for x in parts]

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """The ids of many words at once: in each step every word makes its merge of lowest rank, leftmost first."""
        coded = [w.encode() for w in words]
        out: list[list[int]] = [[] for _ in words]
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(coded):
            by_length.setdefault(-(-len(w) // 4), []).append(i)
        for size, members in by_length.items():
            if 4 * size > LONG_WORD:
                merged = [self.merge(words[i]) for i in members]
            else:
                merged = self.merge_like([coded[i] for i in members])
            for i, ids in zip(members, merged, strict=True):
                out[i] = ids
        return out

    def merge_like(self, coded: list[bytes]) -> list[list[int]]:
        """`merge_all` of words of about the same length."""
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.frombuffer(b"".join(coded), np.uint8)
        width = int(lengths.max())
        places = np.arange(width)
        ids = np.zeros((len(coded), width + 1), np.int64)
        ids[:, :width][places < lengths[:, None]] = self.byte_ids[flat]
        rows = np.arange(len(coded))
        ids[rows, lengths - 1] = self.end_ids[flat[np.cumsum(lengths) - 1]]
        none = len(self.pair_ids)
        ranks = np.full((len(coded), width), none)
        inside = places < (lengths - 1)[:, None]
        ranks[inside] = self.rank_of(ids[:, :-1][inside], ids[:, 1:][inside])
        left = lengths.copy()
        live = rows
        while len(live):
            own = ranks[live]
            at = own.argmin(axis=1)
            rank = own[np.arange(len(live)), at]
            done = rank == none
            if done.any():
                live, at, rank = live[~done], at[~done], rank[~done]
                if not len(live):
                    break
            shifted = np.minimum(places + (places > at[:, None]), width)
            ids[live, :width] = np.take_along_axis(ids[live], shifted, axis=1)
            ids[live, at] = self.pair_ids[rank]
            kept = np.take_along_axis(np.concatenate([ranks[live], np.full((len(live), 1), none)], axis=1), shifted, axis=1)
            left[live] -= 1
            kept[np.arange(len(live)), at] = none
            ranks[live] = kept
            for near in (at - 1, at):
                ok = (near >= 0) & (near + 1 < left[live])
                who, where = live[ok], near[ok]
                ranks[who, where] = self.rank_of(ids[who, where], ids[who, where + 1])
        return [row[:n] for n, row in zip(left.tolist(), ids.tolist(), strict=True)]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], len(self.pair_ids))

    def merge_long(self, parts: list[str]) -> list[str]:
        """The same merges for a long word: pairs wait in a heap by rank and place."""
        ranks, n = self.ranks, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[x], i, x) for i, x in enumerate(zip(parts, parts[1:], strict=False)) if x in ranks]
        heapq.heapify(heap)
        live: list[str | None] = list(parts)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if live[i] != pair[0] or j >= n or live[j] != pair[1]:
                continue
            live[i], live[j] = pair[0] + pair[1], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (x := (live[left], live[right])) in ranks:
                    heapq.heappush(heap, (ranks[x], left, x))
        return [x for x in live if x is not None]

    def normal(self, text: str) -> str:
        """NFC, then each character's own lower case: a final sigma is no special case."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def split(self, text: str) -> list[str]:
        """The runs between white space as the file's pattern sees it; str.split also cuts at four control characters."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [x for x in self.odd_space.split(text) if x]
        return text.split()


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic transducer of ``words``: equal suffixes share their states.

    Words come in byte order, so each state is final once the next word leaves it: it is then replaced by its equal in
    the register or enters it. Arcs carry how many words end before those through the arc; their sum along a word is
    the word's number, which addresses its ids. The bytes hold numpy arrays one after the other.
    """
    root: dict = {"arcs": {}, "final": False}
    register: dict[tuple, int] = {}
    states: list[tuple[bool, list[tuple[int, int]]]] = []

    def settle(node: dict) -> int:
        key = (node["final"], tuple(node["arcs"].items()))
        if key not in register:
            register[key] = len(states)
            states.append((node["final"], list(node["arcs"].items())))
        return register[key]

    ordered = sorted(words)
    path, before = [root], b""
    for word in ordered:
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        while len(path) > common + 1:
            node = path.pop()
            path[-1]["arcs"][before[len(path) - 1]] = settle(node)
        for b in word[common:]:
            node = {"arcs": {}, "final": False}
            path[-1]["arcs"][b] = -1
            path.append(node)
        path[-1]["final"] = True
        before = word
    while len(path) > 1:
        node = path.pop()
        path[-1]["arcs"][before[len(path) - 1]] = settle(node)
    start = settle(root)

    below: list[int] = []  # words that end in or below a state; targets are settled before their sources
    keys, targets, skips = [], [], []
    for number, (final, arcs) in enumerate(states):
        seen = int(final)
        for b, target in sorted(arcs):
            keys.append(number << 8 | b)
            targets.append(target)
            skips.append(seen)
            seen += below[target]
        below.append(seen)
    ids = [words[w] for w in ordered]
    arrays = [
        np.array([f for f, _ in states], np.int64), np.array(keys, np.int64), np.array(targets, np.int64), np.array(skips, np.int64),
        np.cumsum([0, *map(len, ids)], dtype=np.int64), np.array([x for y in ids for x in y], np.int64),
    ]
    return np.concatenate([[start], [len(a) for a in arrays], *arrays]).astype("<i8").tobytes()


class Lexicon:
    """A compiled lexicon, memory-mapped: all executors' workers on a machine share its pages."""

    def __init__(self, path: str):
        whole = np.memmap(path, "<i8", mode="r")
        self.start, at = int(whole[0]), 7
        parts = []
        for n in whole[1:7]:
            parts.append(np.asarray(whole[at : at + int(n)]))
            at += int(n)
        self.final, self.keys, self.targets, self.skips, self.offsets, self.ids = parts

    def look_up(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, None for unknown ones; all words take a step at a time."""
        if not len(self.keys) or not words:
            return [None] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(words), np.uint8)
        begins = np.cumsum(lengths) - lengths
        state = np.full(len(words), self.start)
        number = np.zeros(len(words), np.int64)
        alive = order
        for step in range(int(lengths.max())):
            alive = alive[lengths[alive] > step]
            if not len(alive):
                break
            key = state[alive] << 8 | flat[begins[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            state[alive[~known]] = -1
            alive, at = alive[known], at[known]
            state[alive] = self.targets[at]
            number[alive] += self.skips[at]
        ok = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        low, high = self.offsets[number].tolist(), self.offsets[number + ok].tolist()
        ids = self.ids
        return [ids[a:b].tolist() if good else None for a, b, good in zip(low, high, ok.tolist(), strict=True)]


def frequent_words(docs: DataFrame, words: int) -> DataFrame:
    """(word): the most frequent normalised words of all texts, ``words`` at most.

    Counts are dealt into classes of an eighth of a power of two; the classes that fit are taken whole. So nothing is
    sorted and the driver sees a few hundred class sizes.
    """
    found = F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = stored(counts.where("n > 1").withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "word-counts")
    sizes = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.count("*").alias("n")).collect()}
    least, held = max(sizes, default=0) + 1, 0
    while least > 0 and held + sizes.get(least - 1, 0) <= words:
        least -= 1
        held += sizes.get(least, 0)
    return counts.where(F.col("class") >= least).select("word")


def publish_lexicon(docs: DataFrame, model: bytes, words: int = LEXICON_WORDS) -> str:
    """Compile the lexicon of ``docs`` and give it to every executor; returns the file's name there.

    ``words`` bounds what comes to the driver. Words that are not among them are merged by the workers.
    """
    spark = docs.sparkSession
    merger = Merger(model)
    found = {y for r in frequent_words(docs, words).toLocalIterator() for y in merger.pattern.findall(merger.normal(r["word"]))}
    listed = sorted(found)
    lexicon = {w.encode(): ids for w, ids in zip(listed, merger.merge_all(listed), strict=True)}
    name = f"lexicon-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(compile_lexicon(lexicon)))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


Entry = tuple[int, tuple[int, ...], str, str]


class Kept:
    """A cache of two generations: an entry of the older one that is asked for moves to the younger; when that is full
    it becomes the older one, and what was not asked for goes."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict[str, Entry] = {}
        self.old: dict[str, Entry] = {}

    def missing(self, keys: set[str]) -> list[str]:
        """Those of ``keys`` that are not kept; afterwards all others are in the younger generation."""
        if len(self.young) + len(keys) > self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        out = []
        for key in keys:
            if key not in young:
                if key in old:
                    young[key] = old[key]
                else:
                    out.append(key)
        return out


class WordEncoder:
    """Encodes and decodes runs between white space. A run's words, and the run, are worked out once while they are kept."""

    def __init__(self, merger: Merger, lexicon: Lexicon, outputs: tuple[str, ...], most: int = CACHED_WORDS):
        self.merger, self.lexicon = merger, lexicon
        self.numbers, self.texts, self.decoded = "ids" in outputs, "ids_sha256" in outputs, bool({"decoded", "decoded_sha256"} & set(outputs))
        self.runs, self.words = Kept(most), Kept(most)
        self.id_text = {i: str(i) for i in merger.tokens}
        self.special = {x: self.entry([i]) for x, i in merger.special.items()}

    def entry(self, ids: list[int]) -> Entry:
        id_text, tokens = self.id_text, self.merger.tokens
        return (
            len(ids), tuple(ids) if self.numbers else (), " ".join([id_text[i] for i in ids]) if self.texts else "",
            " ".join([tokens[i] for i in ids]) if self.decoded else "",
        )

    def learn(self, runs: set[str]) -> None:
        """Put all of ``runs`` into the younger generation."""
        m, whole, mixed = self.merger, {}, {}
        for run in self.runs.missing(runs):
            normal = m.normal(run)
            if normal.isalpha():
                whole[run] = normal
            elif "<|" not in run:
                mixed[run] = m.pattern.findall(normal)
            else:
                mixed[run] = [y for x in m.special_at.split(run) if x for y in ([x] if x in m.special else m.pattern.findall(m.normal(x)))]
        words = set(whole.values()).union(*mixed.values()).difference(m.special)
        unseen = []
        kept = self.words
        new = kept.missing(words)
        for word, ids in zip(new, self.lexicon.look_up([w.encode() for w in new]), strict=True):
            if ids is None:
                unseen.append(word)
            else:
                kept.young[word] = self.entry(ids)
        for word, ids in zip(unseen, m.merge_all(unseen), strict=True):
            kept.young[word] = self.entry(ids)
        entries, known = kept.young, self.runs.young
        for run, word in whole.items():
            known[run] = entries[word]
        for run, parts in mixed.items():
            own = [self.special.get(x) or entries[x] for x in parts]
            known[run] = own[0] if len(own) == 1 else (
                sum([x[0] for x in own]), tuple([i for x in own for i in x[1]]), " ".join([x[2] for x in own]), " ".join([x[3] for x in own])
            )

    def encode(self, texts: list[str]) -> Iterator[Iterator[list[Entry]]]:
        """For each text the entries of its runs, a bounded part of the text after another."""
        split: list[list[str] | None] = [self.merger.split(x) if len(x) <= PIECE_CHARS else None for x in texts]
        self.learn(set().union(*[x for x in split if x is not None]))
        known = self.runs.young
        whole = [None if x is None else [known[run] for run in x] for x in split]
        for text, entries in zip(texts, whole, strict=True):
            yield self.parts(text) if entries is None else iter([entries] if entries else [])

    def parts(self, text: str) -> Iterator[list[Entry]]:
        for piece in pieces(text, PIECE_CHARS):
            runs = self.merger.split(piece)
            self.learn(set(runs))
            if runs:
                yield [self.runs.young[x] for x in runs]


def calls(texts: list[str], size: int) -> Iterator[list[str]]:
    """``texts`` in lists of about ``size`` characters."""
    call: list[str] = []
    held = 0
    for text in texts:
        call.append(text)
        held += len(text)
        if held >= size:
            yield call
            call, held = [], 0
    yield call


OUTPUTS = {"ids": "array<int>", "decoded": "string", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_decode(
    docs: DataFrame, tokenizer_path: str, outputs: Sequence[str] = ("ids", "decoded"), keep: Sequence[str] = ("doc_id",),
    lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """The columns ``keep`` and, of ``outputs``: the ids of every whole text, the text that decodes from them, the
    number of ids, and digests of ids and decoded text.

    A null text counts as empty (no ids, decoded ""); repeated rows give repeated rows; an empty table gives an empty
    one; a column of ``keep`` that is named as an output gives way to it. The ids are those of the vocabulary file's normaliser, splitter and merges whether or not a word stands in the
    lexicon, which only saves time. After the count of words this is one narrow stage.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())  # a vocabulary file, of fixed size
    name = publish_lexicon(docs, model.value, lexicon_words)
    keep = [x for x in keep if x.lower() not in outputs]
    read = fresh(docs, "text_read")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(Merger(model.value), Lexicon(SparkFiles.get(name)), outputs)
        for whole in batches:
            for batch in sliced(whole, [read]):
                got: dict[str, list] = {x: [] for x in outputs}
                texts = pc.fill_null(batch.column(read), "").to_pylist()
                for encoded in (x for call in calls(texts, PIECE_CHARS) for x in encoder.encode(call)):
                    n, ids, id_hash, text_hash, decoded, first = 0, array("i"), hashlib.sha256(), hashlib.sha256(), [], True
                    for entries in encoded:
                        n += sum([x[0] for x in entries])
                        if "ids" in got:
                            for x in entries:
                                ids.extend(x[1])
                        if "ids_sha256" in got:
                            id_hash.update(("" if first else " ").encode() + " ".join([x[2] for x in entries]).encode())
                        if "decoded" in got or "decoded_sha256" in got:
                            part = " ".join([x[3] for x in entries])
                            if "decoded_sha256" in got:
                                text_hash.update(("" if first else " ").encode() + part.encode())
                            if "decoded" in got:
                                decoded.append(part)
                        first = False
                    one = {"ids": ids.tobytes(), "decoded": " ".join(decoded), "n_tokens": n, "ids_sha256": id_hash.hexdigest(), "decoded_sha256": text_hash.hexdigest()}
                    for x, values in got.items():
                        values.append(one[x])
                columns = [batch.column(x) for x in keep]
                for x, values in got.items():
                    if x == "ids":
                        offsets = np.cumsum([0, *(len(v) // 4 for v in values)])
                        flat = pa.array(np.frombuffer(b"".join(values), "<i4"), pa.int32())
                        columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat))
                    else:
                        columns.append(pa.array(values, pa.int64() if x == "n_tokens" else pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*keep, *outputs])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{x}` {kinds[x]}" for x in keep] + [f"{x} {OUTPUTS[x]}" for x in outputs])
    return docs.select(*[F.col(f"`{x}`") for x in keep], F.col("text").cast("string").alias(read)).mapInArrow(run, schema)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), ("n_tokens", "ids_sha256", "decoded_sha256"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as token ids: all columns but the text, the number of ids, the ids, and the digest of the text
    that decodes from them. Every row gives a row; a null text has no ids; an empty table stays empty."""
    import public_tokenizers

    keep = [x for x in docs.columns if x != "text"]
    return encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), ("n_tokens", "ids", "decoded_sha256"), keep)
