"""Language ID: a linear-chain conditional random field labels the words of a text by forward-backward."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, remainder, sliced, table
from .runs import RunTable

UNDETERMINED = "und"
#: The bound of the labelled sample: about so many documents of a language, chosen by a hash of their ids.
SAMPLE_DOCS = 300
BUCKETS = 1 << 17
LONGEST_NGRAM = 4
SEQUENCES, SEQUENCE_WORDS, SEGMENT_WORDS = 3000, 48, 16
EPOCHS, BATCH, RATE, DECAY = 4, 128, 0.5, 1e-6


def bare(run: str) -> str:
    """The letters of a run, lower-cased."""
    return run.lower() if run.isalpha() else "".join(filter(str.isalpha, run.lower()))


def hashed_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature: n-grams of the marked word, of which those with a mark are its affixes,
    and the whole word, by which the weights hold a lexicon."""
    marked = [f"^{w}$" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(lengths)
    word_of = np.repeat(np.arange(len(words)), lengths)
    left = ends[word_of] - np.arange(len(codes))  # characters from here to the word's end
    owners, found = [], []
    h = np.zeros(len(codes), np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    for n in range(1, LONGEST_NGRAM + 1):
        h[: len(codes) - n + 1] = (h[: len(codes) - n + 1] ^ codes[n - 1 :]) * factor + np.uint64(n)
        at = np.flatnonzero(left >= n)
        owners.append(word_of[at])
        found.append(h[at])
    power = np.cumprod(np.full(int(lengths.max(initial=0)), 0xD6E8FEB86659FD93, np.uint64))
    begins = ends - lengths
    placed = (codes + np.uint64(1)) * power[np.arange(len(codes)) - begins[word_of]]
    if len(words):
        owners.append(np.arange(len(words)))
        found.append(np.add.reduceat(placed, begins))
    mixed = np.concatenate(found) * np.uint64(0xBF58476D1CE4E5B9)
    return np.concatenate(owners), ((mixed ^ (mixed >> np.uint64(29))) * factor >> np.uint64(47)).astype(np.int64) % BUCKETS


@dataclass
class Field:
    """What is learnt: the labels, a weight for each bucket and label, a weight for each transition."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, runs: list[str]) -> np.ndarray:
        """A row for each run: the labels' scores, then whether the run has a letter; runs without one score 0."""
        n, k = len(runs), len(self.labels)
        words = [bare(x) for x in runs]
        out = np.zeros((n, k + 1), np.float32)
        lettered = np.flatnonzero(np.fromiter(map(bool, words), bool, n))
        if len(lettered):
            owner, bucket = hashed_features([words[i] for i in lettered])
            size = np.bincount(owner, minlength=len(lettered))
            for j in range(k):
                out[lettered, j] = np.bincount(owner, self.weights[bucket, j], len(lettered)) / np.sqrt(size)
            out[lettered, k] = 1
        return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginal of each label at each place, sum over places of the marginals of each transition).

    ``scores`` has the places of all sequences one after another. All sequences take a step at a time, the longest
    first, so those that have ended fall off the end; each step's messages are scaled to sum to 1.
    """
    k = transitions.shape[0]
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    longest = lengths[order]
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
    moves = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(local), np.ones_like(local)
    steps = int(longest.max(initial=0))
    live = [int(np.searchsorted(-longest, -t, side="left")) for t in range(steps + 1)]  # sequences longer than t
    message = None
    for t in range(steps):
        n = live[t] if t else int((longest > 0).sum())
        at = begins[:n] + t
        message = local[at] if message is None else (message[:n] @ moves) * local[at]
        message /= message.sum(axis=1, keepdims=True)
        forward[at] = message
    for t in range(steps - 2, -1, -1):
        at = begins[: live[t + 1]] + t
        message = (backward[at + 1] * local[at + 1]) @ moves.T
        backward[at] = message / message.sum(axis=1, keepdims=True)
    both = forward * backward
    both /= both.sum(axis=1, keepdims=True)
    last = np.zeros(len(scores), bool)
    last[(np.cumsum(lengths) - 1)[lengths > 0]] = True
    here = np.flatnonzero(~last)
    # The marginal of a move from a to b at a place is left[a] * moves[a, b] * right[b] over their sum; the sum over all
    # places is one product of matrices, whatever the number of labels.
    left, right = forward[here], local[here + 1] * backward[here + 1]
    whole = np.einsum("ij,ij->i", left @ moves, right)
    return both, moves * ((left / whole[:, None]).T @ right)


def train_field(rows: list[tuple[str, str]], seed: int = 7) -> Field:
    """Learn from (language, text) of the sample.

    A document's label is that of its words. Sequences are put together from segments of different documents, so that
    transitions between languages occur and get weights; the likelihood's gradient comes from forward-backward.
    """
    labels = sorted({x for x, _ in rows})
    k = len(labels)
    field = Field(labels, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k)))
    if k < 2:
        return field
    rng = np.random.default_rng(seed)
    by_label: list[list[list[str]]] = [[] for _ in labels]
    for label, text in rows:
        words = [w for w in map(bare, text.split()) if w]
        if words:
            by_label[labels.index(label)].append(words)
    usable = [i for i, x in enumerate(by_label) if x]
    if len(usable) < 2:
        return field
    sequences: list[tuple[list[str], list[int]]] = []
    for _ in range(SEQUENCES):
        words: list[str] = []
        truth: list[int] = []
        while len(words) < SEQUENCE_WORDS:
            label = usable[rng.integers(len(usable))]
            doc = by_label[label][rng.integers(len(by_label[label]))]
            start = rng.integers(len(doc))
            part = doc[start : start + 1 + rng.integers(2 * SEGMENT_WORDS)]
            words += part
            truth += [label] * len(part)
        sequences.append((words, truth))
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for words, _ in sequences for w in words))}
    owner, bucket = hashed_features(list(vocabulary))
    sort = np.argsort(owner, kind="stable")
    bucket, ends = bucket[sort], np.cumsum(np.bincount(owner, minlength=len(vocabulary)))
    seen_w, seen_t = np.full((BUCKETS, k), 1e-6, np.float32), np.full((k, k), 1e-6)
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(sequences)), max(1, len(sequences) // BATCH)):
            ids = np.array([vocabulary[w] for i in batch for w in sequences[i][0]])
            truth = np.array([y for i in batch for y in sequences[i][1]])
            lengths = np.array([len(sequences[i][0]) for i in batch])
            counts = ends[ids] - np.concatenate([[0], ends])[ids]
            place = np.repeat(np.arange(len(ids)), counts)
            inner = np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)
            features = bucket[np.repeat(ends[ids] - counts, counts) + inner]
            scale = 1 / np.sqrt(counts)
            scores = np.stack([np.bincount(place, field.weights[features, j], len(ids)) for j in range(k)], axis=1) * scale[:, None]
            marginals, moved = forward_backward(scores, lengths, field.transitions)
            error = -marginals
            error[np.arange(len(ids)), truth] += 1
            error *= scale[:, None]
            touched, inverse = np.unique(features, return_inverse=True)
            gradient = np.stack([np.bincount(inverse, error[place, j], len(touched)) for j in range(k)], axis=1) / len(batch)
            gradient -= DECAY * field.weights[touched]
            seen_w[touched] += gradient**2
            field.weights[touched] += RATE * gradient / np.sqrt(seen_w[touched])
            last = np.zeros(len(ids), bool)
            last[np.cumsum(lengths) - 1] = True
            here = np.flatnonzero(~last)
            observed = np.bincount(truth[here] * k + truth[here + 1], minlength=k * k).reshape(k, k)
            gradient_t = (observed - moved) / len(batch)
            seen_t += gradient_t**2
            field.transitions += RATE * gradient_t / np.sqrt(seen_t)
    return field


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, column: str = "lang") -> Field:
    """A field from about ``sample_docs`` documents of each value of ``column``, chosen by a hash of the id; documents
    whose crc32(doc_id) mod 3 is 1, without text or without a label are never learnt from."""
    usable = docs.where((remainder("doc_id", 3) != 1) & F.col(column).isNotNull() & F.col("text").isNotNull())
    counts = {r[column]: r["n"] for r in usable.groupBy(column).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train_field([])
    share = F.element_at(F.create_map(*[x for c, n in counts.items() for x in (F.lit(c), F.lit(min(1.0, sample_docs / n)))]), F.col(column))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.where(drawn < share).select("doc_id", column, "text").orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample_docs * len(counts))
    return train_field([(r[column], r["text"]) for r in sample.toLocalIterator()])


def label_languages(docs: DataFrame, field: Field, with_words: bool = False, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with lang_pred, lang_score and lang_has_letter, and with ``with_words`` lang_words, an array of (lang,
    words), the runs of words of one most likely language.

    The prediction is the language with the largest mean marginal over the words, the score is that mean. A text that
    is null, empty or without a letter is "und" with score 0, as is every text of a field that has learnt no label.
    Texts are read whole; rows are independent of each other, so repeated rows agree; an empty table gives an empty one;
    no shuffle. Columns of these names in ``docs`` are overwritten; ``prefix`` gives the new ones other names.
    """
    model = docs.sparkSession.sparkContext.broadcast(field)  # BUCKETS weights a language
    names = [prefix + x for x in ["lang_pred", "lang_score", "lang_has_letter"] + ["lang_words"] * with_words]
    kept = [c for c in keep or docs.columns if c.lower() not in names]
    base = docs.select(*[F.col(f"`{c}`") for c in kept], *["text"] * ("text" not in kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = model.value
        k = len(field.labels)
        runs = RunTable(field.emissions)
        for batch in (x for whole in batches for x in sliced(whole, ["text"])):
            split = [(x or "").split() for x in batch.column("text").to_pylist()]
            lengths = np.fromiter(map(len, split), np.int64, len(split))
            numbers, rows = runs.look_up(split)
            lettered = rows[numbers, k].astype(np.float64)
            owner = np.repeat(np.arange(len(split)), lengths)
            letters = np.bincount(owner, lettered, len(split))
            best, score, at = np.zeros(len(split), np.int64), np.zeros(len(split)), np.zeros(0, np.int64)
            if k:
                marginals = forward_backward_marginals(rows[numbers, :k], lengths, field.transitions)
                mean = np.stack([np.bincount(owner, marginals[:, j] * lettered, len(split)) for j in range(k)], axis=1)
                mean = mean / np.maximum(letters, 1)[:, None]
                best, at = mean.argmax(axis=1), marginals.argmax(axis=1)
                score = np.where(letters > 0, mean.max(axis=1), 0.0)
            named = [field.labels[b] if k and n else UNDETERMINED for b, n in zip(best, letters, strict=True)]
            columns = [*batch.select(kept).columns, pa.array(named, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(letters > 0)]
            if with_words:
                columns.append(pa.array(list(language_runs(split, lengths, at, field.labels)), pa.list_(pa.struct([("lang", pa.string()), ("words", pa.string())]))))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    kinds = ["string", "double", "boolean", "array<struct<lang:string,words:string>>"]
    types = dict(docs.dtypes) | dict(zip(names, kinds, strict=False))
    schema = ", ".join(f"`{c}` {types[c]}" for c in [*kept, *names])
    return base.mapInArrow(run, schema)


def forward_backward_marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The marginals of `forward_backward` alone, in places of time rather than of sequence order."""
    k = transitions.shape[0]
    order = np.argsort(-lengths, kind="stable")
    longest = lengths[order]
    steps = int(longest.max(initial=0))
    live = np.searchsorted(-longest, -np.arange(1, steps + 1), side="right")  # sequences that reach step t
    # Lay the places out by step, so that each step reads and writes one contiguous block.
    starts = np.concatenate([[0], np.cumsum(live)])
    begins = np.cumsum(lengths) - lengths
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    within = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
    place = starts[within] + np.repeat(rank, lengths)
    local = np.empty((len(place), k))
    local[place] = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    moves = np.exp(transitions - transitions.max())
    forward = local.copy()
    for t in range(steps):
        block = forward[starts[t] : starts[t + 1]]
        if t:
            block *= forward[starts[t - 1] : starts[t - 1] + len(block)] @ moves
        block /= block.sum(axis=1, keepdims=True)
    backward = np.ones((live[0] if steps else 0, k))
    for t in range(steps - 2, -1, -1):
        n = live[t + 1]
        block = local[starts[t + 1] : starts[t + 2]] * backward[:n]
        block = block @ moves.T
        backward[:n] = block / block.sum(axis=1, keepdims=True)
        forward[starts[t] : starts[t] + n] *= backward[:n]
    forward /= forward.sum(axis=1, keepdims=True)
    return forward[place]


def language_runs(split: list[list[str]], lengths: np.ndarray, at: np.ndarray, labels: list[str]):
    for words, begin in zip(split, np.cumsum(lengths) - lengths, strict=True):
        own = at[begin : begin + len(words)]
        if not len(own):
            yield []
            continue
        cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
        yield [{"lang": labels[own[a]], "words": " ".join(words[a:b])} for a, b in zip(cuts, cuts[1:], strict=False)]


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = label_languages(docs, learn(docs), keep=["doc_id"])
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, empty ones and texts without a letter. Where ``lang`` is null the
    predicted label is filled in; labels that are there stay.

    The field is learnt from what is labelled. Where nothing is, no label can be told, so ``lang`` stays null, and the
    documents with a letter stay. Rows are independent, so repeated rows agree; other columns stay, whatever they are
    named; an empty table stays empty.
    """
    prefix = ""
    while any(c.lower().startswith(prefix + "lang_") for c in docs.columns):
        prefix += "_"
    found = label_languages(docs, learn(docs), prefix=prefix)
    known = F.when(F.col(f"{prefix}lang_pred") != UNDETERMINED, F.col(f"{prefix}lang_pred"))
    own = [F.coalesce(F.col("lang"), known).alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns]
    return found.where(F.col(f"{prefix}lang_has_letter")).select(*own)
