"""Quality classifier: attention-based multiple-instance learning over the passages of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remainder, sliced, table
from .runs import RunTable

#: The bound of the labelled sample, chosen by a hash of the ids.
SAMPLE_DOCS = 4000
PASSAGE_RUNS = 48
THRESHOLD = 0.3
SHAPES, GRAMS = 24, 32
HIDDEN, ATTENTION = 24, 16
EPOCHS, BATCH, RATE = 8, 128, 0.01


def run_features(runs: list[str]) -> np.ndarray:
    """A row for each run: letters, capitals, digits, signs and length, a bucket of its shape, buckets of its trigrams."""
    out = np.zeros((len(runs), 8 + SHAPES + GRAMS), np.float32)
    if not runs:
        return out
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    codes = np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(runs)), lengths)
    begins = np.cumsum(lengths) - lengths
    upper = (codes >= 65) & (codes <= 90)
    lower = (codes >= 97) & (codes <= 122)
    digit = (codes >= 48) & (codes <= 57)
    other = codes > 127
    sign = ~(upper | lower | digit | other)
    share = lambda mask: np.bincount(owner, mask, len(runs)) / lengths
    for j, mask in enumerate((upper, lower, digit, other, sign)):
        out[:, j] = share(mask)
    out[:, 5] = np.minimum(lengths, 30) / 10
    out[:, 6] = lengths > 20
    out[:, 7] = upper[begins]
    # The shape: its first kind, its last kind and the last sign's code.
    kind = np.select([upper, lower, digit, other], [0, 1, 2, 3], 4)
    ends = begins + lengths - 1
    shape = (kind[begins] * 5 + kind[ends]) * 131 + np.where(kind[ends] == 4, codes[ends], 0)
    out[np.arange(len(runs)), 8 + shape.astype(np.int64) * 2654435761 % (1 << 32) % SHAPES] = 1
    folded = np.where(upper, codes + 32, codes).astype(np.uint64)
    at = np.flatnonzero(np.arange(len(codes)) + 2 <= ends[owner])
    gram = ((folded[at] * np.uint64(0x9E3779B1) ^ folded[at + 1]) * np.uint64(0x85EBCA77) ^ folded[at + 2]) * np.uint64(0xC2B2AE3D)
    bucket = ((gram >> np.uint64(15)) % np.uint64(GRAMS)).astype(np.int64)
    out[:, 8 + SHAPES :] = np.bincount(owner[at] * GRAMS + bucket, minlength=len(runs) * GRAMS).reshape(len(runs), GRAMS) / 2
    return out


def passages(numbers: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, passages of each text). A passage has up to PASSAGE_RUNS runs; a text without a run
    has one empty passage. To the means of its runs come how many of them are distinct and how full it is."""
    counts = np.maximum(1, -(-lengths // PASSAGE_RUNS))
    begins = np.cumsum(lengths) - lengths
    inner = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(begins, counts) + inner * PASSAGE_RUNS
    size = np.minimum(PASSAGE_RUNS, np.repeat(lengths, counts) - inner * PASSAGE_RUNS)
    out = np.zeros((len(start), rows.shape[1] + 2), np.float32)
    padded = np.concatenate([rows, np.zeros((1, rows.shape[1]), np.float32)])
    places = np.arange(PASSAGE_RUNS)
    for at in range(0, len(start), 512):  # a bounded number of run rows at a time
        some = slice(at, at + 512)
        inside = places < size[some, None]
        own = np.full(inside.shape, len(rows))
        own[inside] = numbers[(start[some, None] + places)[inside]]
        held = np.maximum(size[some], 1)
        out[some, :-2] = padded[own].sum(axis=1) / held[:, None]
        own.sort(axis=1)
        out[some, -2] = ((own[:, 1:] != own[:, :-1]).sum(axis=1) + (size[some] == PASSAGE_RUNS)) / held
    out[:, -1] = size / PASSAGE_RUNS
    return out, counts


@dataclass
class Bags:
    """The learnt encoder, gated attention and classifier, with the features' means and deviations."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Passages to hidden vectors, gated attention within each text, the weighted vector's score."""
        p = self.p
        h = np.tanh(((x - self.mean) / self.scale) @ p["encode"] + p["encode_b"])
        v, g = np.tanh(h @ p["attend"]), 1 / (1 + np.exp(-(h @ p["gate"])))
        e = (v * g) @ p["weigh"]
        begins = np.cumsum(counts) - counts
        bag = np.repeat(np.arange(len(counts)), counts)
        a = np.exp(e - np.maximum.reduceat(e, begins)[bag])
        a /= np.add.reduceat(a, begins)[bag]
        z = np.add.reduceat(a[:, None] * h, begins, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["judge"] + p["judge_b"], -30, 30)))
        return {"h": h, "v": v, "g": g, "a": a, "z": z, "score": score, "bag": bag, "begins": begins}

    def gradient(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss, through classifier, attention and encoder."""
        p, f = self.p, self.forward(x, counts)
        d = (f["score"] - y) / len(y)
        dz = d[:, None] * p["judge"]
        da = np.einsum("ij,ij->i", dz[f["bag"]], f["h"])
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["begins"])[f["bag"]])
        du = de[:, None] * p["weigh"]
        dv, dg = du * f["g"] * (1 - f["v"] ** 2), du * f["v"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dz[f["bag"]] + dv @ p["attend"].T + dg @ p["gate"].T) * (1 - f["h"] ** 2)
        return {
            "judge": f["z"].T @ d, "judge_b": d.sum(), "weigh": (f["v"] * f["g"]).T @ de, "attend": f["h"].T @ dv, "gate": f["h"].T @ dg,
            "encode": ((x - self.mean) / self.scale).T @ dh, "encode_b": dh.sum(axis=0),
        }


def train_bags(rows: list[tuple[str, int]], seed: int = 5) -> Bags | None:
    """Learn from (text, label) by Adam; None if the sample has not both labels."""
    if len({y for _, y in rows}) < 2:
        return None
    rng = np.random.default_rng(seed)
    split = [x.split() for x, _ in rows]
    numbers, features = RunTable(run_features, most=1 << 62).look_up(split)
    x, counts = passages(numbers, np.array([len(s) for s in split]), features)
    y = np.array([v for _, v in rows], float)
    scale = x.std(axis=0)
    d = x.shape[1]
    draw = lambda *shape: rng.standard_normal(shape) / np.sqrt(shape[0])
    model = Bags(x.mean(axis=0), np.where(scale > 1e-4, scale, 1.0), {
        "encode": draw(d, HIDDEN), "encode_b": np.zeros(HIDDEN), "attend": draw(HIDDEN, ATTENTION), "gate": draw(HIDDEN, ATTENTION),
        "weigh": draw(ATTENTION), "judge": draw(HIDDEN), "judge_b": np.zeros(()),
    })
    begins = np.cumsum(counts) - counts
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
            own = counts[batch]
            at = np.repeat(begins[batch], own) + np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            step += 1
            for k, g in model.gradient(x[at], own, y[batch]).items():
                g = g + 1e-4 * model.p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                rate = RATE * (1 - epoch / EPOCHS)
                model.p[k] = model.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Bags | None:
    """A model from at most ``sample_docs`` labelled documents with a crc32(doc_id) mod 5 that is not 0, chosen by a hash
    of the id. Of ids that repeat, the smallest text and the highest label count, so that reruns learn the same."""
    usable = labels.where((remainder("doc_id", 5) != 0) & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    # Sorted by a hash of the id and limited: at most sample_docs rows of two numbers, which is what makes them fit to broadcast.
    sample = usable.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("quality").alias("quality"))  # a repeated id is one document
    rows = sorted((r["doc_id"], r["text"], r["quality"]) for r in one.toLocalIterator())
    return train_bags([(text, quality) for _, text, quality in rows])


def score_quality(docs: DataFrame, model: Bags | None, threshold: float = THRESHOLD, keep: list[str] | None = None, with_passages: bool = False) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with quality_score (0 to 1), quality_label (1 if the score is at
    least ``threshold``) and, with ``with_passages``, the attention of each passage.

    Every whole text is scored: a null text as an empty one, an empty one by its single empty passage. Rows are
    independent, so repeated rows agree; no shuffle. Without a model (no labels of both kinds) the score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights
    added = {"quality_score": "double", "quality_label": "int"} | ({"quality_attention": "array<double>"} if with_passages else {})
    kept = [c for c in keep or docs.columns if c.lower() not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = RunTable(run_features, most=60_000)
        for batch in (x for whole in batches for x in sliced(whole, ["text"])):
            split = [(x or "").split() for x in batch.column("text").to_pylist()]
            score, attention = np.full(len(split), 0.5), [[] for _ in split]
            if model is not None and split:
                numbers, rows = table.look_up(split)
                x, counts = passages(numbers, np.fromiter(map(len, split), np.int64, len(split)), rows)
                out = model.forward(x, counts)
                score = out["score"]
                if with_passages:
                    attention = [a.tolist() for a in np.split(out["a"], np.cumsum(counts)[:-1])]
            columns = [*batch.select(kept).columns, pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))]
            if with_passages:
                columns.append(pa.array(attention, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *added])

    types = dict(docs.dtypes) | added
    schema = ", ".join(f"`{c}` {types[c]}" for c in [*kept, *added])
    return docs.select(*[F.col(f"`{c}`") for c in kept], *["text"] * ("text" not in kept)).mapInArrow(run, schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, learn(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_label").alias("predicted"))
