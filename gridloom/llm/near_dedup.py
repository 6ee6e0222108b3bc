"""MinHash near-dedup by order MinHash: minima of occurrence-labelled shingles, kept in text order; candidates are
verified by banded alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fresh, sliced, spread_join, stored, table
from .components import connected

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES, MINIMA = 16, 3
#: Texts of a bucket that are still apart are compared with so many hubs one after another, then in tiles of this size.
ROUNDS = 2
TILE_A, TILE_B = 128, 512
#: Pairs that share one copy of the hub's text.
PAIRS_OF_PART = 256
SLICE_BYTES = 1 << 20
# Odd constants for hashing, ASCII white space.
PRIME = np.uint64(0x100000001B3)
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_B
    return (x ^ (x >> np.uint64(27))) * MIX_A


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(labelled shingles of all texts in text order, how many each text has).

    Words are runs without ASCII white space; a shingle is SHINGLE words in a row, or all words of a shorter text. A
    shingle that recurs in its text carries the number of its occurrence, so all shingles of a text differ.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = np.zeros(len(texts), np.int64)
    if not len(data):
        return np.zeros(0, np.uint64), counts
    ends = np.cumsum(sizes)
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    edge[ends - sizes] = True
    solid = ~IS_SPACE[data]
    before = np.concatenate([[False], solid[:-1]]) & ~edge[:-1]
    after = np.concatenate([solid[1:], [False]]) & ~edge[1:]
    start, stop = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    # A word's hash is a difference of running sums of byte * PRIME^place, shifted back to place 0.
    power = powers(PRIME, len(data) + 1)
    inverse = np.uint64(pow(int(PRIME), -1, 1 << 64))
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])])
    words = mixed((total[stop] - total[start]) * powers(inverse, len(data) + 1)[start])
    owner = np.searchsorted(ends, start, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    n = len(words)
    whole = np.zeros(n, np.uint64)
    width = np.minimum(SHINGLE, n_words)[owner]
    left = (first + n_words)[owner] - np.arange(n)
    for j in range(SHINGLE):
        at = np.flatnonzero(width > j)
        at = at[at + j < n]
        whole[at] = mixed(whole[at] + words[at + j] + np.uint64(j + 1))
    keep = left >= width
    whole, owner = whole[keep], owner[keep]
    counts = np.bincount(owner, minlength=len(texts))
    # Occurrence numbers: equal shingles of a text stand together in a stable order.
    salted = whole ^ mixed(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(salted, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = salted[order[1:]] == salted[order[:-1]]
    run = np.arange(len(order))
    run[same] = 0
    occurrence = np.arange(len(order)) - np.maximum.accumulate(run)
    again = order[same]  # a shingle's first occurrence keeps its hash
    whole[again] = mixed(whole[again] + occurrence[same].astype(np.uint64) * MIX_A)
    return whole, counts


def order_sketches(whole: np.ndarray, counts: np.ndarray, sketches: int = SKETCHES, minima: int = MINIMA) -> np.ndarray:
    """A row for each text that has shingles: each sketch takes the ``minima`` shingles of lowest hash and hashes them
    in text order. A text with fewer gives all it has."""
    some = counts > 0
    own = counts[some]
    begins = np.cumsum(own) - own
    bag = np.repeat(np.arange(len(own)), own)
    out = np.zeros((len(own), sketches), np.uint64)
    if not len(own):
        return out
    for sketch in range(sketches):
        h = mixed(whole ^ mixed(np.full(1, sketch + 1, np.uint64)))
        h[h == LAST] -= np.uint64(1)
        places = np.full((len(own), minima), len(whole))
        for i in range(minima):
            low = np.minimum.reduceat(h, begins)
            at = np.flatnonzero(h == low[bag])
            at = at[h[at] != LAST]
            places[bag[at], i] = at  # equal hashes within a text: the last counts, all are used up
            h[at] = LAST
        places.sort(axis=1)
        key = np.full(len(own), sketch + 1, np.uint64)
        padded = np.concatenate([whole, [np.uint64(0)]])
        for i in range(minima):
            key = mixed(key + padded[places[:, i]] + np.uint64(i))
        out[:, sketch] = key
    return out


def aligned(a: np.ndarray, b: np.ndarray, least: float) -> int:
    """The most shingles that stand in both texts in the same order, found within the band that ``least`` allows.

    Labelled shingles differ within a text, so matches are pairs of places, and the longest common subsequence is the
    longest run of rising places. An alignment that reaches ``least`` leaves out so few shingles that no match in it
    lies further off the diagonal than the band is wide.
    """
    both = len(a) + len(b)
    band = both - 2 * int(np.ceil(least / (1 + least) * both - 1e-9))
    if band < 0:
        return 0
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b[order], a), len(b) - 1)
    match = b[order][at] == a
    i, j = np.flatnonzero(match), order[at[match]]
    j = j[np.abs(i - j) <= band]
    if len(j) < 2 or (np.diff(j) > 0).all():
        return len(j)
    tails: list[int] = []
    for x in j.tolist():
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return len(tails)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned shingles over all shingles of both texts: the Jaccard similarity of texts that keep their order."""
    if not len(a) or not len(b) or min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    common = aligned(a, b, least)
    return common / (len(a) + len(b) - common)


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, keys): the text's md5 and its sketches; a text without a word has none, a null text no digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, ["text"]):
                texts = [x or b"" for x in batch.column("text").to_pylist()]
                labelled, counts = shingles(texts)
                keys = order_sketches(labelled, counts).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum((counts > 0) * SKETCHES)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("digest"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.ravel(), pa.int64()))],
                    ["doc_id", "digest", "keys"],
                )

    read = docs.select("doc_id", digest_of().alias("digest"), F.encode("text", "UTF-8").alias("text"))
    return read.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, digest binary, keys array<long>")


def digest_of():
    return F.unhex(F.md5("text"))


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those (a, b) of ``pairs``, a table, whose texts' similarity is at least ``least``.

    A hub has any number of pairs: they are dealt into parts of about PAIRS_OF_PART, and each part gets the hub's text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, ["a_text", "b_text"]):
                n = batch.num_rows
                labelled, counts = shingles(batch.column("a_text").to_pylist() + batch.column("b_text").to_pylist())
                ends = np.cumsum(counts)
                part = lambda i: labelled[ends[i] - counts[i] : ends[i]]  # noqa: B023, E731
                yield batch.select(["a", "b"]).filter(pa.array([similarity(part(i), part(n + i), least) >= least for i in range(n)], pa.bool_()))

    parts = max(1, -(-pairs.count() // PAIRS_OF_PART))
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(parts)))
    a = dealt.select("a", "part").distinct().join(texts.select(F.col("digest").alias("a"), F.col("text").alias("a_text")), "a")
    b = dealt.join(texts.select(F.col("digest").alias("b"), F.col("text").alias("b_text")), "b")
    return b.join(a, ["a", "part"]).select("a", "b", "a_text", "b_text").mapInArrow(run, "a binary, b binary")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(digest, text as bytes) of the texts in ``ids`` (digest, doc_id), read from the rows of that id alone, so that of
    a text with any number of copies one is moved."""
    own = docs.where(F.col("text").isNotNull()).select("doc_id", "text", digest_of().alias("digest"))
    first = ids.select(F.col("doc_id").alias("first_id"), F.col("digest").alias("first_digest"))
    # A merge at every size: what is shuffled grows in proportion, and no list of ids is sent whole to every executor.
    found = own.join(first.hint("merge"), F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest")), "left_semi")
    return found.groupBy("digest").agg(F.encode(F.first("text"), "UTF-8").alias("text"))


def hot_buckets(buckets: DataFrame, partitions: int) -> DataFrame:
    """(bucket) of those that hold more than a quarter of what a partition would get of all rows: at most four times as
    many as there are partitions, as their rows cannot be more than all. That bound lets them be broadcast."""
    rows = buckets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()["rows"]
    return buckets.where(F.col("n") > rows / (4 * partitions)).select("bucket")


def of_buckets(rows: DataFrame, facts: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with the ``facts`` of their bucket. Rows of hot buckets stay where they are and get a broadcast of the
    few facts of those; the others meet theirs in a shuffle."""
    few = F.broadcast(hot)  # see hot_buckets for the bound
    return rows.join(F.broadcast(facts.join(few, "bucket", "left_semi")), "bucket").unionByName(
        rows.join(few, "bucket", "left_anti").join(facts, "bucket")
    )


def shingle_lists(texts: list[bytes]) -> list[np.ndarray]:
    """The labelled shingles of each text, computed about SLICE_BYTES at a time."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    held = 0
    for text in [*texts, None]:
        if part and (text is None or held + len(text) > SLICE_BYTES):
            labelled, counts = shingles(part)
            out += np.split(labelled, np.cumsum(counts)[:-1])
            part, held = [], 0
        if text is not None:
            part.append(text)
            held += len(text)
    return out


def links_of_tile(a_texts: list[bytes], b_texts: list[bytes], apart: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of a, row of b) of similarity ``least`` or more where ``apart`` is true. Common shingles of one text with
    all others are counted at once; only pairs with enough of them are aligned."""
    a_lists, b_lists = shingle_lists(a_texts), shingle_lists(b_texts)
    a_sizes, b_sizes = np.array(list(map(len, a_lists))), np.array(list(map(len, b_lists)))
    known, inverse = np.unique(np.concatenate(b_lists), return_inverse=True)
    begins = np.cumsum(b_sizes) - b_sizes
    flags = np.zeros(len(known) + 1, np.int64)
    rows, cols = [], []
    for i, own in enumerate(a_lists):
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        at = at[known[at] == own]
        flags[at] = 1
        common = np.add.reduceat(flags[inverse], begins)
        flags[at] = 0
        enough = np.flatnonzero(apart[i] & (common >= (least - 1e-9) * (a_sizes[i] + b_sizes - common)))
        found = [j for j in enough.tolist() if similarity(own, b_lists[j], least) >= least]
        rows += [i] * len(found)
        cols += found
    return np.array(rows, np.int64), np.array(cols, np.int64)


def rest_of_buckets(known: DataFrame, texts: DataFrame, hot: DataFrame, least: float) -> DataFrame:
    """Links (a, b) among (bucket, rep, component): in each bucket every text outside its largest component is compared
    with all texts of other components, in tiles of bounded size, so that a bucket of any size is shared out."""
    counts = known.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    shape = counts.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("n_all"), (F.sum("n") - F.max("n")).alias("n_out")
    ).where("n_out > 0").select(
        "bucket", "largest", F.ceil(F.col("n_out") / TILE_A).cast("int").alias("a_blocks"), F.ceil(F.col("n_all") / TILE_B).cast("int").alias("b_blocks")
    )
    rows = of_buckets(known, stored(shape, "open-shapes"), hot)

    def dealt(own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("rep", "bucket"), F.col(n_own)).cast("int")
        return rows.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1)))

    a = dealt("a_block", "a_blocks", "b_block", "b_blocks").where("component <> largest")
    b = dealt("b_block", "b_blocks", "a_block", "a_blocks")
    named = ["bucket", "a_block", "b_block", "rep", "component", "text"]
    text = texts.select(F.col("digest").alias("rep"), "text")
    tile = ["bucket", "a_block", "b_block"]

    def compare(x, y):
        import pandas as pd

        if x.empty or y.empty:
            return pd.DataFrame({"a": [], "b": []})
        apart = x["component"].to_numpy()[:, None] != y["component_2"].to_numpy()[None]
        i, j = links_of_tile(list(x["text"]), list(y["text_2"]), apart, least)
        return pd.DataFrame({"a": x["rep"].to_numpy()[i], "b": y["rep_2"].to_numpy()[j]})

    # The sides come of the same rows, so one gets names and columns of its own.
    left = a.join(text, "rep").select(*named).groupBy(*tile)
    right = b.join(text, "rep").select(*named).toDF(*[f"{c}_2" for c in named]).groupBy(*[f"{c}_2" for c in tile])
    return left.cogroup(right).applyInPandas(compare, "a binary, b binary").distinct()


def with_links(component: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) with the components that ``links`` join made one. Only links between different components are
    followed, as links of these."""
    if links.isEmpty():
        return component
    side = lambda name: component.select(F.col("id").alias(name), F.col("component").alias(f"{name}_in"))
    between = spread_join(links.join(side("b"), "b"), side("a"), "a", by="b").where("a_in <> b_in").select(F.col("a_in").alias("a"), F.col("b_in").alias("b")).distinct()
    joined = connected(stored(between, "between")).withColumnRenamed("component", "to")
    every = component.select("component").distinct().join(joined, F.col("component") == F.col("id"), "left").select("component", F.coalesce("to", "component").alias("to"))
    return stored(spread_join(component, every, "component", by="id").select("id", F.col("to").alias("component")), "components")


def classes_of(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """((doc_id, digest) of every row, (digest, class_key, class_id, class_size, head) of every text): the key of a class
    is its smallest digest; its head, the text that stays, is that of its smallest doc_id (null ones last)."""
    spark = docs.sparkSession
    rows = stored(sketched(docs), "sketches")
    texts = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first"), F.count("*").alias("copies"), F.first("keys").alias("keys")
    )
    texts = stored(texts, "texts")
    in_buckets = texts.select(F.col("digest").alias("rep"), F.posexplode("keys").alias("sketch", "key")).select("rep", F.xxhash64("sketch", "key").alias("bucket"))
    buckets = stored(in_buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("hub")).where("n > 1"), "bucket-sizes")
    hot = stored(hot_buckets(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))), "hot-buckets")
    held = stored(of_buckets(in_buckets, buckets.select("bucket", "hub"), hot), "buckets")
    ids = texts.join(held.select(F.col("rep").alias("digest")).distinct(), "digest", "left_semi").select("digest", "first.doc_id")
    bodies = stored(texts_of(docs, ids), "pair-texts")

    # First one pair a text, with the smallest hub of all its buckets, so that a group of copies becomes one star.
    first = held.groupBy("rep").agg(F.min("hub").alias("hub")).where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    tried = stored(first, "pairs")
    component = stored(held.select(F.col("rep").alias("id"), F.col("rep").alias("component")).distinct(), "components")
    component = with_links(component, stored(verified(tried, bodies, least), "found"))

    def labelled() -> DataFrame:
        """(bucket, rep, component) with the components known so far."""
        return stored(held.join(component, F.col("rep") == F.col("id")).select("bucket", "rep", "component"), "open-buckets")

    for turn in range(ROUNDS):
        known = labelled()
        # The bucket's smallest text, then the one of lowest hash. Buckets of one component are done.
        order = F.xxhash64("rep", F.lit(turn), "bucket") if turn else F.col("rep")
        hubs = known.groupBy("bucket").agg(
            F.min_by(F.struct("rep", "component"), order).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high")
        ).where("low <> high").select("bucket", "hub")
        pairs = of_buckets(known, stored(hubs, "hubs"), hot).where("component <> hub.component").select(F.col("hub.rep").alias("a"), F.col("rep").alias("b")).distinct()
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        discard(known)
        if pairs.isEmpty():
            break
        tried = tried.union(pairs)
        component = with_links(component, stored(verified(pairs, bodies, least), "found"))

    known = labelled()
    component = with_links(component, stored(rest_of_buckets(known, bodies, hot, least), "found"))

    by_text = texts.join(component, F.col("digest") == F.col("id"), "left").select("digest", "first", "copies", F.coalesce("component", "digest").alias("class_key"))
    by_text = stored(by_text, "keys")
    facts = by_text.groupBy("class_key").agg(F.sum("copies").alias("class_size"), F.min(F.struct("first.none", "first.doc_id", "digest")).alias("least"))
    classes = spread_join(by_text, facts, "class_key", by="digest")
    classes = stored(classes.select("digest", "class_key", F.col("least.doc_id").alias("class_id"), "class_size", F.col("least.digest").alias("head")), "classes")
    discard(texts, buckets, held, bodies, known, by_text)
    return rows.select("doc_id", "digest"), classes


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, class_key, class_size, is_first of every row of ``docs``.

    Equal texts are one class at once, by digest; whatever their doc_ids, different texts are different nodes. Texts that
    share an order-MinHash bucket are candidates: each is compared with the smallest hub of its buckets, then, in every
    bucket whose texts are not yet of one component, with that bucket's hubs, then, in tiles, what still lies outside a
    bucket's largest component with all texts of other components. So each pair that shares a bucket is compared or already of one class, at every size.
    Links are pairs of similarity ``least`` or more, classes their connected components.

    class_id is the smallest doc_id of the class (null if it has none), class_key its smallest text digest, which tells
    classes apart whose texts have the same doc_id. is_first marks the rows of the text and id that the class keeps:
    rows repeating both are all marked. A null text is alone in its class, its class_id its doc_id and its class_key
    null; texts without a word only equal each other if they are the same text; an empty table gives an empty one;
    other columns are not read. A pair of similarity 0.8 misses all 16 buckets about once in 100,000 times.
    """
    rows, classes = classes_of(docs, least)
    known = spread_join(rows.where("digest is not null"), classes, "digest", by="doc_id").select(
        "doc_id", "class_id", F.lower(F.hex("class_key")).alias("class_key"), F.col("class_size").cast("long").alias("class_size"),
        ((F.col("digest") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("is_first"),
    )
    alone = rows.where("digest is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(None).cast("string").alias("class_key"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("is_first")
    )
    return known.unionByName(alone)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: of its smallest doc_id (null ones last) the smallest digest. Of rows that repeat
    both, the first stays by all its columns in JSON, so reruns agree. Null texts are no copies of each other and stay;
    other columns stay, whatever they are named; an empty table stays empty."""
    rows, classes = classes_of(docs)
    heads = classes.where("digest = head").select(F.col("class_id").alias("head_id"), F.col("head").alias("head_digest"))
    digest = fresh(docs, "text_digest")
    own = docs.withColumn(digest, digest_of())
    of_head = F.col(f"{digest}") == F.col("head_digest")
    kept = own.where(F.col("text").isNotNull()).join(heads.hint("merge"), F.col("doc_id").eqNullSafe(F.col("head_id")) & of_head, "left_semi")
    repeated = rows.where("digest is not null").groupBy("doc_id", "digest").count().where("count > 1")
    if not repeated.isEmpty():
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        kept = kept.groupBy("doc_id", digest).agg(F.min_by(whole, F.to_json(whole)).alias("row")).select("row.*")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*names).unionByName(docs.where(F.col("text").isNull()).select(*names))
