"""Phrase collocation mining: padded windows of the top order are counted, ROLLUP gives every shorter prefix."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import sliced, spread_join, stored, table

ORDER, LEAST, SHARE, FIRST = 4, 30, 80, 2000
SCALE = 2_000_000
#: Bits of a filter of frequent runs of words, as a power of two: 16 MB, whatever the input.
FILTER_BITS = 27
#: Words a task holds before it counts them, distinct ones among them, and bytes of a text split at a time.
HELD_WORDS, HELD_NAMES, PART_BYTES = 1 << 20, 200_000, 1 << 21
ROWS = 1 << 16
#: What ends a piece, what parts words, letters made small.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
FOLD = bytes(10 if b in ENDS else 32 if b in GAPS else b + 32 if 65 <= b <= 90 else b for b in range(256))
PAD, END = 0, 1
MIX = np.uint64(0x9E3779B97F4A7C15)


def bytes_in_parts(text: bytes, size: int) -> Iterator[bytes]:
    """``text``, folded, in parts of about ``size`` bytes that end between words."""
    folded, at = text.translate(FOLD), 0
    while len(folded) - at > size:
        cuts = [x for x in (folded.find(b" ", at + size), folded.find(b"\n", at + size)) if x >= 0]
        if not cuts:
            break
        yield folded[at : min(cuts)]
        at = min(cuts)
    yield folded[at:]


class Words:
    """Words as numbers and, by language, the sequence of all texts' words, with END where a piece ends."""

    def __init__(self, order: int):
        self.order = order
        self.start()

    def start(self) -> None:
        self.index: dict[bytes, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.index[b""], self.index[b"\n"]
        self.held: dict[str, list[np.ndarray]] = defaultdict(list)
        self.n = 0

    def add(self, lang: str, part: bytes) -> None:
        found = part.replace(b"\n", b" \n ").split(b" ")
        numbers = np.fromiter(map(self.index.__getitem__, found), np.int32, len(found))
        self.held[lang].append(numbers[numbers != PAD])
        self.n += len(found)

    def full(self) -> bool:
        return self.n >= HELD_WORDS or len(self.index) >= HELD_NAMES

    def names(self) -> list[bytes]:
        return list(self.index)

    def take(self, going_on: str | None = None) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
        """(language, its words ``order`` - 1 leads beside each other, all names); then start anew.

        A text of the language ``going_on`` has more to come: its last words lead no window yet and are kept.
        """
        names, kept = self.names(), []
        for lang, parts in self.held.items():
            a = np.concatenate(parts)
            more = self.order - 1
            if lang == going_on:
                kept = [names[i] for i in a[-more:]]
                whole, n = a, max(0, len(a) - more)
            else:
                whole, n = np.concatenate([a, np.full(more, END, np.int32)]), len(a)
            columns = np.zeros((self.order, n), np.int32)
            open_ = np.ones(n, bool)
            for k in range(self.order):  # a window is padded from the end of its piece on
                lead = whole[k : k + n]
                open_ &= lead != END
                np.copyto(columns[k], lead, where=open_)
            yield lang, columns[:, columns[0] != PAD], names
        self.start()
        if kept:
            self.held[going_on].append(np.fromiter(map(self.index.__getitem__, kept), np.int32, len(kept)))

    def of_batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
        for whole in batches:
            for batch in sliced(whole, ["text"]):
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    for part in bytes_in_parts(text, PART_BYTES):
                        if self.full():
                            yield from self.take(lang)
                        self.add(lang, part)
                    self.held[lang].append(np.array([END], np.int32))
        yield from self.take()


def name_hashes(lang: str, names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words as the first of a run and as a later one, the same in every task."""
    own = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
    with np.errstate(over="ignore"):
        return (own ^ np.uint64(xxhash.xxh64_intdigest(lang))) * MIX, own


def run_hashes(hashes: tuple[np.ndarray, np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Of each column of ``columns``, a run of words, a hash; runs of different lengths differ as other runs do."""
    with np.errstate(over="ignore"):
        mixed = hashes[0][columns[0]]
        for later in columns[1:]:
            mixed = mixed + hashes[1][later]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
            mixed ^= mixed >> np.uint64(32)
    return mixed


def frequent_runs(texts: DataFrame, least: int, sizes: Sequence[int], pairs: np.ndarray | None = None) -> np.ndarray:
    """A filter of FILTER_BITS that has every run of as many adjacent words as ``sizes`` says that stands ``least`` times
    or more; with a filter of ``pairs``, only runs of pairs that it has are counted.

    Runs are counted by hash, so a run's count is never too small; what passes besides is only counted later. The
    filter's size is fixed: a corpus of more frequent runs fills it, which costs time and changes no result.
    """
    mask, order = (1 << FILTER_BITS) - 1, max(sizes)
    known = None if pairs is None else texts.sparkSession.sparkContext.broadcast(pairs)  # 16 MB

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, columns, names in Words(order).of_batches(batches):
            hashes = name_hashes(lang, names)
            if known is not None:
                for k in range(1, order):
                    cut(columns, k, columns[k - 1 : k + 1], hashes, known.value)
            for m in sizes:
                runs, n = np.unique(run_hashes(hashes, columns[:m, columns[m - 1] != PAD]), return_counts=True)
                for at in range(0, len(runs), ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(runs[at : at + ROWS].view(np.int64)), pa.array(n[at : at + ROWS])], ["run", "n"])

    often = texts.mapInArrow(count, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    places = F.array(F.col("run").bitwiseAND(mask), F.shiftrightunsigned("run", FILTER_BITS).bitwiseAND(mask))
    bits = often.select(F.explode(F.transform(places, lambda x: x + 1)).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
    rows = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()  # the filter: 4,096 rows of 4 KB at most
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["bucket"] - 1) * len(part) : r["bucket"] * len(part)] = part
    return out


def cut(columns: np.ndarray, k: int, run: np.ndarray, hashes: tuple[np.ndarray, np.ndarray], filter_bits: np.ndarray) -> None:
    """Pad windows from column ``k`` on where the run of their columns ``run``, which ends there, is not in the filter."""
    inside = np.flatnonzero(columns[k] != PAD)
    rare = inside[~passes(filter_bits, run_hashes(hashes, run[:, inside]))]
    columns[k:, rare] = PAD


def passes(filter_bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    ok = np.ones(len(hashes), bool)
    for shift in (0, FILTER_BITS):
        place = (hashes >> np.uint64(shift)) & np.uint64((1 << FILTER_BITS) - 1)
        ok &= (filter_bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return ok


def counted(columns: np.ndarray, n_names: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct windows and how often each stands; columns are joined to one number, a column after another."""
    key, first = columns[0].astype(np.int64), None
    for k in range(1, len(columns)):
        key = key * n_names + columns[k]
        if k < len(columns) - 1:
            key = np.unique(key, return_inverse=True)[1]
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return columns[:, first], n


def windows(texts: DataFrame, least: int = LEAST, order: int = ORDER) -> DataFrame:
    """(lang, w1 to w{order}, n): windows of ``order`` words that begin at every word, padded with "" from the end of
    their piece on, and from the first word on with which the run from the window's start stands less than ``least``
    times: no phrase that stands so often begins there and is longer. The first word of every window stays, so the
    windows of a language are its words.
    """
    pairs = frequent_runs(texts, least, [2])
    longer = frequent_runs(texts, least, range(3, order + 1), pairs) if order > 2 else pairs
    bits = texts.sparkSession.sparkContext.broadcast(pairs | longer)  # 16 MB
    names_out = [f"w{k + 1}" for k in range(order)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, columns, names in Words(order).of_batches(batches):
            hashes = name_hashes(lang, names)
            for k in range(1, order):
                cut(columns, k, columns[: k + 1], hashes, bits.value)
            alone = columns[1] == PAD
            n = np.bincount(columns[0][alone], minlength=len(names))
            single = np.flatnonzero(n)
            found, times = counted(columns[:, ~alone], len(names))
            rows = np.zeros((order, len(single) + len(times)), np.int32)
            rows[0, : len(single)] = single
            rows[:, len(single) :] = found
            n = np.concatenate([n[single], times])
            words = pa.array([b"" if i == PAD else x for i, x in enumerate(names)], pa.binary()).cast(pa.string())
            for at in range(0, len(n), ROWS):
                some = rows[:, at : at + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * some.shape[1], pa.string()), *[words.take(pa.array(c)) for c in some], pa.array(n[at : at + ROWS])], ["lang", *names_out, "n"]
                )

    return texts.mapInArrow(count, "lang string, " + ", ".join(f"{x} string" for x in names_out) + ", n long")


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, first: int = FIRST, order: int = ORDER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best ``first`` phrases of each language.

    Three passes over the texts. Two count runs of adjacent words by hash, for a filter: pairs, then longer runs of
    frequent pairs. The third counts windows of ``order`` words, combined in each task, and one ROLLUP over (lang, w1, ..., w{order}) sums them to every
    shorter prefix: words, phrases of each length and the language's number of words come from the same rows. What
    remains are phrases of at least ``least`` occurrences: joins to their parts deal a part's rows over tasks, however
    many phrases begin with it; ranks are cut before they are shuffled.

    A null text has no words; a null language is ``und``; repeated rows count as often as they stand; other columns are
    not read; an empty table gives an empty one.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")
    columns = [f"w{k + 1}" for k in range(order)]
    whole = windows(texts, least, order).groupBy("lang", *columns).agg(F.sum("n").alias("n"))  # before ROLLUP multiplies rows
    rolled = whole.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    length = F.lit(order) - F.bit_count("level")  # a bit for each column that is rolled up
    words = F.array(*columns)
    phrases = rolled.where("lang is not null").withColumn("size", length).select(
        "lang", "size", "f", F.when(F.col("size") > 0, F.array_join(F.slice(words, 1, F.greatest(F.col("size"), F.lit(1))), " ")).alias("phrase"),
        F.when(F.col("size") > 0, F.element_at(words, F.greatest(F.col("size"), F.lit(1)).cast("int"))).alias("last"),
    )
    kept = stored(phrases.where("size = 0 or (last <> '' and f >= " + str(int(least)) + ")").drop("last"), "phrases")
    key = lambda phrase: F.concat("lang", F.lit("\t"), phrase)  # noqa: E731  no phrase has a tab
    facts = kept.where("size > 0").select(key("phrase").alias("key"), F.col("f").alias("part_f"))
    candidates = kept.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    before, after = F.array_join(F.slice("words", 1, F.col("k")), " "), F.array_join(F.slice("words", F.col("k") + 1, order), " ")
    with_l = spread_join(cuts.withColumn("key", key(before)), facts, "key", "phrase").withColumnRenamed("part_f", "l")
    with_r = spread_join(with_l.withColumn("key", key(after)), facts, "key", "phrase").withColumnRenamed("part_f", "r")
    score = F.expr(f"cast({SCALE} as decimal(38,0)) * cast(a as decimal(38,0)) div (cast(l as decimal(38,0)) + cast(r as decimal(38,0)))")
    cut = with_r.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Within each longer candidate every run of two words or more; of those that hold a phrase, the most frequent counts.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    held = candidates.where("size > 2").select("lang", "f", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    alone = cut.join(held, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (big("longer") * 100 < big("a") * share))
    order_by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = alone.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order_by).cast("long")).where(F.col("rank") <= first)
    totals = kept.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, row_number() OVER () AS p, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, p, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS i FROM split),
leads AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
  FROM placed WINDOW o AS (PARTITION BY p ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY 1),
sums AS (SELECT lang, w1, w2, w3, w4, grouping(w2, w3, w4) AS g, count(*) AS f FROM leads GROUP BY lang, w1, ROLLUP (w2, w3, w4)),
grams AS (
  SELECT lang, f, CASE g WHEN 7 THEN 1 WHEN 3 THEN 2 WHEN 1 THEN 3 ELSE 4 END AS size, concat_ws(' ', w1, w2, w3, w4) AS phrase
  FROM sums WHERE f >= 30 AND (g = 7 OR g = 3 AND w2 IS NOT NULL OR g = 1 AND w3 IS NOT NULL OR g = 0 AND w4 IS NOT NULL)),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, b.f AS l, e.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * c.f // (CAST(b.f AS HUGEINT) + e.f) AS BIGINT) AS score
  FROM candidates c, range(1, 4) s(k)
  JOIN grams b ON b.lang = c.lang AND b.phrase = array_to_string(c.w[1:k], ' ')
  JOIN grams e ON e.lang = c.lang AND e.phrase = array_to_string(c.w[k + 1:], ' ')
  WHERE k < c.size),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts),
inner_runs AS (
  SELECT c.lang, c.f, array_to_string(c.w[i:i + m - 1], ' ') AS phrase
  FROM candidates c, range(2, 4) s(m), range(1, 4) p(i) WHERE m < c.size AND i + m - 1 <= c.size),
held AS (SELECT lang, phrase, max(f) AS longer FROM inner_runs GROUP BY 1, 2),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN held h USING (lang, phrase)
  WHERE o = 1 AND (h.longer IS NULL OR CAST(100 AS HUGEINT) * h.longer < CAST(80 AS HUGEINT) * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
