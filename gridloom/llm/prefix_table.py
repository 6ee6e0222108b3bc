"""SentencePiece encoding and decoding: the unique last token of every prefix, then ids from the end backwards."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Kept, calls
from .common import fresh, sliced, table

SPACE = "▁"
PART_CHARS = 1 << 20
CACHED_WORDS = 300_000
CACHED_PAIRS = 1 << 20
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CUT_BEFORE = ".,;:!?"


class Pairs(dict):
    """Whether a token may stand behind another, by ``first << 20 | second``: tested when first asked for, then kept."""

    def __init__(self, test: Callable[[int, int], bool]):
        super().__init__()
        self.test = test

    def __missing__(self, key: int) -> bool:
        if len(self) >= CACHED_PAIRS:
            self.clear()
        found = self[key] = self.test(key >> 20, key & (1 << 20) - 1)
        return found


class Pieces:
    """A BPE model file with byte fallback: its pieces, their merge order, and what may be cut without changing a merge."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        kinds = {p.type for p in spec.pieces}
        normal = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or not spec.trainer_spec.byte_fallback or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("only BPE models with byte fallback and without user-defined or unused pieces are encoded")
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces or not normal.add_dummy_prefix or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave the text as it is, but for a space in front, are encoded")
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        #: The lower the sooner merged; equal ranks merge from the left.
        self.ranks = {p.piece: -p.score for p in spec.pieces if p.type == NORMAL}
        self.byte_ids = [0] * 256
        self.bytes_of: dict[int, bytes] = {}
        for i, p in enumerate(spec.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif p.type == NORMAL:
                self.bytes_of[i] = p.piece.replace(SPACE, " ").encode()
            else:
                self.bytes_of[i] = spec.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else b""
        self.spaced = {i for x, i in self.ids.items() if x.startswith(SPACE)}
        first = [i for i, p in enumerate(spec.pieces) if p.type == CONTROL]
        names = {p.piece: i for i, p in enumerate(spec.pieces)}
        self.begin = names.get(spec.trainer_spec.bos_piece or "<s>", first[0])
        self.end = names.get(spec.trainer_spec.eos_piece or "</s>", first[-1])
        self.alphabet = set("".join(self.ids))
        if self.alphabet - set(self.ids):
            raise ValueError("a character that stands in a piece is no piece itself")
        self.adjacent = {x[i : i + 2] for x in self.ids for i in range(len(x) - 1)}
        self.text_of = {i: x for x, i in self.ids.items()}
        self.size_of = [0] * len(spec.pieces)
        self.matches = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merge(piece) == [piece]:  # others are merged to something else wherever they stand
                self.size_of[i] = len(piece)
                self.matches.add_word(piece, (i, len(piece)))
        self.matches.make_automaton()
        self.pairs = Pairs(self.compatible)
        self.words = self.cutter()

    def cutter(self) -> re.Pattern:
        """What text is cut into before it is encoded. A cut stands only where no piece has both characters beside each
        other, so that no merge can reach across it: before a run of spaces, around a line feed, between a letter and
        a mark. A vocabulary that has such pieces is cut less, or not at all."""
        if any(SPACE in x.lstrip(SPACE) for x in self.ids):
            return re.compile(r"(?s).+")
        marks = "".join(c for c in CUT_BEFORE if not any(re.search(rf"[^\W\d_]{re.escape(c)}", x) for x in self.ids))
        line = "" if "\n" in self.alphabet else r"\n"
        letters = rf" *+[^\W\d_]++(?=[{re.escape(marks)}])|" if marks else ""
        return re.compile(rf"{letters} *+[^ {line}]++| ++" + (rf"|{line}" if line else ""))

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by merging: the pair of lowest rank, leftmost first, until none is left."""
        parts, ranks = list(text), self.ranks
        while len(parts) > 1:
            found = [ranks.get(a + b, np.inf) for a, b in zip(parts, parts[1:], strict=False)]
            low = min(found)
            if low == np.inf:
                break
            at = found.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether token b may stand behind token a: their joined text merges to just these two."""
        left, right = self.text_of[a], self.text_of[b]
        return left[-1] + right[0] not in self.adjacent or self.merge(left + right) == [left, right]

    def encode(self, word: str) -> array:
        """The ids of a word (spaces as SPACE).

        A token that ends a prefix is the last of the prefix's own encoding just if it may stand behind the last token
        of what is before it: no merge crosses a boundary that stays, so both sides merge as they would alone, and a
        merge across would need only the two tokens at it. Exactly one match passes at each place; a character
        outside the vocabulary stands alone, as bytes.
        """
        n, pairs = len(word), self.pairs
        last = [0] * (n + 1)  # by the place of a prefix's last character, so that -1 is the empty prefix
        for end, (token, size) in self.matches.iter(word):
            if not last[end]:
                before = last[end - size]
                if not before or pairs[before << 20 | token]:
                    last[end] = token
        out: list[int] = []
        size_of = self.size_of
        n -= 1
        while n >= 0:
            token = last[n]
            if token:
                out.append(token)
                n -= size_of[token]
            else:
                out.extend(self.byte_ids[x] for x in reversed(word[n].encode("utf-8", "surrogatepass")))
                n -= 1
        out.reverse()
        return array("i", out)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: bytes that are no character become U+FFFD, one a byte; the space put in front goes."""
        content = b"".join(map(self.bytes_of.__getitem__, ids))
        try:
            text = content.decode()
        except UnicodeDecodeError:
            text = one_each(content)
        shows = next((i for i in ids if self.bytes_of[i]), None)
        return text[1:] if shows in self.spaced else text


def one_each(content: bytes) -> str:
    """UTF-8 in which each byte that belongs to no character stands as U+FFFD."""
    return "".join("�" if "\udc80" <= c <= "\udcff" else c for c in content.decode("utf-8", "surrogateescape"))


def parts(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut before a run of spaces; whole where there is none."""
    at, before_run = 0, re.compile(r"(?<=[^ ]) ")
    while len(text) - at > size:
        found = before_run.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class Encoder:
    """Encodes whole texts; a word's ids and decoded text are worked out once while they are kept."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.kept = pieces, Kept(CACHED_WORDS)
        self.cuts = "(?s).+" != pieces.words.pattern

    def learn(self, words: set[str]) -> None:
        p = self.pieces
        for word in self.kept.missing(words):
            ids = p.encode(word.replace(" ", SPACE))
            shown = b"".join(map(p.bytes_of.__getitem__, ids)).decode("utf-8", "surrogatepass")
            self.kept.young[word] = (ids.tobytes(), word if shown == word else shown)

    def encode(self, texts: list[str]) -> Iterator[Iterator[tuple[bytes, str]]]:
        """For each text (ids, text decoded from them) of one bounded part after another, without begin and end."""
        ready = [(" " + x.replace(SPACE, " ") if x else "") for x in texts]
        split = [self.pieces.words.findall(x) if len(x) <= PART_CHARS else None for x in ready]
        self.learn(set().union(*[x for x in split if x is not None]))
        known = self.kept.young
        whole = [None if x is None else [known[w] for w in x] for x in split]  # before a long text changes what is kept
        for text, entries in zip(ready, whole, strict=True):
            yield self.of_parts(text) if entries is None else iter([(b"".join([x[0] for x in entries]), "".join([x[1] for x in entries]))])

    def of_parts(self, text: str) -> Iterator[tuple[bytes, str]]:
        for part in parts(text, PART_CHARS) if self.cuts else [text]:
            words = self.pieces.words.findall(part)
            self.learn(set(words))
            entries = [self.kept.young[w] for w in words]
            yield b"".join([x[0] for x in entries]), "".join([x[1] for x in entries])


OUTPUTS = {"ids": "array<int>", "decoded": "string", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
_ENCODERS: dict[bytes, Encoder] = {}


def encoder_of(model: bytes) -> Encoder:
    """The model's encoder, which a worker keeps from task to task."""
    key = hashlib.sha256(model).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Pieces(model))
    return _ENCODERS[key]


def encode_decode(docs: DataFrame, model_path: str, outputs: Sequence[str] = ("ids", "decoded"), keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and, of ``outputs``: the ids of every whole text with begin and end, the text that decodes
    from them, the number of ids, the digest of the ids as little-endian 32-bit integers and of the decoded text.

    One narrow stage. Texts are cut where no merge can cross and every distinct word is encoded once while it is kept;
    a text above PART_CHARS is taken a part after another. A null text counts as empty (begin and end alone, decoded
    ""); repeated rows give repeated rows; an empty table gives an empty one; a column of ``keep`` that is named as an
    output gives way to it, other columns are not read.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, of fixed size
    Pieces(model.value)  # refuses what it cannot encode, before any task runs
    keep = [x for x in keep if x.lower() not in outputs]
    read = fresh(docs, "text_read")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model.value)
        first, last = (np.array([x], "<u4").tobytes() for x in (encoder.pieces.begin, encoder.pieces.end))
        for whole in batches:
            for batch in sliced(whole, [read]):
                got: dict[str, list] = {x: [] for x in outputs}
                texts = pc.fill_null(batch.column(read), "").to_pylist()
                for encoded in (x for call in calls(texts, PART_CHARS) for x in encoder.encode(call)):
                    size, id_hash, text_hash, ids, decoded, skip = 2, hashlib.sha256(first), hashlib.sha256(), [first], [], 1
                    for id_bytes, shown in encoded:
                        size += len(id_bytes) // 4
                        shown = shown[skip:] if shown else shown
                        skip = 0 if shown or skip == 0 or id_bytes else skip
                        id_hash.update(id_bytes)
                        if "decoded_sha256" in got:
                            text_hash.update(shown.encode("utf-8", "surrogatepass"))
                        if "ids" in got:
                            ids.append(id_bytes)
                        if "decoded" in got:
                            decoded.append(shown)
                    id_hash.update(last)
                    one = {"ids": b"".join([*ids, last]), "decoded": "".join(decoded), "n_tokens": size, "ids_sha256": id_hash.hexdigest(), "decoded_sha256": text_hash.hexdigest()}
                    for x, values in got.items():
                        values.append(one[x])
                columns = [batch.column(x) for x in keep]
                for x, values in got.items():
                    if x == "ids":
                        offsets = np.cumsum([0, *(len(v) // 4 for v in values)])
                        columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(values), "<i4"), pa.int32())))
                    else:
                        columns.append(pa.array(values, pa.int64() if x == "n_tokens" else pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*keep, *outputs])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{x}` {kinds[x]}" for x in keep] + [f"{x} {OUTPUTS[x]}" for x in outputs])
    return docs.select(*[F.col(f"`{x}`") for x in keep], F.col("text").cast("string").alias(read)).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, column: str = "ids") -> DataFrame:
    """``encoded`` with the text (``decoded``) of a column of ids; null ids give a null text, ids that the model does not
    have are refused."""
    with open(model_path, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("string")
    def text_of(ids):
        pieces = encoder_of(model.value).pieces
        return ids.map(lambda x: None if x is None else pieces.decode(x.tolist()))

    return encoded.withColumn("decoded", text_of(F.col(column)))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ("n_tokens", "ids_sha256", "decoded_sha256"))
