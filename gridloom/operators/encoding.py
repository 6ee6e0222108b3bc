"""Encoded chunks: cells scattered into bounded pieces of chunks, a piece's values as shuffled, compressed bytes beside a
bitmap of the cells that are there, and digests by day and row that combine over any layout."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame

#: A piece: a strip of rows of a chunk (tc, ty, tx); what it holds, its stored size, digests; then its bytes.
PIECES = (
    "tc long, ty int, tx int, part int, n_cells int, n_bytes long, v_min float, v_max float, n_negative int, "
    "y0 int, y1 int, x0 int, x1 int, mask_from array<date>, mask_days array<int>, mask_cells array<int>, mask_places array<long>, "
    "spans array<int>, span_values array<long>, rows array<int>, row_values array<long>, valid binary, payload binary"
)
CELLS = "tc long, ty int, tx int, t date, y int, x int, v float"
FRAGMENTS = "key long, n int, places binary, numbers binary"
#: Cells that a task holds before it deals them to pieces, and that a fragment has at most.
HELD_CELLS, FRAGMENT_CELLS = 1 << 20, 1 << 17
EPOCH = dt.date(1970, 1, 1)
#: Days from the archive's first one on whose values share a digest.
SPAN = 32
#: Of zstd.
LEVEL = 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of integers, so that their exclusive or tells sets apart."""
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Shape:
    """Chunks of (days, ny, nx) over a grid of ``grid`` (rows, columns) from ``first_day`` on, cut into strips of rows."""

    days: int
    ny: int
    nx: int
    grid: tuple[int, int]
    strip: int
    first_day: dt.date

    @staticmethod
    def of(spec: dict) -> Shape:
        return Shape(*spec["chunk"], (spec["ny"], spec["nx"]), spec["strip"], dt.date.fromisoformat(spec["first_day"]))

    @property
    def tall(self) -> int:
        return -(-self.grid[0] // self.ny)

    @property
    def wide(self) -> int:
        return -(-self.grid[1] // self.nx)

    @property
    def parts(self) -> int:
        return -(-self.ny // self.strip)

    @property
    def cells(self) -> int:
        return self.days * self.strip * self.nx

    @property
    def day0(self) -> int:
        return (self.first_day - EPOCH).days

    def places(self, t: np.ndarray, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, place in it) of cells, ``t`` in days since 1970."""
        if len(t) and (min(int(t.min()) - self.day0, y.min(), x.min()) < 0 or y.max() >= self.grid[0] or x.max() >= self.grid[1]):
            raise ValueError("cells lie outside the grid or before its first day")
        # By table: a grid has few rows and columns, a record few days, beside its cells.
        days = np.arange(int(t.min()) - self.day0, int(t.max()) - self.day0 + 1) if len(t) else np.zeros(0, np.int64)
        rows, columns = np.arange(self.grid[0]), np.arange(self.grid[1])
        strips, inside = np.divmod(rows % self.ny, self.strip)
        at = lambda table, index: table[index]
        t = t - (int(t.min()) if len(t) else 0)
        key = at(days // self.days * (self.tall * self.wide * self.parts), t) + at(rows // self.ny * (self.wide * self.parts) + strips, y) + at(columns // self.nx * self.parts, x)
        return key, at(days % self.days * (self.strip * self.nx), t) + at(inside * self.nx, y) + at(columns % self.nx, x)

    def piece(self, key: int) -> tuple[int, int, int, int]:
        """(tc, ty, tx, part)."""
        key, part = divmod(key, self.parts)
        key, tx = divmod(key, self.wide)
        return (*divmod(key, self.tall), tx, part)

    def back(self, piece: tuple[int, int, int, int], places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(t, y, x) of places in a piece."""
        tc, ty, tx, part = piece
        rest, column = np.divmod(places, self.nx)
        day, row = np.divmod(rest, self.strip)
        return day + (tc * self.days + self.day0), row + (ty * self.ny + part * self.strip), column + tx * self.nx


Arrays = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def scattered(cells: DataFrame, shape: Shape) -> DataFrame:
    """(key, n, places, numbers): the cells (t, y, x, v) that are not NaN, in fragments of pieces."""

    def arrays(batch: pa.RecordBatch) -> Iterator[Arrays]:
        t, y, x = (batch.column(c).cast(pa.int32()).to_numpy(zero_copy_only=False) for c in ("t", "y", "x"))
        yield t, y, x, batch.column("v").to_numpy(zero_copy_only=False)

    return fragments_of(cells.select("t", "y", "x", "v"), arrays, shape)


def scattered_files(files: DataFrame, variable: str, fills: list[float], shape: Shape) -> DataFrame:
    """`scattered` of whole day files (stamp, content): Parquet is decoded to arrays in the task that reads the file, so no
    cell ever becomes a row. Values that are fill, of type float, count as NaN."""
    masked = np.array(fills, "<f4")

    def arrays(batch: pa.RecordBatch) -> Iterator[Arrays]:
        for stamp, content in zip(batch.column("stamp").to_pylist(), batch.column("content"), strict=True):
            day = (dt.datetime.strptime(stamp, "%Y%j").date() - EPOCH).days
            file = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
            for i in range(file.num_row_groups):
                group = file.read_row_group(i, ["y", "x", variable])
                y, x = (group.column(c).cast(pa.int32()).to_numpy() for c in ("y", "x"))
                v = group.column(variable).cast(pa.float32()).to_numpy()
                yield np.full(len(v), day, np.int32), y, x, np.where(np.isin(v, masked), np.float32(np.nan), v)

    return fragments_of(files.select("stamp", "content"), arrays, shape)


def fragments_of(source: DataFrame, arrays: Callable[[pa.RecordBatch], Iterator[Arrays]], shape: Shape) -> DataFrame:
    """A task holds a bounded number of cells, sorts them by piece and place unless they come so, and sends bytes;
    nothing is a row a cell from here on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            key, place, v = (np.concatenate([h[i] for h in held]) for i in range(3))
            rank = key * shape.cells + place
            if (rank[1:] < rank[:-1]).any():
                order = np.argsort(rank, kind="stable")
                key, place, v = key[order], place[order], v[order]
            edges = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts = np.unique(np.concatenate([[0], edges, np.arange(0, len(key), FRAGMENT_CELLS)]))
            ends = np.append(starts[1:], len(key))
            place = place.astype("<i4")
            places = [pack_places(place[a:b]) for a, b in zip(starts, ends, strict=True)]
            for at in range(0, len(starts), 256):  # bounds a batch
                some = slice(at, at + 256)
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[starts[some]]), pa.array((ends - starts)[some], pa.int32()), pa.array(places[some], pa.binary()),
                    pa.array([v[a:b].tobytes() for a, b in zip(starts[some], ends[some], strict=True)], pa.binary()),
                ], ["key", "n", "places", "numbers"])

        for t, y, x, v in (a for batch in batches for a in arrays(batch)):
            v = v.astype("<f4")
            there = ~np.isnan(v)
            if not there.all():
                t, y, x, v = t[there], y[there], x[there], v[there]
            if len(v):
                held.append((*shape.places(t, y, x), v))
                n += len(v)
            if n >= HELD_CELLS:
                yield from out()
                held, n = [], 0
        if held:
            yield from out()

    return source.mapInArrow(run, FRAGMENTS)


def pack_places(place: np.ndarray) -> bytes:
    """Ascending places: the first alone if they follow each other, else their steps, which compress well."""
    if int(place[-1]) - int(place[0]) + 1 == len(place):
        return place[:1].tobytes()
    return np.diff(place, prepend=np.int32(0)).astype("<i4").tobytes()


def unpack_places(content: bytes, n: int) -> np.ndarray:
    steps = np.frombuffer(content, "<i4")
    return np.arange(n, dtype=np.int64) + int(steps[0]) if len(steps) == 1 else np.cumsum(steps.astype(np.int64))


def compressed(content: bytes) -> bytes:
    return pa.Codec("zstd", LEVEL).compress(content, asbytes=True)


def encoded(values: np.ndarray) -> tuple[bytes, bytes]:
    """(bitmap of the places with a value, the values there with their bytes sorted by place), both compressed."""
    there = ~np.isnan(values)
    own = values[there].astype("<f4")
    return compressed(np.packbits(there, bitorder="little").tobytes()), compressed(own.view(np.uint8).reshape(-1, 4).T.tobytes())


def decoded(valid: bytes, payload: bytes, n_cells: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a piece of ``cells`` cells."""
    codec = pa.Codec("zstd")
    bits = np.frombuffer(codec.decompress(valid, -(-cells // 8), asbytes=True), np.uint8)
    places = np.flatnonzero(np.unpackbits(bits, count=cells, bitorder="little"))
    shuffled = np.frombuffer(codec.decompress(payload, 4 * n_cells, asbytes=True), np.uint8)
    return places, shuffled.reshape(4, -1).T.copy().view("<f4").reshape(-1)


def summed(shape: Shape, key: int, places: np.ndarray, values: np.ndarray) -> dict:
    """What the manifest says of a piece: extents, bounds, and digests that are the same in whatever pieces the cells lie,
    for they are exclusive ors of the cells' hashes. Which cells a day has: a digest a run of days with the same cells,
    so a mask that stands still is one entry. Values: a digest a span of SPAN days and one a row of the grid."""
    t, y, x = shape.back(shape.piece(key), places)
    place = mixed(y.astype(np.int64) * shape.grid[1] + x)
    days = mixed(np.arange(int(t[0]), int(t[-1]) + 1))
    value = mixed(place ^ days[t - t[0]] ^ (values.view(np.uint32).astype(np.uint64) << np.uint64(7)))
    folded = lambda h, at: np.bitwise_xor.reduceat(h, at).view(np.int64)
    day_at = np.flatnonzero(np.diff(t, prepend=t[0] - 1))  # places go by day first
    day, cells, mask = t[day_at], np.diff(np.append(day_at, len(t))), folded(place, day_at)
    new = np.ones(len(day), bool)
    new[1:] = (np.diff(day) != 1) | (np.diff(cells) != 0) | (mask[1:] != mask[:-1])
    run_at = np.flatnonzero(new)
    span = (t - shape.day0) // SPAN
    span_at = np.flatnonzero(np.diff(span, prepend=-1))
    row, of_row = y, value
    if (row[1:] < row[:-1]).any():
        order = np.argsort(row, kind="stable")
        row, of_row = row[order], value[order]
    row_at = np.flatnonzero(np.diff(row, prepend=-1))
    return {
        "v_min": float(values.min()), "v_max": float(values.max()), "n_negative": int((values < 0).sum()),
        "y0": int(y.min()), "y1": int(y.max()) + 1, "x0": int(x.min()), "x1": int(x.max()) + 1,
        "mask_from": day[run_at].astype(np.int32).tolist(), "mask_days": np.diff(np.append(run_at, len(day))).tolist(),
        "mask_cells": cells[run_at].tolist(), "mask_places": mask[run_at].tolist(),
        "spans": span[span_at].tolist(), "span_values": folded(value, span_at).tolist(), "rows": row[row_at].tolist(), "row_values": folded(of_row, row_at).tolist(),
    }


KINDS = {
    "tc": pa.int64(), "ty": pa.int32(), "tx": pa.int32(), "part": pa.int32(), "n_cells": pa.int32(), "n_bytes": pa.int64(), "v_min": pa.float32(), "v_max": pa.float32(),
    "n_negative": pa.int32(), "y0": pa.int32(), "y1": pa.int32(), "x0": pa.int32(), "x1": pa.int32(), "mask_from": pa.list_(pa.int32()), "mask_days": pa.list_(pa.int32()),
    "mask_cells": pa.list_(pa.int32()), "mask_places": pa.list_(pa.int64()), "spans": pa.list_(pa.int32()), "span_values": pa.list_(pa.int64()), "rows": pa.list_(pa.int32()), "row_values": pa.list_(pa.int64()), "valid": pa.binary(), "payload": pa.binary(),
}


def as_batch(rows: list[dict]) -> pa.RecordBatch:
    batch = [pa.array([r[c] for r in rows], kind) for c, kind in KINDS.items()]
    at = list(KINDS).index("mask_from")
    batch[at] = batch[at].cast(pa.list_(pa.date32()))
    return pa.RecordBatch.from_arrays(batch, list(KINDS))


def row_of(shape: Shape, key: int, places: np.ndarray, values: np.ndarray) -> dict:
    whole = np.full(shape.cells, np.nan, "<f4")
    whole[places] = values
    valid, payload = encoded(whole)
    tc, ty, tx, part = shape.piece(key)
    return {"tc": tc, "ty": ty, "tx": tx, "part": part, "n_cells": len(values), "n_bytes": len(valid) + len(payload), **summed(shape, key, places, values), "valid": valid, "payload": payload}


def gathered(fragments: DataFrame, shape: Shape, parts: int | None = None, by: Column | str = "key") -> DataFrame:
    """The encoded pieces of fragments. Fragments of a piece meet in one task, in order of pieces, and are put together a
    piece at a time; a piece is bounded by the shape. ``by`` may deal more than a piece to a task. A cell that stands twice
    is refused."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out() -> pa.RecordBatch:
            places = np.concatenate([p for p, _ in held])
            values = np.concatenate([v for _, v in held])
            if (places[1:] < places[:-1]).any():
                order = np.argsort(places, kind="stable")
                places, values = places[order], values[order]
            if (places[1:] == places[:-1]).any():
                raise ValueError(f"a cell of piece {shape.piece(key)} stands twice")
            return as_batch([row_of(shape, key, places, values)])

        for batch in batches:
            for k, n, places, numbers in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "places", "numbers")), strict=True):
                if held and k != key:
                    yield out()
                    held = []
                key = k
                held.append((unpack_places(places, n), np.frombuffer(numbers, "<f4")))
        if held:
            yield out()

    dealt = fragments.repartition(parts, by) if parts else fragments.repartition(by)
    return dealt.sortWithinPartitions("key").mapInArrow(run, PIECES)


def cells_of_pieces(pieces: DataFrame, shape: Shape, t: tuple[int | None, int | None] = (None, None), y: tuple[int, int] | None = None, x: tuple[int, int] | None = None) -> DataFrame:
    """(tc, ty, tx, t, y, x, v) of pieces, of a half-open box (``t`` in days since 1970) if one is given; what lies outside
    is left out before it becomes a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tc, ty, tx, part, n, valid, payload in zip(*(batch.column(c).to_pylist() for c in ("tc", "ty", "tx", "part", "n_cells", "valid", "payload")), strict=True):
                places, values = decoded(valid, payload, n, shape.cells)
                day, row, column = shape.back((tc, ty, tx, part), places)
                inside = np.ones(len(places), bool)
                for own, (low, high) in ((day, t), (row, y or (None, None)), (column, x or (None, None))):
                    if low is not None:
                        inside &= own >= low
                    if high is not None:
                        inside &= own < high
                if not inside.all():
                    day, row, column, values = day[inside], row[inside], column[inside], values[inside]
                for at in range(0, len(values), 1 << 18):
                    some = slice(at, at + (1 << 18))
                    m = len(values[some])
                    same = lambda value, kind: pa.array(np.full(m, value), kind)  # noqa: E731, B023
                    yield pa.RecordBatch.from_arrays([
                        same(tc, pa.int64()), same(ty, pa.int32()), same(tx, pa.int32()), pa.array(day[some].astype(np.int32)).cast(pa.date32()),
                        pa.array(row[some].astype(np.int32)), pa.array(column[some].astype(np.int32)), pa.array(values[some]),
                    ], ["tc", "ty", "tx", "t", "y", "x", "v"])

    return pieces.select("tc", "ty", "tx", "part", "n_cells", "valid", "payload").mapInArrow(run, CELLS)


def recounted(pieces: DataFrame, shape: Shape) -> DataFrame:
    """The pieces with everything but their bytes worked out again from the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tc, ty, tx, part, n, valid, payload in zip(*(batch.column(c).to_pylist() for c in ("tc", "ty", "tx", "part", "n_cells", "valid", "payload")), strict=True):
                places, values = decoded(valid, payload, n, shape.cells)
                key = ((tc * shape.tall + ty) * shape.wide + tx) * shape.parts + part
                yield as_batch([{
                    "tc": tc, "ty": ty, "tx": tx, "part": part, "n_cells": len(values), "n_bytes": len(valid) + len(payload), **summed(shape, key, places, values),
                    "valid": None, "payload": None,
                }])

    return pieces.select("tc", "ty", "tx", "part", "n_cells", "valid", "payload").mapInArrow(run, PIECES).drop("valid", "payload")
