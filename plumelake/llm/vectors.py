"""Vectors in blocks: packing rows, exact integer products, and meetings of two sets of
blocks, for operators that compare a stated set of rows with all rows.

A block holds up to ``size`` vectors of one length as rows of whole numbers, as short ones
where they fit. ``block`` is a random number that belongs to the stored block, so a row is
named by its block and its place in it, whatever its id is and however often it repeats.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plumelake.llm.common import partitions
from plumelake.llm.packed import spread, squeeze

SCALE = 256             # fixed value: components are floor(256 x)
BLOCKS = "dim int, block long, ids binary, labels binary, data binary"
SALTS = 64              # groups that blocks are dealt to, at most: the other side is moved as often
SPAN, WORK = 1 << 16, 1 << 29       # rows of such a group, and pairs of rows it makes, as long as there are few
CELLS = 1 << 18         # scores made at once
WIDTH = 512             # scores of a row that are looked at together
_KINDS = (np.int16, np.int32, np.int64)
FIRST = 256             # rows of the first block that are looked at before the others


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))


def body(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: short ones if all are, else doubles."""
    short = np.abs(values).max(initial=0) < 2 ** 15
    return (b"s" if short else b"d") + squeeze(np.ascontiguousarray(values, np.int16 if short else np.float64).ravel())


def matrix(body: bytes, dim: int, n: int) -> np.ndarray:
    return spread(body[1:], np.int16 if body[:1] == b"s" else np.float64).reshape(n, dim)


def pack_blocks(size: int):
    """Task function: rows of vec_id, label and embedding to blocks."""
    columns = [c.split()[0] for c in BLOCKS.split(", ")]

    def block(part: list) -> tuple:
        ids, labels, data = zip(*part)
        scaled = np.floor(SCALE * np.array(data, np.float64)).reshape(len(part), -1)
        return (scaled.shape[1], uuid.uuid4().int >> 65, np.array(ids, np.int64).tobytes(),
                np.array(labels, np.int64).tobytes(), body(scaled))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list] = {}       # by length of the vectors
        for batch in batches:
            for row in zip(batch["vec_id"], batch["label"], batch["embedding"]):
                part = waiting.setdefault(len(row[2]), [])
                part.append(row)
                if len(part) == size:
                    yield pd.DataFrame([block(waiting.pop(len(row[2])))], columns=columns)
        for part in waiting.values():
            yield pd.DataFrame([block(part)], columns=columns)
    return run


def longs(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.int64)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers in one short value."""
    bodies = []
    for a in arrays:
        ends = (int(a.min()), int(a.max())) if len(a) else (0, 0)
        at = next(i for i, k in enumerate(_KINDS) if np.iinfo(k).min <= ends[0] and ends[1] <= np.iinfo(k).max)
        bodies.append(bytes([at]) + squeeze(a.astype(_KINDS[at])))
    return np.array([len(bodies), *map(len, bodies)], np.int64).tobytes() + b"".join(bodies)


def unpacked(body: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(body, np.int64, 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.concatenate([[0], np.frombuffer(body, np.int64, n, 8)]))
    return [spread(body[a + 1:b], _KINDS[body[a]]).astype(np.int64) for a, b in zip(ends, ends[1:])]


class Rows:
    """Vectors as rows, and the same as the numbers that products are made with."""

    def __init__(self, values: np.ndarray):
        self.values, self.most = values, float(np.abs(values).max(initial=0)) + 1
        self.cast: dict = {}

    def __len__(self) -> int:
        return len(self.values)

    def of(self, kind, size: int = 1) -> np.ndarray:
        """Filled up with zeros to a multiple of ``size`` rows."""
        if (kind, size) not in self.cast:
            found = np.zeros((-(-len(self.values) // size) * size, self.values.shape[1]), kind)
            found[:len(self.values)] = self.values
            self.cast[kind, size] = found
        return self.cast[kind, size]


def kind(a: Rows, b: Rows):
    """The fastest numbers that hold all products of rows of a and b, and the steps to them,
    exactly: floats up to 2^24, doubles up to 2^53, longs, slower, beyond."""
    most = a.most * b.most * max(a.values.shape[1], 1)
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def reaching(a: Rows, b: Rows, low: np.ndarray, high: np.ndarray | None = None,
             most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a, rows of b and their products, where these are from ``low`` to ``high`` of the
    row of a, in pieces. With ``most``, of a piece that is full of them only the ``most``
    highest of each row and their ties."""
    if not len(a) or not len(b):
        return
    of, width = kind(a, b), min(WIDTH, -(-len(b) // 32) * 32)
    left, right = a.of(of), b.of(of, width)
    step = max(1, CELLS // len(right))
    # Products are whole numbers.
    low, high = np.ceil(low), None if high is None else np.floor(high)
    if of is np.float32:
        low, high = low.astype(of), None if high is None else high.astype(of)
    room = np.empty((min(step, len(a)), len(right)), of)
    for i in range(0, len(a), step):
        floor = low[i:i + step]
        scores = np.matmul(left[i:i + step], right.T, out=room[:len(floor)])
        groups = scores.reshape(len(floor), -1, width)
        r, g = np.nonzero(groups.max(axis=2) >= floor[:, None])
        if not len(r):
            continue
        if 2 * len(r) > groups.shape[0] * groups.shape[1]:      # most of them: all are looked at where they are
            near, r, g = groups.reshape(-1, width), *np.divmod(np.arange(groups.shape[0] * groups.shape[1]), groups.shape[1])
            inside = (groups >= floor[:, None, None]).reshape(-1, width)
        else:
            near = groups[r, g]
            inside = near >= floor[r, None]
        at = _true(inside.ravel())
        r, c, found = r[at // width], g[at // width] * width + at % width, near.ravel()[at]
        if len(right) > len(b):
            real = c < len(b)
            r, c, found = r[real], c[real], found[real]
        if high is not None:
            within = found <= high[i:i + step][r]
            r, c, found = r[within], c[within], found[within]
        if most is not None and len(r) > 4 * most * len(floor):
            own = scores[:, :len(b)]
            r, c = highest(own, own >= floor[:, None], most)
            found = own[r, c]
        if len(r):
            yield r + i, c, found.astype(np.int64)


def _true(flags: np.ndarray) -> np.ndarray:
    """Places of the flags that are set, of which there are few; their number is divisible by 8."""
    at = np.flatnonzero(flags.view(np.uint64))[:, None] * 8 + np.arange(8)
    return at[flags.reshape(-1, 8)[at[:, 0] // 8]]


def best(groups: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best entries of each group, by score and smaller id."""
    if not len(groups):
        return np.zeros(0, np.int64)
    order = _ordered(groups, ids, scores)
    ordered = groups[order]
    starts = np.concatenate([[0], np.nonzero(ordered[1:] != ordered[:-1])[0] + 1])
    rank = np.arange(len(groups)) - np.repeat(starts, np.diff(np.append(starts, len(groups))))
    return order[rank < k]


def _ordered(groups: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Places by group, score from the top, and id. One number for group and score, where
    there is one, is sorted much faster than three."""
    least, top = int(scores.min()), int(scores.max())
    if groups.min() < 0 or (int(groups.max()) + 1) * (top - least + 1) >= 2 ** 63:
        return np.lexsort((ids, -scores, groups))
    key = groups.astype(np.int64) * (top - least + 1) + (top - scores)
    order = np.argsort(key)
    equal = np.diff(key[order]) == 0
    if equal.any():
        tied = np.nonzero(np.append(equal, False) | np.append(False, equal))[0]
        own = order[tied]
        order[tied] = own[np.lexsort((ids[own], key[own]))]
    return order


class Best:
    """The ``k`` best entries of each of ``n`` groups among those that were added. An entry
    is its group, id, score and whatever else names it. ``low``: the score below which no
    entry of a group is needed any more."""

    def __init__(self, n: int, k: int):
        self.k, self.low, self.waiting, self.parts, self.held = k, np.full(n, -np.inf), 0, [], 0

    def add(self, groups: np.ndarray, ids: np.ndarray, scores: np.ndarray, *names: np.ndarray) -> None:
        self.parts.append([groups, ids, scores, *names])
        self.waiting += len(groups)
        if self.waiting > max(1 << 13, self.held):
            self.trim()

    def trim(self) -> list[np.ndarray]:
        """The entries by group, best first."""
        if self.waiting:
            entries = [np.concatenate(c) for c in zip(*self.parts)]
            at = best(*entries[:3], self.k)
            entries = [c[at] for c in entries]
            self.parts, self.waiting, self.held = [entries], 0, len(at)
            groups, scores = entries[0], entries[2]
            last = np.nonzero(groups[self.k - 1:] == groups[:max(0, len(groups) - self.k + 1)])[0] + self.k - 1
            # A long beyond 2^53 may be rounded up as a double: a little lower is still safe.
            score = scores[last].astype(np.float64)
            self.low[groups[last]] = np.where(np.abs(score) < 2 ** 53, score, score - np.abs(score) * 2.0 ** -50)
        return self.parts[0] if self.parts else []


def highest(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the allowed entries that reach the k-th highest of their row:
    the k best of each row, and all that tie with the last of them."""
    if scores.shape[1] > k:
        least = -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min
        low = np.where(allowed, scores, scores.dtype.type(least))
        allowed = allowed & (low >= np.partition(low, -k, axis=1)[:, -k:][:, :1])
    return np.nonzero(allowed)


def stretches(n: int, first: bool) -> list[slice]:
    """Columns of a block in the order in which they are looked at: at first a few, which
    tell what the others must reach."""
    cuts = [0, *(c for c in (FIRST, 4 * FIRST) if first and c < n), n]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def salts(blocks: DataFrame, n: int) -> int:
    """Groups to deal the blocks to, which meet ``n`` rows."""
    rows = blocks.agg(F.coalesce(F.sum(F.length("ids")), F.lit(0))).first()[0] // 8
    return max(1, min(SALTS, partitions(blocks), max(-(-rows // SPAN), rows * n // WORK)))


def meet(asked: DataFrame, blocks: DataFrame, n: int, salts: int, held: int, by: str = "dim",
         lanes: int = 1, lane: str = "0", others: DataFrame | None = None) -> DataFrame:
    """Rows for ``met``: every block of ``asked``, of ``n`` rows in all, meets every block of
    ``blocks`` that is equal in ``by``. A task takes a group of blocks and holds a group of
    about ``held`` rows of the asked side: what is moved is one copy of the blocks for each
    such group, and one copy of ``asked`` for each group of blocks. ``lane`` deals rows of
    either side to tasks of their own. ``others`` follow the block they name."""
    groups = max(1, -(-n // held))
    every = F.sequence(F.lit(0), F.lit(salts - 1)), F.sequence(F.lit(0), F.lit(groups - 1))

    def side(table: DataFrame, prefix: str, turn: int, block: Column, salt: Column, group: Column) -> DataFrame:
        own = table.select(F.col(by).alias("by"), F.lit(turn).alias("turn"), block.cast("long").alias("at"),
                           F.expr(lane).cast("int").alias("_lane"), salt.alias("_salt"), group.alias("_group"),
                           *[F.col(c).alias(f"{prefix}_{c}") for c in table.columns])
        task = (F.col("_lane") * groups + F.col("_group")) * salts + F.col("_salt")
        return own.withColumn("_task", task.cast("int")).drop("_lane", "_salt", "_group")
    own_salt, own_group = F.pmod("block", F.lit(salts)), F.pmod("q", F.lit(groups))
    rows = side(asked, "q", 0, F.lit(None), F.explode(every[0]), own_group).unionByName(
        side(blocks, "c", 1, F.col("block"), own_salt, F.explode(every[1])), allowMissingColumns=True)
    if others is not None:
        rows = rows.unionByName(side(others, "e", 2, F.col("block"), own_salt, own_group), allowMissingColumns=True)
    last = ["e_q"] if others is not None else []
    return rows.repartitionById(lanes * groups * salts, "_task").sortWithinPartitions(
        "by", F.col("turn") > 0, "at", "turn", *last).drop("_task", "at").fillna(0)      # a null would make longs doubles


def met(batches: Iterator[pd.DataFrame], begin, follow, end) -> Iterator[pd.DataFrame]:
    """Runs over the rows of ``meet``. ``begin`` makes of the asked rows what the task holds,
    ``follow`` takes that and each further row, ``end`` takes it at last."""
    by, asked, state = None, [], None
    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.by != by:
                if state is not None:
                    yield from end(state)
                by, asked, state = row.by, [], None
            if row.turn == 0:
                asked.append(row)
            elif asked:
                state = begin(asked) if state is None else state
                yield from follow(state, row)
    if state is not None:
        yield from end(state)
