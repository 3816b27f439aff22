"""Removing words under windows that stand earlier in the corpus, by level-wise doubling.

A window is ``length`` consecutive words of one document. Windows of ``base`` words are
counted first; only where two windows of one level that both repeat stand side by side
can a window of twice that length repeat, so just those are the candidates of the next
level, until ``length`` is reached or no candidate survives. Most of a corpus leaves
with the first level.

How it is laid out:

* Texts are stored once as parts of ``PART`` bytes in the order they are read, so a part
  is bounded whatever the ids, nulls or lengths of texts are. A longer text is a part.
* A level sends one short code per distinct window of a part to the slice of the codes it
  falls into (32 bits in a slice, sorted, differences squeezed), the slice counts them, and
  returns one bit per code. Short codes can only let too much through. Their number in a
  slice is bounded by the number of shuffle tasks, so chance hits do not grow with input.
* What survives travels as segments of text, so later levels never see the rest.
* The last level sends codes of 96 bits with the lowest id of the part. It returns a bit
  where a lower id holds the same window; the order inside a part is decided there.
* A passage that a third of all documents share is one code per part, never a group.

Words have codes of 64 bits (XXH3), and windows of the last level 96 bits from them. Two
unequal windows of n that repeat share all of them with a chance of about n²/2^97, below
one in ten thousand for n = 4e12.

Defined results: a null text has no words; texts shorter than ``length`` words are kept
whole; a null id counts as the largest; rows with equal ids (or none) remove nothing from
each other, but each from itself; repeated rows come out as often as they went in; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from plumelake.llm.common import partitions, written
from plumelake.llm.packed import distinct, spread, squeeze
from plumelake.session import Workspace

LENGTH, BASE = 20, 5
PART = 2 << 20          # bytes of words in a part
SLICES = 2              # slices of the codes per shuffle task
NO_ID = np.iinfo(np.int64).max

# A row is the state of a part (slice -1, ``payload`` its words) or a message of a part to
# a slice or back. ``rows``, ``ids``, ``at`` and ``sizes`` belong to the segments of the
# state: document in the part, its id, first word in the part, and number of words.
_ROW = "part long, slice int, rows binary, ids binary, at binary, sizes binary, open binary, payload binary"
_COLUMNS = [c.split()[0] for c in _ROW.split(", ")]
_STATE = -1

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def levels(length: int, base: int) -> list[int]:
    """Lengths of the levels, each twice the one before."""
    out = [base]
    while out[-1] < length:
        out.append(2 * out[-1])
    if out[-1] != length:
        raise ValueError("length must be base times a power of two")
    return out


def _pair(a: np.ndarray, b: np.ndarray, seed: int = 0) -> np.ndarray:
    """Codes of joined windows; the order counts."""
    x = (a + np.uint64(seed)) * _A + (b ^ (b >> np.uint64(31))) * _B
    x = (x ^ (x >> np.uint64(32))) * _C
    return x ^ (x >> np.uint64(29))


def _windows(codes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Codes of all windows of ``length`` words, put together by doubling."""
    have, size, out, done = codes, 1, None, 0
    while True:
        if length & size:
            if out is None:
                out = have
            else:
                n = len(have) - done
                out = _pair(out[:max(n, 0)], have[done:], seed)
            done += size
        if 2 * size > length:
            return out
        have = _pair(have[:max(len(have) - size, 0)], have[size:], seed)
        size *= 2


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_COLUMNS)


class _State:
    """The words of a part that are still of interest, in segments of one document each."""

    def __init__(self, row) -> None:
        self.part = int(row.part)
        self.rows, self.ids = np.frombuffer(row.rows, np.int32), np.frombuffer(row.ids, np.int64)
        self.at, self.sizes = np.frombuffer(row.at, np.int64), np.frombuffer(row.sizes, np.int64)
        self.words = zstandard.ZstdDecompressor().decompress(row.payload).split()
        self.codes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        ends = np.cumsum(self.sizes)
        self.segment = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.left = np.repeat(ends, self.sizes) - np.arange(len(self.words))    # words to the end
        self.open = row.open

    def candidates(self, length: int) -> np.ndarray:
        """First words of the windows that this level has to judge."""
        if self.open:
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.open), np.uint8)
            return np.nonzero(np.unpackbits(raw, count=len(self.words)))[0]
        return np.nonzero(self.left >= length)[0]

    def place(self, word: np.ndarray) -> np.ndarray:
        """Places of words in the whole part."""
        before = np.cumsum(self.sizes) - self.sizes
        return self.at[self.segment[word]] + word - before[self.segment[word]]


def _short(codes: np.ndarray, slices: int) -> np.ndarray:
    """Slice in the upper half, short code in the lower half."""
    low = np.uint64(0xFFFFFFFF)
    return (((codes >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)) << np.uint64(32) | codes & low


def _cuts(slices_of: np.ndarray) -> list[tuple[int, int, int]]:
    """(slice, from, to) of the runs of a sorted array."""
    if not len(slices_of):
        return []
    starts = np.concatenate([[0], np.nonzero(np.diff(slices_of))[0] + 1])
    return [(int(slices_of[a]), int(a), int(b)) for a, b in zip(starts, np.append(starts[1:], len(slices_of)))]


def _message(part: int, slice_: int, payload: bytes) -> tuple:
    return part, slice_, None, None, None, None, None, payload


def _short_messages(part: int, keys: np.ndarray) -> list:
    """``keys``: distinct and sorted."""
    out = []
    for s, a, b in _cuts((keys >> np.uint64(32)).astype(np.int64)):
        own = keys[a:b].astype(np.uint32)
        out.append(_message(part, s, squeeze(np.diff(own, prepend=np.uint32(0)).astype(np.uint32))))
    return out


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the keys, first place of each group, group of each place."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, bool)
    return order, np.nonzero(new)[0], np.cumsum(new) - 1


def _bits(known: pd.DataFrame, cuts: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """The answers of the slices for the groups of a part."""
    out, body = np.zeros(n, bool), dict(zip(known["slice"].tolist(), known["payload"]))
    for s, a, b in cuts:
        if s in body:
            out[a:b] = np.unpackbits(np.frombuffer(body[s], np.uint8), count=b - a)
    return out


# --- texts to parts ---------------------------------------------------------------

def _pack(part_bytes: int):
    def close(ids: list, texts: list, sizes: list) -> pd.DataFrame:
        counts = np.array(sizes, np.int64)
        return _frame([(uuid.uuid4().int >> 65, _STATE, np.arange(len(ids), dtype=np.int32).tobytes(),
                        np.array(ids, np.int64).tobytes(), (np.cumsum(counts) - counts).tobytes(), counts.tobytes(),
                        None, zstandard.ZstdCompressor(level=6).compress(b" ".join(t for t in texts if t)))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, sizes, held = [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch["_id"].tolist(), batch["_text"]):
                own = (text or "").encode().split()     # bytes: splits at the six ASCII blanks only
                ids.append(doc)
                texts.append(b" ".join(own))
                sizes.append(len(own))
                held += len(texts[-1]) + 16
                if held >= part_bytes:
                    yield close(ids, texts, sizes)
                    ids, texts, sizes, held = [], [], [], 0
        if ids:
            yield close(ids, texts, sizes)
    return run


# --- levels -----------------------------------------------------------------------

def _send_base(length: int, slices: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                state = _State(row)
                every = _windows(state.codes, length)
                found = _short_messages(state.part, distinct(_short(every[state.candidates(length)], slices)))
                if found:
                    yield _frame(found)
    return run


def _count(key: tuple, messages: pd.DataFrame) -> pd.DataFrame:
    """Of each message, one bit per code: whether another part sent it too."""
    sent = [np.cumsum(spread(p, np.uint32), dtype=np.uint32) for p in messages["payload"]]
    every = np.sort(np.concatenate(sent))
    many = distinct(every[1:][every[1:] == every[:-1]])
    out = []
    for part, own in zip(messages["part"], sent):
        hit = np.zeros(len(own), bool)
        if len(many):
            hit = many[np.minimum(np.searchsorted(many, own), len(many) - 1)] == own
        if hit.any():
            out.append(_message(part, key[0], np.packbits(hit).tobytes()))
    return _frame(out)


def _survivors(state: _State, known: pd.DataFrame, length: int, slices: int) -> np.ndarray:
    """First words of the windows of a level that occur twice or more."""
    at = state.candidates(length)
    keys = _short(_windows(state.codes, length)[at], slices)
    order, first, group = _groups(keys)
    again = np.diff(np.append(first, len(keys))) > 1
    again |= _bits(known, _cuts((keys[order][first] >> np.uint64(32)).astype(np.int64)), len(first))
    return at[np.sort(order[again[group]])]


def _narrowed(state: _State, at: np.ndarray, length: int) -> tuple:
    """The state cut down to the words under the windows that begin at ``at``."""
    edges = np.zeros(len(state.words) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + length, -1)
    under = np.cumsum(edges[:-1]) > 0
    kept = np.nonzero(under)[0]
    new = np.concatenate([[True], (kept[1:] > kept[:-1] + 1) | (state.segment[kept[1:]] != state.segment[kept[:-1]])])
    first = kept[new]
    sizes = np.diff(np.append(np.nonzero(new)[0], len(kept))).astype(np.int64)
    mask = np.zeros(len(state.words), bool)
    mask[at] = True
    zstd = zstandard.ZstdCompressor(level=3)
    words = state.words
    return (state.part, _STATE, state.rows[state.segment[first]].tobytes(), state.ids[state.segment[first]].tobytes(),
            state.place(first).astype(np.int64).tobytes(), sizes.tobytes(),
            zstd.compress(np.packbits(mask[kept]).tobytes()),
            zstd.compress(b" ".join([words[i] for i in kept.tolist()])))


def _full_groups(state: _State, at: np.ndarray, length: int, slices: int):
    """Groups of equal windows in the order of their slices: order, first place of each
    group, group of each place, both halves of the codes, slices of the groups."""
    a = _windows(state.codes, length)[at]
    b = (_windows(state.codes, length, 1)[at] >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((at, b, a))
    a, b = a[order], b[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(at) else np.zeros(0, bool)
    first = np.nonzero(new)[0]
    slice_of = (_short(a[first], slices) >> np.uint64(32)).astype(np.int64)
    return order, first, np.cumsum(new) - 1, a[first], b[first], slice_of


def _extend(length: int, last: bool, slices: int):
    """From the windows of ``length`` that repeat to the candidates of twice that length,
    which are sent to be counted."""
    def run(key: tuple, parts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in parts.itertuples():
            state = _State(row)
            there = np.zeros(len(state.words) + length, bool)
            there[_survivors(state, known, length, slices)] = True
            n = len(state.words)
            at = np.nonzero(there[:n] & there[length:] & (state.left >= 2 * length))[0]
            if not len(at):
                continue
            out.append(_narrowed(state, at, 2 * length))
            if not last:
                keys = _short(_windows(state.codes, 2 * length)[at], slices)
                out += _short_messages(state.part, distinct(keys))
                continue
            order, first, _, high, low, slice_of = _full_groups(state, at, 2 * length, slices)
            lowest = np.minimum.reduceat(state.ids[state.segment[at[order]]], first)
            for s, x, y in _cuts(slice_of):
                bodies = [squeeze(np.diff(high[x:y], prepend=np.uint64(0))), squeeze(low[x:y]), squeeze(lowest[x:y])]
                out.append(_message(state.part, s, struct.pack("<3I", *map(len, bodies)) + b"".join(bodies)))
        return _frame(out)
    return run


def _lowest(key: tuple, messages: pd.DataFrame) -> pd.DataFrame:
    """Of each message, one bit per window: whether a lower id than the part's own holds it."""
    sent = []
    for body in messages["payload"]:
        ends = np.cumsum([12, *struct.unpack_from("<3I", body)]).tolist()
        high, low, lowest = (spread(body[x:y], kind) for x, y, kind in zip(
            ends, ends[1:], (np.uint64, np.uint32, np.int64)))
        sent.append((np.cumsum(high, dtype=np.uint64), low, lowest))
    a, b, ids = (np.concatenate(c) for c in zip(*sent))
    order = np.lexsort((b, a))
    new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
    low = np.minimum.reduceat(ids[order], np.nonzero(new)[0])[np.cumsum(new) - 1]
    hit = np.zeros(len(ids), bool)
    hit[order] = low < ids[order]
    ends = np.cumsum([len(s[2]) for s in sent])
    out = []
    for part, own in zip(messages["part"], np.split(hit, ends[:-1])):
        if own.any():
            out.append(_message(part, key[0], np.packbits(own).tobytes()))
    return _frame(out)


# --- the documents without what repeats ---------------------------------------------

_KEPT = "_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _gone(state: _State, known: pd.DataFrame, length: int, slices: int) -> np.ndarray:
    """Places in the part of the first words of removed windows."""
    at = state.candidates(length)
    order, first, group, _, _, slice_of = _full_groups(state, at, length, slices)
    lower = _bits(known, _cuts(slice_of), len(first))
    word = at[order]
    ids, rows = state.ids[state.segment[word]], state.rows[state.segment[word]]
    lowest = np.minimum.reduceat(ids, first)[group]
    same = np.concatenate([[False], (group[1:] == group[:-1]) & (rows[1:] == rows[:-1])])
    return state.place(word[lower[group] | (ids > lowest) | same])


def _cut(length: int, slices: int, with_text: bool):
    def run(key: tuple, parts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        known, out = found[found["slice"] != _STATE], []
        states = found[found["slice"] == _STATE]
        for row in parts.itertuples():
            ids, sizes = np.frombuffer(row.ids, np.int64), np.frombuffer(row.sizes, np.int64)
            words = zstandard.ZstdDecompressor().decompress(row.payload).split()
            gone = np.zeros(len(words) + 1, np.int64)
            for state in states.itertuples():
                at = _gone(_State(state), known, length, slices)
                np.add.at(gone, at, 1)
                np.add.at(gone, at + length, -1)
            stay = np.cumsum(gone[:-1]) == 0
            ends = np.cumsum(sizes)
            kept_before = np.concatenate([[0], np.cumsum(stay)])
            n_kept = kept_before[ends] - kept_before[ends - sizes]
            for doc, a, b, n in zip(ids.tolist(), (ends - sizes).tolist(), ends.tolist(), n_kept.tolist()):
                own = words[a:b] if n == b - a else [words[i] for i in (np.nonzero(stay[a:b])[0] + a).tolist()]
                left = b" ".join(own)
                out.append((None if doc == NO_ID else doc, b - a, b - a - n, hashlib.sha256(left).hexdigest(),
                            left.decode() if with_text else None))
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in _KEPT.split(", ")])
        return frame.astype({"_id": "Int64"})
    return run


def remove_windows(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = LENGTH,
                   base: int = BASE, with_text: bool = False, part_bytes: int = PART) -> DataFrame:
    """A row per document: the id, n_words, n_removed, kept_sha256 and, if ``with_text``,
    the words that stay, joined by blanks, in ``kept``. Runs its levels when called and
    stores the result; what it stores on the way is deleted."""
    spark, slices = docs.sparkSession, SLICES * partitions(docs)
    steps = levels(length, base)
    if len(steps) < 2:
        raise ValueError("length must be at least twice base")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("_id"),
                       F.col(text).cast("string").alias("_text"))
    with Workspace(spark, "windows") as space:
        parts = space.written(rows.mapInPandas(_pack(part_bytes), _ROW), "parts")
        state = parts
        sent = parts.mapInPandas(_send_base(base, slices), _ROW)
        for size in steps[:-1]:
            known = sent.groupBy("slice").applyInPandas(_count, _ROW)
            last = 2 * size == length
            level = space.written(state.groupBy("part").cogroup(known.groupBy("part")).applyInPandas(
                _extend(size, last, slices), _ROW), f"level-{2 * size}")
            state, sent = level.where(F.col("slice") == _STATE), level.where(F.col("slice") != _STATE)
        found = state.unionByName(sent.groupBy("slice").applyInPandas(_lowest, _ROW))
        cut = parts.groupBy("part").cogroup(found.groupBy("part")).applyInPandas(
            _cut(length, slices, with_text), _KEPT)
        done = written(cut.withColumnRenamed("_id", id_col) if with_text
                       else cut.withColumnRenamed("_id", id_col).drop("kept"), "windows-removed")
    return done
