"""Removing byte strings that an earlier document already holds, by prefix doubling.

A position of the corpus is ranked by the bytes that follow it, and ranks of twice the
length come from pairs of ranks at growing offsets: (rank of the first L bytes, rank of
the L bytes after them). A position whose rank is unique cannot begin a repeat and
leaves; the rest goes on until the threshold of ``LENGTH`` bytes is reached.

Ranking every byte of the corpus in Spark would move each position several times. Two
things keep the work small without changing the result:

* Ranks of the short lengths are computed where the text is. A rank is a 64-bit
  polynomial of the bytes, so doubling is one multiplication per position and equal
  strings have equal ranks in every task.
* Only positions chosen by their content are ranked across the corpus: in every string
  of ``LENGTH`` bytes, those where the rank of ``ANCHOR`` bytes is lowest (about one
  position in fourteen). Equal strings choose the same positions, so a string that
  repeats has an anchor that repeats at the same place in it.

Round 1 gathers the ranks of anchors by slice of the ranks, cut to 32 bits, and returns
those seen in more than one part of the corpus; all others are unique and leave. What
two ranks cut alike let through leaves in round 2, which gathers the bytes around the
remaining anchors and ranks, by pairs of ranks at growing offsets, the strings of
``LENGTH`` bytes that hold them; a string with a lower document in its rank class is
removed. Equal neighbourhoods are settled before, and one of them is ranked. The exact number of removed bytes follows from the union of strings.

Strings of one rank in round 2 are compared by their bytes, so no chance is left there.

Documents travel in parts of consecutive ids; a long text is a part of its own, and texts
without an id are spread by their content, where copies of one text share a part. A part sends each distinct rank or
neighbourhood once, with its lowest document, so a line that a third of all documents
share is one row per part. Slices and parts are groups of a bounded size; their number
follows the number of shuffle tasks and the ids. Nothing is collected to the driver.

Defined results: a null text is empty; a null id comes after all ids, and such rows
remove nothing from each other; rows with the same id remove nothing from each other;
texts shorter than ``LENGTH`` bytes are kept whole. Ids should be dense: a part is a
range of ids, so sparse ids only mean smaller parts and more of them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from plumelake.llm.common import partitions, written
from plumelake.llm.packed import distinct, spread, squeeze as squeezed

LENGTH = 50
ANCHOR = 24
PART = 512              # consecutive ids in a part of the corpus
LONG = 1 << 16          # bytes of a text that is a part of its own
VOID_PARTS = 1 << 12    # parts of texts without an id
SLICES = 4              # slices of the ranks per shuffle task
NO_ID = np.iinfo(np.int64).max

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_REACH = LENGTH - ANCHOR
_AROUND = LENGTH + _REACH       # bytes of a neighbourhood
_CHUNK = 1 << 15                # bytes ranked at once, which stay near the processor
_ROWS = 1 << 12                 # neighbourhoods ranked at once

_MESSAGE = "slice int, part long, kind int, payload binary"
# ``spot`` is the place of an anchor, with a checksum of the text above it where rows of a
# part have the same id.
_REMOVAL = np.dtype([("id", "<i8"), ("spot", "<u8"), ("mask", "<u4")])


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Ranks of all strings of ``length`` bytes along the last axis, by doubling."""
    have, size = data.astype(np.uint64) + np.uint64(1), 1
    out, done = None, 0
    while True:
        if length & size:
            if out is None:
                out = have
            else:   # pair: the string so far and the next one at offset ``done``
                n = have.shape[-1] - done
                out = out[..., :n] * _power(size) + have[..., done:done + n]
            done += size
        size *= 2
        if size > length:
            return out
        half = size // 2
        n = have.shape[-1] - half
        have = have[..., :n] * _power(half) + have[..., half:half + n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """Lowest or highest of each ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def anchors(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts that lie one behind the other: the number of the text, the position
    in it, the rank, and a mask of the strings it stands for: bit b is the string that
    begins b bytes before it. Texts are ranked together, for most are short."""
    ends = np.cumsum(np.asarray(sizes, np.int64))
    begins = ends - sizes
    inside = np.ones(len(flat), bool)       # strings that lie in one text
    some = ends > begins
    inside[np.maximum(ends[some, None] - np.arange(1, LENGTH), begins[some, None])] = False
    places, codes, masks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
    width, edge = _REACH + 1, np.zeros(_REACH, np.uint64)
    for at in range(0, len(flat), _CHUNK):                  # positions of a chunk
        first, stop = max(at - _REACH, 0), min(at + _CHUNK, len(flat) - LENGTH + 1)
        if stop <= first:
            break
        # Never zero, which stands for no string.
        rank = _mixed(ranks(flat[first:stop + LENGTH - 1], ANCHOR)) | np.uint64(1)
        low = _sliding(rank, width, np.minimum)             # one per string
        low[~inside[first:stop]] = 0
        low = np.concatenate([edge, low, edge])
        # The highest of the lows around a position equals its rank if it is a low.
        chosen = np.nonzero(_sliding(low, width, np.maximum) == rank)[0]
        chosen = chosen[(chosen >= at - first) & (chosen < at - first + _CHUNK)]
        hit = sliding_window_view(low, width)[chosen][:, ::-1] == rank[chosen, None]
        places.append(chosen + first)
        codes.append(rank[chosen])
        masks.append(np.packbits(hit, axis=1, bitorder="little").view("<u4").ravel())
    place = np.concatenate(places)
    text = np.searchsorted(ends, place, "right")
    return text, place - begins[text], np.concatenate(codes), np.concatenate(masks)


def _slice_of(rank: np.ndarray, slices: int) -> np.ndarray:
    """Ranks of anchors are low ones: they are mixed again to be dealt out evenly."""
    return ((_mixed(rank) >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def _part_of(doc: int, data: bytes | np.ndarray) -> int:
    """Consecutive ids share a part, but for long texts, which are parts of their own, and
    texts without an id, which are spread by their content."""
    if doc == NO_ID:
        return -1 - zlib.crc32(data) % VOID_PARTS
    if len(data) > LONG:
        return -(1 << 41) - (doc & (1 << 40) - 1)
    return doc // PART


def _by_slice(rank: np.ndarray, slices: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the ranks of each slice, in their order."""
    where = _slice_of(rank, slices)
    order = np.argsort(where, kind="stable")
    where = where[order]
    starts = np.concatenate([[0], np.nonzero(where[1:] != where[:-1])[0] + 1])
    for a, b in zip(starts, np.append(starts[1:], len(where))):
        if b > a:
            yield int(where[a]), order[a:b]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _marks(ids: np.ndarray, texts: list) -> np.ndarray:
    """A checksum above the place for texts whose id another text of the part has; else 0."""
    order = np.sort(ids)
    again = np.nonzero(_among(ids, distinct(order[1:][order[1:] == order[:-1]])))[0]
    marks = np.zeros(len(ids), np.uint64)
    for n in again.tolist():
        marks[n] = np.uint64(zlib.crc32(texts[n])) << np.uint64(32)
    return marks


def _codes(rank: np.ndarray) -> np.ndarray:
    """What round 1 sends of a rank. That some codes are equal by chance costs a row each."""
    return _mixed(rank).astype(np.uint32)


def _sent(codes: np.ndarray) -> bytes:
    return squeezed(np.diff(distinct(codes), prepend=np.uint32(0)))


def _received(body: bytes) -> np.ndarray:
    return np.cumsum(spread(body, np.uint32), dtype=np.uint32)


def _message(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["slice", "part", "kind", "payload"])


def _texts(batch: pd.DataFrame) -> Iterator[tuple[int, bytes]]:
    for doc, text in zip(batch["_id"].tolist(), batch["_text"]):
        yield doc, (text or "").encode()


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)


def _mixed_rows(rows: np.ndarray) -> np.ndarray:
    """A number per row of bytes, eight or a multiple of them, that equal rows share."""
    words = np.ascontiguousarray(rows).view(np.uint64)
    weights = _mixed(np.arange(1, words.shape[1] + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    out = np.zeros(len(words), np.uint64)
    for n, weight in enumerate(weights):
        out += words[:, n] * weight
    return _mixed(out)


def _classes(rows: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of rows of bytes, equal ones side by side with the lowest document first, and
    which of them begin a class of equal rows. Rows are compared by their bytes: if two
    numbers are equal by chance, a class may only be cut in pieces."""
    order = np.lexsort((doc, _mixed_rows(rows)))
    rows = rows[order]
    return order, np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])


# --- round 1: ranks of anchors --------------------------------------------------

def _send_ranks(slices: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[int, list] = {}
            for doc, data in _texts(batch):
                found.setdefault(_part_of(doc, data), []).append(data)
            for part, texts in found.items():
                rank = distinct(anchors(*_joined(texts))[2])
                codes = _codes(rank)
                yield _message([(s, part, 0, _sent(codes[r])) for s, r in _by_slice(rank, slices)])
    return run


def _repeated(key: tuple, messages: pd.DataFrame) -> pd.DataFrame:
    """Codes that more than one message of a slice holds, back to their senders."""
    sent = [_received(p) for p in messages["payload"]]
    every = np.sort(np.concatenate(sent))
    many = distinct(every[1:][every[1:] == every[:-1]])
    out = []
    for part, codes in zip(messages["part"], sent):
        back = codes[_among(codes, many)]
        if len(back):
            out.append((key[0], part, 1, _sent(back)))
    return _message(out)


def _unpacked(docs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Ids and sizes of the texts of a part, and the texts one behind the other."""
    unpack = zstandard.ZstdDecompressor()
    ids, sizes = (np.concatenate([np.asarray(v, np.int64) for v in docs[c]] + [np.zeros(0, np.int64)]) for c in ("ids", "sizes"))
    return ids, sizes, b"".join(unpack.decompress(b) for b in docs["blob"])


# --- round 2: neighbourhoods ----------------------------------------------------

def _around(flat: np.ndarray, begin: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes from ``_REACH`` before each anchor to ``LENGTH`` after it, zero outside its
    text, which begins at ``begin`` and is ``size`` bytes long."""
    edge = np.zeros(LENGTH, np.uint8)
    near = sliding_window_view(np.concatenate([edge[:_REACH], flat, edge]), _AROUND)[begin + at]
    rim = np.nonzero((at < _REACH) | (at + LENGTH > size))[0]
    place = at[rim, None] + np.arange(-_REACH, LENGTH)
    near[rim] = np.where((place >= 0) & (place < size[rim, None]), near[rim], 0)
    return near


def _send_neighbourhoods(slices: int):
    def run(key: tuple, docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        """Of one part: distinct neighbourhoods of anchors that repeat, with the lowest
        document (kind 2), and what repeats inside the part (kind 3)."""
        squeeze = zstandard.ZstdCompressor(level=6)
        wanted = distinct(np.concatenate([_received(p) for p in known["payload"]] + [np.zeros(0, np.uint32)]))
        ids, sizes, whole = _unpacked(docs)
        flat, begins = np.frombuffer(whole, np.uint8), np.cumsum(sizes) - sizes
        text, place, rank, mask = anchors(flat, sizes)
        # Anchors seen twice in the part repeat too, whatever the other parts hold.
        inside = np.sort(rank)
        hit = _among(_codes(rank), wanted) | _among(rank, distinct(inside[1:][inside[1:] == inside[:-1]]))
        if not hit.any():
            return _message([])
        text, place, rank, mask = (c[hit] for c in (text, place, rank, mask))
        marks = _marks(ids, [flat[a:a + n] for a, n in zip(begins.tolist(), sizes.tolist())])
        doc, spot = ids[text], place.astype(np.uint64) | marks[text]
        near = _around(flat, begins[text], place, sizes[text])
        # One row per distinct neighbourhood and mask, its lowest document first.
        order, new = _classes(np.concatenate([near, mask[:, None].view(np.uint8), rank[:, None].view(np.uint8)], axis=1), doc)
        first = order[np.nonzero(new)[0]][np.cumsum(new) - 1]
        lowest = np.empty(len(doc), np.int64)
        lowest[order] = doc[first]
        # Copies go; the others of one rank stay neighbours.
        later = doc > lowest
        out = []
        if later.any():
            local = np.zeros(later.sum(), _REMOVAL)
            local["id"], local["spot"], local["mask"] = doc[later], spot[later], mask[later]
            out.append((int(key[0] % slices), key[0], 3, _pressed(local)))
        stays = np.nonzero(~later)[0]
        stays = stays[np.argsort(rank[stays], kind="stable")]
        doc, spot, rank, mask, near = (c[stays] for c in (doc, spot, rank, mask, near))
        for s, r in _by_slice(rank, slices):
            body = doc[r].tobytes() + spot[r].tobytes() + mask[r].tobytes() + near[r].tobytes()
            out.append((s, key[0], 2, squeeze.compress(body)))
        return _message(out)
    return run


def _pressed(found: np.ndarray) -> bytes:
    return squeezed(found[np.lexsort((found["spot"], found["id"]))])


def _removals(key: tuple, messages: pd.DataFrame) -> pd.DataFrame:
    """Strings of a slice that a lower document holds, as (document, anchor, mask)."""
    unpack = zstandard.ZstdDecompressor()
    out = [(key[0], p, 3, body) for p, k, body in zip(messages["part"], messages["kind"], messages["payload"]) if k == 3]
    parts = []
    sent = messages[messages["kind"] == 2]
    for sender, body in zip(sent["part"], sent["payload"]):
        raw = unpack.decompress(body)
        n = len(raw) // (20 + _AROUND)
        parts.append((np.full(n, sender, np.int64), np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.uint64, n, 8 * n),
                      np.frombuffer(raw, np.uint32, n, 16 * n),
                      np.frombuffer(raw, np.uint8, n * _AROUND, 20 * n).reshape(n, _AROUND)))
    if not parts:
        return _message(out)
    home, doc, spot, mask, near = (np.concatenate(c) for c in zip(*parts))
    # Of equal neighbourhoods with equal strings, the later ones lose them all, and one
    # stands for the rest, which have the same document.
    order, new = _classes(np.concatenate([near, mask[:, None].view(np.uint8)], axis=1), doc)
    heads = order[np.nonzero(new)[0]]
    head = np.empty(len(doc), np.int64)
    head[order] = heads[np.cumsum(new) - 1]
    gone = np.zeros(len(doc), np.uint32)
    # Equal strings have an equal anchor: where no other one has it, nothing repeats.
    anchor = _mixed_rows(near[heads, _REACH:LENGTH])
    ordered = np.sort(anchor)
    heads = heads[_among(anchor, distinct(ordered[1:][ordered[1:] == ordered[:-1]]))]
    step = _ROWS
    codes, docs, rows, bits = ([np.zeros(0, t)] for t in (np.uint64, np.int64, np.int64, np.uint32))
    for a in range(0, len(heads), step):
        here = heads[a:a + step]
        string = ranks(near[here], LENGTH)                  # one per string around the anchor
        for b in range(_REACH + 1):
            has = np.nonzero(mask[here] >> np.uint32(b) & np.uint32(1))[0]
            codes.append(string[has, _REACH - b])
            docs.append(doc[here[has]])
            rows.append(here[has])
            bits.append(np.full(len(has), b, np.uint32))
    code, docs, rows, bits = (np.concatenate(c) for c in (codes, docs, rows, bits))
    # Stable: the strings around one pair of anchors stay neighbours.
    order = np.argsort(code, kind="stable")
    code, docs = code[order], docs[order]
    if len(code):
        rows, bits = rows[order], bits[order].astype(np.int64)
        new = code[1:] != code[:-1]
        starts = np.concatenate([[0], np.nonzero(new)[0] + 1])
        lowest = np.repeat(np.minimum.reduceat(docs, starts), np.diff(np.append(starts, len(code))))
        for c in distinct(code[_unequal(near, rows, bits, np.nonzero(~new)[0])]).tolist():
            # One rank for several strings: the bytes decide.
            a, b = np.searchsorted(code, np.uint64(c), "left"), np.searchsorted(code, np.uint64(c), "right")
            _, same = np.unique(_strings(near, rows[a:b], bits[a:b]), axis=0, return_inverse=True)
            low = np.full(b - a, NO_ID, np.int64)
            np.minimum.at(low, same.ravel(), docs[a:b])
            lowest[a:b] = low[same.ravel()]
        later = docs > lowest
        np.bitwise_or.at(gone, rows[later], np.uint32(1) << bits[later].astype(np.uint32))
    gone = np.where(doc > doc[head], mask, gone[head])
    hit = gone > 0
    found = np.zeros(int(hit.sum()), _REMOVAL)
    found["id"], found["spot"], found["mask"] = doc[hit], spot[hit], gone[hit]
    part = home[hit]
    for p in np.unique(part):
        out.append((key[0], int(p), 3, _pressed(found[part == p])))
    return _message(out)


def _strings(near: np.ndarray, rows: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return near[rows[:, None], (_REACH - bits)[:, None] + np.arange(LENGTH)]


def _unequal(near: np.ndarray, rows: np.ndarray, bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of places ``at`` whose next one has the same rank, those whose strings differ. Two
    neighbourhoods that are equal, as most are, settle all their strings at once."""
    pair = rows[at].astype(np.uint64) * np.uint64(len(near)) + rows[at + 1].astype(np.uint64)
    once = distinct(pair)
    same = np.ones(len(once), bool)
    for a in range(0, len(once), _ROWS):
        i, j = np.divmod(once[a:a + _ROWS], np.uint64(max(len(near), 1)))
        same[a:a + _ROWS] = (near[i.astype(np.int64)] == near[j.astype(np.int64)]).all(axis=1)
    settled = (bits[at] == bits[at + 1]) & same[np.searchsorted(once, pair)]
    found, at = [at[:0]], at[~settled]
    for a in range(0, len(at), _ROWS):
        i = at[a:a + _ROWS]
        found.append(i[(_strings(near, rows[i], bits[i]) != _strings(near, rows[i + 1], bits[i + 1])).any(axis=1)])
    return np.concatenate(found)


# --- the documents without what repeats -----------------------------------------

def _runs_of(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes under the removed strings of one document."""
    bits = np.nonzero(found["mask"][:, None] >> np.arange(_REACH + 1, dtype=np.uint32) & np.uint32(1))
    place = (found["spot"] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begin = np.unique(place[bits[0]] - bits[1])
    new = np.concatenate([[True], begin[1:] > begin[:-1] + LENGTH])
    first = np.nonzero(new)[0]
    return begin[first], begin[np.append(first[1:], len(begin)) - 1] + LENGTH


_KEPT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(with_bytes: bool):
    def run(key: tuple, docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        gone = np.concatenate([spread(p, _REMOVAL) for p in found["payload"]] + [np.zeros(0, _REMOVAL)])
        gone = gone[np.argsort(gone["id"], kind="stable")]
        ids, sizes, flat = _unpacked(docs)
        texts = [flat[b - n:b] for b, n in zip(np.cumsum(sizes).tolist(), sizes.tolist())]
        first, last = (np.searchsorted(gone["id"], ids, side).tolist() for side in ("left", "right"))
        above, out = gone["spot"] >> np.uint64(32) << np.uint64(32), []
        for doc, data, mark, a, b in zip(ids.tolist(), texts, _marks(ids, texts), first, last):
            own = gone[a:b][above[a:b] == mark]
            starts, stops = _runs_of(own) if len(own) else (np.zeros(0, int), np.zeros(0, int))
            at, pieces = 0, []
            for s, e in zip(starts.tolist(), stops.tolist()):
                pieces.append(data[at:s])
                at = e
            left = b"".join([*pieces, data[at:]])
            out.append((None if doc == NO_ID else doc, len(data), len(data) - len(left), len(starts),
                        hashlib.sha256(left).hexdigest(), left if with_bytes else None))
        frame = pd.DataFrame(out, columns=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        return frame.astype({"_id": "Int64"})
    return run


def _pack_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of a part as one compressed row."""
    squeeze = zstandard.ZstdCompressor(level=7)
    for batch in batches:
        parts: dict[int, list] = {}
        for doc, text in zip(batch["_id"].tolist(), batch["_text"]):
            data = (text or "").encode()
            parts.setdefault(_part_of(doc, data), []).append((doc, data))
        for part, rows in parts.items():
            yield pd.DataFrame([(part, [d for d, _ in rows], [len(t) for _, t in rows],
                                 squeeze.compress(b"".join(t for _, t in rows)))], columns=["part", "ids", "sizes", "blob"])


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                   with_bytes: bool = False) -> DataFrame:
    """A row per document: the id, n_bytes, n_removed, n_spans, kept_sha256 and, if
    ``with_bytes``, the bytes that stay in ``kept``. A part of a hot range of ids is
    ``PART`` ids long; the texts cross the network twice, compressed."""
    slices = SLICES * partitions(docs)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("_id"),
                       F.col(text).alias("_text"))
    parts = rows.mapInPandas(_pack_parts, "part long, ids array<long>, sizes array<long>, blob binary")

    first = rows.mapInPandas(_send_ranks(slices), _MESSAGE)
    known = first.groupBy("slice").applyInPandas(_repeated, _MESSAGE)
    sent = parts.groupBy("part").cogroup(known.groupBy("part")).applyInPandas(
        _send_neighbourhoods(slices), _MESSAGE)
    found = written(sent.groupBy("slice").applyInPandas(_removals, _MESSAGE), "substrings-found")
    cut = parts.groupBy("part").cogroup(found.groupBy("part")).applyInPandas(_cut(with_bytes), f"_id long, {_KEPT}")
    kept = cut.withColumnRenamed("_id", id_col)
    return kept if with_bytes else kept.drop("kept")
