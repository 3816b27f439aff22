"""Near-duplicates by SimHash and a Gray-order hierarchical index.

A fingerprint has 64 bits, each the majority of that bit over the hashes of a text's
word shingles. Texts with fingerprints at most ``DISTANCE`` bits apart are linked.

Two such fingerprints agree on at least one of ``DISTANCE + 1`` blocks of bits, so the
top level of the index has one node per block and value: fingerprints are rotated to
have the block first and sorted by Gray rank, in which the block is a run and
neighbours share long bit patterns. Below a node, leaves of consecutive fingerprints
and groups of leaves keep the bits that all their members share (mask and value). Two
nodes are compared by their shared bits only: if those already differ in more than
``DISTANCE`` places the whole groups are pruned. What remains is compared bit by bit.

Only distinct fingerprints enter the index. A node returns no pairs but a forest: each
fingerprint and the first one of its local component, so groups of near copies stay
linear; leaves known to lie in one component are not compared again. A node with more
than ``TILE`` fingerprints is dealt out to tiles that together hold every two of its
parts, so no task gets an unbounded node. Forests of all nodes meet in ``components``.

Defined results: a null text is empty; texts without a word have fingerprint zero and
are linked like others; a null id takes part and is never the smallest id of a
component unless it has only null ids; repeated ids are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumelake.llm.common import partitions, written
from plumelake.llm.components import components

SHINGLE, DISTANCE, SEED = 3, 3, 42
BITS = 64
TILE = 1 << 16
LEAF, FAN = 32, 64
_BLOCK = 1 << 16        # shingles counted at once


def _fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode().lower().split()      # bytes: only A-Z and the six white spaces
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1].tolist(), (ends[k - 1:] - 1).tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), _BLOCK):
        raw = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[i:i + _BLOCK], ends[i:i + _BLOCK])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long."""
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, shingle) for t in texts], dtype="int64")
    return prints(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _rotated(fp: Column, by: Column) -> Column:
    return F.when(by == 0, fp).otherwise(F.call_function("shiftleft", fp, by).bitwiseOR(
        F.call_function("shiftrightunsigned", fp, F.lit(BITS) - by)))


def gray_rank(code: Column) -> Column:
    """Place of a bit pattern in Gray order: each bit is the parity of those above."""
    for by in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, by))
    return code


def _settle(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Lowest label of each component after adding the pairs (a, b)."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (label[a], label[b]):
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _shared(values: np.ndarray, masks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits that all members of each group of ``size`` share, and their values."""
    at = np.arange(0, len(values), size)
    both, either = np.bitwise_and.reduceat(values & masks, at), np.bitwise_or.reduceat(values & masks, at)
    mask = np.bitwise_and.reduceat(masks, at) & ~(both ^ either)
    return both & mask, mask


def _close(v: np.ndarray, m: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count((v[i] ^ v[j]) & m[i] & m[j]) <= most


def _spread(i: np.ndarray, j: np.ndarray, fan: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Children of node pairs, each unordered pair once."""
    step = np.arange(fan)
    a = np.repeat(i[:, None] * fan + step, fan, axis=1).ravel()
    b = np.tile(j[:, None] * fan + step, (1, fan)).ravel()
    keep = (a < n) & (b < n) & (a <= b)
    return a[keep], b[keep]


def local_components(codes: np.ndarray, most: int = DISTANCE) -> np.ndarray:
    """Component of each of the distinct ``codes``, which are in Gray order, as the
    index of its first member."""
    n = len(codes)
    label = np.arange(n)
    for lag in range(1, min(n, LEAF)):          # neighbours in Gray order first
        near = np.nonzero(np.bitwise_count(codes[lag:] ^ codes[:-lag]) <= most)[0]
        label = _settle(n, near, near + lag, label)
    if n <= LEAF:
        return label
    leaf_v, leaf_m = _shared(codes, np.full(n, ~np.uint64(0)), LEAF)
    node_v, node_m = _shared(leaf_v, leaf_m, FAN)
    first = np.arange(0, n, LEAF)
    for row in range(len(node_v)):              # pairs of upper nodes, a row at a time
        others = np.arange(row, len(node_v))
        others = others[_close(node_v, node_m, np.full(len(others), row), others, most)]
        i, j = _spread(np.full(len(others), row), others, FAN, len(leaf_v))
        near = _close(leaf_v, leaf_m, i, j, most)
        i, j = i[near], j[near]
        for at in range(0, len(i), 1024):
            x, y = i[at:at + 1024], j[at:at + 1024]
            low, high = np.minimum.reduceat(label, first), np.maximum.reduceat(label, first)
            open_ = (low[x] != low[y]) | (low[x] != high[x]) | (low[y] != high[y])
            a, b = _spread(x[open_], y[open_], LEAF, n)
            hit = (label[a] != label[b])
            a, b = a[hit], b[hit]
            hit = np.bitwise_count(codes[a] ^ codes[b]) <= most
            label = _settle(n, a[hit], b[hit], label)
    return label


def _runs(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.nonzero(values[1:] != values[:-1])[0] + 1])


def _forest(most: int):
    def small(codes: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Components inside many small nodes at once: row against the next rows."""
        label = np.arange(len(codes))
        for lag in range(1, LEAF):
            same = np.nonzero(node[lag:] == node[:-lag])[0]
            if not len(same):
                break
            near = same[np.bitwise_count(codes[same + lag] ^ codes[same]) <= most]
            label = _settle(len(codes), near, near + lag, label)
        return label

    def edges(codes: np.ndarray, label: np.ndarray) -> pd.DataFrame:
        child = np.nonzero(label != np.arange(len(codes)))[0]
        return pd.DataFrame({"a": codes[child].view(np.int64), "b": codes[label[child]].view(np.int64)})

    def finish(codes: np.ndarray, node: np.ndarray) -> Iterator[pd.DataFrame]:
        starts = _runs(node)
        sizes = np.diff(np.append(starts, len(node)))
        large = sizes > LEAF
        few = np.repeat(~large, sizes)
        yield edges(codes[few], small(codes[few], node[few]))
        for s, size in zip(starts[large], sizes[large]):
            part = codes[s:s + size]
            yield edges(part, local_components(part, most))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by node and Gray rank; a node may go on in the next batch."""
        codes, node = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            codes = np.concatenate([codes, batch["fp"].to_numpy(np.int64).view(np.uint64)])
            node = np.concatenate([node, batch["node"].to_numpy(np.int64)])
            last = _runs(node)[-1] if len(node) else 0
            if last:
                yield from finish(codes[:last], node[:last])
                codes, node = codes[last:], node[last:]
        if len(codes):
            yield from finish(codes, node)
    return run


def links(prints: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """A forest (a, b) of the distinct fingerprints in ``fp`` within ``distance``. Its
    components are those of all links."""
    blocks = distance + 1
    width = -(-BITS // blocks)
    keyed = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    keyed = keyed.withColumn("turned", _rotated(F.col("fp"), F.col("block") * width)).withColumn(
        "value", F.shiftrightunsigned("turned", BITS - width))
    sizes = keyed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    parts = F.ceil(F.col("n") / tile).cast("int")
    sized = keyed.join(sizes, ["block", "value"]).withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # Part p of P meets every part: the tiles (p, q) and (q, p), written once.
    tiles = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.least(
        q, F.col("part")) * F.col("parts") + F.greatest(q, F.col("part")))
    dealt = sized.withColumn("tile", F.explode(tiles)).select(
        "fp", gray_rank(F.col("turned")).alias("rank"),
        F.xxhash64("block", "value", "tile").alias("node"))
    tasks = partitions(prints)
    return dealt.repartition(tasks, "node").sortWithinPartitions("node", "rank").select(
        "fp", "node").mapInPandas(_forest(distance), "a long, b long")


def _classed(docs: DataFrame, text: str, id_col: str, shingle: int, distance: int,
             more: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows as id, ``fp`` and ``more``, without their texts; and for each fingerprint its
    component (``_root``, one of its fingerprints) with the smallest id in it."""
    rows = written(docs.select(id_col, fingerprint(F.col(text), shingle).alias("fp"), *more), "simhash-prints")
    classes = written(rows.groupBy("fp").agg(F.min(id_col).alias("_first")), "simhash-classes")
    forest = written(links(classes.select("fp"), distance), "simhash-links")
    roots = components(forest)
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").withColumn(
        "_root", F.coalesce("root", "fp")).select("fp", "_first", "_root")
    lowest = named.groupBy("_root").agg(F.min("_first").alias("component_id"))
    return rows, named.join(lowest, "_root").select(F.col("fp").alias("_fp"), "_root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """A row per document: the id, ``fp`` and ``component_id``, the smallest id that is
    reachable over links."""
    rows, known = _classed(docs, text, id_col, shingle, distance, [])
    return rows.join(known, F.col("fp") == F.col("_fp")).select(id_col, "fp", "component_id")


def first_of_each(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE,
                  distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, rows without an
    id last, and the lowest hash of its text among rows with that id. So rows with one id in
    two components both stay, and a component without ids keeps one row.

    Survivors are found without the texts, one per component and task before the shuffle.
    They meet the texts by id and 96 bits of hash; of rows that are equal in both, one stays.
    """
    marks = {"_void": F.col(id_col).isNull(), "_id": F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
             "_hash": F.xxhash64(text), "_more": F.hash(text)}
    rows, known = _classed(docs, text, id_col, shingle, distance, [c.alias(n) for n, c in marks.items()])
    survivor = F.min(F.struct(*marks)).alias("_stay")
    stay = rows.join(known, F.col("fp") == F.col("_fp")).groupBy("_root").agg(survivor).select("_stay.*")
    alike = Window.partitionBy(*marks).orderBy("_hash")
    return docs.withColumns(marks).join(stay, list(marks), "left_semi").withColumn(
        "_n", F.row_number().over(alike)).where(F.col("_n") == 1).select(*docs.columns)
