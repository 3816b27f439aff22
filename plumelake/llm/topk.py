"""Exact top-k by inner product in three phases with a uniform threshold.

A score is the sum of its parts over m segments of the dimensions. Vectors are kept in
blocks, and a task of the first two phases holds one segment of a block of queries and of
a block of candidates, so it knows parts, never scores.

1. Local score lists are gathered: per query and segment, the ``LISTED`` k candidates with the
   highest part. Their missing parts are looked up; the k-th best of their scores is a cutoff that
   the k-th best of all cannot be below.
2. The cutoff goes out with the blocks of queries. A score can reach it only if one of its m
   parts reaches cutoff / m, so each task sends just those entries, packed by block.
3. Entries of a block of queries and of candidates come together; only their missing parts
   are looked up, and of a pair of blocks at most k scores per query go on.

Of equal vectors in a block only the k + 1 with the smallest ids are candidates: the others
cannot be among k best. So copies do not make the lists long. No cap: everything that can
reach the cutoff is sent.

In all phases candidates are moved once for each group of queries, and queries once for each
group of blocks (``vectors.meet``); entries go where their block is. A task holds a group of
queries, about ``HELD``, with k entries each, and one block with
the entries of a block of queries; nothing is the driver's.

Defined results: vectors that are null or hold a null or a non-finite component, and rows
without an id, take no part; only vectors of the same length are compared; a query is a
row, so repeated query rows have results each, and a copy of the query's row is a
candidate like any other; ties go to the smaller id; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumelake.llm import vectors as vec
from plumelake.llm.common import written
from plumelake.session import Workspace

SCALE = vec.SCALE
SEGMENTS = 2            # fewer segments make the threshold of a part sharper
BLOCK, QUERY_BLOCK = 4096, 1024
HELD = 1 << 17          # queries that a task holds
LISTED = 1              # times k entries of a list: longer lists tell a sharper cutoff

_QUERIES = "home long, place int, query_id long, dim int, data binary, cutoff double"
_ASKED = "q int, dim int, homes binary, places binary, ids binary, cutoffs binary, data binary"
_PARTS = "key long, q int, homes binary, places binary, cutoffs binary, data binary"
_SEGMENT = "key long, segment int, dim int, block long, labels binary, ids binary, data binary"
# Of a block of queries and a segment: rows, blocks, places, ids and parts.
_LISTED = "q int, dim int, segment int, payload binary"
# Entries of a pair of blocks and a segment: rows, places and parts.
_ENTRIES = "q int, dim int, block long, segment int, payload binary"
_SCORES = "home long, place int, query_id long, block long, col int, vec_id long, score long"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _edges(dim: int, segments: int) -> list[slice]:
    cuts = np.linspace(0, dim, segments + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]


def _key(dim: int, segment: int) -> int:
    return dim << 8 | segment


# --- blocks ------------------------------------------------------------------------

def _without_copies(k: int):
    """Task function: ``labels`` becomes 1 for candidates, 0 for copies that cannot win."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples():
                ids = vec.longs(b.ids)
                data = vec.matrix(b.data, b.dim, len(ids))
                keep = np.ones(len(ids), np.int64)
                if len(ids) > k + 1:
                    same = np.unique(data + data.dtype.type(0), axis=0, return_inverse=True)[1].ravel()
                    keep[:] = 0
                    keep[vec.best(same, ids, np.zeros(len(ids), np.int64), k + 1)] = 1
                yield pd.DataFrame([(b.dim, b.block, b.ids, keep.tobytes(), b.data)], columns=_names(vec.BLOCKS))
    return run


def _queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of blocks whose label says that they are queries."""
    for batch in batches:
        for b in batch.itertuples():
            ids = vec.longs(b.ids)
            at = np.nonzero(vec.longs(b.labels) == 1)[0]
            data = vec.matrix(b.data, b.dim, len(ids))
            yield pd.DataFrame({"home": b.block, "place": at, "query_id": ids[at], "dim": b.dim,
                                "data": [data[i].astype(np.float64).tobytes() for i in at], "cutoff": float("-inf")})


def _ask(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["home", "place"])      # a query has the same row in every phase
    data = np.frombuffer(b"".join(rows["data"]), np.float64)
    return pd.DataFrame([(key[0], key[1], rows["home"].to_numpy(np.int64).tobytes(),
                          rows["place"].to_numpy(np.int64).tobytes(), rows["query_id"].to_numpy(np.int64).tobytes(),
                          rows["cutoff"].to_numpy(np.float64).tobytes(), vec.body(data))], columns=_names(_ASKED))


def _asked(queries: DataFrame, n: int, size: int) -> DataFrame:
    dealt = F.pmod(F.xxhash64("home", "place"), F.lit(max(1, -(-n // size)))).cast("int")
    return queries.groupBy(dealt.alias("q"), "dim").applyInPandas(_ask, _ASKED)


def _split_asked(segments: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in batch.itertuples():
                data = vec.matrix(a.data, a.dim, len(vec.longs(a.homes)))
                yield pd.DataFrame([(_key(a.dim, s), a.q, a.homes, a.places, a.cutoffs, vec.body(data[:, e]))
                                    for s, e in enumerate(_edges(a.dim, segments))], columns=_names(_PARTS))
    return run


def _split_blocks(segments: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples():
                data = vec.matrix(b.data, b.dim, len(vec.longs(b.ids)))
                yield pd.DataFrame([(_key(b.dim, s), s, b.dim, b.block, b.labels, b.ids, vec.body(data[:, e]))
                                    for s, e in enumerate(_edges(b.dim, segments))], columns=_names(_SEGMENT))
    return run


class _Queries:
    """A block of queries, in one segment or whole."""

    def __init__(self, row, width: int):
        self.ids = vec.longs(row.q_ids) if hasattr(row, "q_ids") else None
        self.q, self.homes, self.places = row.q_q, vec.longs(row.q_homes), vec.longs(row.q_places)
        self.cutoffs = np.frombuffer(row.q_cutoffs, np.float64)
        self.data = vec.Rows(vec.matrix(row.q_data, width, len(self.homes)))

    def others(self, block: int, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which of these pairs of queries and places in a block are two rows."""
        return (self.homes[rows] != block) | (self.places[rows] != places)


def _width(key: int, segments: int) -> int:
    edge = _edges(key >> 8, segments)[key & 255]
    return edge.stop - edge.start


def _candidates(row, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, ids and vectors of the rows of a block that may count."""
    ids, places = vec.longs(row.c_ids), np.nonzero(vec.longs(row.c_labels) == 1)[0]
    return places, ids[places], vec.matrix(row.c_data, width, len(ids))[places]


# --- phase 1: lists and cutoff -------------------------------------------------------

def _lists(k: int, segments: int):
    """Task function: of each query the k candidates with the highest part among all blocks
    that the task meets. What it holds is k entries per query, and as many again that wait."""
    def begin(asked: list) -> list:
        blocks = [_Queries(a, _width(asked[0].by, segments)) for a in asked]
        return [asked[0].by, [(b, vec.Best(len(b.homes), k)) for b in blocks]]

    def follow(state: list, row) -> Iterator[pd.DataFrame]:
        places, ids, data = _candidates(row, _width(state[0], segments))
        whole = vec.Rows(data)
        for queries, held in state[1]:
            first = not held.parts
            for s in vec.stretches(len(ids), first):
                for r, c, parts in vec.reaching(queries.data, vec.Rows(data[s]) if first else whole, held.low, most=k + 1):
                    c += s.start
                    other = queries.others(row.c_block, r, places[c])
                    r, c, parts = r[other], c[other], parts[other]
                    held.add(r, ids[c], parts, np.full(len(r), row.c_block), places[c])
                if s.stop < len(ids):
                    held.trim()
        return iter(())

    def end(state: list) -> Iterator[pd.DataFrame]:
        for queries, held in state[1]:
            if entries := held.trim():
                rows, ids, parts, blocks, places = entries
                yield pd.DataFrame([(queries.q, state[0] >> 8, state[0] & 255, vec.packed(rows, blocks, places, ids, parts))],
                                   columns=_names(_LISTED))

    return lambda batches: vec.met(batches, begin, follow, end)


def _listed(k: int):
    """Group function: the lists of all tasks as one, by block."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        q, blocks, places, ids, parts = (np.concatenate(c) for c in zip(*map(vec.unpacked, rows["payload"])))
        at = vec.best(q, ids, parts, k)
        at = at[np.lexsort((places[at], q[at], blocks[at]))]
        return pd.DataFrame([(key[0], key[1], blocks[own[0]], key[2], vec.packed(q[own], places[own], parts[own]))
                             for own in np.split(at, np.nonzero(np.diff(blocks[at]))[0] + 1) if len(own)],
                            columns=_names(_ENTRIES))
    return run


# --- missing parts -----------------------------------------------------------------------

def _scored(q: list[vec.Rows], c: list[vec.Rows], s: int, rows: np.ndarray, cols: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Scores of the entries of segment ``s``: their parts, and the missing ones, which are
    computed for these pairs only. ``q``, ``c``: by segment."""
    total = parts.copy()
    for t in range(len(q)):
        if t != s:
            of = vec.kind(q[t], c[t])
            left, right = q[t].of(of), c[t].of(of)
            for a in range(0, len(rows), 1 << 12):      # bounded memory
                at = slice(a, a + (1 << 12))
                total[at] += np.einsum("ij,ij->i", left[rows[at]], right[cols[at]]).astype(np.int64)
    return total


def _once(rows: np.ndarray, cols: np.ndarray, scores: np.ndarray) -> list[np.ndarray]:
    """Pairs that entries of several segments tell, once each."""
    spots = rows * (int(cols.max(initial=0)) + 1) + cols
    at = np.unique(spots, return_index=True)[1]
    return [rows[at], cols[at], scores[at]]


def _by_segment(data: np.ndarray, segments: int) -> list[vec.Rows]:
    return [vec.Rows(data[:, e]) for e in _edges(data.shape[1], segments)]


def _looked_up(segments: int):
    """Task function: scores of the entries of lists, which follow the block they are in."""
    def begin(asked: list) -> list:
        return [{a.q_q: _Queries(a, a.q_dim) for a in asked}, (), None, []]

    def complete(state: list) -> Iterator[pd.DataFrame]:
        queries, (block, ids, data), told = state[0][state[2]], state[1], state[3]
        q = _by_segment(queries.data.values, segments)
        rows, cols, scores = _once(*(np.concatenate(x) for x in zip(*(
            (r, c, _scored(q, data, s, r, c, parts)) for s, r, c, parts in told))))
        yield pd.DataFrame(dict(zip(_names(_SCORES), (
            queries.homes[rows], queries.places[rows], queries.ids[rows], np.full(len(rows), block), cols, ids[cols], scores))))

    def follow(state: list, row) -> Iterator[pd.DataFrame]:
        if state[3] and (row.turn == 1 or row.e_q != state[2]):
            yield from complete(state)
            state[3] = []
        if row.turn == 1:
            ids = vec.longs(row.c_ids)
            state[1] = row.c_block, ids, _by_segment(vec.matrix(row.c_data, row.c_dim, len(ids)), segments)
        else:
            state[2] = row.e_q
            state[3].append((row.e_segment, *vec.unpacked(row.e_payload)))

    def end(state: list) -> Iterator[pd.DataFrame]:
        if state[3]:
            yield from complete(state)

    return lambda batches: vec.met(batches, begin, follow, end)


# --- phases 2 and 3: entries at or above cutoff / m, and their scores ----------------------

def _reached(k: int, segments: int):
    """Task function: of each query the k best scores among all blocks that the task meets.
    Once it has k, the worst of them is a cutoff too."""
    def begin(asked: list) -> list:
        blocks = [_Queries(a, a.q_dim) for a in asked]
        return [[(b, _by_segment(b.data.values, segments), vec.Best(len(b.homes), k)) for b in blocks], 0]

    def follow(state: list, row) -> Iterator[pd.DataFrame]:
        places, ids, data = _candidates(row, row.c_dim)
        data = _by_segment(data, segments)
        for queries, q, held in state[0]:
            cutoffs, known = np.maximum(queries.cutoffs, held.low), []
            for s in range(segments):
                if found := [*vec.reaching(q[s], data[s], cutoffs / segments)]:
                    r, c, parts = (np.concatenate(x) for x in zip(*found))
                    state[1] += len(r)
                    scores = _scored(q, data, s, r, c, parts)
                    keep = (scores.astype(np.float64) >= cutoffs[r]) & queries.others(row.c_block, r, places[c])
                    known.append((r[keep], c[keep], scores[keep]))
            if known:
                r, c, scores = _once(*(np.concatenate(x) for x in zip(*known)))
                held.add(r, ids[c], scores, np.full(len(r), row.c_block), places[c])
        return iter(())

    def end(state: list) -> Iterator[pd.DataFrame]:
        # A row without a place tells how many entries there have been.
        yield pd.DataFrame([(0, 0, 0, 0, -1, 0, state[1])], columns=_names(_SCORES))
        for queries, _, held in state[0]:
            if entries := held.trim():
                rows, ids, scores, blocks, places = entries
                yield pd.DataFrame(dict(zip(_names(_SCORES), (
                    queries.homes[rows], queries.places[rows], queries.ids[rows], blocks, places, ids, scores))))

    return lambda batches: vec.met(batches, begin, follow, end)


def top_k(vectors: DataFrame, k: int, is_query: Column, segments: int = SEGMENTS, block: int = BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k best candidates.
    ``vectors``: vec_id, embedding. Runs when called and stores the result."""
    return _search(vectors, k, is_query, segments, block, query_block)[0]


def _search(vectors: DataFrame, k: int, is_query: Column, segments: int, block: int,
            query_block: int) -> tuple[DataFrame, int]:
    """The result, and how many entries phase 2 sent."""
    spark = vectors.sparkSession
    flagged = vectors.withColumn("_asks", F.coalesce(is_query, F.lit(False)).cast("long"))
    valid = flagged.where(F.col("vec_id").isNotNull() & vec.usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("_asks").alias("label"), "embedding")
    by_query, by_score = ["home", "place"], [F.desc("score"), "vec_id"]
    with Workspace(spark, "topk") as space:
        packed = space.written(valid.mapInPandas(vec.pack_blocks(block), vec.BLOCKS), "packed")
        queries = space.written(packed.mapInPandas(_queries, _QUERIES), "queries")
        n = queries.count()
        blocks = space.written(packed.mapInPandas(_without_copies(k), vec.BLOCKS), "blocks")
        asked = space.written(_asked(queries, n, query_block), "asked")

        salts = vec.salts(blocks, n)
        lists = vec.meet(asked.mapInPandas(_split_asked(segments), _PARTS),
                         blocks.mapInPandas(_split_blocks(segments), _SEGMENT), n, salts, HELD, "key", segments,
                         "key & 255").mapInPandas(_lists(LISTED * k, segments), _LISTED)
        listed = lists.groupBy("q", "dim", "segment").applyInPandas(_listed(LISTED * k), _ENTRIES)
        known = vec.meet(asked, blocks, n, salts, HELD, others=listed).mapInPandas(_looked_up(segments), _SCORES)
        in_order = Window.partitionBy(*by_query).orderBy(*by_score, "block", "col")
        kth = known.withColumn("_n", F.row_number().over(in_order)).where(F.col("_n") == k)
        # A score beyond 2^53 may be rounded up as a double: a little lower is still safe.
        low = F.col("score").cast("double")
        cutoffs = kth.select(*by_query, (low - F.abs(low) * 2.0 ** -50).alias("_low"))
        informed = queries.join(cutoffs, by_query, "left").withColumn(
            "cutoff", F.coalesce("_low", F.lit(float("-inf")))).select(*queries.columns)
        asked = space.written(_asked(informed, n, query_block), "informed")

        met = vec.meet(asked, blocks, n, salts, HELD).mapInPandas(_reached(k, segments), _SCORES)
        scores = space.written(met, "scores")
        sent = scores.where(F.col("col") < 0).agg(F.coalesce(F.sum("score"), F.lit(0))).first()[0]
        ranked = scores.where(F.col("col") >= 0).withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k)
        return written(ranked.select("query_id", "rank", "vec_id", "score"), "topk-best"), sent
