"""Hard negatives for anchors: rows of another label whose score lies in a window below
the score of a positive. Selection is decomposed into slots.

1. The positives of an anchor are its best rows of the same label.
2. The upper limits of the positives' windows, in descending order, cut the scores into
   disjoint slots: slot t holds the scores from the limit of positive t down to above the
   limit of positive t + 1. The windows of an anchor overlap, its slots do not, so a
   negative is kept once, not once per positive.
3. Tasks are combiners: over all blocks they meet they keep the ``k`` best negatives of
   each anchor and slot. The same is done once more across tasks.
4. The best of a window are found from the top: slots t, t + 1, … joined in descending
   order and cut at ``k``. These suffixes are merged once per anchor and answer all its
   windows; what is below the lower limit of a window is left out at the end.

Anchors are a stated set of rows against all rows, in blocks (``vectors.meet``). What a
task holds is about ``HELD`` anchors with at most ``k`` rows of each slot, as many again
that wait to be compared, and one block of rows; nothing is one group or the driver's, and
no key is hot, whatever label or vector a third of the rows share.

Defined results: rows with a null id, label or vector, or with a component that is null or
not finite, take no part; vectors meet those of the same length; an anchor is a row, so a
repeated anchor gets its results as often as it is there, and its copies are other rows;
ties go to the smaller id; negative positives have empty windows; extra columns are
ignored; an empty table gives no rows. Scores, and scores times 100, must fit in a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plumelake.llm import vectors as vec
from plumelake.llm.common import written
from plumelake.session import Workspace

POSITIVES, NEGATIVES = 5, 10
LOWEST, HIGHEST = 30, 90        # per cent of the positive's score
BLOCK, ANCHOR_BLOCK = 2048, 256
HELD = 1 << 15          # anchors that a task holds

# ``home`` and ``place`` name the row of an anchor; ``limits`` are the upper limits of its
# windows in descending order, ``floor`` the lowest of its lower limits.
_ANCHORS = "home long, place int, anchor_id long, label long, dim int, data binary"
_ASKED = ("dim int, q int, homes binary, places binary, ids binary, labels binary, data binary, limits binary, "
          "floors binary")
_NONE = np.iinfo(np.int64).min
# Of a block of anchors: homes, places, anchors, slots, ids and scores.
_PART = "q int, dim int, payload binary"
_FOUND = "home long, place int, anchor_id long, slot int, vec_id long, score long, n int"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _anchors_of(every: int):
    """Task function: the rows of blocks whose id is divisible by ``every``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples():
                own, labels = vec.longs(b.ids), vec.longs(b.labels)
                data = vec.matrix(b.data, b.dim, len(own))
                at = np.nonzero(own % every == 0)[0]
                yield pd.DataFrame({"home": b.block, "place": at, "anchor_id": own[at], "label": labels[at],
                                    "dim": b.dim, "data": [data[i].astype(np.float64).tobytes() for i in at]})
    return run


def _ask(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One block of anchors."""
    def body(name: str) -> bytes:
        return rows[name].to_numpy(np.int64).tobytes()
    limits = np.full((len(rows), max([1, *map(len, rows["limits"])])), _NONE)
    for i, own in enumerate(rows["limits"]):
        limits[i, :len(own)] = own
    data = np.frombuffer(b"".join(rows["data"]), np.float64)
    return pd.DataFrame([(key[0], key[1], body("home"), body("place"), body("anchor_id"), body("label"),
                          vec.body(data), limits.tobytes(), body("floor"))], columns=_names(_ASKED))


def _asked(anchors: DataFrame, n: int, size: int) -> DataFrame:
    """Blocks of at most about ``size`` anchors."""
    dealt = F.pmod(F.xxhash64("home", "place"), F.lit(max(1, -(-n // size)))).cast("int")
    return anchors.groupBy("dim", dealt.alias("_q")).applyInPandas(_ask, _ASKED)


class _Anchors:
    """The anchors that a task holds, by label, and the ``k`` best rows of each slot."""

    def __init__(self, asked: list, k: int):
        def joined(name: str) -> np.ndarray:
            return np.concatenate([vec.longs(getattr(a, name)) for a in asked])
        labels = joined("q_labels")
        order = np.argsort(labels, kind="stable")
        self.labels, self.homes, self.places, self.ids = (
            c[order] for c in (labels, joined("q_homes"), joined("q_places"), joined("q_ids")))
        sizes = [len(a.q_labels) // 8 for a in asked]
        self.data = np.concatenate([vec.matrix(a.q_data, a.q_dim, m) for a, m in zip(asked, sizes)])[order]
        self.rows = vec.Rows(self.data)
        same = [0, *(np.nonzero(np.diff(self.labels))[0] + 1).tolist(), len(order)]
        self.by_label = {int(self.labels[a]): (a, b, vec.Rows(self.data[a:b])) for a, b in zip(same, same[1:])}
        self.block = np.repeat([a.q_q for a in asked], sizes)[order]
        widths = [len(a.q_limits) // 8 // m for a, m in zip(asked, sizes)]
        self.slots, self.dim = max(widths), asked[0].q_dim
        self.limits = np.concatenate([np.pad(vec.longs(a.q_limits).reshape(m, w), ((0, 0), (0, self.slots - w)),
                                             constant_values=_NONE) for a, m, w in zip(asked, sizes, widths)])[order]
        self.floors = joined("q_floors")[order]
        self.held = vec.Best(len(order) * self.slots, k)

    def others(self, block: int, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which of these pairs of anchors and places in a block are two rows."""
        return (self.homes[rows] != block) | (self.places[rows] != places)

    def given(self) -> Iterator[pd.DataFrame]:
        if entries := self.held.trim():
            row, slot = entries[0] // self.slots, entries[0] % self.slots
            order = np.argsort(self.block[row], kind="stable")
            blocks = self.block[row][order]
            for at in np.split(order, np.nonzero(np.diff(blocks))[0] + 1):
                own = row[at]
                if len(at):
                    yield pd.DataFrame([(self.block[own[0]], self.dim, vec.packed(
                        self.homes[own], self.places[own], self.ids[own], slot[at], entries[1][at], entries[2][at]))],
                        columns=_names(_PART))


def _block(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = vec.longs(row.c_ids)
    return ids, vec.longs(row.c_labels), vec.matrix(row.c_data, row.c_dim, len(ids))


def _positive(anchors: _Anchors, row, k: int) -> None:
    """Rows of the label of an anchor: label by label, so that only these are compared."""
    ids, labels, data = _block(row)
    order, held = np.argsort(labels, kind="stable"), anchors.held
    ordered = labels[order]
    for label in np.intersect1d(anchors.labels, labels).tolist():
        begin, end, own = anchors.by_label[label]
        at = order[slice(*(np.searchsorted(ordered, label, side) for side in ("left", "right")))]
        for r, c, scores in vec.reaching(own, vec.Rows(data[at]), held.low[begin:end], most=k + 1):
            r, c = r + begin, at[c]
            other = anchors.others(row.c_block, r, c)
            held.add(r[other], ids[c[other]], scores[other])


def _negative(anchors: _Anchors, row, k: int) -> None:
    """Rows of another label in one of the slots of an anchor."""
    ids, labels, data = _block(row)
    held, n, slots = anchors.held, len(anchors.labels), anchors.slots
    last = np.arange(n) * slots + np.maximum((anchors.limits != _NONE).sum(axis=1), 1) - 1
    # As doubles, longs beyond 2^53 may be rounded: a little more is looked at, and then compared.
    slack = lambda x, sign: x + sign * np.abs(x) * 2.0 ** -50      # noqa: E731
    high = slack(anchors.limits[:, 0].astype(np.float64), 1)
    least = slack(anchors.floors.astype(np.float64), -1)
    for s in vec.stretches(len(ids), not held.parts):
        rows = vec.Rows(data[s])
        low = np.maximum(least, held.low[last])
        for r, c, scores in vec.reaching(anchors.rows, rows, low, high):
            c += s.start
            slot = (anchors.limits[r] >= scores[:, None]).sum(axis=1) - 1
            inside = (slot >= 0) & (scores >= anchors.floors[r]) & (anchors.labels[r] != labels[c])
            r, c = r[inside], c[inside]
            held.add(r * slots + slot[inside], ids[c], scores[inside])
        if s.stop < len(ids):
            held.trim()


def _combine(k: int, slots):
    """Task function over meetings of blocks: the ``k`` best rows of each anchor and slot.
    ``slots`` adds the rows of a block that may be among them."""
    def follow(anchors: _Anchors, row) -> Iterator[pd.DataFrame]:
        slots(anchors, row, k)
        return iter(())

    return lambda batches: vec.met(batches, lambda asked: _Anchors(asked, k), follow, _Anchors.given)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each anchor and slot across tasks, with their place."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        home, place, anchor, slot, ids, score = (np.concatenate(c) for c in zip(*map(vec.unpacked, rows["payload"])))
        group = np.unique(np.stack([home, place, slot], axis=1), axis=0, return_inverse=True)[1].ravel()
        at = vec.best(group, ids, score, k)
        first = np.nonzero(np.diff(group[at], prepend=-1))[0]
        n = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at)))) + 1
        return pd.DataFrame(dict(zip(_names(_FOUND), [*(c[at] for c in (home, place, anchor, slot, ids, score)), n])))
    return found.groupBy("q", "dim").applyInPandas(run, _FOUND)


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   lowest: int = LOWEST, highest: int = HIGHEST, block: int = BLOCK,
                   anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    ``rows``: vec_id, embedding, label. Anchors are the rows whose id is divisible by
    ``every``. Runs when called and stores the result."""
    spark = rows.sparkSession
    valid = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vec.usable(F.col("embedding")))
    valid = valid.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                         "embedding")
    key = ["home", "place"]
    with Workspace(spark, "negatives") as space:
        blocks = space.written(valid.mapInPandas(vec.pack_blocks(block), vec.BLOCKS), "blocks")
        anchors = space.written(blocks.mapInPandas(_anchors_of(every), _ANCHORS), "anchors")
        n = anchors.count()
        salts = vec.salts(blocks, n)
        no_limits = anchors.withColumns({"limits": F.array().cast("array<long>"), "floor": F.lit(0).cast("long")})
        meetings = vec.meet(space.written(_asked(no_limits, n, anchor_block), "asked"), blocks, n, salts, HELD)
        near = _top(meetings.mapInPandas(_combine(positives, _positive), _PART), positives)
        # Whole numbers only: the highest and lowest score of a window.
        upper = F.expr(f"({highest} * score - pmod({highest} * score, 100)) div 100")
        lower = F.expr(f"({lowest} * score + pmod(-{lowest} * score, 100)) div 100")
        chosen = space.written(near.select(*key, "anchor_id", F.col("n").alias("slot"), F.col("vec_id").alias(
            "positive_id"), F.col("score").alias("positive_score"), upper.alias("upper"), lower.alias("lower")), "positives")
        windows = chosen.groupBy(*key).agg(
            F.array_sort(F.collect_list(F.struct("slot", "upper"))).alias("_limits"),     # at most ``positives``
            F.min("lower").alias("floor")).select(*key, F.col("_limits.upper").alias("limits"), "floor")
        meetings = vec.meet(space.written(_asked(anchors.join(windows, key), n, anchor_block), "windows"), blocks, n, salts, HELD)
        kept = _top(meetings.mapInPandas(_combine(negatives, _negative), _PART), negatives)

        # At most positives x negatives rows of an anchor: its slots, best first.
        entry = F.struct(F.col("slot").cast("int").alias("slot"), (-F.col("score")).alias("minus"), "vec_id")
        slots = kept.groupBy(*key).agg(F.array_sort(F.collect_list(entry)).alias("entries"))

        def suffix(t: Column) -> Column:
            """The best of slot t and those below it: descending, so joined and cut."""
            return F.slice(F.filter("entries", lambda e: e["slot"] >= t), 1, negatives)
        answered = chosen.join(slots, key).withColumn("_best", suffix(F.col("slot") - 1))
        hits = F.filter("_best", lambda e: -e["minus"] >= F.col("lower"))
        out = answered.select("anchor_id", "positive_id", "positive_score", F.posexplode(hits).alias("_n", "_hit"))
        result = written(out.select(
            "anchor_id", "positive_id", (F.col("_n") + 1).cast("int").alias("rank"),
            F.col("_hit.vec_id").alias("negative_id"), "positive_score", (-F.col("_hit.minus")).alias("negative_score")),
            "hard-negatives")
    return result
