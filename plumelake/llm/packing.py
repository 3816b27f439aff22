"""Packing documents into training sequences of several context sizes.

Documents are tokenised in the tasks and packed there, in groups of a bounded number
of tokens, so no token is shuffled. Within a group:

* whole windows of the longest size are cut from the start of each document;
* what remains of a document is routed to the smallest tier that holds it;
* windows are opened from the longest remainder down, and gaps are filled with the
  longest shorter remainder that fits (from any shorter tier), until none fits;
* the last part of a gap is filled by cutting the longest remainder;
* when nothing is left to fill with, the open window is divided into windows of the
  powers of two of its length, so it needs no padding either.

Step groups are balanced over the whole corpus: the sequences of a tier are numbered across
all tasks, by counts per task that are added up, and every ``STEP_TOKENS`` tokens are a
group. So (tier, step_group) is a key, a step takes more short sequences than long ones,
and all groups of a tier have equal tokens but for its last. For that the pieces, a few
numbers each, are stored once.

Sequence numbers begin with the task and group, so they are unique. Bounded memory:
one group of tokens, one batch of texts and a bounded cache of words per task.

Defined results: a null or empty text is the single end id; repeated documents are
packed one by one, with their own pieces; a null id stays null; an empty table gives
no pieces.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from plumelake.llm.common import written

TOKENIZER = "word_bpe_49k.json"
TIERS = (256, 512, 1024, 2048)
END = 1
GROUP_TOKENS = 1 << 21
STEP_TOKENS = 1 << 16
CACHED_WORDS = 400_000

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier int, step_group long")
# Before the step groups are known: the sequence's number in its tier and task.
_LOCAL = PIECES.replace("step_group long", "number long, task long")

# Words of these characters are split and lower-cased alike by every Unicode version;
# all other words are left to the tokenizer itself.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class WordIds(dict):
    """Ids of white-space words as bytes, worked out when first asked for.

    The tokenizer drops white space and never merges across it, so the ids of a text
    are those of its words. Plain words go through the same merges by rank, where a
    byte that no text contains marks the end of a word; it is much faster than one
    call of the tokenizer per word, and equal to it.
    """

    def __init__(self, path: str):
        super().__init__()
        import json
        import tiktoken
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        letters = _byte_letters()
        special = {str(t) for t in self.whole.get_added_tokens_decoder().values()}
        special |= {t.content for t in self.whole.get_added_tokens_decoder().values()}
        ranks = {}
        for token, rank in vocabulary.items():
            if token not in special:
                end = token.endswith("</w>")
                ranks[bytes(letters[c] for c in token.removesuffix("</w>")) + b"\xff" * end] = rank
        ranks.setdefault(b"\xff", len(vocabulary))
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks,
                                       special_tokens={})._core_bpe.encode_single_piece

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        text = word.decode()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            ids = [i for part in _PARTS.findall(text.lower()) for i in self.merge(part.encode() + b"\xff")]
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            self[word] = packed
        return packed


def _byte_letters() -> dict[str, int]:
    """The public mapping of bytes to printable letters in byte-level vocabularies:
    printable bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def token_ids(text: str | None, words: WordIds) -> bytes:
    """Ids of a text with the end id, as little-endian unsigned 32-bit numbers."""
    return b"".join(map(words.__getitem__, (text or "").encode().split())) + struct.pack("<I", END)


def _pack(lengths: list[int], tiers: tuple[int, ...]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Windows as (size, pieces); a piece is (document, start, length)."""
    longest = tiers[-1]
    pool: list[tuple[int, int, int]] = []       # (length, document, start), sorted
    for d, n in enumerate(lengths):
        whole = n - n % longest
        for start in range(0, whole, longest):
            yield longest, [(d, start, longest)]
        if n > whole:
            pool.append((n - whole, d, whole))
    pool.sort()
    while pool:
        n, d, start = pool.pop()
        size = next(t for t in tiers if t >= n)
        window, gap = [(d, start, n)], size - n
        while gap and pool:
            at = bisect_right(pool, (gap, float("inf"), 0)) - 1
            if at >= 0:
                n, d, start = pool.pop(at)
                window.append((d, start, n))
            else:
                n, d, start = pool.pop()
                window.append((d, start, gap))
                insort(pool, (n - gap, d, start + gap))
                n = gap
            gap -= n
        if not gap:
            yield size, window
        else:
            yield from _powers(window, size - gap)


def _powers(window: list[tuple[int, int, int]], n: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """A window of n tokens divided at the powers of two of n."""
    pieces = list(reversed(window))
    for bit in reversed(range(n.bit_length())):
        if n >> bit & 1:
            part, room = [], 1 << bit
            while room:
                d, start, length = pieces.pop()
                take = min(length, room)
                part.append((d, start, take))
                if take < length:
                    pieces.append((d, start + take, length - take))
                room -= take
            yield 1 << bit, part


def _packer(path: str, tiers: tuple[int, ...], group_tokens: int):
    def close(ids: list[bytes], docs: list, first: int, steps: dict[int, int]) -> pd.DataFrame:
        rows = []
        for n, (size, window) in enumerate(_pack([len(b) // 4 for b in ids], tiers)):
            offset = 0
            step = steps[size] = steps.get(size, -1) + 1
            for d, start, length in window:
                rows.append((docs[d], start, length, zlib.crc32(ids[d][4 * start:4 * (start + length)]),
                             len(ids[d]) // 4, first + n, offset, size, step, first >> 40))
                offset += length
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in _LOCAL.split(", ")])
        return out.astype({"doc_id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, words = TaskContext.get(), WordIds(path)
        group, steps = (task.partitionId() if task else 0) << 40, {}
        ids, docs, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                ids.append(token_ids(text, words))
                docs.append(doc)
                held += len(ids[-1]) // 4
                if held >= group_tokens:
                    yield close(ids, docs, group, steps)
                    group, ids, docs, held = group + (1 << 24), [], [], 0
        if docs:
            yield close(ids, docs, group, steps)
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, tiers: tuple[int, ...] = TIERS, text: str = "text",
         id_col: str = "doc_id", group_tokens: int = GROUP_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """A row per piece. ``tokenizer`` is the path of the vocabulary on the executors.
    Sequences have the length ``tier``, a power of two, and no padding."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    packed = written(rows.mapInPandas(_packer(tokenizer or default_tokenizer(), tuple(sorted(tiers)), group_tokens),
                                      _LOCAL), "packing-pieces")
    # One row per task and tier.
    counts = packed.groupBy("task", "tier").agg((F.max("number") + 1).alias("_n"))
    before = Window.partitionBy("tier").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "tier", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    group = F.expr(f"((_start + number) * tier) div {step_tokens}")
    return packed.join(starts, ["task", "tier"]).withColumn("step_group", group).select(
        *[c.split()[0] for c in PIECES.split(", ")])
