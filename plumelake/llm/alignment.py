"""Alignment of the tokens of two tokenizers, Arrow-native.

Both tokenizers cut the same bytes, a blank and the text. Where a token of A and a token
of B end at the same byte, a group ends; A and B tokens whose bytes overlap are linked.

In a task, for the documents of a part:

* The texts are cut at blanks behind other characters, where neither tokenizer has a token
  across (the vocabulary is checked for that), and each distinct chunk is encoded once.
* Chunk and token lists are Arrow lists: ``list_flatten`` gives the tokens of all documents,
  ``list_parent_indices`` their chunk and document.
* Token lengths, summed up and less the start of the document, are the ends of the tokens
  in it (a segmented cumulative sum).
* An Acero hash join of A and B on (document, end) finds the ends of groups.
* Every end of either side closes one link, so the links of a document are as many as its
  distinct ends. ``Table.group_by`` counts them per pair of ids.

A first pass encodes the texts in parts of ``PART`` bytes and stores for each part its
distinct chunks as ids, its documents as numbers of chunks, and the partial counts, for
which a chunk is aligned once. Spark merges the counts and finds the highest of each B id.
The counts of the pairs that a part holds go back to it, and a second pass aligns its
documents. So what a task holds is one part; a pair that every document holds is one row per
part; the counts are joined by a shuffle, never sent whole. A document longer than ``PART``
is a part of several pieces, which are worked off one after the other.

Defined results: null and empty texts, and texts that a tokenizer does not give back byte
by byte, have no tokens, zeros and an empty digest; repeated rows and rows without an id
are aligned one by one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from plumelake.llm.common import written
from plumelake.llm.packed import distinct, spread, squeeze
from plumelake.session import Workspace

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
PART = 1 << 20          # characters of texts in a part

# A row is the list of the documents of a part (``ids``), a piece of it (``piece``), or a
# pair of ids with its count in the part (``a``, ``b``, ``n``).
_PARTS = ("part long, ids array<long>, piece int, docs binary, chunks binary, per_doc binary, sizes binary, "
          "ids_a binary, per_a binary, ids_b binary, per_b binary, a int, b int, n long")
_DOCS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
         "groups_sha256 string")
_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

# Characters whose class (letter, number or other) is the same in every
# version of Unicode, so that any regex engine cuts them alike. No blank at the end.
_PLAIN = re.compile(
    r"[\n -~¡-¬®-ȠЀ-ҁぁ-ゔァ-ヺ一-龥가-힣]*"
    r"[!-~¡-¬®-ȠЀ-ҁぁ-ゔァ-ヺ一-龥가-힣]")
_BEHIND_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def default_paths() -> tuple[str, str, str]:
    """Vocabularies of A and B, and the pattern by which A cuts texts."""
    import public_tokenizers as public
    return public.path(TOKENIZER_A), public.path(TOKENIZER_B), public.PATTERN


def chunks(text: str) -> list[str]:
    """A blank and the text, cut before blanks that follow another character than white
    space. The blank that every chunk begins with is left out."""
    if _BEHIND_SPACE.search(" " + text):
        return [c[1:] for c in _CUT.split(" " + text)]
    return text.split(" ")


def _byte_letters() -> dict[str, int]:
    """The public mapping of bytes to printable letters in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def token_bytes(path_a: str, path_b: str) -> tuple[list[bytes], list[bytes]]:
    """The bytes of each token of A and of B by its id; none where it stands for no text."""
    import sentencepiece
    with open(path_a, encoding="utf-8") as f:
        content = json.load(f)
    vocabulary, letters = content["model"]["vocab"], _byte_letters()
    special = {t["content"] for t in content["added_tokens"]}
    a = [b""] * (max([*vocabulary.values(), *(t["id"] for t in content["added_tokens"])]) + 1)
    for token, i in vocabulary.items():
        if token not in special:
            a[i] = bytes(letters[c] for c in token)
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(re.search("[^▁]▁", p) for p in pieces):
        raise ValueError("a piece of B goes across words")
    return a, [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in enumerate(pieces)]


def token_lengths(path_a: str, path_b: str) -> tuple[pa.Array, ...]:
    return tuple(pa.array([len(t) for t in side], pa.int64()) for side in token_bytes(path_a, path_b))


class Coders:
    """Both tokenizers, with the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        import os
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path_a)
        self.whole.encode_special_tokens = True
        self.bytes_a, self.bytes_b = token_bytes(path_a, path_b)
        self.lengths_a, self.lengths_b = (pa.array([len(t) for t in side], pa.int64())
                                          for side in (self.bytes_a, self.bytes_b))
        ranks = {t: i for i, t in enumerate(self.bytes_a) if t}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.blank = self.b.piece_to_id("▁")

    def encode(self, chunks: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
        """Of A and B the ids of all chunks and how many each chunk has; whether both give
        the chunk back; and its length in bytes."""
        raw = [b" " + c.encode() for c in chunks]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        found = [ids if c else [self.blank] for c, ids in zip(chunks, self.b.encode(chunks, num_threads=1))] if raw else []
        per_b = np.fromiter(map(len, found), np.int32, len(found))
        ids_b = np.fromiter(chain.from_iterable(found), np.int32, int(per_b.sum()))
        ids_a, per_a = self._encode_a(chunks, sizes)
        ok = np.ones(len(raw), bool)
        for ids, per, known in ((ids_a, per_a, self.bytes_a), (ids_b, per_b, self.bytes_b)):
            tokens = list(map(known.__getitem__, ids.tolist()))
            ends = np.cumsum(per).tolist()
            if b"".join(tokens) != b"".join(raw) or np.any(self._bytes(ids, per, known) != sizes):
                ok &= np.fromiter((b"".join(tokens[e - n:e]) == r for e, n, r in zip(ends, per.tolist(), raw)), bool, len(raw))
        return [ids_a, ids_b], [per_a, per_b], ok, sizes

    def _bytes(self, ids: np.ndarray, per: np.ndarray, known: list) -> np.ndarray:
        lengths = (self.lengths_a if known is self.bytes_a else self.lengths_b).to_numpy()
        total = np.concatenate([[0], np.cumsum(lengths[ids])])
        ends = np.cumsum(per)
        return total[ends] - total[ends - per]

    def _encode_a(self, chunks: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((_PLAIN.fullmatch(c) is not None for c in chunks), bool, len(chunks))
        own = [c for c, p in zip(chunks, plain.tolist()) if p]
        flat = np.array(self.fast.encode_ordinary(" " + " ".join(own)) if own else [], np.int32)
        ends = np.cumsum(self.lengths_a.to_numpy()[flat])
        cuts = np.searchsorted(ends, np.cumsum(sizes[plain]), "right")
        per = np.zeros(len(chunks), np.int32)
        per[plain] = np.diff(cuts, prepend=0)
        if plain.all():
            return flat, per
        odd = np.nonzero(~plain)[0].tolist()
        others = [e.ids for e in self.whole.encode_batch([" " + chunks[i] for i in odd], add_special_tokens=False)]
        per[odd] = list(map(len, others))
        ids, begin = np.zeros(int(per.sum()), np.int32), np.cumsum(per) - per
        rest = np.ones(len(ids), bool)
        for at, own_ids in zip(begin[odd].tolist(), others):
            ids[at:at + len(own_ids)] = own_ids
            rest[at:at + len(own_ids)] = False
        ids[rest] = flat
        return ids, per


def _lists(per: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(_offsets(np.cumsum(per)), pa.array(values))


def _offsets(ends: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], ends]).astype(np.int32))


class _Piece:
    """Documents, or a stretch of a long one, as Arrow lists of numbers of chunks, and the
    ids of A and of B for each chunk."""

    def __init__(self, docs: np.ndarray, chunks: pa.Array, ids: list[np.ndarray], per: list[np.ndarray], sizes: np.ndarray):
        self.docs, self.chunks, self.raw, self.sizes = docs, chunks, (ids, per), sizes
        self.ids = [_lists(p, i) for p, i in zip(per, ids)]

    def row(self, part: int, piece: int) -> dict:
        (ids_a, ids_b), (per_a, per_b) = self.raw
        flat, per_doc = pc.list_flatten(self.chunks).to_numpy(), pc.list_value_length(self.chunks).to_numpy()
        numbers = {"docs": self.docs.astype(np.int64), "chunks": flat.astype(np.int32), "per_doc": per_doc.astype(np.int32),
                   "sizes": self.sizes, "ids_a": ids_a, "per_a": per_a, "ids_b": ids_b, "per_b": per_b}
        return {"part": part, "piece": piece, **{k: squeeze(v) for k, v in numbers.items()}}


def _read_piece(row: dict) -> _Piece:
    def numbers(name: str, kind=np.int32) -> np.ndarray:
        return spread(row[name], kind)
    return _Piece(numbers("docs", np.int64), _lists(numbers("per_doc"), numbers("chunks")),
                  [numbers("ids_a"), numbers("ids_b")], [numbers("per_a"), numbers("per_b")], numbers("sizes", np.int64))


def _encoded(coders: Coders, docs: list[tuple[int, list[str]]]) -> tuple[_Piece, set[int]]:
    """A piece of the documents that have tokens, and the others."""
    numbers: dict[str, int] = {}
    flat = [numbers.setdefault(c, len(numbers)) for _, own in docs for c in own]
    flat, per = np.array(flat, np.int32), np.array([len(own) for _, own in docs], np.int32)
    ids, per_chunk, ok, sizes = coders.encode(list(numbers))
    at = np.array([d for d, _ in docs], np.int64)
    lists = _lists(per, flat)
    bad = np.zeros(len(docs), bool)
    if not ok.all():
        bad = np.bincount(pc.list_parent_indices(lists).to_numpy(), ~ok[flat], len(docs)) > 0
        lists = lists.filter(pa.array(~bad))
    return _Piece(at[~bad], lists, ids, per_chunk, sizes), set(at[bad].tolist())


def _side(lists: pa.Array, lengths: pa.Array, chosen: pa.Array, doc_of: pa.Array, base: pa.Array) -> pa.Table:
    """Tokens of the chosen lists in order: number, id, document, end in the whole piece, and
    the key of document and end in it."""
    taken = lists.take(chosen)
    ids, parent = pc.list_flatten(taken), pc.list_parent_indices(taken)
    doc = doc_of.take(parent)
    end = pc.cumulative_sum(lengths.take(ids)) if len(ids) else pa.array([], pa.int64())
    key = pc.add(pc.shift_left(doc.cast(pa.int64()), 32), pc.subtract(end, base.take(doc)))
    return pa.table({"n": pa.array(np.arange(len(ids), dtype=np.int32)), "id": ids, "doc": doc, "all": end, "key": key})


def _sides(piece: _Piece, chosen: pa.Array, doc_of: pa.Array, lengths: tuple[pa.Array, pa.Array]) -> tuple[pa.Table, ...]:
    sizes = pa.array(piece.sizes).take(chosen).to_numpy()
    n = int(doc_of.to_numpy()[-1]) + 1 if len(doc_of) else 0
    per_doc = np.bincount(doc_of.to_numpy(), sizes, n).astype(np.int64) if n else np.zeros(0, np.int64)
    base = pa.array(np.cumsum(per_doc) - per_doc)
    return tuple(_side(lists, known, chosen, doc_of, base) for lists, known in zip(piece.ids, lengths))


def _links(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the linked tokens: each end of either side closes one link."""
    ends_a, ends_b = a["all"].to_numpy(), b["all"].to_numpy()
    ends = distinct(np.concatenate([ends_a, ends_b]))
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def _pieces(coders: Coders, texts: list[str], limit: int) -> Iterator[_Piece]:
    """The documents that have tokens, in pieces of about ``limit`` characters."""
    waiting, held = [], 0
    for number, text in enumerate(texts):
        if not text:
            continue
        own = chunks(text)
        if len(text) <= limit:
            waiting.append((number, own))
            held += len(text)
            if held >= limit:
                yield _encoded(coders, waiting)[0]
                waiting, held = [], 0
            continue
        stretches, start, size = [], 0, 0
        for i, c in enumerate(own):
            size += len(c) + 1
            if size >= limit:
                stretches.append((start, i + 1))
                start, size = i + 1, 0
        stretches += [(start, len(own))] if start < len(own) else []
        if not any(_encoded(coders, [(number, own[x:y])])[1] for x, y in stretches):
            for x, y in stretches:
                yield _encoded(coders, [(number, own[x:y])])[0]
    if waiting:
        yield _encoded(coders, waiting)[0]


# --- first pass: ids and partial counts -----------------------------------------------

def _counts(piece: _Piece, lengths: tuple[pa.Array, pa.Array]) -> pa.Table:
    """Links of a pair of ids in a piece: those of each distinct chunk, as often as the
    chunk occurs."""
    occurs = np.bincount(pc.list_flatten(piece.chunks).to_numpy(), minlength=len(piece.sizes))
    each = pa.array(np.nonzero(occurs)[0].astype(np.int32))
    a, b = _sides(piece, each, pa.array(np.arange(len(each))), lengths)
    x, y = _links(a, b)
    times = occurs[each.to_numpy()][a["doc"].to_numpy()[x]]
    found = pa.table({"a": a["id"].take(pa.array(x)), "b": b["id"].take(pa.array(y)), "n": pa.array(times, pa.int64())})
    return _summed(found)


def _summed(found: pa.Table) -> pa.Table:
    return found.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["a", "b", "n"])


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
_PART_SCHEMA = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in _PARTS.split(", ")])


def _encode(paths: tuple[str, str, str], limit: int):
    def of_part(coders: Coders, ids: list, texts: list) -> Iterator[pa.RecordBatch]:
        part, found = uuid.uuid4().int >> 65, []
        rows = [{"part": part, "ids": ids}]
        for n, piece in enumerate(_pieces(coders, texts, limit)):
            if len(piece.docs):
                rows.append(piece.row(part, n))
                found.append(_counts(piece, (coders.lengths_a, coders.lengths_b)))
        yield pa.RecordBatch.from_pylist(rows, schema=_PART_SCHEMA)
        if found:
            total = _summed(pa.concat_tables(found))
            columns = {"part": pa.array(np.full(total.num_rows, part, np.int64)), **{c: total[c] for c in ("a", "b", "n")}}
            empty = {f.name: pa.nulls(total.num_rows, f.type) for f in _PART_SCHEMA if f.name not in columns}
            yield from pa.table({**empty, **columns}).select(_PART_SCHEMA.names).cast(_PART_SCHEMA).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, ids, texts, held = None, [], [], 0
        for batch in batches:
            for doc, text in zip(batch["_id"], batch["_text"]):      # one by one: a batch may be large
                ids.append(doc.as_py())
                texts.append(text.as_py() or "")
                held += len(texts[-1]) + 16
                if held >= limit:
                    coders = coders or Coders(*paths)
                    yield from of_part(coders, ids, texts)
                    ids, texts, held = [], [], 0
                    pa.default_memory_pool().release_unused()
        if ids:
            yield from of_part(coders or Coders(*paths), ids, texts)
    return run


# --- second pass: the documents ---------------------------------------------------------

def _digests(a: pa.Table, b: pa.Table, last_a: np.ndarray, last_b: np.ndarray, docs: int) -> tuple[list, np.ndarray]:
    """Groups of each document as text, and their number. ``last_*``: the tokens that end
    a group."""
    def joined(side: pa.Table, last: np.ndarray) -> pa.Array:
        words = side["id"].combine_chunks().cast(pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(_offsets(last + 1), words), ",")
    groups = pc.binary_join_element_wise(joined(a, last_a), joined(b, last_b), "|")
    per_doc = np.bincount(a["doc"].to_numpy()[last_a], minlength=docs)
    lists = pa.ListArray.from_arrays(_offsets(np.cumsum(per_doc)), groups)
    return pc.binary_join(lists, ";").to_pylist(), per_doc


def _align(paths: tuple[str, str, str]):
    columns, known = [c.split()[0] for c in _DOCS.split(", ")], []     # the lengths, read once in a task
    kinds = [pa.string() if c == "groups_sha256" else pa.int64() for c in columns]

    def run(parts: pa.Table, counts: pa.Table) -> pa.Table:
        if not parts.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=columns)
        rows = parts.to_pylist()
        ids = next(r["ids"] for r in rows if r["ids"] is not None)
        known[:] = known or [token_lengths(*paths[:2])]
        lengths = known[0]
        pair = counts["a"].to_numpy().astype(np.int64) << 32 | counts["b"].to_numpy()
        order = np.argsort(pair)
        pair, n, top = pair[order], counts["n"].to_numpy()[order], counts["top"].to_numpy()[order]
        sums = {c: np.zeros(len(ids), np.int64) for c in _SUMS}
        digests: dict[int, hashlib._Hash] = {}
        for piece in map(_read_piece, sorted((r for r in rows if r["ids"] is None), key=lambda r: r["piece"])):
            chosen, doc_of = pc.list_flatten(piece.chunks), pc.list_parent_indices(piece.chunks)
            a, b = _sides(piece, chosen, doc_of, lengths)
            both = a.select(["key", "n"]).join(b.select(["key", "n"]), "key", join_type="inner", right_suffix="_b",
                                               use_threads=False)
            texts, groups = _digests(a, b, np.sort(both["n"].to_numpy()), np.sort(both["n_b"].to_numpy()), len(piece.docs))
            for doc, text in zip(piece.docs.tolist(), texts):
                if doc in digests:
                    digests[doc].update(b";")
                digests.setdefault(doc, hashlib.sha256()).update(text.encode())
            x, y = _links(a, b)
            linked = a["doc"].to_numpy()[x]
            at = np.searchsorted(pair, a["id"].to_numpy()[x].astype(np.int64) << 32 | b["id"].to_numpy()[y])
            per_doc = pa.table({"doc": linked, "best": (n[at] == top[at]).astype(np.int64), "n": n[at]}).group_by(
                "doc", use_threads=False).aggregate([("best", "sum"), ("n", "sum"), ([], "count_all")])
            where = piece.docs[per_doc["doc"].to_numpy()]
            for name, found in (("n_best", "best_sum"), ("count_sum", "n_sum"), ("n_links", "count_all")):
                np.add.at(sums[name], where, per_doc[found].to_numpy())
            np.add.at(sums["n_groups"], piece.docs, groups)
            for name, side in (("n_a", a), ("n_b", b)):
                np.add.at(sums[name], piece.docs, np.bincount(side["doc"].to_numpy(), minlength=len(piece.docs)))
        pa.default_memory_pool().release_unused()
        sha = [digests[d].hexdigest() if d in digests else "" for d in range(len(ids))]
        return pa.table([pa.array(ids, pa.int64()), *[pa.array(sums[c]) for c in _SUMS], pa.array(sha)],
                        names=columns)
    return run


def align(docs: DataFrame, text: str = "text", id_col: str = "doc_id", paths: tuple[str, str, str] | None = None,
          part_bytes: int = PART) -> tuple[DataFrame, DataFrame]:
    """A row per document (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256), and the table of linked pairs: a, b, n, and ``top``, the highest
    count of b. ``paths``: both vocabularies on the executors and the pattern of A. Runs
    when called and stores both results."""
    spark, paths = docs.sparkSession, paths or default_paths()
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    with Workspace(spark, "alignment") as space:
        parts = space.written(rows.mapInArrow(_encode(paths, part_bytes), _PARTS), "parts")
        pairs = parts.where(F.col("a").isNotNull()).select("part", "a", "b", "n")
        counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
        # One row per A id at most for each B id.
        table = written(counts.withColumn("top", F.max("n").over(Window.partitionBy("b"))), "alignment-pairs")
        answers = pairs.select(F.col("part").alias("of"), "a", "b").join(table, ["a", "b"])
        pieces = parts.where(F.col("a").isNull()).drop("a", "b", "n")
        aligned = written(pieces.groupBy("part").cogroup(answers.groupBy("of")).applyInArrow(
            _align(paths), _DOCS), "alignment-documents")
    return aligned, table
