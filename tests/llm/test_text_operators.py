"""Operators on documents against plain versions, over all odd cases."""

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from plumelake.llm import packing, pii, quality_rules as qr, simhash, substrings


def pairs(corpus):
    return [(r[0], r[1]) for r in corpus]


def ordered(rows):
    return sorted(rows, key=repr)


# --- quality rules --------------------------------------------------------------

RULE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_measures(docs, corpus):
    got = qr.measure(docs, "text", ["doc_id"]).withColumn("base_failed", qr.base_failed())
    want = [(d, *[brute.rule_measures(t)[c] for c in RULE_COLUMNS]) for d, t in pairs(corpus)]
    assert ordered(tuple(r) for r in got.select("doc_id", *RULE_COLUMNS).collect()) == ordered(want)


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (50, 3, 0.2), (1000, 2, 0.01), (30_000, 100, 0.005),
                                   (400, 7, 0.02), (21, 20, 0.999), (5, 5, 0.5)])
def test_binomial_tail(spark, n, k, p):
    from math import exp, lgamma, log, log1p
    want = sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p))
               for i in range(k + 1))
    got = spark.range(1).select(qr.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
    assert got == (pytest.approx(want, rel=1e-9) if k < n * p else 1.0)


def test_cutoffs_need_enough_good_documents(spark):
    """Of 3,000 good documents 3 have many symbols, of 500 bad ones all."""
    rows = spark.range(3500).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit(100).cast("long").alias("n_words"),
        F.lit(1000).cast("long").alias("word_chars"),
        F.when((F.col("id") < 3) | (F.col("id") >= 3000), 250).otherwise(0).cast("long").alias("n_symbols"),
        *[F.lit(0).cast("long").alias(c) for c in ("_capitals", "_lines", "n_dup_lines", "n_repeat_words")])
    labels = spark.range(3500).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, 1).otherwise(0).alias("quality"))
    chosen = qr.choose_cutoffs(rows, labels, "lang").collect()
    # The first step that rejects the bad ones: the second for symbols, the first for all others.
    assert sorted((r["rule"], r["cutoff"], r["n"], r["lost"], r["gain"]) for r in chosen) == [
        ("capital_rate", 800, 3000, 3, 500), ("dup_line_rate", 700, 3000, 3, 500), ("repeat_rate", 180, 3000, 3, 500),
        ("symbol_rate", 200, 3000, 3, 500)]
    judged = qr.judge(rows, qr.choose_cutoffs(rows, labels, "lang"), "lang")
    assert judged.where("kept").count() == 2997
    few = qr.choose_cutoffs(rows, labels.where("doc_id % 50 = 7"), "lang")
    assert few.count() == 0                         # 60 good ones, none of them lost, prove nothing
    assert qr.judge(rows, few, "lang").where("kept").count() == 3500


def test_a_path_ends_at_its_first_failure(spark):
    """The bad documents could only be told by repeats, but before that capitals would cost
    more good ones than the risk; in the other stratum they cost none. Where good documents
    are lost at random, the loss stays below the risk but for a chance of delta."""
    rng = random.Random(2)
    rows, labels = [], []
    for lang, shouting in (("a", 0.05), ("b", 0.0)):
        for n in range(900):
            good, doc = n % 3 > 0, len(rows)
            capitals = 170 if good and rng.random() < shouting else 10
            rows.append((doc, lang, 100, 1000, 0, capitals, 0, 0, 0 if good else 15))
            labels.append((doc, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, _capitals long, "
                                     "_lines long, n_dup_lines long, n_repeat_words long")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    chosen = {(r["lang"], r["rule"]): r for r in qr.choose_cutoffs(df, known, "lang").collect()}
    path = qr.path_of(qr.CUTOFFS)
    assert path[:4] == [("symbol_rate", 300), ("capital_rate", 800), ("dup_line_rate", 700), ("repeat_rate", 180)]
    assert chosen["b", "repeat_rate"]["cutoff"] == 120 and chosen["b", "repeat_rate"]["gain"] == 300
    before = path.index(("capital_rate", 150)) > path.index(("repeat_rate", 120))
    assert (("a", "repeat_rate") in chosen) == before
    for r in chosen.values():
        assert r["lost"] / r["n"] < qr.RISK


def test_rules_on_odd_tables(spark, crowded, no_docs, corpus):
    labels = spark.createDataFrame([(7, 0), (8, 1), (8, None), (None, 1), (999, 0), (9, 5)], "doc_id long, quality int")
    got = qr.quality_rules(crowded, labels)
    assert got.count() == len(corpus)
    assert got.where("base_failed and kept").count() == 0
    assert qr.quality_rules(no_docs, labels).count() == 0


# --- repeated substrings --------------------------------------------------------

DEDUP_COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_substrings(crowded, corpus):
    small = [r for r in pairs(corpus) if len(r[1] or "") < 20_000]
    got = substrings.remove_repeats(crowded.where(F.length(F.coalesce("text", F.lit(""))) < 20_000))
    assert ordered(tuple(r) for r in got.select(DEDUP_COLUMNS).collect()) == ordered(brute.without_repeats(small))


def test_substrings_inside_one_long_text(spark):
    """A long text across several chunks, whose passages come back in two others."""
    import random
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(2_500_000))
    rows = [(600, long), (2, long[1_048_500:1_048_700]), (900, "x" + long[2_000_000:2_000_060] + "y" * 70)]
    got = {r["doc_id"]: r for r in substrings.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string"), with_bytes=True).collect()}
    assert (got[2]["n_removed"], got[600]["n_removed"], got[900]["n_removed"]) == (0, 200, 60)
    assert bytes(got[900]["kept"]).decode() == "x" + "y" * 70
    assert got[600]["kept"] == (long[:1_048_500] + long[1_048_700:]).encode()


def test_strings_that_share_a_rank_are_told_apart(spark, corpus, monkeypatch):
    """With ranks of a few bits nearly all strings share theirs, and nothing is removed that
    does not repeat; rows without an id and long texts are spread over parts."""
    small = [(d, t[:600]) for d, t in pairs(corpus) if t]
    exact = substrings.ranks
    monkeypatch.setattr(substrings, "ranks", lambda data, length: exact(data, length) & np.uint64(
        7 if length == substrings.LENGTH else 2 ** 64 - 1))
    monkeypatch.setattr(substrings, "LONG", 500)
    got = substrings.remove_repeats(spark.createDataFrame(small, "doc_id long, text string").repartition(3))
    assert ordered(tuple(r) for r in got.select(DEDUP_COLUMNS).collect()) == ordered(brute.without_repeats(small))
    parts = {substrings._part_of(d, t) for d, t in [
        (3, b"a"), (4, b"b"), (5, b"x" * 501), (substrings.NO_ID, b"a"), (substrings.NO_ID, b"b")]}
    assert len(parts) == 4


def test_short_texts_are_ranked_together(monkeypatch):
    """Anchors of many texts take few passes and are those of each text alone; copies of a
    neighbourhood are settled before its strings are ranked."""
    import random
    import pandas as pd
    rng, calls, exact = random.Random(5), [], substrings.ranks

    def counted(data, length):
        calls.append((length, len(data)))
        return exact(data, length)
    monkeypatch.setattr(substrings, "ranks", counted)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.choice([0, 1, 49, 50, 51, 200]))) for _ in range(300)]
    texts += [texts[-1] + texts[-2] + "x" * 60]
    frame = pd.DataFrame({"_id": range(len(texts)), "_text": texts})
    list(substrings._send_ranks(2)([frame]))
    assert len(calls) <= 8
    text, place, rank, mask = substrings.anchors(*substrings._joined([t.encode() for t in texts]))
    got = {(t, p): (r, m) for t, p, r, m in zip(text.tolist(), place.tolist(), rank.tolist(), mask.tolist())}
    want: dict = {}
    for n, t in enumerate(texts):
        own = (substrings._mixed(exact(np.frombuffer(t.encode(), np.uint8), substrings.ANCHOR)) | np.uint64(1)).tolist() \
            if len(t) >= substrings.LENGTH else []
        for begin in range(len(t) - substrings.LENGTH + 1):
            window = own[begin:begin + 27]
            for b in (b for b, r in enumerate(window) if r == min(window)):
                r, m = want.get((n, begin + b), (window[b], 0))
                want[n, begin + b] = r, m | 1 << b
    assert got == want
    # A passage in forty parts: one of its copies is ranked.
    line = "".join(rng.choice("abcdefgh ") for _ in range(400))
    many = pd.DataFrame({"_id": [n * substrings.PART for n in range(40)], "_text": [
        "".join(rng.choice("abcdefgh ") for _ in range(30)) + line for _ in range(40)]})
    parts = pd.concat(substrings._pack_parts([many]))
    codes = substrings._codes(substrings.anchors(*substrings._joined([line.encode()]))[2])
    known = pd.DataFrame([(0, 0, 1, substrings._sent(codes))], columns=["slice", "part", "kind", "payload"])
    sent = pd.concat(substrings._send_neighbourhoods(1)((n,), parts.iloc[[n]], known) for n in range(40))
    calls.clear()
    found = substrings._removals((0,), sent)
    assert set(found["part"]) >= set(range(1, 40)) and sum(n for length, n in calls if length == substrings.LENGTH) < 200


def test_substrings_of_nothing(no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("length", [1, 2, 3, 24, 50])
def test_equal_strings_have_equal_ranks(length):
    import numpy as np
    data = np.frombuffer(b"abcabcabcabc" * 20, np.uint8)
    rank = substrings.ranks(data, length)
    assert len(rank) == len(data) - length + 1
    for i in range(len(rank)):
        assert (rank[i] == rank[0]) == (bytes(data[i:i + length]) == bytes(data[:length]))


# --- simhash --------------------------------------------------------------------

def test_components(crowded, corpus):
    got = simhash.near_duplicates(crowded).select(
        "doc_id", simhash.as_hex(F.col("fp")), "component_id")
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute.simhash_components(pairs(corpus)))


@pytest.mark.parametrize("tile", [40, 1 << 16])
def test_index_finds_every_link(spark, tile):
    """Clusters of any density, in one node or dealt out to tiles."""
    import random
    rng = random.Random(1)
    codes = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(120):
            code = centre
            for _ in range(rng.randint(0, 6)):
                code ^= 1 << rng.randrange(64)
            codes.add(code)
    codes = sorted(codes)
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    from plumelake.llm.components import components
    found = components(simhash.links(spark.createDataFrame(signed, "fp long"), tile=tile)).collect()
    root = {r["node"] & (1 << 64) - 1: r["root"] for r in found}
    want = brute.linked(codes)
    groups = {}
    for c, w in zip(codes, want):
        groups.setdefault(w, []).append(c)
    for members in groups.values():
        assert len({root.get(m, m) for m in members}) == 1
    assert len({root.get(c, ("alone", c)) for c in codes}) == len(groups)


def test_long_chain_of_links(spark):
    from plumelake.llm.components import components
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r["node"], r["root"]) for r in components(edges).collect()} == {(n, 0) for n in range(301)}
    assert components(edges.where("false")).count() == 0


def first_of_each(rows):
    """Ids that stay, by component of linked fingerprints, and the texts that may stand for
    each: rows with equal ids in one component have no order here."""
    prints = [int(p, 16) for _, p, _ in brute.simhash_components(rows)]
    codes = sorted(set(prints))
    root = dict(zip(codes, brute.linked(codes)))
    members = {}
    for (doc, text), p in zip(rows, prints):
        members.setdefault(root[p], []).append((doc is None, doc or 0, text))
    return [(None if m[0][0] else m[0][1], {t for v, d, t in m if (v, d) == m[0][:2]})
            for m in (sorted(ms, key=lambda x: x[:2]) for ms in members.values())]


def test_first_of_each(docs, corpus, crowded, no_docs):
    got = simhash.first_of_each(crowded)
    assert got.columns == crowded.columns
    want = first_of_each(pairs(corpus))
    have = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(have) == len(want)
    for doc, texts in want:
        assert sum(d == doc and t in texts for d, t in have) == 1
    assert simhash.first_of_each(no_docs).count() == 0


def test_rows_with_one_id_and_other_texts_stay(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(80)) for _ in range(4)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[1] + " tail"), (None, texts[2]), (None, texts[2]),
            (None, texts[2] + " tail"), (None, None), (None, ""), (3, texts[3]), (3, texts[3]), (None, texts[3])]
    got = simhash.first_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((str(r["doc_id"]), (r["text"] or "")[:20]) for r in got) == sorted(
        [("1", texts[0][:20]), ("1", texts[1][:20]), ("None", texts[2][:20]), ("None", ""), ("3", texts[3][:20])])


# --- packing --------------------------------------------------------------------

def tokenizer_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    global _tokenizer
    try:
        _tokenizer
    except NameError:
        _tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    return _tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]


@pytest.mark.parametrize("text", [
    "Don't stop, it's 2024: we'll see!", "naïve Straße ÀÉ ÿ x²µª", "“quoted” … — œuvre Ǆ İstanbul ΣΑΣ", "é äb",
    "<|endoftext|> a<|startoftext|>b", "a\x1cb \x85 \xa0c d", "a_b-c __ $$$ ###", "日本語 テスト 한국어 🙂🙂", "\x00 \x7f"])
def test_token_ids(text):
    import public_tokenizers
    got = packing.token_ids(text, packing.WordIds(public_tokenizers.path(packing.TOKENIZER)))
    assert [int.from_bytes(got[i:i + 4], "little") for i in range(0, len(got), 4)] == tokenizer_ids(text)


@pytest.mark.parametrize("group_tokens", [3000, packing.GROUP_TOKENS])
def test_packing(crowded, corpus, group_tokens):
    got = [r.asDict() for r in packing.pack(crowded, group_tokens=group_tokens).collect()]
    assert brute.pieces_are_right(pairs(corpus), got, tokenizer_ids) == 0
    assert unbalanced(got, packing.STEP_TOKENS) == 0


def unbalanced(pieces, step_tokens):
    """Step groups, over all tasks, that are not full, without the last of each tier; and
    holes in their numbers."""
    steps = {}
    for p in pieces:
        steps.setdefault(p["tier"], {}).setdefault(p["step_group"], set()).add(p["sequence_id"])
    wrong = 0
    for tier, groups in steps.items():
        wrong += sorted(groups) != list(range(len(groups)))
        wrong += sum(len(groups[g]) * tier != max(step_tokens, tier) for g in range(len(groups) - 1))
        wrong += len(groups[len(groups) - 1]) * tier > max(step_tokens, tier)
    return wrong


def test_step_groups_are_full_across_tasks(docs, corpus):
    got = [r.asDict() for r in packing.pack(docs.repartition(7), group_tokens=3000, step_tokens=4096).collect()]
    assert len({p["sequence_id"] >> 40 for p in got}) == 7
    assert len({(p["tier"], p["step_group"]) for p in got}) > 12
    assert unbalanced(got, 4096) == 0
    assert brute.pieces_are_right(pairs(corpus), got, tokenizer_ids) == 0


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs).count() == 0


# --- personal data --------------------------------------------------------------

ODD = ["mail a@b.c%d@e.f and x.y+z@host-1.example.org. @ a@b", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 010.0.0.001 9.9.9.9999",
       "4111 1111 1111 1111 4111-1111-1111-1112 1234567890123 0000000000000 4  5", "+49 (30) 1234-5678 +1 +12345678 +1234567890123456",
       "é" * 70 + " me@ex.org " + "ü" * 70 + " 10.0.0.1", "+(1) ++49 30 123456 -", "9" * 5000, "a" * 3000 + "@" + "b." * 300,
       "@" * 50, "1" * 13 + " " + "4" * 19, None, ""]


def test_patterns(spark, crowded):
    docs = spark.createDataFrame([(n, t, "clash") for n, t in enumerate(ODD)], "doc_id long, text string, kind string")
    base, _ = pii.find_all(docs, ["doc_id"])
    got = {r["doc_id"]: r["s"] for r in base.select("doc_id", pii.spans_text(F.col("_spans")).alias("s")).collect()}
    assert got == {n: ",".join(f"{k}:{s}:{e}" for k, s, e in brute.personal(t)) for n, t in enumerate(ODD)}
    assert pii.find_all(crowded, ["doc_id", "spans"])[0].count() == crowded.count()


def leaking(spark):
    """The word ``vendrik`` stands beside one address only; ``office`` beside all."""
    rows = [(n, f"plain office text number {'abcdefgh'[n % 8] * 4}") for n in range(40)]
    rows += [(100 + n, f"write to office of vendrik person1@ex.org before {'klmnopqr'[n] * 4}") for n in range(5)]
    rows += [(200 + n, f"write to office of person2@ex.org before {'stuvwxyz'[n] * 4}") for n in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_disclose(spark):
    docs = leaking(spark)
    base, terms = pii.find_all(docs, ["doc_id"])
    found = {r["entity"]: r["term"] for r in pii.disclosing(docs, base).collect()}
    assert found == {"person1@ex.org": "vendrik"}
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert out[100] == "write to office of  [EMAIL] before kkkk"
    assert out[200] == "write to office of [EMAIL] before ssss"
    assert out[0] == "plain office text number aaaa"
    kept = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, remove=2.0).collect()}
    assert kept[101] == "write to office of [TERM] [EMAIL] before llll"


def test_term_far_from_its_entity_goes_everywhere(spark):
    """The name stands in the title and far behind the address, in every document of it."""
    filler = "plain words between them all the time " * 4
    rows = [(n, f"{filler} {'abcdefgh'[n % 8] * 4}") for n in range(200)]
    rows += [(300 + n, f"Vendrik {filler} person1@ex.org {filler} vendrik. {filler}{n}") for n in range(4)]
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[300] == f" {filler} [EMAIL] {filler} . {filler}0" and out[0] == rows[0][1]


def test_a_pair_needs_two_texts(spark):
    """A name and an address that two documents hold, among many. What one document holds
    once, or in copies of one text, proves nothing."""
    rows = [(n, f"plain office text number {'abcdefgh'[n % 8] * 4}") for n in range(400)]
    rows += [(500, "plain text of vendrik at person1@ex.org"), (501, "office text of vendrik for person1@ex.org")]
    rows += [(600 + n, "plain text of kellmann at person2@ex.org") for n in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base, _ = pii.find_all(docs, ["doc_id"])
    assert [(r["entity"], r["term"]) for r in pii.disclosing(docs, base).collect()] == [("person1@ex.org", "vendrik")]
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert out[500] == "plain text of  at [EMAIL]" and out[600] == "plain text of kellmann at [EMAIL]"


def plain_disclosing(rows):
    """Flagged pairs by counting document after document."""
    import math
    import regex
    from collections import Counter
    held, n_t, n_c, n_ct, texts = {}, Counter(), Counter(), Counter(), Counter()
    for _, text in rows:
        text = text or ""
        free, entities = text, set()
        for _, s, e in brute.personal(text):
            free = free[:s] + " " * (e - s) + free[e:]
            entities.add(text[s:e].lower())
        n_t.update({w.lower() for w in regex.findall(r"\p{L}{3,}", text)})
        n_c.update(entities)
        held.setdefault(text, [0, entities, {w.lower() for w in regex.findall(r"\p{L}{3,}", free)}])[0] += 1
    for copies, entities, words in held.values():
        for pair in ((c, w) for c in entities for w in words):
            n_ct[pair] += copies
            texts[pair] += 1
    out = set()
    for (c, w), n in n_ct.items():
        left, information = -math.log2(n / n_t[w]), math.log2(len(rows) / n_c[c])
        share = 1 - left / information if information > 0 else 0
        if left - math.log2(0.05) / texts[c, w] <= 2.2 and share >= 0.8:
            out.add((c, w))
    return out


@pytest.mark.parametrize("many", [400, 4000])
def test_names_beside_addresses_are_found_and_other_words_are_not(spark, many):
    """Planted: 40 persons whose name stands with their address in three documents, among
    common and rare words. The threshold does not move with the number of documents."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(n))     # noqa: E731
    common = [word(2) for _ in range(150)]
    filler = lambda n: [rng.choice(common) if rng.random() < 0.9 else word(5) for _ in range(n)]
    rows = [(n, " ".join(filler(40))) for n in range(many)]
    names = [word(4) + "son" for _ in range(40)]
    for n, name in enumerate(names):
        for _ in range(3):
            rows.append((len(rows), " ".join([*filler(20), name, f"p{n}@ex.org", *filler(20)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base, _ = pii.find_all(docs, ["doc_id"])
    found = {(r["entity"], r["term"]) for r in pii.disclosing(docs, base).collect()}
    assert found == plain_disclosing(rows)
    planted = {(f"p{n}@ex.org", name) for n, name in enumerate(names)}
    assert len(found & planted) >= 0.9 * len(planted)
    assert len(found - planted) <= 0.02 * 120 * 40


def test_disclosing_equals_plain_version(spark, docs, corpus):
    rows = pairs(corpus) + [(None, t) for t in ODD if t and len(t) < 1000] * 2
    more = spark.createDataFrame(rows, "doc_id long, text string")
    base, _ = pii.find_all(more, ["doc_id"])
    assert {(r["entity"], r["term"]) for r in pii.disclosing(more, base).collect()} == plain_disclosing(rows)


def test_sanitise_odd_tables(spark, crowded, no_docs):
    docs = spark.createDataFrame([(n, t, "x") for n, t in enumerate(ODD)], "doc_id long, text string, share string")
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == len(ODD)
    for r in out.collect():
        assert brute.personal(r["text"]) == []
    assert pii.sanitise(crowded).count() == crowded.count()
    assert pii.sanitise(no_docs).count() == 0


def test_base_digest(spark):
    from plumelake.llm import queries
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    got = queries.op6_personal_data(spark, "/root/testdata/sf0.001").select("n_email", "base_sha256", "spans").collect()
    for r in got:
        base = ",".join(s for s in r["spans"].split(",") if s and not s.startswith("term"))
        assert hashlib.sha256(base.encode()).hexdigest() == r["base_sha256"]
