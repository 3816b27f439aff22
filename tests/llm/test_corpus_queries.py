"""Registered corpus queries against their SQL, and the pipeline against its stages."""

from collections import Counter

import brute
import compare
import corpus_pipeline
import pytest

from plumelake.llm import quality_classifier as qc, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_sql(spark, name):
    assert compare.differences(spark, name, SF) == []


def test_registered():
    names = list(compare.contract.queries())
    assert [n.split("_")[0] for n in queries.registered()] == [f"op{n}" for n in range(1, 14)]
    assert "pipeline" in names and set(queries.registered()) <= set(names)


@pytest.mark.parametrize("name", sorted(set(queries.registered()) - set(queries.statements())))
def test_other_queries_run(spark, name):
    assert queries.registered()[name](spark, SF).count() > 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage is checked on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SF).write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept[-1].columns == docs.columns
    read, good, unique, clean, mixed, packed = kept

    def rows(df):
        return {r["doc_id"]: r["text"] for r in df.collect()}
    texts, good, unique, clean = rows(read), rows(good), rows(unique), rows(clean)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = [labels[d] == (d in good) for d in texts if d in labels]
    assert sum(right) / len(right) > 0.9
    assert all(texts[d] == t for d, t in good.items())
    found = brute.simhash_components(list(good.items()))
    assert sorted(unique) == sorted({c for _, _, c in found})
    assert clean.keys() == unique.keys()
    assert not [d for d, t in clean.items() if brute.personal(t)]
    untouched = [d for d, t in unique.items() if not brute.personal(t)]
    assert all(clean[d] == unique[d] for d in untouched)
    taken = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    assert {d for d, _ in taken} <= clean.keys() and all(clean[d] == t for d, t in taken)
    import public_tokenizers
    from tokenizers import Tokenizer
    from plumelake.llm import packing
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    pieces = [r.asDict() for r in packed.collect()]
    assert brute.pieces_are_right(taken, pieces, lambda t: tokenizer.encode(
        t or "", add_special_tokens=False).ids + [packing.END]) == 0


def test_stages_on_odd_documents(spark, docs, crowded, corpus, no_docs, tmp_path):
    """Nulls, empty and very long texts, repeated rows and ids, rows without an id, extra
    columns: every stage against a plain version on its own input."""
    import public_tokenizers
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer
    from plumelake.llm import mixing, packing
    labelled = [(r[0], int(len((r[1] or "").split()) > 8), 0) for r in corpus if r[0] is not None]
    spark.createDataFrame(labelled, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def rows(df):
        return Counter((r["doc_id"], r["text"]) for r in df.collect())
    read = rows(docs)
    good = stages["quality classifier"](spark, docs, str(tmp_path))
    assert good.columns == docs.columns and not rows(good) - read
    by_text = {}
    for doc, text in read:
        by_text.setdefault(text, set()).add((doc, text) in rows(good))
    assert all(len(verdicts) == 1 for verdicts in by_text.values())      # a text has one verdict

    unique = stages["simhash near-duplicates"](spark, crowded, str(tmp_path))
    assert unique.columns == crowded.columns
    kept = rows(unique)
    prints = {row: int(p, 16) for row, (_, p, _) in zip(read, brute.simhash_components(list(read)))}
    codes = sorted(set(prints.values()))
    root = dict(zip(codes, brute.linked(codes)))
    assert max(kept.values()) == 1 and not kept - read
    assert sorted(root[prints[r]] for r in kept) == sorted(set(root.values()))

    clean = stages["personal data"](spark, unique, str(tmp_path))
    assert clean.columns == crowded.columns
    assert not [t for _, t in rows(clean) if brute.personal(t)]
    assert sorted(str(d) for d, _ in rows(clean)) == sorted(str(d) for d, _ in kept)

    mixed = stages["mixing"](spark, clean, str(tmp_path))
    assert mixed.columns == crowded.columns
    copies = mixing.mix(clean).groupBy().agg(F.sum("copies")).first()[0]
    assert sum(rows(mixed).values()) == copies and set(rows(mixed)) <= set(rows(clean))

    packed = [r.asDict() for r in stages["packing"](spark, mixed, str(tmp_path)).collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    taken = [row for row, n in rows(mixed).items() for _ in range(n)]
    assert brute.pieces_are_right(taken, packed, lambda t: tokenizer.encode(
        t or "", add_special_tokens=False).ids + [packing.END]) == 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, str(tmp_path)).count() == 0, name


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert qc.SAMPLE == 20_000
