import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def invented(rng, n):
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows of documents with every odd case: null and empty texts, blanks, a very long
    one, copies, near copies, shared passages, repeated rows and ids, null ids."""
    rng = random.Random(7)
    passage, base = invented(rng, 30), invented(rng, 120)
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "one two", "ÄÖ É ß … “x” naïve",
             invented(rng, 40_000), base, base, base.replace(" ", "\n", 20),
             base.replace(base.split()[50], "changed", 1), base + " tail", base.upper(),
             "echo echo " * 60, "same line here\n" * 8 + invented(rng, 30),
             "### $$$ %%% " + invented(rng, 20) + " ||| &&&", "a" * 400, "ab" * 300]
    texts += [invented(rng, rng.randint(3, 60)) + " " + passage + " " + invented(rng, rng.randint(3, 60))
              for _ in range(6)]
    texts += [invented(rng, rng.randint(5, 150)) for _ in range(30)]
    langs = ["en", "de", None]
    sources = ["b", "a", None, "ä", "c"]
    rows = [(n, t, langs[n % 3], sources[n % 5], len(t or "")) for n, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [rows[3], rows[3], (7, "another text under a known number " + passage, "en", "a", 3)]
    rows += [(None, base, "en", "a", 1), (None, invented(rng, 40), None, None, 1)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def crowded(docs):
    """The same with extra columns named like the operators' own outputs."""
    from pyspark.sql import functions as F
    names = ["n_words", "score", "size", "target", "fp", "component_id", "kept", "path", "host", "copies",
             "spans", "block", "label", "rank", "entity", "tier"]
    return docs.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
