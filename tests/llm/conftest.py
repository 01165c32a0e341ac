import re
from collections import Counter

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _text string, _row string, version string, "
    "n_lines string, shard string, kept string, sequence_id string"
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those of the operators."""
    def make(pairs, lang="en"):
        rows = [(i, t, lang, "s", None, "x", "y", "z", "a", "b", "c", "d") for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)
    return make


@pytest.fixture(scope="session")
def corpus(spark):
    """The smallest documents table: pairs."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path


def word_list(text):
    return WORD.findall(text or "")


def multiset(items):
    return Counter(items)
