"""The corpus pipeline: stages of the training-data operators over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet under the shared storage root and
read again as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from skyledger.llm.langid import floors, keep_identified, learn, train_split, unit_rows
from skyledger.llm.mixing import mixed_documents
from skyledger.llm.packing import pack, tokenizer_file
from skyledger.llm.secret_scan import redact
from skyledger.llm.simhash import one_per_component
from skyledger.session import scratch_path

ORACLE_SQL = None  # random vectors, permutations and tokenizer ids are not SQL


def language_id(spark, docs, sf_dir):
    """Keeps documents written in a language learned from the training split of ``docs``."""
    split = train_split(docs)
    names, sums = learn(split)
    return keep_identified(docs, names, unit_rows(sums), floors(split, names, sums))


def near_duplicates(spark, docs, sf_dir):
    """Keeps one document of each group of SimHash near-duplicates, the one of smallest doc_id."""
    return one_per_component(docs, shingle=4, max_bits=4)


def secret_scan(spark, docs, sf_dir):
    """Keeps every document; secrets in its text are replaced by a mark."""
    return redact(docs)


def source_mixing(spark, docs, sf_dir):
    """Mixes the sources to their target weights; a document may come in part or repeatedly."""
    return mixed_documents(docs)


def packing(spark, docs, sf_dir):
    """Packs the token ids of every mixed document; returns the pieces."""
    return pack(docs, tokenizer_file())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("packing", packing),
]


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.mode("errorifexists").parquet(path)
        docs = spark.read.parquet(path)
    return docs
