"""Brute-force versions and small tables."""

import re

import pyarrow.parquet as pq

WORD = re.compile("[^ \t-\r]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key bigint, t string, own int"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def documents(spark, texts, ids=None):
    """A table with columns that clash with names used inside the operators."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), "r", 1, "x", 2) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def corpus(sf_dir):
    t = pq.read_table(f"{sf_dir}/documents.parquet").to_pandas()
    return dict(zip(t.doc_id.tolist(), t.text.tolist(), strict=True))


LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD_TEXTS = [None, "", " \n\t ", "One", "Same text here, twice.", "Same text here, twice.", "é ü ß 中文 😀  x", LONG, "a\n\nb  c\n"]
ODD_IDS = [None, 5, 5, -1, 7, 7, 1 << 40, 2, None]
