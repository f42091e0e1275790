"""The registered queries over whole small tables: rows, columns, and SQL where there is some."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from compare import connect, differences
from tokenizers import Tokenizer

import __spark_entry__ as contract
from courierlens.llm.encode import encoder
from courierlens.llm.grammar import encode_documents
from courierlens.llm.packing import pack_documents
from courierlens.llm.queries import LLM_EQUIVALENTS, LLM_QUERIES, vocabulary_file

SMALL = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_": ["doc_id", "n_shingles", "component_id"],
    "op3_": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op4_": ["doc_id", "held_out", "score", "predicted"],
    "op5_": ["doc_id"],
    "op6_": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op7_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op8_": ["vec_id", "n_links", "component_id", "kept"],
    "op9_": ["doc_id"],
    "op10_": ["page_id", "host", "path", "rule", "verdict"],
    "op11_": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op12_": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op13_": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}
ROWS = {"op8_": "embeddings", "op10_": "pages", "op12_": "embeddings"}


def rows_of(folder, table):
    return duckdb.sql(f"SELECT count(*) FROM '{folder}/{table}.parquet'").fetchall()[0][0]


def test_one_query_for_each_operator():
    assert sorted(q.split("_")[0] + "_" for q in LLM_QUERIES) == sorted(COLUMNS)
    assert set(LLM_QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(LLM_EQUIVALENTS) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_rows_and_columns(spark, name):
    prefix = name.split("_")[0] + "_"
    found = LLM_QUERIES[name](spark, SMALL)
    assert found.columns[: len(COLUMNS[prefix])] == COLUMNS[prefix]
    if prefix not in ("op5_", "op7_", "op11_"):
        assert found.count() == rows_of(SMALL, ROWS.get(prefix, "documents"))


@pytest.mark.parametrize("name", sorted(LLM_EQUIVALENTS))
def test_query_equals_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, SMALL), connect(SMALL), LLM_EQUIVALENTS[name]) == []


def documents_of(folder):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def test_token_files_equal_the_library(spark):
    library = Tokenizer.from_file(vocabulary_file())
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in LLM_QUERIES["op3_token_files"](spark, SMALL).collect()}
    at = 0
    for doc_id, text in documents_of(SMALL):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert found[doc_id] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_added_tokens_equal_the_library(spark, documents):
    library = Tokenizer.from_file(vocabulary_file())
    rng = random.Random(9)
    parts = ["a", " ", "<|endoftext|>", "<|endof", "text|>", "中", "é", "'s", "\n", "1"]
    texts = ["a <|endoftext|> b", "<|endof", "text|>", *("".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(400))]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[0] == [64, 220, 50256, 275]
    table = documents(list(enumerate(texts))).repartition(3)
    found = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in encode_documents(table, vocabulary_file()).collect()}
    assert found == {i: (len(x) + 1, zlib.crc32(np.array([*x, 2], "<u4").tobytes())) for i, x in enumerate(ids)}
    packed = {r.doc_id: (r.length, r.ids_crc32) for r in pack_documents(table, vocabulary_file()).collect()}
    assert packed == {i: (len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for i, x in enumerate(ids)}


def test_edits_equal_their_definition(spark):
    found = {r.doc_id: r for r in LLM_QUERIES["op6_fingerprints"](spark, SMALL).collect()}
    rows = documents_of(SMALL)
    for i, (doc_id, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        assert found[doc_id].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert found[doc_id].n_chars == len(text)


def test_pieces_of_other_characters_equal_the_library():
    library = Tokenizer.from_file(vocabulary_file())
    library.encode_special_tokens = True
    rng = random.Random(8)
    parts = ["a", "s", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "é", "1", "²", "$", "!!", "\xa0", "\x85", "\x1c",
             "Don't", "''s", " '", "中", "<|endoftext|>", "½", "ǅ", "\r\n", "r", "e", "l"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4000)]
    import pyarrow as pa

    ids, offsets = encoder(vocabulary_file()).encode(pa.array([*texts, None]))
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)] + [[]]
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == wanted
