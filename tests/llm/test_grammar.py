from __future__ import annotations

import random
import resource
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from courierlens.llm import encode, grammar
from courierlens.llm.blocks import flat
from courierlens.llm.grammar import LEAST, Shard, compress, encode_documents, write_shards
from courierlens.llm.queries import vocabulary_file


def shard_of(documents, **kwargs):
    ids = np.array([i for d in documents for i in d], np.uint32)
    return compress(ids, np.cumsum([0, *map(len, documents)]), **kwargs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=40), max_size=8), st.integers(2, 4))
def test_round_trip(documents, least):
    shard = Shard.unpack(shard_of(documents, least=least, span=0.3).pack())
    assert shard.sizes().tolist() == [len(d) for d in documents]
    for i, d in enumerate(documents):
        assert shard.document(i).tolist() == d


def test_repeats_shrink_and_rules_know_their_length():
    rng = random.Random(2)
    words = [[rng.randrange(50_000) for _ in range(5)] for _ in range(20)]
    documents = [[t for _ in range(60) for t in rng.choice(words)] + [2] for _ in range(30)]
    shard = shard_of(documents)
    assert len(shard.symbols) * 4 < sum(map(len, documents))
    for rule, length in enumerate(shard.lengths):
        assert len(shard.expand(np.array([shard.base + rule]))) == length
    assert all(shard.document(i).tolist() == d for i, d in enumerate(documents))


def commonest(shard):
    """Occurrences of the commonest neighbouring pair within documents."""
    runs = [shard.symbols[a:b].tolist() for a, b in zip(shard.starts[:-1], shard.starts[1:], strict=True)]
    return max(Counter(p for run in runs for p in zip(run, run[1:], strict=False)).values(), default=0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=60), max_size=8), st.integers(2, 5), st.sampled_from([0.005, 0.5]))
def test_no_frequent_pair_is_left(documents, least, span):
    assert commonest(shard_of(documents, least=least, span=span)) < least


def test_no_frequent_pair_is_left_in_many_ids():
    rng = np.random.default_rng(5)
    words = [rng.zipf(1.3, 12) % 3000 for _ in range(300)]
    documents = [np.concatenate([words[i] for i in rng.integers(0, 300, 40)]).tolist() for _ in range(120)]
    shard = shard_of(documents)
    assert commonest(shard) < LEAST and shard.lengths.max() > 8
    assert all(shard.document(i).tolist() == d for i, d in enumerate(documents))


def test_rules_of_copies_grow_as_long_as_the_copies():
    text = list(range(1000))
    shard = shard_of([text] * 9)
    assert shard.lengths.max() == 1000 and len(shard.symbols) == 9
    assert shard.document(4).tolist() == text


def test_rules_that_are_not_written_out_decode_alike(monkeypatch):
    documents = [[1, 2, 3, 1, 2, 3] * 50, [], [2]]
    shard = shard_of(documents)
    monkeypatch.setattr(grammar, "WRITTEN_OUT", 1)
    assert [shard.document(i).tolist() for i in range(3)] == documents


def test_long_runs_of_one_id():
    documents = [[7] * n for n in (1, 2, 3, 1000, 4097)] + [[]]
    shard = shard_of(documents)
    assert [shard.document(i).tolist() for i in range(6)] == documents
    assert len(shard.symbols) < 1500


TEXTS = [None, "", " ", "a b a b a b", "中文 text's", "word " * 3000] + [f"a {i} tie" for i in range(60)]


def test_files_hold_every_document(spark, documents):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(6, " "), (None, "lost id"), (9, "another nine")]
    random.Random(1).shuffle(rows)
    path = vocabulary_file()
    found = encode_documents(documents(rows).repartition(4), path).collect()
    library = Tokenizer.from_file(path)
    assert len(found) == len(rows)
    ordered = sorted(found, key=lambda r: r.start)
    keys = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert keys == sorted(keys)
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    whole = sorted((-1 if i is None else i, ids_of(library, t)) for i, t in rows)
    assert sorted((k, (r.n_tokens, r.ids_crc32)) for k, r in zip(keys, ordered, strict=True)) == whole


def ids_of(library, text):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
    return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


def test_small_shards_and_empty_table(spark, documents, tmp_path):
    table = documents([(i, t) for i, t in enumerate(TEXTS)])
    folder = str(tmp_path / "ids")
    write_shards(table, vocabulary_file(), folder, shard_ids=50)
    shards = spark.read.parquet(folder).collect()
    assert len(shards) > 3
    assert sum(s.documents for s in shards) == len(TEXTS)
    assert all(s.ids <= 50 or s.documents == 1 for s in shards)
    assert encode_documents(table.limit(0), vocabulary_file()).count() == 0


def test_freed_memory_goes_back_before_the_next_batch():
    def held() -> int:
        return int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize() >> 20

    # small arrays lie in the heap; the last one keeps what is below it from going back by itself
    arrays = [np.ones(8_000) for _ in range(4_000)]
    last = arrays.pop()
    arrays.clear()
    before = held()
    flat(pa.array(["a"]))
    assert held() < before - 150 and last[0] == 1


def test_known_pieces_are_found_without_sorting(monkeypatch):
    rng = random.Random(8)
    parts = ["a", "b", "'s", "'ll", " ", "  ", "\n", "\u0085", "\u00a0", "\u00e9", "\u00b2", "7", "zz", "\u65e5", "\u0416", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(400)] + [None, "", "'"]
    own = encode.Encoder(vocabulary_file(), added=True)
    wanted = [i for t in texts for i in own.whole.encode(t or "", add_special_tokens=False).ids]
    first, bounds = own.encode(pa.array(texts))
    assert first.tolist() == wanted and bounds[-1] == len(wanted)
    unique = np.unique
    with monkeypatch.context() as patch:
        patch.setattr(encode.np, "unique", lambda x, **k: pytest.fail("sorted") if k else unique(x))
        assert own.encode(pa.array(texts))[0].tolist() == wanted
    # pieces that share a place, and a worker that keeps few pieces
    for name, value in (("PLACES", 16), ("KEEP", 100)):
        monkeypatch.setattr(encode, name, value)
        few = encode.Encoder(vocabulary_file(), added=True)
        found = [few.encode(pa.array(texts[a : a + 20]))[0].tolist() for a in range(0, len(texts), 20)]
        assert [i for part in found for i in part] == wanted
