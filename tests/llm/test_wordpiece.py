from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from courierlens.llm.queries import vocabulary_file
from courierlens.llm.wordpiece import build_automaton, byte_pieces, count_batch, count_tokens, greedy_length

SINGLE = {bytes([b]) for b in range(256)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=6).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=12), st.text("abc", max_size=30))
def test_lengths_equal_greedy_matching(pieces, word):
    automaton = build_automaton(pieces)
    data = np.frombuffer(word.encode(), np.uint8)
    found = automaton.lengths(data, np.array([0]), np.array([len(data)]), lead=b"")
    assert found.tolist() == [greedy_length(word.encode(), {*pieces, *SINGLE})]


def test_documents(spark, documents):
    texts = [None, "", " \t", "Hello, hello world", "Straße 中文 ñandú", "a" * 5000, "the cat " * 3000, "tie", "tie"]
    pieces = byte_pieces(vocabulary_file())
    known = {*pieces, *SINGLE}
    wanted = []
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        wanted.append((i, len(words), sum(greedy_length(b" " + w, known) for w in words)))
    table = documents([(i, t) for i, t in enumerate(texts)])
    assert sorted(tuple(r) for r in count_tokens(table, pieces).collect()) == wanted
    assert count_tokens(table.limit(0), pieces).count() == 0
    words, _ = count_batch(build_automaton([]), pa.array(["a b", None]))
    assert words.tolist() == [2, 0]


def test_a_long_word_takes_its_length_not_more():
    automaton = build_automaton(byte_pieces(vocabulary_file()))
    rng = np.random.default_rng(6)
    word = rng.integers(33, 127, 1_000_000).astype(np.uint8).tobytes().decode()
    count_batch(automaton, pa.array(["warm " + "x" * 200]))
    before = time.process_time()
    _, tokens = count_batch(automaton, pa.array([word]))
    assert time.process_time() - before < 4
    known = {*byte_pieces(vocabulary_file()), *SINGLE}
    short = word[:600]
    assert count_batch(automaton, pa.array([short]))[1][0] == greedy_length(b" " + short.encode(), known)
    assert tokens[0] > 400_000


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=40), min_size=70, max_size=90))
def test_many_and_few_words_are_read_alike(words):
    pieces = [b"ab", b"abab", b"ba", b"bbb", b"aab"]
    automaton = build_automaton(pieces)
    _, found = count_batch(automaton, pa.array(words))
    assert found.tolist() == [greedy_length(b" " + w.encode(), {*pieces, *SINGLE}) for w in words]
