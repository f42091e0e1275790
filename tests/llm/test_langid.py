from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from courierlens.llm import langid
from courierlens.llm.langid import (
    Training,
    gradients,
    label_bytes,
    learn_languages,
    pooled,
    predict_batch,
    predict_languages,
    train,
)

QUICK = Training(steps=60, batch=48, texts_per_language=60)
WORDS = {"aa": "tha ing ent ith ous ble".split(), "bb": "che zze gli ione ato ère".split(), "cc": "ung sch öße ich tz".split()}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choices(WORDS[lang], k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return train([(text(rng, lang).encode(), lang) for lang in WORDS for _ in range(40)], QUICK)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    params = {k: v.astype(np.float64) for k, v in langid._start(3, rng).items()}
    x, y = rng.integers(97, 100, (6, 4)), np.array([0, 1, 2, 1])
    found, _ = gradients(params, x, y)
    for name, value in params.items():
        for at in [tuple(rng.integers(0, n) for n in value.shape) for _ in range(4)]:
            if name.endswith("table"):
                at = (at[0], int(x[0, 0]))
            change = np.zeros_like(value)
            change[at] = 1e-3
            up, down = (gradients({**params, name: value + s * change}, x, y)[1] for s in (1, -1))
            assert found[name][at] == pytest.approx((up - down) / 2e-3, abs=2e-4)


def test_held_out_accuracy(model):
    rng = random.Random(2)
    wanted = [rng.choice(sorted(WORDS)) for _ in range(150)]
    best, score = predict_batch(*model, pa.array([text(rng, lang, rng.randint(3, 60)) for lang in wanted]))
    assert np.mean([model[0][b] == w for b, w in zip(best, wanted, strict=True)]) > 0.95
    assert ((score > 0) & (score <= 1)).all()


def test_every_position_is_labelled_and_pooled(model, monkeypatch):
    """Long texts in several passes pool what segments on their own give."""
    _, params = model
    data = np.frombuffer(text(random.Random(3), "bb", 3000).encode(), np.uint8)
    sums = np.zeros(3)
    for a in range(0, len(data), langid.SEGMENT):
        p = label_bytes(params, data[a : a + langid.SEGMENT, None].astype(np.int64), None)
        assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
        sums += p.sum(axis=0)[:, 0]
    assert np.allclose(pooled(params, data, np.array([0, len(data)]))[0], sums, rtol=1e-3)
    monkeypatch.setattr(langid, "PASS_BYTES", 10 * langid.SEGMENT + 5)
    best, score = predict_batch(*model, pa.array([data.tobytes().decode(), "", None]))
    assert best.tolist() == [int(sums.argmax()), -1, -1]
    assert score[0] == pytest.approx(sums.max() / len(data), rel=1e-3)


def test_query_learns_only_from_rows_not_held_out(spark, documents):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(WORDS))
        kept = zlib.crc32(str(i).encode()) % 4 != 2
        rows.append((i, text(rng, lang), lang if kept else "lie"))
    rows += [(1000, None, "aa"), (1001, "12 34 !?", "aa"), (1002, "", None), (None, text(rng, "aa"), "aa"), (3, "tha", None)]
    table = documents([(*r, "src", 0, "clash") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    model = learn_languages(table, QUICK)
    assert model[0] == sorted(WORDS)
    found = predict_languages(table, model).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found if r.doc_id not in (3, None)}
    assert {i: by_id[i].lang_pred for i in (1000, 1001, 1002)} == {1000: "und", 1001: "und", 1002: "und"}
    assert all(by_id[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(300) if i != 3)
    kept = predict_languages(table, model, keep_from=0.2)
    assert kept.columns == table.columns
    assert kept.count() == sum(r.lang_pred != "und" for r in found)


def test_kept_rows_have_any_columns(spark, documents):
    rows = [(i, "tha tha tha", "aa" if i % 2 else "bb", f"own {i}") for i in range(40)]
    table = documents(rows, "doc_id long, text string, lang string, _letters string, letters string, score string")
    kept = predict_languages(table, learn_languages(table, QUICK), keep_from=0.0)
    assert kept.columns == table.columns and {r._letters for r in kept.collect()} == {r[3] for r in rows}


def test_every_language_is_learned_from_a_fair_sample(spark, documents):
    rows = [(i, f"text {'z' if i % 2 else 'a'} {i}", f"l{i % 250}") for i in range(5000)]
    bounds = langid.Training(texts_per_language=5)
    sample = langid.labelled_sample(documents(rows), bounds)
    assert {lang for _, lang in sample} == {f"l{i}" for i in range(250)}
    # not those that come first by their text
    one = langid.labelled_sample(documents([(i, f"{i:04d} x", "l") for i in range(4000)]), langid.Training(texts_per_language=50))
    firsts = [int(text[:4]) for text, _ in one]
    assert len(one) == 50 and 1200 < np.mean(firsts) < 2800


def test_no_rows_and_no_languages(spark, documents):
    table = documents([(1, "abc"), (2, None)])
    assert [r.lang_pred for r in predict_languages(table, learn_languages(table, QUICK)).collect()] == ["und", "und"]
    assert predict_languages(table.limit(0), learn_languages(table.limit(0), QUICK)).count() == 0
