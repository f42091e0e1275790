"""The pipeline against stages computed one by one outside it."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

import corpus_pipeline
from courierlens.llm.langid import learn_languages, predict_languages
from courierlens.llm.mixing import mix_sql
from courierlens.llm.queries import vocabulary_file
from courierlens.llm.toxicity import learn_toxicity, score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents in three languages, with copies, toxic ones and junk, and their labels."""
    rng = random.Random(12)
    stems = {"en": "the ing and ous her ent".split(), "fr": "ère que les eau ion tré".split(), "de": "ung sch ich ein öße und".split()}
    rows, labels = [], []
    for i in range(420):
        lang = rng.choice(sorted(stems))
        text = " ".join("".join(rng.choices(stems[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(30, 90)))
        toxic = int(rng.random() < 0.25)
        if toxic:
            text = f"{text} grubling {text.split()[0]}"
        rows.append((i, text, lang, f"src{rng.choice([0, 0, 0, 3, 11, 16])}", len(text)))
        labels.append((i, 1, toxic))
    for i in range(60):
        base = rows[rng.randrange(400)]
        text = base[1] if i % 2 else base[1] + " " + rng.choice(stems["en"])
        rows.append((1000 + i, text, base[2], base[3], len(text)))
    rows += [(2000, None, "en", "src1", 0), (2001, "12 34 !!", "en", "src1", 8), (2002, "", None, None, 0)]
    root = tmp_path_factory.mktemp("corpus")
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def stage(spark, number, docs, folder):
    return corpus_pipeline.STAGES[number][1](spark, docs, folder)


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_every_stage_and_the_whole(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")

    known = predict_languages(docs, learn_languages(docs)).collect()
    first = stage(spark, 0, docs, folder)
    assert ids(first) == {r.doc_id for r in known if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
    assert {2000, 2001, 2002} & ids(first) == set()
    assert len(ids(first)) >= 0.95 * 480
    first.write.parquet(f"{tmp_path}/0")
    first = spark.read.parquet(f"{tmp_path}/0")

    scored = score_toxicity(first, learn_toxicity(first, labels)).collect()
    second = stage(spark, 1, first, folder)
    assert ids(second) == {r.doc_id for r in scored if r.predicted == 0}
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    assert len(ids(second) & toxic) < 0.1 * len(toxic)
    assert len(ids(second) - toxic) > 0.9 * len(ids(first) - toxic - set(range(1000, 1060)))
    second.write.parquet(f"{tmp_path}/1")
    second = spark.read.parquet(f"{tmp_path}/1")

    rows = {r.doc_id: shingles(r.text) for r in second.collect()}
    label = {i: i for i in rows}
    links = [(a, b) for a in rows for b in rows if a < b and 100 * len(rows[a] & rows[b]) >= 75 * len(rows[a] | rows[b])]
    for _ in range(len(rows)):
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    third = stage(spark, 2, second, folder)
    assert ids(third) == {i for i, c in label.items() if i == c}
    assert len(links) > 10
    third.write.parquet(f"{tmp_path}/2")
    third = spark.read.parquet(f"{tmp_path}/2")

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/2/*.parquet'")
    taken = con.execute(mix_sql(corpus_pipeline.PIPELINE_MIX)).fetchall()
    fourth = stage(spark, 3, third, folder)
    assert sorted(r.doc_id for r in fourth.collect()) == sorted(r[0] for r in taken)
    assert len(taken) == len({r[0] for r in taken})
    fourth.write.parquet(f"{tmp_path}/3")
    fourth = spark.read.parquet(f"{tmp_path}/3")

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_file())
    whole = corpus_pipeline.run(spark, folder).collect()
    wanted = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in fourth.collect()}
    lengths = {}
    for r in whole:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == wanted
    for kept in (first, second, third, fourth):
        assert kept.columns == COLUMNS


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for number in range(4):
        docs = stage(spark, number, docs, folder)
        assert docs.columns == COLUMNS
        docs.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.schema(docs.schema).parquet(f"{tmp_path}/{number}")
    assert stage(spark, 4, docs, folder).count() == 0
