"""Each stage of the pipeline on its own input, and the whole against brute force."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm.common import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        out.append((docs, made))
        docs = made
    return out


def test_columns(stages):
    assert all(made.columns == COLUMNS for _, made in stages[:-1])


def test_language_keeps_what_has_letters(stages):
    docs, made = stages[0]
    assert made.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_lines(stages):
    from test_operators import brute_lines

    docs, made = stages[1]
    want = {i: t for i, t in brute_lines({r.doc_id: r.text for r in docs.collect()}).items() if WORD.search(t)}
    assert {r.doc_id: r.text for r in made.collect()} == want


def test_near_duplicates(stages):
    from test_operators import brute_components

    docs, made = stages[2]
    comps = brute_components({r.doc_id: r.text for r in docs.collect()}, 5, 80, 100)
    assert {r.doc_id for r in made.collect()} == {c for _, c in comps.values()}


def test_mix(stages):
    docs, made = stages[3]
    size = {r.doc_id: len(WORD.findall(r.text)) for r in docs.collect()}
    taken = collections.Counter()
    for r in made.collect():
        taken[r.doc_id] += len(WORD.findall(r.text))
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= 20 and all(n <= 2 * size[i] for i, n in taken.items())


def test_encoding(stages):
    docs, made = stages[4]
    want = collections.Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in made.collect()) == want


def test_run(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).count() == stages[4][1].count()


def test_stages_of_odd_tables(spark, sf_dir):
    """Nulls in any column, empty and repeated rows, clashing columns and an empty table go through every stage."""
    rows = [(1, "the house of the king and the sea near the old town wall", "en", "a", 56), (1, "the house of the king and the sea near the old town wall", "en", "a", 56), (2, None, None, None, None), (3, "", "de", "a", 0), (None, "der König und das Haus über die Straße am alten Wall", None, None, 5), (4, "*" * 2000, "fr", "b", 1), (5, "mot " * 3000, "fr", None, 1)]
    clash = {c: F.lit("x") for c in ("_pred", "_score", "row", "gone", "no", "spans", "n_taken", "first", "component_id", "tie", "size")}
    full = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(clash)
    for docs in (full, full.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            made = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            assert made.columns == full.columns
            docs = made
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_stages_alone_on_odd_rows(spark, sf_dir):
    df = spark.createDataFrame([(1, None, None, None, None), (1, "", None, None, 0), (None, None, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [stage(spark, df, sf_dir).count() for _, stage in corpus_pipeline.STAGES] == [0, 0, 3, 0, 3]


def test_language_is_told_in_small_groups():
    import tracemalloc

    from siltstone.llm.langid import LanguageModel

    model = LanguageModel(["the cat and the dog", "der hund und die katze"] * 3, ["en", "de"] * 3)
    texts = ["the dog and the cat " * 100, "die katze und der hund " * 100] * 250
    want = [model.predict([t]) for t in texts[:2]]
    tracemalloc.start()
    langs, scores = model.predict(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert langs == [w[0][0] for w in want] * 250 and list(scores) == [w[1][0] for w in want] * 250
    assert peak < 40 << 20
