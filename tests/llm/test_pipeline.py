from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import pytest
from tables import documents

import corpus_pipeline
from huntlake.llm import language, packing, tokens
from huntlake.llm.common import ARROW_ROWS, SENT, saved


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    items = [(1, "one two three four five six seven eight nine ten"), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def test_near_copies_leave_one(spark, folder):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "A B c d e f"), (4, "quite another text than that"), (None, "a b c d e f"), (5, None), (6, "")]
    docs = documents(spark, rows)
    kept = stage("simhash_dedup")(spark, docs, folder)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5]


def test_passages_go_and_other_texts_stay_as_they_are(spark, folder):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"x  {passage}"), (2, f"own {passage} words"), (3, passage), (4, " spaces \n stay "), (5, None), (None, passage)]
    docs = documents(spark, rows)
    got = stage("substring_dedup")(spark, docs, folder)
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(
        [(1, f"x  {passage}"), (2, "own words"), (4, " spaces \n stay "), (5, None), (None, passage)], key=str
    )


@pytest.mark.parametrize("name, passes", [("language_id", 0), ("simhash_dedup", 0), ("substring_dedup", 1)])
def test_rows_that_stay_do_not_go_through_python(spark, sf_dir, folder, plan, name, passes):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(stage(name)(spark, docs, folder)).split("Initial Plan")[-1]
    assert "ArrowEvalPython" in text and text.count("MapInArrow") == passes


def test_texts_are_sent_to_python_in_small_batches(spark, folder, settings):
    sizes = spark.sparkContext.accumulator(0)
    before = spark.conf.get(ARROW_ROWS)

    def seen(batches):
        for batch in batches:
            sizes.add(batch.num_rows > SENT)
            yield batch

    held = saved(spark.range(3 * SENT, numPartitions=1).mapInArrow(seen, "id long"), "batches", small=True)
    assert held.count() == 3 * SENT and sizes.value == 0 and spark.conf.get(ARROW_ROWS) == before


@pytest.mark.parametrize("name", ["language_id", "packing"])
def test_a_stage_sends_few_texts_at_once(spark, folder, plan, monkeypatch, name):
    asked, large = (spark.sparkContext.accumulator(0) for _ in range(2))
    for module in (language, packing):

        def watched(make, *rows, real=module.per_batch):
            def seen(batches):
                for batch in batches:
                    asked.add("text" in batch.schema.names)
                    large.add("text" in batch.schema.names and batch.num_rows > SENT)
                    yield batch

            return lambda batches: real(make, *rows)(seen(batches))

        monkeypatch.setattr(module, "per_batch", watched)
    rows = [(i, f"some words of text {i}" if i % 7 else "12", "en") for i in range(3 * SENT)]
    docs = documents(spark, rows).coalesce(1)
    got = stage(name)(spark, docs, folder)
    assert got.count() == sum(1 for i, *_ in rows if i % 7 or name == "packing")
    assert asked.value > 0 and large.value == 0
    # what is planned for the caller sends hashes
    assert all("(xxhash64(" in line for line in plan(got).splitlines() if "ArrowEvalPython" in line)


def test_benchmark_items_go(spark, folder):
    rows = [(1, "so ONE two three four five six seven eight nine ten"), (2, "one two three four other words here"), (3, None), (4, "")]
    kept = stage("decontamination")(spark, documents(spark, rows), folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4] and kept.columns == documents(spark, []).columns


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, folder, name):
    assert stage(name)(spark, documents(spark, []), folder).collect() == []


def test_pipeline_over_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    held = Counter()
    for row in got:
        held[row["doc_id"]] += row["length"]
    assert 0.5 * len(texts) < len(held) < len(texts)
    whole = [i for i in held if held[i] == len(tokens.ids_of(texts[i])) // 4 + 1]
    assert len(whole) > 0.5 * len(held)  # the others lost a passage
    assert all(held[row["doc_id"]] == row["doc_tokens"] for row in got)


def test_the_entry_stands_without_the_package(monkeypatch):
    import importlib.util

    for name in [name for name in sys.modules if name.startswith("huntlake.llm") or name == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "huntlake.llm" or name == "corpus_pipeline":
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    path = Path(__file__).resolve().parents[2] / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("entry_alone", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert "pipeline" not in module.queries() and not any(name.startswith("op") for name in module.queries())
