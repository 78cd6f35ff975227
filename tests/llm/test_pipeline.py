"""The pipeline, and the registered queries against SQL or a second look at their rows."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from oracle_check import connect, differences  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
import corpus_pipeline  # noqa: E402
from millwatch.llm import decontamination, ngram_jaccard, sentencepiece_lattice, suffix_dedup  # noqa: E402
from millwatch.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    duck = connect(SF)
    try:
        assert differences(QUERIES[name](spark, SF), duck, ORACLES[name]) == ""
    finally:
        duck.close()


def test_every_operator_is_registered(spark):
    numbers = sorted(int(n.split("_")[0][2:]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_return_every_row(spark, name):
    table = "pages" if "_html_" in name or "_url_" in name else "embeddings" if "_embedding_" in name else "documents"
    each = 16 if table == "embeddings" else 1  # components
    rows = QUERIES[name](spark, SF)
    assert rows.count() == each * spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        docs = out.cache()
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0]
    # What a stage was to remove is not there any more.
    assert ngram_jaccard.link(docs, 5, 80).where("component_id <> doc_id").count() <= 2  # cutting may bring texts closer
    assert suffix_dedup.remove_repeats(docs).agg({"n_removed": "sum"}).first()[0] in (0, None)
    assert decontamination.found_items(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    decoded = sentencepiece_lattice.decode(last).collect()
    assert {r["doc_id"]: r["decoded"] for r in decoded} == texts
    assert all(r["n_pieces"] == len(r["ids"]) for r in decoded)
