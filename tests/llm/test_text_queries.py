"""The registered queries over the smallest tables, and the pipeline against a plain version."""

from __future__ import annotations

from collections import Counter

import duckdb
import plain
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from changeloom.llm import byte_bpe, toxicity
from changeloom.llm.queries import ORACLES, QUERIES
from changeloom.llm.tables import remainder, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "substring_dedup", "decontamination", "byte_bpe",
    ]


def test_queries_without_sql(spark):
    rows = table(spark, SF, "documents").collect()
    size = {r.doc_id: len((r.text or "").encode()) for r in rows}
    counted = QUERIES["op8_token_counts"](spark, SF).collect()
    assert {r.doc_id: r.n_bytes for r in counted} == size and all(r.over_limit == (r.n_tokens > 2048) for r in counted)
    coded = QUERIES["op10_byte_bpe"](spark, SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in coded} == {r.doc_id: plain.sha(r.text or "") for r in rows}
    lang = {r.doc_id: r.lang for r in rows}
    found = [r for r in QUERIES["op4_language"](spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in found) >= 0.9 * len(found)
    assert QUERIES["op2_toxicity"](spark, SF).count() == len(rows)


def test_pipeline_against_plain(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    model = toxicity.learn(docs, labels.where(remainder(F.col("doc_id"), 3) != 1))
    reader = toxicity.token_reader()
    rest = []
    for r in docs.orderBy("doc_id").collect():
        ((n, found),) = toxicity.scan([r.text], model.token, model.score, model.drift, reader)
        p = toxicity.chance([s for s, _, _ in found], n, model.decay, model.rate)
        if toxicity.score_of(p, model.cut) < toxicity.TOXIC:
            rest.append((r.doc_id, r.text))
    rest = [(d, t) for (d, t), (_, _, c, _) in zip(rest, plain.jaccard(rest)) if c == d]
    passages = {d: (n, w) for d, _, n, w in plain.dedup(rest)}
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    rest = [(d, passages[d][1] if passages[d][0] else t) for d, t in rest]
    clean = {d for d, _, hit, _ in plain.contaminated(rest, items) if not hit}
    expected = {d: plain.words(t) for d, t in rest if d in clean}

    rows = corpus_pipeline.run(spark, SF).collect()
    codec = byte_bpe.TreeCodec(byte_bpe.read_ranks(byte_bpe.public_tokenizers.path(byte_bpe.VOCABULARY)))
    import numpy as np

    decoded = {r.doc_id: codec.decode(np.frombuffer(r.token_ids, "<u4").tolist()).decode() for r in rows}
    assert {d: plain.words(t) for d, t in decoded.items()} == expected
    assert all(plain.sha(decoded[r.doc_id]) == r.decoded_sha256 and plain.sha(bytes(r.token_ids)) == r.ids_sha256 for r in rows)


def test_stages_with_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, later string, one int"
    odd = [(1, None, None, None, None, "a", "b", 1), (1, None, None, None, None, "a", "b", 1), (2, "", "en", "s", 0, "a", "b", 1)]
    odd += [(3, "few words here", "en", "s", 14, None, None, None)] * 3 + [(None, "no id", None, None, 5, None, None, None)]
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "x y")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == list(corpus_pipeline.COLUMNS)
            found = Counter(r.doc_id for r in out.collect())
            assert set(found) == {r[0] for r in rows}
            if name == "near_duplicates":
                assert not rows or max(found.values()) == 1
        assert corpus_pipeline.encode(spark, docs, sf).count() == len(rows)


def test_near_duplicates_by_row(spark):
    text = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, text[0]), (5, text[0] + " more"), (5, text[1]), (None, text[0]), (None, text[2]), (None, text[2]), (None, text[2] + " end")]
    rows += [(7, text[3]), (7, text[3].replace(" ", "  ")), (None, text[4]), (None, None), (None, None), (None, " ")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], schema)
    found = [(r.doc_id, r.text) for r in corpus_pipeline.remove_near_duplicates(spark, docs.repartition(4), SF).collect()]
    kept = Counter((d, " ".join((t or "").split()).removesuffix(" end")) for d, t in found)
    assert kept == {(1, text[0]): 1, (5, text[1]): 1, (None, text[2]): 1, (7, text[3]): 1, (None, text[4]): 1, (None, ""): 3}


def test_decontamination_stage_by_hits(spark, tmp_path):
    spark.createDataFrame([(None, "x y")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "a x y"), (2, "a b")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(None).cast("string") for c in corpus_pipeline.KEPT})
    assert [r.doc_id for r in corpus_pipeline.remove_contaminated(spark, docs, str(tmp_path)).collect()] == [2]
