"""The pipeline, stage by stage and as a whole, and the registered queries."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import __spark_entry__ as entry
from clicktally.llm import quality
from tests.llm.helpers import HARD_TEXTS, changed, documents, sentence
from tests.llm.test_documents import leaks, linked_components
from tests.llm.test_scans import base_spans
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL).cache()
        assert at == 4 or out.columns == docs.columns
        after = {r.doc_id: r for r in out.collect()}
        assert len(after) == out.count()
        if at == 0:
            measured = quality.statistics(docs)
            scores = quality.score(measured, quality.fit(measured, spark.read.parquet(f"{SMALL}/labels.parquet")))
            assert set(after) == {r.doc_id for r in scores.collect() if r.predicted}
        elif at == 1:
            classes = linked_components(list(before.items()))
            assert set(after) == set(classes.values())
        elif at == 4:
            assert set(after) == set(before) and all(r.release <= r.slot < r.deadline for r in after.values())
            break
        else:
            assert set(after) == set(before)
            assert not any(leaks(r.text, items)[1] if at == 2 else base_spans(r.text) for r in after.values())
            was = leaks if at == 2 else (lambda t, _: (0, len(base_spans(t))))
            assert all(r.text == before[d] for d, r in after.items() if not was(before[d], items)[1])
            assert all(r.n_chars == len(r.text) for r in after.values())
        before, docs = {d: r.text for d, r in after.items()}, out


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)


def test_what_the_stages_do_to_texts_is_in_the_result(spark, tmp_path, monkeypatch):
    """A passage cut out and a secret replaced show in the last stage's rows, repeated ids and odd names too."""
    passage = " ".join(f"benchmark{i}" for i in range(12))
    texts = [(1, f"before {passage} after"), (1, "password = abcdef123456 here"), (2, None), (None, "no id"), (None, "none")]
    docs = documents(spark, texts, extra=True).selectExpr("*", "'y' AS slot", "'z' AS `odd d`")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([("i", passage)], "item_id string, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[1:])  # no labels to learn from
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[:7] == ["doc_id", "source", "block", "place", "release", "deadline", "slot"]
    assert set(out.columns[7:]) == set(docs.columns) - {"doc_id", "source", "slot"} | {"given_slot"}
    rows = out.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "2", "None", "None"]
    text = " ".join(r.text for r in rows if r.doc_id == 1)
    assert all(w in text for w in ("before", "after", "here")) and "benchmark" not in text and "abcdef123456" not in text
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    assert all((r.given_slot, r["odd d"], r.rank) == ("y", "z", "x") for r in rows)


def test_hard_rows_pass_all_stages(spark):
    texts = [*HARD_TEXTS, (3, "one"), (3, "one"), (None, "no id"), (None, None)]
    for docs in (documents(spark, texts, extra=True), documents(spark, [], extra=True)):
        for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL)
            assert at == 4 or out.columns == docs.columns
            ids = sorted(str(r.doc_id) for r in out.collect())
            given = sorted(str(r.doc_id) for r in docs.collect())
            if at == 0:  # scored like any other
                measured = quality.statistics(docs)
                model = quality.fit(measured, spark.read.parquet(f"{SMALL}/labels.parquet"))
                assert ids == sorted(str(r.doc_id) for r in quality.score(measured, model).collect() if r.predicted)
            elif at == 1:  # 'one' is there three times, of which two have the same id; so are 7 and 8
                gone = ["3", "3", "8"] if given else []
                assert ids == sorted(given) if not given else sorted([*ids, *gone]) == given
            else:
                assert ids == given


def test_duplicates_of_ids_and_texts(spark):
    text = "a b c d e f g h i j"
    rows = [(4, text), (4, "another text of this id"), (9, text), (5, None), (6, None), (None, text), (None, text)]
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), SMALL).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == [("4", text), ("4", "another text of this id"), ("None", text), ("None", text)]
    assert sorted(r.doc_id for r in kept if not r.text) == [5, 6]


def test_a_row_goes_only_if_a_similar_one_stays(spark):
    """Ids with several texts, against all pairs; twice, in other partitions, with the same result."""
    rng = random.Random(21)
    bases = [sentence(rng, rng.randrange(5, 60), 10**6) for _ in range(12)]
    rows = [(rng.randrange(30), changed(rng, rng.choice(bases), rng.randrange(2))) for _ in range(90)]
    rows += [(i, b) for i, b in enumerate(bases)] + rows[:10]
    distinct = sorted(set(rows), key=lambda r: (r[0], hashlib.sha256(r[1].encode()).hexdigest()))
    several = {d for d, _ in rows if sum(x == d for x, _ in rows) > 1}
    classes = linked_components([(i, text) for i, (_, text) in enumerate(distinct)])
    want = sorted(distinct[i] for i in set(classes.values()))
    assert len(several) > 10 and len(want) < len(distinct)
    for parts in (3, 7):
        docs = documents(spark, rows, extra=True).repartition(parts)
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == want


def test_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_queries_equal_their_sql(spark):
    duck = connect(SMALL)
    for name in entry.oracle_sql():
        if name.startswith("op"):
            assert compare(spark, duck, name, SMALL) > 0
