import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import ngrams, shared
from tallyworks.operators.filters import bloom_filter, may_hold


def test_texts_are_sent_in_small_batches_and_the_setting_comes_back(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    rows = spark.range(0, 5_000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with shared.small_batches(spark):
        sent = shared.written(rows.mapInArrow(sizes, "n long, size long"), "sent").collect()
    assert sum(r["n"] for r in sent) == 5_000
    assert max(r["n"] for r in sent) <= shared.ROWS_SENT and max(r["size"] for r in sent) <= 2 * shared.BYTES_SENT
    assert spark.conf.get(name) == before
    with pytest.raises(KeyError), shared.small_batches(spark):
        raise KeyError
    assert spark.conf.get(name) == before


def test_the_join_reads_texts_in_small_batches(spark, monkeypatch):
    seen = []

    def written(frame, name):
        seen.append((name, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))))
        return shared.written(frame, name)

    monkeypatch.setattr(ngrams, "written", written)
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, "other words here"), (4, None)], "doc_id long, text string"
    )
    got = {r["doc_id"]: r["component_id"] for r in ngrams.similar_groups(docs, 3, 90).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    reading = [rows for name, rows in seen if name in ("ngram-prefixes", "ngram-sets", "ngram-links")]
    assert reading and max(reading) <= shared.ROWS_SENT


def test_the_join_leaves_only_tables_that_its_result_reads(spark, monkeypatch):
    made = {}

    def written(frame, name):
        table = shared.written(frame, name)
        made.setdefault(name, []).append(table.written_at)
        return table

    monkeypatch.setattr(ngrams, "written", written)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(words[:60 - i % 3])) for i in range(9)], "doc_id long, text string")
    result = ngrams.similar_groups(docs, 3, 80)
    left = {name for name, paths in made.items() for path in paths if os.path.exists(path.removeprefix("file:"))}
    assert left == {"ngram-prefixes"}
    assert {r["component_id"] for r in result.collect()} == {0}


def test_a_pair_is_named_in_the_first_entry_that_both_sets_share():
    """Three sets of different components, the first two in the entries 5 and 9, all in 9; each entry is a task of its own."""
    parity = bytes(32)

    def named(entry, ids, few):
        n = len(ids)
        batch = pa.RecordBatch.from_pydict({
            "entry": [entry] * n, "left": [0] * n, "right": [0] * n, "is_left": [True] * n, "blocks": [1] * n,
            "doc_id": ids, "component": ids, "n": [50] * n, "parity": [parity] * n, "few": few,
        })
        return [pair for out in ngrams._across(90)(iter([batch])) for pair in zip(*(c.to_pylist() for c in out.columns))]

    assert named(5, [1, 2], [[5, 9], [5, 9]]) == [(1, 2)]
    assert named(9, [1, 2, 3], [[5, 9], [5, 9], [9]]) == [(1, 3), (2, 3)]
    # the entry is not among the first ones of a set: named again, never lost
    assert named(9, [1, 2], [[5, 9], [1, 2]]) == [(1, 2)]


def test_the_main_component_is_not_repeated_for_each_block(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "BLOCK", 10)
    rows = [(7, i, 50, 20, 0 if i < 196 else i, 0, 4) for i in range(200)]
    apart = spark.createDataFrame(rows, "entry long, doc_id long, n long, blocks int, component long, main long, apart long")
    dealt = ngrams._dealt(apart, (F.col("doc_id") % F.col("blocks")).cast("int")).collect()
    assert len(dealt) == 200 + 4 * 20     # 4,000 when every row goes to every block
    left, right = {}, {}
    for r in dealt:
        (left if r["is_left"] else right).setdefault((r["left"], r["right"]), set()).add(r["doc_id"])
    met = {(min(a, b), max(a, b)) for k in left for a in left[k] for b in right.get(k, ())}
    assert {(a, b) for b in range(196, 200) for a in range(b)} <= met


def test_sets_of_similar_size_share_a_class(spark):
    for percent in (50, 80, 90, 99, 100):
        sizes = spark.range(1, 400).select(F.col("id").alias("n"))
        pairs = sizes.crossJoin(sizes.select(F.col("n").alias("m"))).where(f"n <= m AND 100 * n >= {percent} * m")
        entries = sizes.select(F.col("n").alias("doc_id"), "n", F.lit(5).cast("long").alias("entry"))
        classes = ngrams._by_size(entries, percent).groupBy("n").agg(F.collect_set("entry").alias("e"))
        joined = pairs.join(classes, "n").join(classes.select(F.col("n").alias("m"), F.col("e").alias("f")), "m")
        assert joined.where(~F.arrays_overlap("e", "f")).isEmpty()
        assert joined.count() == pairs.count()
    far = ngrams._by_size(spark.createDataFrame([(1, 100, 5), (2, 200, 5)], "doc_id long, n long, entry long"), 90)
    assert far.select("entry").distinct().count() == 4


def test_texts_in_no_pair_are_dropped_before_the_join(spark):
    held = spark.range(1000).select((F.col("id") * 7919).alias("x"))
    bits = 1 << 14
    words = bloom_filter(held, "x", bits)
    assert held.where(may_hold(words, F.col("x"), bits)).count() == 1000
    assert spark.range(10**9, 10**9 + 10_000).where(may_hold(words, F.col("id"), bits)).count() < 1000
