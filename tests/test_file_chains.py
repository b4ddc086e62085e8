"""Whole jobs from text files to text files, each job reading what the one before wrote."""

import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import cooccurrence, words
from tallyworks.plans import chains
from tallyworks.sinks import tables
from tallyworks.sinks import text as text_sinks
from tallyworks.sources import corpus

ARTICLES = {
    "1.txt": "The war, the world war\nWorld of wars\n",
    "2.txt": "states united\n\nUnited States of states\n",
    "3.txt": "history of the world\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("chain")
    (path / "articles").mkdir()
    for name, text in ARTICLES.items():
        (path / "articles" / name).write_text(text)
    (path / "stop").write_text("the\nof\n")
    return path


def test_top_words_then_pairs_and_stripes(spark, folder):
    lines = corpus.read_corpus_lines(spark, str(folder / "articles"))
    stop = corpus.read_exact_stop_words(spark, str(folder / "stop"))
    top = words.top_words(lines, "line", stop, k=4)
    text_sinks.write_key_value(top, str(folder / "top"), "word", "n")
    assert [tuple(r) for r in top.collect()] == [("states", 3), ("world", 3), ("united", 2), ("war", 2)]

    vocabulary = corpus.read_frequent_words(spark, str(folder / "top"))
    pairs = cooccurrence.cooccurrence_pairs(lines, vocabulary, 2)
    text_sinks.pair_lines(pairs).write.text(str(folder / "pairs"))
    assert sorted(r[0] for r in spark.read.text(str(folder / "pairs")).collect()) == [
        "states,states\t2", "states,united\t2", "united,states\t2", "war,world\t2", "world,war\t2",
    ]
    striped = cooccurrence.stripes(pairs).select("word", text_sinks.map_text(F.col("stripe")).alias("stripe"))
    text_sinks.write_key_value(striped, str(folder / "stripes"), "word", "stripe")
    assert sorted(r[0] for r in spark.read.text(str(folder / "stripes")).collect()) == [
        "states\t{states=2, united=2}", "united\t{states=2}", "war\t{world=2}", "world\t{war=2}",
    ]


def test_document_frequency_then_tf_idf(spark, folder):
    lines = corpus.read_corpus_lines(spark, str(folder / "articles"))
    stop = corpus.read_stop_words(spark, str(folder / "stop"))
    frequencies = words.document_frequency(lines, "line", stop, key="doc_id")
    text_sinks.write_key_value(words.top_terms(frequencies, 3), str(folder / "df"), "term", "df")
    table = corpus.read_document_frequencies(spark, str(folder / "df"))
    assert sorted(tuple(r) for r in table.collect()) == [("histori", 1), ("state", 1), ("world", 2)]

    scores = words.tf_idf(lines, table, n_docs=10, text="line")
    found = {(r["doc_id"], r["term"]): r["tfidf"] for r in scores.collect()}
    assert found == {
        ("1", "world"): pytest.approx(math.log(3)),
        ("2", "state"): pytest.approx(2 * math.log(5)),
        ("3", "histori"): pytest.approx(math.log(5)),
        ("3", "world"): pytest.approx(math.log(3)),
    }


def test_documents_as_folders(spark, tmp_path):
    """One folder and one file a document, whatever its id; no files beside them, which cost more to write than the documents."""
    rows = [("a b", "one"), ("x/y=1", "two"), ("50%", None), ("ü+'\"", "drei"), ("d", "first"), ("d", "second"), (None, "n"), ("", "e")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    path = str(tmp_path / "documents")
    text_sinks.write_documents(docs, path)
    folders = glob.glob(f"{path}/shelf=*/document=*")
    assert corpus.finished(spark, path) == path
    assert len(folders) == 7 and {len(os.listdir(f)) for f in folders} == {1}  # no value and the empty one share a name on two shelves
    found = sorted(tuple(r) for r in corpus.read_document_folders(spark, path).collect())
    nameless = "__HIVE_DEFAULT_PARTITION__"
    assert found == sorted([(doc_id or nameless, text or "") for doc_id, text in rows])
    # the folders are those that Spark makes, but for names that its JVM may not be able to write
    plain = docs.where("doc_id NOT LIKE 'ü%' OR doc_id IS NULL")
    by_spark = str(tmp_path / "by-spark")
    plain.selectExpr("doc_id AS document", "text").write.partitionBy("document").text(by_spark)
    made = {f for f in os.listdir(by_spark) if f.startswith("document=")}
    assert made == {os.path.basename(f) for f in folders if "%C3%BC" not in f}
    with pytest.raises(FileExistsError):
        text_sinks.write_documents(docs, path)


def odd_folders(tmp_path):
    """Folders at several depths, files and folders that readers skip, line ends of every kind, bytes that are no UTF-8."""
    files = {
        "shelf=1/document=a/part-0.txt": b"one\ntwo\r\n\nlast", "shelf=1/document=a/part-1.txt": b"more\n", "shelf=1/document=b/_part-0.txt.7": b"half",
        "shelf=1/document=b/.part-0.txt.crc": b"crc", "shelf=1/document=b/part-0.txt": b"", "shelf=2/deep/document=50%25 a+b/part-0.txt": b"\xef\xbb\xbfmark\n",
        "shelf=2/document=c/part-0.txt": b"\xef\xbb\xbf", "shelf=2/document=d/part-0.txt": b"\n", "document=%C3%BC/part-0.txt": "\u00fc\u2028\x85x\n".encode(),
        "_SUCCESS": b"", "_temporary/document=e/part-0.txt": b"no", "loose.txt": b"no folder\n", "document=f/below/part-0.txt": b"below",
        "shelf=2/document=g/x._COPYING_": b"no", "shelf=2/_x=1/document=h/part-0.txt": b"\xff\xfe",
    }
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def test_tasks_read_folders_as_spark_does(spark, tmp_path):
    path = odd_folders(tmp_path)
    lines = corpus.read_document_folders(spark, path)
    found = lines.selectExpr("doc_id", "cast(line AS binary) AS line").collect()
    expected = corpus._lines_by_spark(spark, [path]).selectExpr("doc_id", "cast(line AS binary) AS line").collect()
    assert sorted((r[0], bytes(r[1])) for r in found) == sorted((r[0], bytes(r[1])) for r in expected)
    assert {r[0] for r in found} == {"a", "50% a+b", "d", "\u00fc", "", "h"} and len(found) == 11
    assert corpus.read_document_folders(spark, f"{path}/shelf=1/document=a").count() == 5


def test_the_driver_holds_no_places_of_documents(spark, tmp_path):
    """A place a document in the plan, as Spark's reader has, fills the driver; the corpus is not taken to be small either."""
    lines = corpus.read_document_folders(spark, odd_folders(tmp_path))
    assert lines.inputFiles() == []
    assert lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 1 << 40


def test_a_store_of_many_files_is_read_in_rounds(spark, tmp_path, monkeypatch):
    path = odd_folders(tmp_path / "corpus")
    lines = corpus._lines_by_spark(spark, [path])
    expected = sorted(tuple(r) for r in lines.collect())
    read, by_one = [], corpus._lines_by_spark
    monkeypatch.setattr(corpus, "_lines_by_spark", lambda s, places: read.append(places) or by_one(s, places))
    monkeypatch.setattr(corpus, "FILES_AT_ONCE", 3)
    # the same folder by a file system that is not called "file"
    store = f"viewfs://corpus{path}"
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.corpus.link./" + path.split("/")[1], f"file:///{path.split('/')[1]}")
    assert sorted(tuple(r) for r in corpus.read_document_folders(spark, store).collect()) == expected
    assert len(read) > 2 and sorted(os.path.basename(p) for places in read for p in places) == [
        "document=%C3%BC", "document=f", "loose.txt", "shelf=1", "shelf=2"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        corpus.read_document_folders(spark, f"{path}/missing")


def test_the_scores_are_made_without_a_list_of_files_in_the_driver(spark, tmp_path, monkeypatch):
    rows = [(1, "war and\nstates war"), (2, "states of"), (3, None), (3, "war"), (None, "states"), (4, "war"), (5, "other"), (6, "x"), (7, "y")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kept, scratch = {}, tables.scratch
    monkeypatch.setattr(tables, "scratch", lambda frame, name: kept.setdefault(name, frame) and scratch(frame, name))
    found = {(r["doc_id"], r["term"]): r["tfidf"] for r in chains.chain_tfidf(spark, str(tmp_path)).collect()}
    assert kept["corpus-lines"].inputFiles() == []
    war, other = math.log(2), math.log(4)  # 8 folders by one more than the lines with the term: 8 // 4 and 8 // 2
    nameless = "__HIVE_DEFAULT_PARTITION__"
    assert {k: v for k, v in found.items() if k[1] in ("war", "other")} == {
        ("1", "war"): pytest.approx(2 * war, abs=1e-6), ("3", "war"): pytest.approx(war, abs=1e-6),
        ("4", "war"): pytest.approx(war, abs=1e-6), ("5", "other"): pytest.approx(other, abs=1e-6)}
    assert {k[0] for k in found if k[1] == "state"} == {"1", "2", nameless}
