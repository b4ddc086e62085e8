"""Vectors, token ids, mixtures, notices, the classifier and the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import tiktoken
from compare import connect, difference, type_difference
from pyspark.sql import functions as F

import corpus_pipeline
from tallyworks.llm import bpe, catalogue, collisions, licences, mixing, pivots, quality
from tallyworks.llm.shared import components

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, n long, points long, component string"


# --- components ---------------------------------------------------------------------------------

def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(61))
    assert all(found[i] == 100 for i in range(100, 140))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- vectors --------------------------------------------------------------------------------------

def vectors(seed, count):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < count:
        center = rng.normal(size=16)
        label = int(rng.integers(0, 3))
        for _ in range(int(rng.choice([1, 1, 4, 25]))):
            rows.append(((center + rng.normal(size=16) * 0.08).astype(np.float32).tolist(), label))
    rows = [(3 * i, v, label, 1, 2, "x") for i, (v, label) in enumerate(rows[:count])]
    copy = rows[0][1]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, copy, copy]
    rows += [(10_000 + i, v, rows[0][2], 1, 2, "x") for i, v in enumerate(odd)]
    return rows + [(20_000, copy, None, 1, 2, "x"), (20_001, [1.0, 2.0], 0, 1, 2, "x"), (20_100, copy[:8], 1, 1, 2, "x")]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("block", [2048, 8])
def test_near_duplicate_vectors(spark, block):
    rows = vectors(1, 300)
    found = {
        r[0]: tuple(r)[1:4]
        for r in pivots.near_duplicates(spark.createDataFrame(rows, VECTORS).repartition(4), block=block).collect()
    }
    links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            if not usable(a[1]) or not usable(b[1]) or a[2] is None or a[2] != b[2] or len(a[1]) != len(b[1]):
                continue
            x, y = np.array(a[1]), np.array(b[1])
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links[a[0]] += 1
                links[b[0]] += 1
                p, q = find(a[0]), find(b[0])
                parent[max(p, q)] = min(p, q)
    wanted = sum(links.values())
    assert wanted > 500
    assert set(found) == set(links)
    # nothing that is not linked, and nearly everything that is
    assert all(found[i][0] <= links[i] for i in links)
    assert sum(v[0] for v in found.values()) >= 0.97 * wanted
    assert all(v[2] == (i == v[1]) for i, v in found.items())
    assert sum(found[i][1] == find(i) for i in links) >= 0.97 * len(links)


def test_nearest_neighbours(spark):
    rows = vectors(2, 600)
    got = collisions.nearest_neighbours(
        spark.createDataFrame(rows, VECTORS).repartition(4), "vec_id % 15 = 0", query_block=16, rows_block=200
    ).collect()
    by_id = {r[0]: np.array(r[1], dtype=float) for r in rows if usable(r[1])}
    hit = total = 0
    for query in [i for i in by_id if i % 15 == 0]:
        own = sorted((float(np.sqrt(((v - by_id[query]) ** 2).sum())), i) for i, v in by_id.items()
                     if i != query and len(v) == len(by_id[query]))[:10]
        found = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query)
        assert [f[0] for f in found] == list(range(1, len(own) + 1))
        assert [(f[2], f[1]) for f in found] == sorted((f[2], f[1]) for f in found)
        for _, i, score in found:
            assert abs(score - np.sqrt(((by_id[i] - by_id[query]) ** 2).sum())) < 1e-9
        hit, total = hit + len({f[1] for f in found} & {i for _, i in own}), total + len(own)
    assert total > 300 and hit >= 0.9 * total


def test_empty_vector_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert pivots.near_duplicates(empty).count() == 0
    assert collisions.nearest_neighbours(empty, "vec_id % 100 = 0").count() == 0
    odd = spark.createDataFrame([r for r in vectors(1, 1) if not usable(r[1])], VECTORS)
    assert {tuple(r)[1:] for r in pivots.near_duplicates(odd).select("vec_id", "n_links", "kept").collect()} == {(0, True)}


# --- token ids --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def reference():
    path, pattern = bpe.default_vocabulary()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def odd_texts():
    rng = random.Random(4)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "日", "😀", "0", "12", "!", "...", "'s", "'re", "Z", "\r", "\x1c", "\x85",
             "​", "　", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 60))) for _ in range(800)]
    return texts + ["", "a" * 5000, "ab" * 3000, " " * 900, "x " * 5000]


def test_ids_are_those_of_the_library(spark, reference):
    path, pattern = bpe.default_vocabulary()
    rows = [(i, t, "other") for i, t in enumerate(odd_texts())] + [(99_999, None, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens string").repartition(3)
    got = {r[0]: r[1] for r in bpe.encode_documents(docs, path, pattern).collect()}
    digests = {r[0]: tuple(r)[1:] for r in bpe.round_trip_digests(docs, path, pattern).collect()}
    for i, text, _ in rows:
        ids = reference.encode_ordinary(text or "")
        assert got[i] == ids, text
        assert digests[i] == (
            len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        )


def test_forgetting_states_changes_nothing(reference):
    path, pattern = bpe.default_vocabulary()
    ranks = bpe.read_ranks(path)
    small, codec = bpe.Transducer(ranks, max_states=20), bpe.Codec(ranks, pattern)
    for text in odd_texts()[800:900]:
        own = np.frombuffer(small.encode(text.encode()), dtype="<u4").tolist()
        assert own == reference.encode_ordinary(text)
    codec.alone = False  # by the pattern alone
    for text in odd_texts()[:200]:
        assert np.frombuffer(b"".join(codec.encode(text)), dtype="<u4").tolist() == reference.encode_ordinary(text)


def test_text_comes_out_whole_however_bytes_are_cut():
    data = "aé日😀b".encode() * 3
    for step in (1, 2, 3, 5):
        stream = bpe.Utf8Stream()
        parts = [stream.feed(data[i:i + step]) for i in range(0, len(data), step)] + [stream.feed(b"", last=True)]
        assert "".join(parts) == "aé日😀b" * 3
    stream = bpe.Utf8Stream()
    assert stream.feed(b"a\xe6\x97") + stream.feed(b"", last=True) == "a�"


# --- mixtures -----------------------------------------------------------------------------------------

def shared(budget, children):
    """Water level by bisection: each child gets its weight times a rate, up to its capacity."""
    if sum(c for c, _ in children) <= budget:
        return [c for c, _ in children]
    low, high = 0.0, 1e12
    for _ in range(200):
        rate = (low + high) / 2
        low, high = (rate, high) if sum(min(c, w * rate) for c, w in children) < budget else (low, rate)
    return [min(c, w * low) for c, w in children]


def test_budgets_go_to_siblings_before_ancestors(spark):
    rng = random.Random(3)
    leaves = [(d, x, s, rng.choice([0, 1, 50, 1000, 30000])) for d in "ab" for x in ("en", "de", "fr") for s in "stuv"]
    weights = {"domain": {"a": 3.0}, "lang": {"en": 4.0}, "source": {"s": 2.0, "t": 0.5}}
    epochs, share = 2, 0.7
    found = {
        tuple(r)[:3]: r["target"] for r in mixing.budgets(
            spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long"), weights, share, epochs
        ).collect()
    }
    tree = {}
    for *path, tokens in leaves:
        if tokens:
            tree[tuple(path)] = tokens * epochs
    budget = {(): float(int(sum(tree.values()) / epochs * share + 1e-9))}
    for depth, level in enumerate(mixing.LEVELS):
        for parent in [p for p in budget if len(p) == depth]:
            names = sorted({p[depth] for p in tree if p[:depth] == parent})
            children = [
                (sum(v for p, v in tree.items() if p[:depth + 1] == (*parent, n)), weights[level].get(n, 1.0)) for n in names
            ]
            for n, part in zip(names, shared(budget[parent], children)):
                budget[(*parent, n)] = part
    assert set(found) == set(tree)
    assert all(abs(found[p] - budget[p]) <= 1 for p in tree)


def test_mixture_takes_prefixes_of_epochs(spark):
    rng = random.Random(3)
    rows = [(i, "d", "en", rng.choice("sst"), rng.randint(0, 40)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, tokens long")
    many = mixing.mix(docs, slices=16).collect()
    assert sorted(many) == sorted(mixing.mix(docs.repartition(5), slices=16).collect())
    for source in "st":
        target = {r["source"]: r["target"] for r in mixing.budgets(
            docs.groupBy("domain", "lang", "source").agg(F.sum("tokens").alias("tokens"))).collect()}[source]
        used = sum(r["tokens"] * r["times"] for r in many if r["source"] == source)
        assert target - 40 <= used <= target
    assert mixing.mix(docs.limit(0)).count() == 0
    assert all(r["tokens"] for r in many)


# --- notices and queries with SQL ----------------------------------------------------------------------

def test_notices(spark):
    rows = [
        (1, "prose and\nReleased under the MIT License!\nmore"), (2, None), (3, ""), (4, "the"), (5, "mit license released"),
        (6, "  licensed UNDER the apache license version 2.0"), (7, licences.TEMPLATES["MIT"][1].replace(" ", "\n", 9)),
        (8, "Released under the MIT License.\nReleased under the MIT License."), (9, "x " * 5000), (10, "-- !! --"),
    ]
    got = licences.scan(spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, licence string"))
    found = sorted((r[0], r[1], r[2]) for r in got.collect())
    assert found == [
        (1, 2, "MIT"), (6, 1, "Apache-2.0"), (7, 0, "MIT"), (7, 10, "MIT"),
        (8, 0, "MIT"), (8, 1, "MIT"), (8, 2, "MIT"),
    ]
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, name):
    connection, sql = connect(SMALL), catalogue.oracle_sql()[name]
    got = catalogue.queries()[name](spark, SMALL)
    assert type_difference(got, connection, sql) is None
    assert difference(got, connection, sql) is None


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in catalogue.queries()} == {f"op{i}" for i in range(1, 11)}


# --- quality -----------------------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in quality.op9_quality(spark, folder).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(labels[i], r["predicted"]) for i, r in got.items() if r["held_out"] and i in labels]
    assert len(judged) > 50
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_scores_without_labels_or_texts(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a b", "x"), (4, "a b", "x")], "doc_id long, text string, features string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r[0]: r["score"] for r in quality.scored(docs, labels).collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 0.5, 4: 0.5}
    assert quality.scored(docs.limit(0), labels).count() == 0


def test_interactions_are_learnt():
    rng = np.random.default_rng(0)
    values = rng.random((4000, len(quality.FEATURES)))
    labels = ((values[:, 0] > 0.5) ^ (values[:, 1] > 0.5)).astype(float)  # no single feature tells
    model = quality.AdditiveModel.fit(values[:3000], labels[:3000])
    assert ((model.score(values[3000:]) > 0.5) == labels[3000:]).mean() > 0.85


# --- pipeline ----------------------------------------------------------------------------------------

def test_pipeline(spark, reference):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), "test-stage")
        seen.append(docs.count())
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert 0 < seen[1] <= seen[0] <= 200 and seen[2] == seen[1] and seen[3] == seen[4] > 0
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_pipeline_on_odd_rows(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    rows = [(1, None, None, None, None), (2, "", "en", "src0", 0), (3, "one", "en", "src1", 3), (4, "one", "en", "src1", 3)]
    for own in (rows, []):
        docs = spark.createDataFrame(own, "doc_id long, text string, lang string, source string, n_chars long")
        docs = docs.select(*[F.col(c).cast(kinds[c]) for c in schema.names])
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, SMALL), "odd-stage")
        assert docs.count() <= len(own) * mixing.EPOCHS


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_redact_with_null_and_repeated_ids(spark):
    texts = [(None, "to a@b.co now"), (None, None), (5, "to a@b.co now"), (5, "to a@b.co now"), (5, "plain")]
    docs = spark.createDataFrame([(i, t, "en", "src1", 0) for i, t in texts], COLUMNS)
    got = corpus_pipeline.replace_personal_data(spark, docs, SMALL).select("doc_id", "text").collect()
    expected = [(None, "to [email] now"), (None, None), (5, "to [email] now"), (5, "to [email] now"), (5, "plain")]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_near_copies_with_null_and_repeated_ids(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    texts = [(7, one), (7, one), (None, one), (3, two), (3, three), (None, two), (None, three + " more"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "src1", 0) for i, t in texts], COLUMNS).repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, SMALL).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(7, one), (3, two), (3, three), (None, None)], key=str)


@pytest.mark.parametrize("ids", [[None] * 10, [5] * 10])
def test_mixture_with_null_and_repeated_ids(spark, ids):
    """Of ten rows of one word, 60 per cent are used, each once."""
    docs = spark.createDataFrame([(i, f"w{n}", "en", "src1", 2) for n, i in enumerate(ids)], COLUMNS)
    got = corpus_pipeline.mix_sources(spark, docs, SMALL).collect()
    assert len(got) == len(set(got)) == 6 and set(got) <= set(docs.collect())


def test_mixture_of_rows_is_the_mixture_of_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    times = {r["doc_id"]: r["times"] for r in mixing.mix(mixing.with_leaf(docs, mixing.words("text"))).collect()}
    got = Counter(r["doc_id"] for r in mixing.choose(docs, mixing.words("text")).select("doc_id").collect())
    assert got == times and len(got) > 10


def test_mixture_shuffles_no_text(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = mixing.choose(docs, mixing.words("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_equal_rows_are_used_together(spark):
    docs = spark.createDataFrame([(i // 2, "one two", "en", "src1", 7) for i in range(10)], COLUMNS)
    got = Counter(r["doc_id"] for r in mixing.choose(docs, mixing.words("text")).collect())
    assert len(got) == 3 and set(got.values()) == {2}


def test_stages_keep_columns_with_names_of_helpers(spark):
    names = ["_row", "number", "row", "_spans", "domain", "tokens", "_order", "component_id"]
    text = " ".join(f"w{i}" for i in range(30)) + " a@b.co"
    docs = spark.createDataFrame([(1, text, "en", "src1", 5), (2, text, "en", "src1", 5)], COLUMNS)
    docs = docs.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    first = corpus_pipeline.drop_near_copies(spark, docs, SMALL)
    assert first.collect() == docs.where("doc_id = 1").collect()
    assert {tuple(r) for r in mixing.choose(docs, mixing.words("text"), share=1.0).collect()} == {
        tuple(r) for r in docs.collect()
    }


def test_neighbours_with_null_ids(spark):
    rows = [(None, [1.0, 0.0]), (0, [1.0, 0.1]), (1, [1.0, 0.2]), (2, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collisions.nearest_neighbours(vectors, "vec_id % 100 = 0").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(got)] == [(0, 1, 1), (0, 2, 2)]
