"""Ranked lexical search by the Best Position Algorithm.

A task takes the documents of its partition in shards of bounded size and lays out, for each
term, an impact list: the documents that hold the term, highest contribution first. For an item all its lists are read
downwards together. A document met in one list is looked up in all others by direct
access, so its score is known, and its places in the other lists count as seen too. The best position of
a list is the end of its first unbroken run of seen places. No unseen document can
score more than the contributions at the best positions together; reading stops when that sum
is strictly below the k-th score.

Items are taken in blocks of bounded size, each against all documents. Only terms of the block's
items are kept of a document.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.shared import documents, written

K = 10
ITEM_BYTES = 4 << 20     # item texts that are answered together
SHARD = 1 << 20          # postings that a task lays out together
STEP = 32                # places that are read first in each list; then twice as many every time
LENGTH_SHARE = 75        # per cent of the weight that a document's length has

# Everything but ASCII letters, digits and what is not ASCII separates; A-Z count as a-z.
_FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLDED).split(b" ")


def _counts(text: bytes | None) -> Counter:
    counts = Counter(terms_of(text))
    counts.pop(b"", None)
    return counts


def _match(vocabulary: dict[bytes, int]):
    """``(_row id, n, terms, tfs)`` of each document: its length, and the numbers and counts of the listed terms."""

    def run(batches):
        for batch in batches:
            lengths, terms, tfs = [], [], []
            for text in batch.column(1).cast(pa.large_binary()).to_pylist():
                counts = _counts(text)
                lengths.append(sum(counts.values()))
                own = [(vocabulary[t], c) for t, c in counts.items() if t in vocabulary]
                terms.append([t for t, _ in own])
                tfs.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))],
                names=["_id", "n", "terms", "tfs"],
            )

    return run


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of several spans, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Shard:
    """Postings of some documents, by document and as impact lists."""

    def __init__(self, sizes: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.first = np.append(0, np.cumsum(sizes))
        self.term, self.impact = term, impact
        doc = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((doc, -impact, term))
        self.place = np.empty(len(order), dtype=np.int64)       # of each posting in the lists
        self.place[order] = np.arange(len(order))
        self.listed_doc, self.listed_impact = doc[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(n_terms + 1))

    def best(self, terms: np.ndarray, times: np.ndarray, weight: np.ndarray, k: int, floor: int, step: int = STEP):
        """Documents and scores that may be among the ``k`` highest, given that ``k`` scores reach ``floor`` elsewhere.

        ``weight`` has for every term number how often the item holds it.
        """
        begin, end = self.begin[terms], self.begin[terms + 1]
        some = end > begin
        begin, end, times = begin[some], end[some], times[some]
        seen = np.zeros(len(self.place), dtype=bool)
        known = np.zeros(len(self.first) - 1, dtype=bool)
        docs, scores = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        best = begin.copy()                                     # the first place that is not seen
        depth, kth = 0, floor
        while len(begin):
            lo = np.minimum(begin + depth, end)
            hi = np.minimum(lo + step, end)
            met = np.unique(self.listed_doc[_spans(lo, hi - lo)])
            met = met[~known[met]]
            known[met] = True
            # direct access: all postings of the documents met, wherever they stand in the item's lists
            sizes = self.first[met + 1] - self.first[met]
            at = _spans(self.first[met], sizes)
            share = weight[self.term[at]]
            seen[self.place[at[share > 0]]] = True
            sums = np.append(0, np.cumsum(self.impact[at] * share))
            ends = np.cumsum(sizes)
            docs.append(met)
            scores.append(sums[ends] - sums[ends - sizes])
            depth, step = depth + step, step * 2
            for i in range(len(best)):
                left = seen[best[i]:end[i]]
                best[i] += len(left) if left.all() else int(np.argmin(left))
            found = np.concatenate(scores)
            if len(found) >= k:
                kth = max(kth, int(np.partition(found, len(found) - k)[len(found) - k]))
            open_lists = best < end
            bound = int((self.listed_impact[best[open_lists] - 1] * times[open_lists]).sum())
            if not open_lists.any() or bound < kth:
                break
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        good = (scores > 0) & (scores >= kth)
        return docs[good], scores[good]


def _search(items: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, total: int, k: int, shard: int):
    """``(item, _id, score)``: the ``k`` best documents of a task for each item."""

    def run(batches):
        best: dict[int, list] = {item: [] for item, _, _ in items}
        held, size, ids_type = [], 0, None

        def settle():
            ids = pa.concat_arrays([h[0] for h in held])
            n = np.concatenate([h[1] for h in held])
            sizes = np.concatenate([h[2] for h in held])
            term = np.concatenate([h[3] for h in held])
            tf = np.concatenate([h[4] for h in held])
            m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // total
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes)))
            lists = Shard(sizes, term, impact, len(weights))
            share = np.zeros(len(weights), dtype=np.int64)
            for item, terms, times in items:
                share[terms] = times
                have = best[item]
                docs, scores = lists.best(terms, times, share, k, have[-1][0] if len(have) == k else 0)
                share[terms] = 0
                if len(docs):
                    new = list(zip(scores.tolist(), ids.take(pa.array(docs)).to_pylist()))
                    best[item] = sorted(have + new, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k]

        for batch in batches:
            ids_type = batch.column(0).type
            terms, tfs = batch.column(2), batch.column(3)
            sizes = np.diff(terms.offsets.to_numpy())
            offsets = np.append(0, np.cumsum(sizes))
            term, tf = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
            n = batch.column(1).to_numpy()
            a = 0
            while a < len(sizes):  # whole documents, up to the size of a shard
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + shard - size, "right")) - 1)
                part = slice(offsets[a], offsets[b])
                held.append((batch.column(0).slice(a, b - a), n[a:b], sizes[a:b], term[part], tf[part]))
                size += int(offsets[b] - offsets[a])
                a = b
                if size >= shard or a < len(sizes):
                    settle()
                    held, size = [], 0
        if held:
            settle()
        rows = [(item, doc, score) for item, found in best.items() for score, doc in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], ids_type),
                 pa.array([r[2] for r in rows], pa.int64())],
                names=["_item", "_id", "score"],
            )

    return run


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    item_bytes: int = ITEM_BYTES,
    shard: int = SHARD,
) -> DataFrame:
    """``(item, rank, id, score)``: the ``k`` documents of highest score above 0 for each item, equal scores by id.

    Terms are runs of ASCII letters and digits and of all that is not ASCII, A-Z in lower case.
    With N documents that have a term, L terms in all of them, n in one, df documents
    that hold a term and tf times in one of them, a term weighs ``w = floor(1000 ln((2N + 2) / (2df + 1)))`` and gives
    ``w * (10^9 tf div (1000 tf + 8m))``, ``m = 25 + 75nN div L``; an item's terms count as often as they stand in it.

    Null and empty texts have no terms: such documents do not count, such items find nothing.
    Every row is a document and an item of its own, whether its id is null (last among equals) or
    repeated. Other columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    id_type = docs.select(F.col(id_column)).dtypes[0][1]
    asked = written(
        items.select(F.monotonically_increasing_id().alias("_item"), F.col(item_column).alias("_name"), F.col(item_text).alias("_text")),
        "items",
    )
    size = asked.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / item_bytes))
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    out = spark.createDataFrame([], f"_item long, _id {id_type}, score long")
    for block in range(n_blocks):  # each of a bounded size, by its own number of rows
        rows = asked.where((F.col("_item") % n_blocks) == block).select("_item", "_text").collect()
        counted = [(row["_item"], _counts(row["_text"].encode() if row["_text"] else None)) for row in rows]
        vocabulary = {term: i for i, term in enumerate(sorted(set().union(*[counts for _, counts in counted])))}
        if not vocabulary:
            continue
        matched = written(texts.mapInArrow(
            _match(vocabulary), f"_id {id_type}, n long, terms array<int>, tfs array<long>"
        ), "matched").where("n > 0")
        n_docs, total = matched.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for term, n in matched.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[term] = n
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], dtype=np.int64)
        numbered = [
            (item, np.array([vocabulary[t] for t in counts], dtype=np.int64), np.array(list(counts.values()), dtype=np.int64))
            for item, counts in counted if counts
        ]
        found = matched.where(F.size("terms") > 0).mapInArrow(
            _search(numbered, weights, n_docs, total, k, shard), f"_item long, _id {id_type}, score long"
        )
        out = out.unionByName(found)
    order = Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_last("_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("_item", "_name"), "_item").select(
        F.col("_name").alias(item_column), "rank", F.col("_id").alias(id_column), "score"
    )


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten documents that fit each benchmark item best."""
    found = search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select(F.col("item_id").cast("long").alias("item_id"), "rank", F.col("doc_id").cast("long").alias("doc_id"), "score")


def lexical_sql() -> str:
    words = """list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\\x{80}-\\x{10FFFF}]+'), lambda t: t <> '')"""
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ts FROM documents),
    sizes AS (SELECT count(*) AS N, CAST(sum(len(ts)) AS BIGINT) AS L FROM docs WHERE len(ts) > 0),
    tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM docs) GROUP BY r, t),
    df AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(N) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, sizes GROUP BY t),
    asked AS (SELECT row_number() OVER () AS q, item_id, {words} AS ts FROM benchmark),
    wanted AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(ts) AS t FROM asked) GROUP BY q, t),
    scored AS (SELECT q, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(ts) * N) // L)))) AS BIGINT) AS score
        FROM wanted JOIN tf USING (t) JOIN df USING (t) JOIN docs USING (r), sizes GROUP BY q, r),
    ranked AS (SELECT q, r, score, doc_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank
        FROM scored JOIN docs USING (r) WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked JOIN asked USING (q) WHERE rank <= {K}"""
