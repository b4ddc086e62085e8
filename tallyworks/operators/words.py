"""Word counts, document frequency and TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import text as T
from tallyworks.functions.stemming import stem_arrays, stem_vocabulary
from tallyworks.operators.ranking import top_k
from tallyworks.sinks import tables

# Word lists carry no broadcast hint. Spark broadcasts one when its size is below
# ``spark.sql.autoBroadcastJoinThreshold``, and knows that size for the result of a
# ``limit`` as well as for a file; a list that is too large is shuffled.


def keep_listed(frame: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """Rows whose ``column`` is in the one-column list ``words``."""
    listed = words.toDF("_listed")
    return frame.join(listed, frame[column] == listed["_listed"], "left_semi")


def drop_listed(frame: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """Rows whose ``column`` is not in the one-column list ``words``."""
    listed = words.toDF("_listed").where("_listed IS NOT NULL")
    return frame.join(listed, frame[column] == listed["_listed"], "left_anti")


def word_tokens(
    corpus: DataFrame, text: str = "text", stop_words: DataFrame | None = None, case_sensitive: bool = False
) -> DataFrame:
    """Every word occurrence as ``(word)``; ``text`` may hold lines or whole documents."""
    tokens = corpus.select(F.explode(T.words(text, case_sensitive)).alias("word")).where("word != ''")
    return tokens if stop_words is None else drop_listed(tokens, "word", stop_words)


def word_count(
    corpus: DataFrame, text: str = "text", stop_words: DataFrame | None = None, case_sensitive: bool = False
) -> DataFrame:
    """``(word, n)``.

    Stop words are dropped from the counts. Spark moves that below the
    aggregation when the list is small enough to broadcast; a long list meets
    only the counted words, not every occurrence.
    """
    tokens = word_tokens(corpus, text, None, case_sensitive)
    counts = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts if stop_words is None else drop_listed(counts, "word", stop_words)


def top_words(
    corpus: DataFrame,
    text: str = "text",
    stop_words: DataFrame | None = None,
    case_sensitive: bool = False,
    k: int = 50,
) -> DataFrame:
    """The ``k`` most frequent words, equal counts in word order."""
    counts = word_count(corpus, text, stop_words, case_sensitive)
    return top_k(counts, [F.desc("n"), F.asc("word")], k)


def document_terms(
    corpus: DataFrame, text: str = "text", key: str | None = None, stemmed: bool = True, revised: bool = True
) -> DataFrame:
    """Each distinct term of each document once.

    Without ``key`` every row is a document (or a line, if lines are the unit)
    and is made distinct inside its own row, without a shuffle. With ``key``,
    rows are pieces of the document the key names.
    """
    columns = [] if key is None else [key]
    tokens = corpus.select(*columns, F.array_distinct(T.letter_digit_tokens(text)).alias("tokens"))
    found = F.col("tokens")
    if stemmed:
        tokens, found = stem_arrays(tokens, "tokens", revised)
    terms = tokens.select(*columns, F.explode(F.array_distinct(found)).alias("term")).where("term != ''")
    return terms if key is None else terms.dropDuplicates([key, "term"])


def document_frequency(
    corpus: DataFrame,
    text: str = "text",
    stop_words: DataFrame | None = None,
    key: str | None = None,
    stemmed: bool = True,
    revised: bool = True,
) -> DataFrame:
    """``(term, df)``. Stop words are compared with the stem, not with the token."""
    terms = document_terms(corpus, text, key, stemmed, revised)
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts if stop_words is None else drop_listed(counts, "term", stop_words)


def top_terms(frequencies: DataFrame, k: int = 100) -> DataFrame:
    """The ``k`` terms found in most documents, equal counts in term order."""
    return top_k(frequencies, [F.desc("df"), F.asc("term")], k)


def _tokens(text: str, normalize: bool) -> Column:
    return T.letter_digit_tokens(text) if normalize else T.raw_tokens(text)


def token_dictionary(
    corpus: DataFrame, terms: DataFrame, text: str = "text", normalize: bool = False, revised: bool = True
) -> DataFrame:
    """``(token, *terms)``: every distinct token of the corpus whose stem is ``terms.term``.

    Each distinct token is stemmed once, however often it occurs. The result is written, so
    that Spark knows its size when it chooses how to join it.
    """
    tokens = corpus.select(F.explode(F.array_distinct(_tokens(text, normalize))).alias("token"))
    # Written before the join: Spark would move the join's conditions below the steps of the stemmer and nest them.
    stems = tables.scratch(stem_vocabulary(tokens, "token", revised), "stems")
    return tables.scratch(stems.join(terms, stems["stem"] == terms["term"]).drop("stem"), "token-dictionary")


def _token_counts(corpus: DataFrame, key: str, text: str, normalize: bool) -> DataFrame:
    """``(doc_id, token, n)``, each distinct token of a row once, counted by run length in the row's own sorted array."""
    ordered = corpus.select(F.col(key).alias("doc_id"), F.sort_array(_tokens(text, normalize)).alias("ts"))
    ends = "filter(transform(ts, (t, i) -> if(t <=> get(ts, i + 1), -1, i)), i -> i >= 0)"
    runs = "transform(ends, (e, i) -> struct(ts[e] AS token, CAST(e - coalesce(get(ends, i - 1), -1) AS LONG) AS n))"
    # Not plain ``inline``: for that, Spark would test the size of the array in a filter at the scan, computing it anew.
    counted = ordered.select("doc_id", "ts", F.expr(ends).alias("ends")).select("doc_id", F.inline_outer(F.expr(runs)))
    return counted.where("token IS NOT NULL")


def term_counts(
    corpus: DataFrame,
    terms: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalize: bool = False,
    revised: bool = True,
) -> DataFrame:
    """``(doc_id, *terms, tf)``: how often each listed term stands in each document.

    Tokens are counted inside the row and meet the dictionary as distinct tokens; nothing is stemmed per occurrence.
    Rows may be documents or pieces of them.
    """
    listed = token_dictionary(corpus, terms, text, normalize, revised)
    counts = _token_counts(corpus, key, text, normalize)
    return counts.join(listed, "token").groupBy("doc_id", *terms.columns).agg(F.sum("n").alias("tf"))


def term_frequency(
    corpus: DataFrame,
    vocabulary: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalize: bool = False,
    revised: bool = True,
) -> DataFrame:
    """``(doc_id, term, tf)`` for terms of the one-column vocabulary.

    Tokens keep case and punctuation before stemming, so ``State,`` does not
    count for ``state``. ``normalize`` cleans them as ``document_frequency`` does.
    """
    return term_counts(corpus, vocabulary.toDF("term").distinct(), key, text, normalize, revised)


def tf_idf(
    corpus: DataFrame,
    frequencies: DataFrame,
    n_docs: int | Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    idf: str = "integer",
    normalize: bool = False,
    revised: bool = True,
) -> DataFrame:
    """``(doc_id, term, tfidf)`` against a ``(term, df)`` table with one row per term.

    The table both selects the terms and brings their frequency, in one join, so
    no term is ever without one. ``n_docs`` is a number, or is counted from the
    corpus when not given.
    """
    if n_docs is None:
        n_docs = corpus.agg(F.countDistinct(key)).scalar()
    elif not isinstance(n_docs, Column):
        n_docs = F.lit(n_docs)
    counts = term_counts(corpus, frequencies.select("term", "df"), key, text, normalize, revised)
    weight = T.inverse_document_frequency(n_docs, F.col("df"), idf)
    return counts.select("doc_id", "term", (F.col("tf") * weight).alias("tfidf"))
