"""SQL for the queries of ``chains``."""

from __future__ import annotations

from tallyworks.plans import catalogue as C
from tallyworks.plans import oracles as O


def oracles() -> dict[str, str]:
    built = f"""roster AS (SELECT course, batch, obtained_grade,
        CAST(avg_attendance_percent AS DECIMAL(5,2)) AS avg_attendance_percent FROM ({O._warehouse(False)}))"""
    loaded = f"""cleaned AS (SELECT * FROM ({O.oracles()["load_export"]})
        WHERE NOT regexp_full_match(course, '{C.BAG_PATTERN}'))"""
    one_line = "regexp_replace(text, '[\r\n]', ' ', 'g')"
    as_files = f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {one_line} AS text FROM main.documents"
    stop = ", ".join(f"'{w}'" for w in C.STOP_WORDS)
    listed = f"""vocabulary AS (SELECT word FROM ({O._words()}) WHERE word NOT IN ({stop})
        ORDER BY n DESC, word LIMIT {C.TOP_WORDS})"""
    return {
        "chain_avg_mode": O.REPORT_1.replace(O.ROSTER, built),
        "chain_pct_below": O.REPORT_2.replace(O.ROSTER, built),
        "chain_top3": O.REPORT_3.replace(O.ROSTER, built),
        "chain_bag_avg_mode": f"WITH {loaded} {O.BAG_REPORT_1}",
        "chain_bag_pct_below": f"WITH {loaded} {O.BAG_REPORT_2}",
        "chain_bag_top3": f"WITH {loaded} {O.BAG_TOP}",
        "corpus_from_files": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {one_line} AS line FROM documents",
        "chain_top_words_pairs": O._pairs(C.MAX_DISTANCE).replace(O.VOCABULARY, listed),
        # the documents as read from the files: an id of text, and one line
        "chain_tfidf": O.oracles()["tfidf"].replace("FROM documents", f"FROM ({as_files})"),
        "chain_warehouse_from_log": O._warehouse(True),
        "roster_avg_mode_bucketed": O.REPORT_1,
        "roster_pct_below_bucketed": O.REPORT_2,
        "roster_top3_bucketed": O.REPORT_3,
        "words_without_exact_stop_words": f"SELECT * FROM ({O._words()}) WHERE word NOT IN ({stop})",
        "terms_without_trimmed_stop_words": O.oracles()["document_frequency"],
        "error_table_appended": O.oracles()["dq_error_records"],
        "partitions_overwritten": f"""WITH {O.ROSTER} SELECT batch,
            CASE WHEN batch = '1995' THEN 'A' ELSE obtained_grade END AS obtained_grade, count(*) AS n
            FROM roster GROUP BY ALL""",
    }
