"""DuckDB SQL for the registered queries (same keys and column names).

The views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are expected to be
registered over the same Parquet files. Integer sums are cast back to BIGINT
(DuckDB widens them) and ranks to INTEGER (Spark's type); doubles that depend
on summation order are rounded on both sides.
"""

from __future__ import annotations

from encore.functions.columns import HASH_RANGE
from encore.plans.roles import MIN_ITEMS_PER_USER, MIN_PLAYS_PER_ITEM, N_FEATURES, TABLE_NAMES
from encore.sources.attributes import NUMBER, WHOLE, WIDTHS

# Shared fragments --------------------------------------------------------

INTERACTIONS = """
    SELECT o.o_custkey AS user_id, l.l_partkey AS song_id, CAST(l.l_quantity AS INTEGER) AS plays,
           CAST(l.l_orderkey AS VARCHAR) || ':' || CAST(l.l_linenumber AS VARCHAR) AS row_key
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

RECORDS = """
    SELECT p_partkey AS song_id, p_brand AS song_artist, p_name AS song_title,
           p_partkey AS track_id, p_type AS track_artist, p_size
    FROM part WHERE p_type = 'PROMO'
"""

BLOCKLIST = f"""
    SELECT e.song_id, e.song_artist, e.song_title, e.track_id, e.track_artist
    FROM ({RECORDS}) e
    WHERE NOT EXISTS (SELECT 1 FROM ({RECORDS}) a WHERE a.p_size <= 10 AND a.song_id = e.song_id)
"""

WITHOUT_BLOCKED = f"""
    SELECT i.user_id, i.song_id, i.plays FROM ({INTERACTIONS}) i
    WHERE NOT EXISTS (SELECT 1 FROM ({BLOCKLIST}) b WHERE b.song_id = i.song_id)
"""

USER_ACTIVITY = f"""
    SELECT user_id, COUNT(song_id) AS song_count, CAST(SUM(plays) AS BIGINT) AS play_count
    FROM ({WITHOUT_BLOCKED}) GROUP BY user_id
"""

ITEM_ACTIVITY = f"""
    SELECT song_id, COUNT(user_id) AS user_count, CAST(SUM(plays) AS BIGINT) AS play_count
    FROM ({WITHOUT_BLOCKED}) GROUP BY song_id
"""

MIN_ITEMS, MIN_PLAYS = MIN_ITEMS_PER_USER, MIN_PLAYS_PER_ITEM

CLEANED = f"""
    SELECT w.* FROM ({WITHOUT_BLOCKED}) w
    WHERE w.user_id IN (SELECT user_id FROM ({USER_ACTIVITY}) WHERE song_count > {MIN_ITEMS})
      AND w.song_id IN (SELECT song_id FROM ({ITEM_ACTIVITY}) WHERE play_count > {MIN_PLAYS})
"""

ORACLES: dict[str, str] = {
    "blocklist": BLOCKLIST,
    "anti_blocked": WITHOUT_BLOCKED,
    "user_activity": USER_ACTIVITY,
    "item_activity": ITEM_ACTIVITY,
    "item_popularity": f"""
        SELECT song_id, COUNT(user_id) AS user_count, CAST(SUM(plays) AS BIGINT) AS sum_play_count
        FROM ({WITHOUT_BLOCKED}) GROUP BY song_id ORDER BY user_count DESC, song_id
    """,
    "top_items": f"""
        SELECT song_id, COUNT(user_id) AS user_count, CAST(SUM(plays) AS BIGINT) AS sum_play_count
        FROM ({WITHOUT_BLOCKED}) GROUP BY song_id ORDER BY user_count DESC, song_id LIMIT 20
    """,
    "distinct_counts": f"""
        SELECT COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT song_id) AS n_items FROM ({WITHOUT_BLOCKED})
    """,
    "active_users": f"SELECT * FROM ({USER_ACTIVITY}) WHERE song_count > {MIN_ITEMS}",
    "popular_items": f"SELECT * FROM ({ITEM_ACTIVITY}) WHERE play_count > {MIN_PLAYS}",
    "clean_interactions": CLEANED,
    "retention_report": f"""
        WITH u AS ({USER_ACTIVITY}), s AS ({ITEM_ACTIVITY}),
        t AS (
          SELECT (SELECT CAST(SUM(song_count) AS BIGINT) FROM u) AS n_rows,
                 (SELECT COUNT(*) FROM u) AS n_users,
                 (SELECT COUNT(*) FROM s) AS n_items,
                 (SELECT MAX(song_count) FROM u) AS max_items_per_user,
                 (SELECT COUNT(*) FROM u WHERE song_count > {MIN_ITEMS}) AS active_users,
                 (SELECT COUNT(*) FROM s WHERE play_count > {MIN_PLAYS}) AS popular_items,
                 (SELECT COUNT(*) FROM ({CLEANED})) AS cleaned_rows)
        SELECT n_rows, n_users, n_items, max_items_per_user,
               CAST(max_items_per_user AS DOUBLE) / n_items AS max_items_share,
               active_users, CAST(active_users AS DOUBLE) / n_users AS active_share,
               popular_items, CAST(popular_items AS DOUBLE) / n_items AS popular_share,
               cleaned_rows, CAST(cleaned_rows AS DOUBLE) / n_rows AS cleaned_share
        FROM t
    """,
}


# --- sources ----------------------------------------------------------------------

SO = "'SO' || lpad(CAST(p_partkey AS VARCHAR), 16, '0')"
TR = "'TR' || lpad(CAST(p_partkey AS VARCHAR), 16, '0')"
TITLE2 = "p_name || ' - ' || CAST(p_size AS VARCHAR)"
PARSED_FIELDS = f"""{SO} AS song_id, p_brand AS song_artist, p_name AS song_title,
    {TR} AS track_id, p_type AS track_artist, {TITLE2} AS track_title"""
BROKEN_LINE = f"'<' || {SO} || ' ' || {TR} || '> ' || p_brand || '  -  ' || p_name || ' != ' || p_type || '  -  ' || {TITLE2}"

FEATURE_COLS = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(N_FEATURES))
RAW_COLS = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS _c{i}" for i in range(N_FEATURES))
QUOTED_ID = "'''TR' || lpad(CAST(vec_id AS VARCHAR), 16, '0') || ''''"

FEATURES_LABELS = f"""
    SELECT {FEATURE_COLS}, e.vec_id AS track_id, d.lang AS genre
    FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id
"""
BINARY = f"SELECT *, CASE WHEN genre = 'es' THEN 1 ELSE 0 END AS label FROM ({FEATURES_LABELS})"


def share(fraction: float) -> int:
    """The part of the hash range below which a share of the rows falls."""
    return round(fraction * HASH_RANGE)


def bucket(key_sql: str) -> str:
    return f"(CAST('0x' || substr(md5({key_sql}), 1, 7) AS BIGINT))"


SCANNED = """
    SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS song_id,
           CAST(l.l_quantity AS INTEGER) AS plays
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

# The widest value of each column (see ``sources.attributes``).
_TYPE_NAMES = str(list(WIDTHS))
_WIDTHS_SQL = " UNION ALL ".join(
    f"""SELECT name, width FROM (UNPIVOT (SELECT MAX(CASE WHEN COLUMNS(*) IS NULL THEN 0
            WHEN regexp_matches(CAST(COLUMNS(*) AS VARCHAR), '{WHOLE}') THEN 1
            WHEN regexp_matches(CAST(COLUMNS(*) AS VARCHAR), '{NUMBER}') THEN 2 ELSE 3 END) FROM {t}) ON COLUMNS(*) INTO NAME name VALUE width)"""
    for t in TABLE_NAMES
)

ORACLES.update({
    "parse_log": f"SELECT {PARSED_FIELDS} FROM part WHERE p_type = 'PROMO' AND p_size <> 50",
    "parse_accepted_log": f"SELECT {PARSED_FIELDS} FROM part WHERE p_type = 'PROMO' AND p_size <= 10 AND p_size <> 1",
    "rejected_lines": f"""
        SELECT 'errors' AS log, 'ERROR: ' || {BROKEN_LINE} AS value FROM part WHERE p_type = 'PROMO' AND p_size = 50
        UNION ALL
        SELECT 'accepted' AS log, '< ERROR: ' || {BROKEN_LINE} AS value FROM part WHERE p_type = 'PROMO' AND p_size = 1
    """,
    "scan_delimited": SCANNED,
    "spread_scan": SCANNED,
    "single_file_report": f"""
        SELECT COUNT(DISTINCT song_id) AS n_items, COUNT(user_id) AS user_count, CAST(SUM(plays) AS BIGINT) AS play_count
        FROM ({WITHOUT_BLOCKED})
    """,
    "ordered_export": f"""
        SELECT *, row_number() OVER (ORDER BY user_count DESC, song_id) AS row_no
        FROM (SELECT song_id, COUNT(user_id) AS user_count, CAST(SUM(plays) AS BIGINT) AS sum_play_count FROM ({WITHOUT_BLOCKED}) GROUP BY song_id)
    """,
    "schema_from_attributes": f"SELECT {FEATURE_COLS}, CAST(vec_id AS VARCHAR) AS TRACK_ID FROM embeddings",
    "attribute_types": f"""
        SELECT {_TYPE_NAMES}[width + 1] AS type, COUNT(*) AS n_attributes FROM ({_WIDTHS_SQL}) GROUP BY 1
    """,
    "log_line_counts": """
        SELECT 'errors' AS log, COUNT(*) AS n_lines FROM part
        UNION ALL SELECT 'accepted' AS log, COUNT(*) AS n_lines FROM part WHERE p_type = 'PROMO'
    """,
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS data_set, COUNT(*) AS n_rows FROM {t}" for t in TABLE_NAMES),
    "cast_features": f"SELECT {RAW_COLS}, {QUOTED_ID} AS track_id FROM embeddings",
    "unquote_id": f"SELECT {RAW_COLS}, 'TR' || lpad(CAST(vec_id AS VARCHAR), 16, '0') AS track_id FROM embeddings",
    "features_labels": FEATURES_LABELS,
    "binary_label": f"SELECT track_id, genre, label FROM ({BINARY})",
    "class_balance": f"SELECT label, genre, COUNT(*) AS n_rows FROM ({BINARY}) GROUP BY label, genre",
})


# --- statistics ----------------------------------------------------------------------


def _profile_sql(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG(CAST({c} AS DOUBLE)), 9) AS mean,
                   ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 9) AS stddev,
                   CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM ({source})"""
        for c in cols
    )


PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)
MEASURES = (("items_per_user", USER_ACTIVITY, "song_count"), ("plays_per_item", ITEM_ACTIVITY, "play_count"),
            ("users_per_item", ITEM_ACTIVITY, "user_count"))
LINEITEM_CORR = "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * 2 + l_tax AS qty2_tax FROM lineitem"
CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty2_tax"]
CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, ROUND(corr({a}, {b}), 9) AS r FROM ({LINEITEM_CORR})"
    for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1:]
)

ORACLES.update({
    "profile_features": _profile_sql(f"SELECT {FEATURE_COLS} FROM embeddings", [f"f{i}" for i in range(N_FEATURES)]),
    "profile_activity": _profile_sql(USER_ACTIVITY, ["song_count", "play_count"]) + " UNION ALL " + _profile_sql(
        f"SELECT song_id, COUNT(user_id) AS user_count, CAST(SUM(plays) AS BIGINT) AS sum_play_count "
        f"FROM ({WITHOUT_BLOCKED}) GROUP BY song_id", ["user_count", "sum_play_count"]),
    "quantiles_exact": " UNION ALL ".join(
        f"SELECT '{m}' AS measure, CAST({p} AS DOUBLE) AS prob, quantile_disc({c}, {p}) AS value FROM ({src})"
        for m, src, c in MEASURES for p in PROBS
    ),
    "quantiles_approx": " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, CAST({p} AS DOUBLE) AS prob, MIN(v) FILTER (cum >= CAST({round(max(p - 0.05, 0), 9)} AS DOUBLE) * n) AS lower,
                   MIN(v) FILTER (cum >= CAST({round(min(p + 0.05, 1), 9)} AS DOUBLE) * n) AS upper, TRUE AS within_bound
            FROM (SELECT {c} AS v, COUNT(*) OVER (ORDER BY {c}) AS cum, COUNT(*) OVER () AS n FROM ({src}))"""
        for m, src, c in MEASURES for p in PROBS
    ),
    "correlation_pairs": CORR,
    "correlation_features": f"""
        WITH v AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM embeddings, (SELECT unnest(range({N_FEATURES})) AS i))
        SELECT 'f' || a.i AS feature_x, 'f' || b.i AS feature_y, ROUND(corr(a.x, b.x), 9) AS r
        FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i
    """,
    "quantile_sketches": f"""
        SELECT event_type, prob, n, n_sketches, TRUE AS within_bound
        FROM (SELECT event_type, COUNT(value) AS n, COUNT(DISTINCT CAST(ts AS DATE)) FILTER (value IS NOT NULL) AS n_sketches FROM events GROUP BY event_type),
             (SELECT CAST(unnest({list(PROBS)}) AS DOUBLE) AS prob)
    """,
    "correlated_pairs": f"SELECT * FROM ({CORR}) WHERE r > 0.9",
})


# --- splits, sampling, indexing ------------------------------------------------------------

KEYED_WITHOUT_BLOCKED = f"""
    SELECT i.* FROM ({INTERACTIONS}) i
    WHERE NOT EXISTS (SELECT 1 FROM ({BLOCKLIST}) b WHERE b.song_id = i.song_id)
"""
KEYED_CLEAN = f"""
    SELECT w.* FROM ({KEYED_WITHOUT_BLOCKED}) w
    WHERE w.user_id IN (SELECT user_id FROM ({USER_ACTIVITY}) WHERE song_count > {MIN_ITEMS})
      AND w.song_id IN (SELECT song_id FROM ({ITEM_ACTIVITY}) WHERE play_count > {MIN_PLAYS})
"""
TRAIN = f"SELECT * FROM ({KEYED_CLEAN}) WHERE {bucket('row_key')} < {share(0.05)}"
TEST = f"SELECT * FROM ({KEYED_CLEAN}) WHERE {bucket('row_key')} >= {share(0.05)}"
IN_TRAIN = f"{bucket('CAST(track_id AS VARCHAR)')} < {share(0.8)}"
IN_SAMPLE = f"""{bucket("'sample:' || CAST(track_id AS VARCHAR)")}
    < CASE WHEN label = 0 THEN {share(0.1)} WHEN label = 1 THEN {share(1.0)} ELSE 0 END"""


def _index_sql(source: str, col: str) -> str:
    return f"""
        SELECT {col}, COUNT(*) AS n_rows,
               CAST(row_number() OVER (ORDER BY COUNT(*) DESC, {col}) - 1 AS DOUBLE) AS "index"
        FROM ({source}) WHERE {col} IS NOT NULL GROUP BY {col}
    """


ORACLES.update({
    "hash_split": f"""
        SELECT *, CASE WHEN {bucket('row_key')} < {share(0.7)} THEN 'train' ELSE 'test' END AS split
        FROM ({KEYED_WITHOUT_BLOCKED})
    """,
    "stratified_sample": f"""
        SELECT track_id, genre, label FROM ({BINARY})
        WHERE {bucket('CAST(track_id AS VARCHAR)')} < {share(0.8)}
          AND {bucket("'sample:' || CAST(track_id AS VARCHAR)")} < CASE WHEN label = 0 THEN {share(0.1)} WHEN label = 1 THEN {share(1.0)} ELSE 0 END
    """,
    "split_class_counts": f"""
        SELECT part, label, genre, COUNT(*) AS n_rows FROM (
          SELECT CASE WHEN {IN_TRAIN} THEN 'train' ELSE 'test' END AS part, label, genre FROM ({BINARY})
          UNION ALL SELECT 'sample' AS part, label, genre FROM ({BINARY}) WHERE {IN_TRAIN} AND {IN_SAMPLE})
        GROUP BY part, label, genre
    """,
    "cold_start_users": f"SELECT t.* FROM ({TEST}) t WHERE NOT EXISTS (SELECT 1 FROM ({TRAIN}) r WHERE r.user_id = t.user_id)",
    "cold_start_items": f"SELECT t.* FROM ({TEST}) t WHERE NOT EXISTS (SELECT 1 FROM ({TRAIN}) r WHERE r.song_id = t.song_id)",
    "string_index": _index_sql("SELECT lang FROM documents", "lang"),
    "user_index": _index_sql(KEYED_CLEAN, "user_id"),
})


# --- ranking ------------------------------------------------------------------------------------

PAIRS = """
    SELECT o.o_custkey AS user_id, l.l_partkey AS song_id, MAX(l.l_extendedprice) AS prediction,
           CAST(SUM(CAST(l.l_quantity AS INTEGER)) AS BIGINT) AS plays
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2
"""
REC = f"""
    SELECT user_id, song_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, song_id) AS INTEGER) AS position
    FROM ({PAIRS}) QUALIFY position <= 10
"""
REL = f"""
    SELECT user_id, song_id, CAST(rank() OVER (PARTITION BY user_id ORDER BY plays DESC) AS INTEGER) AS "rank"
    FROM ({PAIRS}) QUALIFY "rank" <= 10
"""


def _ideal(k: int) -> str:
    return f"list_sum(list_transform(range(1, LEAST(n_rel, {k}) + 1), lambda i: 1.0 / log2(i + 1)))"


METRICS = f"""
    WITH rec AS ({REC}), rel AS ({REL}),
    n AS (SELECT user_id, COUNT(*) AS n_rel FROM rel GROUP BY user_id),
    h AS (SELECT r.user_id, r.position, CASE WHEN l.song_id IS NULL THEN 0 ELSE 1 END AS hit
          FROM rec r LEFT JOIN rel l ON r.user_id = l.user_id AND r.song_id = l.song_id),
    c AS (SELECT *, SUM(hit) OVER (PARTITION BY user_id ORDER BY position) AS cum FROM h),
    u AS (SELECT c.user_id, n.n_rel,
                 SUM(hit * cum / position) AS ap_sum,
                 SUM(CASE WHEN position <= 5 THEN hit ELSE 0 END) AS hits5,
                 SUM(CASE WHEN position <= 10 THEN hit ELSE 0 END) AS hits10,
                 SUM(CASE WHEN position <= 5 THEN hit / log2(position + 1) ELSE 0 END) AS dcg5,
                 SUM(CASE WHEN position <= 10 THEN hit / log2(position + 1) ELSE 0 END) AS dcg10
          FROM c JOIN n USING (user_id) GROUP BY c.user_id, n.n_rel)
    SELECT COUNT(*) AS n_users,
           ROUND(AVG(hits5 / 5.0), 9) AS precision_at_5,
           ROUND(AVG(hits10 / 10.0), 9) AS precision_at_10,
           ROUND(AVG(ap_sum / n_rel), 9) AS mean_average_precision,
           ROUND(AVG(dcg5 / {_ideal(5)}), 9) AS ndcg_at_5,
           ROUND(AVG(dcg10 / {_ideal(10)}), 9) AS ndcg_at_10
    FROM u
"""

ORACLES.update({
    "topn_per_user": f"""
        SELECT user_id, song_id, prediction, plays,
               CAST(rank() OVER (PARTITION BY user_id ORDER BY prediction DESC) AS INTEGER) AS "rank"
        FROM ({PAIRS}) QUALIFY "rank" <= 10
    """,
    "relevant_per_user": f"""
        SELECT user_id, song_id, prediction, plays,
               CAST(rank() OVER (PARTITION BY user_id ORDER BY plays DESC) AS INTEGER) AS "rank"
        FROM ({PAIRS}) QUALIFY "rank" <= 10
    """,
    "ranked_lists": f"""
        SELECT user_id, string_agg(CAST(song_id AS VARCHAR), ',' ORDER BY position) AS items
        FROM ({REC}) GROUP BY user_id
    """,
    # Both lists come from the same pairs, so each pair's two ranks stand in one row.
    "ranked_pairs": f"""
        SELECT user_id, song_id, CASE WHEN position <= 10 THEN position END AS position, CASE WHEN "rank" <= 10 THEN "rank" END AS "rank"
        FROM (SELECT user_id, song_id,
                     CAST(row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, song_id) AS INTEGER) AS position,
                     CAST(rank() OVER (PARTITION BY user_id ORDER BY plays DESC) AS INTEGER) AS "rank"
              FROM ({PAIRS}))
        WHERE position <= 10 OR "rank" <= 10
    """,
    "predictions_sorted": f"SELECT * FROM ({PAIRS}) ORDER BY user_id, song_id, prediction DESC",
    "ranking_metrics": METRICS,
    "precision_at_k": f"SELECT precision_at_5, precision_at_10 FROM ({METRICS})",
    "map_score": f"SELECT mean_average_precision FROM ({METRICS})",
    "ndcg_at_k": f"SELECT ndcg_at_5, ndcg_at_10 FROM ({METRICS})",
})


# --- evaluation on fixed scores ------------------------------------------------------------------

BINARY_SCORES = """
    SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
           CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END AS prediction, l_quantity AS score
    FROM lineitem
"""
MULTI = """
    SELECT CAST(label AS DOUBLE) AS label,
           CAST((label + CASE WHEN vec_id % 4 = 0 THEN 1 ELSE 0 END) % 10 AS DOUBLE) AS prediction
    FROM embeddings
"""

ORACLES.update({
    "confusion_matrix": f"""
        WITH c AS (
          SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE prediction = 1) AS n_positive,
                 COUNT(*) FILTER (WHERE prediction = 0) AS n_negative,
                 COUNT(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
                 COUNT(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp,
                 COUNT(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn,
                 COUNT(*) FILTER (WHERE prediction = 0 AND label = 0) AS tn
          FROM ({BINARY_SCORES}))
        SELECT *, ROUND(CAST(tp + tn AS DOUBLE) / total, 9) AS accuracy,
               ROUND(CASE WHEN tp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 9) AS recall,
               ROUND(CASE WHEN tp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 9) AS precision
        FROM c
    """,
    "auc": f"""
        WITH r AS (
          SELECT label, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0 AS mr
          FROM ({BINARY_SCORES})),
        s AS (SELECT SUM(CASE WHEN label = 1 THEN mr ELSE 0 END) AS sr,
                     COUNT(*) FILTER (WHERE label = 1) AS n_positive,
                     COUNT(*) FILTER (WHERE label <> 1) AS n_negative FROM r)
        SELECT ROUND((sr - n_positive * (n_positive + 1) / 2.0) / (CAST(n_positive AS DOUBLE) * n_negative), 9) AS auc,
               n_positive, n_negative
        FROM s
    """,
    "multiclass_scores": f"""
        WITH t AS ({MULTI}),
        k AS (SELECT c, SUM(nt) AS n_true, SUM(np) AS n_pred, SUM(tp) AS tp FROM (
                SELECT label AS c, 1 AS nt, 0 AS np, CASE WHEN label = prediction THEN 1 ELSE 0 END AS tp FROM t
                UNION ALL SELECT prediction AS c, 0, 1, 0 FROM t) GROUP BY c),
        m AS (SELECT CAST(n_true AS DOUBLE) AS nt, CAST(n_pred AS DOUBLE) AS np, CAST(tp AS DOUBLE) AS tp FROM k)
        SELECT ROUND(SUM(nt * CASE WHEN tp = 0 THEN 0.0 ELSE 2 * tp / (nt + np) END) / SUM(nt), 9) AS f1,
               ROUND(SUM(tp) / SUM(nt), 9) AS accuracy,
               ROUND(SUM(nt * CASE WHEN tp = 0 THEN 0.0 ELSE tp / np END) / SUM(nt), 9) AS weighted_precision,
               ROUND(SUM(nt * CASE WHEN tp = 0 THEN 0.0 ELSE tp / nt END) / SUM(nt), 9) AS weighted_recall
        FROM m
    """,
})


ORACLES.update({
    "assemble_scale": "SELECT track_id, " + ", ".join(
        f"ROUND(f{i} / STDDEV_SAMP(f{i}) OVER (), 9) AS s{i}" for i in range(N_FEATURES)
    ) + f" FROM (SELECT {FEATURE_COLS}, vec_id AS track_id FROM embeddings)",
})


# --- certificates of fitted models: the rows they cover, and no violation --------------------------

ORACLES.update({
    "logistic_certificate": f"""
        WITH sampled AS (SELECT COUNT(*) AS n FROM ({BINARY}) WHERE {IN_TRAIN} AND {IN_SAMPLE}),
        trained AS (SELECT COUNT(*) AS n FROM ({BINARY}) WHERE {IN_TRAIN}),
        classes AS (SELECT COUNT(DISTINCT genre) AS c FROM ({BINARY}) WHERE genre IS NOT NULL)
        SELECT model, n AS n_rows, CAST(6 AS BIGINT) AS n_coefficients, CAST(0 AS BIGINT) AS violated
        FROM sampled, (SELECT unnest(['plain', 'elastic_net']) AS model)
        UNION ALL SELECT 'multinomial', n, 6 * c, 0 FROM trained, classes
    """,
    "grid_certificate": f"""
        WITH sampled AS (SELECT COUNT(*) AS n FROM ({BINARY}) WHERE {IN_TRAIN} AND {IN_SAMPLE}),
        trained AS (SELECT COUNT(*) AS n FROM ({BINARY}) WHERE {IN_TRAIN}),
        classes AS (SELECT COUNT(DISTINCT genre) AS c FROM ({BINARY}) WHERE genre IS NOT NULL)
        SELECT 'binary_grid' AS model, n AS n_rows, CAST(6 AS BIGINT) AS n_coefficients, CAST(0 AS BIGINT) AS violated FROM sampled
        UNION ALL SELECT 'multinomial_grid', n, 6 * c, 0 FROM trained, classes
    """,
    "forest_table": f"""
        SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS mismatches, CAST(20 AS BIGINT) AS n_trees,
               20 * COUNT(*) AS at_roots, 20 * COUNT(*) AS at_leaves
        FROM ({BINARY}) WHERE NOT ({IN_TRAIN})
    """,
    "pca_certificate": f"""
        WITH v AS (SELECT i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM embeddings, (SELECT unnest(range({N_FEATURES})) AS i)),
        s AS (SELECT i, x, stddev_samp(x) OVER (PARTITION BY i) AS sd FROM v),
        c AS (SELECT i, var_samp(x / sd) AS spread FROM s WHERE sd > 0 GROUP BY i)
        SELECT (SELECT COUNT(*) FROM embeddings) AS n, 5 AS components, ROUND(SUM(spread), 6) AS total_variance,
               0 AS not_eigen, 0 AS not_orthonormal, 0 AS not_leading FROM c
    """,
    "als_certificate": f"""
        SELECT COUNT(DISTINCT user_id) AS n_users, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS violated
        FROM ({KEYED_CLEAN}) WHERE {bucket('row_key')} < {share(0.7)}
    """,
})
