"""DuckDB SQL equivalents of the registered queries (independent oracle).

Tables ``lineitem``, ``embeddings``, ``documents``, ``events`` ... are views
over the same parquet files. Queries whose numbers depend on K-means or PCA
return facts that every right result satisfies; those are checked here.
"""

from __future__ import annotations

from tessera.plans.wide import WIDE_FACTS_SQL, WIDE_MEASURES

LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
TRIM_LO, TRIM_HI = 0.02, 0.98
MIN_VALID = 5
LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag"


def _valid(c: str) -> str:
    return f"(CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) THEN 1 ELSE 0 END)"


N_VALID = " + ".join(_valid(c) for c in WIDE_MEASURES)
IMPUTED = ", ".join(
    f"CASE WHEN {c} IS NULL OR isnan({c}) THEN CAST(0 AS DOUBLE) ELSE {c} END AS {c}" for c in WIDE_MEASURES
)
MEASURES = ", ".join(WIDE_MEASURES)

WIDE = f"wide_facts AS ({WIDE_FACTS_SQL})"
CLEAN = f"clean AS (SELECT l_orderkey, l_linenumber, l_returnflag, {IMPUTED} FROM wide_facts WHERE {N_VALID} >= {MIN_VALID})"
CATALOGUE_CLEAN = (
    "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS _id, "
    f"l_returnflag AS product_name, {IMPUTED} FROM wide_facts WHERE {N_VALID} >= {MIN_VALID}"
)


def _trim_chain(source: str, cols: str) -> str:
    """CTEs t0..t9: sequential exact 0.02/0.98 trim of f1..f9 (bounds from survivors)."""
    parts = [f"t0 AS (SELECT {cols} FROM {source})"]
    for j, f in enumerate(WIDE_MEASURES, start=1):
        parts.append(
            f"b{j} AS (SELECT quantile_disc({f}, {TRIM_LO}) AS lo, quantile_disc({f}, {TRIM_HI}) AS hi FROM t{j - 1})"
        )
        parts.append(f"t{j} AS (SELECT t{j - 1}.* FROM t{j - 1}, b{j} WHERE {f} BETWEEN b{j}.lo AND b{j}.hi)")
    return ", ".join(parts)


LAST_TRIM = f"t{len(WIDE_MEASURES)}"

# Embedding coordinates in long form: (id, i, x); both unnests zip by position.
POINTS = (
    "pts AS (SELECT vec_id AS id, UNNEST(range(len(embedding))) AS i, "
    "CAST(UNNEST(embedding) AS DOUBLE) AS x FROM embeddings)"
)
LABELS = "lab AS (SELECT vec_id AS id, label AS c FROM embeddings)"
CENTRES = "cen AS (SELECT l.c, p.i, avg(p.x) AS m FROM lab l JOIN pts p ON l.id = p.id GROUP BY l.c, p.i)"
DIST2 = (
    "d2 AS (SELECT p.id, ce.c, sum((p.x - ce.m) * (p.x - ce.m)) AS dd "
    "FROM pts p JOIN cen ce ON p.i = ce.i GROUP BY p.id, ce.c)"
)

# Silhouette (squared Euclidean) of assignments asg(k, id, c), one value per k:
# a = mean distance to own cluster * n/(n-1), b = least mean distance to another
# cluster, s = 1-a/b | b/a-1 | 0, singleton clusters score 0.
SILHOUETTE = """
nrm AS (SELECT id, sum(x * x) AS nx FROM pts GROUP BY id),
cst AS (SELECT a.k, a.c, count(*) AS n, sum(nm.nx) AS psi FROM asg a JOIN nrm nm ON a.id = nm.id GROUP BY a.k, a.c),
csm AS (SELECT a.k, a.c, p.i, sum(p.x) AS y FROM asg a JOIN pts p ON a.id = p.id GROUP BY a.k, a.c, p.i),
dts AS (SELECT a.k, a.id, s.c AS oc, sum(p.x * s.y) AS yx
        FROM asg a JOIN pts p ON a.id = p.id JOIN csm s ON s.k = a.k AND s.i = p.i
        GROUP BY a.k, a.id, s.c),
dis AS (SELECT d.k, d.id, d.oc, a.c AS own, cs.n AS n, nm.nx + cs.psi / cs.n - 2 * d.yx / cs.n AS dd
        FROM dts d JOIN asg a ON a.k = d.k AND a.id = d.id
        JOIN nrm nm ON nm.id = d.id JOIN cst cs ON cs.k = d.k AND cs.c = d.oc),
ab AS (SELECT k, id,
              max(CASE WHEN oc = own AND n > 1 THEN dd * n / (n - 1) END) AS a,
              min(CASE WHEN oc <> own THEN dd END) AS b,
              max(CASE WHEN oc = own THEN n END) AS n_own
       FROM dis GROUP BY k, id),
sil AS (SELECT k, avg(CASE WHEN n_own = 1 THEN 0.0 WHEN a < b THEN 1 - a / b
                           WHEN a > b THEN b / a - 1 ELSE 0.0 END) AS silhouette
        FROM ab GROUP BY k)
"""

# Seeded sweep: for k = 2..L, centres are the means of the k smallest labels and
# each row goes to the nearest (ties: lowest label).
SEEDED = f"""
{POINTS}, {LABELS}, {CENTRES}, {DIST2},
rk AS (SELECT c, dense_rank() OVER (ORDER BY c) AS r FROM (SELECT DISTINCT c FROM lab)),
ks AS (SELECT r AS k FROM rk WHERE r >= 2),
cand AS (SELECT ks.k, d2.id, d2.c, d2.dd FROM ks JOIN d2 ON TRUE JOIN rk ON rk.c = d2.c AND rk.r <= ks.k),
ranked AS (SELECT k, id, c, dd, row_number() OVER (PARTITION BY k, id ORDER BY dd, c) AS rn FROM cand),
asg AS (SELECT k, id, c FROM ranked WHERE rn = 1),
cost AS (SELECT k, sum(dd) AS wssse FROM ranked WHERE rn = 1 GROUP BY k),
{SILHOUETTE},
sw AS (SELECT cost.k, cost.wssse, sil.silhouette FROM cost JOIN sil ON cost.k = sil.k)
"""


def _union(template: str, cols) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


ORACLE: dict[str, str] = {
    "parquet_scan": "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
    "parquet_roundtrip": f"WITH {WIDE}, {CLEAN} SELECT * FROM clean",
    "materialize_once": f"WITH {WIDE}, {CLEAN} SELECT * FROM clean",
    "impute_zero": f"WITH {WIDE}, {CLEAN} SELECT * FROM clean",
    "json_nested_scan": f"WITH {WIDE} {CATALOGUE_CLEAN}",
    "csv_tab_scan": f"WITH {WIDE} {CATALOGUE_CLEAN}",
    "csv_comma_scan": f"WITH {WIDE} {CATALOGUE_CLEAN}",
    "first_lines": (
        f"WITH src AS (SELECT * FROM lineitem ORDER BY {LINE_ORDER} LIMIT 20000), "
        f"wide_facts AS ({WIDE_FACTS_SQL.replace('FROM lineitem', 'FROM src')}) "
        "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS _id, "
        "l_returnflag AS product_name, f1, f3, f8 FROM wide_facts"
    ),
    "row_cap": (
        "SELECT least(count(*), 10000) AS n_rows, least(count(*), 10000) AS rows_of_the_table FROM lineitem"
    ),
    "json_quarantine": (
        f"WITH n AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY {LINE_ORDER}) AS number FROM lineitem) "
        "SELECT number, '{broken ' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS text, "
        "(SELECT count(*) FROM lineitem WHERE l_orderkey % 17 <> 0) AS whole_rows FROM n WHERE l_orderkey % 17 = 0"
    ),
    "rename_map": (
        "SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_extendedprice AS extended_price FROM lineitem"
    ),
    "add_missing_cols": (
        f"WITH {WIDE} SELECT l_orderkey, l_linenumber, f1, CAST(NULL AS DOUBLE) AS f7, "
        "CAST(NULL AS DOUBLE) AS f8, CAST(NULL AS DOUBLE) AS f9 FROM wide_facts"
    ),
    "conform_schema": (
        f"WITH {WIDE} SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS _id, "
        "l_returnflag AS product_name, CAST(NULL AS VARCHAR) AS brands, f1, f3 FROM wide_facts"
    ),
    "cast_clean": (
        "SELECT event_id, value, "
        "TRY_CAST(split_part(list_extract(string_split(props, ': '), -1), '}', 1) AS DOUBLE) AS k, "
        "TRY_CAST(event_type AS DOUBLE) AS bad FROM events"
    ),
    "validity_count": (
        f"WITH {WIDE} SELECT n_valid, count(*) AS n_rows FROM (SELECT {N_VALID} AS n_valid FROM wide_facts) v "
        "GROUP BY n_valid"
    ),
    "quality_filter": (
        f"WITH {WIDE} SELECT l_orderkey, l_linenumber, l_returnflag, {N_VALID} AS n_valid "
        f"FROM wide_facts WHERE {N_VALID} >= {MIN_VALID}"
    ),
    "stage_counts": (
        f"WITH {WIDE}, {CLEAN}, {_trim_chain('clean', MEASURES)} "
        "SELECT (SELECT count(*) FROM wide_facts) AS rows_in, "
        f"(SELECT count(*) FROM wide_facts WHERE {N_VALID} >= {MIN_VALID}) AS rows_valid, "
        f"(SELECT count(*) FROM {LAST_TRIM}) AS rows_trimmed"
    ),
    "summary_stats": _union(
        "SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
        "round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, quantile_disc({c}, 0.25) AS p25, "
        "quantile_disc({c}, 0.5) AS p50, quantile_disc({c}, 0.75) AS p75, max({c}) AS max FROM lineitem",
        LINE_MEASURES,
    ),
    "quantile_bounds": _union(
        "SELECT '{c}' AS \"column\", quantile_disc({c}, 0.02) AS lower, quantile_disc({c}, 0.98) AS upper "
        "FROM lineitem",
        LINE_MEASURES,
    ),
    "outlier_trim": (
        f"WITH {WIDE}, {CLEAN}, {_trim_chain('clean', 'l_orderkey, l_linenumber, ' + MEASURES)} "
        f"SELECT * FROM {LAST_TRIM}"
    ),
    "assemble_scale": "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS s_{c}" for c in LINE_MEASURES
    )
    + " FROM lineitem",
    "cov_matrix": "\nUNION ALL\n".join(
        f"SELECT '{a}' AS col_i, '{b}' AS col_j, round(corr({a}, {b}), 6) AS cov FROM lineitem"
        for i, a in enumerate(LINE_MEASURES)
        for b in LINE_MEASURES[i:]
    ),
    "word_count": (
        "SELECT word, count(*) AS count FROM "
        "(SELECT unnest(string_split(text, ' ')) AS word FROM documents) w GROUP BY word"
    ),
    "n_clusters": "SELECT count(DISTINCT label) AS n_clusters FROM embeddings",
    "cluster_sizes": "SELECT label, count(*) AS count FROM embeddings GROUP BY label",
    "cluster_profile": f"WITH {WIDE}, {CLEAN} SELECT l_returnflag, "
    + ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in WIDE_MEASURES)
    + " FROM clean GROUP BY l_returnflag",
    "cluster_minmax": "WITH m AS (SELECT l_returnflag, "
    + ", ".join(f"avg({c}) AS avg_{c}" for c in LINE_MEASURES)
    + " FROM lineitem GROUP BY l_returnflag) SELECT l_returnflag, "
    + ", ".join(
        f"round(CASE WHEN max(avg_{c}) OVER () - min(avg_{c}) OVER () = 0 THEN 0.0 "
        f"ELSE (avg_{c} - min(avg_{c}) OVER ()) / (max(avg_{c}) OVER () - min(avg_{c}) OVER ()) END, 6) AS avg_{c}"
        for c in LINE_MEASURES
    )
    + " FROM m",
    "format_stats": "SELECT l_returnflag, "
    + ", ".join(f"format('{{:,.2f}}', avg({c})) AS avg_{c}" for c in LINE_MEASURES)
    + " FROM lineitem GROUP BY l_returnflag",
    "silhouette": (
        f"WITH {POINTS}, asg AS (SELECT 1 AS k, vec_id AS id, label AS c FROM embeddings), {SILHOUETTE} "
        "SELECT round(silhouette, 6) AS silhouette FROM sil"
    ),
    "cluster_report": (
        f"WITH {POINTS}, asg AS (SELECT 1 AS k, vec_id AS id, label AS c FROM embeddings), {SILHOUETTE} "
        "SELECT label, count(*) AS size, "
        "CAST((SELECT count(DISTINCT label) FROM embeddings) AS INTEGER) AS k, "
        "(SELECT round(silhouette, 6) FROM sil) AS silhouette FROM embeddings GROUP BY label"
    ),
    "assign_nearest": (
        f"WITH {POINTS}, {LABELS}, {CENTRES}, {DIST2} "
        "SELECT id AS vec_id, c AS prediction FROM "
        "(SELECT id, c, row_number() OVER (PARTITION BY id ORDER BY dd, c) AS rn FROM d2) r WHERE rn = 1"
    ),
    "wssse": (
        f"WITH {POINTS}, {LABELS}, {CENTRES}, {DIST2} "
        "SELECT round(sum(d2.dd), 6) AS wssse FROM d2 JOIN lab ON d2.id = lab.id AND d2.c = lab.c"
    ),
    "preview": (
        f"WITH {WIDE}, {CLEAN} SELECT * FROM clean ORDER BY l_orderkey, l_linenumber, l_returnflag, {MEASURES} LIMIT 20"
    ),
    "plain_format": "SELECT l_returnflag, "
    + ", ".join(
        f"format('{{:.2f}}', avg({c})) AS avg_{c}, CAST(format('{{:.2f}}', avg({c})) AS DOUBLE) AS num_avg_{c}"
        for c in LINE_MEASURES
    )
    + " FROM lineitem GROUP BY l_returnflag",
    "cluster_filter": "SELECT vec_id, label FROM embeddings WHERE label = 3",
    # standardised columns: each adds n - 1 to the cost of one cluster, a constant one nothing
    "kmeans_sweep": (
        f"WITH {POINTS}, one AS (SELECT sum(CASE WHEN v > 0 THEN n - 1 ELSE 0 END) AS cost FROM "
        "(SELECT count(*) AS n, var_samp(x) AS v FROM pts GROUP BY i) d) "
        "SELECT CAST(k AS INTEGER) AS k, round(CAST((SELECT cost FROM one) AS DOUBLE), 4) AS one_cluster_cost, "
        "true AS below_one_cluster, true AS nearest_costs_no_more, true AS silhouette_of_nearest, "
        "true AS iterations_in_range FROM range(2, 16) t(k)"
    ),
    "kmeans_fit": (
        "SELECT count(*) AS n_rows, count(DISTINCT label) AS n_centres, CAST(0 AS BIGINT) AS rows_off_nearest "
        "FROM embeddings"
    ),
    "model_roundtrip": (
        "SELECT count(DISTINCT label) AS n_centres, CAST(0 AS DOUBLE) AS largest_change FROM embeddings"
    ),
    "pca_points": (
        "SELECT count(*) AS n_points, CAST(0 AS DOUBLE) AS mean_x, CAST(0 AS DOUBLE) AS mean_y, "
        "CAST(0 AS DOUBLE) AS cov_xy, true AS ordered, CAST(0 AS DOUBLE) AS largest_residual FROM lineitem"
    ),
    "cluster_predictions": (
        f"WITH {WIDE}, {CLEAN}, {_trim_chain('clean', 'l_orderkey, l_linenumber, ' + MEASURES)} "
        f"SELECT *, true AS on_nearest FROM {LAST_TRIM}"
    ),
    "cluster_job": (
        f"WITH {WIDE}, {CLEAN}, {_trim_chain('clean', MEASURES)} "
        "SELECT (SELECT count(*) FROM wide_facts) AS rows_in, (SELECT count(*) FROM clean) AS rows_clean, "
        f"(SELECT count(*) FROM {LAST_TRIM}) AS rows_prepared, (SELECT count(*) FROM {LAST_TRIM}) AS rows_in_clusters, "
        "true AS one_row_a_cluster, true AS silhouette_in_range"
    ),
    "choose_k": (
        f"WITH {SEEDED}, "
        "best AS (SELECT k FROM sw ORDER BY silhouette DESC, k ASC LIMIT 1), "
        "drops AS (SELECT k, lead(wssse) OVER (ORDER BY k) - wssse AS dw FROM sw), "
        "elbow AS (SELECT k FROM drops WHERE dw IS NOT NULL ORDER BY dw, k LIMIT 1) "
        "SELECT CAST((SELECT k FROM best) AS INTEGER) AS k_silhouette, "
        "CAST((SELECT k FROM elbow) AS INTEGER) AS k_elbow, "
        "CAST(CASE WHEN (SELECT k FROM best) <= 3 THEN 4 ELSE (SELECT k FROM best) END AS INTEGER) AS k_final"
    ),
}
