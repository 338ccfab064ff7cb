"""Registered queries: Spark callables ``(spark, sf_dir) -> DataFrame`` over
the driver tables, each with a DuckDB oracle in ``ORACLES`` where SQL can
express it.  Every query reads whole tables (no id subsets, no row caps)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from centrix.functions.tables import register_table_functions
from centrix.operators import assign as A
from centrix.operators import cost as COST
from centrix.operators import metrics as M
from centrix.operators import project as P
from centrix.operators import update as U
from centrix.plans import oracle as O
from centrix.plans.lloyd import fit
from centrix.sources import testdata as td

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---- fixtures ---------------------------------------------------------------

@query("fixture_points64", O.POINTS64)
def q_points64(spark: SparkSession, sf: str) -> DataFrame:
    return td.points64(spark, sf)


@query("fixture_start64", O.START64)
def q_start64(spark, sf):
    return td.start64(spark, sf)


@query("fixture_partition2", O.PARTITION2)
def q_partition2(spark, sf):
    return td.partition2(spark, sf)


@query("dataset_profile_points64",
       f"SELECT count(*) AS n_samples, CAST(max(len(coord)) AS INTEGER) AS n_features, "
       f"(SELECT CAST(count(DISTINCT label) AS INTEGER) FROM ({O.PARTITION64})) AS n_clusters "
       f"FROM ({O.POINTS64})")
def q_profile(spark, sf):
    return M.dataset_info(td.points64(spark, sf), labels=td.partition64(spark, sf))


# ---- assignment and pairs ---------------------------------------------------

def _assign_sql(points: str, start: str) -> str:
    return O.with_([f"pts AS ({points})", f"c1 AS ({start})"],
                   f"SELECT point_id, CAST(cluster_id AS INTEGER) AS cluster_id, dist FROM "
                   f"({O.assign_cte('pts', 'c1')})")


@query("assign_sql_points2", _assign_sql(O.POINTS2, O.START2))
def q_assign_sql(spark, sf):
    return A.assign(td.points2(spark, sf), td.start2(spark, sf), method="sql")


@query("assign_arrow_points64", _assign_sql(O.POINTS64, O.START64))
def q_assign_arrow(spark, sf):
    return A.assign(td.points64(spark, sf), td.start64(spark, sf), method="arrow")


_PAIRS64 = O.with_([f"pts AS ({O.POINTS64})", f"c1 AS ({O.START64})"],
                   f"SELECT p.point_id, CAST(c.cluster_id AS INTEGER) AS cluster_id, "
                   f"{O.sq_dist('p.coord', 'c.coord')} AS dist FROM pts p, c1 c")


@query("pair_distances_points64", _PAIRS64)
def q_pairs(spark, sf):
    return A.pair_distances(td.points64(spark, sf), td.start64(spark, sf))


@query("pair_join_points64", _PAIRS64)
def q_pair_join(spark, sf):
    pts, start = A.co_partitioned(td.points64(spark, sf)), td.start64(spark, sf)
    return A.pair_distances_joined(A.all_pairs(pts, start), pts, start)


@query("min_dist_points2", O.with_(
    [f"pts AS ({O.POINTS2})", f"c1 AS ({O.START2})"],
    f"SELECT p.point_id, min({O.sq_dist('p.coord', 'c.coord')}) AS dist FROM pts p, c1 c GROUP BY p.point_id"))
def q_min_dist(spark, sf):
    return A.min_dist(td.points2(spark, sf), td.start2(spark, sf))


@query("nearest_ties_points2", O.with_(
    [f"pts AS ({O.POINTS2})", f"c1 AS ({O.START2})",
     f"dd AS (SELECT p.point_id, c.cluster_id, {O.sq_dist('p.coord', 'c.coord')} AS dist FROM pts p, c1 c)"],
    "SELECT d.point_id, CAST(d.cluster_id AS INTEGER) AS cluster_id, d.dist FROM dd d JOIN "
    "(SELECT point_id, min(dist) AS md FROM dd GROUP BY point_id) m "
    "ON d.point_id = m.point_id AND d.dist = m.md"))
def q_ties(spark, sf):
    return A.nearest_all_ties(td.points2(spark, sf), td.start2(spark, sf))


@query("distinct_points2",
       f"SELECT coord, count(*) AS w, min(point_id) AS point_id FROM ({O.POINTS2}) GROUP BY coord")
def q_distinct(spark, sf):
    return A.distinct_points(td.points2(spark, sf))


# ---- update and cost --------------------------------------------------------

def _one_step(points: str, start: str, body: str) -> str:
    return O.with_([f"pts AS ({points})", f"c1 AS ({start})", f"a1 AS ({O.assign_cte('pts', 'c1')})"], body)


@query("cluster_sums_points2", _one_step(
    O.POINTS2, O.START2,
    "SELECT CAST(cluster_id AS INTEGER) AS cluster_id, count(*) AS n, "
    "[CAST(sum(coord[1]) AS BIGINT), CAST(sum(coord[2]) AS BIGINT)] AS sums FROM a1 GROUP BY cluster_id"))
def q_sums(spark, sf):
    a = A.assign(td.points2(spark, sf), td.start2(spark, sf), keep_coord=True)
    return U.cluster_sums(a, 2)


@query("update_points64", O.with_(
    [f"pts AS ({O.POINTS64})", f"c1 AS ({O.START64})", f"a1 AS ({O.assign_cte('pts', 'c1')})",
     f"c2 AS ({O.update_cte('a1', 'c1', 64)})"],
    "SELECT CAST(c.cluster_id AS INTEGER) AS cluster_id, CAST(coalesce(m.n, 0) AS BIGINT) AS n, c.coord "
    "FROM c2 c LEFT JOIN (SELECT cluster_id, count(*) AS n FROM a1 GROUP BY cluster_id) m USING (cluster_id)"))
def q_update(spark, sf):
    pts, start = td.points64(spark, sf), td.start64(spark, sf)
    return U.update_centroids(A.assign(pts, start, method="arrow", keep_coord=True), start)


@query("cluster_cost_points2", _one_step(
    O.POINTS2, O.START2,
    "SELECT CAST(cluster_id AS INTEGER) AS cluster_id, count(*) AS n, "
    "sum(CAST(dist AS DECIMAL(38, 6))) AS cost FROM a1 GROUP BY cluster_id"))
def q_cost(spark, sf):
    return COST.cluster_cost(A.assign(td.points2(spark, sf), td.start2(spark, sf)))


@query("members_points2", _one_step(
    O.POINTS2, O.START2,
    "SELECT point_id, CAST(cluster_id AS INTEGER) AS cluster_id, dist FROM a1 WHERE cluster_id = 1"))
def q_members(spark, sf):
    return P.members(A.assign(td.points2(spark, sf), td.start2(spark, sf)), 1)


# ---- projections ------------------------------------------------------------

@query("spread_points2", f"SELECT point_id, coord[1] AS x_0, coord[2] AS x_1 FROM ({O.POINTS2})")
def q_spread(spark, sf):
    return P.spread(td.points2(spark, sf), 2)


@query("feature_points64", f"SELECT point_id, coord[6] AS x_5 FROM ({O.POINTS64})")
def q_feature(spark, sf):
    return P.feature(td.points64(spark, sf), 5)


# ---- training ---------------------------------------------------------------

@query("lloyd_centroids_points64", O.lloyd_centroids(O.POINTS64, O.START64, 4, 64))
def q_lloyd64(spark, sf):
    return fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=4).centroids()


@query("lloyd_labels_points2", O.lloyd_labels(O.POINTS2, O.START2, 3, 2))
def q_lloyd_labels2(spark, sf):
    return fit(td.points2(spark, sf), td.start2(spark, sf), max_iter=3).labels()


@query("lloyd_collapsed_points2", O.lloyd_centroids(O.POINTS2, O.START2, 3, 2))
def q_lloyd_collapsed(spark, sf):
    """Training on distinct coordinates weighted by multiplicity (A10 + K1)."""
    return fit(td.points2(spark, sf), td.start2(spark, sf), max_iter=3, collapse_duplicates=True).centroids()


@query("smoke_points2", O.lloyd_centroids(O.POINTS2, O.START2, 2, 2))
def q_smoke(spark, sf):
    from centrix.plans.lloyd import smoke
    return smoke(td.points2(spark, sf), td.start2(spark, sf))


def exact_cost_curve(res) -> DataFrame:
    """(iter, cost DECIMAL) recomputed from the centroid history: one union
    of per-iteration label passes over the persisted blocks, then one
    aggregate keyed by iteration."""
    labels = res.labels_at([it for it, _, _, _ in res.history])
    return labels.groupBy(F.col("iter").cast("int").alias("iter")).agg(
        F.sum(F.col("dist").cast(COST.COST_TYPE)).alias("cost"))


@query("lloyd_cost_curve_points64", O.lloyd_costs(O.POINTS64, O.START64, 4, 64))
def q_costs(spark, sf):
    return exact_cost_curve(fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=4))


@query("lloyd_costs_points64", f"SELECT iter, CAST(cost AS DECIMAL(38, 2)) AS cost FROM ({O.lloyd_costs(O.POINTS64, O.START64, 4, 64)})")
def q_kernel_costs(spark, sf):
    """K3 as the training passes measured it, no pass of its own."""
    return fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=4).costs().select("iter", F.col("cost").cast("decimal(38,2)").alias("cost"))


@query("cost_reduction_points64", O.with_(
    O.lloyd_ctes(O.POINTS64, O.START64, 4, 64) +
    [f"cc AS ({' UNION ALL '.join(f'SELECT {i} AS iter, sum(CAST(dist AS DECIMAL(38, 6))) AS cost FROM a{i}' for i in range(1, 5))})",
     "l2 AS (SELECT CAST(cost AS DOUBLE) AS c, lag(CAST(cost AS DOUBLE)) OVER (ORDER BY iter) AS p, iter FROM cc)"],
    "SELECT CAST(round((p - c) / p * 100, 2) AS DECIMAL(10, 2)) AS cost_reduction_pct FROM l2 "
    "WHERE iter = (SELECT max(iter) FROM cc)"))
def q_cost_reduction(spark, sf):
    curve = exact_cost_curve(fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=4))
    return M.cost_reduction(curve)


def _scored64(iters: int) -> list[str]:
    return O.lloyd_ctes(O.POINTS64, O.START64, iters, 64) + [
        f"j AS (SELECT a.point_id, a.cluster_id, t.label FROM a{iters} a JOIN ({O.PARTITION64}) t USING (point_id))",
        "cont AS (SELECT label, CAST(cluster_id AS INTEGER) AS cluster_id, count(*) AS n FROM j GROUP BY label, cluster_id)"]


@query("contingency_points64", O.with_(_scored64(4), "SELECT * FROM cont"))
def q_contingency(spark, sf):
    res = fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=4)
    return M.contingency(M.join_truth(res.labels(), td.partition64(spark, sf)))


_NMI_BODY = (
    "SELECT CAST(CASE WHEN ka = 1 AND kb = 1 THEN 1.0 WHEN mi <= 0 THEN 0.0 ELSE mi / ((ha + hb) / 2.0) END "
    "AS DECIMAL(12, 6)) AS nmi FROM (SELECT "
    "sum(n / tot * ln(tot * n / (na * nb))) AS mi, "
    "-sum(CASE WHEN fa THEN na / tot * ln(na / tot) END) AS ha, "
    "-sum(CASE WHEN fb THEN nb / tot * ln(nb / tot) END) AS hb, "
    "sum(CAST(fa AS INTEGER)) AS ka, sum(CAST(fb AS INTEGER)) AS kb FROM ("
    "SELECT CAST(n AS DOUBLE) AS n, CAST(sum(n) OVER () AS DOUBLE) AS tot, "
    "CAST(sum(n) OVER (PARTITION BY label) AS DOUBLE) AS na, "
    "CAST(sum(n) OVER (PARTITION BY cluster_id) AS DOUBLE) AS nb, "
    "row_number() OVER (PARTITION BY label ORDER BY cluster_id) = 1 AS fa, "
    "row_number() OVER (PARTITION BY cluster_id ORDER BY label) = 1 AS fb FROM cont))")


@query("nmi_points64", O.with_(_scored64(4), _NMI_BODY))
def q_nmi(spark, sf):
    res = fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=4)
    return M.nmi(M.join_truth(res.labels(), td.partition64(spark, sf))) \
        .select(F.col("nmi").cast("decimal(12,6)").alias("nmi"))


@query("vector_mean_points64", _one_step(
    O.POINTS64, O.START64,
    "SELECT CAST(cluster_id AS BIGINT) AS cluster_id, CAST(count(*) AS BIGINT) AS n, ["
    + ", ".join(f"CAST(sum(coord[{j}]) AS DOUBLE) / count(*)" for j in range(1, 65)) + "] AS mean FROM a1 GROUP BY cluster_id"))
def q_vector_mean(spark, sf):
    """The vector mean as SQL text, whatever the width."""
    register_table_functions(spark)
    A.assign(td.points64(spark, sf), td.start64(spark, sf), keep_coord=True).createOrReplaceTempView("centrix_assigned")
    return spark.sql(
        "SELECT cluster_id, n, mean FROM vector_mean(TABLE("
        "SELECT cluster_id, col, limb, sum(v) AS v FROM vector_sums(TABLE(SELECT cluster_id, coord FROM centrix_assigned)) "
        "GROUP BY cluster_id, col, limb) PARTITION BY cluster_id)")


# ---- seeding, sampling, order -----------------------------------------------

from centrix.functions.hashrand import stream as _stream  # noqa: E402
from centrix.operators import expand as X  # noqa: E402
from centrix.operators import seed as S  # noqa: E402
from centrix.session import scratch_path  # noqa: E402
from centrix.sources.text import load_points, write_points  # noqa: E402

SEED = 222


@query("kmeanspp_points64", O.kmeanspp_sql(O.POINTS64, 3, SEED, 3))
def q_kpp64(spark, sf):
    return S.kmeanspp(td.points64(spark, sf), 3, seed=SEED)


@query("kmeanspp_points2", O.kmeanspp_sql(O.POINTS2, 5, SEED, 3))
def q_kpp2(spark, sf):
    return S.kmeanspp(td.points2(spark, sf), 5, seed=SEED, checkpoint_every=2)


@query("uniform_pick_points2",
       f"SELECT point_id, coord FROM ({O.POINTS2}) ORDER BY {O.uniform_u(_stream(SEED, 0, 0), 'point_id')}, "
       f"point_id LIMIT 1")
def q_uniform(spark, sf):
    return S.uniform_pick(td.points2(spark, sf), SEED)


def _w2(spark, sf):
    return td.points2(spark, sf).select("point_id", F.col("coord")[1].cast("double").alias("w"))


_W2 = f"SELECT point_id, CAST(coord[2] AS DOUBLE) AS w FROM ({O.POINTS2})"


@query("race_pick_points2", O.with_(
    [f"w AS ({_W2})",
     "r AS (SELECT tt.t AS trial, w.point_id, -ln(" + O.uniform("tt.st", "w.point_id") +
     ") / w.w AS key FROM w, (VALUES " + ", ".join(f"({t}, {_stream(SEED, 1, t)})" for t in (1, 2, 3)) +
     ") tt(t, st) WHERE w.w > 0)"],
    "SELECT CAST(trial AS INTEGER) AS trial, point_id FROM (SELECT *, row_number() OVER "
    "(PARTITION BY trial ORDER BY key, point_id) AS rn FROM r) WHERE rn = 1"))
def q_race(spark, sf):
    return S.weighted_pick_race(_w2(spark, sf), "w", SEED, 1, 3)


def _cdf_u() -> float:
    import numpy as np

    from centrix.functions.hashrand import np_hash_uniform
    return float(np_hash_uniform(_stream(SEED, 9, 1), np.array([0]))[0])


@query("cdf_pick_points2", O.with_(
    [f"w AS ({_W2})",
     "c AS (SELECT point_id, sum(w) OVER (ORDER BY point_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
     "AS cdf FROM w)"],
    f"SELECT coalesce((SELECT min(point_id) FROM c WHERE cdf >= {_cdf_u()!r} * (SELECT sum(w) FROM w)), "
    f"(SELECT max(point_id) FROM w)) AS point_id"))
def q_cdf_pick(spark, sf):
    """T5 parity form: first row whose running sum reaches u * total."""
    return S.weighted_pick_cdf(_w2(spark, sf), "w", _cdf_u())


@query("running_cdf_points2",
       f"SELECT point_id, w, sum(w) OVER (ORDER BY point_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
       f"AS cdf FROM ({_W2})")
def q_cdf(spark, sf):
    return S.running_cdf(_w2(spark, sf), "w").select("point_id", "w", "cdf")


@query("shuffle_points2",
       f"SELECT point_id, {O.uniform_u(O.stream(SEED, 3), 'point_id')} AS shuffle_key FROM ({O.POINTS2})")
def q_shuffle(spark, sf):
    return X.shuffle_rows(td.points2(spark, sf), SEED).select("point_id", "shuffle_key")


@query("shuffle_order_points64",
       f"SELECT row_number() OVER (ORDER BY {O.uniform_u(O.stream(SEED, 3), 'point_id')}, point_id) AS place, point_id "
       f"FROM ({O.POINTS64})")
def q_shuffle_order(spark, sf):
    """T3 with every row's place in the order."""
    return X.shuffled_places(td.points64(spark, sf), SEED).select("place", "point_id")


@query("true_centroids_points64", O.true_centroids_sql(O.POINTS64, O.PARTITION64, 64))
def q_true64(spark, sf):
    return X.true_centroids_from_labels(td.points64(spark, sf), td.partition64(spark, sf))


@query("expand_points64", O.expand_sql(O.POINTS64, O.PARTITION64, 64, SEED))
def q_expand(spark, sf):
    pts, lab = td.points64(spark, sf), td.partition64(spark, sf)
    n = pts.count()
    out, out_lab = X.expand(pts, lab, X.true_centroids_from_labels(pts, lab), 2 * n, seed=SEED)
    return out.join(out_lab, "point_id").select("point_id", "coord", "label")


# labels with gaps: true label 3 * label - 2
_GAP64 = O.PARTITION64.replace("label + 1", "3 * label + 1")


@query("expand_gap_points64", O.expand_sql(O.POINTS64, _GAP64, 64, SEED))
def q_expand_gap(spark, sf):
    """T7 over labels with gaps: new rows carry their centroid's cluster id."""
    pts = td.points64(spark, sf)
    lab = td.partition64(spark, sf).select("point_id", (F.col("label") * 3 - 2).alias("label"))
    out, out_lab = X.expand(pts, lab, X.true_centroids_from_labels(pts, lab), 2 * pts.count(), seed=SEED)
    return out.join(out_lab, "point_id").select("point_id", "coord", "label")


# ---- text files ---------------------------------------------------------------

@query("text_roundtrip_points2",
       f"SELECT row_number() OVER (ORDER BY point_id) AS point_id, coord FROM ({O.POINTS2})")
def q_text(spark, sf):
    path = scratch_path(spark, "points2-text")
    write_points(td.points2(spark, sf), path)
    return load_points(spark, path)


# ---- more projections, functions and histories -------------------------------

from centrix.functions.text import parse_json_array  # noqa: E402
from centrix.functions.vector import register_sql_functions, sq_norm  # noqa: E402
from centrix.plans.runs import score_record  # noqa: E402


@query("vector_length_points64", f"SELECT CAST(len(coord) AS INTEGER) AS d FROM ({O.POINTS64}) LIMIT 1")
def q_veclen(spark, sf):
    return P.vector_length(td.points64(spark, sf))


@query("prefix_points64", f"SELECT point_id, coord[1:2] AS coord FROM ({O.POINTS64})")
def q_prefix(spark, sf):
    return P.prefix(td.points64(spark, sf), 2)


@query("flatten_points2", _one_step(
    O.POINTS2, O.START2, "SELECT coord[1] AS x_0, coord[2] AS x_1, CAST(cluster_id AS INTEGER) AS cluster_id FROM a1"))
def q_flatten(spark, sf):
    return P.flatten_assignment(A.assign(td.points2(spark, sf), td.start2(spark, sf), keep_coord=True), 2)


@query("assign_blocked_points64", _assign_sql(O.POINTS64, O.START64))
def q_assign_blocked(spark, sf):
    return A.assign_blocked(td.points64(spark, sf), td.start64(spark, sf), block_rows=3)


@query("sq_norm_points2",
       f"SELECT point_id, list_reduce(list_transform(coord, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), "
       f"lambda acc, t: acc + t) AS norm2 FROM ({O.POINTS2})")
def q_norm(spark, sf):
    return td.points2(spark, sf).select("point_id", sq_norm("coord").alias("norm2"))


@query("sq_dist_sql_function_points2",
       f"SELECT point_id, {O.sq_dist('coord', 'list_reverse(coord)')} AS dist FROM ({O.POINTS2})")
def q_sqdist_sql(spark, sf):
    register_sql_functions(spark)
    td.points2(spark, sf).createOrReplaceTempView("centrix_points2")
    return spark.sql("SELECT point_id, sq_dist(CAST(coord AS ARRAY<DOUBLE>), CAST(reverse(coord) AS ARRAY<DOUBLE>)) "
                     "AS dist FROM centrix_points2")


@query("nearest_sql_function_points2", _assign_sql(O.POINTS2, O.START2))
def q_nearest_sql(spark, sf):
    register_sql_functions(spark)
    td.points2(spark, sf).createOrReplaceTempView("centrix_points2")
    td.start2(spark, sf).createOrReplaceTempView("centrix_start2")
    return spark.sql(
        "SELECT point_id, b.cluster_id AS cluster_id, b.dist AS dist FROM ("
        "SELECT point_id, nearest_centroid(CAST(coord AS ARRAY<DOUBLE>), "
        "(SELECT array_sort(collect_list(struct(cluster_id, coord))) FROM centrix_start2)) AS b "
        "FROM centrix_points2)")


@query("parse_json_points2", f"SELECT point_id, CAST(coord AS DOUBLE[]) AS coord FROM ({O.POINTS2})")
def q_json(spark, sf):
    text = td.points2(spark, sf).select(
        "point_id", F.concat(F.lit("["), F.array_join("coord", ",\n "), F.lit("]")).alias("txt"))
    return text.select("point_id", parse_json_array("txt").alias("coord"))


@query("catalogue_fixtures", (
    f"SELECT 'embeddings64' AS dataset, count(*) AS n_samples, CAST(max(len(coord)) AS INTEGER) AS n_features, "
    f"(SELECT CAST(count(DISTINCT label) AS INTEGER) FROM ({O.PARTITION64})) AS n_clusters FROM ({O.POINTS64}) "
    f"UNION ALL SELECT 'events2', count(*), CAST(max(len(coord)) AS INTEGER), "
    f"(SELECT CAST(count(DISTINCT label) AS INTEGER) FROM ({O.PARTITION2})) FROM ({O.POINTS2})"))
def q_catalogue(spark, sf):
    a = M.dataset_info(td.points64(spark, sf), labels=td.partition64(spark, sf))
    b = M.dataset_info(td.points2(spark, sf), labels=td.partition2(spark, sf))
    return a.select(F.lit("embeddings64").alias("dataset"), "*").unionByName(
        b.select(F.lit("events2").alias("dataset"), "*"))


@query("labels_history_points2", O.with_(
    O.lloyd_ctes(O.POINTS2, O.START2, 3, 2),
    "SELECT * FROM (SELECT 1 AS iter, point_id, CAST(cluster_id AS INTEGER) AS cluster_id, dist FROM a1 "
    "UNION ALL SELECT 3, point_id, CAST(cluster_id AS INTEGER), dist FROM a3)"))
def q_label_hist(spark, sf):
    res = fit(td.points2(spark, sf), td.start2(spark, sf), max_iter=3)
    return res.labels_at([1, 3]).select(F.col("iter").cast("int").alias("iter"), "point_id", "cluster_id", "dist")


@query("centroid_history_points64", O.with_(
    O.lloyd_ctes(O.POINTS64, O.START64, 3, 64),
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT {i} AS iter, CAST(c.cluster_id AS INTEGER) AS cluster_id, CAST(coalesce(m.n, 0) AS BIGINT) AS n, "
        f"c.coord FROM c{i} c LEFT JOIN (SELECT cluster_id, count(*) AS n FROM a{i} GROUP BY cluster_id) m "
        f"USING (cluster_id)" for i in (1, 2, 3)) + ")"))
def q_cent_hist(spark, sf):
    return fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=3).centroid_history()


@query("score_record_points64", O.with_(
    _scored64(4),
    "SELECT 'embeddings64' AS dataset, (SELECT count(*) FROM pts) AS n_samples, "
    "(SELECT CAST(max(len(coord)) AS INTEGER) FROM pts) AS n_features, "
    f"(SELECT CAST(count(DISTINCT label) AS INTEGER) FROM ({O.PARTITION64})) AS n_clusters, "
    "CAST(NULL AS DOUBLE) AS training_time_ms, nmi FROM (" + _NMI_BODY + ")"))
def q_score(spark, sf):
    pts, lab = td.points64(spark, sf), td.partition64(spark, sf)
    res = fit(pts, td.start64(spark, sf), max_iter=4)
    rec = score_record("embeddings64", pts, lab, res.labels())
    return rec.withColumn("nmi", F.col("nmi").cast("decimal(12,6)"))



# ---- run history over data-derived sets (measured times: rows-only checks) -----

from centrix.operators.history import combine_times  # noqa: E402
from centrix.operators.report import by_sample_size  # noqa: E402
from centrix.plans.runs import time_fits, train_many, write_dataset  # noqa: E402


@query("run_history_fixtures")
def q_run_history(spark, sf):
    """K4 end to end: both fixture sets written as text data sets, one trained,
    then the job resumes and trains only the one not yet recorded."""
    root = scratch_path(spark, "datasets")
    write_dataset(root, "embeddings64", td.points64(spark, sf), td.partition64(spark, sf),
                  start=td.start64(spark, sf))
    write_dataset(root, "events2", td.points2(spark, sf), td.partition2(spark, sf), start=td.start2(spark, sf))
    hist = scratch_path(spark, "history")
    train_many(spark, root, ["embeddings64"], hist, max_iter=5)
    return train_many(spark, root, ["embeddings64", "events2"], hist, max_iter=5)


@query("timing_report_fixtures")
def q_timing_report(spark, sf):
    """J7 + K6: per-system training times joined to the catalogue by name,
    then one (family, system, n_samples, time_ms) series per family."""
    sets = {"embeddings64": (td.points64(spark, sf), td.start64(spark, sf)),
            "events2": (td.points2(spark, sf), td.start2(spark, sf))}
    per_system = {m: spark.createDataFrame(time_fits(sets, 5, m), "dataset STRING, time DOUBLE")
                  for m in ("arrow", "sql")}
    combined = combine_times(q_catalogue(spark, sf), per_system)
    return by_sample_size(combined, ["embeddings", "events"])



# ---- names -------------------------------------------------------------------

from centrix.functions.text import dataset_name  # noqa: E402

# A family and its enlargements are named base, base+'e1', 'e2', 'e3'.
FAMILY_SUFFIXES = ["", "e1", "e2", "e3"]


@query("dataset_names_events", (
    "SELECT concat(t.event_type, s.suffix) AS dataset FROM (SELECT DISTINCT event_type FROM events) t, "
    "(SELECT unnest(['" + "', '".join(FAMILY_SUFFIXES) + "']) AS suffix) s"))
def q_names(spark, sf):
    """data-set names of each event-type family with its enlargements
    (the suffix list is a literal exploded per row, no join)."""
    types = td.table(spark, sf, "events").select("event_type").distinct()
    fams = types.select("event_type", F.explode(F.array(*[F.lit(x) for x in FAMILY_SUFFIXES])).alias("suffix"))
    return fams.select(dataset_name("event_type", F.col("suffix")).alias("dataset"))


# ---- run histories derived from the events table -----------------------------
# A data set is an event type with an enlargement suffix (user_id % 4), a system
# is user_id % 3, and a run's time is an exact sum; sys2 has no run of the e3 sets.

from centrix.operators import history as H  # noqa: E402
from centrix.operators import report as R  # noqa: E402
from centrix.plans import runs as RUNS  # noqa: E402
from centrix.sources import csv as CSV  # noqa: E402
from centrix.sources import dataset as DS  # noqa: E402
from centrix.sources import tables as TBL  # noqa: E402
from centrix.sources import text as TXT  # noqa: E402

SYSTEMS = ["sys0", "sys1", "sys2"]
_SUFFIX_SQL = "['" + "', '".join(FAMILY_SUFFIXES) + "']"
_EVENTS = ("SELECT concat(event_type, list_extract(" + _SUFFIX_SQL + ", CAST(user_id % 4 + 1 AS INT))) AS dataset, "
           "concat('sys', user_id % 3) AS system, user_id, length(event_type) AS width, "
           "CAST(round(value * 100.0) AS BIGINT) AS cents FROM events")
_RUNS = f"SELECT dataset, system, CAST(sum(cents) AS DOUBLE) AS time FROM ({_EVENTS}) WHERE NOT (system = 'sys2' AND dataset LIKE '%e3') GROUP BY ALL"
_SETS = (f"SELECT dataset, count(*) AS n_samples, CAST(max(width) AS INTEGER) AS n_features, "
         f"CAST(count(DISTINCT user_id) AS INTEGER) AS n_clusters FROM ({_EVENTS}) GROUP BY dataset")
_WIDE = f"SELECT s.*, {', '.join(f'(SELECT r.time FROM runs r WHERE r.dataset = s.dataset AND r.system = {chr(39)}{x}{chr(39)}) AS {x}' for x in SYSTEMS)} FROM sets s"
_HISTORY = [f"runs AS ({_RUNS})", f"sets AS ({_SETS})", f"wide AS ({_WIDE})"]
_LONG = "SELECT dataset, n_samples, n_features, unnest(['sys0', 'sys1', 'sys2']) AS system, unnest([sys0, sys1, sys2]) AS time_ms FROM wide"


def _events(spark, sf) -> DataFrame:
    suffix = F.element_at(F.array(*[F.lit(x) for x in FAMILY_SUFFIXES]), (F.col("user_id") % 4 + 1).cast("int"))
    return td.table(spark, sf, "events").select(
        dataset_name("event_type", suffix).alias("dataset"), F.concat(F.lit("sys"), F.col("user_id") % 3).alias("system"),
        "user_id", "event_type", F.length("event_type").alias("width"), F.round(F.col("value") * 100.0).cast("bigint").alias("cents"))


def _sets(spark, sf) -> DataFrame:
    return _events(spark, sf).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_samples"), F.max("width").cast("int").alias("n_features"), F.countDistinct("user_id").cast("int").alias("n_clusters"))


def _times(spark, sf, system: str) -> DataFrame:
    e = _events(spark, sf).where(F.col("system") == system)
    if system == "sys2":
        e = e.where(~F.col("dataset").endswith("e3"))
    return e.groupBy("dataset").agg(F.sum("cents").cast("double").alias("time"))


def _combined(spark, sf) -> DataFrame:
    return combine_times(_sets(spark, sf), {x: _times(spark, sf, x) for x in SYSTEMS})


@query("combined_times_events", O.with_(_HISTORY, "SELECT * FROM wide"))
def q_combined(spark, sf):
    """The catalogue with one time column per system, by name."""
    return _combined(spark, sf)


@query("pending_events", O.with_(_HISTORY, "SELECT dataset FROM wide WHERE sys2 IS NULL"))
def q_pending(spark, sf):
    """Data sets that sys2 has no record of."""
    return H.pending(_sets(spark, sf).select("dataset"), _times(spark, sf, "sys2"))


@query("appended_records_events", O.with_(_HISTORY, "SELECT dataset, time FROM runs WHERE system <> 'sys2'"))
def q_appended(spark, sf):
    """One system's records appended to another's."""
    return H.append_record(_times(spark, sf, "sys0"), _times(spark, sf, "sys1"))


@query("side_by_side_events", O.with_(_HISTORY, "SELECT dataset, sys0 AS time_0, sys2 AS time_2 FROM wide WHERE sys2 IS NOT NULL AND sys0 IS NOT NULL"))
def q_side_by_side(spark, sf):
    """Two histories next to each other, aligned by name."""
    a, b = (_times(spark, sf, x).withColumnRenamed("time", f"time_{x[-1]}") for x in ("sys0", "sys2"))
    return H.side_by_side(a, b, "dataset")


@query("report_by_size_events", O.with_(
    _HISTORY + [f"long AS ({_LONG})", "fam AS (SELECT DISTINCT event_type AS family FROM events)"],
    "SELECT f.family, l.system, l.n_samples, l.time_ms FROM long l JOIN fam f ON contains(l.dataset, f.family) WHERE l.time_ms IS NOT NULL"))
def q_by_size(spark, sf):
    """K6: n_samples -> time per family and system."""
    families = [r[0] for r in td.table(spark, sf, "events").select("event_type").distinct().collect()]   # a few names
    return R.by_sample_size(_combined(spark, sf), families)


@query("report_by_dimension_events", O.with_(
    _HISTORY + [f"long AS ({_LONG})"],
    "SELECT n_samples, system, n_features, time_ms FROM long WHERE time_ms IS NOT NULL AND n_samples IN (SELECT max(n_samples) FROM sets UNION SELECT min(n_samples) FROM sets)"))
def q_by_dimension(spark, sf):
    """K7: n_features -> time for the smallest and the largest sample size."""
    sizes = _sets(spark, sf).agg(F.min("n_samples"), F.max("n_samples")).first()
    return R.by_dimension(_combined(spark, sf), list(sizes))


@query("matching_names_events", O.with_(_HISTORY, "SELECT * FROM sets WHERE contains(dataset, 'e1')"))
def q_matching(spark, sf):
    """P5: names that hold a text."""
    return R.matching(_sets(spark, sf), "e1")


@query("other_names_events", O.with_(_HISTORY, "SELECT * FROM sets WHERE NOT contains(dataset, 'e1')"))
def q_not_matching(spark, sf):
    """P5: names that don't."""
    return R.matching(_sets(spark, sf), "e1", keep=False)


@query("largest_sets_events", O.with_(_HISTORY, "SELECT * FROM sets WHERE n_samples = (SELECT max(n_samples) FROM sets)"))
def q_with_samples(spark, sf):
    """Sets of exactly the largest size."""
    sets = _sets(spark, sf)
    return R.with_samples(sets, sets.agg(F.max("n_samples")).first()[0])


@query("system_columns_events", O.with_(_HISTORY, "SELECT sys0, sys1, sys2 FROM wide"))
def q_systems(spark, sf):
    """The columns after the catalogue's."""
    wide = _combined(spark, sf)
    return wide.select(*R.system_columns(wide))


@query("history_csv_events", O.with_(_HISTORY, "SELECT dataset, time FROM runs WHERE system = 'sys0'"))
def q_history_csv(spark, sf):
    """S9 + S10: a history written as CSV in two appends, read back."""
    path = scratch_path(spark, "history-csv")
    t = _times(spark, sf, "sys0")
    CSV.write_history(t.where(F.col("dataset") < "m"), path, mode="append")
    CSV.write_history(t.where(F.col("dataset") >= "m"), path, mode="append")
    return CSV.read_history(spark, path)


@query("trained_once_fixtures",
       "SELECT unnest(['embeddings64', 'events2']) AS dataset, CAST(1 AS BIGINT) AS n_runs, true AS timed")
def q_trained_once(spark, sf):
    """K4 without its clock: a job that resumes trains each set exactly once."""
    return q_run_history(spark, sf).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_runs"), (F.min("time") > 0).alias("timed"))


# ---- iterations, saved results, data sets ------------------------------------

_COSTS3 = O.lloyd_costs(O.POINTS64, O.START64, 3, 64)


@query("chosen_iterations_points64", f"SELECT * FROM ({_COSTS3}) WHERE iter IN (1, 3)")
def q_chosen(spark, sf):
    """The asked-for iterations of a history."""
    return R.select_iterations(exact_cost_curve(fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=3)), [1, 3])


@query("last_iteration_points64", f"SELECT cost FROM ({_COSTS3}) WHERE iter = 3")
def q_last(spark, sf):
    """The value at the last iteration."""
    return R.last_iteration(exact_cost_curve(fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=3)), "cost")


@query("saved_labels_text_points2", O.lloyd_labels(O.POINTS2, O.START2, 2, 2))
def q_saved_text(spark, sf):
    """S6 + S7 as text: labels saved and read back."""
    path = scratch_path(spark, "saved-text")
    res = fit(td.points2(spark, sf), td.start2(spark, sf), max_iter=2)
    TXT.write_output(path, labels=res.labels(), fmt="text")
    res.unpersist()
    return TXT.load_output(spark, path, fmt="text")["label"]


@query("saved_history_points2", O.with_(
    O.lloyd_ctes(O.POINTS2, O.START2, 2, 2),
    "SELECT * FROM (SELECT 1 AS iter, point_id, CAST(cluster_id AS INTEGER) AS cluster_id, dist FROM a1 "
    "UNION ALL SELECT 2, point_id, CAST(cluster_id AS INTEGER), dist FROM a2)"))
def q_saved_history(spark, sf):
    """K2 as a saved table: labels of every iteration, as Parquet."""
    path = scratch_path(spark, "saved-history")
    res = fit(td.points2(spark, sf), td.start2(spark, sf), max_iter=2)
    TXT.write_output(path, history=res.labels_at([1, 2]).withColumn("iter", F.col("iter").cast("int")))
    res.unpersist()
    return TXT.load_output(spark, path)["history"]


@query("scored_output_points64", O.with_(
    _scored64(3) + [
        "cc AS (" + " UNION ALL ".join(f"SELECT {i} AS iter, sum(dist) AS cost FROM a{i}" for i in (1, 2, 3)) + ")",
        "l2 AS (SELECT cost AS c, lag(cost) OVER (ORDER BY iter) AS p, iter FROM cc)"],
    "SELECT CAST(round((SELECT nmi FROM (" + _NMI_BODY.replace("AS DECIMAL(12, 6)", "AS DOUBLE") + ")), 4) AS DECIMAL(8, 4)) AS nmi, "
    "CAST(round((p - c) / p * 100, 2) AS DECIMAL(10, 2)) AS cost_reduction_pct FROM l2 WHERE iter = 3"))
def q_scored(spark, sf):
    """A saved result scored in one step: NMI at 4 places, cost drop at 2."""
    path = scratch_path(spark, "saved-score")
    res = fit(td.points64(spark, sf), td.start64(spark, sf), max_iter=3)
    TXT.write_output(path, labels=res.labels(), costs=res.costs(), centroids=res.centroids(), fmt="text")
    res.unpersist()
    return RUNS.score_output(spark, path, td.partition64(spark, sf), fmt="text").withColumn("nmi", F.col("nmi").cast("decimal(8,4)"))


@query("data_set_roles_points64", (
    f"SELECT 'set64' AS dataset, 'points' AS role, count(*) AS n, CAST(sum(coord[1]) AS DOUBLE) AS total FROM ({O.POINTS64}) "
    f"UNION ALL SELECT 'set64', 'partition', count(*), CAST(sum(label) AS DOUBLE) FROM ({O.PARTITION64}) "
    f"UNION ALL SELECT 'set64', 'true', count(*), CAST(sum(coord[1]) AS DOUBLE) FROM ({O.true_centroids_sql(O.POINTS64, O.PARTITION64, 64)}) "
    f"UNION ALL SELECT 'set64', 'start', count(*), sum(coord[1] + 0.5) FROM ({O.START64})"))
def q_roles(spark, sf):
    """S3 + S4: a data set of four roles written, listed, and loaded."""
    root = scratch_path(spark, "roles")
    pts, lab = td.points64(spark, sf), td.partition64(spark, sf)
    half = F.transform("coord", lambda x: x + 0.5)   # start centroids keep fractions
    write_dataset(root, "set64", pts, lab, X.true_centroids_from_labels(pts, lab), td.start64(spark, sf).withColumn("coord", half))
    out = None
    for row in DS.list_datasets(spark, root).collect():
        ds = DS.load_dataset(spark, root, row["dataset"])
        roles = {"points": (ds.points, F.col("coord")[0]), "partition": (ds.partition, F.col("label")),
                 "true": (ds.true_centroids, F.col("coord")[0]), "start": (ds.start_centroids, F.col("coord")[0])}
        for role, (df, value) in roles.items():
            one = df.agg(F.count(F.lit(1)).alias("n"), F.sum(value).cast("double").alias("total")).select(
                F.lit(row["dataset"]).alias("dataset"), F.lit(role).alias("role"), "n", "total")
            out = one if out is None else out.unionByName(one)
    return out


@query("cleaned_text_points2", f"SELECT row_number() OVER (ORDER BY point_id) AS point_id, coord FROM ({O.POINTS2})")
def q_clean(spark, sf):
    """A file with uneven white space and fractions rewritten and read."""
    src, dst = scratch_path(spark, "messy"), scratch_path(spark, "clean")
    messy = F.concat(F.lit("  "), F.array_join("coord", "\t   "), F.lit(" "))
    td.points2(spark, sf).orderBy("point_id").select(messy.alias("value")).write.text(src)
    TXT.clean_text(spark, src, dst)
    return load_points(spark, dst)


@query("replaced_table_points2", (
    f"SELECT 'first' AS step, count(*) AS n FROM ({O.POINTS2}) UNION ALL "
    f"SELECT 'replaced', count(*) FROM ({O.POINTS2}) WHERE coord[2] > 5000 UNION ALL SELECT 'cleared', 0"))
def q_replaced(spark, sf):
    """S11, durable form: a table made, replaced from a query, and cleared."""
    import uuid
    name = f"centrix_points_{uuid.uuid4().hex}"
    pts = td.points2(spark, sf).select("point_id", F.col("coord")[1].alias("y"))
    try:
        counts = [("first", TBL.replace_table(pts, name, durable=True).count()),
                  ("replaced", TBL.replace_table(pts.where("y > 5000"), name, durable=True).count())]
        TBL.clear_table(spark, name)
        counts.append(("cleared", spark.table(name).count()))
    finally:
        TBL.drop_table(spark, name)
    return spark.createDataFrame(counts, "step STRING, n BIGINT")


# ---- small functions, counts, laterals ---------------------------------------

from centrix.functions.numeric import millis, round_to  # noqa: E402
from centrix.functions.vector import vec_add, vec_div, vec_least  # noqa: E402


@query("cluster_counts_points2", _one_step(
    O.POINTS2, O.START2, "SELECT CAST(cluster_id AS INTEGER) AS cluster_id, count(*) AS n FROM a1 GROUP BY cluster_id"))
def q_counts(spark, sf):
    """A5: members per cluster."""
    return U.cluster_counts(A.assign(td.points2(spark, sf), td.start2(spark, sf)))


@query("total_cost_points2", _one_step(O.POINTS2, O.START2, "SELECT sum(CAST(dist AS DECIMAL(38, 6))) AS cost FROM a1"))
def q_total(spark, sf):
    """A6 over all clusters."""
    return COST.total_cost(A.assign(td.points2(spark, sf), td.start2(spark, sf)))


@query("vector_functions_points2", (
    "SELECT point_id, [coord[1] + coord[2], coord[2] + coord[1]] AS added, [coord[1] / 4.0::DOUBLE, coord[2] / 4.0::DOUBLE] AS divided, "
    "[least(coord[1], coord[2]), least(coord[2], coord[1])] AS lower, least(coord[2], 5000) AS clipped, "
    f"round(coord[2] * 0.001::DOUBLE * 1000.0::DOUBLE, 3) AS ms, round(coord[2] / 7.0::DOUBLE, 4) AS score FROM ({O.POINTS2})"))
def q_vector_functions(spark, sf):
    """Add, divide, elementwise minimum, clip, ms and rounding."""
    y = F.col("coord")[1]
    return td.points2(spark, sf).select(
        "point_id", vec_add("coord", F.reverse("coord")).alias("added"), vec_div("coord", 4).alias("divided"),
        vec_least("coord", F.reverse("coord")).alias("lower"), F.least(y, F.lit(5000)).alias("clipped"),
        millis(y * 0.001).alias("ms"), round_to(y / F.lit(7.0), 4).alias("score"))


@query("lateral_means_points2", _one_step(
    O.POINTS2, O.START2,
    "SELECT CAST(c.cluster_id AS INTEGER) AS cluster_id, count(a.point_id) AS n, avg(a.coord[1]) AS x, avg(a.coord[2]) AS y "
    "FROM c1 c LEFT JOIN a1 a USING (cluster_id) GROUP BY c.cluster_id"))
def q_lateral(spark, sf):
    """J6 and the SQL form of the update: per cluster, a lateral aggregate over
    its members (decorrelated to one grouped aggregate and a join)."""
    a = A.assign(td.points2(spark, sf), td.start2(spark, sf), keep_coord=True)
    a.createOrReplaceTempView("centrix_members")
    td.start2(spark, sf).createOrReplaceTempView("centrix_clusters")
    return spark.sql(
        "SELECT c.cluster_id, m.n, m.x, m.y FROM centrix_clusters c, LATERAL ("
        "SELECT count(point_id) AS n, avg(coord[0]) AS x, avg(coord[1]) AS y FROM centrix_members a "
        "WHERE a.cluster_id = c.cluster_id) m")


@query("lloyd100_properties_points2", (
    f"SELECT CAST(i AS INTEGER) AS iter, (SELECT count(*) FROM ({O.POINTS2})) AS n, false AS rises FROM range(1, 101) t(i)"))
def q_lloyd100(spark, sf):
    """A run of the published length: every iteration covers all points, and
    the cost never rises."""
    res = fit(td.points2(spark, sf), td.start2(spark, sf), max_iter=100)
    costs = res.costs().select("iter", "cost", F.lag("cost").over(Window.orderBy("iter")).alias("before"))
    sizes = res.centroid_history().groupBy("iter").agg(F.sum("n").alias("n"))
    res.unpersist()
    return sizes.join(costs, "iter").select(
        "iter", "n", F.coalesce(F.col("cost") > F.col("before") * (1 + 1e-12), F.lit(False)).alias("rises"))
