"""DuckDB SQL text for the correctness oracles of the registered queries.

Nothing here runs on Spark: these strings are what the driver executes in
DuckDB against the same Parquet tables.  Loops (Lloyd iterations, seeding
steps) are unrolled into CTE blocks.
"""

from __future__ import annotations


# The draws, written here a second time from their definition: a stream number
# folded from (seed, parts), and a double from two mixes of the id.
_P, _Q = 2**31 - 1, 2**31 - 19


def stream(seed: int, *parts: int) -> int:
    out = seed % _P
    for part in parts:
        out = (out * 1000003 + part + 1) % _P
    return out


def stream_of(base: int, part: str) -> str:
    return f"((CAST({base} AS BIGINT) * 1000003 + ({part}) + 1) % {_P})"


def uniform(stream_no: str, id_sql: str) -> str:
    """A draw as nested one-element lists, so that each round is named once."""
    def mixed(m: int, a: int, b: int, c: int, e: int) -> str:
        high = f"((CAST({id_sql} AS BIGINT) >> 30) % {m} + {m}) % {m}"
        first = f"[((CAST({id_sql} AS BIGINT) & 1073741823) * {a} + ({stream_no})) % {m}]"
        second = f"list_transform({first}, lambda v: (v * v + {b}) % {m})"
        third = f"list_transform({second}, lambda v: (v * {c} + {high}) % {m})"
        return f"CAST(list_transform({third}, lambda v: (v * v + {e}) % {m})[1] AS DOUBLE)"

    one, two = mixed(_P, 48271, 12345, 69621, 54321), mixed(_Q, 69621, 54321, 48271, 12345)
    return f"least(({one} + ({two} + CAST(0.5 AS DOUBLE)) / CAST({_Q} AS DOUBLE)) / CAST({_P} AS DOUBLE), CAST({1 - 2.0**-53!r} AS DOUBLE))"


POINTS64 = ("SELECT vec_id AS point_id, list_transform(embedding, lambda x: "
            "CAST(round(CAST(x AS DOUBLE) * 1000.0) AS BIGINT)) AS coord FROM embeddings")
PARTITION64 = "SELECT vec_id AS point_id, CAST(label + 1 AS INTEGER) AS label FROM embeddings"
START64 = ("SELECT CAST(label + 1 AS INTEGER) AS cluster_id, list_transform(arg_min(embedding, vec_id), lambda x: "
           "CAST(CAST(round(CAST(x AS DOUBLE) * 1000.0) AS BIGINT) AS DOUBLE)) AS coord "
           "FROM embeddings GROUP BY label")
POINTS2 = ("SELECT event_id AS point_id, [user_id, CAST(round(value * 100.0) AS BIGINT)] AS coord "
           "FROM events")
PARTITION2 = ("SELECT e.event_id AS point_id, CAST(r.label AS INTEGER) AS label FROM events e JOIN "
              "(SELECT event_type, row_number() OVER (ORDER BY event_type) AS label "
              "FROM (SELECT DISTINCT event_type FROM events)) r USING (event_type)")
START2 = ("SELECT CAST(row_number() OVER (ORDER BY point_id) AS INTEGER) AS cluster_id, "
          "list_transform(coord, lambda x: CAST(x AS DOUBLE)) AS coord FROM "
          f"(SELECT * FROM ({POINTS2}) ORDER BY point_id LIMIT 5)")

FIXTURES = {"points64": POINTS64, "partition64": PARTITION64, "start64": START64,
            "points2": POINTS2, "partition2": PARTITION2, "start2": START2}


def sq_dist(a: str, b: str) -> str:
    """Squared distance, summed left to right (same order as Spark's fold)."""
    return (f"list_reduce(list_transform(range(1, len({a}) + 1), lambda j: "
            f"(CAST({a}[j] AS DOUBLE) - CAST({b}[j] AS DOUBLE)) * "
            f"(CAST({a}[j] AS DOUBLE) - CAST({b}[j] AS DOUBLE))), lambda acc, t: acc + t)")


def assign_cte(points: str, cents: str) -> str:
    """Nearest centroid per point, lowest cluster_id on a tie."""
    return (f"SELECT point_id, coord, cluster_id, dist FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY dist, cluster_id) AS rn FROM ("
            f"SELECT p.point_id, p.coord, c.cluster_id, {sq_dist('p.coord', 'c.coord')} AS dist "
            f"FROM {points} p, {cents} c)) WHERE rn = 1")


def update_cte(assigned: str, cents: str, d: int) -> str:
    mean = "[" + ", ".join(f"sum(coord[{j + 1}]) / count(*)" for j in range(d)) + "]"
    return (f"SELECT c.cluster_id, coalesce(s.mean, c.coord) AS coord FROM {cents} c LEFT JOIN "
            f"(SELECT cluster_id, {mean} AS mean FROM {assigned} GROUP BY cluster_id) s "
            f"USING (cluster_id)")


def lloyd_ctes(points_sql: str, start_sql: str, iters: int, d: int) -> list[str]:
    """CTEs pts, c1, a1, c2, a2, ..., c{iters}, a{iters}."""
    ctes = [f"pts AS ({points_sql})", f"c1 AS ({start_sql})"]
    for i in range(1, iters + 1):
        ctes.append(f"a{i} AS ({assign_cte('pts', f'c{i}')})")
        if i < iters:
            ctes.append(f"c{i + 1} AS ({update_cte(f'a{i}', f'c{i}', d)})")
    return ctes


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def lloyd_centroids(points_sql: str, start_sql: str, iters: int, d: int) -> str:
    body = (f"SELECT c.cluster_id, CAST(coalesce(m.n, 0) AS BIGINT) AS n, c.coord FROM c{iters} c "
            f"LEFT JOIN (SELECT cluster_id, count(*) AS n FROM a{iters} GROUP BY cluster_id) m USING (cluster_id)")
    return with_(lloyd_ctes(points_sql, start_sql, iters, d), body)


def lloyd_labels(points_sql: str, start_sql: str, iters: int, d: int) -> str:
    body = f"SELECT point_id, CAST(cluster_id AS INTEGER) AS cluster_id, dist FROM a{iters}"
    return with_(lloyd_ctes(points_sql, start_sql, iters, d), body)


def lloyd_costs(points_sql: str, start_sql: str, iters: int, d: int) -> str:
    body = " UNION ALL ".join(
        f"SELECT {i} AS iter, sum(CAST(dist AS DECIMAL(38, 6))) AS cost FROM a{i}" for i in range(1, iters + 1))
    return with_(lloyd_ctes(points_sql, start_sql, iters, d), f"SELECT * FROM ({body})")


def uniform_u(seed_stream: int, id_sql: str) -> str:
    return uniform(str(seed_stream), id_sql)


def kmeanspp_sql(points_sql: str, k: int, seed: int, trials: int) -> str:
    """Greedy k-means++ unrolled for k centres (exponential-race draws)."""
    ctes = [f"pts AS ({points_sql})",
            f"c1 AS (SELECT point_id, coord FROM pts ORDER BY {uniform_u(stream(seed, 0, 0), 'point_id')}, "
            f"point_id LIMIT 1)",
            f"d1 AS (SELECT p.point_id, p.coord, {sq_dist('p.coord', 'c.coord')} AS dn FROM pts p, c1 c)"]
    for c in range(2, k + 1):
        vals = ", ".join(f"({t}, {stream(seed, c, t)})" for t in range(1, trials + 1))
        u = uniform("tt.st", "d.point_id")
        ctes += [
            f"r{c} AS (SELECT tt.t, d.point_id, d.coord, -ln({u}) / d.dn AS key "
            f"FROM d{c - 1} d, (VALUES {vals}) tt(t, st) WHERE d.dn > 0)",
            f"k{c} AS (SELECT t, point_id, coord FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY t ORDER BY key, point_id) AS rn FROM r{c}) WHERE rn = 1)",
            f"p{c} AS (SELECT k.t, sum(least(d.dn, {sq_dist('d.coord', 'k.coord')})) AS pot "
            f"FROM d{c - 1} d, k{c} k GROUP BY k.t)",
            f"c{c} AS (SELECT k.point_id, k.coord FROM k{c} k JOIN p{c} p USING (t) ORDER BY p.pot, k.t LIMIT 1)"]
        if c < k:
            ctes.append(f"d{c} AS (SELECT d.point_id, d.coord, least(d.dn, {sq_dist('d.coord', 'c.coord')}) AS dn "
                        f"FROM d{c - 1} d, c{c} c)")
    body = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS cluster_id, point_id, CAST(coord AS DOUBLE[]) AS coord FROM c{i}"
        for i in range(1, k + 1))
    return with_(ctes, f"SELECT * FROM ({body})")


def true_centroids_sql(points_sql: str, partition_sql: str, d: int) -> str:
    mean = "[" + ", ".join(f"CAST(trunc(sum(p.coord[{j + 1}]) / count(*)) AS BIGINT)" for j in range(d)) + "]"
    return (f"SELECT CAST(t.label AS INTEGER) AS cluster_id, {mean} AS coord FROM ({points_sql}) p "
            f"JOIN ({partition_sql}) t USING (point_id) GROUP BY t.label")


def expand_sql(points_sql: str, partition_sql: str, d: int, seed: int, factor: int = 2) -> str:
    ctes = [f"pts AS ({points_sql})", f"lab AS ({partition_sql})",
            f"tc AS ({true_centroids_sql(points_sql, partition_sql, d)})",
            "cents AS (SELECT row_number() OVER (ORDER BY cluster_id) - 1 AS place, cluster_id, "
            "CAST(coord AS DOUBLE[]) AS centre FROM tc)",
            f"par AS (SELECT count(*) AS n, max(point_id) AS mx, (SELECT count(*) FROM tc) AS k, "
            f"({factor} * count(*) - count(*)) // (SELECT count(*) FROM tc) AS m FROM pts)",
            "ids AS (SELECT unnest(range(k * m)) AS id, mx, m FROM par)",
            "nw AS (SELECT mx + 1 + id AS point_id, id, id // m AS place FROM ids)"]
    u1, u2 = (uniform(stream_of(stream(seed, r), "j"), "nw.id") for r in (1, 2))
    normal = f"sqrt(-2.0 * ln({u1})) * cos(2.0 * pi() * {u2})"
    gen = f"list_transform(range(0, {d}), lambda j: CAST(trunc(c.centre[j + 1] + {normal}) AS BIGINT))"
    body = ("SELECT point_id, coord, CAST(label AS INTEGER) AS label FROM pts JOIN lab USING (point_id) "
            f"UNION ALL SELECT nw.point_id, {gen} AS coord, CAST(c.cluster_id AS INTEGER) AS label FROM nw JOIN cents c USING (place)")
    return with_(ctes, f"SELECT * FROM ({body})")
