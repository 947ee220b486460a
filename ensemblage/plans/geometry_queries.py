"""Queries on moments, duplicates and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ensemblage.functions import constants as K
from ensemblage.operators import clustering, geometry, linkage as trees, metric as metrics, screen
from ensemblage.plans.adapters import Given
from ensemblage.plans.catalog import register
from ensemblage.plans.oracle import r6, with_ctes

MEMBER = geometry.MEMBER


def tensor_sql() -> dict[str, str]:
    def central(a: str, b: str) -> str:
        return f"sum(m * {a} * {b}) - sum(m * {a}) * sum(m * {b}) / sum(m)"

    return {
        "atoms": """
            SELECT ensemble_id, conf_idx, l_linenumber, min(element) AS element, min(l_quantity * 1.0371319::DOUBLE) AS x,
                   min(l_discount * 100.37131::DOUBLE) AS y, min(l_tax * 97.13137::DOUBLE) AS z
            FROM observed GROUP BY ALL""",
        "points": """
            SELECT *, CASE element WHEN 'H' THEN 1.008 WHEN 'C' THEN 12.011 ELSE 15.999 END::DOUBLE AS m FROM atoms""",
        "tensor": f"""
            SELECT ensemble_id, conf_idx, {central('y', 'y')} + ({central('z', 'z')}) AS xx, {central('x', 'x')} + ({central('z', 'z')}) AS yy,
                   {central('x', 'x')} + ({central('y', 'y')}) AS zz, -({central('x', 'y')}) AS xy, -({central('x', 'z')}) AS xz,
                   -({central('y', 'z')}) AS yz FROM points GROUP BY ensemble_id, conf_idx""",
        "scaled": """
            SELECT *, (xx + yy + zz) / 3 AS q, xy * xy + xz * xz + yz * yz AS off,
                   sqrt(((xx - q) * (xx - q) + (yy - q) * (yy - q) + (zz - q) * (zz - q) + 2 * off) / 6) AS p FROM tensor""",
        "angled": """
            SELECT *, CASE WHEN p > 0 THEN acos(greatest(-1.0, least(1.0, ((xx - q) * ((yy - q) * (zz - q) - yz * yz)
                   - xy * (xy * (zz - q) - yz * xz) + xz * (xy * yz - (yy - q) * xz)) / (2 * p * p * p)))) / 3 ELSE 0 END AS phi FROM scaled""",
        "eigen": """
            SELECT ensemble_id, conf_idx, q + 2 * p * cos(phi + 2 * pi() / 3) AS low, q + 2 * p * cos(phi) AS high, 3 * q - low - high AS mid
            FROM angled""",
    }


@register("scr_moi_descriptor", with_ctes("""
    SELECT ensemble_id, conf_idx, (round(low, 3) + 0.0) AS moment_a, (round(mid, 3) + 0.0) AS moment_b, (round(high, 3) + 0.0) AS moment_c
    FROM eigen""", tensor_sql()))
def descriptor(spark: SparkSession, folder: str) -> DataFrame:
    found = geometry.moments(Given(spark, folder).coordinates())
    return found.select(*MEMBER, *[F.round(f"moment_{n}", 3).alias(f"moment_{n}") for n in "abc"])


SAME_MOMENTS = " AND ".join(
    ["(m.energy_kcal IS NULL OR k.e IS NULL OR abs(m.energy_kcal - k.e) <= 2.0)", *[f"abs(m.{x} - k.{x}) <= -ln(1 - 0.2::DOUBLE)" for x in "abc"]])
WALK = {
    **tensor_sql(),
    "ordered": """
        SELECT ensemble_id, conf_idx, energy_kcal, ln(greatest(low, 1e-9)) AS a, ln(greatest(mid, 1e-9)) AS b, ln(greatest(high, 1e-9)) AS c,
               row_number() OVER (PARTITION BY ensemble_id ORDER BY energy_kcal IS NULL, energy_kcal, conf_idx) AS pos
        FROM conformers_all JOIN eigen USING (ensemble_id, conf_idx)""",
    "walk": f"""
        SELECT ensemble_id, pos, conf_idx, conf_idx AS kept_idx, [struct_pack(i := conf_idx, e := energy_kcal, a := a, b := b, c := c)] AS kept
        FROM ordered WHERE pos = 1
        UNION ALL
        SELECT ensemble_id, pos, conf_idx, coalesce(hit, conf_idx),
               CASE WHEN hit IS NULL THEN list_append(kept, struct_pack(i := conf_idx, e := energy_kcal, a := a, b := b, c := c)) ELSE kept END
        FROM (SELECT m.*, w.kept, list_filter(w.kept, lambda k: {SAME_MOMENTS})[1].i AS hit
              FROM walk w JOIN ordered m ON m.ensemble_id = w.ensemble_id AND m.pos = w.pos + 1)""",
}


@register("scr_moi_pairs", with_ctes("SELECT ensemble_id, conf_idx, kept_idx FROM walk WHERE kept_idx <> conf_idx", WALK))
def moment_pairs(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    points = given.conformers(all_energies=True).join(geometry.moments(given.coordinates()), MEMBER)
    found = geometry.moment_duplicates(points, 0.2, 2.0)
    return found.where("kept_idx <> conf_idx")


def superposed_sql() -> dict[str, str]:
    """Superposed RMSD of every two conformers of one formula in an ensemble, from the singular values of their covariance."""
    h = [f"h{a}{b}" for a in "xyz" for b in "xyz"]
    k = {f"{a}{b}": " + ".join(f"h{c}{a} * h{c}{b}" for c in "xyz") for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")}
    return {
        "atoms": tensor_sql()["atoms"],
        "centred": """
            SELECT ensemble_id, conf_idx, row_number() OVER (PARTITION BY ensemble_id, conf_idx ORDER BY l_linenumber) AS spot, element, x - avg(x) OVER m AS x, y - avg(y) OVER m AS y, z - avg(z) OVER m AS z
            FROM atoms WINDOW m AS (PARTITION BY ensemble_id, conf_idx)""",
        "shapes": """
            SELECT ensemble_id, conf_idx, string_agg(element, ' ' ORDER BY spot) AS formula, count(*) AS n, sum(x * x + y * y + z * z) AS g
            FROM centred GROUP BY ensemble_id, conf_idx""",
        "turned": f"""
            SELECT a.ensemble_id, a.conf_idx AS i, b.conf_idx AS j, {", ".join(f"sum(a.{n[1]} * b.{n[2]}) AS {n}" for n in h)}
            FROM centred a JOIN centred b ON a.ensemble_id = b.ensemble_id AND a.spot = b.spot AND a.conf_idx < b.conf_idx GROUP BY ALL""",
        "squared": f"""
            SELECT ensemble_id, i, j, {", ".join(f"{v} AS {n}" for n, v in k.items())},
                   hxx * (hyy * hzz - hyz * hzy) - hxy * (hyx * hzz - hyz * hzx) + hxz * (hyx * hzy - hyy * hzx) AS det FROM turned""",
        "pairs_scaled": """
            SELECT *, (xx + yy + zz) / 3 AS q, xy * xy + xz * xz + yz * yz AS off,
                   sqrt(((xx - q) * (xx - q) + (yy - q) * (yy - q) + (zz - q) * (zz - q) + 2 * off) / 6) AS p FROM squared""",
        "pairs_angled": """
            SELECT *, CASE WHEN p > 0 THEN acos(greatest(-1.0, least(1.0, ((xx - q) * ((yy - q) * (zz - q) - yz * yz)
                   - xy * (xy * (zz - q) - yz * xz) + xz * (xy * yz - (yy - q) * xz)) / (2 * p * p * p)))) / 3 ELSE 0 END AS phi FROM pairs_scaled""",
        "singular": """
            SELECT ensemble_id, i, j, sign(det) AS side, sqrt(greatest(0, q + 2 * p * cos(phi))) AS s1, sqrt(greatest(0, q + 2 * p * cos(phi + 2 * pi() / 3))) AS s3,
                   sqrt(greatest(0, 3 * q - (q + 2 * p * cos(phi)) - (q + 2 * p * cos(phi + 2 * pi() / 3)))) AS s2 FROM pairs_angled""",
        "rmsds": """
            SELECT s.ensemble_id, s.i, s.j, sqrt(greatest(0, (a.g + b.g - 2 * (s1 + s2 + side * s3)) / a.n)) AS rmsd FROM singular s
            JOIN shapes a ON a.ensemble_id = s.ensemble_id AND a.conf_idx = s.i JOIN shapes b ON b.ensemble_id = s.ensemble_id AND b.conf_idx = s.j
            WHERE a.formula = b.formula""",
    }


def rmsd_walk_sql(tolerance: float, gate: str, among: str = "shapes") -> dict[str, str]:
    """The walk by energy over conformers of ``among``, each with the ones that it duplicates."""
    return {
        "alike": f"""
            SELECT r.ensemble_id, r.i, r.j FROM rmsds r JOIN conformers_all a ON a.ensemble_id = r.ensemble_id AND a.conf_idx = r.i
            JOIN conformers_all b ON b.ensemble_id = r.ensemble_id AND b.conf_idx = r.j WHERE rmsd <= {tolerance} AND {gate}""",
        "alikes": """
            SELECT ensemble_id, i AS conf_idx, list(j) AS others FROM (SELECT ensemble_id, i, j FROM alike UNION ALL SELECT ensemble_id, j, i FROM alike)
            GROUP BY ensemble_id, i""",
        "queued": f"""
            SELECT ensemble_id, conf_idx, coalesce(others, []) AS others,
                   row_number() OVER (PARTITION BY ensemble_id ORDER BY energy_kcal IS NULL, energy_kcal, conf_idx) AS pos
            FROM conformers_all JOIN (SELECT ensemble_id, conf_idx FROM {among}) USING (ensemble_id, conf_idx) LEFT JOIN alikes USING (ensemble_id, conf_idx)""",
        "led": """
            SELECT ensemble_id, pos, conf_idx, conf_idx AS kept_idx, [conf_idx] AS kept FROM queued WHERE pos = 1
            UNION ALL
            SELECT ensemble_id, pos, conf_idx, coalesce(hit, conf_idx), CASE WHEN hit IS NULL THEN list_append(kept, conf_idx) ELSE kept END
            FROM (SELECT m.*, w.kept, list_filter(w.kept, lambda k: list_contains(m.others, k))[1] AS hit
                  FROM led w JOIN queued m ON m.ensemble_id = w.ensemble_id AND m.pos = w.pos + 1)""",
    }


@register("scr_rmsd_pairs", with_ctes(
    "SELECT ensemble_id, conf_idx, kept_idx FROM led WHERE kept_idx <> conf_idx", {**superposed_sql(), **rmsd_walk_sql(1.0, "true")}))
def rmsd_pairs(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    atoms = given.coordinates()
    points = given.conformers(all_energies=True).join(geometry.spreads(atoms), MEMBER).join(geometry.coordinate_lists(atoms), MEMBER)
    found = geometry.rmsd_duplicates(points, 1.0, None)
    return found.where("kept_idx <> conf_idx")


@register("scr_cluster_metric", with_ctes(f"""
    SELECT s.ensemble_id, s.conf_idx, coalesce(min(r.label), s.conf_idx) AS label FROM shapes s
    LEFT JOIN led_to r ON r.ensemble_id = s.ensemble_id AND r.conf_idx = s.conf_idx GROUP BY s.ensemble_id, s.conf_idx""",
    {**tensor_sql(), **superposed_sql(),
     "logs": ", ".join(["SELECT ensemble_id, conf_idx", *[f"ln(greatest({m}, {metrics.LEAST_MOMENT})) AS {m}" for m in ("low", "mid", "high")]]) + " FROM eigen",
     "mixed": """
        SELECT r.ensemble_id, r.i, r.j FROM rmsds r JOIN logs a ON a.ensemble_id = r.ensemble_id AND a.conf_idx = r.i
        JOIN logs b ON b.ensemble_id = r.ensemble_id AND b.conf_idx = r.j
        WHERE (rmsd + greatest(abs(a.low - b.low), abs(a.mid - b.mid), abs(a.high - b.high))) / 2 <= 1.5""",
     "both_ways": "SELECT ensemble_id, i, j FROM mixed UNION ALL SELECT ensemble_id, j, i FROM mixed",
     "led_to": """
        SELECT ensemble_id, i AS conf_idx, i AS label FROM both_ways
        UNION
        SELECT l.ensemble_id, l.j, r.label FROM led_to r JOIN both_ways l ON l.ensemble_id = r.ensemble_id AND l.i = r.conf_idx"""}))
def by_metric(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters by the mean of superposed RMSD and the difference of moments."""
    return metrics.metric_clusters(metrics.shapes(Given(spark, folder).coordinates()), 1.5, "mix")


FIRST_WALK = {k: v.replace("0.2::DOUBLE", f"{geometry.MOMENT_TOLERANCE}::DOUBLE").replace("<= 2.0", f"<= {geometry.ENERGY_GATE_KCAL}") for k, v in WALK.items()}


@register("scr_greedy_dedupe", with_ctes(
    "SELECT c.ensemble_id, c.conf_idx, coalesce(l.kept_idx = c.conf_idx, false) AS accepted FROM conformers_all c LEFT JOIN led l USING (ensemble_id, conf_idx)",
    {**FIRST_WALK, "unlike": "SELECT ensemble_id, conf_idx FROM walk WHERE kept_idx = conf_idx", **superposed_sql(),
     **rmsd_walk_sql(geometry.RMSD_TOLERANCE, f"abs(a.energy_kcal - b.energy_kcal) <= {geometry.ENERGY_GATE_KCAL}", "unlike")}))
def dedupe(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    return geometry.prune(given.coordinates(), given.conformers(all_energies=True))


def lloyd_sql(ks: list[int]) -> dict[str, str]:
    """Rounds of assignment and averaging for each number of clusters, until the centres rest."""
    apart = "list_sum(list_transform(list_zip(p.f, c.f), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return {
        "vectors": """
            SELECT label AS ensemble_id, vec_id AS conf_idx, list_transform(embedding, lambda x: x::DOUBLE) AS f,
                   row_number() OVER (PARTITION BY label ORDER BY md5(vec_id::VARCHAR), vec_id) AS rank FROM embeddings""",
        "ks": f"SELECT unnest({ks}) AS k",
        "run": f"""
            SELECT ensemble_id, k::INT AS k, 0 AS round, TRUE AS moving, list(struct_pack(c := (rank - 1)::INT, f := f) ORDER BY rank) AS centres
            FROM vectors CROSS JOIN ks WHERE rank <= k GROUP BY ensemble_id, k
            UNION ALL
            SELECT ensemble_id, k, round + 1, max(shift) > 1e-12, list(struct_pack(c := c, f := f) ORDER BY c) FROM (
                SELECT o.ensemble_id, o.k, o.round, o.c, coalesce(n.f, o.f) AS f,
                       list_sum(list_transform(list_zip(coalesce(n.f, o.f), o.f), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS shift
                FROM (SELECT ensemble_id, k, round, unnest(centres).c AS c, unnest(centres).f AS f FROM run WHERE moving) o
                LEFT JOIN (
                    SELECT ensemble_id, k, c, list(m ORDER BY i) AS f FROM (
                        SELECT ensemble_id, k, c, i, avg(x) AS m FROM (
                            SELECT ensemble_id, k, c, unnest(f) AS x, unnest(range(64)) AS i FROM (
                                SELECT p.ensemble_id, c.k, p.conf_idx, any_value(p.f) AS f, arg_min(c.c, ({apart}, c.c)) AS c
                                FROM vectors p JOIN (SELECT ensemble_id, k, unnest(centres).c AS c, unnest(centres).f AS f FROM run WHERE moving) c
                                ON c.ensemble_id = p.ensemble_id GROUP BY p.ensemble_id, c.k, p.conf_idx))
                        GROUP BY ensemble_id, k, c, i)
                    GROUP BY ensemble_id, k, c) n
                ON n.ensemble_id = o.ensemble_id AND n.k = o.k AND n.c = o.c)
            GROUP BY ensemble_id, k, round""",
        "rested": "SELECT *, row_number() OVER (PARTITION BY ensemble_id, k ORDER BY round DESC) AS last FROM run",
        "ends": "SELECT ensemble_id, k, round, NOT moving AS converged, unnest(centres).c AS c, unnest(centres).f AS f FROM rested WHERE last = 1",
        "members": f"""
            SELECT p.ensemble_id, p.conf_idx, c.k, any_value(p.f) AS f, any_value(c.round) AS rounds, any_value(c.converged) AS converged,
                   arg_min(c.c, ({apart}, c.c)) AS label, sqrt(min({apart})) AS distance
            FROM vectors p JOIN ends c ON c.ensemble_id = p.ensemble_id GROUP BY p.ensemble_id, p.conf_idx, c.k""",
    }


@register("scr_cluster_kmeans", with_ctes(f"SELECT ensemble_id, conf_idx, label, {r6('distance')} AS distance, converged, rounds FROM members", lloyd_sql([4])))
def kmeans(spark: SparkSession, folder: str) -> DataFrame:
    points = Given(spark, folder).embedding_points()
    return clustering.kmeans(points, 4, 64).select(*MEMBER, "label", F.round("distance", 6).alias("distance"), "converged", "rounds")


@register("scr_cluster_kmeans_auto", with_ctes(f"""
    SELECT ensemble_id, conf_idx, label, k, {r6('distance')} AS distance, {r6('silhouette')} AS silhouette, 2 AS k_least, 8 AS k_most, converged, rounds
    FROM members JOIN chosen USING (ensemble_id, k)""",
    {**lloyd_sql(list(range(2, 9))),
     "to_each": """
        SELECT a.ensemble_id, a.k, a.conf_idx, a.label = b.label AS same, b.label AS other, count(*) AS n,
               avg(list_sum(list_transform(list_zip(a.f, b.f), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) FILTER (a.conf_idx <> b.conf_idx) AS gap
        FROM members a JOIN members b ON a.ensemble_id = b.ensemble_id AND a.k = b.k GROUP BY a.ensemble_id, a.k, a.conf_idx, a.label, b.label""",
     "sides": """
        SELECT ensemble_id, k, conf_idx, min(gap) FILTER (same) AS within, min(gap) FILTER (NOT same) AS between, min(n) FILTER (same) AS n
        FROM to_each GROUP BY ensemble_id, k, conf_idx""",
     "scores": """
        SELECT ensemble_id, k, round(avg(CASE WHEN n = 1 OR between IS NULL OR greatest(within, between) <= 0 THEN 0.0
               ELSE (between - within) / greatest(within, between) END), 9) AS silhouette FROM sides GROUP BY ensemble_id, k""",
     "chosen": "SELECT ensemble_id, arg_min(k, (-silhouette, k)) AS k, max(silhouette) AS silhouette FROM scores GROUP BY ensemble_id"}))
def kmeans_auto(spark: SparkSession, folder: str) -> DataFrame:
    points = Given(spark, folder).embedding_points()
    return clustering.kmeans_auto(points, 64).select(
        *MEMBER, "label", "k", F.round("distance", 6).alias("distance"), F.round("silhouette", 6).alias("silhouette"), "k_least", "k_most", "converged", "rounds")


NEAR = "(a.u - b.u) * (a.u - b.u) + (a.v - b.v) * (a.v - b.v) <= 0.4 * 0.4"
REACHED = {
    "spots": """
        SELECT c_nationkey AS ensemble_id, c_custkey AS conf_idx, round(c_acctbal / 1000, 3) AS u, length(c_mktsegment)::DOUBLE AS v
        FROM customer""",
    "cores": f"""
        SELECT a.* FROM spots a JOIN spots b ON a.ensemble_id = b.ensemble_id AND {NEAR}
        GROUP BY ALL HAVING count(*) >= MIN""",
    "core_links": f"""
        SELECT a.ensemble_id, a.conf_idx, b.conf_idx AS other FROM cores a JOIN cores b ON a.ensemble_id = b.ensemble_id AND {NEAR}""",
    "reach": """
        SELECT ensemble_id, conf_idx, conf_idx AS label FROM cores
        UNION
        SELECT l.ensemble_id, l.other, r.label FROM reach r JOIN core_links l USING (ensemble_id, conf_idx)""",
    "named": "SELECT ensemble_id, conf_idx, min(label) AS label FROM reach GROUP BY ensemble_id, conf_idx",
    "bordered": f"""
        SELECT a.ensemble_id, a.conf_idx, min(n.label) AS label FROM spots a JOIN cores b ON a.ensemble_id = b.ensemble_id AND {NEAR}
        JOIN named n ON n.ensemble_id = b.ensemble_id AND n.conf_idx = b.conf_idx
        WHERE NOT EXISTS (SELECT 1 FROM cores c WHERE c.ensemble_id = a.ensemble_id AND c.conf_idx = a.conf_idx)
        GROUP BY a.ensemble_id, a.conf_idx""",
}


def cluster_sql(min_members: int) -> str:
    """Labels by real distances and reachability, member by member."""
    body = """
        SELECT ensemble_id, conf_idx, coalesce(n.label, x.label, conf_idx) AS label FROM spots
        LEFT JOIN named n USING (ensemble_id, conf_idx) LEFT JOIN bordered x USING (ensemble_id, conf_idx)"""
    return with_ctes(body, {k: v.replace("MIN", str(min_members)) for k, v in REACHED.items()})


@register("scr_cluster_threshold", cluster_sql(1))
def linkage(spark: SparkSession, folder: str) -> DataFrame:
    points = Given(spark, folder).descriptors()
    return clustering.threshold_clusters(points, ["u", "v"], 0.4).select(*MEMBER, "label")


@register("scr_cluster_density", cluster_sql(3))
def density(spark: SparkSession, folder: str) -> DataFrame:
    points = Given(spark, folder).descriptors()
    return clustering.threshold_clusters(points, ["u", "v"], 0.4, 3).select(*MEMBER, "label")


LINKED = {
    "spots": REACHED["spots"],
    "gaps": """
        SELECT a.ensemble_id, a.conf_idx AS x, b.conf_idx AS y, least(a.conf_idx, b.conf_idx) AS a, greatest(a.conf_idx, b.conf_idx) AS b,
               (a.u - b.u) * (a.u - b.u) + (a.v - b.v) * (a.v - b.v) AS square
        FROM spots a JOIN spots b ON a.ensemble_id = b.ensemble_id AND a.conf_idx <> b.conf_idx""",
    "grown": """
        SELECT ensemble_id, [min(conf_idx)] AS seen, NULL::BIGINT AS a, NULL::BIGINT AS b, NULL::DOUBLE AS square FROM spots GROUP BY ensemble_id
        UNION ALL
        SELECT ensemble_id, list_append(seen, e.y), e.a, e.b, e.square FROM (
            SELECT t.ensemble_id, any_value(t.seen) AS seen, min(struct_pack(square := g.square, a := g.a, b := g.b, y := g.y)) AS e
            FROM grown t JOIN gaps g ON g.ensemble_id = t.ensemble_id AND list_contains(t.seen, g.x) AND NOT list_contains(t.seen, g.y)
            GROUP BY t.ensemble_id)""",
    "tree": """
        SELECT ensemble_id, a, b, square, row_number() OVER (PARTITION BY ensemble_id ORDER BY square, a, b) AS merge FROM grown WHERE a IS NOT NULL""",
    "sides": "SELECT ensemble_id, a AS x, b AS y, merge FROM tree UNION ALL SELECT ensemble_id, b, a, merge FROM tree",
    "ways": """
        SELECT ensemble_id, conf_idx AS x, conf_idx AS y, conf_idx AS before, 0::BIGINT AS top FROM spots
        UNION ALL
        SELECT w.ensemble_id, w.x, s.y, w.y, greatest(w.top, s.merge) FROM ways w JOIN sides s ON s.ensemble_id = w.ensemble_id AND s.x = w.y AND s.y <> w.before""",
}


@register("scr_cluster_dendrogram", with_ctes(f"""
    SELECT ensemble_id, merge, least(a_name, b_name) AS left, greatest(a_name, b_name) AS right, {r6('sqrt(square)')} AS height, a_size + b_size AS size FROM (
        SELECT t.ensemble_id, t.merge, any_value(t.square) AS square, min(w.y) FILTER (w.x = t.a) AS a_name, min(w.y) FILTER (w.x = t.b) AS b_name,
               count(*) FILTER (w.x = t.a) AS a_size, count(*) FILTER (w.x = t.b) AS b_size
        FROM tree t JOIN ways w ON w.ensemble_id = t.ensemble_id AND w.x IN (t.a, t.b) AND w.top < t.merge GROUP BY t.ensemble_id, t.merge)""", LINKED))
def linkage_tree(spark: SparkSession, folder: str) -> DataFrame:
    merges = trees.dendrogram(Given(spark, folder).descriptors(), ["u", "v"])
    return merges.select("ensemble_id", "merge", "left", "right", F.round("height", 6).alias("height"), "size")


@register("scr_cluster_agglomerative", with_ctes("""
    SELECT w.ensemble_id, w.x AS conf_idx, min(w.y) AS label FROM ways w JOIN (SELECT ensemble_id, count(*) AS n FROM spots GROUP BY ensemble_id) c
    ON c.ensemble_id = w.ensemble_id AND w.top <= c.n - 4 GROUP BY ALL""", LINKED))
def linkage_by_count(spark: SparkSession, folder: str) -> DataFrame:
    """Four clusters of each ensemble that has so many members."""
    points = Given(spark, folder).descriptors()
    return trees.cut(trees.dendrogram(points, ["u", "v"]), points, n_clusters=4)


@register("scr_cluster_pipeline", with_ctes(f"""
    SELECT ensemble_id, conf_idx, accepted, reason AS rejected_reason FROM (
        SELECT s.*, CASE WHEN NOT inside THEN '{K.REASON_WINDOW}' WHEN NOT accepted THEN '{K.REASON_CLUSTER}' END AS reason FROM (
            SELECT w.*, inside AND (NOT screened OR conf_idx = centre) AS accepted FROM sized w LEFT JOIN centres USING (ensemble_id, label)) s)""",
    {**{k: v.replace("MIN", "1") for k, v in REACHED.items()},
     "labelled": "SELECT s.*, n.label FROM spots s JOIN named n USING (ensemble_id, conf_idx)",
     "far": """
        SELECT *, round(sqrt((u - avg(u) OVER c) * (u - avg(u) OVER c) + (v - avg(v) OVER c) * (v - avg(v) OVER c)), 6) AS distance
        FROM labelled WINDOW c AS (PARTITION BY ensemble_id, label)""",
     "windowed": """
        SELECT f.*, c_acctbal AS energy, c_acctbal - min(c_acctbal) OVER (PARTITION BY ensemble_id) <= 9000 AS inside
        FROM far f JOIN customer ON c_custkey = conf_idx""",
     "sized": "SELECT *, count(*) FILTER (inside) OVER (PARTITION BY ensemble_id) >= 3 AS screened FROM windowed",
     "centres": "SELECT ensemble_id, label, arg_min(conf_idx, (distance, energy, conf_idx)) AS centre FROM sized WHERE inside AND screened GROUP BY ALL"}))
def cluster_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Points to clusters by distance, their members' distances to the mean, and the screen that keeps one of each."""
    points = Given(spark, folder).descriptors()
    labelled = clustering.threshold_clusters(points, ["u", "v"], 0.4)
    distances = clustering.centroid_distances(labelled, ["u", "v"]).withColumn("distance", F.round("distance", 6))
    screened = screen.cluster_screen(points.select(*MEMBER, "energy_kcal"), distances, 9000.0)
    return screened.select(*MEMBER, "accepted", "rejected_reason")
