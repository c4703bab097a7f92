"""Queries of the spatial operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.levels import few, for_each_level
from ..functions.tails import chi2_upper_col
from ..functions.tails_sql import chi2_upper
from ..operators import spatial
from . import domain, imports

RADIUS = spatial.to_micrometres(120.0, "um")
K = 5


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.radius_edges(domain.points(spark, sf_dir), "fov", "cell_id", RADIUS)


def slide_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = spatial.slide_offsets(domain.points(spark, sf_dir))
    return placed.select("cell_id", F.round("x_adj", 5).alias("x_adj"), F.round("y_adj", 5).alias("y_adj"))


def radius_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir).select("src", "dst", F.round("dist", 6).alias("dist"))


def knn_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spatial.knn_edges(domain.points(spark, sf_dir), "fov", "cell_id", K)
    return found.select("src", "dst", F.round("dist", 6).alias("dist"), "rank")


def neighbor_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = domain.points(spark, sf_dir).where("area IS NOT NULL")
    return spatial.neighbor_values(_edges(spark, sf_dir), cells, "cell_id", "area").select("src", "degree", F.round("total", 4).alias("total"))


def neighbor_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = domain.points(spark, sf_dir).where("area IS NOT NULL")
    return spatial.neighbor_values(_edges(spark, sf_dir), cells, "cell_id", "area").select("src", F.round("mean", 4).alias("mean"))


def neighbor_tabulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spatial.neighbor_tabulate(_edges(spark, sf_dir), domain.points(spark, sf_dir), "cell_id", "cell_type")
    return found.select("src", "cell_type", "n", F.round("share", 8).alias("share"))


def neighborhood_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.neighborhood_expression(_edges(spark, sf_dir), domain.counts(spark, sf_dir).where("assay = 'RNA'")).select("src", "gene", F.round("mean", 8).alias("mean"))


def cell_kinds(spark: SparkSession, sf_dir: str) -> list[str]:
    """Names of the cell types, sorted: the columns of a profile; more than a factor may have are refused."""
    return sorted(r[0] for r in few(domain.cells(spark, sf_dir).where("cell_type IS NOT NULL").select("cell_type").distinct()))


def neighbor_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of each type for each cell, 0 where there are none: the cell by type matrix, a row per entry."""
    points = domain.points(spark, sf_dir)
    kinds = points.where("cell_type IS NOT NULL").select("cell_type").distinct()
    held = spatial.local_profile(_edges(spark, sf_dir), points, "cell_id", "cell_type")
    return for_each_level(points.select("cell_id"), kinds).join(held, ["cell_id", "cell_type"], "left").fillna(0, ["n"])


def neighborhood_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spatial.neighborhood_summary(_edges(spark, sf_dir), domain.points(spark, sf_dir), "cell_id", ["area", "cell_type"])
    return found.select("src", "variable", "level", F.round("value", 4).alias("value"))


def moran_uni(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.moran(_edges(spark, sf_dir), domain.points(spark, sf_dir), "fov", "cell_id", "area").select("fov", "n", F.round("moran", 8).alias("moran"))


def moran_bi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.moran(_edges(spark, sf_dir), domain.points(spark, sf_dir), "fov", "cell_id", "area", "mean_panck").select("fov", "n", F.round("moran", 8).alias("moran"))


def lisa_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.lisa(_edges(spark, sf_dir), domain.points(spark, sf_dir), "fov", "cell_id", "area").select("cell_id", (F.round("lisa", 1) + F.lit(0.0)).alias("lisa"))


def lisa_bi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.lisa(_edges(spark, sf_dir), domain.points(spark, sf_dir), "fov", "cell_id", "area", "mean_panck").select("cell_id", (F.round("lisa", 1) + F.lit(0.0)).alias("lisa"))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ligand-receptor scores of every row of the pair table."""
    return spatial.lr_table_scores(_edges(spark, sf_dir), domain.cells(spark, sf_dir), domain.counts(spark, sf_dir), imports.csv_pairs(spark, sf_dir), "fov", "cell_id", "cell_type")


def ab_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("fov", "ligand_type", "receptor_type", "ligand_cell", "receptor_cell", F.round("dist", 6).alias("dist")).distinct()


def lr_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select(
        "fov", "ligand", "receptor", "ligand_cell", "receptor_cell", "lr_score", F.round("overall", 8).alias("overall"), F.round("overall_normalized", 10).alias("overall_normalized")
    )


def signaling_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spatial.signaling_table(_edges(spark, sf_dir), domain.points(spark, sf_dir), domain.counts(spark, sf_dir), imports.csv_pairs(spark, sf_dir), "fov", "cell_id", "cell_type")
    return found.select("ligand", "receptor", "anchor_type", "target_type", "cell_id", F.round("score", 5).alias("score"))


def quadrat_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.quadrat_counts(domain.points(spark, sf_dir), "fov", 5, 5)


def quadrat_chi2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spatial.quadrat_test(spatial.quadrat_counts(domain.points(spark, sf_dir), "fov", 5, 5), "fov")
    return found.select("fov", "n", F.round("chi2", 7).alias("chi2"), "df", F.round("vmr", 7).alias("vmr"))


def quadrat_test_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spatial.quadrat_test(spatial.quadrat_counts(domain.points(spark, sf_dir), "fov", 5, 5), "fov")
    return found.select("fov", "n", F.round(chi2_upper_col(F.col("chi2"), F.col("df")), 7).alias("p"))


def quadrat_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = domain.points(spark, sf_dir).groupBy("fov").agg((F.max("x") - F.min("x")).alias("width"), (F.max("y") - F.min("y")).alias("height"), F.count(F.lit(1)).alias("n"))
    return spatial.quadrat_suggestions(box, "fov")


QUERIES = {
    f.__name__: f
    for f in (
        slide_offset, radius_edges, knn_edges, neighbor_sum, neighbor_mean, neighbor_tabulate, neighborhood_expression, neighbor_profile, neighborhood_summary,
        moran_uni, moran_bi, lisa_local, lisa_bi, ab_pairs, lr_score, signaling_score, quadrat_counts, quadrat_chi2, quadrat_test_p, quadrat_grids,
    )
}

EDGES = (
    domain.SQL
    + f""", edges AS (
        SELECT a.fov, a.cell_id AS src, b.cell_id AS dst, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist
        FROM pts a JOIN pts b ON a.fov = b.fov AND a.cell_id <> b.cell_id
            AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {RADIUS * RADIUS}::DOUBLE
    )
"""
)
_DEV = """, dev AS (SELECT fov, cell_id, area - avg(area) OVER w AS dx, {y} - avg({y}) OVER w AS dy FROM pts
        WHERE area IS NOT NULL AND {y} IS NOT NULL WINDOW w AS (PARTITION BY fov))
"""
_MORAN = """SELECT s.fov, s.n, round(s.n / (sqrt(sx) * sqrt(sy)) * c / w, 8) AS moran
    FROM (SELECT fov, count(*) AS n, sum(dx * dx) AS sx, sum(dy * dy) AS sy FROM dev GROUP BY fov) s
    LEFT JOIN (SELECT e.fov, sum(a.dx * b.dy) AS c, count(*) AS w FROM edges e JOIN dev a ON e.src = a.cell_id JOIN dev b ON e.dst = b.cell_id GROUP BY 1) x ON s.fov = x.fov"""
_LISA = """SELECT d.cell_id, round(dx * coalesce(lag, 0), {digits}) + 0.0::DOUBLE AS lisa FROM dev d
    LEFT JOIN (SELECT src, sum(b.dy) AS lag FROM edges e JOIN dev b ON e.dst = b.cell_id GROUP BY src) l ON d.cell_id = l.src"""
_AREAS = "(SELECT src, count(*) AS degree, sum(area) AS total FROM edges JOIN pts ON dst = cell_id WHERE dist > 0 AND area IS NOT NULL GROUP BY src)"
_QUADS = """(SELECT b.fov, qx::INT AS qx, qy::INT AS qy, coalesce(n, 0) AS n FROM (SELECT DISTINCT fov FROM pts) b CROSS JOIN range(5) u(qx) CROSS JOIN range(5) v(qy)
    LEFT JOIN (SELECT p.fov, CASE WHEN x1 > x0 THEN least(4, floor((x - x0) / (x1 - x0) * 5))::INT ELSE 0 END AS px, CASE WHEN y1 > y0 THEN least(4, floor((y - y0) / (y1 - y0) * 5))::INT ELSE 0 END AS py, count(*) AS n
        FROM pts p JOIN (SELECT fov, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts GROUP BY fov) w ON p.fov = w.fov GROUP BY 1, 2, 3) c
    ON b.fov = c.fov AND qx = px AND qy = py)"""


LR = (
    EDGES
    + imports.LR_TABLE
    + """, met AS (SELECT e.fov, l.ligand, l.receptor, unit1, unit2, l.ligand_cell AS ligand_type, l.receptor_cell AS receptor_type, src, dst, dist FROM edges e JOIN pts a ON src = a.cell_id JOIN pts b ON dst = b.cell_id
        JOIN lr l ON a.cell_type = l.ligand_cell AND b.cell_type = l.receptor_cell WHERE l.ligand_cell <> l.receptor_cell OR src < dst
    ), scored AS (SELECT m.*, coalesce(l.count, 0) * CASE WHEN unit2 IS NULL THEN coalesce(r1.count, 0) WHEN unit1 IS NULL THEN coalesce(r2.count, 0) ELSE least(coalesce(r1.count, 0), coalesce(r2.count, 0)) END AS lr_score
        FROM met m LEFT JOIN counts l ON l.cell_id = src AND l.gene = m.ligand LEFT JOIN counts r1 ON r1.cell_id = dst AND r1.gene = unit1 LEFT JOIN counts r2 ON r2.cell_id = dst AND r2.gene = unit2
    ), lr_scores AS (SELECT s.fov, ligand, receptor, ligand_type, receptor_type, src AS ligand_cell, dst AS receptor_cell, dist, lr_score, avg(lr_score) OVER w AS overall, avg(lr_score) OVER w / n AS overall_normalized
        FROM scored s JOIN (SELECT fov, count(*) AS n FROM cells GROUP BY fov) c ON s.fov = c.fov WINDOW w AS (PARTITION BY s.fov, ligand, receptor, ligand_type, receptor_type))
"""
)
_SIGNALS = (
    EDGES
    + imports.LR_TABLE
    + """, signals AS (SELECT DISTINCT ligand, coalesce(unit1, unit2) AS receptor, receptor_cell AS anchor_type, ligand_cell AS target_type FROM lr
    ), sizes AS (SELECT fov, count(*) AS n FROM pts GROUP BY 1
    ), m AS (SELECT z.fov, g.gene, n, coalesce(s1, 0)::DOUBLE / n AS mean, CASE WHEN n > 1 AND (coalesce(s2, 0) - coalesce(s1, 0)::DOUBLE * coalesce(s1, 0) / n) / (n - 1) > 1e-12
            THEN sqrt((coalesce(s2, 0) - coalesce(s1, 0)::DOUBLE * coalesce(s1, 0) / n) / (n - 1)) END AS sd
        FROM sizes z CROSS JOIN (SELECT ligand AS gene FROM signals UNION SELECT receptor FROM signals) g LEFT JOIN (
            SELECT fov, gene, sum(count) AS s1, sum(count * count) AS s2 FROM counts c JOIN pts p ON c.cell_id = p.cell_id GROUP BY 1, 2) s ON z.fov = s.fov AND g.gene = s.gene
    ), lev AS (SELECT p.cell_id, p.cell_type, m.gene, exp((coalesce(c.count, 0) - mean) / sd) AS z FROM pts p JOIN m ON p.fov = m.fov LEFT JOIN counts c ON c.cell_id = p.cell_id AND c.gene = m.gene WHERE p.cell_type IS NOT NULL
    ), near AS (SELECT src, t.cell_type AS target_type, t.gene AS ligand, sum(t.z) AS near, count(*) AS k FROM edges JOIN lev t ON dst = t.cell_id GROUP BY 1, 2, 3)
"""
)
SQL = {
    "slide_offset": domain.SQL
    + """SELECT cell_id, round(x + (i % k) * w * 1.2, 5) AS x_adj, round(y + (i // k) * h * 1.2, 5) AS y_adj FROM pts p
        JOIN (SELECT slide, row_number() OVER (ORDER BY slide) - 1 AS i FROM (SELECT DISTINCT slide FROM pts)) s ON p.slide = s.slide,
        (SELECT max(x) - min(x) AS w, max(y) - min(y) AS h, ceil(sqrt(count(DISTINCT slide)))::BIGINT AS k FROM pts)""",
    "radius_edges": EDGES + "SELECT src, dst, round(dist, 6) AS dist FROM edges",
    "knn_edges": domain.SQL
    + f"""SELECT src, dst, round(sqrt(d2), 6) AS dist, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d2, dst) AS rank FROM (
        SELECT a.cell_id AS src, b.cell_id AS dst, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2
        FROM pts a JOIN pts b ON a.fov = b.fov AND a.cell_id <> b.cell_id)) WHERE rank <= {K}""",
    "neighbor_sum": EDGES + f"SELECT cell_id AS src, coalesce(degree, 0) AS degree, round(coalesce(total, 0), 4) AS total FROM pts LEFT JOIN {_AREAS} s ON cell_id = s.src WHERE area IS NOT NULL",
    "neighbor_mean": EDGES + f"SELECT cell_id AS src, round(coalesce(total, 0) / greatest(coalesce(degree, 0), 1), 4) AS mean FROM pts LEFT JOIN {_AREAS} s ON cell_id = s.src WHERE area IS NOT NULL",
    "neighbor_tabulate": EDGES
    + """SELECT src, cell_type, n, round(n / sum(n) OVER (PARTITION BY src), 8) AS share
        FROM (SELECT src, cell_type, count(*) AS n FROM edges JOIN pts ON dst = cell_id WHERE dist > 0 AND cell_type IS NOT NULL GROUP BY 1, 2)""",
    "neighborhood_expression": EDGES
    + """SELECT s.src, gene, round(s::DOUBLE / degree, 8) AS mean FROM (SELECT src, gene, sum(count) AS s FROM edges JOIN counts c ON dst = c.cell_id WHERE assay = 'RNA' GROUP BY 1, 2) s
        JOIN (SELECT src, count(*) AS degree FROM edges GROUP BY 1) d ON s.src = d.src""",
    "neighbor_profile": EDGES
    + """SELECT p.cell_id, k.cell_type, coalesce(n, 0) AS n FROM pts p CROSS JOIN (SELECT DISTINCT cell_type FROM pts WHERE cell_type IS NOT NULL) k
        LEFT JOIN (SELECT src, cell_type, count(*) AS n FROM edges JOIN pts ON dst = cell_id GROUP BY 1, 2) e ON p.cell_id = e.src AND k.cell_type = e.cell_type""",
    "neighborhood_summary": EDGES
    + f"""SELECT cell_id AS src, 'area' AS variable, NULL::VARCHAR AS level, round(coalesce(total, 0), 4) AS value FROM pts LEFT JOIN {_AREAS} s ON cell_id = s.src WHERE area IS NOT NULL
        UNION ALL SELECT src, 'cell_type', cell_type, count(*)::DOUBLE FROM edges JOIN pts ON dst = cell_id WHERE dist > 0 AND cell_type IS NOT NULL GROUP BY 1, 3""",
    "moran_uni": EDGES + _DEV.format(y="area") + _MORAN,
    "moran_bi": EDGES + _DEV.format(y="mean_panck") + _MORAN,
    "lisa_local": EDGES + _DEV.format(y="area") + _LISA.format(digits=1),
    "lisa_bi": EDGES + _DEV.format(y="mean_panck") + _LISA.format(digits=1),
    "ab_pairs": LR + "SELECT DISTINCT fov, ligand_type, receptor_type, ligand_cell, receptor_cell, round(dist, 6) AS dist FROM lr_scores",
    "lr_score": LR + "SELECT fov, ligand, receptor, ligand_cell, receptor_cell, lr_score, round(overall, 8) AS overall, round(overall_normalized, 10) AS overall_normalized FROM lr_scores",
    "signaling_score": _SIGNALS
    + """SELECT s.ligand, s.receptor, anchor_type, s.target_type, r.cell_id, CASE WHEN k IS NULL THEN 0.0 ELSE round(r.z * near, 5) END AS score FROM signals s JOIN lev r ON r.cell_type = anchor_type AND r.gene = s.receptor
        LEFT JOIN near n ON r.cell_id = n.src AND s.ligand = n.ligand AND s.target_type = n.target_type""",
    "quadrat_test_p": domain.SQL
    + f"""SELECT fov, n, round({chi2_upper("chi2", "df")}, 7) AS p FROM (SELECT fov, sum(n)::BIGINT AS n, sum(n * n)::DOUBLE / (sum(n)::DOUBLE / count(*)) - sum(n)::DOUBLE AS chi2, (count(*) - 1)::INT AS df FROM {_QUADS} GROUP BY fov)""",
    "quadrat_counts": domain.SQL + f"SELECT fov, qx, qy, n FROM {_QUADS}",
    "quadrat_chi2": domain.SQL
    + f"""SELECT fov, n, round(chi2, 7) AS chi2, df, round(chi2 / df, 7) AS vmr FROM (SELECT fov, sum(n)::BIGINT AS n, sum(n * n)::DOUBLE / (sum(n)::DOUBLE / count(*)) - sum(n)::DOUBLE AS chi2,
        (count(*) - 1)::INT AS df FROM {_QUADS} GROUP BY fov)""",
    "quadrat_grids": domain.SQL
    + """SELECT fov, nx, ny, nx * ny AS quadrats, round(n / (nx * ny)::DOUBLE, 2) AS points_per_quadrat FROM (
        SELECT fov, n, nx::INT AS nx, greatest(1, round_even(nx * h / w, 0)::INT) AS ny FROM (SELECT fov, count(*) AS n, max(x) - min(x) AS w, max(y) - min(y) AS h FROM pts GROUP BY fov), range(2, 11) r(nx)
        WHERE w > 0 AND h > 0) WHERE n / (nx * ny)::DOUBLE BETWEEN 5 AND 10""",
}
