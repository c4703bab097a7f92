"""Queries of the FOV quality control."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import saved
from ..functions.tails_sql import t_upper
from ..operators import fovqc
from . import domain

MIN_CELLS = 4
CYCLES = 8
MAX_LOSS = 0.3
#: The manifest is made at the smallest loss and a loose level, so that the tables have flagged genes at all.
LOOSE_ALPHA = 0.05
# The losses that are tried.
LOSSES = [0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


def _rna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.counts(spark, sf_dir).where("assay = 'RNA'")


def _gene_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fovqc.gene_bits(domain.genes(spark, sf_dir).where("assay = 'RNA'"))


def _bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    squares = fovqc.grid_squares(domain.points(spark, sf_dir), min_cells=MIN_CELLS)
    return fovqc.square_bits(squares, _rna(spark, sf_dir), _gene_bits(spark, sf_dir), CYCLES)


def _residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = saved(fovqc.normalized_bits(_bits(spark, sf_dir)))  # used three times below
    return fovqc.residuals(bits, fovqc.comparators(bits))


def fov_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fovqc.grid_squares(domain.points(spark, sf_dir), min_cells=MIN_CELLS).select("cell_id", "square")


def square_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _bits(spark, sf_dir).select("square", "n_cells", F.round("total", 8).alias("total"), F.posexplode("bits").alias("bit", "mean"))
    return long.withColumn("mean", F.round("mean", 8))


def square_comparators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fovqc.comparators(saved(fovqc.normalized_bits(_bits(spark, sf_dir))))


def fov_total_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _residuals(spark, sf_dir).select("square", (F.round("total_residual", 6) + F.lit(0.0)).alias("total_residual"))


def fov_low_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fovqc.low_total_fovs(_residuals(spark, sf_dir), MAX_LOSS).select("fov", F.round("share_low", 6).alias("share_low"), "flag_total")


def fov_bit_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _residuals(spark, sf_dir).select("square", F.posexplode("residuals").alias("bit", "residual"))
    return long.withColumn("residual", F.round("residual", 6) + F.lit(0.0))


def fov_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fovqc.fov_bias(_residuals(spark, sf_dir), [MAX_LOSS])
    return found.select("fov", "bit", (F.round("bias", 6) + F.lit(0.0)).alias("bias"), (F.round("t", 4) + F.lit(0.0)).alias("t"), "df", F.round("agree", 6).alias("agree"))


def fov_flag_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    resid = saved(_residuals(spark, sf_dir))
    return fovqc.flag_sweep(fovqc.bit_flags(fovqc.fov_bias(resid, LOSSES)), fovqc.low_total_fovs(resid, MAX_LOSS))


def fov_flagged_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = fovqc.bit_flags(fovqc.fov_bias(_residuals(spark, sf_dir), [LOSSES[0]]), LOOSE_ALPHA)
    return fovqc.flagged_genes(fovqc.cycle_flags(flags), _gene_bits(spark, sf_dir))


def fov_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FOVs flagged for bias in a cycle, for total counts, or for either."""
    resid = saved(_residuals(spark, sf_dir))
    return fovqc.flagged_fovs(fovqc.cycle_flags(fovqc.bit_flags(fovqc.fov_bias(resid, [MAX_LOSS]))), fovqc.low_total_fovs(resid, MAX_LOSS))


def fov_plot_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares as boxes with their clipped residuals, and whether their FOV is flagged."""
    squares = fovqc.grid_squares(domain.points(spark, sf_dir), min_cells=MIN_CELLS)
    boxes = fovqc.square_boxes(squares, domain.points(spark, sf_dir))
    found = boxes.join(fovqc.clipped_totals(_residuals(spark, sf_dir)), "square").join(fov_flags(spark, sf_dir).select("fov", "flagged"), "fov")
    return found.select("fov", "square", "x_min", "x_max", "y_min", "y_max", F.round("clipped", 6).alias("clipped"), "flagged")


QUERIES = {
    f.__name__: f
    for f in (fov_grid, square_bits, square_comparators, fov_total_residual, fov_low_total, fov_bit_residual, fov_bias, fov_flag_sweep, fov_flagged_genes, fov_flags, fov_plot_squares)
}

_GRID = domain.SQL + f""", placed AS (
        SELECT slide, p.fov, cell_id, p.fov || '_' || CASE WHEN x1 > x0 THEN greatest(1, ceil((x - x0) / (x1 - x0) * 7))::INT ELSE 1 END || '_'
            || CASE WHEN y1 > y0 THEN greatest(1, ceil((y - y0) / (y1 - y0) * 7))::INT ELSE 1 END AS square
        FROM pts p JOIN (SELECT fov, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts GROUP BY fov) b ON p.fov = b.fov
    ), squares AS (SELECT * FROM placed WHERE square IN (SELECT square FROM placed GROUP BY square HAVING count(*) >= {MIN_CELLS})
    ), gene_bits AS (
        SELECT gene, cycle, colour, (cycle - 1) * 4 + strpos('BGYR', colour) - 1 AS bit FROM (SELECT gene, cycle, substr(barcode, 2 * cycle, 1) AS colour
            FROM genes, range(1, {CYCLES} + 1) r(cycle) WHERE assay = 'RNA' AND barcode IS NOT NULL) WHERE colour IN ('B', 'G', 'Y', 'R')
    ), sq AS (SELECT slide, fov, square, count(*) AS n_cells FROM squares GROUP BY ALL
    ), bit_sums AS (SELECT square, bit, sum(count) AS s FROM counts c JOIN squares q ON c.cell_id = q.cell_id JOIN gene_bits g ON c.gene = g.gene WHERE c.assay = 'RNA' GROUP BY ALL
    ), tot AS (SELECT square, sum(count) AS t FROM counts c JOIN squares q ON c.cell_id = q.cell_id WHERE c.assay = 'RNA' GROUP BY ALL
    ), bits AS (
        SELECT slide, fov, sq.square, n_cells, t / n_cells::DOUBLE AS total, r.bit::INT AS bit, coalesce(s, 0) / n_cells::DOUBLE AS mean
        FROM sq JOIN tot ON sq.square = tot.square CROSS JOIN range({CYCLES * 4}) r(bit) LEFT JOIN bit_sums b ON sq.square = b.square AND r.bit = b.bit
        WHERE sq.square IN (SELECT square FROM bit_sums)
    )
"""
_RESID = _GRID + f""", sums AS (SELECT slide, square, sum(mean) AS rs FROM bits GROUP BY ALL
    ), norm AS (SELECT b.*, mean / rs * ms AS v FROM bits b JOIN sums s ON b.square = s.square JOIN (SELECT slide, avg(rs) AS ms FROM sums GROUP BY slide) m ON b.slide = m.slide
    ), near AS (SELECT *, row_number() OVER (PARTITION BY square ORDER BY d2, other) AS r FROM (
        SELECT a.square, a.fov, b.square AS other, b.fov AS other_fov, round(sum((a.v - b.v) * (a.v - b.v)), 6) AS d2 FROM norm a JOIN norm b ON a.slide = b.slide AND a.bit = b.bit GROUP BY ALL)
    ), firsts AS (SELECT *, row_number() OVER (PARTITION BY square, other_fov ORDER BY d2, other) AS k FROM near WHERE r <= {fovqc.NEAREST} AND other_fov <> fov
    ), comp AS (SELECT * FROM (SELECT square, other, row_number() OVER (PARTITION BY square ORDER BY d2, other)::INT AS place FROM firsts WHERE k = 1) WHERE place <= {fovqc.PER_SQUARE}
    ), hat AS (SELECT c.square, n.bit, avg(n.v) AS y, avg(n.total) AS ht FROM comp c JOIN norm n ON c.other = n.square GROUP BY ALL
    ), resid AS (SELECT n.slide, n.fov, n.square, n.bit, log2(n.total / ht) AS tr, log2((n.v + 1) / (y + 1)) AS r FROM norm n JOIN hat h ON n.square = h.square AND n.bit = h.bit)
"""
def _cycles(losses: str, alpha: float = 0.01) -> str:
    """cycles: share of flagged bits per FOV, loss and cycle; low: FOVs flagged by total counts."""
    return f""", losses AS (SELECT unnest({losses}::DOUBLE[]) AS loss
    ), stats AS (SELECT f.*, df, CASE WHEN df > 0 AND ss > 1e-12 THEN bias / sqrt(ss / df / n) END AS t
        FROM (SELECT slide, fov, bit, count(*) AS n, avg(r) AS bias, sum(r * r) AS s2 FROM resid GROUP BY ALL) f
        JOIN (SELECT slide, bit, (sum(n) - count(*))::BIGINT AS df, sum(s2 - n * bias * bias) AS ss FROM
            (SELECT slide, fov, bit, count(*) AS n, avg(r) AS bias, sum(r * r) AS s2 FROM resid GROUP BY ALL) GROUP BY ALL) p ON f.slide = p.slide AND f.bit = p.bit
    ), tested AS (SELECT *, 2 * {t_upper("abs(t)", "df")} AS p FROM stats
    ), agreeing AS (SELECT slide, fov, bit, loss, avg(CASE WHEN r < log2(1 - loss) / 3 THEN 1.0 ELSE 0.0 END) AS agree FROM resid, losses GROUP BY ALL
    ), cycles AS (SELECT t.slide, t.fov, loss, (t.bit // 4)::INT + 1 AS cycle, avg(CASE WHEN bias < log2(1 - loss) AND p < {alpha} AND agree >= 0.5 THEN 1.0 ELSE 0.0 END) AS share
        FROM tested t JOIN agreeing a ON t.slide = a.slide AND t.fov = a.fov AND t.bit = a.bit GROUP BY ALL
    ), low AS (SELECT slide, fov, avg(CASE WHEN tr < log2(1 - {MAX_LOSS}) THEN 1.0 ELSE 0.0 END) > 0.75 AS flag_total FROM resid WHERE bit = 0 GROUP BY ALL)
"""


_FLAGS = _RESID + _cycles(str([MAX_LOSS])) + f""", fov_flags AS (SELECT l.slide, l.fov, max(share) >= 0.5 AS flag_bias, any_value(flag_total) AS flag_total, max(share) >= 0.5 OR any_value(flag_total) AS flagged
        FROM low l JOIN cycles c ON l.slide = c.slide AND l.fov = c.fov GROUP BY ALL)
"""
SQL = {
    "fov_flag_sweep": _RESID
    + _cycles(str(LOSSES))
    + """SELECT slide, loss, sum(b)::BIGINT AS n_bias, sum(t)::BIGINT AS n_total, sum(greatest(b, t))::BIGINT AS n_flagged FROM (
        SELECT c.slide, c.fov, loss, (max(share) >= 0.5)::INT AS b, any_value(flag_total)::INT AS t FROM cycles c JOIN low l ON c.fov = l.fov GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    "fov_flagged_genes": _RESID + _cycles(str(LOSSES[:1]), LOOSE_ALPHA) + "SELECT DISTINCT fov, gene FROM cycles c JOIN gene_bits g ON c.cycle = g.cycle WHERE share >= 0.5",
    "fov_flags": _FLAGS + "SELECT slide, fov, flag_bias, flag_total, flagged FROM fov_flags",
    "fov_plot_squares": _FLAGS
    + """SELECT q.fov, q.square, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, round(any_value(greatest(-1.0, least(1.0, tr))), 6) + 0.0::DOUBLE AS clipped, any_value(flagged) AS flagged
        FROM squares q JOIN pts p ON q.cell_id = p.cell_id JOIN (SELECT DISTINCT square, tr FROM resid WHERE bit = 0) r ON q.square = r.square JOIN fov_flags f ON q.fov = f.fov GROUP BY 1, 2""",
    "fov_grid": _GRID + "SELECT cell_id, square FROM squares",
    "square_bits": _GRID + "SELECT square, n_cells, round(total, 8) AS total, bit, round(mean, 8) AS mean FROM bits",
    "square_comparators": _RESID + "SELECT square, other, place FROM comp",
    "fov_total_residual": _RESID + "SELECT DISTINCT square, round(tr, 6) + 0.0::DOUBLE AS total_residual FROM resid",
    "fov_low_total": _RESID
    + f"""SELECT fov, round(avg(CASE WHEN tr < log2(1 - {MAX_LOSS}) THEN 1.0 ELSE 0.0 END), 6) AS share_low, avg(CASE WHEN tr < log2(1 - {MAX_LOSS}) THEN 1.0 ELSE 0.0 END) > 0.75 AS flag_total
        FROM resid WHERE bit = 0 GROUP BY fov""",
    "fov_bit_residual": _RESID + "SELECT square, bit, round(r, 6) + 0.0::DOUBLE AS residual FROM resid",
    "fov_bias": _RESID
    + f"""SELECT f.fov, f.bit, round(bias, 6) + 0.0::DOUBLE AS bias, round(CASE WHEN df > 0 AND ss > 1e-12 THEN bias / sqrt(ss / df / n) END, 4) + 0.0::DOUBLE AS t, df, round(agree, 6) AS agree
        FROM (SELECT slide, fov, bit, count(*) AS n, avg(r) AS bias, sum(r * r) AS s2, avg(CASE WHEN r < log2(1 - {MAX_LOSS}) / 3 THEN 1.0 ELSE 0.0 END) AS agree FROM resid GROUP BY ALL) f
        JOIN (SELECT slide, bit, (sum(n) - count(*))::BIGINT AS df, sum(s2 - n * bias * bias) AS ss FROM
            (SELECT slide, fov, bit, count(*) AS n, avg(r) AS bias, sum(r * r) AS s2 FROM resid GROUP BY ALL) GROUP BY ALL) p ON f.slide = p.slide AND f.bit = p.bit""",
}
