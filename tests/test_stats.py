"""Formulas on small hand-computed cases, and tails against published tables."""

import math
import random
import statistics

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import tails, tails_sql
from cellweave.functions.values import among, ratio
from cellweave.operators import normalize, qc, transcripts
from tests.helpers import rows


@pytest.mark.parametrize("t,df,p", [(2.228, 10, 0.025), (1.812, 10, 0.05), (6.314, 1, 0.05), (2.576, 1e7, 0.005), (0.0, 5, 0.5), (-1.812, 10, 0.95)])
def test_student(t, df, p):
    assert float(tails.t_upper(t, df)) == pytest.approx(p, abs=2e-4)


@pytest.mark.parametrize("x,df,p", [(3.841, 1, 0.05), (18.307, 10, 0.05), (124.342, 100, 0.05), (0.0, 3, 1.0), (6.635, 1, 0.01)])
def test_chi_squared(x, df, p):
    assert float(tails.chi2_upper(x, df)) == pytest.approx(p, abs=1e-4)


def test_normal_quantile(spark):
    ps = [1e-9, 0.001, 0.02425, 0.3, 0.5, 0.975, 1 - 1e-7]
    got = [r.z for r in spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0, None]], "p double").select(tails.normal_quantile_col(F.col("p")).alias("z")).collect()]
    assert got[:-3] == pytest.approx([statistics.NormalDist().inv_cdf(p) for p in ps], rel=3e-9, abs=1e-8) and got[-3:] == [None] * 3


def test_tails_in_sql():
    con = duckdb.connect()
    of = lambda sql: con.execute(f"SELECT {sql}").fetchone()[0]
    for t, df in [(0.0, 3), (1.5, 1), (-1.0, 10), (3.0, 2000), (1.96, 1e6), (0.1, 1e5)]:
        assert of(tails_sql.t_upper(str(t), str(df))) == pytest.approx(float(tails.t_upper(t, df)), abs=1e-9)
    for x, df in [(24.0, 24), (2.0, 2), (500.0, 24), (3.0, 8)]:
        assert of(tails_sql.chi2_upper(str(x), str(df))) == pytest.approx(float(tails.chi2_upper(x, df)), abs=1e-9)
    for z in (0.0, 1.96, -2.0, 5.0):
        assert of(tails_sql.normal_upper(str(z))) == pytest.approx(1 - statistics.NormalDist().cdf(z), abs=1e-9)
    for p in (1e-6, 0.3, 0.999):
        assert of(tails_sql.normal_quantile(f"{p}::DOUBLE")) == pytest.approx(statistics.NormalDist().inv_cdf(p), abs=1e-8)


def test_tail_columns_keep_nulls(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (2.0, None)], "t double, n double")
    got = [r.p for r in df.select(tails.t_upper_col(F.col("t"), F.col("n")).alias("p")).collect()]
    assert got[0] == pytest.approx(0.18161, abs=1e-4) and got[1:] == [None, None]


def test_ratio_and_membership(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.5, math.inf, None, None]
    names = spark.createDataFrame([("x",), (None,)], "v string")
    assert [r[0] for r in names.select(~among(F.col("v"), ["x"])).collect()] == [False, True]


CELLS = [("c1", "s", "f", 10.0), ("c2", "s", "f", 20.0), ("c3", "s", "g", None)]
COUNTS = [("c1", "A", "RNA", 6), ("c1", "B", "RNA", 2), ("c1", "N", "negative", 2), ("c2", "A", "RNA", 4), ("c2", "K", "bacterial", 3)]


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(CELLS, "cell_id string, slide string, fov string, area double")


@pytest.fixture
def counts(spark):
    return spark.createDataFrame(COUNTS, "cell_id string, gene string, assay string, count long")


def test_cell_metrics_and_flags(cells, counts):
    totals = qc.cell_totals(cells, counts)
    assert rows(totals, "cell_id", "n_count", "n_feature", "n_neg", "n_bac") == {("c1", 8, 2, 2, 0), ("c2", 4, 1, 0, 3), ("c3", 0, 0, 0, 0)}
    metrics = qc.cell_metrics(totals, 4, 2)
    assert rows(metrics, "cell_id", "proportion_negative", "complexity", "signal_strength") == {("c1", 0.2, 4.0, 2.0), ("c2", 0.0, 4.0, math.inf), ("c3", None, None, None)}
    limits = qc.Limits(min_counts=5, max_negative=0.5, min_complexity=1)
    flags = qc.cell_flags(metrics, limits)
    assert rows(flags, "cell_id", "flag_counts", "flag_negative", "flagged") == {("c1", False, False, False), ("c2", True, False, True), ("c3", True, None, None)}
    area = cells.where("cell_id = 'c1'").select("area")
    assert rows(qc.cell_flags(metrics, limits, area), "cell_id", "flag_area") == {("c1", True), ("c2", False), ("c3", False)}
    summary = dict(rows(qc.qc_summary(metrics, limits)))
    assert summary["total_cells"] == 3 and summary["average_signal_strength"] == 2.0 and summary["flagged_total_counts"] == 2 and summary["total_fovs"] == 2
    table = dict(rows(qc.flagged_table(metrics, limits)))
    assert table["min_counts"] == 2 and table["total_flagged"] + table["total_passed"] == table["all_cells"] == 3


def test_moments_count_zeros(spark, counts):
    genes = spark.createDataFrame([("A", "RNA"), ("B", "RNA"), ("Z", "RNA")], "gene string, assay string")
    got = {r.gene: (r.mean, r.sd) for r in qc.gene_moments(counts, genes, 4).collect()}
    assert got["A"] == (2.5, pytest.approx(3.0)) and got["B"] == (0.5, pytest.approx(1.0)) and got["Z"] == (0.0, 0.0)


def test_adjusted_p_with_ties(spark):
    df = spark.createDataFrame([("g", "a", 0.01), ("g", "b", 0.02), ("g", "c", 0.02), ("g", "d", 0.9), ("g", "e", None), ("h", "a", 0.5)], "s string, k string, p double")
    got = {(r.s, r.k): r.p_adj for r in qc.adjusted(df, "p", ["s"], "k").collect()}
    assert got["g", "a"] == pytest.approx(0.08 / 3) and got["g", "b"] == got["g", "c"] == pytest.approx(0.08 / 3)
    assert got["g", "d"] == pytest.approx(0.9) and got["g", "e"] is None and got["h", "a"] == 0.5


def test_grubbs(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 40.0)], "v double")
    r = qc.grubbs(qc.extremes(df, "v")).first()
    assert r.g10 == pytest.approx(1.7846, abs=1e-3) and 0 < r.p10 < 0.01
    assert qc.extremes(df.where("v = 1"), "v").first().g10 is None


def test_normalization(counts):
    got = {(r.cell_id, r.gene): r.norm for r in normalize.normalized_counts(counts.where("assay = 'RNA'"), 5).collect()}
    assert got == {("c1", "A"): 0.75, ("c1", "B"): 0.25, ("c2", "A"): 0.8}
    by_gene = {(r.cell_id, r.gene): r.norm for r in normalize.normalized_counts(counts.where("assay = 'RNA'"), 1, "gene").collect()}
    assert by_gene["c1", "A"] == 0.6
    assert rows(normalize.background_normalized(counts, 4, 2)) == {("c2", "K", 12.0)}


def test_box_and_levels(spark):
    data = [("c", 0.0, 0.0, 0.0, "T"), ("c", 10.0, 10.0, 10.0, "T"), ("c", 5.0, 5.0, 5.0, "T"), ("d", None, float("nan"), 1.0, "T"), (None, 1.0, 1.0, 1.0, "T")]
    m = spark.createDataFrame(data, "cell string, x_local_px double, y_local_px double, z double, target string")
    boxes = transcripts.cell_boxes(m)
    r = boxes.where("cell = 'c'").first()
    assert (r.low_z, r.high_z, r.n) == (1.0, 9.0, 3)
    marked = transcripts.inside_box(m, boxes, "T")
    assert rows(marked.where("confidence = 'High'"), "cell", "z") == {("c", 5.0)}
    where = transcripts.intracellular(spark.createDataFrame([("c",), ("d",)], "cell_id string"), marked)
    assert rows(where) == {("c", "Intracellular"), ("d", "Extracellular")}


def test_filters_and_pasting(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), (None, "y")], "p string, q string")
    kept, skipped = transcripts.apply_filters(df, "p,Exclude,a;none,include,z")
    assert rows(kept) == {("b", None), (None, "y")} and skipped == ["none"]
    assert rows(transcripts.apply_filters(df, "p,include,a,b")[0]) == {("a", "x"), ("b", None)}
    with pytest.raises(ValueError):
        transcripts.apply_filters(df, "p,drop,a")
    assert rows(transcripts.neovariable(df, "p+q"), "p_q") == {("a_x",), ("b_NA",), ("NA_y",)}


def test_histogram_holds_every_value(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "v double")
    got = dict(rows(transcripts.histogram_bins(df, "v", 5)))
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}
    assert rows(transcripts.histogram_bins(df.where("v = 3"), "v", 5)) == {(1, 1)}


def test_local_fit():
    x = np.linspace(-2, 2, 80)
    np.testing.assert_allclose(normalize.local_fit(x, 1 + 2 * x - 0.5 * x * x), 1 + 2 * x - 0.5 * x * x, atol=1e-9)
    bend = normalize.local_fit(x, np.abs(x), 0.2)
    assert np.abs(bend - np.abs(x)).max() < 0.15 and abs(bend[0] - 2) < 0.02  # follows a bend that one parabola would miss
    assert len(normalize.local_fit(np.array([]), np.array([]))) == 0
    np.testing.assert_allclose(normalize.local_fit(np.ones(6), np.arange(6.0), 1.0), np.full(6, 2.5))


def test_variable_genes_stand_out(spark):
    rnd = random.Random(3)
    counts = [(f"c{c}", f"g{g:03}", 1 + rnd.randint(0, 4 + g)) for g in range(60) for c in range(150)]
    counts = [(c, g, (150 if rnd.random() < 0.1 else 1) if g == "g030" else n) for c, g, n in counts]
    df = spark.createDataFrame(counts, "cell_id string, gene string, count long")
    moments = qc.gene_moments(df, df.select("gene", F.lit("RNA").alias("assay")).distinct(), 150)
    assert normalize.variable_features(df, moments, 3).where("rank = 1").first().gene == "g030"
    assert normalize.variable_features(df.limit(0), moments.limit(0), 3).count() == 0
