"""Queries of niches, point patterns, markers, differential expression, typing and pathways."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.levels import for_each_level
from ..functions.scratch import saved
from ..functions.tails import normal_upper_col, t_upper_col
from ..functions.tails_sql import normal_quantile, normal_upper, t_upper
from ..operators import expression, niches, normalize, patterns, qc, spatial, transcripts
from ..sources.tables import table
from . import domain, imports, quality
from .space import EDGES, RADIUS, cell_kinds

RADII = [0.0, 20.0, 40.0, 60.0, 80.0, 100.0, 120.0]
KIND_I, KIND_J, KIND_K = "tumor", "fibroblast", "macrophage"
K = 5
#: k_prop_n of the reference.
CLUSTER_SHARE = 0.05
#: Simulations: the reference's 199 of an envelope and 999 of a label test; permutations of an enrichment test.
ENVELOPES, LABELS, PERMUTATIONS = 199, 999, 1000
LOOSE = 0.5
CONTRAST = ["fixed_effect", "direction", "cell_type"]


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.radius_edges(domain.points(spark, sf_dir), "fov", "cell_id", RADIUS)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.local_profile(_edges(spark, sf_dir), domain.points(spark, sf_dir), "cell_id", "cell_type")


def _wide(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    kinds = cell_kinds(spark, sf_dir)
    return saved(spatial.neighbor_profile(_edges(spark, sf_dir), domain.points(spark, sf_dir), "cell_id", "cell_type", kinds)), kinds


def _rna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.counts(spark, sf_dir).where("assay = 'RNA'")


def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return niches.cooccurrence(niches.shares(_profile(spark, sf_dir), "cell_id"), "cell_id", "cell_type").select("type_from", "type_to", F.round("weight", 7).alias("weight"))


def cooccurrence_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _cooccurring(spark, sf_dir)
    return found.select("type_from", "type_to", F.round("weight", 6).alias("weight"), F.round("z", 5).alias("z"), F.round("p", 5).alias("p"))


def _cooccurring(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = saved(niches.shares(_profile(spark, sf_dir), "cell_id"))
    weights = niches.cooccurrence(share, "cell_id", "cell_type")
    return niches.cooccurrence_test(share, weights, "cell_type", domain.points(spark, sf_dir).count())


def cooccurrence_significant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges below a loose level: types are mixed at random in the tables, so few pairs keep together at 0.05."""
    found = niches.significant_edges(_cooccurring(spark, sf_dir), LOOSE)
    return found.select("type_from", "type_to", F.round("p", 5).alias("p"), "degree")


def node_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return niches.abundance(_profile(spark, sf_dir), "cell_type").select("cell_type", F.round("abundance", 8).alias("abundance"))


def _curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = patterns.framed(domain.points(spark, sf_dir), "fov", "cell_type")
    return patterns.cross_curves(_edges(spark, sf_dir), frame, "fov", RADII)


def gcross_rs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curves(spark, sf_dir).select("fov", "type_i", "type_j", "r", "n_i", F.round("g", 8).alias("g"))


def kcross_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curves(spark, sf_dir).select("fov", "type_i", "type_j", "r", F.round("k", 3).alias("k"))


def cross_curve_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = patterns.curve_summary(_curves(spark, sf_dir), "fov", "g")
    return found.select("fov", "type_i", "type_j", F.round("auc", 6).alias("auc"), F.round("highest", 8).alias("highest"))


def sign_flip_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = saved(patterns.auc_differences(patterns.curve_summary(_curves(spark, sf_dir), "fov", "g"), "fov", KIND_I, KIND_J, KIND_K))
    found = patterns.sign_flip_test(deltas, "fov", 999, 3)
    return found.select(F.round("mean_delta", 6).alias("mean_delta"), "n", F.round("p_value", 6).alias("p_value"))


def gcross_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = saved(patterns.framed(domain.points(spark, sf_dir), "fov", "cell_type"))
    return patterns.envelope(_edges(spark, sf_dir), frame, "fov", RADII, ENVELOPES, 5)


def pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the neighbourhood profiles."""
    wide, kinds = _wide(spark, sf_dir)
    return niches.principal_components(wide, "cell_id", kinds, 5)[0]


def _expression_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells as vectors of their variable genes' log-normalized counts, each gene over its standard deviation."""
    counts = _rna(spark, sf_dir)
    norm = normalize.log_normalized(normalize.normalized_counts(counts, quality.MIN_TOTAL), normalize.scale_factors(quality._totals(spark, sf_dir)))
    n = domain.cells(spark, sf_dir).count()
    wanted = quality.variable_features(spark, sf_dir).select("gene")
    logged = saved(norm.join(wanted, "gene", "left_semi").select("cell_id", "gene", "logged"))
    sd = qc.gene_moments(logged.withColumnRenamed("logged", "count"), logged.select("gene", F.lit("RNA").alias("assay")).distinct(), n).where("sd > 0")
    scaled = logged.join(sd.select("gene", "sd"), "gene").select("cell_id", "gene", (F.col("logged") / F.col("sd")).alias("value"))
    return niches.dense_vectors(scaled, domain.cells(spark, sf_dir).select("cell_id"), "cell_id", "gene", "value")


def expression_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    return niches.vector_components(_expression_vectors(spark, sf_dir), "cell_id", 10)[0]


def _corrected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Components of the expression before and after slides are brought together."""
    scores = saved(niches.vector_components(_expression_vectors(spark, sf_dir), "cell_id", 10)[0].withColumnRenamed("pc", "v"))
    return scores, niches.batch_corrected(scores, domain.cells(spark, sf_dir).select("cell_id", "slide"), "cell_id", "slide", 8)


def batch_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corrected(spark, sf_dir)[1].withColumnRenamed("v", "pc")


def batch_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First two components of each cell with its slide, before and after the correction, in an order that hides no slide."""
    before, after = _corrected(spark, sf_dir)
    slides = domain.cells(spark, sf_dir).select("cell_id", "slide")
    rows = before.withColumn("stage", F.lit("before")).unionByName(after.select("cell_id", "v").withColumn("stage", F.lit("after")))
    return rows.join(slides, "cell_id", "left").select("cell_id", "slide", "stage", F.col("v")[0].alias("pc1"), F.col("v")[1].alias("pc2"), F.xxhash64("cell_id").alias("draw_order"))


def kmeans_niches(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide, kinds = _wide(spark, sf_dir)
    return niches.kmeans_niches(wide, "cell_id", kinds, 6)


def neighborhood_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 components of the mean expression of a cell's neighbours."""
    means = spatial.neighborhood_expression(_edges(spark, sf_dir), _rna(spark, sf_dir)).select(F.col("src").alias("cell_id"), "gene", F.col("mean").alias("value"))
    vectors = niches.dense_vectors(means, domain.points(spark, sf_dir).select("cell_id"), "cell_id", "gene", "value")
    return niches.vector_components(vectors, "cell_id", 25)[0]


def gmm_niches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten groups of the neighbourhood expression: a Gaussian mixture with one diagonal covariance."""
    scores = neighborhood_pca(spark, sf_dir).withColumnRenamed("pc", "v")
    return niches.diagonal_mixture(scores, "cell_id", 10)


def niche_silhouettes(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide, kinds = _wide(spark, sf_dir)
    return niches.silhouettes(wide, "cell_id", kinds, [2, 4, 6])


def niche_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean number of neighbours of each type per annotated niche, cells without any included."""
    points = domain.points(spark, sf_dir)
    known = points.where("niche IS NOT NULL").select("cell_id", "niche")
    sizes = known.groupBy("niche").agg(F.count(F.lit(1)).alias("n_cells"))
    sums = _profile(spark, sf_dir).join(known, "cell_id").groupBy("niche", "cell_type").agg(F.sum("n").alias("s"))
    kinds = points.where("cell_type IS NOT NULL").select("cell_type").distinct()
    return for_each_level(sizes, kinds).join(sums, ["niche", "cell_type"], "left").select("niche", "cell_type", F.round(F.coalesce("s", F.lit(0)) / F.col("n_cells"), 7).alias("mean"))


def _fov_niches(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide, kinds = _wide(spark, sf_dir)
    vectors = wide.select("cell_id", F.array(*[F.col(f"`{k}`").cast("double") for k in kinds]).alias("v"))
    grouped = vectors.join(domain.points(spark, sf_dir).select("cell_id", "fov"), "cell_id")
    found = niches.grouped_kmeans(grouped, "fov", "cell_id", 6)
    return saved(found.select("cell_id", F.concat_ws(".", "fov", F.col("cluster").cast("string")).alias("niche"), "v"))


def fov_niches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cell's niche: clusters of neighbourhood profiles, found in each FOV on its own and named by it."""
    return _fov_niches(spark, sf_dir).select("cell_id", "niche")


def super_niches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with their niche and the group of niches with a like mean profile."""
    found = _fov_niches(spark, sf_dir)
    size = len(found.first()["v"]) if not found.isEmpty() else 0
    means = saved(found.groupBy("niche").agg(F.array(*[F.avg(F.col("v")[i]) for i in range(size)]).alias("v")))
    return found.select("cell_id", "niche").join(niches.vector_kmeans(means, "niche", 3).withColumnRenamed("cluster", "super_niche"), "niche", "left")


def niche_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap statistic of the neighbourhood profiles: 1 to 15 groups against 50 references."""
    wide, kinds = _wide(spark, sf_dir)
    vectors = saved(wide.select("cell_id", F.array(*[F.col(f"`{k}`").cast("double") for k in kinds]).alias("v")))
    return niches.gap_statistic(vectors, "cell_id", list(range(1, 16)), 50)


def xy_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spatial clusters of cells, slide by slide, so that none crosses two: as many per slide as CLUSTER_SHARE of its cells."""
    found = niches.place_clusters(domain.points(spark, sf_dir), "slide", "cell_id", CLUSTER_SHARE)
    return found.select("cell_id", F.concat_ws(".", "slide", F.col("cluster").cast("string")).alias("k_cluster"))


def _knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.knn_edges(domain.points(spark, sf_dir), "fov", "cell_id", K)


def snn_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return niches.shared_neighbors(_knn(spark, sf_dir), K, 0.15).select("a", "b", F.round("jaccard", 9).alias("jaccard"))


def snn_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return niches.propagated_labels(niches.shared_neighbors(_knn(spark, sf_dir), K, 0.15), "a", "b", "jaccard")


def embedding_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every vector whose id is divisible by 100, against all."""
    vectors = table(spark, sf_dir, "embeddings")
    found = niches.vector_neighbors(vectors.where(F.col("vec_id") % 100 == 0), vectors, "vec_id", "embedding", 10)
    return found.select("query", "neighbor", F.round("dist", 5).alias("dist"), "rank")


def rank_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = niches.rank_normal(domain.cells(spark, sf_dir).where("area IS NOT NULL").select("cell_id", "slide", "area"), "slide", "area")
    return found.select("cell_id", "slide", "area", F.round("rank_norm", 6).alias("rank_norm"))


def wilcoxon_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = expression.rank_sums(_rna(spark, sf_dir), domain.cells(spark, sf_dir), "cell_type")
    return found.select("gene", "cell_type", "u", F.round("z", 6).alias("z"))


def marker_log2fc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = expression.log2_fold_changes(_rna(spark, sf_dir), domain.cells(spark, sf_dir), "cell_type", "count")
    return found.select("gene", "cell_type", F.round("log2fc", 8).alias("log2fc"))


def top_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    fc = marker_log2fc(spark, sf_dir).where("log2fc > 0.01")
    return transcripts.best_rows(fc, "cell_type", [F.desc("log2fc"), F.col("gene")], 10).select("cell_type", "gene", "log2fc", "place")


def mean_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.mean_profiles(_rna(spark, sf_dir), domain.cells(spark, sf_dir), "cell_type").select("cell_type", "gene", F.round("mean", 8).alias("mean"))


def mean_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = expression.mean_negatives(domain.counts(spark, sf_dir), domain.cells(spark, sf_dir), domain.genes(spark, sf_dir))
    return found.select("cell_id", F.round("mean_negative", 9).alias("mean_negative"))


def _background(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = domain.counts(spark, sf_dir)
    negatives = expression.mean_negatives(counts, domain.cells(spark, sf_dir), domain.genes(spark, sf_dir))
    return expression.cell_background(counts.where("assay = 'RNA'"), negatives)


def cell_background(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _background(spark, sf_dir).select("cell_id", F.round("background", 9).alias("background"))


def _type_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores of cells and types, with the counts and profiles they come from."""
    counts = saved(_rna(spark, sf_dir))
    profiles = saved(expression.mean_profiles(counts, domain.cells(spark, sf_dir), "cell_type"))
    return expression.type_scores(counts, profiles, "cell_type", _background(spark, sf_dir)), counts, profiles


def typing_loglik_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.likeliest_types(_type_scores(spark, sf_dir)[0], "cell_type").select("cell_id", "cell_type")


def typing_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = expression.anchors(_type_scores(spark, sf_dir)[0], "cell_type")
    return found.select("cell_id", "cell_type", F.round("cosine", 5).alias("cosine"), F.round("llr", 5).alias("llr"))


def typing_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of the cells that are no anchors, by the profiles of the anchors; anchors keep theirs."""
    scores, counts, profiles = _type_scores(spark, sf_dir)
    chosen = saved(expression.anchors(scores, "cell_type"))
    updated = saved(expression.updated_profiles(counts, chosen, profiles, "cell_type"))
    again = expression.likeliest_types(expression.type_scores(counts, updated, "cell_type", _background(spark, sf_dir)), "cell_type")
    kept = chosen.select("cell_id", F.col("cell_type").alias("anchor"))
    return again.join(kept, "cell_id", "left").select("cell_id", F.coalesce("anchor", "cell_type").alias("cell_type"), F.col("anchor").isNotNull().alias("is_anchor"))


def cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells grouped by their stains, as normal scores over all cells."""
    held = domain.cells(spark, sf_dir).where("mean_panck IS NOT NULL AND mean_cd45 IS NOT NULL").select("cell_id", "mean_panck", "mean_cd45", F.lit(1).alias("all"))
    scored = niches.rank_normal(held, "all", "mean_panck").withColumnRenamed("rank_norm", "panck")
    scored = niches.rank_normal(scored, "all", "mean_cd45").withColumnRenamed("rank_norm", "cd45")
    return niches.mixture_niches(saved(scored.select("cell_id", "panck", "cd45")), "cell_id", ["panck", "cd45"], 3).select("cell_id", F.col("niche").alias("cohort"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with labels of three references, derived from their type and niche."""
    t, n = F.col("cell_type"), F.col("niche")
    lung = F.when(t == "endothelial", "blood.vessel.cell").when((t == "mast") & (n % 2 == 0), "mast.cell").when(t == "tumor", "a")
    skin = F.when(t == "fibroblast", "Mesenchymal.Fibroblast").when(t == "pericyte", "Pericytes.1").when(t == "endothelial", "Pericytes.2")
    io = F.when(t == "tumor", F.substring(F.md5("cell_id"), 1, 1)).when(t == "fibroblast", "Fibroblast").otherwise(t)
    return domain.cells(spark, sf_dir).withColumns({"lung": lung, "skin": skin, "io": io})


def cell_type_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.typed_by_rules(_labelled(spark, sf_dir), "lung", "skin", "io").select("cell_id", "broad_type", "final_type", "n_rules")


def rule_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.rule_conflicts(expression.typed_by_rules(_labelled(spark, sf_dir), "lung", "skin", "io"))


def final_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = expression.typed_by_rules(_labelled(spark, sf_dir), "lung", "skin", "io")
    clusters = typed.where(F.col("final_type") == expression.UNKNOWN).select("cell_id", F.col("niche").alias("cluster"))
    made = expression.labelled_clusters(typed, clusters)
    return made.select("cell_id", "cell_label", expression.simple_category(F.col("cell_type")).alias("category"))


def neighbor_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.neighbor_expression(_edges(spark, sf_dir), _rna(spark, sf_dir), domain.points(spark, sf_dir), "cell_type")


def neighbor_expression_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.neighbor_expression_by_type(_edges(spark, sf_dir), _rna(spark, sf_dir), domain.points(spark, sf_dir), "cell_type")


def de_covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with the counts in neighbours of other types, and these as normal scores within a type: the covariate of the models."""
    cells = domain.points(spark, sf_dir).where("cell_type IS NOT NULL").select("cell_id", "cell_type")
    totals = expression.other_type_totals(neighbor_expression(spark, sf_dir), cells)
    return niches.rank_normal(totals, "cell_type", "other_total").select("cell_id", "cell_type", "other_total", F.round("rank_norm", 6).alias("rank_norm"))


def contamination_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = domain.points(spark, sf_dir)
    found = expression.contamination(neighbor_expression(spark, sf_dir), _rna(spark, sf_dir), points, "cell_type")
    return found.select("cell_type", "gene", F.round("ratio", 8).alias("ratio"), "kept")


def _model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.count_model(_rna(spark, sf_dir), domain.cells(spark, sf_dir), "cell_type", "timepoint")


def quasi_poisson_de(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rate ratios between timepoints, per type and gene."""
    return _model(spark, sf_dir).select("cell_type", "gene", "level_a", "level_b", *[F.round(c, 6).alias(c) for c in ("estimate", "se", "wald")], "df")


def _tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.least(F.lit(1.0), 2 * t_upper_col(F.abs("wald"), F.col("df")))
    return qc.adjusted(quasi_poisson_de(spark, sf_dir).withColumn("p", p), "p", ["cell_type", "level_a", "level_b"], "gene")


def de_tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-sided p of each contrast, adjusted within cell type and contrast."""
    return _tested(spark, sf_dir).select("cell_type", "gene", "level_a", "level_b", "wald", F.round("p", 5).alias("p"), F.round("p_adj", 4).alias("p_adj"))


def two_stage_top_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First stage's genes for the second: the 100 contrasts per type with the largest |estimate / se|."""
    scored = quasi_poisson_de(spark, sf_dir).withColumn("strength", F.abs("wald"))
    top = transcripts.best_rows(scored, "cell_type", [F.desc("strength"), F.col("gene"), F.col("level_a"), F.col("level_b")], 100)
    return top.select("cell_type", "gene", "level_a", "level_b", "strength", "place")


def de_second_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen contrasts again, within places (FOVs), adjusted within a gene's own contrasts."""
    top = saved(two_stage_top_genes(spark, sf_dir))
    found = expression.stratified_ratios(_rna(spark, sf_dir), domain.cells(spark, sf_dir), top, "cell_type", "timepoint", "fov")
    z = found.withColumn("p", F.least(F.lit(1.0), 2 * normal_upper_col(F.abs(F.col("estimate") / F.col("se")))))
    adjusted = qc.adjusted(z, "p", ["cell_type", "gene"], "level_a")
    return adjusted.select("cell_type", "gene", "level_a", "level_b", "n_strata", *[F.round(c, 6).alias(c) for c in ("estimate", "se")], F.round("p", 5).alias("p"), F.round("p_adj", 4).alias("p_adj"))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "de_results").where(F.col("gene").isNotNull() & ~F.isnan("diff_mean"))
    estimates = rows.groupBy(*CONTRAST, "gene").agg(F.round(F.avg("diff_mean"), 9).alias("estimate"))
    return expression.ranked_genes(estimates, CONTRAST, "gene", "estimate")


def gsea_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.enrichment(_ranked(spark, sf_dir), domain.gene_sets(spark, sf_dir), CONTRAST).select(*CONTRAST, "gs_name", "size", F.round("es", 8).alias("es"))


def gsea_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running sums behind the enrichment scores, at the hits."""
    found = expression.enrichment_curve(_ranked(spark, sf_dir), domain.gene_sets(spark, sf_dir), CONTRAST)
    return found.select(*CONTRAST, "gs_name", "place", *[(F.round(c, 7) + F.lit(0.0)).alias(c) for c in ("before", "after")])


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = expression.enrichment_test(saved(_ranked(spark, sf_dir)), domain.gene_sets(spark, sf_dir), CONTRAST, PERMUTATIONS, 11)
    return qc.adjusted(tested, "p", CONTRAST, "gs_name")


def gsea_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _enriched(spark, sf_dir).withColumn("pathway", expression.clean_name(F.col("gs_name")))
    return found.select(*CONTRAST, "gs_name", "pathway", "size", F.round("es", 7).alias("es"), F.round("nes", 6).alias("nes"), F.round("p", 7).alias("p"), F.round("p_adj", 7).alias("p_adj"))


def pathway_score_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and percentile from the adjusted p and the normalized enrichment score, for the best eight sets of a contrast."""
    found = expression.pathway_scores(_enriched(spark, sf_dir).where("nes IS NOT NULL"), CONTRAST, "gs_name", "p_adj", "nes", 8)
    return found.select(*CONTRAST, "gs_name", expression.clean_name(F.col("gs_name")).alias("pathway"), F.round("score", 6).alias("score"), "percentile")


def pathway_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment of the sets that a table of wanted pathways names: those with more than an eighth of their genes in the add-on panel."""
    share = domain.gene_sets(spark, sf_dir).join(domain.genes(spark, sf_dir).select("gene", "panel"), "gene").groupBy("gs_name").agg(F.avg((F.col("panel") == "addon").cast("double")).alias("s"))
    wanted = share.where("s > 0.125")
    return expression.only_pathways(gsea_running_sum(spark, sf_dir), wanted)


def pathway_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = expression.bar_geometry(gsea_running_sum(spark, sf_dir), CONTRAST, "gs_name", "es")
    return bars.select(*CONTRAST, "gs_name", *[F.round(c, 8).alias(c) for c in ("xmin", "xmax", "ymin", "ymax")])


def _regulons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.csv_regulons(spark, sf_dir)


def tf_target_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = expression.tf_targets(_regulons(spark, sf_dir), ["A", "B", "C", "D"])
    return lists.select("tf", F.array_join("upregulated", ",").alias("upregulated"), F.array_join("downregulated", ",").alias("downregulated"))


def _n_genes(spark: SparkSession, sf_dir: str) -> int:
    return domain.genes(spark, sf_dir).where("assay = 'RNA'").count()


def aucell(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = expression.recovery(_rna(spark, sf_dir), domain.gene_sets(spark, sf_dir), _n_genes(spark, sf_dir))
    return found.select("cell_id", "gs_name", F.round("auc", 9).alias("auc"))


def pathway_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _regulons(spark, sf_dir).where("confidence <> 'E'")
    sets = known.select(F.concat("tf", F.when(F.col("mor") == 1, "|up").otherwise("|down")).alias("gs_name"), F.col("target").alias("gene"))
    sizes = sets.groupBy("gs_name").agg(F.count(F.lit(1)).alias("size"))
    auc = expression.recovery(_rna(spark, sf_dir), sets, _n_genes(spark, sf_dir))
    return expression.pathway_activity(auc, sizes).select("cell_id", "tf", F.round("score", 9).alias("score"))


def lr_tf_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complexes of up to five genes with the panel of each, one left join per position, and their factors."""
    members = transcripts.best_rows(domain.gene_sets(spark, sf_dir), "gs_name", [F.col("gene")], 5)
    wide = members.groupBy("gs_name").pivot("place", [1, 2, 3, 4, 5]).agg(F.first("gene"))
    units = [f"uniprot_{i}" for i in range(1, 6)]
    wide = wide.select("gs_name", *[F.col(str(i)).alias(f"uniprot_{i}") for i in range(1, 6)])
    joined = expression.with_partners(wide, domain.genes(spark, sf_dir), units, "gene", "panel")
    tfs = _regulons(spark, sf_dir).groupBy(F.col("target").alias("uniprot_1")).agg(F.max("tf").alias("tf"))
    return joined.join(tfs, "uniprot_1", "left").select("gs_name", *units, *[f"{u}_panel" for u in units], "tf")


def lr_fov_cross_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of the pair table for each FOV, with the number of cells of the FOV."""
    fovs = domain.cells(spark, sf_dir).groupBy("fov").agg(F.count(F.lit(1)).alias("n_cells"))
    return for_each_level(fovs, imports.csv_pairs(spark, sf_dir).select("receptor", "ligand", "receptor_cell", "ligand_cell", "r"))


def fov_type_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of each type per FOV and their percentages of the FOV's typed cells; types that an FOV lacks have 0."""
    cells = domain.cells(spark, sf_dir).where("cell_type IS NOT NULL")
    totals = cells.groupBy("fov").agg(F.count(F.lit(1)).alias("total"))
    n = cells.groupBy("fov", "cell_type").agg(F.count(F.lit(1)).alias("n"))
    every = for_each_level(totals, cells.select("cell_type").distinct()).join(n, ["fov", "cell_type"], "left").fillna(0, ["n"])
    return every.select("fov", "cell_type", "n", F.round(F.col("n") * 100.0 / F.col("total"), 6).alias("percent"))


QUERIES = {
    f.__name__: f
    for f in (
        cooccurrence, cooccurrence_permutation, cooccurrence_significant, node_abundance, gcross_rs, kcross_border, cross_curve_auc, sign_flip_test,
        gcross_envelope, pca, expression_pca, batch_corrected, batch_scatter, kmeans_niches, neighborhood_pca, gmm_niches, niche_silhouettes, niche_gap, niche_profiles, fov_niches, super_niches, xy_clusters, snn_jaccard, snn_clusters,
        embedding_neighbors, rank_normal, wilcoxon_u, marker_log2fc, top_markers, mean_profiles, mean_negatives, cell_background, typing_loglik_argmax, typing_anchors, typing_updated, cohorts, cell_type_rules, rule_conflicts,
        final_labels, neighbor_expression, neighbor_expression_by_type, de_covariates, contamination_ratio, quasi_poisson_de, de_tested, two_stage_top_genes, de_second_stage,
        gsea_running_sum, gsea_curve, gsea_permutation, pathway_score_percentile, pathway_subset, pathway_bars, tf_target_lists, aucell, pathway_activity, lr_tf_chain, lr_fov_cross_expand, fov_type_percent,
    )
}

_PROFILE = EDGES + """, profile AS (SELECT src AS cell_id, cell_type, count(*) AS n FROM edges JOIN pts ON dst = pts.cell_id WHERE cell_type IS NOT NULL GROUP BY ALL
    ), share AS (SELECT *, n / sum(n) OVER (PARTITION BY cell_id) AS v FROM profile)
"""
_COOCCURRING = _PROFILE + f""", col AS (SELECT cell_type, sum(v) AS s, sum(v * v) - sum(v) * sum(v) / any_value(n) AS ss, any_value(n)::DOUBLE AS n FROM share_v, (SELECT count(*) AS n FROM pts) GROUP BY 1
    ), met AS (SELECT a.cell_type AS type_from, b.cell_type AS type_to, sum(a.v * b.v) AS weight FROM share a JOIN share b ON a.cell_id = b.cell_id GROUP BY 1, 2
    ), scored AS (SELECT m.*, (weight - a.s * b.s / a.n) / CASE WHEN a.ss * b.ss > 0 THEN sqrt(a.ss * b.ss / (a.n - 1)) END AS z FROM met m JOIN col a ON type_from = a.cell_type JOIN col b ON type_to = b.cell_type
    ), co AS (SELECT *, CASE WHEN type_from = type_to THEN 1.0 ELSE {normal_upper("z")} END AS p FROM scored)
""".replace("share_v", "(SELECT cell_type, v FROM share)")
_CURVES = EDGES + f""", frame AS (
        SELECT p.fov, cell_id, cell_type AS kind, least(x - x0, x1 - x, y - y0, y1 - y) AS border, (x1 - x0) * (y1 - y0) AS area FROM pts p
        JOIN (SELECT fov, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts GROUP BY fov) b ON p.fov = b.fov WHERE cell_type IS NOT NULL
    ), radii AS (SELECT unnest({RADII}::DOUBLE[]) AS r
    ), inn AS (SELECT fov, kind AS type_i, r, count(*) AS n_i FROM frame, radii WHERE border >= r GROUP BY ALL
    ), kinds AS (SELECT fov, kind, count(*) AS n_j, any_value(area) AS area FROM frame GROUP BY ALL
    ), reach AS (SELECT fov, type_i, type_j, r, count(*) AS reached, sum(c) AS pairs FROM (
        SELECT a.fov, a.kind AS type_i, b.kind AS type_j, r, src, count(*) AS c FROM edges e JOIN frame a ON src = a.cell_id JOIN frame b ON dst = b.cell_id, radii
        WHERE dist <= r AND a.border >= r GROUP BY ALL) GROUP BY ALL
    ), curves AS (
        SELECT a.fov, a.kind AS type_i, b.kind AS type_j, radii.r, coalesce(n_i, 0) AS n_i, CASE WHEN n_i > 0 THEN coalesce(reached, 0) / n_i::DOUBLE END AS g,
            CASE WHEN n_i > 0 AND b.area > 0 THEN coalesce(pairs, 0) * b.area / (b.n_j * n_i)::DOUBLE END AS k
        FROM kinds a JOIN kinds b ON a.fov = b.fov CROSS JOIN radii LEFT JOIN inn ON a.fov = inn.fov AND a.kind = inn.type_i AND radii.r = inn.r
        LEFT JOIN reach ON a.fov = reach.fov AND a.kind = reach.type_i AND b.kind = reach.type_j AND radii.r = reach.r
    ), auc AS (SELECT fov, type_i, type_j, sum(g) * (max(r) - min(r)) / CASE WHEN count(*) > 1 THEN count(*) - 1 END AS auc, max(g) AS highest FROM curves WHERE g IS NOT NULL GROUP BY ALL)
"""
_SETS = domain.SQL + """, sets AS (SELECT DISTINCT upper(assay) || '_GROUP_' || upper(gene[1:1]) AS gs_name, gene FROM genes)
"""
_GSEA = _SETS + """, est AS (SELECT fixed_effect, direction, cell_type, gene, round(avg(diff_mean), 9) AS stat FROM de_results WHERE gene IS NOT NULL AND NOT isnan(diff_mean) GROUP BY ALL
    ), ranked AS (SELECT *, row_number() OVER (PARTITION BY fixed_effect, direction, cell_type ORDER BY stat DESC, gene) AS place, count(*) OVER (PARTITION BY fixed_effect, direction, cell_type) AS n
        FROM est WHERE stat IS NOT NULL
    ), walked AS (SELECT r.*, gs_name, abs(stat) AS w, row_number() OVER o AS k, count(*) OVER p AS size, sum(abs(stat)) OVER p AS whole, sum(abs(stat)) OVER (o ROWS UNBOUNDED PRECEDING) AS upto
        FROM ranked r JOIN sets s ON r.gene = s.gene
        WINDOW p AS (PARTITION BY fixed_effect, direction, cell_type, gs_name), o AS (PARTITION BY fixed_effect, direction, cell_type, gs_name ORDER BY place)
    ), es AS (SELECT fixed_effect, direction, cell_type, gs_name, size, CASE WHEN round(top, 9) >= -round(bottom, 9) THEN top ELSE bottom END AS es FROM (
        SELECT fixed_effect, direction, cell_type, gs_name, max(size) AS size, max(upto / whole - (place - k) / (n - size)::DOUBLE) AS top, min((upto - w) / whole - (place - k) / (n - size)::DOUBLE) AS bottom
        FROM walked WHERE whole > 0 AND n > size GROUP BY 1, 2, 3, 4)
    ), es8 AS (SELECT fixed_effect, direction, cell_type, gs_name, size, round(es, 8) AS es FROM es)
"""
_PATHWAY = "upper(gs_name[1:1]) || lower(split_part(gs_name, '_', 1)[2:]) || ': Group ' || lower(split_part(gs_name, '_', 3))"
_NULLS = _GSEA + f""", perms AS (SELECT perm FROM range(1, {PERMUTATIONS} + 1) r(perm)
    ), hashed AS (SELECT r.fixed_effect, r.direction, r.cell_type, r.gene, r.n, r.place AS frm, perm, (r.place * 1103515245 + perm * 2654435 + 11) % {expression.DEAL} AS h0 FROM ranked r, perms
    ), hashed1 AS (SELECT *, (h0 * h0 + perm) % {expression.DEAL} AS h1 FROM hashed), hashed2 AS (SELECT *, (h1 * h1 + frm) % {expression.DEAL} AS h2 FROM hashed1
    ), moved AS (SELECT fixed_effect, direction, cell_type, gene, n, perm, row_number() OVER (PARTITION BY fixed_effect, direction, cell_type, perm ORDER BY (h2 * h2 + h0) % {expression.DEAL}, frm) AS place FROM hashed2
    ), dwalked AS (SELECT m.*, gs_name, abs(r.stat) AS w, row_number() OVER o AS k, count(*) OVER p AS size, sum(abs(r.stat)) OVER p AS whole, sum(abs(r.stat)) OVER (o ROWS UNBOUNDED PRECEDING) AS upto
        FROM moved m JOIN ranked r ON m.fixed_effect = r.fixed_effect AND m.direction = r.direction AND m.cell_type = r.cell_type AND m.place = r.place JOIN sets s ON m.gene = s.gene
        WINDOW p AS (PARTITION BY m.fixed_effect, m.direction, m.cell_type, perm, gs_name), o AS (PARTITION BY m.fixed_effect, m.direction, m.cell_type, perm, gs_name ORDER BY m.place)
    ), nulls AS (SELECT fixed_effect, direction, cell_type, gs_name, round(CASE WHEN round(top, 9) >= -round(bottom, 9) THEN top ELSE bottom END, 9) AS e0 FROM (
        SELECT fixed_effect, direction, cell_type, gs_name, perm, max(upto / whole - (place - k) / (n - size)::DOUBLE) AS top, min((upto - w) / whole - (place - k) / (n - size)::DOUBLE) AS bottom
        FROM dwalked WHERE whole > 0 AND n > size GROUP BY 1, 2, 3, 4, 5)
    ), tested AS (SELECT e.fixed_effect, e.direction, e.cell_type, e.gs_name, size, es, es / CASE WHEN avg(abs(e0)) FILTER (same) > 0 THEN avg(abs(e0)) FILTER (same) END AS nes,
            (count(*) FILTER (same AND abs(e0) >= abs(round(es, 9))) + 1) / (count(*) FILTER (same) + 1)::DOUBLE AS p
        FROM (SELECT e.*, e0, sign(e0) = sign(es) AS same FROM es e LEFT JOIN nulls n ON e.fixed_effect = n.fixed_effect AND e.direction = n.direction AND e.cell_type = n.cell_type AND e.gs_name = n.gs_name) e GROUP BY 1, 2, 3, 4, 5, 6
    ), enriched AS (SELECT *, least(1.0, min(raw) OVER (PARTITION BY fixed_effect, direction, cell_type ORDER BY p, gs_name ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS p_adj
        FROM (SELECT *, p * count(*) OVER (PARTITION BY fixed_effect, direction, cell_type) / row_number() OVER (PARTITION BY fixed_effect, direction, cell_type ORDER BY p, gs_name) AS raw FROM tested))
"""
_REGULONS = domain.SQL + f", reg AS (SELECT * FROM {imports.REGULONS})\n"
_TOPGENES = "(SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY count DESC, gene) AS r FROM counts WHERE assay = 'RNA')"
_TOP = "(SELECT greatest(1, floor(count(*) * 0.05)::INT) AS top FROM genes WHERE assay = 'RNA')"


def _auc(sets: str) -> str:
    return f"""(SELECT cell_id, h.gs_name, a / (m * top - m * (m + 1) / 2.0) AS auc, size FROM (
        SELECT cell_id, gs_name, sum(top - r) AS a, any_value(top) AS top FROM {_TOPGENES} t JOIN {sets} s ON t.gene = s.gene, {_TOP} WHERE r < top GROUP BY 1, 2) h
        JOIN (SELECT gs_name, count(DISTINCT gene) AS size, least(count(DISTINCT gene), any_value(top) - 1) AS m FROM {sets} s, {_TOP} GROUP BY 1) z ON h.gs_name = z.gs_name)"""


_LABELLED = domain.SQL + """, labelled AS (SELECT *,
        CASE WHEN cell_type = 'endothelial' THEN 'blood.vessel.cell' WHEN cell_type = 'mast' AND niche % 2 = 0 THEN 'mast.cell' WHEN cell_type = 'tumor' THEN 'a' END AS lung,
        CASE WHEN cell_type = 'fibroblast' THEN 'Mesenchymal.Fibroblast' WHEN cell_type = 'pericyte' THEN 'Pericytes.1' WHEN cell_type = 'endothelial' THEN 'Pericytes.2' END AS skin,
        CASE WHEN cell_type = 'tumor' THEN md5(cell_id)[1:1] WHEN cell_type = 'fibroblast' THEN 'Fibroblast' ELSE cell_type END AS io FROM cells
    ), ruled AS (SELECT *, coalesce(lung IN ('blood.vessel.cell', 'mast.cell', 'lymph.vessel.cell'), false) AS a,
        coalesce(skin IN ('Mesenchymal.Fibroblast', 'Secretory.reticular.Fibroblast', 'Pro.inflammatory.Fibroblast', 'Secretory.papillary.Fibroblast', 'Pericytes.1', 'Pericytes.2'), false) AS b,
        NOT coalesce(io IN ('Endothelial', 'Fibroblast'), false) AND NOT coalesce(regexp_full_match(io, '[a-z]'), false) AS c FROM labelled
    ), typed AS (SELECT *, CASE WHEN a THEN 'Stromal and mast cells' WHEN b THEN 'Fibroblasts and pericytes' WHEN c THEN 'Immune cells' ELSE 'Parenchymal or unknown' END AS broad_type,
        CASE WHEN a THEN lung WHEN b THEN skin WHEN c THEN io ELSE 'Parenchymal or unknown' END AS final_type, a::INT + b::INT + c::INT AS n_rules FROM ruled)
"""
_NEAR = EDGES + """, near AS (SELECT src AS cell_id, gene, sum(count)::BIGINT AS total, sum(CASE WHEN a.cell_type <> b.cell_type THEN count ELSE 0 END)::BIGINT AS other
        FROM edges e JOIN pts a ON src = a.cell_id JOIN pts b ON dst = b.cell_id JOIN counts c ON dst = c.cell_id
        WHERE a.cell_type IS NOT NULL AND b.cell_type IS NOT NULL AND assay = 'RNA' GROUP BY 1, 2)
"""
_MODEL = domain.SQL + """, size AS (SELECT cell_id, sum(count) AS size FROM counts WHERE assay = 'RNA' GROUP BY 1
    ), held AS (SELECT c.cell_id, cell_type, timepoint AS level, size FROM cells c JOIN size s ON c.cell_id = s.cell_id WHERE cell_type IS NOT NULL AND timepoint IS NOT NULL
    ), levels AS (SELECT cell_type, level, sum(size) AS e, count(*) AS n FROM held GROUP BY ALL
    ), rates AS (SELECT y.*, y / e::DOUBLE AS rate FROM (SELECT cell_type, gene, level, sum(count) AS y, sum(count * count / size::DOUBLE) AS q FROM counts k JOIN held h ON k.cell_id = h.cell_id
        WHERE assay = 'RNA' GROUP BY ALL) y JOIN levels l ON y.cell_type = l.cell_type AND y.level = l.level
    ), phi AS (SELECT r.cell_type, gene, df, greatest(1e-8, chi2 / df) AS phi FROM (SELECT cell_type, gene, sum(q / rate - y) AS chi2 FROM rates GROUP BY ALL) r
        JOIN (SELECT cell_type, (sum(n) - count(*))::BIGINT AS df FROM levels GROUP BY ALL) w ON r.cell_type = w.cell_type WHERE df > 0
    ), de AS (SELECT cell_type, gene, level_a, level_b, round(est, 6) AS estimate, round(se, 6) AS se, round(est / se, 6) AS wald, df FROM (
        SELECT a.cell_type, a.gene, a.level AS level_a, b.level AS level_b, ln(b.rate / a.rate) AS est, sqrt(phi * (1.0 / a.y::DOUBLE + 1.0 / b.y::DOUBLE)) AS se, df
        FROM rates a JOIN rates b ON a.cell_type = b.cell_type AND a.gene = b.gene AND a.level < b.level JOIN phi p ON a.cell_type = p.cell_type AND a.gene = p.gene))
"""
_TESTED_DE = _MODEL + f""", ps AS (SELECT *, least(1.0, 2 * {t_upper("abs(wald)", "df")}) AS p FROM de
    ), tested AS (SELECT *, least(1.0, min(raw) OVER (PARTITION BY cell_type, level_a, level_b ORDER BY p, gene ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS p_adj
        FROM (SELECT *, p * count(*) OVER (PARTITION BY cell_type, level_a, level_b) / row_number() OVER (PARTITION BY cell_type, level_a, level_b ORDER BY p, gene) AS raw FROM ps))
"""
_SECOND = _MODEL + f""", top AS (SELECT cell_type, gene, level_a, level_b FROM (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY abs(wald) DESC, gene, level_a, level_b) AS k FROM de) WHERE k <= 100
    ), heldf AS (SELECT c.cell_id, cell_type, timepoint AS level, fov, size FROM cells c JOIN size s ON c.cell_id = s.cell_id WHERE cell_type IS NOT NULL AND timepoint IS NOT NULL AND fov IS NOT NULL
    ), ex AS (SELECT cell_type, fov, level, sum(size)::DOUBLE AS e FROM heldf GROUP BY ALL
    ), yf AS (SELECT cell_type, gene, fov, level, sum(count)::DOUBLE AS y FROM counts k JOIN heldf h ON k.cell_id = h.cell_id WHERE assay = 'RNA' GROUP BY ALL
    ), strata AS (SELECT t.*, a.fov, a.e AS ea, b.e AS eb, coalesce(ya.y, 0) AS ya, coalesce(yb.y, 0) AS yb FROM top t JOIN ex a ON t.cell_type = a.cell_type AND t.level_a = a.level JOIN ex b ON t.cell_type = b.cell_type AND t.level_b = b.level AND a.fov = b.fov
        LEFT JOIN yf ya ON ya.cell_type = t.cell_type AND ya.gene = t.gene AND ya.fov = a.fov AND ya.level = t.level_a LEFT JOIN yf yb ON yb.cell_type = t.cell_type AND yb.gene = t.gene AND yb.fov = a.fov AND yb.level = t.level_b
    ), mh AS (SELECT cell_type, gene, level_a, level_b, sum(yb * ea / (ea + eb)) AS r, sum(ya * eb / (ea + eb)) AS s, sum((ya + yb) * ea * eb / ((ea + eb) * (ea + eb))) AS v, count(*) AS n_strata FROM strata GROUP BY 1, 2, 3, 4
    ), est AS (SELECT cell_type, gene, level_a, level_b, n_strata, ln(r / s) AS estimate, sqrt(v / (r * s)) AS se FROM mh WHERE r > 0 AND s > 0
    ), pz AS (SELECT *, least(1.0, 2 * {normal_upper("abs(estimate / se)")}) AS p FROM est
    ), adjusted AS (SELECT *, least(1.0, min(raw) OVER (PARTITION BY cell_type, gene ORDER BY p, level_a ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS p_adj
        FROM (SELECT *, p * count(*) OVER (PARTITION BY cell_type, gene) / row_number() OVER (PARTITION BY cell_type, gene ORDER BY p, level_a) AS raw FROM pz))
"""
_FC = domain.SQL + """, known AS (SELECT cell_id, cell_type FROM cells WHERE cell_type IS NOT NULL
    ), s AS (SELECT gene, cell_type, sum(count)::DOUBLE AS s1 FROM counts c JOIN known k ON c.cell_id = k.cell_id WHERE assay = 'RNA' GROUP BY ALL
    ), fc AS (SELECT gene, s.cell_type, round(log2(s1 / n1 + 1) - log2((sum(s1) OVER (PARTITION BY gene) - s1) / (n - n1) + 1), 8) AS log2fc
        FROM s JOIN (SELECT cell_type, count(*) AS n1, sum(count(*)) OVER () AS n FROM known GROUP BY 1) z ON s.cell_type = z.cell_type)
"""
_BACKGROUND = domain.SQL + """, negmean AS (SELECT c.cell_id, coalesce(s, 0) / n::DOUBLE AS mean_negative FROM cells c LEFT JOIN (SELECT cell_id, sum(count) AS s FROM counts WHERE assay = 'negative' AND NOT contains(gene, 'NegAdd') GROUP BY 1) x ON c.cell_id = x.cell_id,
        (SELECT count(*) AS n FROM genes WHERE assay = 'negative' AND NOT contains(gene, 'NegAdd'))
    ), rna AS (SELECT * FROM counts WHERE assay = 'RNA'), size AS (SELECT cell_id, sum(count) AS size FROM rna GROUP BY 1
    ), tot AS (SELECT n.cell_id, mean_negative, coalesce(size, 0) AS size FROM negmean n LEFT JOIN size s ON n.cell_id = s.cell_id
    ), bg AS (SELECT cell_id, size * b / t AS background FROM tot, (SELECT avg(mean_negative) AS b, avg(size) AS t FROM tot))
"""
_TYPING = _BACKGROUND + """, means AS (SELECT s.cell_type, gene, s / n::DOUBLE AS mean FROM (SELECT cell_type, gene, sum(count) AS s FROM rna c JOIN cells k ON c.cell_id = k.cell_id WHERE cell_type IS NOT NULL GROUP BY 1, 2) s
        JOIN (SELECT cell_type, count(*) AS n FROM cells GROUP BY 1) z ON s.cell_type = z.cell_type
    ), prof AS (SELECT cell_type, gene, mean / sum(mean) OVER (PARTITION BY cell_type) AS p, mean / sqrt(sum(mean * mean) OVER (PARTITION BY cell_type)) AS u FROM means
    ), scores AS (SELECT r.cell_id, t.cell_type, any_value(size) AS size, round(sum(count * ln(size * coalesce(p, 0) + greatest(background, 1e-6::DOUBLE))), 6) AS score, sum(count * coalesce(u, 0)) / sqrt(sum(count * count)) AS cosine
        FROM rna r JOIN size s ON r.cell_id = s.cell_id JOIN bg ON r.cell_id = bg.cell_id CROSS JOIN (SELECT DISTINCT cell_type FROM prof) t LEFT JOIN prof f ON f.cell_type = t.cell_type AND f.gene = r.gene GROUP BY 1, 2
    ), placed AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY score DESC, cell_type) AS k, lead(score) OVER (PARTITION BY cell_id ORDER BY score DESC, cell_type) AS second FROM scores)
"""
_ANCHORS = _TYPING + """, good AS (SELECT cell_id, cell_type, cosine, round((score - second) / size, 9) AS llr FROM placed WHERE k = 1 AND cosine >= 0.3 AND round((score - second) / size, 9) >= 0.01
    ), best AS (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY llr DESC, cell_id) AS place FROM good
    ), anchors AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY cell_type) AS m FROM best WHERE place <= 500) WHERE m >= 20)
"""
_GROUP = "fixed_effect, direction, cell_type"
SQL = {
    "cooccurrence": _PROFILE + "SELECT a.cell_type AS type_from, b.cell_type AS type_to, round(sum(a.v * b.v), 7) AS weight FROM share a JOIN share b ON a.cell_id = b.cell_id GROUP BY 1, 2",
    "cooccurrence_permutation": _COOCCURRING + "SELECT type_from, type_to, round(weight, 6) AS weight, round(z, 5) AS z, round(p, 5) AS p FROM co",
    "cooccurrence_significant": _COOCCURRING + f"SELECT type_from, type_to, round(p, 5) AS p, count(*) OVER (PARTITION BY type_from) AS degree FROM co WHERE p < {LOOSE}",
    "node_abundance": _PROFILE + "SELECT cell_type, round(sum(n) * 100.0::DOUBLE / sum(sum(n)) OVER (), 8) AS abundance FROM profile GROUP BY 1",
    "gcross_rs": _CURVES + "SELECT fov, type_i, type_j, r, n_i, round(g, 8) AS g FROM curves",
    "kcross_border": _CURVES + "SELECT fov, type_i, type_j, r, round(k, 3) AS k FROM curves",
    "cross_curve_auc": _CURVES + "SELECT fov, type_i, type_j, round(auc, 6) AS auc, round(highest, 8) AS highest FROM auc",
    "sign_flip_test": _CURVES
    + f""", deltas AS (SELECT * FROM (SELECT fov, max(auc) FILTER (type_j = '{KIND_J}') - max(auc) FILTER (type_j = '{KIND_K}') AS delta FROM auc WHERE type_i = '{KIND_I}' GROUP BY 1) WHERE delta IS NOT NULL
        ), flips AS (SELECT flip, round(avg(CASE WHEN md5(fov || '|' || flip || '|3')[1:1] < '8' THEN -delta ELSE delta END), 9) AS m FROM deltas, range(1, 1000) f(flip) GROUP BY 1)
        SELECT round(o.d, 6) AS mean_delta, o.n, round(avg(CASE WHEN abs(m) >= abs(round(o.d, 9)) THEN 1.0 ELSE 0.0 END), 6) AS p_value FROM flips, (SELECT avg(delta) AS d, count(*) AS n FROM deltas) o GROUP BY o.d, o.n""",
    "niche_profiles": EDGES
    + """SELECT k.niche, t.cell_type, round(coalesce(s, 0) / k.n::DOUBLE, 7) AS mean FROM (SELECT niche, count(*) AS n FROM pts WHERE niche IS NOT NULL GROUP BY 1) k
        CROSS JOIN (SELECT DISTINCT cell_type FROM pts WHERE cell_type IS NOT NULL) t
        LEFT JOIN (SELECT a.niche, b.cell_type, count(*) AS s FROM edges JOIN pts a ON src = a.cell_id JOIN pts b ON dst = b.cell_id GROUP BY 1, 2) e ON k.niche = e.niche AND t.cell_type = e.cell_type""",
    "rank_normal": domain.SQL
    + f""", held AS (SELECT cell_id, slide, area FROM cells WHERE area IS NOT NULL), placed AS (SELECT *, (rank() OVER (PARTITION BY slide ORDER BY area) + (count(*) OVER (PARTITION BY slide, area) - 1) / 2.0::DOUBLE - 0.375::DOUBLE) / (count(*) OVER (PARTITION BY slide) + 0.25::DOUBLE) AS p FROM held)
        SELECT cell_id, slide, area, round({normal_quantile("p")}, 6) AS rank_norm FROM placed""",
    "snn_jaccard": domain.SQL
    + f""", knn AS (SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d2, dst) AS rank FROM (
        SELECT a.cell_id AS src, b.cell_id AS dst, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM pts a JOIN pts b ON a.fov = b.fov AND a.cell_id <> b.cell_id)) WHERE rank <= {K})
        SELECT a, b, round(n / ({2 * K} - n)::DOUBLE, 9) AS jaccard FROM (SELECT l.src AS a, r.src AS b, count(*) AS n FROM knn l JOIN knn r ON l.dst = r.dst AND l.src < r.src GROUP BY 1, 2) WHERE n / ({2 * K} - n)::DOUBLE > 0.15""",
    "embedding_neighbors": """
        SELECT query, neighbor, round(sqrt(d2), 5) AS dist, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY d2, neighbor) AS rank FROM (
            SELECT a.vec_id AS query, b.vec_id AS neighbor, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))), 9) AS d2
            FROM embeddings a JOIN embeddings b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)) WHERE rank <= 10""",
    "wilcoxon_u": domain.SQL
    + """, known AS (SELECT cell_id, cell_type FROM cells WHERE cell_type IS NOT NULL
        ), dense AS (SELECT g.gene, k.cell_type, coalesce(c.count, 0) AS v FROM (SELECT DISTINCT gene FROM counts c JOIN known k ON c.cell_id = k.cell_id WHERE assay = 'RNA') g CROSS JOIN known k
            LEFT JOIN counts c ON c.gene = g.gene AND c.cell_id = k.cell_id
        ), vals AS (SELECT gene, v, count(*) AS t FROM dense GROUP BY 1, 2
        ), ranks AS (SELECT *, sum(t) OVER (PARTITION BY gene ORDER BY v) - (t - 1) / 2.0 AS r, sum(t::DOUBLE * t * t - t) OVER (PARTITION BY gene) AS ties, sum(t) OVER (PARTITION BY gene)::DOUBLE AS n FROM vals
        ), u AS (SELECT d.gene, cell_type, count(*)::DOUBLE AS n1, any_value(n) AS n, any_value(ties) AS ties, sum(r)::DOUBLE - count(*)::DOUBLE * (count(*) + 1) / 2 AS u FROM dense d JOIN ranks k ON d.gene = k.gene AND d.v = k.v GROUP BY 1, 2)
        SELECT gene, cell_type, u, round((u - n1 * (n - n1) / 2) / sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1)))), 6) AS z FROM u""",
    "marker_log2fc": _FC + "SELECT gene, cell_type, log2fc FROM fc",
    "top_markers": _FC
    + "SELECT cell_type, gene, log2fc, place FROM (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY log2fc DESC, gene)::INT AS place FROM fc WHERE log2fc > 0.01) WHERE place <= 10",
    "mean_profiles": domain.SQL
    + """SELECT s.cell_type, gene, round(s / n::DOUBLE, 8) AS mean FROM (SELECT cell_type, gene, sum(count) AS s FROM counts c JOIN cells k ON c.cell_id = k.cell_id WHERE assay = 'RNA' AND cell_type IS NOT NULL GROUP BY 1, 2) s
        JOIN (SELECT cell_type, count(*) AS n FROM cells GROUP BY 1) z ON s.cell_type = z.cell_type""",
    "mean_negatives": _BACKGROUND + "SELECT cell_id, round(mean_negative, 9) AS mean_negative FROM negmean",
    "cell_background": _BACKGROUND + "SELECT cell_id, round(background, 9) AS background FROM bg",
    "typing_loglik_argmax": _TYPING + "SELECT cell_id, cell_type FROM placed WHERE k = 1",
    "typing_anchors": _ANCHORS + "SELECT cell_id, cell_type, round(cosine, 5) AS cosine, round(llr, 5) AS llr FROM anchors",
    "typing_updated": _ANCHORS
    + """, fresh AS (SELECT s.cell_type, gene, s / n::DOUBLE AS mean FROM (SELECT cell_type, gene, sum(count) AS s FROM rna c JOIN anchors k ON c.cell_id = k.cell_id GROUP BY 1, 2) s JOIN (SELECT cell_type, count(*) AS n FROM anchors GROUP BY 1) z ON s.cell_type = z.cell_type
            UNION ALL SELECT cell_type, gene, mean FROM means WHERE cell_type NOT IN (SELECT cell_type FROM anchors)
        ), fprof AS (SELECT cell_type, gene, mean / sum(mean) OVER (PARTITION BY cell_type) AS p FROM fresh
        ), again AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY score DESC, cell_type) AS k FROM (SELECT r.cell_id, t.cell_type, round(sum(count * ln(size * coalesce(p, 0) + greatest(background, 1e-6::DOUBLE))), 6) AS score
            FROM rna r JOIN size s ON r.cell_id = s.cell_id JOIN bg ON r.cell_id = bg.cell_id CROSS JOIN (SELECT DISTINCT cell_type FROM fprof) t LEFT JOIN fprof f ON f.cell_type = t.cell_type AND f.gene = r.gene GROUP BY 1, 2))
        SELECT g.cell_id, coalesce(a.cell_type, g.cell_type) AS cell_type, a.cell_type IS NOT NULL AS is_anchor FROM again g LEFT JOIN anchors a ON g.cell_id = a.cell_id WHERE k = 1""",
    "cell_type_rules": _LABELLED + "SELECT cell_id, broad_type, final_type, n_rules FROM typed",
    "rule_conflicts": _LABELLED + "SELECT n_rules, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE AS percent FROM typed GROUP BY 1",
    "final_labels": _LABELLED
    + """SELECT cell_id, final_type || CASE WHEN final_type = 'Parenchymal or unknown' THEN coalesce(niche::VARCHAR, '') ELSE '' END AS cell_label,
        CASE WHEN regexp_matches(cell_type, '^(M(ac|o)|DC)\\|') THEN 'Myeloid' WHEN regexp_matches(cell_type, '^CD[4|8]') THEN 'T cell' WHEN cell_type = 'Tumor|Intracellular_16S' THEN '16S+ tumor' ELSE 'Other' END AS category FROM typed""",
    "neighbor_expression": _NEAR + "SELECT cell_id, gene, total, other FROM near",
    "contamination_ratio": _NEAR
    + """SELECT o.cell_type, o.gene, round(coalesce(m, 0) / own::DOUBLE, 8) AS ratio, coalesce(m, 0) / own::DOUBLE <= 1 AS kept
        FROM (SELECT cell_type, gene, sum(count) AS own FROM counts c JOIN pts p ON c.cell_id = p.cell_id WHERE cell_type IS NOT NULL AND assay = 'RNA' GROUP BY 1, 2) o
        LEFT JOIN (SELECT cell_type, gene, sum(other) AS m FROM near n JOIN pts p ON n.cell_id = p.cell_id GROUP BY 1, 2) x ON o.cell_type = x.cell_type AND o.gene = x.gene""",
    "neighbor_expression_by_type": EDGES
    + """SELECT src AS cell_id, gene, cell_type, sum(count)::BIGINT AS total FROM edges JOIN pts b ON dst = b.cell_id JOIN counts c ON dst = c.cell_id WHERE cell_type IS NOT NULL AND assay = 'RNA' GROUP BY 1, 2, 3""",
    "de_covariates": _NEAR
    + f""", tot AS (SELECT p.cell_id, p.cell_type, coalesce(t, 0)::BIGINT AS other_total FROM pts p LEFT JOIN (SELECT cell_id, sum(other) AS t FROM near GROUP BY 1) n ON p.cell_id = n.cell_id WHERE p.cell_type IS NOT NULL
        ), placed AS (SELECT *, (rank() OVER (PARTITION BY cell_type ORDER BY other_total) + (count(*) OVER (PARTITION BY cell_type, other_total) - 1) / 2.0::DOUBLE - 0.375::DOUBLE) / (count(*) OVER (PARTITION BY cell_type) + 0.25::DOUBLE) AS p FROM tot)
        SELECT cell_id, cell_type, other_total, round({normal_quantile("p")}, 6) AS rank_norm FROM placed""",
    "quasi_poisson_de": _MODEL + "SELECT * FROM de",
    "de_tested": _TESTED_DE + "SELECT cell_type, gene, level_a, level_b, wald, round(p, 5) AS p, round(p_adj, 4) AS p_adj FROM tested",
    "de_second_stage": _SECOND + "SELECT cell_type, gene, level_a, level_b, n_strata, round(estimate, 6) AS estimate, round(se, 6) AS se, round(p, 5) AS p, round(p_adj, 4) AS p_adj FROM adjusted",
    "two_stage_top_genes": _MODEL
    + """SELECT cell_type, gene, level_a, level_b, abs(wald) AS strength, place FROM (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY abs(wald) DESC, gene, level_a, level_b)::INT AS place FROM de) WHERE place <= 100""",
    "gsea_running_sum": _GSEA + f"SELECT {_GROUP}, gs_name, size, es FROM es8",
    "gsea_curve": _GSEA
    + f"SELECT {_GROUP}, gs_name, place, round((upto - w) / whole - (place - k) / (n - size)::DOUBLE, 7) + 0.0::DOUBLE AS before, round(upto / whole - (place - k) / (n - size)::DOUBLE, 7) + 0.0::DOUBLE AS after FROM walked WHERE whole > 0 AND n > size",
    "gsea_permutation": _NULLS + f"SELECT {_GROUP}, gs_name, {_PATHWAY} AS pathway, size, round(es, 7) AS es, round(nes, 6) AS nes, round(p, 7) AS p, round(p_adj, 7) AS p_adj FROM enriched",
    "pathway_score_percentile": _NULLS
    + f""", scored AS (SELECT *, round(-log10(p_adj) * abs(nes), 9) AS score FROM enriched WHERE p_adj > 0 AND nes IS NOT NULL), kept AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY {_GROUP} ORDER BY score DESC) AS r FROM scored) WHERE r <= 8)
        SELECT {_GROUP}, gs_name, {_PATHWAY} AS pathway, round(score, 6) AS score,
            round(100 - row_number() OVER (PARTITION BY {_GROUP} ORDER BY score DESC, gs_name) / count(*) OVER (PARTITION BY {_GROUP})::DOUBLE * 100, 1) AS percentile FROM kept""",
    "pathway_subset": _GSEA + f"SELECT {_GROUP}, gs_name, size, es FROM es8 WHERE gs_name IN (SELECT gs_name FROM sets s JOIN probes p ON s.gene = p.gene GROUP BY 1 HAVING avg((panel = 'addon')::INT) > 0.125)",
    "pathway_bars": _GSEA
    + f""", w AS (SELECT *, count(*) OVER (PARTITION BY {_GROUP}) / 3.0::DOUBLE AS n, row_number() OVER (PARTITION BY {_GROUP} ORDER BY es, gs_name) AS place FROM es8
        ), b AS (SELECT *, CASE WHEN n <= 1 THEN 0.25 WHEN n <= 5 THEN 0.125 * n + 0.125 ELSE sqrt(n) - sqrt(5.0) + 0.75 END AS width FROM w)
        SELECT {_GROUP}, gs_name, round(place - width / 2, 8) AS xmin, round(place + width / 2, 8) AS xmax, round(least(0.0, es), 8) AS ymin, round(greatest(0.0, es), 8) AS ymax FROM b""",
    "tf_target_lists": _REGULONS
    + """SELECT tf, coalesce(string_agg(target, ',' ORDER BY target) FILTER (mor = 1), '') AS upregulated, coalesce(string_agg(target, ',' ORDER BY target) FILTER (mor = -1), '') AS downregulated
        FROM reg WHERE confidence <> 'E' GROUP BY tf""",
    "aucell": _SETS + f"SELECT cell_id, gs_name, round(auc, 9) AS auc FROM {_auc('sets')}",
    "pathway_activity": _REGULONS
    + ", tfsets AS (SELECT tf || CASE WHEN mor = 1 THEN '|up' ELSE '|down' END AS gs_name, target AS gene FROM reg WHERE confidence <> 'E')"
    + f"SELECT cell_id, split_part(gs_name, '|', 1) AS tf, round(sum(CASE WHEN split_part(gs_name, '|', 2) = 'up' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * auc / size), 9) AS score FROM {_auc('tfsets')} GROUP BY 1, 2",
    "lr_tf_chain": _REGULONS
    + """, sets AS (SELECT DISTINCT upper(assay) || '_GROUP_' || upper(gene[1:1]) AS gs_name, gene FROM genes
        ), m AS (SELECT *, row_number() OVER (PARTITION BY gs_name ORDER BY gene) AS k FROM sets
        ), c AS (SELECT gs_name, """
    + ", ".join(f"max(gene) FILTER (k = {i}) AS uniprot_{i}" for i in range(1, 6))
    + " FROM m GROUP BY 1) SELECT gs_name, "
    + ", ".join(f"uniprot_{i}" for i in range(1, 6))
    + ", "
    + ", ".join(f"g{i}.panel AS uniprot_{i}_panel" for i in range(1, 6))
    + ", t.tf FROM c "
    + " ".join(f"LEFT JOIN genes g{i} ON uniprot_{i} = g{i}.gene" for i in range(1, 6))
    + " LEFT JOIN (SELECT target, max(tf) AS tf FROM reg GROUP BY 1) t ON uniprot_1 = t.target",
    "lr_fov_cross_expand": domain.SQL + imports.LR_TABLE + "SELECT fov, n_cells, receptor, ligand, receptor_cell, ligand_cell, 120.0::DOUBLE AS r FROM (SELECT fov, count(*) AS n_cells FROM cells GROUP BY 1) CROSS JOIN lr",
    "fov_type_percent": domain.SQL
    + """SELECT f.fov, k.cell_type, coalesce(n, 0) AS n, round(coalesce(n, 0) * 100.0::DOUBLE / total, 6) AS percent FROM (SELECT fov, count(*) AS total FROM cells WHERE cell_type IS NOT NULL GROUP BY 1) f
        CROSS JOIN (SELECT DISTINCT cell_type FROM cells WHERE cell_type IS NOT NULL) k LEFT JOIN (SELECT fov, cell_type, count(*) AS n FROM cells GROUP BY 1, 2) c ON f.fov = c.fov AND k.cell_type = c.cell_type""",
}
