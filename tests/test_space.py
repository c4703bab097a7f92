"""Neighbour graphs and what is computed over them, on hand-made points and against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import levels
from cellweave.functions.mixing import GOLDEN, mixed
from cellweave.operators import expression, fovqc, niches, patterns, spatial
from cellweave.plans import biology, domain, space
from tests.helpers import rows

CELL = "fov string, cell_id string, x double, y double, cell_type string, v double, slide string"


def cells(spark, data):
    return spark.createDataFrame([(*d, "s") for d in data], CELL)


SQUARE = [("f", "a", 0.0, 0.0, "A", 1.0), ("f", "b", 1.0, 0.0, "B", 2.0), ("f", "c", 1.0, 1.0, "A", 3.0), ("f", "d", 0.0, 1.0, "B", 4.0)]


def test_square(spark):
    df = cells(spark, SQUARE)
    edges = spatial.radius_edges(df, "fov", "cell_id", 1.0)
    assert edges.count() == 8
    assert spatial.moran(edges, df, "fov", "cell_id", "v").first().moran == pytest.approx(-0.2)
    assert spatial.moran(edges, df.withColumn("v", F.lit(1.0)), "fov", "cell_id", "v").first().moran is None
    assert dict(rows(spatial.lisa(edges, df, "fov", "cell_id", "v"))) == {"a": -1.5 * 1.0, "b": -0.5 * -1.0, "c": 0.5 * 1.0, "d": 1.5 * -1.0}
    assert rows(spatial.neighbor_tabulate(edges, df, "cell_id", "cell_type"), "src", "cell_type", "n", "share") == {("a", "B", 2, 1.0), ("b", "A", 2, 1.0), ("c", "B", 2, 1.0), ("d", "A", 2, 1.0)}
    assert rows(spatial.type_pairs(edges, df, "fov", "cell_id", "cell_type", "A", "A")) == set()
    wide = spatial.radius_edges(df, "fov", "cell_id", 1.5)
    assert rows(spatial.type_pairs(wide, df, "fov", "cell_id", "cell_type", "A", "A"), "ligand_cell", "receptor_cell") == {("a", "c")}


def test_coincident_points(spark):
    df = cells(spark, [("f", "a", 0.0, 0.0, "A", 5.0), ("f", "b", 0.0, 0.0, "B", 7.0), ("f", "c", 1.0, 0.0, "A", 2.0)])
    edges = spatial.radius_edges(df, "fov", "cell_id", 1.0)
    assert rows(spatial.neighbor_values(edges, df, "cell_id", "v")) == {("a", 1, 2.0, 2.0), ("b", 1, 2.0, 2.0), ("c", 2, 12.0, 6.0)}
    counts = spark.createDataFrame([("b", "G", 4)], "cell_id string, gene string, count long")
    assert rows(spatial.neighborhood_expression(edges, counts)) == {("a", "G", 2.0), ("c", "G", 2.0)}


def cloud(seed, n):
    rnd = random.Random(seed)
    made = [(f"f{rnd.randint(0, 2)}", f"k{i:03}", round(rnd.gauss(0, 30), 1), round(rnd.gauss(0, 30), 1), rnd.choice("ABC"), rnd.random()) for i in range(n)]
    return [*made, ("f0", "far", 5000.0, 5000.0, "A", 0.5), ("f9", "alone", 1.0, 1.0, "A", 0.5), ("f8", "t1", 2.0, 2.0, "A", 0.5), ("f8", "t2", 2.0, 2.0, "A", 0.5)]


@pytest.mark.parametrize("k", [1, 4, 300])
def test_nearest_against_brute_force(spark, k):
    data = cloud(1, 150)
    wanted = set()
    for a in data:
        near = sorted(((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2, b[1]) for b in data if b[0] == a[0] and b[1] != a[1])
        wanted |= {(a[1], b, i + 1) for i, (_, b) in enumerate(near[:k])}
    assert rows(spatial.knn_edges(cells(spark, data), "fov", "cell_id", k), "src", "dst", "rank") == wanted


@pytest.mark.parametrize("r", [0.5, 12.0, 9000.0])
def test_radius_against_brute_force(spark, r):
    data = cloud(2, 120)
    wanted = {(a[1], b[1]) for a in data for b in data if a[0] == b[0] and a[1] != b[1] and math.dist(a[2:4], b[2:4]) <= r}
    assert rows(spatial.radius_edges(cells(spark, data), "fov", "cell_id", r), "src", "dst") == wanted


def test_multimers_and_signaling(spark):
    df = cells(spark, SQUARE)
    edges = spatial.radius_edges(df, "fov", "cell_id", 1.0)
    counts = spark.createDataFrame([("a", "L", 3), ("b", "R1", 2), ("b", "R2", 5), ("d", "R1", 4)], "cell_id string, gene string, count long")
    pairs = spatial.type_pairs(edges, df, "fov", "cell_id", "cell_type", "A", "B")
    scored = spatial.lr_scores(pairs, df, counts, "fov", "L", "R1+R2")
    assert rows(scored, "ligand_cell", "receptor_cell", "lr_score", "overall", "overall_normalized") == {("a", "b", 6, 1.5, 0.375), ("a", "d", 0, 1.5, 0.375), ("c", "b", 0, 1.5, 0.375), ("c", "d", 0, 1.5, 0.375)}
    signal = dict(rows(spatial.signaling_scores(edges, df, counts, "fov", "cell_id", "cell_type", ["B"], ["A"], "L", "R1")))
    assert set(signal) == {"b", "d"} and signal["d"] > signal["b"] > 0


def test_quadrats(spark):
    df = cells(spark, SQUARE)
    q = spatial.quadrat_counts(df, "fov", 2, 2)
    assert {r.n for r in q.collect()} == {1}
    r = spatial.quadrat_test(q, "fov").first()
    assert (r.chi2, r.df, r.vmr) == (0.0, 3, 0.0)
    assert spatial.to_micrometres(1.2, "px") == pytest.approx(10)
    with pytest.raises(ValueError):
        spatial.to_micrometres(1.0, "ft")


def test_curves(spark):
    data = [("f", "i", 5.0, 5.0, "I", 0.0), ("f", "j", 5.0, 6.0, "J", 0.0), ("f", "e0", 0.0, 0.0, "I", 0.0), ("f", "e1", 10.0, 10.0, "J", 0.0)]
    df = cells(spark, data)
    frame = patterns.framed(df, "fov", "cell_type")
    curves = patterns.cross_curves(spatial.radius_edges(df, "fov", "cell_id", 4.0), frame, "fov", [0.0, 1.0, 4.0])
    got = {(r.type_i, r.type_j, r.r): (r.n_i, r.g, r.k) for r in curves.collect()}
    assert got["I", "J", 0.0] == (2, 0.0, 0.0) and got["I", "J", 1.0] == (1, 1.0, 50.0) and got["J", "I", 4.0] == (1, 1.0, 50.0)
    assert rows(patterns.curve_summary(curves.where("type_i = 'I' AND type_j = 'J'"), "fov", "g"), "auc", "highest") == {(4.0, 1.0)}
    again = [patterns.envelope(spatial.radius_edges(df, "fov", "cell_id", 4.0), frame, "fov", 4.0, 9, 1).collect() for _ in range(2)]
    assert sorted(again[0]) == sorted(again[1]) and all(0 <= r.lowest <= r.highest <= 1 for r in again[0])


def test_cooccurrence_of_one_pattern(spark):
    profile = spark.createDataFrame([("c1", "A", 1), ("c1", "B", 1), ("c2", "A", 2), ("c3", "B", 1)], "cell_id string, cell_type string, n long")
    share = niches.shares(profile, "cell_id")
    w = niches.cooccurrence(share, "cell_id", "cell_type")
    assert rows(w) == {("A", "A", 1.25), ("B", "B", 1.25), ("A", "B", 0.25), ("B", "A", 0.25)}
    tested = {(r.type_from, r.type_to): r for r in niches.cooccurrence_test(share, w, "cell_type", 3).collect()}
    assert tested["A", "A"].p == 1.0 and tested["A", "B"].p > 0.5


def test_lost_cycle_is_flagged(spark):
    rnd = random.Random(4)
    barcodes = spark.createDataFrame([("g1", "0B1."), ("g2", "0G1."), ("g3", "0.1B"), ("g4", "0.1G"), ("g5", "0Y1Y"), ("g6", "0R1R")], "gene string, barcode string")
    points, counts = [], []
    for f in range(6):
        for i in range(400):
            cell = f"f{f}c{i}"
            points.append(("s", f"f{f}", cell, rnd.random() * 100, rnd.random() * 100))
            for g in range(1, 7):
                rate = 40 if not (f == 0 and g in (1, 2)) else 4  # cycle 1 is lost in f0
                counts.append((cell, f"g{g}", max(0, round(rnd.gauss(rate, 2)))))
    pts = spark.createDataFrame(points, "slide string, fov string, cell_id string, x double, y double")
    bits = fovqc.gene_bits(barcodes)
    assert rows(bits) >= {("g1", 1, "B"), ("g5", 2, "Y")}
    squares = fovqc.grid_squares(pts, side=3, min_cells=10)
    norm = fovqc.normalized_bits(fovqc.square_bits(squares, spark.createDataFrame(counts, "cell_id string, gene string, count long"), bits, 2))
    resid = fovqc.residuals(norm, fovqc.comparators(norm))
    flags = fovqc.bit_flags(fovqc.fov_bias(resid, [0.3]))
    cycles = fovqc.cycle_flags(flags)
    assert rows(cycles.where("flag_cycle"), "fov", "cycle") == {("f0", 1)}
    assert rows(fovqc.flagged_genes(cycles, bits)) == {("f0", g) for g in ("g1", "g2", "g5", "g6")}
    assert rows(fovqc.flag_sweep(flags, fovqc.low_total_fovs(resid, 0.3)), "n_bias", "n_flagged") == {(1, 1)}


def test_comparators_take_one_square_per_fov(spark):
    rnd = random.Random(5)
    made = [("s", f"f{i % 4}", f"q{i}", 10, 1.0, [rnd.random() for _ in range(4)]) for i in range(40)]
    bits = spark.createDataFrame(made, "slide string, fov string, square string, n_cells int, total double, bits array<double>")
    wanted = set()
    for _, fov, name, *_, v in made:
        near = sorted((round(math.dist(v, w) ** 2, 6), o, f) for _, f, o, *_, w in made)[:20]
        seen, place = {fov}, 0
        for _, o, f in near:
            if f not in seen:
                seen.add(f)
                place += 1
                if place <= 2:
                    wanted.add((name, o, place))
    assert rows(fovqc.comparators(bits, nearest=20, per_square=2)) == wanted


def test_place_clusters_follow_the_points_of_a_slide(spark):
    rnd = random.Random(8)
    sizes = {f"s{i:02}": 41 + 20 * (i % 3) for i in range(12)}
    pts = [(s, f"{s}_{j}", rnd.uniform(0, 100) + 5000 * (j == 0), rnd.uniform(0, 100)) for s, n in sizes.items() for j in range(n)]
    found = rows(niches.place_clusters(spark.createDataFrame(pts, "slide string, cell_id string, x double, y double"), "slide", "cell_id", 0.05, 60))
    assert len(found) == len(pts)
    place = {c: (x, y) for _, c, x, y in pts}
    for slide, n in sizes.items():
        members = {}
        for s, c, k in found:
            if s == slide:
                members.setdefault(k, []).append(place[c])
        assert len(members) == -(-n // 20)
        means = {k: tuple(sum(p[a] for p in ps) / len(ps) for a in (0, 1)) for k, ps in members.items()}
        for k, ps in members.items():
            assert all(math.dist(p, means[k]) <= min(math.dist(p, m) for m in means.values()) + 1e-3 for p in ps)


def test_no_cell_type_is_cut_from_a_profile(spark, monkeypatch):
    many = spark.range(501).selectExpr("concat('t', id) AS cell_type")
    monkeypatch.setattr(domain, "cells", lambda *_: many)
    assert len(space.cell_kinds(spark, "")) == 501
    monkeypatch.setattr(levels, "MOST", 500)
    with pytest.raises(ValueError, match="more than"):
        space.cell_kinds(spark, "")


def test_labels_settle_on_two_groups(spark):
    pairs = [("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "z"), ("x", "z")]
    graph = spark.createDataFrame([(*p, 1.0) for p in pairs], "a string, b string, w double")
    labels = dict(rows(niches.propagated_labels(graph, "a", "b", "w")))
    assert labels["a"] == labels["b"] == labels["c"] != labels["x"] == labels["y"] == labels["z"]


def test_labels_settle_beyond_ten_rounds(spark):
    graph = spark.createDataFrame([(f"n{i:02}", f"n{i + 1:02}", 1.0) for i in range(59)], "a string, b string, w double")
    labels = dict(rows(niches.propagated_labels(graph, "a", "b", "w")))
    for i in range(60):
        votes = {}
        for j in (i - 1, i, i + 1):
            if 0 <= j < 60:
                votes[labels[f"n{j:02}"]] = votes.get(labels[f"n{j:02}"], 0) + 1
        assert labels[f"n{i:02}"] == min(votes, key=lambda x: (-votes[x], x))
    with pytest.raises(ValueError, match="settled"):
        niches.propagated_labels(graph, "a", "b", "w", 1, 2)


def test_rank_sums_against_counting(spark):
    rnd = random.Random(6)
    kinds = {f"c{i}": rnd.choice("AB") for i in range(40)}
    held = {c: rnd.randint(0, 3) for c in kinds}
    counts = spark.createDataFrame([(c, "G", n) for c, n in held.items() if n], "cell_id string, gene string, count long")
    typed = spark.createDataFrame(list(kinds.items()), "cell_id string, cell_type string")
    got = {r.cell_type: r.u for r in expression.rank_sums(counts, typed, "cell_type").collect()}
    for k in "AB":
        ins, outs = [[held[c] for c in kinds if (kinds[c] == k) == w] for w in (True, False)]
        assert got[k] == sum((a > b) + 0.5 * (a == b) for a in ins for b in outs)


def test_model_recovers_a_rate_ratio(spark):
    rnd = random.Random(7)
    typed, counts = [], []
    for i in range(300):
        level = "high" if i % 2 else "base"
        typed.append((f"c{i}", "T", level))
        y = sum(rnd.random() < (0.2 if level == "high" else 0.1) for _ in range(100))
        counts += [(f"c{i}", "G", y), (f"c{i}", "rest", 100 - y)]
    df = spark.createDataFrame(typed, "cell_id string, cell_type string, timepoint string")
    found = expression.count_model(spark.createDataFrame([c for c in counts if c[2]], "cell_id string, gene string, count long"), df, "cell_type", "timepoint")
    r = found.where("gene = 'G'").first()
    assert (r.level_a, r.level_b, r.df) == ("base", "high", 298) and abs(r.estimate - math.log(2)) < 3 * r.se and r.wald > 5


def test_envelope_over_radii_and_numbers_of_simulations(spark):
    rnd = random.Random(9)
    df = cells(spark, [("f", f"c{i}", rnd.uniform(0, 20), rnd.uniform(0, 20), rnd.choice("AB"), 1.0) for i in range(60)])
    frame, edges = patterns.framed(df, "fov", "cell_type"), spatial.radius_edges(df, "fov", "cell_id", 4.0)
    found = rows(patterns.envelope(edges, frame, "fov", [0.0, 2.0, 4.0], 9, 1), "type_i", "type_j", "r", "lowest", "highest")
    assert {f[2] for f in found} == {0.0, 2.0, 4.0} and all(f[4] == 0 for f in found if f[2] == 0)
    one = rows(patterns.envelope(edges, frame, "fov", 4.0, 9, 1), "type_i", "type_j", "r", "lowest", "highest")
    assert one == {f for f in found if f[2] == 4.0}
    assert biology.ENVELOPES >= 199 and biology.LABELS >= 999 and biology.PERMUTATIONS >= 1000


def test_envelope_against_each_simulation(spark, monkeypatch):
    rnd = random.Random(11)
    made = [(f, f"{f}{i:02}", rnd.uniform(0, 30), rnd.uniform(0, 30), rnd.choice(["A", "A", "B", "C", None]), 1.0) for f in "fg" for i in range(50)]
    df, radii, sims = cells(spark, made), [2.0, 4.0, 8.0], 7
    frame, edges = patterns.framed(df, "fov", "cell_type"), spatial.radius_edges(df, "fov", "cell_id", 8.0)
    hashes = {r[0]: r[1] for r in frame.select("cell_id", F.xxhash64("cell_id", F.lit(3))).collect()}
    near, wanted = edges.select("src", "dst", "dist").collect(), {}
    for f in "fg":
        own = sorted((r.cell_id, r.kind, r.border) for r in frame.where(F.col("fov") == f).collect())
        border = {c: b for c, _, b in own}
        for sim in range(1, sims + 1):
            state = np.array([hashes[c] for c, _, _ in own], np.int64).view(np.uint64) + np.array([sim], np.uint64) * GOLDEN
            dealt = dict(zip([own[i][0] for i in np.argsort(mixed(state))], [k for _, k, _ in own], strict=True))
            for r in radii:
                met = {(e.src, dealt[e.dst]) for e in near if e.src in dealt and e.dst in dealt and e.dist <= r}
                for i in set(dealt.values()):
                    inner = [c for c in dealt if dealt[c] == i and border[c] >= r]
                    for j in set(dealt.values()) if inner else ():
                        wanted.setdefault((f, i, j, r), []).append(sum((c, j) in met for c in inner) / len(inner))
    wanted = {(*k, min(v), max(v)) for k, v in wanted.items()}
    assert rows(patterns.envelope(edges, frame, "fov", radii, sims, 3)) == wanted
    monkeypatch.setattr(patterns, "DEALT", 15)  # several tasks a window
    assert rows(patterns.envelope(edges, frame, "fov", radii, sims, 3)) == wanted


def test_enrichment_against_a_walk(spark):
    rnd = random.Random(8)
    stats = {f"g{i}": round(rnd.gauss(0, 1), 3) for i in range(40)}
    member = {s: {g for g in stats if rnd.random() < 0.3} for s in ("p", "q")} | {"all": set(stats), "none": {"other"}}
    est = spark.createDataFrame([("c", g, v) for g, v in stats.items()], "c string, gene string, e double")
    sets = spark.createDataFrame([(s, g) for s, gs in member.items() for g in gs], "gs_name string, gene string")
    ranked = expression.ranked_genes(est, ["c"], "gene", "e")
    got = {r.gs_name: r.es for r in expression.enrichment(ranked, sets, ["c"]).collect()}
    assert set(got) == {"p", "q"}
    for s in got:
        total, at, path = sum(abs(stats[g]) for g in member[s]), 0.0, [0.0]
        for g in sorted(stats, key=lambda g: (-stats[g], g)):
            at += abs(stats[g]) / total if g in member[s] else -1 / (len(stats) - len(member[s]))
            path.append(at)
        assert got[s] == pytest.approx(max(path, key=abs), abs=1e-9)
    tested = expression.enrichment_test(ranked, sets, ["c"], 30, 1).collect()
    assert all(0 < r.p <= 1 and (r.nes is None or math.copysign(1, r.nes) == math.copysign(1, r.es)) for r in tested)


def test_typing_rules(spark):
    data = [("1", "mast.cell", "Pericytes.1", "a"), ("2", None, "Pericytes.1", "B-cell"), ("3", None, None, "a"), ("4", None, None, "Fibroblast"), ("5", None, None, None), ("6", "x", "y", "NK")]
    typed = expression.typed_by_rules(spark.createDataFrame(data, "cell_id string, l string, s string, i string"), "l", "s", "i")
    assert rows(typed, "cell_id", "final_type", "n_rules") == {("1", "mast.cell", 2), ("2", "Pericytes.1", 2), ("3", expression.UNKNOWN, 0), ("4", expression.UNKNOWN, 0), ("5", None, 1), ("6", "NK", 1)}
    names = spark.createDataFrame([("Mac|x",), ("CD4 T",), ("CD|",), ("Tumor|Intracellular_16S",), ("B",)], "v string")
    assert [r[0] for r in names.select(expression.simple_category(F.col("v"))).collect()] == ["Myeloid", "T cell", "T cell", "16S+ tumor", "Other"]


def test_vector_neighbors_in_blocks(spark):
    rnd = random.Random(9)
    vectors = {i: [rnd.random() for _ in range(3)] for i in range(60)}
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors.items()] + [(99, None, "x")], "vec_id long, embedding array<double>, b1 string")
    got = rows(niches.vector_neighbors(df.where("vec_id % 10 = 0"), df, "vec_id", "embedding", 3, block=16), "query", "neighbor", "rank")
    wanted = {(q, n, i + 1) for q in range(0, 60, 10) for i, n in enumerate(sorted((j for j in vectors if j != q), key=lambda j: math.dist(vectors[q], vectors[j]))[:3])}
    assert got == wanted


def test_dense_place_and_nearest(spark):
    """Many points at one place: each gets its first neighbours by key, none is compared with all."""
    data = [("f", f"d{i:04}", 1.0, 1.0, "A", 0.0) for i in range(600)] + [("f", "z", 9.0, 1.0, "A", 0.0)]
    got = rows(spatial.knn_edges(cells(spark, data), "fov", "cell_id", 2), "src", "dst", "rank")
    assert len(got) == 1202 and {g for g in got if g[0] == "z"} == {("z", "d0000", 1), ("z", "d0001", 2)}
    assert {g for g in got if g[0] == "d0000"} == {("d0000", "d0001", 1), ("d0000", "d0002", 2)}


def test_inhomogeneous_k_of_an_even_intensity(spark):
    df = cells(spark, cloud(3, 80)).where("fov = 'f1'")
    edges = spatial.radius_edges(df, "fov", "cell_id", 20.0)
    frame = patterns.framed(df, "fov", "cell_type").first()
    even = df.select("fov", "cell_id", F.lit(df.count() / frame.area).alias("intensity"))
    for r in patterns.inhomogeneous_k(edges, df, even, "fov", [5.0, 20.0]).collect():
        assert r.k == pytest.approx(r.k_inhom)


def test_gap_statistic_finds_three_groups(spark):
    rnd = random.Random(6)
    made = [(f"c{i}", [rnd.gauss(m, 0.3), rnd.gauss(-m, 0.3)]) for i, m in enumerate([0, 10, 20] * 25)]
    found = niches.gap_statistic(spark.createDataFrame(made, "cell_id string, v array<double>"), "cell_id", [1, 2, 3, 4, 5], 8)
    assert [r.k for r in found.where("chosen").collect()] == [3] and found.count() == 5
    assert niches.gap_statistic(spark.createDataFrame([], "cell_id string, v array<double>"), "cell_id", [1, 2], 3).count() == 0


def test_gap_statistic_against_plain_k_means(spark):
    rnd = random.Random(12)
    apart = [(f"c{i}", [rnd.gauss(m, 1.0), rnd.gauss(-m, 1.0), 7.0]) for i, m in enumerate([0, 6] * 60)]
    even = [(f"c{i}", [float(i % 3)]) for i in range(30)]  # 1 is as near to 0 as to 2
    for made, ks, references, steps in ((apart, [1, 2, 4], 5, 4), (even, [1, 2, 3], 2, 3)):
        df = spark.createDataFrame(made, "cell_id string, v array<double>")
        hashed = {r[0]: r[1] for r in df.select("cell_id", F.xxhash64("cell_id", F.lit(1))).collect()}
        starts = [r[0] for r in df.select("v").distinct().orderBy(F.xxhash64("v", F.lit(1))).limit(max(ks)).collect()]
        x = np.array([v for _, v in made])
        low, high, d = x.min(axis=0), x.max(axis=0), x.shape[1]
        state = np.array([hashed[c] for c, _ in made], np.int64).view(np.uint64)[:, None]
        seeds = np.random.default_rng(1).uniform(low, high, (references + 1, max(ks), d))
        seeds[0, : len(starts)] = starts
        log = np.zeros((references + 1, len(ks)))
        for b in range(references + 1):
            turns = np.arange((b - 1) * d + 1, b * d + 1).astype(np.uint64) * GOLDEN
            y = x if b == 0 else low + (mixed(state + turns) >> np.uint64(32)) * ((high - low) / 2.0**32)
            for j, k in enumerate(ks):
                centers = seeds[b, :k].copy()
                for step in range(steps + 1):
                    far = -2 * y @ centers.T + (centers * centers).sum(axis=1)
                    own = far.argmin(axis=1)
                    log[b, j] = np.log(max(1e-12, np.maximum(far.min(axis=1) + (y * y).sum(axis=1), 0).sum()))
                    for c in set(own) if step < steps else ():
                        centers[c] = y[own == c].mean(axis=0)
        found = niches.gap_statistic(df.repartition(3), "cell_id", ks, references, steps).orderBy("k").collect()
        assert [r.gap for r in found] == pytest.approx(list(log[1:].mean(axis=0) - log[0]), abs=1e-8)
        assert [r.se for r in found] == pytest.approx(list(log[1:].std(axis=0) * math.sqrt(1 + 1 / references)), abs=1e-8)


def test_clusters_within_groups(spark):
    rnd = random.Random(7)
    made = [(g, f"{g}{i}", [m + rnd.gauss(0, 0.1), 5.0]) for g, shift in (("p", 0), ("q", 100)) for i, m in enumerate([shift, shift + 9] * 20)] + [("tiny", "t", [1.0, 1.0])]
    found = niches.grouped_kmeans(spark.createDataFrame(made, "fov string, cell_id string, v array<double>"), "fov", "cell_id", 2).collect()
    of = {r.cell_id: (r.fov, r.cluster) for r in found}
    assert len(of) == 81
    for g in "pq":  # each group has both of its own clusters, whatever lies in the other
        parts = [{of[f"{g}{i}"] for i in range(k, 40, 2)} for k in (0, 1)]
        assert len(parts[0]) == len(parts[1]) == 1 and parts[0] != parts[1]


def test_mixture_with_one_diagonal(spark):
    rnd = random.Random(8)
    made = [(i, [rnd.gauss(m, 1.0), rnd.gauss(0, 30.0)]) for i, m in enumerate([0, 12] * 150)]  # the second column is wide and says nothing
    found = {r.id: r for r in niches.diagonal_mixture(spark.createDataFrame(made, "id long, v array<double>").repartition(3), "id", 2).collect()}
    sides = [{found[i].niche for i in range(k, 300, 2) if abs(made[i][1][0] - 12 * k) < 3} for k in (0, 1)]
    assert len(found) == 300 and all(0.5 <= r.certainty <= 1 for r in found.values())
    if len(sides[0]) == len(sides[1]) == 1:
        assert sides[0] != sides[1]
    else:  # k-means starts along the wide column; then the shares still follow it
        assert {r.niche for r in found.values()} == {0, 1}


def test_dense_vectors(spark):
    entries = spark.createDataFrame([("a", "x", 1.0), ("a", "z", 3.0), ("b", "y", 2.0)], "k string, name string, value double")
    keys = spark.createDataFrame([("a",), ("b",), ("none",)], "k string")
    assert {r.k: r.v for r in niches.dense_vectors(entries, keys, "k", "name", "value").collect()} == {"a": [1.0, 0.0, 3.0], "b": [0.0, 2.0, 0.0], "none": [0.0, 0.0, 0.0]}


def test_batches_are_brought_together(spark):
    rnd = random.Random(9)
    made = [(i, [m + rnd.gauss(0, 0.3) + (4.0 if i % 2 else 0.0), 20 - m + rnd.gauss(0, 0.3)]) for i, m in enumerate([0, 0, 15, 15] * 60)] + [(999, [1.0, 1.0])]
    scores = spark.createDataFrame(made, "id long, v array<double>")
    batches = spark.createDataFrame([(i, "b" if i % 2 else "a") for i in range(240)], "id long, batch string")
    after = {r.id: r.v for r in niches.batch_corrected(scores, batches, "id", "batch", 2).collect()}
    gap = lambda of, m: abs(sum(of[i][0] * (1 if i % 2 else -1) for i in range(240) if (i // 2) % 2 == m)) / 60
    before = dict(made)
    assert len(after) == 241 and after[999] == [1.0, 1.0]
    assert all(gap(after, m) < gap(before, m) / 2 for m in (0, 1))
    spread = lambda of: abs(sum(of[i][1] * (1 if (i // 2) % 2 else -1) for i in range(240))) / 120
    assert spread(after) > 0.9 * spread(before)  # what sets clusters apart stays


def test_pair_table_scores(spark):
    data = [("f", "a", 0.0, 0.0, "A", 1.0), ("f", "b", 1.0, 0.0, "B", 1.0), ("f", "c", 0.0, 1.0, "A", 1.0), ("f", "d", 50.0, 50.0, "B", 1.0), ("f", "e", 0.0, 2.0, None, 1.0)]
    df = cells(spark, data)
    edges = spatial.radius_edges(df, "fov", "cell_id", 2.0)
    counts = spark.createDataFrame([("a", "L", 3), ("b", "R1", 2), ("b", "R2", 5), ("c", "L", 1), ("c", "R1", 4)], "cell_id string, gene string, count long")
    pairs = spark.createDataFrame([("L", "R1+R2", "A", "B", 9.0), ("L", "R1", "A", "A", 9.0), ("L", "R1", "A", "B", 1.0), ("L", "none", "A", "B", 9.0)], "ligand string, receptor string, ligand_cell string, receptor_cell string, r double")
    found = spatial.lr_table_scores(edges, df, counts, pairs, "fov", "cell_id", "cell_type")
    assert rows(found, "ligand", "receptor", "ligand_cell", "receptor_cell", "lr_score", "overall", "overall_normalized") == {
        ("L", "R1+R2", "a", "b", 6, 4.0, 0.8), ("L", "R1+R2", "c", "b", 2, 4.0, 0.8), ("L", "R1", "a", "c", 12, 12.0, 2.4), ("L", "R1", "a", "b", 6, 6.0, 1.2),
        ("L", "none", "a", "b", 0, 0.0, 0.0), ("L", "none", "c", "b", 0, 0.0, 0.0),
    }
    assert spatial.lr_table_scores(edges, df, counts, pairs.limit(0), "fov", "cell_id", "cell_type").count() == 0


def test_summary_by_type_of_column(spark):
    df = cells(spark, SQUARE)
    found = spatial.neighborhood_summary(spatial.radius_edges(df, "fov", "cell_id", 1.0), df, "cell_id", ["v", "cell_type"])
    assert ("a", "v", None, 6.0) in rows(found) and ("a", "cell_type", "B", 2.0) in rows(found) and found.count() == 8
    with pytest.warns(UserWarning, match="more than 1 levels"):
        spatial.neighborhood_summary(spatial.radius_edges(df, "fov", "cell_id", 1.0), df, "cell_id", ["cell_type"], most=1)


def test_anchors_and_updated_profiles(spark):
    counts = [(f"{k}{i}", g, n) for k, own in (("A", "ga"), ("B", "gb")) for i in range(25) for g, n in ((own, 9), ("both", 1))] + [("m", "both", 4)]
    c = spark.createDataFrame(counts, "cell_id string, gene string, count long")
    profiles = spark.createDataFrame([("A", "ga", 5.0), ("A", "both", 1.0), ("B", "gb", 5.0), ("B", "both", 1.0)], "cell_type string, gene string, mean double")
    background = c.select("cell_id", F.lit(0.01).alias("background")).distinct()
    scores = expression.type_scores(c, profiles, "cell_type", background)
    typed = dict(rows(expression.likeliest_types(scores, "cell_type"), "cell_id", "cell_type"))
    assert typed == {**{f"{k}{i}": k for k in "AB" for i in range(25)}, "m": "A"}  # equal scores go by name
    found = expression.anchors(scores, "cell_type", n=22)
    assert found.groupBy("cell_type").count().collect() and {r["count"] for r in found.groupBy("cell_type").count().collect()} == {22}
    assert expression.anchors(scores, "cell_type", at_least=26).count() == 0
    updated = expression.updated_profiles(c, found.where("cell_type = 'A'"), profiles, "cell_type")
    assert rows(updated, "cell_type", "gene", "mean") == {("A", "ga", 9.0), ("A", "both", 1.0), ("B", "gb", 5.0), ("B", "both", 1.0)}


def test_ratios_within_places(spark):
    data = [(f"{p}{lv}{i}", "T", lv, p) for p in "xy" for lv in "ab" for i in range(5)] + [("alone", "T", "a", "z")]
    c = spark.createDataFrame(data, "cell_id string, cell_type string, timepoint string, fov string")
    rate = {("x", "a"): 2, ("x", "b"): 4, ("y", "a"): 20, ("y", "b"): 40}  # twice as many in b at each place, ten times as many at y
    counts = [(cid, "g", rate.get((p, lv), 1)) for cid, _, lv, p in data] + [(cid, "rest", 100) for cid, *_ in data]
    k = spark.createDataFrame(counts, "cell_id string, gene string, count long")
    genes = spark.createDataFrame([("T", "g", "a", "b"), ("T", "absent", "a", "b")], "cell_type string, gene string, level_a string, level_b string")
    r = expression.stratified_ratios(k, c, genes, "cell_type", "timepoint", "fov").collect()
    assert len(r) == 1 and r[0].n_strata == 2
    e = {("x", "a"): 510, ("x", "b"): 520, ("y", "a"): 600, ("y", "b"): 700}
    top = sum(5 * rate[p, "b"] * e[p, "a"] / (e[p, "a"] + e[p, "b"]) for p in "xy")
    bottom = sum(5 * rate[p, "a"] * e[p, "b"] / (e[p, "a"] + e[p, "b"]) for p in "xy")
    assert r[0].estimate == pytest.approx(math.log(top / bottom))

