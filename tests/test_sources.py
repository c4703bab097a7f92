import pytest
from pyspark.sql import functions as F

from cellweave import config, streaming
from cellweave.functions.scratch import checkpoint_dir, cut, saved
from cellweave.operators import qc
from cellweave.operators.qc import Limits
from cellweave.plans import imports, pipeline
from cellweave.sources import flatfiles
from tests.helpers import rows


@pytest.fixture
def run_folder(tmp_path):
    for slide, genes, lines in (("s1", "A,B,Negative1,SystemControl1,16S", ["1,1,5,0,1,9,2", "1,2,0,0,0,0,0", "1,3,4"]), ("s2", "A,B,Negative1,SystemControl1,16S", ["1,1,7,8,0,0,0"])):
        folder = tmp_path / slide
        folder.mkdir()
        (folder / "x_metadata_file.csv").write_text("fov,cell_ID,Area,timepoint\n1,1,10.5,t0\n1,2,11,t1\n1,3,12,\n1,9,1,t0\n")
        (folder / "x_exprMat_file.csv").write_text(f"fov,cell_ID,{genes}\n" + "\n".join(lines) + "\n")
        (folder / "x_tx_file.csv").write_text("fov,cell_ID,cell,x_local_px,y_local_px,x_global_px,y_global_px,z,target,CellComp\n1,1,c_1,1,2,3,4,5.5,A,Nuclear\n")
        (folder / "flat" / "RunSummary").mkdir(parents=True)
        (folder / "flat" / "RunSummary" / "Run_1_ExptConfig.txt").write_text("Run Number: R77\nmore\n" if slide == "s1" else "nothing\n")
    return tmp_path


def test_readers(spark, run_folder):
    root = str(run_folder)
    cells = flatfiles.read_cells(spark, root)
    assert cells.count() == 8 and rows(cells.where("cell_ID = 1"), "Run_Tissue_name", "uniqueFOV") == {("s1", "s1:1"), ("s2", "s2:1")}
    counts = flatfiles.read_counts(spark, root)
    assert rows(counts.where("Run_Tissue_name = 's1' AND cell_ID <> 1"), "cell_ID", "gene", "count") == {(3, "A", 4)}
    ids = dict(rows(flatfiles.read_run_ids(spark, root)))
    known = spark.createDataFrame([("s1",), ("s2",), ("bare",), ("bare",)], "Run_Tissue_name string")
    more = dict(rows(flatfiles.read_run_ids(spark, root, known)))
    assert len(more.pop("bare")) == 37 and more == ids
    assert ids["s1"] == "R77" and len(ids["s2"]) == 37 and ids == dict(rows(flatfiles.read_run_ids(spark, root)))
    assert flatfiles.read_molecules(spark, f"{root}/*/*_tx_file.csv").first().z == 5.5
    with pytest.raises(ValueError, match="cell_ID"):
        flatfiles.require(spark.range(1).withColumnRenamed("id", "fov"), ["fov", "cell_ID"])


def test_slides_with_other_headers(spark, run_folder):
    folder = run_folder / "s3"
    folder.mkdir()
    (folder / "x_metadata_file.csv").write_text("timepoint,cell_ID,only_here,Area,fov\nt1,4,q,13,2\n")
    (folder / "x_exprMat_file.csv").write_text("fov,B,Addon.1,cell_ID,A,Negative1,16S,SystemControl1\n2,6,9,4,5,1,3,2\n")
    with pytest.warns(UserWarning, match="only_here"):
        cells = flatfiles.read_cells(spark, str(run_folder))
    assert rows(cells.where("Run_Tissue_name = 's3'"), "uniqueFOV", "fov", "cell_ID", "Area", "timepoint") == {("s3:2", 2, 4, 13.0, "t1")}
    assert cells.count() == 9 and "only_here" not in cells.columns
    with pytest.warns(UserWarning, match="Addon.1"):
        counts = flatfiles.read_counts(spark, str(run_folder))
    found = rows(counts, "Run_Tissue_name", "cell_ID", "gene", "count")
    assert {f[1:] for f in found if f[0] == "s3"} == {(4, "A", 5), (4, "B", 6), (4, "Negative1", 1), (4, "16S", 3), (4, "SystemControl1", 2)}
    assert {f[1:] for f in found if f[0] == "s2"} == {(1, "A", 7), (1, "B", 8)}


def test_types_of_other_headers(spark, tmp_path):
    for slide, text in (("s1", "fov,cell_ID,n,code,none\n1,1,1,1.50,\n"), ("s2", "cell_ID,fov,n,code,none\n2,1,2.5,x,7\n")):
        (tmp_path / slide).mkdir()
        (tmp_path / slide / "a_metadata_file.csv").write_text(text)
    cells = flatfiles.read_cells(spark, str(tmp_path))
    assert rows(cells, "cell_ID", "n", "code", "none") == {(1, 1.0, "1.50", None), (2, 2.5, "x", 7)}


def test_pipeline(spark, run_folder):
    settings = config.Config({"filter_vars": "timepoint,exclude,t9", "neovariables": ["timepoint+fov"], "bacterial_probes": ["16S"]})
    e = pipeline.imported(spark, str(run_folder), settings)
    assert rows(e.cells, "cell_id") == {("c_s1_1_1",), ("c_s1_1_3",), ("c_s2_1_1",)}
    assert rows(e.counts.groupBy("assay").agg(F.sum("count"))) == {("RNA", 24), ("negative", 1), ("bacterial", 2)}
    kept = pipeline.checked(e, Limits(min_counts=5, max_negative=0.5))
    assert rows(kept.cells, "cell_id", "timepoint_fov") == {("c_s1_1_1", "t0_1"), ("c_s2_1_1", "t0_1")}
    assert pipeline.normalized(kept, 1).where("logged > 0").count() == 3


def test_small_tables(spark, tmp_path):
    (tmp_path / "p.csv").write_text(",T1,T2\nA,1,3\nB,,4\n")
    profiles = flatfiles.read_profiles(spark, str(tmp_path / "p.csv"))
    assert rows(profiles) == {("A", "T1", 1.0), ("A", "T2", 3.0), ("B", "T1", None), ("B", "T2", 4.0)}
    genes = spark.createDataFrame([("A",)], "gene string")
    assert max(r.value for r in flatfiles.scaled_profiles(profiles, genes).collect()) == pytest.approx(3 / 2.98 * 1000)
    (tmp_path / "w.tsv").write_text("H\t\nC2\tREACTOME\n")
    assert flatfiles.read_pathways(spark, str(tmp_path / "w.tsv")).count() == 2
    with pytest.raises(ValueError, match="xlsx"):
        flatfiles.read_pathways(spark, "a.xlsx")
    (tmp_path / "lr.csv").write_text("r1,R,L,x,y,cell_type,50\n")
    assert flatfiles.read_pairs(spark, str(tmp_path / "lr.csv")).first().r == 50.0
    assert flatfiles.query_file(spark, str(tmp_path / "p.csv"), "SELECT sum(T2) AS s FROM f").first().s == 7


def test_additional_columns(spark):
    cells = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    extra = spark.createDataFrame([("a", 9, "x"), ("a", 9, "x")], "id string, n int, more string")
    assert rows(flatfiles.with_additional(cells, extra, "id")) == {("a", 1, "x"), ("b", 2, None)}
    assert flatfiles.with_additional(cells, extra, "no").columns == ["id", "n"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s1", 1), ("s2", 2)], "slide string, n int")
    flatfiles.write_stage(df, str(tmp_path / "stage"), "slide")
    assert rows(spark.read.parquet(str(tmp_path / "stage")), "slide", "n") == {("s1", 1), ("s2", 2)}
    flatfiles.write_result(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2
    flatfiles.create_table(df, "made_here")
    flatfiles.create_table(df.limit(1), "made_here")
    assert spark.table("made_here").count() == 1
    flatfiles.mark_stage(spark, str(tmp_path / "mark"), "qc")
    assert flatfiles.last_stage(spark, str(tmp_path / "mark")) == "qc"


def test_stream_takes_each_file_once(spark, run_folder, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("table")
    for _ in range(2):
        stream = streaming.arriving_molecules(spark, str(run_folder))
        streaming.keep(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination(120)
    found = spark.read.parquet(str(tmp_path / "t"))
    assert found.count() == 2 and rows(found, "Run_Tissue_name", "z") == {("s1", 5.5), ("s2", 5.5)}


def test_scratch(spark):
    df = spark.range(5)
    assert checkpoint_dir(spark) == checkpoint_dir(spark)
    assert cut(df).count() == saved(df).count() == 5


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("qc:\n  min: 5\n  names: a, b\n")
    variables = [{"variable": "names", "required": "TRUE", "split_string": "TRUE"}, {"variable": "extra", "default_value": "7"}]
    loaded = config.load(str(tmp_path / "c.yaml"), variables)
    assert loaded["names"] == ["a", "b"] and loaded["min"] == 5 and loaded.get("extra") == "7" and loaded.sections["min"] == "qc.min"
    with pytest.raises(ValueError, match="gone"):
        config.validated({}, [{"variable": "gone", "required": "TRUE"}])
    with pytest.raises(ValueError, match="set at"):
        config.flattened({"a": {"x": 1}, "b": {"x": 2}})
    assert config.merged({"a": 1, "b": {"c": 2, "d": 3}}, {"b": {"d": 9}, "z": 1}) == {"a": 1, "b": {"c": 2, "d": 9}}


def test_filters_of_the_configuration(spark):
    cells = [(i, "s", 1 + i % 2, f"s:{1 + i % 2}", 100.0 + i % 5) for i in range(40)] + [(40, "s", 1, "s:1", 99999.0)]
    counts = [(i, g, a, n) for i in range(41) for g, a, n in (("A", "RNA", 6), ("B", "RNA", 9), ("L", "RNA", int(i == 0)), ("Negative1", "negative", int(i < 2)), ("Negative2", "negative", int(i < 3)), ("Negative3", "negative", int(i < 2))) if n]
    e = pipeline.Experiment(
        spark.createDataFrame(cells, "cell_id long, slide string, fov int, uniqueFOV string, Area double"),
        spark.createDataFrame([("A", "RNA"), ("B", "RNA"), ("L", "RNA"), ("Negative1", "negative"), ("Negative2", "negative"), ("Negative3", "negative")], "gene string, assay string"),
        spark.createDataFrame(counts, "cell_id long, gene string, assay string, count long"),
    )
    limits = qc.Limits(min_counts=5, min_features=1, max_negative=0.5, min_complexity=1.0, min_signal=0.0)
    bad = spark.createDataFrame([("s:2",)], "fov string")
    ids = lambda made: {r.cell_id for r in made.cells.select("cell_id").collect()}
    inner = {i for i in range(40) if i % 5}  # the test is for both ends at once, so the smallest areas go with the huge one
    assert ids(pipeline.checked(e, limits)) == inner
    assert ids(pipeline.checked(e, limits, {"filter_fovs": True}, bad)) == {i for i in inner if i % 2 == 0}
    assert ids(pipeline.checked(e, limits, {"filter_cells": False})) == set(range(41))
    assert ids(pipeline.checked(e, limits, {"pre_qc_mode": True, "filter_fovs": True, "filter_targets": True}, bad)) == set(range(41))
    by = {"filter_cells": False, "filter_targets": True, "filter_targets_by_neg_control_quantile": True}
    genes = lambda made: {r.gene for r in made.counts.select("gene").distinct().collect()}
    assert genes(pipeline.checked(e, limits, by)) == {"A", "B", "Negative1", "Negative2", "Negative3"}
    assert genes(pipeline.checked(e, limits, {"filter_cells": False, "filter_targets": True})) == {"A", "B", "L", "Negative1", "Negative2", "Negative3"}


def test_negative_outliers(spark):
    means = [(f"N{i}", "negative", 41, 1.0 + i / 1000, 1.0) for i in range(20)] + [("far", "negative", 41, 9.0, 1.0), ("A", "RNA", 41, 99.0, 1.0)]
    found = qc.negative_outliers(spark.createDataFrame(means, "gene string, assay string, n_cells long, mean double, sd double"), 0.01)
    assert rows(found.where("outlier"), "gene") == {("far",)} and found.count() == 21


def test_settings_are_dumped(tmp_path):
    config.dumped({"min_counts_per_cell": 5, "filter_cells": True}, str(tmp_path / "qc.yaml"))
    assert dict(config.load(str(tmp_path / "qc.yaml")).values) == {"min_counts_per_cell": 5, "filter_cells": True}


def test_csv_molecules_keeps_odd_texts(spark, tmp_path):
    texts = ["plain", " lead", "trail ", "a,b", 'q"x', "b,back\\", "new\nline", "cr\rx", "\ttab", " ", "", None]
    held = [("1", "1", f"c_{t}", float("nan") if i % 2 else -1.5, 1.0, 1.0, 1.0, 0.5, t, t) for i, t in enumerate(texts)]
    spark.createDataFrame(held, flatfiles.MOLECULES).coalesce(1).write.parquet(f"{tmp_path}/transcripts.parquet")
    found = imports.csv_molecules(spark, str(tmp_path)).withColumn("x_min", F.col("x_min").cast("string"))
    assert rows(found) == {(t, t, 1, 1, "NaN" if i % 2 else "-1.5", 0.5) for i, t in enumerate(texts)}
