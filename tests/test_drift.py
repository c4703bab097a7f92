import csv
import datetime as dt
import itertools
import json
import random
import re

import duckdb
import pytest

from cellweave.functions import levels
from cellweave.operators import drift
from cellweave.plans import problems
from tests.helpers import rows

RAW = "record_id long, stream_name string, file_name string, file_format string, delivered_at timestamp_ntz, line_no int, raw_line string, names string, head int"
KNOWN = [("fov", "fov"), ("fov", "FOV_number"), ("cell_ID", "cell_ID"), ("Area", "Area"), ("Area", "Area.um2"), ("fov", None)]


def raw(spark, files):
    """files: (stream, name, format, day, lines); lines come shuffled, the first one twice."""
    made = []
    for stream, name, kind, day, lines in files:
        numbered = [(stream, name, kind, dt.datetime(2024, 1, day), i + 1, line) for i, line in enumerate(lines)]
        made += numbered + numbered[:1]
    random.Random(1).shuffle(made)
    return spark.createDataFrame([(i, *m, "x", 0) for i, m in enumerate(made)], RAW)


def known(spark):
    return drift.known_names(spark.createDataFrame(KNOWN, "field_name string, known_name string"))


def schemas(spark, files):
    found = drift.stream_files(raw(spark, files))
    return drift.file_schemas(drift.parsed_lines(raw(spark, files), found), found, known(spark))


def scripts(spark, files):
    return drift.schema_changes(schemas(spark, files), known(spark))


def changes(spark, files):
    return rows(drift.listed_changes(scripts(spark, files)), "file_name", "field_name", "change_kind")


def unified(spark, files, targets):
    found = schemas(spark, files)
    composed = drift.composed_fields(found, drift.schema_changes(found, known(spark)))
    return drift.unified_records(drift.parsed_lines(drift.distinct_lines(raw(spark, files)), drift.stream_files(raw(spark, files))), composed, targets)


def test_every_kind_of_change(spark):
    files = [
        ("s", "f9", "csv", 1, ["# note", "", "\ufefffov,cell_ID,Area", "1,2,3.5", "2", "NA,,null"]),
        ("s", "f1", "csv", 2, ["FOV_number;\"cell_ID\"; X1", "1.5;7;a", "2;NaN;b;extra"]),
        ("s", "f5", "jsonl", 3, ['{"fov": 3, "cell_ID": "0037", "x1": null}', '{"fov": "4", "Area.um2": 2e3}', "not json", "[1]"]),
        ("t", "f2", "csv", 9, ["fov\tcell_ID", "1\t2"]),
    ]
    assert changes(spark, files) == {
        ("f1", "fov", "renamed"), ("f1", "fov", "retyped"), ("f1", "Area", "removed"), ("f1", "x1", "added"),
        ("f5", "fov", "renamed"), ("f5", "fov", "retyped"), ("f5", "Area", "added"),
    }


def test_a_field_without_values_has_no_type(spark):
    files = [("s", "a", "csv", 1, ["fov,Area", "1,NA"]), ("s", "b", "csv", 2, ["fov,Area", "1,2.5"])]
    assert changes(spark, files) == set()


def test_unified_table(spark):
    files = [
        ("s", "a", "csv", 1, ["fov,cell_ID,extra", '1,"x, y",e', "2"]),
        ("s", "b", "jsonl", 2, ['{"Area.um2": 2.5, "FOV_number": 7, "pos": {"x": 1, "deep": {"y": "q"}}}']),
    ]
    table = unified(spark, files, ["Area", "cell_ID", "fov"])
    assert dict(table.dtypes) | {"Area": "double", "cell_ID": "string", "fov": "bigint"} == dict(table.dtypes)
    assert {(r.file_name, r.line_no, r.Area, r.cell_ID, r.fov, tuple(sorted(r.others.items()))) for r in table.collect()} == {
        ("a", 2, None, "x, y", 1, (("extra", "e"),)), ("a", 3, None, None, 2, ()), ("b", 1, 2.5, None, 7, (("pos/deep/y", "q"), ("pos/x", "1"))),
    }


def test_a_field_under_two_names_in_one_file(spark):
    files = [
        ("s", "a", "jsonl", 1, ['{"fov": 1}', '{"FOV_number": 2, "new": "n"}', '{"fov": 3, "FOV_number": 4}']),
        ("s", "b", "csv", 2, ["Area.um2;Area;fov", "1.5;;5", ";2.5;6", "3.5;4.5;7"]),
        ("s", "c", "jsonl", 3, ['{"Area.um2": 9.5, "FOV_number": 8}']),
    ]
    table = unified(spark, files, ["Area", "fov"])
    assert {(r.file_name, r.line_no, r.Area, r.fov, tuple(sorted(r.others.items()))) for r in table.collect()} == {
        ("a", 1, None, 1, ()), ("a", 2, None, 2, (("new", "n"),)), ("a", 3, None, 3, (("fov_number", "4"),)),
        ("b", 2, 1.5, 5, ()), ("b", 3, 2.5, 6, ()), ("b", 4, 4.5, 7, (("area.um2", "3.5"),)), ("c", 1, 9.5, 8, ()),
    }
    assert changes(spark, files) == {("b", "Area", "added"), ("b", "new", "removed"), ("c", "fov", "renamed")}


def test_more_levels_than_fit_are_refused(spark):
    with pytest.raises(ValueError, match="more than"):
        levels.few(spark.range(levels.MOST + 1))
    assert len(levels.few(spark.range(1001))) == 1001


def test_empty_and_odd_files(spark):
    assert changes(spark, []) == set()
    files = [("s", "a", "csv", 1, ["", "# only a comment"]), ("s", "b", "csv", 2, ["fov", ""]), ("s", "c", "csv", 3, ["fov,fov,,", "1,2,3,4"])]
    assert changes(spark, files) == set()
    nulls = spark.createDataFrame([(1, "s", "f", "csv", None, 1, None, "x", 0), (2, None, None, None, None, None, None, None, None)], RAW)
    assert drift.parsed_lines(nulls, drift.stream_files(nulls)).count() == 0


def test_long_line(spark):
    long = "v" * 1_000_000
    assert rows(unified(spark, [("s", "a", "csv", 1, ["fov,cell_ID", f"1,{long}"])], ["cell_ID"]), "cell_ID") == {(long,)}


@pytest.mark.parametrize("value,rank", [("", 0), (" NaN ", 0), ("n/a", 0), ("+7", 1), ("007", 1), ("1.", 2), (".5", 2), ("-1e5", 2), ("1e", 3), ("inf", 3), ("wk;8", 3), ("1 2", 3)])
def test_types(spark, value, rank):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(drift.type_rank(df.v)).first()[0] == rank


def leaf(field, name=None, rank=1, place=0, sketch=()):
    return drift.Leaf(field, (name or field,), rank, place, sketch)


def kinds(*sides, listed=()):
    return {(e.field, e.kind, e.old) for e in drift.edit_script(*sides, frozenset(listed))}


def test_scripts_of_nested_schemas():
    old = (leaf("a"), leaf("pos/x"), leaf("pos/y"), leaf("z"))
    assert kinds(old, old) == set()
    assert kinds(old, (leaf("a"), leaf("pos/x"), leaf("y"), leaf("z"))) == {("y", "moved", "pos/y")}
    assert kinds(old, (leaf("a", "alpha", 2), leaf("pos/x"), leaf("pos/y"))) == {("a", "renamed", None), ("a", "retyped", None), ("z", "removed", None)}
    assert kinds((), old) == {(f.field, "added", None) for f in old}


def test_whole_objects_are_matched_wrapped_and_renamed():
    flat = tuple(leaf(f, place=i) for i, f in enumerate("abcdef"))
    wrapped = tuple(leaf(f"data/{f}", place=i) for i, f in enumerate("abcdef"))
    assert kinds(flat, wrapped) == {(f"data/{f}", "moved", f) for f in "abcdef"}
    assert kinds(wrapped, flat) == {(f, "moved", f"data/{f}") for f in "abcdef"}
    other = tuple(leaf(f"body/{f}", place=i) for i, f in enumerate("abcdef"))
    assert kinds(wrapped, other) == {(f"body/{f}", "moved", f"data/{f}") for f in "abcdef"}


def test_renames_are_found_by_cost():
    values, others = (1, 2, 3, 4), (5, 6, 7, 8)
    old = (leaf("colour", place=1, sketch=values), leaf("n", place=2))
    assert kinds(old, (leaf("color", place=1, sketch=values), leaf("n", place=2))) == {("color", "renamed", "colour")}
    assert kinds(old, (leaf("weight", place=5, sketch=others), leaf("n", place=2))) == {("colour", "removed", None), ("weight", "added", None)}
    # of two candidates the cheaper total: each takes the one it shares values with, though the names are as like
    old = (leaf("mean_a", sketch=values), leaf("mean_b", sketch=others))
    assert kinds(old, (leaf("mean_c", sketch=others), leaf("mean_d", sketch=values))) == {("mean_c", "renamed", "mean_b"), ("mean_d", "renamed", "mean_a")}
    # two fields of the table are never one, one of them and an unknown one can be
    assert kinds((leaf("Area", "area", 1, 1, values),), (leaf("Areas", "areas", 1, 1, values),), listed=("Area", "Areas")) == {("Area", "removed", None), ("Areas", "added", None)}
    assert kinds((leaf("Area", "area", 1, 1, values),), (leaf("areas", "areas", 1, 1, values),), listed=("Area",)) == {("areas", "renamed", "Area")}


def test_assignment_against_all_matchings():
    rnd = random.Random(4)
    for _ in range(150):
        n, m = rnd.randint(0, 4), rnd.randint(0, 4)
        costs = [[rnd.choice([rnd.uniform(0, 3), float("inf")]) for _ in range(m)] for _ in range(n)]
        total = lambda pairs: sum(costs[i][j] for i, j in pairs) + 2.0 * (n - len(pairs))
        best = min(total([(i, j) for i, j in enumerate(p) if j < m]) for p in itertools.permutations(range(m + n), n)) if n else 0.0
        assert total(drift.assignment(costs)) == pytest.approx(best)


def test_known_pairs_against_set_comparison():
    rnd = random.Random(2)
    for _ in range(200):
        made = [tuple(leaf(f"f{i}", rnd.choice(["p", "q"]) + str(i), rnd.randint(0, 3), rnd.randint(0, 9)) for i in sorted(rnd.sample(range(9), rnd.randint(0, 8)))) for _ in range(2)]
        a, b = ({f.field: f for f in side} for side in made)
        wanted = {(f, "removed", None) for f in a.keys() - b.keys()} | {(f, "added", None) for f in b.keys() - a.keys()}
        for f in a.keys() & b.keys():
            wanted |= {(f, "renamed", None)} if a[f].names != b[f].names else set()
            wanted |= {(f, "retyped", None)} if a[f].rank != b[f].rank and a[f].rank and b[f].rank else set()
        assert kinds(*made, listed=[f"f{i}" for i in range(9)]) == wanted


def test_composed_scripts_feed_the_table(spark):
    files = [
        ("s", "a", "csv", 1, ["fov,colour,Area", "1,red,2.5", "2,blue,3.5"]),
        ("s", "b", "csv", 2, ["fov,color,Area", "3,red,4.5", "4,blue,2.5"]),
        ("s", "c", "jsonl", 3, ['{"fov": 5, "colors": "red", "areas": 2.5}', '{"fov": 6, "colors": "blue", "areas": 4.5}']),
        ("s", "d", "jsonl", 4, ['{"fov": 7, "pos": {"colors": "red"}, "areas": 1.5}']),
        ("t", "e", "csv", 1, ["fov,color", "8,green"]),
    ]
    assert rows(scripts(spark, files), "file_name", "field_name", "change_kind", "old_field") == {
        ("b", "color", "renamed", "colour"), ("c", "colors", "renamed", "color"), ("c", "areas", "renamed", "Area"), ("d", "pos/colors", "moved", "colors"),
    }
    assert changes(spark, files) == {
        ("b", "color", "added"), ("b", "colour", "removed"), ("c", "colors", "added"), ("c", "color", "removed"), ("c", "areas", "added"), ("c", "Area", "removed"),
        ("d", "pos/colors", "added"), ("d", "colors", "removed"),
    }
    assert {(r.fov, r.Area, tuple(r.others.items())) for r in unified(spark, files, ["fov", "Area"]).collect()} == {
        (1, 2.5, (("colour", "red"),)), (2, 3.5, (("colour", "blue"),)), (3, 4.5, (("colour", "red"),)), (4, 2.5, (("colour", "blue"),)),
        (5, 2.5, (("colour", "red"),)), (6, 4.5, (("colour", "blue"),)), (7, 1.5, (("colour", "red"),)), (8, None, (("color", "green"),)),
    }


def test_lines_that_come_several_times(spark):
    one = (1, "s", "a", "csv", None, 2, "1,x", "x", 0)
    lines = [one, one, (2, *one[1:]), (3, *one[1:6], "2,y", "x", 0), (4, *one[1:6], "", "x", 0), (5, *one[1:5], 1, "fov,n", "x", 0), (0, *one[1:5], None, "3,z", "x", 0)]
    assert sorted((r.record_id, r.line_no) for r in drift.distinct_lines(spark.createDataFrame(lines, RAW)).collect()) == [(0, None), (1, 2), (5, 1)]


def stated_changes(records, names):
    """The changes between neighbouring files as the problem states them, file by file in plain Python."""
    known = {n.strip().lower(): f for f, n in names}
    files = {}
    for stream, name, kind, at, line_no, line in records:
        files.setdefault((stream, at, name, kind), {})[line_no] = line
    clean = lambda n: n.strip("﻿ \"'\t").lower()

    def kind_of(values):
        values = [v.strip().strip('"').strip() for v in values if v is not None]
        values = [v for v in values if v.lower() not in ("", "na", "n/a", "null", "nan")]
        whole = [re.fullmatch(r"[+-]?\d+", v) for v in values]
        number = [w or re.fullmatch(r"[+-]?(\d+\.\d*|\.?\d+)([eE][+-]?\d+)?", v) for w, v in zip(whole, values, strict=True)]
        return None if not values else "integer" if all(whole) else "decimal" if all(number) else "text"

    def fields(kind, lines):
        kept = [line for _, line in sorted(lines.items()) if line and line.strip("﻿ \r\n") and not line.strip("﻿ ").startswith("#")]
        columns = {}
        if kind == "jsonl":
            for line in kept:
                for k, v in json.loads(line.strip("﻿"), parse_float=str, parse_int=str).items():
                    columns.setdefault(clean(k), []).append(v)
        elif kept:
            mark = max(",;|\t", key=lambda c: re.sub(r'"[^"]*"', "", kept[0]).count(c))
            head, *body = csv.reader([line.strip("﻿\r\n") for line in kept], delimiter=mark, skipinitialspace=True)
            for i, n in enumerate(head):
                columns[clean(n)] = [row[i] if i < len(row) else None for row in body]
        found = {}
        for n, values in columns.items():
            at = found.setdefault(known.get(n, n), [set(), []])
            at[0].add(n)
            at[1].extend(values)
        return {f: (ns, kind_of(vs)) for f, (ns, vs) in found.items()}

    out, before = set(), {}
    for (stream, _, name, kind), lines in sorted(files.items(), key=lambda f: f[0][:3]):
        now = fields(kind, lines)
        if stream in before:
            then = before[stream]
            out |= {(name, f, "added") for f in now.keys() - then.keys()} | {(name, f, "removed") for f in then.keys() - now.keys()}
            for f in now.keys() & then.keys():
                out |= {(name, f, "renamed")} if not now[f][0] & then[f][0] else set()
                out |= {(name, f, "retyped")} if now[f][1] and then[f][1] and now[f][1] != then[f][1] else set()
        before[stream] = now
    return out


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_found_against_the_statement(spark, scale):
    data = f"/root/testdata/{scale}"
    records = duckdb.sql(f"SELECT stream_name, file_name, file_format, delivered_at, line_no, raw_line FROM '{data}/raw_records.parquet' ORDER BY record_id DESC").fetchall()
    names = duckdb.sql(f"SELECT field_name, known_name FROM '{data}/field_names.parquet'").fetchall()
    wanted = stated_changes(records, names)
    assert rows(problems.p5_found(spark, data)) == wanted and wanted
