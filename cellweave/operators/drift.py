"""Schemas that drift between files: read all files of a stream into one table and report each change.

Lines arrive unordered, some twice, in several formats. Per row, a small helper splits a line into (name, value) pairs. From
these come, by map-side combined aggregation, one schema per file: its fields with their names, types, positions and a
sketch of their values, so no file is ever gathered in one task. Neighbouring files of a stream are compared by a tree edit
distance between their schemas. The costs of its edits depend on names, types, positions and shared values; a table of known
names makes renaming among them cheap but is not needed to find a rename. The edit scripts name what was added,
removed, renamed, moved or changed in type; those of a stream are composed and compiled to a projection per file.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import few
from ..functions.scratch import saved

csv.field_size_limit(2**31 - 1)  # lines of any length
DELIMITERS = ",;|\t"
TYPES = ("none", "integer", "decimal", "text")
#: Edit costs. A pair that the field table or a common name makes one field costs at most KNOWN + RETYPE + SHIFT = 0.65, one
#: told by its likeness alone at least GUESS: two such pairs, 2.7, cost more than the one and an added and a removed field,
#: 2.65, so no guess ever parts a known pair. A guess below LIKENESS costs more than ADD + REMOVE and is not made.
KNOWN, RETYPE, SHIFT, ADD, REMOVE, GUESS, LIKENESS, MOVE = 0.3, 0.25, 0.1, 1.0, 1.0, 1.35, 0.55, 0.2
#: Smallest hashes kept of a field's values, to estimate how many two fields share.
SKETCH = 4
_NO_VALUE = r"(?i)^\s*(na|n/a|null|nan)?\s*$"
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"^\s*[+-]?([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?[0-9]+[eE][+-]?[0-9]+\s*$"


def type_rank(value: Column) -> Column:
    """Position in TYPES of the narrowest type that fits one value; 0 for no value."""
    return (
        F.when(value.isNull() | value.rlike(_NO_VALUE), 0)
        .when(value.rlike(_INTEGER), 1)
        .when(value.rlike(_DECIMAL), 2)
        .otherwise(3)
    )


def plain_name(name: str) -> str:
    """A field name without byte order mark, surrounding spaces and quotes, in lower case."""
    return name.strip("\ufeff \t\r\n\"'").lower()


def delimiter_of(header: str) -> str:
    """The delimiter that occurs most in a header line outside double quotes."""
    bare = "".join(header.split('"')[::2])
    return max(DELIMITERS, key=bare.count)


def _cells(line: str, delimiter: str) -> list[str]:
    return next(csv.reader([line.replace("\0", "").replace("\r", " ").replace("\n", " ")], delimiter=delimiter, skipinitialspace=True), [])


@lru_cache(maxsize=4096)
def _header(line: str) -> tuple[str, tuple[str, ...]]:
    delimiter = delimiter_of(line)
    return delimiter, tuple(plain_name(c) for c in _cells(line.lstrip("\ufeff"), delimiter))


def _flatten(value: dict, above: str = "") -> Iterator[tuple[str, str | None]]:
    """Leaves of a JSON object; the path of a nested one is joined with '/'."""
    for name, inner in value.items():
        path = above + plain_name(str(name))
        if isinstance(inner, dict) and inner:
            yield from _flatten(inner, path + "/")
        elif inner is None or isinstance(inner, str):
            yield path, inner
        else:
            yield path, json.dumps(inner)


def _json(line: str) -> list[tuple[str, str | None]]:
    """Leaves of a JSON line, numbers in their spelling; nothing if it is no object."""
    try:
        record = json.loads(line.lstrip("\ufeff"), parse_float=str, parse_int=str)
    except ValueError:
        return []
    return list(_flatten(record)) if isinstance(record, dict) else []


def split_line(file_format: str, header: str | None, line: str) -> tuple[list[str], list[str | None]]:
    """Names and values of one line; of several columns with one name the first value that is there counts."""
    if file_format == "jsonl":
        pairs = _json(line)
    elif header is None:
        pairs = []
    else:
        delimiter, names = _header(header)
        cells = _cells(line, delimiter)
        pairs = list(zip(names, [*cells, *[None] * (len(names) - len(cells))], strict=False))
    found: dict[str, str | None] = {}
    for name, cell in pairs:
        if name and found.get(name) is None:
            found[name] = cell
    return list(found), list(found.values())


def data_lines(raw: DataFrame) -> DataFrame:
    """Lines of named files that are neither blank nor comments; a null line counts as blank."""
    bare = F.trim(F.regexp_replace(F.coalesce("raw_line", F.lit("")), "^\ufeff", ""))
    columns = ["record_id", "stream_name", "file_name", "file_format", "delivered_at", "line_no", "raw_line"]
    return raw.where(F.col("file_name").isNotNull() & (bare != "") & ~bare.startswith("#")).select(*columns)


def distinct_lines(raw: DataFrame) -> DataFrame:
    """Each line of a file once: of several deliveries that are neither blank nor comments the one with the smallest record_id.

    Only the keys of lines are shuffled to find those that come several times, and only these are grouped as a whole.
    """
    lines = data_lines(raw)
    key = ["file_name", "line_no"]
    several = saved(lines.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(*key))
    same = lambda side: [side[k].eqNullSafe(several[k]) for k in key]
    kept = F.min(F.struct("record_id", "stream_name", "file_format", "delivered_at", "raw_line"))
    once = lines.join(several, same(lines), "left_semi").groupBy(*key).agg(kept.alias("k"))
    merged = once.select("k.record_id", "k.stream_name", "file_name", "k.file_format", "k.delivered_at", "line_no", "k.raw_line")
    return lines.join(several, same(lines), "left_anti").unionByName(merged)


def stream_files(raw: DataFrame) -> DataFrame:
    """(file_name, stream_name, file_format, delivered_at, head_no, head): one row per file with a data line.

    The header of a CSV file is its first data line; of several deliveries of it that with the smallest record_id.
    """
    lines = data_lines(raw)
    head = F.min(F.when(F.coalesce("file_format", F.lit("")) != "jsonl", F.struct("line_no", "record_id", "raw_line")))
    files = lines.groupBy("file_name").agg(F.min("stream_name").alias("stream_name"), F.min("file_format").alias("file_format"), F.min("delivered_at").alias("delivered_at"), head.alias("h"))
    return files.select("file_name", "stream_name", "file_format", "delivered_at", F.col("h.line_no").alias("head_no"), F.col("h.raw_line").alias("head"))


def parsed_lines(raw: DataFrame, files: DataFrame) -> DataFrame:
    """(record_id, file_name, line_no, is_head, names, cells): names and values of the data lines; a header comes with empty cells.

    Blank lines and comments are gone, as are lines before the header; a line that comes twice is parsed twice. Lines that are no
    JSON object in a 'jsonl' file have no names. `files` as `stream_files` gives them.
    """
    lines = data_lines(raw).select("record_id", "file_name", "line_no", "raw_line")
    placed = lines.join(files.select("file_name", "file_format", "head_no", "head"), "file_name").where(F.col("head_no").isNull() | (F.col("line_no") >= F.col("head_no")))
    columns = ["record_id", "file_name", "line_no", "is_head", "names", "cells"]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [
                split_line(kind, None if head is None or head != head else head, "" if is_head else line)
                for kind, head, line, is_head in zip(batch["file_format"], batch["head"], batch["raw_line"], batch["is_head"], strict=True)
            ]
            yield batch.assign(names=[p[0] for p in pairs], cells=[p[1] for p in pairs])[columns]

    is_head = F.coalesce(F.col("line_no") == F.col("head_no"), F.lit(False))
    return placed.select("record_id", "file_name", "line_no", is_head.alias("is_head"), "file_format", "head", "raw_line").mapInPandas(
        split, "record_id bigint, file_name string, line_no int, is_head boolean, names array<string>, cells array<string>"
    )


def known_names(field_names: DataFrame) -> DataFrame:
    """(name, field): plain spelling of each known name, and its field."""
    plain = F.lower(F.trim(F.col("known_name")))
    return field_names.where(F.col("known_name").isNotNull()).groupBy(plain.alias("name")).agg(F.min("field_name").alias("field"))


def file_schemas(parsed: DataFrame, files: DataFrame, names: DataFrame) -> DataFrame:
    """(stream_name, file_name, delivered_at, fields array<struct<field, name, rank, place, sketch>>), sorted by field and name.

    One entry per name; a field that a file has under several names has several. place is a name's first position in a line, sketch
    the smallest of its values' hashes under several seeds. The array is as long as a file has names, not lines; lines that come
    twice change nothing. Files none of whose lines has a name are left out.
    """
    cells = parsed.select("file_name", F.posexplode(F.arrays_zip("names", "cells")).alias("place", "c"))
    is_value = F.col("c.cells").isNotNull() & ~F.col("c.cells").rlike(_NO_VALUE)
    least = [F.min(F.when(is_value, F.hash(F.trim("c.cells"), F.lit(i)))) for i in range(SKETCH)]
    by_name = cells.groupBy("file_name", F.col("c.names").alias("name")).agg(
        F.max(type_rank(F.col("c.cells"))).alias("rank"), F.min("place").alias("place"), *[h.alias(f"h{i}") for i, h in enumerate(least)]
    )
    sketch = F.when(F.col("h0").isNotNull(), F.array(*[f"h{i}" for i in range(SKETCH)])).otherwise(F.array().cast("array<int>"))
    entry = F.struct(F.coalesce("field", "name").alias("field"), "name", "rank", "place", sketch.alias("sketch"))
    return (
        by_name.join(names, "name", "left")
        .groupBy("file_name")
        .agg(F.sort_array(F.collect_list(entry)).alias("fields"))
        .join(files.select("file_name", "stream_name", "delivered_at"), "file_name")
        .select("stream_name", "file_name", "delivered_at", "fields")
    )


class Leaf(NamedTuple):
    """A field of a file: its name in the field table or its own, its names there, its type, first position and value sketch."""

    field: str
    names: tuple[str, ...]
    rank: int
    place: int = 0
    sketch: tuple[int, ...] = ()

    @property
    def inside(self) -> str:
        """Path of the object that holds the field."""
        return self.names[0].rpartition("/")[0]

    @property
    def last(self) -> str:
        """Name within that object."""
        return self.names[0].rpartition("/")[2]


class Edit(NamedTuple):
    """One edit: the field in the new file, or the removed one; for a pair told by likeness, or moved, its field before."""

    field: str
    kind: str
    old: str | None = None


def _retyped(a: Leaf, b: Leaf) -> bool:
    """Whether a field's type differs; without any value in a file a field has no type there."""
    return a.rank != b.rank and bool(a.rank and b.rank)


def _one_field(a: Leaf, b: Leaf) -> bool:
    return a.field == b.field or bool(set(a.names) & set(b.names))


def _renamed(a: Leaf, b: Leaf) -> bool:
    """Whether two files have no name of a field in common."""
    return not set(a.names) & set(b.names)


def likeness(a: Leaf, b: Leaf) -> float:
    """How much two fields resemble each other, from 0 to 1: half by name, four tenths by shared values, the rest by position."""
    name = max(SequenceMatcher(None, x.rpartition("/")[2], y.rpartition("/")[2], autojunk=False).ratio() for x in a.names for y in b.names)
    values = sum(x == y for x, y in zip(a.sketch, b.sketch, strict=False)) / SKETCH
    return 0.5 * name + 0.4 * values + 0.1 / (1 + abs(a.place - b.place))


def _leaf_cost(a: Leaf, b: Leaf, listed: frozenset[str]) -> float:
    """Cost of taking a for b. Two different fields of the field table are never one."""
    retype = RETYPE * _retyped(a, b)
    if _one_field(a, b):
        return KNOWN * _renamed(a, b) + retype + SHIFT * min(1.0, abs(a.place - b.place) / 100)
    if a.field in listed and b.field in listed:
        return float("inf")
    return GUESS + (ADD + REMOVE - GUESS) * (1 - likeness(a, b)) / (1 - LIKENESS) + retype


def assignment(costs: list[list[float]]) -> list[tuple[int, int]]:
    """Pairs (row, column) of a cheapest partial matching: an entry is used where it is below ADD + REMOVE in the best total.

    Successive shortest paths on the matrix with a spare column per row (Kuhn and Munkres).
    """
    n, m = len(costs), len(costs[0]) if costs else 0
    if not n or not m:
        return []
    wide = m + n
    cost = lambda i, j: min(costs[i][j], 1e9) if j < m else (ADD + REMOVE if j == m + i else 1e9)
    u, v, match = [0.0] * (n + 1), [0.0] * (wide + 1), [0] * (wide + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = [float("inf")] * (wide + 1), [0] * (wide + 1), [False] * (wide + 1)
        while match[j0]:
            used[j0] = True
            i0, delta, j1 = match[j0], float("inf"), 0
            for j in range(1, wide + 1):
                if not used[j]:
                    reduced = cost(i0 - 1, j - 1) - u[i0] - v[j]
                    if reduced < least[j]:
                        least[j], way[j] = reduced, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(wide + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    return [(match[j] - 1, j - 1) for j in range(1, m + 1) if match[j]]


class _Tree:
    """An object of a schema: its own fields and the objects in it."""

    def __init__(self, leaves: list[Leaf], depth: int = 0):
        inner: dict[str, list[Leaf]] = {}
        self.leaves: list[Leaf] = []
        for leaf in leaves:
            *above, _ = leaf.names[0].split("/")
            if len(above) > depth:
                inner.setdefault(above[depth], []).append(leaf)
            else:
                self.leaves.append(leaf)
        self.objects = {name: _Tree(held, depth + 1) for name, held in sorted(inner.items())}
        self.size = len(self.leaves) + sum(1 + o.size for o in self.objects.values())


def _distance(a: _Tree, b: _Tree, listed: frozenset[str], done: dict[tuple[int, int], tuple]) -> tuple[float, list[tuple[Leaf, Leaf]]]:
    """Cost and matched fields of the cheapest edit script between two trees whose children have no order.

    Children are matched with children by a cheapest assignment, objects at the distance of their contents, and what is left
    is removed or added; or one tree as a whole is matched with an object inside the other, the rest being added or removed
    around it. These are the mappings of Zhang's constrained edit distance, which keep separate subtrees separate.
    """
    key = (id(a), id(b))
    if key in done:
        return done[key]
    left, right, pairs, cost = list(a.leaves), list(b.leaves), [], 0.0
    named = {}
    for leaf in right:
        for name in {leaf.field, *leaf.names}:
            named.setdefault(name, leaf)
    for leaf in a.leaves:  # one field in both objects is always matched: see the costs
        other = next((named[n] for n in (leaf.field, *leaf.names) if n in named and named[n] in right), None)
        if other is not None:
            left.remove(leaf)
            right.remove(other)
            pairs.append((leaf, other))
            cost += _leaf_cost(leaf, other, listed)
    guesses = assignment([[_leaf_cost(x, y, listed) for y in right] for x in left])
    pairs += [(left[i], right[j]) for i, j in guesses]
    cost += sum(_leaf_cost(left[i], right[j], listed) for i, j in guesses) + REMOVE * (len(left) - len(guesses)) + ADD * (len(right) - len(guesses))
    before, after = list(a.objects.items()), list(b.objects.items())
    inner = [[_distance(x, y, listed, done) for _, y in after] for _, x in before]
    gain = lambda i, j: inner[i][j][0] + (KNOWN if before[i][0] != after[j][0] else 0.0)
    apart = lambda i, j: REMOVE * (1 + before[i][1].size) + ADD * (1 + after[j][1].size)
    # the assignment weighs entries against ADD + REMOVE, so a pair of objects enters with what it saves
    chosen = assignment([[ADD + REMOVE + gain(i, j) - apart(i, j) for j in range(len(after))] for i in range(len(before))])
    kept, met = {i for i, _ in chosen}, {j for _, j in chosen}
    cost += sum(gain(i, j) for i, j in chosen)
    cost += sum(REMOVE * (1 + x.size) for i, (_, x) in enumerate(before) if i not in kept) + sum(ADD * (1 + y.size) for j, (_, y) in enumerate(after) if j not in met)
    best = (cost, pairs + [p for i, j in chosen for p in inner[i][j][1]])
    for _, y in after:
        deeper = _distance(a, y, listed, done)
        best = min(best, (deeper[0] + ADD * (b.size - y.size), deeper[1]), key=lambda c: c[0])
    for _, x in before:
        deeper = _distance(x, b, listed, done)
        best = min(best, (deeper[0] + REMOVE * (a.size - x.size), deeper[1]), key=lambda c: c[0])
    done[key] = best
    return best


@lru_cache(maxsize=4096)
def edit_script(old: tuple[Leaf, ...], new: tuple[Leaf, ...], listed: frozenset[str] = frozenset()) -> tuple[Edit, ...]:
    """Cheapest edits from one schema to the next, by tree edit distance with moves; `listed` are the fields of the field table.

    What the distance between the trees leaves removed and added is matched once more over all objects: a pair that is cheaper
    moved than removed and added is 'moved'. A field is moved whenever the object that holds it has another path.
    """
    _, pairs = _distance(_Tree(list(old)), _Tree(list(new)), listed, {})
    gone = [a for a in old if all(a is not p[0] for p in pairs)]
    came = [b for b in new if all(b is not p[1] for p in pairs)]

    def elsewhere(a: Leaf, b: Leaf) -> float:
        if a.field in listed and b.field in listed and a.field != b.field:
            return float("inf")
        if _one_field(a, b) or a.last == b.last:
            return MOVE + KNOWN * (a.last != b.last) + RETYPE * _retyped(a, b) + (1 - likeness(a, b)) / 10
        return MOVE + _leaf_cost(a, b, listed)

    moves = assignment([[elsewhere(a, b) for b in came] for a in gone])
    pairs = pairs + [(gone[i], came[j]) for i, j in moves]
    edits = [Edit(gone[i].field, "removed") for i in range(len(gone)) if i not in {m[0] for m in moves}]
    edits += [Edit(came[j].field, "added") for j in range(len(came)) if j not in {m[1] for m in moves}]
    for a, b in pairs:
        before = None if a.field == b.field else a.field
        if a.inside != b.inside:
            edits.append(Edit(b.field, "moved", a.field))
        if _renamed(a, b) and a.last != b.last:
            edits.append(Edit(b.field, "renamed", before))
        if _retyped(a, b):
            edits.append(Edit(b.field, "retyped", before))
    return tuple(sorted(edits, key=lambda e: (e.field, e.kind, e.old or "")))


def _in_order(schemas: DataFrame) -> DataFrame:
    """schemas with step, the number of a file in its stream (by delivered_at, then name), and the file before."""
    order = Window.partitionBy("stream_name").orderBy("delivered_at", "file_name")
    steps = schemas.select("stream_name", "file_name", F.row_number().over(order).alias("step"), F.lag("file_name").over(order).alias("before"))
    return schemas.drop("delivered_at").join(steps.drop("stream_name"), "file_name")


def schema_changes(schemas: DataFrame, names: DataFrame) -> DataFrame:
    """(stream_name, file_name, step, field_name, change_kind, old_field): edits from the file before in the stream.

    schemas: as `file_schemas` gives them, best a saved table, since they are used three times; names: the field table. Files follow each
    other by delivered_at, then by name. First files have no edits; a file without a header or a record is no file here, and
    the one after it is compared with the one before it. An empty table gives none. Extra columns are ignored. old_field is
    the field before of one that moved, or that is taken for another by its likeness alone; else null. The order is found on
    rows of names and times only.
    """
    ordered = _in_order(schemas)
    pairs = ordered.where(F.col("before").isNotNull()).join(schemas.select(F.col("file_name").alias("before"), F.col("fields").alias("then")), "before")
    listed = frozenset(r[0] for r in few(names.select("field").distinct()))

    def leaves(fields) -> tuple[Leaf, ...]:
        made = []
        for field, group in groupby(fields, key=lambda f: f["field"]):
            held = list(group)  # the names of one field; its sketch is that of all their values
            sketches = [f["sketch"] for f in held if len(f["sketch"])]
            least = tuple(min(int(s[i]) for s in sketches) for i in range(SKETCH)) if sketches else ()
            made.append(Leaf(field, tuple(f["name"] for f in held), max(int(f["rank"]) for f in held), min(int(f["place"]) for f in held), least))
        return tuple(made)

    def scripts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (stream, file, step, *edit)
                for stream, file, step, then, now in zip(batch["stream_name"], batch["file_name"], batch["step"], batch["then"], batch["fields"], strict=True)
                for edit in edit_script(leaves(then), leaves(now), listed)
            ]
            yield pd.DataFrame(rows, columns=["stream_name", "file_name", "step", "field_name", "change_kind", "old_field"])

    return pairs.select("stream_name", "file_name", "step", "then", "fields").mapInPandas(
        scripts, "stream_name string, file_name string, step int, field_name string, change_kind string, old_field string"
    )


def listed_changes(changes: DataFrame) -> DataFrame:
    """(stream_name, file_name, field_name, change_kind) in terms of the field table alone, distinct.

    A field that only its likeness or its move ties to another field is one removed and one added; a known field that moved
    has another name.
    """
    kind, old = F.col("change_kind"), F.col("old_field")
    other = old.isNotNull() & (old != F.col("field_name"))
    as_is = F.struct("field_name", F.when(kind == "moved", "renamed").otherwise(kind).alias("change_kind"))
    apart = F.array(F.struct("field_name", F.lit("added").alias("change_kind")), F.struct(old.alias("field_name"), F.lit("removed").alias("change_kind")))
    return changes.select("stream_name", "file_name", F.inline(F.when(other, apart).otherwise(F.array(as_is)))).distinct()


def composed_fields(schemas: DataFrame, changes: DataFrame) -> DataFrame:
    """(stream_name, file_name, fields array<struct<field, names, rank>>): the schemas with each field under its first name in the stream.

    The scripts of a stream are composed: a field that was renamed or moved from another one goes by what that one goes by,
    however often this happened. Chains are followed by doubling, a join a round, so a stream of n files needs log n rounds.
    """
    events = saved(
        changes.where(F.col("old_field").isNotNull() & (F.col("old_field") != F.col("field_name")))
        .groupBy("stream_name", "step", F.col("field_name").alias("new"))
        .agg(F.min("old_field").alias("old"))
    )
    fields = _in_order(schemas).select("stream_name", "file_name", "step", F.explode("fields").alias("f"))
    made = F.struct("step", "new")  # a rename is known by the step and the field it made
    uses = events.select("stream_name", F.col("old").alias("name"), F.col("step"), F.lit(0).alias("makes"), made.alias("id"), F.col("old").alias("root"))
    makes = events.select("stream_name", F.col("new").alias("name"), F.col("step"), F.lit(1).alias("makes"), made.alias("id"), F.lit(None).cast("string").alias("root"))
    upto = Window.partitionBy("stream_name", "name").orderBy("step", "makes").rowsBetween(Window.unboundedPreceding, -1)
    links = uses.unionByName(makes).withColumn("up", F.last(F.when(F.col("makes") == 1, F.col("id")), ignorenulls=True).over(upto)).where("makes = 0")
    links = saved(links.select("stream_name", "id", "root", "up"))
    while not links.where(F.col("up").isNotNull()).isEmpty():
        above = links.select("stream_name", F.col("id").alias("up"), F.col("root").alias("root_up"), F.col("up").alias("up_up"))
        links = saved(links.join(above, ["stream_name", "up"], "left").select("stream_name", "id", F.coalesce("root_up", "root").alias("root"), F.col("up_up").alias("up")))
    roots = links.select("stream_name", F.col("id.step").alias("step"), F.col("id.new").alias("name"), "root", F.lit(0).alias("held"))
    held = fields.select("stream_name", "step", F.col("f.field").alias("name"), F.lit(None).cast("string").alias("root"), F.lit(1).alias("held"), "file_name", "f")
    since = Window.partitionBy("stream_name", "name").orderBy("step", "held").rowsBetween(Window.unboundedPreceding, 0)
    named = held.unionByName(roots, allowMissingColumns=True).withColumn("root", F.last("root", ignorenulls=True).over(since)).where("held = 1")
    return (
        named.groupBy("stream_name", "file_name", F.coalesce("root", "name").alias("field"))
        .agg(F.array_sort(F.collect_set("f.name")).alias("names"), F.max("f.rank").alias("rank"))
        .groupBy("stream_name", "file_name")
        .agg(F.sort_array(F.collect_list(F.struct("field", "names", "rank"))).alias("fields"))
    )


def unified_records(parsed: DataFrame, composed: DataFrame, targets: list[str]) -> DataFrame:
    """All records of all files as one table: a column per target field, other fields in the map `others`.

    A file's projection, which of its names feed which field, is compiled from the composed scripts of its stream
    (`composed_fields`), joined by file, and applied to each record. A record with values under several names of a field counts with the first of these names
    by code point; the values under the others are in `others`, under their names. A target column is bigint, double or
    string: the narrowest type that fits every file. Missing and unknown values are null. `targets` are the field names
    of the field table.
    """
    widest = dict(
        composed.select(F.explode("fields").alias("f"))
        .where(F.col("f.field").isin(targets))
        .groupBy("f.field")
        .agg(F.max("f.rank"))
        .collect()
    )  # a row per target field
    valued = F.filter(F.arrays_zip("names", "cells"), lambda c: c["cells"].isNotNull() & ~c["cells"].rlike(_NO_VALUE))
    held = parsed.where(~F.col("is_head") & (F.size("names") > 0)).select("record_id", "file_name", "line_no", F.map_from_entries(valued).alias("held"))
    feeding = lambda names: F.filter(names, lambda n: F.map_contains_key("held", n))
    feeds = F.filter(F.transform("fields", lambda f: F.struct(f["field"].alias("field"), feeding(f["names"]).alias("names"))), lambda f: F.size(f["names"]) > 0)
    records = held.join(composed.select("stream_name", "file_name", "fields"), "file_name").withColumn("feeds", feeds)
    first = F.transform("feeds", lambda f: F.struct(f["field"], F.try_element_at("held", f["names"][0])))
    surplus = F.flatten(F.transform("feeds", lambda f: F.slice(f["names"], 2, F.size(f["names"]))))
    records = records.withColumns({"byfield": F.map_from_entries(first), "surplus": surplus})
    cast = {1: "bigint", 2: "double"}
    made = []
    for field in targets:
        raw = F.trim(F.try_element_at("byfield", F.lit(field)))
        made.append((raw.try_cast(cast[widest[field]]) if widest.get(field) in cast else raw).alias(field.replace(".", "_")))
    unknown = F.map_filter("byfield", lambda k, v: ~k.isin(targets))
    others = F.when(F.size("surplus") == 0, unknown).otherwise(
        F.map_concat(unknown, F.map_filter("held", lambda k, v: F.array_contains("surplus", k) & ~F.map_contains_key(unknown, k)))
    )
    return records.select("record_id", "stream_name", "file_name", "line_no", *made, others.alias("others"))
