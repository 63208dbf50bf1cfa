"""Deeply nested records turned into related flat tables.

``child_links`` infers the array levels of a nested column and lists every child
object with the positions it has at each level, in one scan and without a
shuffle;
``child_tables`` gives the children themselves with all their scalar fields and
the parent's surrogate key.  JSON text is first parsed to variants;
``json_levels`` finds the fields that hold arrays in one pass over all rows,
``infer_levels`` merges the schemas of all of them.

Defined results: null arrays, null elements and rows without a key's children
give no child; null elements keep their position; a lone object in place of an
array stands at position 0; text that isn't valid JSON has no children; names
of parent and child fields never clash, as a child's fields are prefixed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Follows a text within brackets: it is the second value only where the text is one whole value.
END = "\u0001end"


def json_objects(text: Column) -> Column:
    """JSON text as an array of variants; a lone object becomes an array of one.

    Null for text that isn't valid JSON as a whole (truncated text, text with
    trailing characters, empty text) and for JSON that is neither.
    """
    # the parser stops after a first value; bound to a name, it runs once a row
    parsed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f"\n,{json.dumps(END)}]")))
    return F.transform(F.array(parsed), lambda v: F.when(F.try_variant_get(v, "$[1]", "string") == END, variant_array(v, "$[0]")))[0]


def variant_array(v: Column, path: str = "$") -> Column:
    lone = F.when(is_object(v, path), F.array(F.try_variant_get(v, path, "variant")))
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), lone)


def is_object(v: Column, path: str = "$") -> Column:
    # a struct without fields: nothing below the value is read
    return F.try_variant_get(v, path, "struct<>").isNotNull()


def field_array(v: Column, path: tuple[str, ...]) -> Column:
    """The same of a field; names that can't stand in a variant's path are looked up."""
    if all(re.fullmatch(r"[^'?]+", f) for f in path):
        return variant_array(v, "$" + "".join(f"['{f}']" for f in path))
    return variant_array(reduce(lambda o, f: F.try_element_at(F.try_variant_get(o, "$", "map<string,variant>"), F.lit(f)), path, v))


def struct_levels(element: T.StructType) -> dict[tuple[str, ...], dict]:
    """The array levels below a struct, at any depth: field path -> the levels below its elements.

    Structs of one are walked through; arrays of scalars are no level.
    """
    out = {}
    for f in element.fields:
        if isinstance(f.dataType, T.StructType):
            out |= {(f.name, *path): below for path, below in struct_levels(f.dataType).items()}
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            out[(f.name,)] = struct_levels(f.dataType.elementType)
    return out


def json_levels(df: DataFrame, column: str) -> dict[tuple[str, ...], dict]:
    """The same of JSON text, from all its rows: the fields that hold an array in any of them.

    One pass: each task sends the paths it found, the driver gets each once.
    Text that isn't JSON to this reader isn't to the variants' parser either.
    """
    paths = df.select(column).where(F.col(column).isNotNull()).mapInArrow(_array_paths(), "path string").distinct().collect()
    levels: dict[tuple[str, ...], dict] = {(): {}}
    for path in sorted(tuple(json.loads(r.path)) for r in paths):
        # below a field that is never an array there are no levels
        if path[:-1] in levels:
            levels[path] = levels[path[:-1]][path[-1:]] = {}
    return levels[()]


def _array_paths() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Paths of the fields that hold arrays, as JSON; lone objects count as arrays of one."""
    # an inner function goes to the workers whole: they needn't have this package

    def paths_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[str, list] = {}  # field -> [whether it holds an array, the fields below]
        for batch in batches:
            for text in batch.column(0):
                try:
                    # bytes that aren't UTF-8 are replaced, as the variants' parser does
                    value = json.loads(str(text.as_buffer(), "utf-8", "replace"), parse_int=float)
                except (ValueError, RecursionError):
                    continue
                todo = [(root, value if isinstance(value, list) else [value])]
                while todo:
                    node, elements = todo.pop()
                    for e in elements:
                        if not isinstance(e, dict):
                            continue
                        for f, v in e.items():
                            if isinstance(v, (list, dict)):
                                seen = node.setdefault(f, [False, {}])
                                seen[0] |= (repeats := isinstance(v, list))
                                todo.append((seen[1], v if repeats else [v]))
        paths, todo = [], [((), root)]
        while todo:
            above, node = todo.pop()
            for f, (repeats, below) in node.items():
                path = (*above, f.encode(errors="replace").decode())
                paths += [json.dumps(path)] if repeats else []
                todo.append((path, below))
        yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string())})

    return paths_of


def child_links(df: DataFrame, key: str, column: str, levels: dict | None = None) -> DataFrame:
    """(row_id, label, path) of each child object of ``column`` at any depth.

    ``label`` is the dotted path of array fields from ``column`` on, ``path``
    the child's 0-based position at each level from the outermost: with the
    key it is the child's surrogate key, and without its last position its
    parent's.  Levels are inferred from the schema (of JSON text: from all
    rows) unless given.  One narrow pass: each level's arrays become
    arrays of links, which are exploded once.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        levels = json_levels(df, column) if levels is None else levels
        outer, keep, get = json_objects(F.col(column)), is_object, field_array
    else:
        levels = struct_levels(kind.elementType) if levels is None else levels
        outer, keep = F.col(column), lambda e: e.isNotNull()
        get = lambda e, path: reduce(lambda c, f: c[f], path, e)

    def links(label: str, array: Column, below: dict, above: list) -> Column:
        def of(e: Column, i: Column) -> Column:
            here = [*above, i.cast("int")]
            own = F.array(F.struct(F.lit(label).alias("label"), F.array(*here).alias("path")))
            inner = [links(".".join([label, *path]), get(e, path), rest, here) for path, rest in below.items()]
            return F.when(keep(e), F.concat(own, *inner) if inner else own)

        return F.flatten(F.filter(F.transform(F.coalesce(array, F.array()), of), lambda x: x.isNotNull()))

    return df.select(F.col(key).alias("row_id"), F.explode(links(column, outer, levels, [])).alias("link")).select("row_id", "link.*")


def _flat(schema: T.StructType, path: Column, prefix: str) -> tuple[list[Column], list[tuple[str, Column, T.DataType]]]:
    """Scalar columns of a struct, one-to-one structs included, and its arrays of structs."""
    scalars, arrays = [], []
    for f in schema.fields:
        col = path[f.name]
        if isinstance(f.dataType, T.StructType):
            s, a = _flat(f.dataType, col, f"{prefix}{f.name}_")
            scalars += s
            arrays += a
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            arrays.append((f"{prefix}{f.name}", col, f.dataType.elementType))
        else:
            scalars.append(col.alias(f"{prefix}{f.name}"))
    return scalars, arrays


def child_tables(df: DataFrame, key: str, column: str, name: str | None = None) -> dict[str, DataFrame]:
    """One flat table for each array level below ``column``, at any depth.

    Each has ``parent_key`` (the record's key), ``parent_path`` (positions of
    all the levels above, joined by dots: with the key it is the parent row's
    surrogate key), ``pos`` and the child's scalar fields with the prefix
    ``f_``.  Arrays of scalars stay columns.
    """
    out: dict[str, DataFrame] = {}

    def walk(rows: DataFrame, element: T.StructType, label: str) -> None:
        scalars, arrays = _flat(element, F.col("element"), "f_")
        out[label] = rows.select("parent_key", "parent_path", "pos", *scalars)
        for field, col, kind in arrays:
            path = F.when(F.col("parent_path") == "", F.col("pos").cast("string")).otherwise(F.concat_ws(".", "parent_path", "pos"))
            below = rows.select("parent_key", path.alias("parent_path"), F.posexplode(col).alias("pos", "element")).where(F.col("element").isNotNull())
            walk(below, kind, f"{label}.{field[2:]}")

    top = df.select(F.col(key).alias("parent_key"), F.lit("").alias("parent_path"), F.posexplode(F.col(column)).alias("pos", "element")).where(F.col("element").isNotNull())
    walk(top, df.schema[column].dataType.elementType, name or column)
    return out


def _array_fields(objects: DataFrame, fields: list[str]) -> set[str]:
    """Fields that hold an array of objects in any row of any file."""
    if not fields:
        return set()
    # an array whose elements are all null still counts: the field repeats
    seen = objects.agg(*[F.max(F.coalesce(F.schema_of_variant(F.try_variant_get("element", f"$['{f}']", "variant")).startswith("ARRAY<"), F.lit(False))).alias(f"c{i}") for i, f in enumerate(fields)]).first()
    return {f for i, f in enumerate(fields) if seen[i]}


def _merged(objects: DataFrame) -> tuple[dict[str, str], set[str]]:
    """The fields of all objects with their merged types, and those that repeat."""
    fields = _object_fields(objects.agg(F.schema_of_variant_agg(F.col("element"))).first()[0] or "")
    return fields, _array_fields(objects, [f for f, t in fields.items() if t.startswith(("ARRAY", "VARIANT"))])


def infer_levels(df: DataFrame, key: str, column: str) -> dict[str, DataFrame]:
    """Child tables of JSON text under the schema merged over all its rows.

    Each level's objects are aggregated into one merged schema (partial
    aggregates in the tasks, one short text to the driver); fields of one
    object are flattened, fields that repeat become the next level.  Values
    whose types differ between rows come out as their JSON text.
    """
    out: dict[str, DataFrame] = {}

    def walk(rows: DataFrame, label: str) -> None:
        fields, repeated = _merged(rows)
        cols = []
        for f, t in sorted(fields.items()):
            if f in repeated:
                continue
            inner = _object_fields(t) if t.startswith("OBJECT") else {}
            for path, kind in [(f"$['{f}']['{g}']", k) for g, k in sorted(inner.items())] or [(f"$['{f}']", t)]:
                name = "f_" + "_".join(re.findall(r"\['(.*?)'\]", path))
                ok = kind in {"BIGINT", "DOUBLE", "BOOLEAN", "STRING"} or kind.startswith("DECIMAL")
                cols.append(F.try_variant_get("element", path, kind if ok else "string").alias(name))
        out[label] = rows.select("parent_key", "parent_path", "pos", *cols)
        for f in sorted(repeated):
            path = F.when(F.col("parent_path") == "", F.col("pos").cast("string")).otherwise(F.concat_ws(".", "parent_path", "pos"))
            below = rows.select("parent_key", path.alias("parent_path"), F.posexplode(variant_array(F.col("element"), f"$['{f}']")).alias("pos", "element")).where(is_object(F.col("element")))
            walk(below, f"{label}.{f}")

    top = df.select(F.col(key).alias("parent_key"), F.lit("").alias("parent_path"), F.posexplode(json_objects(F.col(column))).alias("pos", "element")).where(is_object(F.col("element")))
    walk(top, column)
    return out


def _object_fields(schema: str) -> dict[str, str]:
    """Top-level fields of a merged ``OBJECT<name: type, ...>`` text."""
    if not schema.startswith("OBJECT<"):
        return {}
    out, depth, part, parts = {}, 0, "", []
    for ch in schema[7:-1]:
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            parts.append(part)
            part = ""
        else:
            part += ch
    for p in [*parts, part]:
        name, _, kind = p.strip().partition(": ")
        if name:
            out[name.strip("`")] = kind
    return out
