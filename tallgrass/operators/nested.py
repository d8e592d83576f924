"""Nested records to flat tables named by dotted path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _array_paths(schema: T.DataType, path: tuple) -> list[tuple]:
    """Paths of the arrays that can be measured without entering another array."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in _array_paths(f.dataType, (*path, f.name))]
    return [path] if isinstance(schema, T.ArrayType) else []


def _at(path: tuple) -> Column:
    column = F.col(_quoted(path[0]))
    for step in path[1:]:
        column = F.get(column, F.lit(step)) if isinstance(step, int) else column.getField(step)
    return column


def _type_at(schema: T.DataType, path: tuple) -> T.DataType:
    for step in path:
        schema = schema.elementType if isinstance(step, int) else schema[step].dataType
    return schema


def leaf_paths(df: DataFrame) -> list[tuple]:
    """Paths of all leaves; list positions count up to the longest list seen in the data.

    Each level of nested lists takes one aggregate over the records, and only the lengths
    come back to the driver.
    """
    lengths: dict[tuple, int] = {}

    def unmeasured(schema: T.DataType, path: tuple) -> list[tuple]:
        found = []
        for p in _array_paths(schema, path):
            if p not in lengths:
                found.append(p)
                continue
            element = _type_at(df.schema, p).elementType
            for i in range(lengths[p]):
                found.extend(unmeasured(element, (*p, i)))
        return found

    todo = unmeasured(df.schema, ())
    while todo:
        sizes = df.agg(*[F.coalesce(F.max(F.size(_at(p))), F.lit(0)).alias(f"s{i}") for i, p in enumerate(todo)]).first()
        lengths.update({p: max(0, sizes[i]) for i, p in enumerate(todo)})
        todo = unmeasured(df.schema, ())

    def leaves(schema: T.DataType, path: tuple) -> list[tuple]:
        if isinstance(schema, T.StructType):
            return [p for f in schema.fields for p in leaves(f.dataType, (*path, f.name))]
        if isinstance(schema, T.ArrayType):
            return [p for i in range(lengths[path]) for p in leaves(schema.elementType, (*path, i))]
        return [path]

    return leaves(df.schema, ())


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """One column per leaf, named by its path, list positions included.

    Every record gets all columns, in name order: the union of the keys of all records.
    Empty containers leave no column.  Two leaves that would get one name are an error: neither
    may hide the other.
    """
    named: dict[str, tuple] = {}
    for path in leaf_paths(df):
        name = separator.join(str(step) for step in path)
        if name in named:
            raise ValueError(f"{named[name]} and {path} would both be named {name!r}; choose another separator")
        named[name] = path
    return df.select(*[_at(named[name]).alias(name) for name in sorted(named)])


def fill_missing(df: DataFrame) -> DataFrame:
    """All columns as text, an empty text where a record lacks the key."""
    return df.select(*[F.coalesce(F.col(_quoted(c)).cast("string"), F.lit("")).alias(c) for c in df.columns])


_LEAVES = "array<struct<path: string, value: string>>"


def _leaves(column: Column, kind: T.DataType, separator: str) -> Column:
    """All leaves below a value as one array of (path, value); built from the schema alone."""

    def below(name: Column, leaves: Column) -> Column:
        # a leaf itself has no path yet
        return F.transform(leaves, lambda leaf: F.struct(
            F.concat(name, F.when(leaf["path"] == "", F.lit("")).otherwise(F.concat(F.lit(separator), leaf["path"]))).alias("path"),
            leaf["value"].alias("value"),
        ))

    none = F.array().cast(_LEAVES)
    if isinstance(kind, T.StructType):
        parts = [below(F.lit(f.name), _leaves(column.getField(f.name), f.dataType, separator)) for f in kind.fields]
        return F.concat(*parts) if parts else none
    if isinstance(kind, T.ArrayType):
        each = F.transform(column, lambda x, i: below(i.cast("string"), _leaves(x, kind.elementType, separator)))
        return F.coalesce(F.flatten(each), none)
    if isinstance(kind, T.MapType):
        each = F.transform(F.map_entries(column), lambda e: below(e["key"].cast("string"), _leaves(e["value"], kind.valueType, separator)))
        return F.coalesce(F.flatten(each), none)
    text = column.cast("string")
    return F.when(text.isNotNull(), F.array(F.struct(F.lit("").alias("path"), text.alias("value")))).otherwise(none)


def to_paths(df: DataFrame, record: str, separator: str = ".") -> DataFrame:
    """One row per record and leaf that has a value: (record, path, value as text).

    List positions and map keys are parts of the path.  The leaves of a row are gathered by one
    expression that follows the schema, so the plan does not grow with the lists in the data, and
    nothing about the data is asked first.  Empty containers and NULL leave no row.
    """
    others = [f for f in df.schema.fields if f.name != record]
    whole = F.struct(*[F.col(_quoted(f.name)).alias(f.name) for f in others])
    leaves = _leaves(whole, T.StructType(others), separator)
    return df.select(F.col(_quoted(record)).alias("record"), F.explode(leaves).alias("_leaf")).select("record", "_leaf.path", "_leaf.value")
