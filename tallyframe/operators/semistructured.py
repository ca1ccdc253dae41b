"""JSON and XML text columns to rows and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import ref, resolve
from .shape import reject_duplicates


def json_schema(df: DataFrame, field: str) -> str:
    """Schema of all JSON texts of a column, found in one distributed pass."""
    row = df.agg(F.schema_of_variant_agg(F.try_parse_json(ref(resolve(df, field))))).first()
    return (row[0] or "STRUCT<>").replace("OBJECT<", "STRUCT<")


def _leaves(column: Column, data_type: T.DataType, name: str) -> list[tuple[str, Column]]:
    """Leaf columns of a struct under dotted names; arrays and maps stay as JSON text."""
    if isinstance(data_type, T.StructType):
        out = []
        for f in data_type.fields:
            out += _leaves(column.getField(f.name), f.dataType, f"{name}.{f.name}" if name else f.name)
        return out
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return [(name, F.to_json(column))]
    return [(name, column)]


def _flatten(df: DataFrame, parsed: Column, schema: T.DataType, kept: list[str]) -> DataFrame:
    leaves = _leaves(ref("__parsed"), schema, "")
    reject_duplicates([*kept, *[name for name, _ in leaves]])
    return df.withColumn("__parsed", parsed).select(*[ref(c) for c in kept], *[c.alias(n) for n, c in leaves])


def json_flatten(df: DataFrame, field: str, schema: str | None = None, keep_input: bool = False) -> DataFrame:
    """Keys of a JSON object as columns, nested ones as `a.b`; a broken text gives nulls.

    ``schema`` is a DDL struct; without it one extra pass finds it.
    """
    field = resolve(df, field)
    ddl = schema or json_schema(df, field)
    struct = T.DataType.fromDDL(ddl)
    kept = df.columns if keep_input else [c for c in df.columns if c != field]
    return _flatten(df, F.from_json(ref(field), struct), struct, kept)


def json_explode(df: DataFrame, field: str, out: str | None = None, element: str = "string", keep_input: bool = False) -> DataFrame:
    """One row per element of a JSON array; an empty or broken array drops the row."""
    field = resolve(df, field)
    out = out or field
    items = F.explode(F.from_json(ref(field), f"array<{element}>"))
    rest = [c for c in df.columns if c != out and (keep_input or c != field)]
    return df.select(*[ref(c) for c in rest], items.alias(out))


def xml_select(df: DataFrame, field: str, path: str, out: str | None = None, schema: str | None = None, keep_input: bool = False) -> DataFrame:
    """One row per element at a path such as `orders/order/name`; a wrong path gives no rows.

    Without ``schema`` the element's text; with a DDL struct of the element its XML fragment.
    """
    field = resolve(df, field)
    out = out or field
    steps = [s for s in path.split("/") if s]
    if schema is None:
        found = F.xpath(ref(field), F.lit("/" + "/".join(steps) + "/text()"))
    else:
        nested = f"{steps[-1]}: array<{schema}>"
        for step in reversed(steps[1:-1]):
            nested = f"{step}: struct<{nested}>"
        found = F.from_xml(ref(field), f"struct<{nested}>")
        for step in steps[1:]:
            found = found.getField(step)
        found = F.transform(found, lambda e: F.to_xml(e, {"rowTag": steps[-1]}))
    rest = [c for c in df.columns if c != out and (keep_input or c != field)]
    return df.select(*[ref(c) for c in rest], F.explode(found).alias(out))


def xml_schema(df: DataFrame, field: str) -> T.StructType:
    """Schema that all documents fit: one pass, in which tasks merge the elements they meet."""
    field = resolve(df, field)
    texts = df.select(ref(field)).filter(ref(field).isNotNull()).rdd.map(lambda row: row[0])
    schema = df.sparkSession.read.xml(texts, rowTag="ROW").schema
    if not schema.fields:
        raise ValueError("no document to read the schema from")
    return schema


def xml_extract(df: DataFrame, field: str, schema: str | None = None, unwrap: str | None = None, keep_input: bool = False) -> DataFrame:
    """Children of an XML document as columns; ``unwrap`` goes into that child first."""
    field = resolve(df, field)
    struct = T.DataType.fromDDL(schema) if schema else xml_schema(df, field)
    parsed = F.from_xml(ref(field), struct.simpleString())
    if unwrap:
        parsed, struct = parsed.getField(unwrap), struct[unwrap].dataType
    kept = df.columns if keep_input else [c for c in df.columns if c != field]
    return _flatten(df, parsed, struct, kept)


def xml_to_json(df: DataFrame, field: str, out: str | None = None, schema: str | None = None) -> DataFrame:
    """XML text as JSON text."""
    field = resolve(df, field)
    struct = T.DataType.fromDDL(schema) if schema else xml_schema(df, field)
    return df.withColumn(out or field, F.to_json(F.from_xml(ref(field), struct.simpleString())))


def strip_namespaces(c: Column) -> Column:
    """XML text without namespace prefixes and declarations."""
    text = F.regexp_replace(c, r"\s+xmlns(:\w+)?\s*=\s*(\"[^\"]*\"|'[^']*')", "")
    return F.regexp_replace(text, r"<(/?)[\w.-]+:", "<$1")
