"""The six logical column types and their null-on-failure casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOGICAL_TYPES = {
    "string": "string",
    "integer": "bigint",
    "number": "double",
    "date": "date",
    "datetime": "timestamp",
    "boolean": "boolean",
}

MONEY = "decimal(38,6)"


# Fixed value: how a number is written.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number_text(column: Column) -> Column:
    """Double of a text that is a number as a whole; '12d', 'NaN' and the like are none."""
    text = column.cast("string")
    return F.when(F.regexp_like(text, F.lit(NUMBER)), text.try_cast("double"))


def spark_type(logical: str) -> str:
    if logical == "money":
        return MONEY
    if logical not in LOGICAL_TYPES:
        raise ValueError(f"unknown column type {logical!r}")
    return LOGICAL_TYPES[logical]


def cast_to(column: Column, logical: str) -> Column:
    """Cast to a logical type; a value that does not convert becomes null."""
    if logical == "integer":
        # text such as '12.7' is no bigint: go through decimal, which truncates
        return F.coalesce(column.try_cast("bigint"), column.try_cast(MONEY).try_cast("bigint"))
    if logical == "number":
        # the test is folded away for columns that aren't text
        return F.when(F.typeof(column) == "string", number_text(column)).otherwise(column.try_cast("double"))
    return column.try_cast(spark_type(logical))


def logical_type(data_type: T.DataType) -> str:
    """Logical type of a Spark column; nested types have none of the six."""
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, T.NumericType):
        return "number"
    if isinstance(data_type, T.DateType):
        return "date"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    return data_type.simpleString()


def column_type(df: DataFrame, name: str) -> str:
    return logical_type(df.schema[resolve(df, name)].dataType)


def resolve(df: DataFrame, name: str) -> str:
    """Exact spelling of a column looked up without regard to case."""
    for existing in df.columns:
        if existing == name:
            return existing
    hits = [existing for existing in df.columns if existing.lower() == name.lower()]
    if len(hits) != 1:
        raise ValueError(f"column {name!r} not found in {df.columns}")
    return hits[0]


def ref(name: str) -> Column:
    """Column by its literal name, also with spaces, dots or parentheses."""
    return F.col("`" + name.replace("`", "``") + "`")


def convert(df: DataFrame, name: str, logical: str) -> Column:
    """A column of ``df`` in a logical type; one that has it already stays plain, so that filters
    and joins on it still reach the source."""
    data_type = df.schema[name].dataType
    if logical == "integer" and isinstance(data_type, T.IntegralType):
        return ref(name).cast("bigint")
    if logical == "string" and isinstance(data_type, T.StringType):
        return ref(name)
    return cast_to(ref(name), logical)


def orderable(df: DataFrame, name: str) -> bool:
    """False for columns Spark cannot compare (maps, variants)."""

    def comparable(data_type: T.DataType) -> bool:
        if isinstance(data_type, T.ArrayType):
            return comparable(data_type.elementType)
        if isinstance(data_type, T.StructType):
            return all(comparable(f.dataType) for f in data_type.fields)
        return not isinstance(data_type, (T.MapType, T.VariantType))

    return comparable(df.schema[name].dataType)
