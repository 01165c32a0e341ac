"""Schema-driven projections: flattening, tagging, JSON encoding and JSON typing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# json text keeps null fields, so that decoding gives the record back
_KEEP_NULLS = {"ignoreNullFields": "false"}


def quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs become columns named by their path; arrays and maps are left alone.

    A projection only: parquet still reads just the leaves a later select keeps.
    Two paths that give one name raise, since one of them would be lost.
    """
    paths = list(_leaves(df.schema))
    names = [sep.join(p) for p in paths]
    seen: dict[str, str] = {}
    for name, path in zip(names, paths):
        other = seen.setdefault(name.lower(), ".".join(path))
        if other != ".".join(path):
            raise ValueError(f"{other} and {'.'.join(path)} both flatten to {name}")
    return df.select([F.col(quoted(*p)).alias(n) for p, n in zip(paths, names)])


def tag(df: DataFrame, **values: object) -> DataFrame:
    """Set constant columns, replacing columns of that name (in any case)."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()})


def _complex(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def encode_complex(df: DataFrame) -> DataFrame:
    """Array, map and struct columns become JSON text; NULL stays NULL."""
    return df.select([
        F.to_json(F.col(quoted(f.name)), _KEEP_NULLS).alias(f.name) if _complex(f.dataType) else F.col(quoted(f.name))
        for f in df.schema.fields
    ])


def _strict(field: T.StructField) -> Column:
    col, kind = F.col(quoted(field.name)), field.dataType
    if isinstance(kind, T.ArrayType):
        floating = isinstance(kind.elementType, (T.FloatType, T.DoubleType))
        missing = (lambda x: x.isNull() | F.isnan(x)) if floating else (lambda x: x.isNull())
        # forall is true for an empty array, so it covers both cases
        return F.when(~F.forall(col, missing), F.to_json(col, _KEEP_NULLS)).alias(field.name)
    if _complex(kind):
        return F.to_json(col, _KEEP_NULLS).alias(field.name)
    if isinstance(kind, (T.DateType, T.DecimalType)):
        return col.cast("string").alias(field.name)
    return col


def encode_strict(df: DataFrame) -> DataFrame:
    """As encode_complex, but arrays that are empty or hold only nulls become NULL and object scalars text."""
    return df.select([_strict(f) for f in df.schema.fields])


def json_columns(df: DataFrame) -> list[str]:
    """String columns whose first non-null value opens a JSON object or array.

    One `limit(1)` read per column: Spark stops after the first partition that has
    a value, where an aggregate would scan the whole table to see one row.
    """
    found = []
    for field in df.schema.fields:
        if not isinstance(field.dataType, T.StringType):
            continue
        col = F.col(quoted(field.name))
        first = df.where(col.isNotNull()).select(col.alias("v")).limit(1).collect()
        if first and first[0].v.startswith(("{", "[")):
            found.append(field.name)
    return found


def promote_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """JSON text columns become VARIANT. Text that does not parse is kept as a variant string."""
    names = json_columns(df) if columns is None else columns
    return df.withColumns({
        n: F.coalesce(F.try_parse_json(F.col(quoted(n))), F.col(quoted(n)).cast("variant")) for n in names
    })
