"""Row-wise operators: record binding, casts, banding, conditional rates, row rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

# Lower bounds of the delay bands (exclusive), the label of zero, and of the rest.
DELAY_BANDS = (
    (100, "Very Long Delay"),
    (50, "Long Delay"),
    (10, "Medium Delay"),
    (0, "Tolerable Delay"),
)
NO_DELAY = "No Delay"
EARLY = "Early"

# Usage above the limit is charged at the lower rate.
USAGE_LIMIT = 750
RATE_ABOVE = 0.15
RATE_BELOW = 0.50


def conform(df: DataFrame, schema: StructType, dirty: str = "raise") -> DataFrame:
    """Bind rows to a record type by name: its columns, in its order, with its types. Fields of
    structs, also of those in arrays and maps, are bound by name in the same way.

    A missing column or field is an error, and so is a struct where none is expected or the other way
    round. A value that does not cast is an error too, or NULL with ``dirty="null"``. A NULL struct,
    array or map stays NULL.
    """
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the record type: {missing}")
    return df.select(
        [
            bound(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType, f.name, dirty).alias(f.name)
            for f in schema.fields
        ]
    )


def bound(column: Column, have: DataType, want: DataType, path: str, dirty: str = "raise") -> Column:
    """A column of type ``have`` as ``want``, fields of structs matched by name."""
    if not _holds_struct(have) and not _holds_struct(want):
        return _cast(column, want, dirty)
    if type(have) is not type(want):
        raise ValueError(f"{path} is {have.simpleString()}, the record type has {want.simpleString()}")
    if isinstance(want, ArrayType):
        return F.transform(
            column, lambda x: bound(x, have.elementType, want.elementType, f"{path}[]", dirty)
        )
    if isinstance(want, MapType):
        pairs = F.transform(
            F.map_entries(column),
            lambda x: F.struct(
                bound(x["key"], have.keyType, want.keyType, f"{path}.key", dirty),
                bound(x["value"], have.valueType, want.valueType, f"{path}.value", dirty),
            ),
        )
        return F.map_from_entries(pairs)
    missing = [name for name in want.fieldNames() if name not in have.fieldNames()]
    if missing:
        raise ValueError(f"fields of {path} missing for the record type: {missing}")
    fields = [
        bound(column.getField(f.name), have[f.name].dataType, f.dataType, f"{path}.{f.name}", dirty).alias(f.name)
        for f in want.fields
    ]
    return F.when(column.isNotNull(), F.struct(*fields))


def _holds_struct(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _holds_struct(kind.elementType)
    if isinstance(kind, MapType):
        return _holds_struct(kind.keyType) or _holds_struct(kind.valueType)
    return isinstance(kind, StructType)


def recast(df: DataFrame, types: Mapping[str, str], dirty: str = "raise") -> DataFrame:
    """Replace columns by their casts."""
    return df.withColumns({name: _cast(F.col(name), kind, dirty) for name, kind in types.items()})


def delay_band(delay: Column) -> Column:
    """Label of a delay. A NULL delay meets no branch and so counts as the rest."""
    bounds = list(DELAY_BANDS)
    label = F.when(delay > bounds[0][0], bounds[0][1])
    for bound, name in bounds[1:]:
        label = label.when(delay > bound, name)
    return label.when(delay == 0, NO_DELAY).otherwise(EARLY)


def usage_cost(usage: Column) -> Column:
    return F.when(usage > USAGE_LIMIT, usage * RATE_ABOVE).otherwise(usage * RATE_BELOW)


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def flag_valid(df: DataFrame, rule: Column, flag: str = "is_valid") -> DataFrame:
    """Mark rows that meet ``rule``; a rule that comes out NULL is not met."""
    return df.withColumn(flag, F.coalesce(rule, F.lit(False)))


def _cast(column: Column, kind, dirty: str) -> Column:
    return column.try_cast(kind) if dirty == "null" else column.cast(kind)
