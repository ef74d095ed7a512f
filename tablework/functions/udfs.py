"""Python functions over Arrow batches, each beside a native expression that does the same.

The native forms are what queries should use: they need no trip to a Python worker.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from tablework.functions.nested import FAHRENHEIT_FACTOR, FAHRENHEIT_OFFSET

# Largest number whose cube is a bigint.
CUBE_LIMIT = 2_097_151


@F.pandas_udf(LongType())
def cubed(numbers: pd.Series) -> pd.Series:
    """Cube of a bigint. Too large a number is an error, as in native ANSI arithmetic."""
    if (numbers.abs() > CUBE_LIMIT).any():
        raise OverflowError(f"cube of a number beyond {CUBE_LIMIT} is not a bigint")
    whole = numbers.astype("Int64")  # a batch with NULLs arrives as floats
    return whole * whole * whole


def cubed_native(number: Column) -> Column:
    return number * number * number


@F.arrow_udf(ArrayType(DoubleType()))
def fahrenheit_arrays(arrays: pa.Array) -> pa.Array:
    """All values of a batch at once, in the arrays they came in."""
    values = pc.add(pc.multiply(arrays.flatten(), FAHRENHEIT_FACTOR), FAHRENHEIT_OFFSET)
    sizes = pc.fill_null(pc.list_value_length(arrays), 0)
    ends = np.append(0, np.cumsum(sizes.to_numpy(zero_copy_only=False)))
    offsets = pa.array(ends, pa.int32())
    return pa.ListArray.from_arrays(offsets, values, mask=arrays.is_null())


def field_scaler(schema: str, factors: dict[str, float]):
    """A struct-to-struct function that multiplies some fields; a NULL struct stays NULL."""

    @F.arrow_udf(schema)
    def scale(records: pa.Array) -> pa.Array:
        names = [records.type.field(i).name for i in range(records.type.num_fields)]
        fields = [
            pc.multiply(field, factors[name]) if name in factors else field
            for name, field in zip(names, records.flatten())
        ]
        return pa.StructArray.from_arrays(fields, names, mask=records.is_null())

    return scale


def register_udfs(spark: SparkSession) -> None:
    """Make the functions callable from SQL text."""
    spark.udf.register("cubed", cubed)
    spark.udf.register("fahrenheit_arrays", fahrenheit_arrays)
