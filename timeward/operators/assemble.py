"""Joins, projections and unions that build the model input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeward.functions.scalars import boolean_from_text, kind_of, missing_count
from timeward.names import (
    ID,
    LABEL,
    NOT_FEATURES,
    NULL_COUNT,
    NUMERIC_CATEGORIES,
    ORIGIN,
    V_COLUMNS,
)
from timeward.operators.lookups import inner_attach, left_attach, with_dictionary


class AssemblyError(Exception):
    """Columns or rows do not line up."""


def join_identity(
    transactions: DataFrame,
    identity: DataFrame,
    *,
    key: str = ID,
    block: Sequence[str] = tuple(V_COLUMNS),
    null_count: str = NULL_COUNT,
) -> DataFrame:
    """Every transaction, its identity columns where it has any, and the block's null count.

    The count is taken on the raw values, before anything could fill them.
    """
    counted = transactions.withColumn(null_count, missing_count(block))
    joined = left_attach(counted, identity, key)
    extra = [c for c in identity.columns if c != key]
    return joined.select(*transactions.columns, *extra, null_count)


def join_scoring_identity(
    transactions: DataFrame,
    identity: DataFrame,
    *,
    label_type: T.DataType | None = None,
    key: str = ID,
    label: str = LABEL,
    block: Sequence[str] = tuple(V_COLUMNS),
) -> DataFrame:
    """The same join for a period without labels; the label arrives as a typed NULL."""
    joined = join_identity(transactions, identity, key=key, block=block)
    return joined.withColumn(label, F.lit(None).cast(label_type or T.LongType()))


def assemble_model_input(
    joined: DataFrame, features: DataFrame, names: Sequence[str], *, key: str = ID
) -> DataFrame:
    """Joined rows with each engineered column named; an absent one raises."""
    if absent := [n for n in names if n not in features.columns]:
        raise AssemblyError(f"engineered column(s) absent: {absent[:5]}")
    return inner_attach(joined, features.select(key, *names), key)


def require_same_rows(left: DataFrame, right: DataFrame, what: str) -> int:
    """Raises when two frames differ in row count."""
    a, b = left.count(), right.count()
    if a != b:
        raise AssemblyError(f"{what}: {a} rows against {b}")
    return a


def feature_names(df: DataFrame, excluded: frozenset[str] = NOT_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in excluded]


def drop_roles(df: DataFrame, excluded: frozenset[str] = NOT_FEATURES) -> DataFrame:
    return df.select(*feature_names(df, excluded))


def prepare_types(
    df: DataFrame,
    *,
    categories: frozenset[str] = NUMERIC_CATEGORIES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Types for the learner: declared codes to text, doubles to floats, booleans to 1/0 floats.

    A missing boolean stays NULL. Columns in ``keep`` pass through untouched.
    """
    out = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if f.name in keep:
            out.append(column)
        elif f.name in categories:
            out.append(column.cast("string").alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.BooleanType)):
            out.append(column.cast("float").alias(f.name))
        else:
            out.append(column)
    return df.select(*out)


def vocabulary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(``column``, ``value``): every non-null level the training rows hold."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return train.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()


def align_to(
    df: DataFrame,
    reference: T.StructType,
    *,
    levels: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``df`` in the reference's columns, order and types.

    An absent column becomes a typed NULL, text is read as a boolean or a number where the
    reference has one, and with ``levels`` a text level the training rows never held becomes
    NULL. Columns in ``carry`` ride along in front.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in reference.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.BooleanType) and isinstance(have[f.name], T.StringType):
            out.append(boolean_from_text(f.name).alias(f.name))
        elif isinstance(f.dataType, T.NumericType) and not isinstance(have[f.name], T.NumericType):
            text = isinstance(have[f.name], T.StringType)
            value = F.col(f.name).try_cast(f.dataType) if text else F.col(f.name).cast(f.dataType)
            out.append(value.alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    aligned = df.select(*[c for c in carry if c not in reference.names], *out)
    if levels is None:
        return aligned
    texts = [f.name for f in reference.fields if isinstance(f.dataType, T.StringType) and f.name in have]
    probes = {f"_level_{c}": (c, F.col(c)) for c in texts}
    key = ID if ID in aligned.columns else None
    known = with_dictionary(aligned, levels, probes, "value", key=key)
    return known.select(*[F.col(f"_level_{c}").alias(c) if c in texts else F.col(c) for c in aligned.columns])


def scoring_history(train: DataFrame, scoring: DataFrame, *, origin: str = ORIGIN) -> DataFrame:
    """Training rows and scoring rows in the training schema, tagged with where they came from.

    What the scoring side lacks arrives as a typed NULL; what training lacks is dropped.
    """
    have = set(scoring.columns)
    aligned = scoring.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in train.schema.fields
        ]
    )
    return train.withColumn(origin, F.lit("train")).unionByName(
        aligned.withColumn(origin, F.lit("test"))
    )


def contract_view(
    df: DataFrame,
    admitted: Sequence[str],
    *,
    carry: Sequence[str],
) -> DataFrame:
    """``carry`` columns plus the admitted features in contract order; any absent one raises."""
    if absent := [c for c in admitted if c not in df.columns]:
        raise AssemblyError(f"{len(absent)} admitted column(s) absent, e.g. {absent[:5]}")
    return df.select(*[c for c in carry if c not in admitted], *admitted)


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    if absent := [n for n in names if n not in df.columns]:
        raise AssemblyError(f"{what}: {len(absent)} column(s) absent, e.g. {absent[:5]}")


def shape_of(df: DataFrame, name: str) -> DataFrame:
    """One row: the name, the row count and the number of columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")
    )


def column_kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: kind_of(f.dataType) for f in df.schema.fields}
