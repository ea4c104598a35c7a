"""The one-time clean of a raw export: keep-list projection + usable emails.

Both are narrow (Project + Filter in one stage, no shuffle); Catalyst prunes
the scan to the kept columns and pushes ``contains('@')`` into the parquet
reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import valid_email, valid_email_predicate

ORDER_COLUMNS = (S.GEN, S.ORD)


def _order_cols(df: DataFrame) -> list[str]:
    return [c for c in ORDER_COLUMNS if c in df.columns]


def project_required(df: DataFrame) -> DataFrame:
    """Keep-list columns that exist, in keep-list order (plus the ordering
    columns). None present -> an empty table with all keep-list columns."""
    keep = [c for c in S.KEEP_COLUMNS if c in df.columns]
    if not keep:
        return df.select(
            *[F.lit(None).cast("string").alias(c) for c in S.KEEP_COLUMNS], *_order_cols(df)
        ).filter(F.lit(False))
    return df.select(*[S.qcol(c) for c in keep], *_order_cols(df))


def clean_export(df: DataFrame) -> DataFrame:
    """Project to the keep-list, then keep rows with a usable email.
    No email column -> zero rows with the kept columns."""
    out = project_required(df)
    if S.EMAIL not in out.columns:
        return out.filter(F.lit(False))
    return out.filter(valid_email_predicate(S.EMAIL))


def with_email_validity(df: DataFrame, name: str = "_valid") -> DataFrame:
    """Adds the usable-email flag; a missing email column makes every row invalid."""
    if S.EMAIL not in df.columns:
        return df.withColumn(name, F.lit(False))
    return df.withColumn(name, valid_email(S.EMAIL))


def invalid_rows(df: DataFrame) -> DataFrame:
    """Rows a reconcile skips for an unusable email."""
    if S.EMAIL not in df.columns:
        return df
    return df.filter(~valid_email(S.EMAIL))


def valid_rows(df: DataFrame) -> DataFrame:
    if S.EMAIL not in df.columns:
        return df.filter(F.lit(False))
    return df.filter(valid_email_predicate(S.EMAIL))
