"""HR tables derived by Spark from the driver's TPC-H-style tables.

People come from ``customer`` (zone = region, country = nation), the roster
from a slice of the same customers with damaged keys and mixed actions, and
the add list from ``supplier``. The rules are arithmetic on the row key, so
the derivation is a narrow projection that grows with the tables and that
DuckDB can reproduce exactly (see ``oracle_sql.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall import schema as S

TEST_ZONE = "AMERICA"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x nation x region with the raw key ``k``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .withColumn("k", F.col("c_custkey"))
    )


def _name(k: Column) -> Column:
    """Names with all that delimited text has to carry, and blank ones."""
    m = k % 17
    return (
        F.when(m == 1, F.lit(""))
        .when(m == 2, F.lit("  "))
        .when(m == 3, F.concat(F.lit('Smith, "'), F.col("c_name"), F.lit('", Jr')))
        .when(m == 4, F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")))
        .when(m == 5, F.concat(F.col("c_name"), F.lit("\nII")))
        .otherwise(F.col("c_name"))
    )


def _userbase_columns(k: Column) -> dict:
    gid = (
        F.when(k % 5 == 0, F.concat(_s(k), F.lit(".0")))
        .when(k % 11 == 0, F.lpad(_s(k), 8, "0"))
        .otherwise(_s(k))
    )
    email = (
        F.when(k % 50 == 7, F.lit(""))
        .when(k % 50 == 9, F.lit("noemail@corp.com"))
        .when(k % 50 == 11, F.lit("no-at-sign"))
        .when(k % 40 == 3, F.concat(F.lit("USER"), _s(k - 1), F.lit("@Corp.com")))
        .otherwise(F.concat(F.lit("user"), _s(k), F.lit("@corp.com")))
    )
    return {
        S.ZONE: F.col("r_name"),
        "Country": F.col("n_name"),
        S.GLOBAL_ID: gid,
        S.LOCAL_ID: F.concat(F.lit("L-"), _s(k)),
        S.NAME: _name(k),
        S.EMAIL: email,
    }


def userbase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared userbase: six keep-list columns, ``status`` '', run 0."""
    p = people(spark, sf_dir)
    cols = _userbase_columns(F.col("k"))
    return p.select(
        *[v.alias(n) for n, v in cols.items()],
        F.lit("").alias(S.STATUS),
        F.lit(0).alias(S.GEN),
        F.col("k").cast("bigint").alias(S.ORD),
    )


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw export: the userbase columns in file order of our own, plus a
    keep-list column (``Employee Status``) and two columns the clean drops."""
    p = people(spark, sf_dir)
    cols = _userbase_columns(F.col("k"))
    return p.select(
        cols[S.EMAIL].alias(S.EMAIL),
        F.col("c_mktsegment").alias("Segment Code"),
        *[cols[n].alias(n) for n in (S.ZONE, "Country", S.GLOBAL_ID, S.LOCAL_ID, S.NAME)],
        F.when(F.col("k") % 7 == 0, F.lit("Inactive")).otherwise(F.lit("Active")).alias("Employee Status"),
        _s(F.col("c_nationkey")).alias("Nation Key"),
        F.lit(0).alias(S.GEN),
        F.col("k").cast("bigint").alias(S.ORD),
    )


def roster(spark: SparkSession, sf_dir: str, everyone: bool = False) -> DataFrame:
    """The first roster: two thirds of the customers, as people are missing from
    a roster; ``everyone`` for queries that look at roster rows alone."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    email = (
        F.when(k % 4 == 1, F.concat(F.lit("moved"), _s(k), F.lit("@new.com")))
        .when(k % 40 == 2, F.lit("noemail@corp.com"))
        .otherwise(F.concat(F.lit(" mailto:User"), _s(k), F.lit("@Corp.com ")))
    )
    gid = F.when(k % 8 == 1, F.concat(F.lit("X"), _s(k))).otherwise(_s(k))
    lid = F.when(k % 16 == 1, F.lit("")).otherwise(F.concat(F.lit(" l-"), _s(k)))
    m = k % 10
    action = (
        F.when(m == 6, F.lit("remove from list"))
        .when(m == 7, F.lit(""))
        .when(m == 3, F.lit("Left"))
        .when(m == 9, F.lit(" OK "))
        .otherwise(F.lit("ok"))
    )
    name = F.when(k % 17 != 6, _name(k))
    return c.filter(F.lit(everyone) | (k % 3 != 2)).select(
        name.alias(S.NAME),
        email.alias(S.EMAIL),
        gid.alias(S.GLOBAL_ID),
        lid.alias(S.LOCAL_ID),
        action.alias(S.ACTION),
        k.cast("bigint").alias(S.ORD),
    )


def add_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = F.col("s_suppkey")
    email = (
        F.when(k % 4 == 0, F.concat(F.lit("user"), _s(k), F.lit("@corp.com")))
        .when(k % 10 == 3, F.lit("bad"))
        .when(k % 10 == 7, F.concat(F.lit("NEW"), _s(k - 2), F.lit("@corp.com")))
        .otherwise(F.concat(F.lit("new"), _s(k), F.lit("@corp.com")))
    )
    return s.select(
        F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("ASIA")).alias(S.ZONE),
        F.concat(_s(k + 90000000), F.lit(".0")).alias(S.GLOBAL_ID),
        F.concat(F.lit("N-"), _s(k)).alias(S.LOCAL_ID),
        F.col("s_name").alias(S.NAME),
        email.alias(S.EMAIL),
        k.cast("bigint").alias(S.ORD),
    )


def zone_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One roster workbook per region: its customers, with
    the ``Zone`` column named by region, blank for ``k % 7 = 0`` and, in the
    ``MIDDLE EAST`` workbook, a second zone for ``k % 13 = 0``."""
    p = people(spark, sf_dir)
    k = F.col("k")
    z = (
        F.when(k % 7 == 0, F.lit(" "))
        .when((F.col("r_name") == "MIDDLE EAST") & (k % 13 == 0), F.lit("EUROPE"))
        .otherwise(F.concat(F.lit(" "), F.col("r_name")))
    )
    return p.select(
        F.concat(F.lit("zones-"), F.lower(F.regexp_replace("r_name", " ", "_"))).alias("workbook"),
        z.alias(S.ZONE),
        F.col("c_name").alias(S.NAME),
        k.cast("bigint").alias(S.ORD),
    )


SECOND_ZONE = "EUROPE"


def roster_second_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster of a second zone run: the customers the first roster left
    out (``k % 3 = 2``), no local-id column, actions by ``k % 4``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    email = (
        F.when(k % 6 == 5, F.concat(F.lit("User"), _s(k), F.lit("@corp.com")))
        .otherwise(F.concat(F.lit("other"), _s(k), F.lit("@corp.com")))
    )
    m = k % 4
    action = F.when(m == 0, F.lit("remove")).when(m == 1, F.lit("")).otherwise(F.lit("ok"))
    return c.filter(k % 3 == 2).select(
        F.col("c_name").alias(S.NAME),
        email.alias(S.EMAIL),
        _s(k).alias(S.GLOBAL_ID),
        action.alias(S.ACTION),
        k.cast("bigint").alias(S.ORD),
    )


def roster_near_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster with near misses in the rows that match nothing
    (``k % 16 = 1``): a changed mail domain for ``k % 32 = 1``, and a
    zero-padded global id for ``k % 48 = 33``. Used by the diagnose job."""
    r = roster(spark, sf_dir)
    k = F.col(S.ORD)
    email = F.when(k % 32 == 1, F.concat(F.lit("user"), _s(k), F.lit("@new.org"))).otherwise(F.col(S.EMAIL))
    gid = F.when(k % 48 == 33, F.concat(F.lit("000"), _s(k))).otherwise(F.col(S.GLOBAL_ID))
    return r.withColumns({S.EMAIL: email, S.GLOBAL_ID: gid})
