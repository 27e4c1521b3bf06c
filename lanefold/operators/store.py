"""The statistics store: keyed joins, picking, upserts and verification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` itself, or an error that counts the keys that occur twice."""
    n = df.groupBy(*keys).count().filter("count > 1").count()
    if n:
        raise ValueError(f"{n} keys {keys} are not unique")
    return df


def keyed_join(keys: list[str], *tables: DataFrame) -> DataFrame:
    """Inner join of all tables on ``keys``; of columns that several have, the rightmost non-null value wins."""

    def two(a: DataFrame, b: DataFrame) -> DataFrame:
        both = [c for c in b.columns if c in a.columns and c not in keys]
        j = a.alias("a").join(b.alias("b"), keys)
        rest = [F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) if c in both else F.col(f"a.{c}") for c in a.columns if c not in keys]
        return j.select(*keys, *rest, *[F.col(f"b.{c}") for c in b.columns if c not in keys and c not in both])

    return reduce(two, tables)


def pick_one(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each group by ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def fill_missing(wanted: DataFrame, have: DataFrame, keys: list[str], compute) -> DataFrame:
    """Rows of ``have`` and, for wanted keys without one, what ``compute`` makes of them."""
    return have.unionByName(compute(wanted.join(have.select(*keys), keys, "left_anti")))


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], supplied: list[str]) -> DataFrame:
    """``stored`` with the supplied columns of matching rows replaced (also by null) and new rows added."""
    s, n = stored.alias("s"), new.select(*keys, *supplied, F.lit(True).alias("_new")).alias("n")
    j = s.join(n, keys, "full")
    out = [F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c) if c in supplied else F.col(f"s.{c}") for c in stored.columns if c not in keys]
    return j.select(*keys, *out)


def verify(expected: DataFrame, actual: DataFrame, keys: list[str], tolerance: dict[str, float]) -> DataFrame:
    """keys, field, expected and actual of every value that differs by more than its tolerance; null equals null only."""
    cols = list(tolerance)
    melt = lambda df, name: df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("v")) for c in cols])).alias("x")).select(*keys, "x.field", F.col("x.v").alias(name))
    j = melt(expected, "expected").join(melt(actual, "actual"), [*keys, "field"], "full")
    limit = F.create_map(*[x for c, t in tolerance.items() for x in (F.lit(c), F.lit(float(t)))])[F.col("field")]
    close = F.abs(F.col("expected") - F.col("actual")) <= F.greatest(limit, 1e-9 * F.greatest(F.abs("expected"), F.abs("actual")))
    return j.filter(~(F.coalesce(close, F.lit(False)) | (F.col("expected").isNull() & F.col("actual").isNull())))


def overlay(fits: DataFrame, verdicts: DataFrame, depth: DataFrame, keys: list[str]) -> DataFrame:
    """``fits`` with the columns of a verdict in their place, also by null, and then null columns filled from ``depth``."""
    cols = [c for c in dict.fromkeys([*fits.columns, *verdicts.columns, *depth.columns]) if c not in keys]
    j = fits.alias("f").join(verdicts.withColumn("_v", F.lit(True)).alias("v"), keys, "left").join(depth.alias("d"), keys, "left")

    def one(c: str):
        base = F.col(f"f.{c}") if c in fits.columns else F.lit(None)
        if c in verdicts.columns:
            base = F.when(F.col("v._v"), F.col(f"v.{c}")).otherwise(base)
        return (F.coalesce(base, F.col(f"d.{c}")) if c in depth.columns else base).alias(c)

    return j.select(*keys, *[one(c) for c in cols])


def mixed_identities(parts: DataFrame, group: str, identity: list[str]) -> DataFrame:
    """Groups whose rows don't share one identity, with how many they have; null is an identity too."""
    return parts.groupBy(group).agg(F.size(F.collect_set(F.struct(*identity))).alias("identities")).filter("identities > 1")


def partial_upsert(stored: DataFrame, new: DataFrame, keys: list[str], supplied: list[str]) -> tuple[DataFrame, DataFrame]:
    """``stored`` with the supplied columns of known keys replaced, and the new rows refused since nothing is stored for them."""
    known = new.join(stored.select(*keys), keys, "left_semi")
    return upsert(stored, known, keys, supplied), new.join(stored.select(*keys), keys, "left_anti")


def backfill_summary(samples: DataFrame) -> DataFrame:
    """One row: samples, valid, invalid, verified and mismatched; ``safe_to_rerun`` if no valid sample is mismatched."""
    t = samples.agg(
        F.count("*").alias("samples"), F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"), F.count_if(F.col("valid") & (F.col("mismatches") == 0)).alias("verified"),
        F.count_if(F.col("valid") & (F.col("mismatches") > 0)).alias("mismatched"),
    )
    return t.withColumn("safe_to_rerun", F.col("mismatched") == 0)


def safe_to_rerun(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, once each, of the samples that can be run again without harm: not valid, or with an upload that wasn't committed.

    A null ``valid`` or ``committed`` counts as no.
    """
    done = F.coalesce(F.col("valid"), F.lit(False)) & F.coalesce(F.col("committed"), F.lit(False))
    return samples.filter(~done).select(*keys).distinct()


def all_or_nothing(rows: DataFrame, error: str = "error") -> DataFrame:
    """``rows`` without their error column, or an error that counts the rows which have one: nothing is written then."""
    n = rows.filter(F.col(error).isNotNull()).count()
    if n:
        raise ValueError(f"{n} rows are not valid; nothing is applied")
    return rows.drop(error)


def merge_records(parts: list[DataFrame], group: str, identity: list[str]) -> tuple[DataFrame, DataFrame]:
    """Records of all ``parts`` joined on group and identity, and the groups whose parts don't share one identity."""
    keys = [group, *identity]
    return keyed_join(keys, *parts), mixed_identities(reduce(DataFrame.unionByName, [p.select(*keys) for p in parts]), group, identity)


def family_tables(record: DataFrame, families: dict[str, dict[str, str | tuple[str, str]]], keys: list[str]) -> dict[str, DataFrame]:
    """The rows of each typed table that a record table (keys and legacy columns) supplies.

    ``families`` maps a family's columns to their table, or to (table, stored name); columns that the record lacks are
    left out. A row exists only where a process gave a value, so rows of nulls are dropped. Raises if a family has no
    column in the record, or if keys repeat.
    """
    assert_unique(record, keys)
    tables: dict[str, list[tuple[str, str]]] = {}
    for family, columns in families.items():
        have = {c: t for c, t in columns.items() if c in record.columns}
        if not have:
            raise ValueError(f"{family}: the record has none of its columns")
        for c, target in have.items():
            table, name = target if isinstance(target, tuple) else (target, c)
            tables.setdefault(table, []).append((c, name))
    out = {}
    for table, pairs in tables.items():
        rows = record.select(*keys, *[F.col(c).alias(name) for c, name in pairs])
        out[table] = rows.filter(F.coalesce(*[F.col(name).cast("string") for _, name in pairs]).isNotNull())
    return out


def upsert_families(stored: dict[str, DataFrame], record: DataFrame, families: dict[str, dict[str, str | tuple[str, str]]], keys: list[str]) -> dict[str, DataFrame]:
    """Every stored table with what the record supplies for it: its columns are replaced, also by null, others kept."""
    new = family_tables(record, families, keys)
    return stored | {table: upsert(stored[table], rows, keys, [c for c in rows.columns if c not in keys]) if table in stored else rows for table, rows in new.items()}
