"""Checks of declared keys, references and value rules. Each returns report rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from headway import schemas as S
from headway.functions.texts import blank_to_null

Tables = dict[str, DataFrame]


def pk_duplicates(tables: Tables, names: list[str] | None = None) -> DataFrame:
    """Keys that occur more than once, as text, with their row count."""
    parts = []
    for name in names or [n for n in S.PRIMARY_KEYS if n in tables]:
        key = S.PRIMARY_KEYS[name]
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
        parts.append(tables[name].groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
                     .where("copies > 1")
                     .select(F.lit(name).alias("table_name"), text.alias("key"), "copies"))
    return reduce(DataFrame.unionByName, parts)


def missing_references(child: DataFrame, columns: list[str], parent: DataFrame,
                       keys: list[str]) -> DataFrame:
    """(key, rows) of child keys that no parent row has; a key with a NULL part is not checked.

    Child rows are counted per key before the join, so a key that very many rows share
    reaches it as one row.
    """
    names = [f"k{i}" for i in range(len(columns))]
    wanted = (child.select(*[F.col(c).alias(n) for c, n in zip(columns, names)]).dropna()
              .groupBy(*names).agg(F.count(F.lit(1)).alias("rows")))
    known = parent.select(*[F.col(c).alias(n) for c, n in zip(keys, names)])
    return wanted.join(known, names, "left_anti")


def fk_orphans(tables: Tables) -> DataFrame:
    """For every declared reference whose tables are given: orphan keys and orphan rows."""
    parts = []
    for child, columns, parent, keys in S.FOREIGN_KEYS:
        if child in tables and parent in tables:
            parts.append(
                missing_references(tables[child], columns, tables[parent], keys)
                .agg(F.count(F.lit(1)).alias("orphan_keys"),
                     F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphan_rows"))
                .select(F.lit(child).alias("child"), F.lit(columns[0]).alias("column_name"),
                        F.lit(parent).alias("parent"), "orphan_keys", "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)


def _tally(name: str, table: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Violations of all rules of one table, counted in one pass over it."""
    sums = [F.count_if(broken).alias(rule) for rule, broken in rules]
    pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("violations"))
                      for rule, _ in rules])
    return (table.agg(*sums).select(F.lit(name).alias("table_name"), F.explode(pairs).alias("r"))
            .select("table_name", "r.rule", "r.violations"))


def check_violations(tables: Tables) -> DataFrame:
    """Rows per column whose value lies outside its declared range; NULL passes."""
    parts = []
    for name, ranges in S.VALUE_RANGES.items():
        rules = [(c, ~F.col(c).between(lo, hi)) for c, (lo, hi) in ranges.items()
                 if name in tables and c in tables[name].columns]
        if rules:
            parts.append(_tally(name, tables[name], rules))
    return reduce(DataFrame.unionByName, parts)


def not_null_and_length(tables: Tables) -> DataFrame:
    """Rows per column that are NULL where they must not be, or longer than declared."""
    parts = []
    for name in S.NOT_NULL:
        if name not in tables:
            continue
        have = tables[name].columns
        rules = [(f"{c} is null", F.col(c).isNull()) for c in S.NOT_NULL[name] if c in have]
        rules += [(f"{c} longer than {n}", F.length(F.col(c)) > n)
                  for c, n in S.MAX_LENGTH.get(name, {}).items() if c in have]
        parts.append(_tally(name, tables[name], rules))
    return reduce(DataFrame.unionByName, parts)


def single_active_version(versions: DataFrame) -> DataFrame:
    return versions.agg(F.count_if("is_active").alias("active_versions")).withColumn(
        "passes", F.col("active_versions") <= 1)


def unlisted_references(tables: Tables) -> DataFrame:
    """Trips whose service is in neither calendar table or whose shape is in none.

    Such trips are allowed; this only reports them, per missing id.
    """
    scoped = lambda column: [column, *S.SCOPE]
    services = (tables["calendar"].select(*scoped("service_id"))
                .unionByName(tables["calendar_dates"].select(*scoped("service_id"))))
    parts = []
    for column, known in (("service_id", services), ("shape_id", tables["shapes"])):
        trips = tables["trips"].withColumn(column, blank_to_null(F.col(column)))
        parts.append(missing_references(trips, scoped(column), known, scoped(column))
                     .select(F.lit(column).alias("reference"), F.col("k0").alias("missing_id"),
                             F.col("k1").alias("source_id"), F.col("k2").alias("version_id"),
                             F.col("rows").alias("trips")))
    return parts[0].unionByName(parts[1])
