"""Schema and data-quality checks, and the two clean-up deletes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..schemas import Table
from ..sources import snapshots
from .joins import anti_join
from .picks import latest_duplicate


def delete_duplicates(results: DataFrame) -> DataFrame:
    """Results without re-ingested copies; the highest id of a key stays."""
    return latest_duplicate(results)


def delete_null_school(results: DataFrame) -> DataFrame:
    return results.where(F.col("SchoolID").isNotNull())


def ensure_columns(df: DataFrame, columns: StructType) -> DataFrame:
    """Add each column that is absent, as a typed NULL."""
    have = set(df.columns)
    new = {f.name: F.lit(None).cast(f.dataType) for f in columns.fields if f.name not in have}
    return df.withColumns(new) if new else df


def relax_required(table: Table, *columns: str) -> Table:
    """The table with fewer required columns."""
    return replace(table, required=tuple(c for c in table.required if c not in columns))


def _long(df: DataFrame, figures: dict[str, Column], label: str, value: str) -> DataFrame:
    """One aggregate pass, then one row per figure."""
    names = list(figures)
    wide = df.agg(*[c.alias(f"f{i}") for i, c in enumerate(figures.values())])
    rows = F.array(
        *[F.struct(F.lit(n).alias(label), F.col(f"f{i}").alias(value)) for i, n in enumerate(names)]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, missing parts counting as equal."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def required_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per required column."""
    return _long(df, {c: F.count_if(F.col(c).isNull()) for c in columns}, "column_name", "violations")


def length_violations(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Texts longer than their column, per column."""
    figures = {c: F.count_if(F.length(c) > w) for c, w in widths.items() if c in df.columns}
    return _long(df, figures, "column_name", "violations")


def table_presence(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Whether each table is there, and its row count; parquet counts come from the file footers.

    A folder that is there but holds no readable table raises: it is broken, not absent.
    """
    out = None
    for name, path in paths.items():
        label = F.lit(name).alias("table_name")
        try:
            counted = snapshots.read(spark, path).agg(F.count(F.lit(1)).alias("row_count"))
            one = counted.select(label, F.lit(True).alias("present"), "row_count")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            absent = F.lit(0).cast("bigint").alias("row_count")
            one = spark.range(1).select(label, F.lit(False).alias("present"), absent)
        out = one if out is None else out.unionByName(one)
    return out


def catalog_presence(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Whether each table is in the session's catalog."""
    rows = [(n, spark.catalog.tableExists(n)) for n in names]
    return spark.createDataFrame(rows, "table_name string, present boolean")


def column_report(df: DataFrame) -> DataFrame:
    """Name, type and longest text of each column."""
    figures = {
        f.name: (F.max(F.length(f.name)) if isinstance(f.dataType, StringType) else F.lit(None).cast("int"))
        for f in df.schema.fields
    }
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return _long(df, figures, "column_name", "max_length").withColumn(
        "data_type", F.element_at(kind, F.col("column_name"))
    )


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys with no parent row: rows and distinct values; equal keys are counted first."""
    per_key = child.where(F.col(foreign_key).isNotNull()).groupBy(F.col(foreign_key).alias(key))
    lost = anti_join(per_key.agg(F.count(F.lit(1)).alias("n")), parent.select(key), [key])
    return lost.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys")
    )


def orphan_report(relations: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    out = None
    for name, relation in relations.items():
        one = orphans(*relation).select(F.lit(name).alias("relation"), "orphan_rows", "orphan_keys")
        out = one if out is None else out.unionByName(one)
    return out


def foreign_key_report(tables: dict[str, DataFrame], layouts: Sequence[Table]) -> DataFrame:
    """``orphan_report`` for every reference that the layouts state."""
    return orphan_report(
        {
            f"{layout.name}.{column}": (tables[layout.name], column, tables[parent], key)
            for layout in layouts
            for column, (parent, key) in layout.references.items()
        }
    )


def constraint_report(tables: dict[str, DataFrame], layouts: Sequence[Table]) -> DataFrame:
    """``table_name, kind, columns, violations, keys``: all constraints of all layouts, with one scan of each table.

    Each row names the keys it holds and the rules it breaks, and one grouped pass counts them: ``unique`` (rows under a key that occurs
    more than once, missing parts being equal, and such keys), ``required`` (rows without a value), ``length`` (texts that are too long)
    and ``reference`` (rows whose key no parent has, and such keys). Equal keys are counted before the shuffle. A column that a table lacks is missing in all its rows,
    for ``required``, and otherwise breaks nothing. A reference to a table that is not given is not checked.
    """
    rules: list[tuple[str, str, str]] = []
    claims: dict[str, list[Column]] = {name: [] for name in tables}
    none = F.lit(None).cast("string")

    def claim(table: str, rule: int, key: Column, when: Column, parent: bool = False) -> None:
        claims[table].append(F.when(when, F.struct(F.lit(rule).alias("rule"), key.alias("key"), F.lit(parent).alias("parent"))))

    for layout in layouts:
        if layout.name not in tables:
            continue
        have = set(tables[layout.name].columns)
        for columns in [layout.unique] if layout.unique and set(layout.unique) <= have else []:
            rules.append((layout.name, "unique", ",".join(columns)))
            claim(layout.name, len(rules) - 1, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), F.lit(True))
        for c in layout.required:
            rules.append((layout.name, "required", c))
            claim(layout.name, len(rules) - 1, none, F.col(c).isNull() if c in have else F.lit(True))
        for c, width in layout.widths.items():
            rules.append((layout.name, "length", c))
            if c in have:
                claim(layout.name, len(rules) - 1, none, F.length(c) > width)
        for c, (parent, key) in layout.references.items():
            if parent in tables:
                rules.append((layout.name, "reference", c))
                if c in have:
                    claim(layout.name, len(rules) - 1, F.col(c).cast("string"), F.col(c).isNotNull())
                claim(parent, len(rules) - 1, F.col(key).cast("string"), F.col(key).isNotNull(), parent=True)
    spark = next(iter(tables.values())).sparkSession
    stated = spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], "rule int, table_name string, kind string, columns string")
    found = [df.select(F.explode(F.array_compact(F.array(*claims[n]))).alias("c")).select("c.*") for n, df in tables.items() if claims[n]]
    if not found:
        return stated.select("table_name", "kind", "columns", F.lit(0).cast("long").alias("violations"), F.lit(0).cast("long").alias("keys"))
    per_key = reduce(DataFrame.unionByName, found).groupBy("rule", "key").agg(F.count_if(~F.col("parent")).alias("n"), F.bool_or("parent").alias("has_parent"))
    # the rules are a few rows
    kinds = per_key.join(F.broadcast(stated.select("rule", "kind")), "rule")
    broken = F.when(F.col("kind") == "unique", F.col("n") > 1).when(F.col("kind") == "reference", ~F.col("has_parent")).otherwise(F.lit(True))
    totals = kinds.where(broken & (F.col("n") > 0)).groupBy("rule").agg(F.sum("n").alias("violations"), F.count("key").alias("keys"))
    report = stated.join(totals, "rule", "left")
    return report.select("table_name", "kind", "columns", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("violations", "keys")])
