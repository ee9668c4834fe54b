"""Tables rebuilt in full behind one catalog switch, with limits counted in
the writing pass.

A rebuild writes a folder of its own beside the others of the table
(``<schema's folder>/<name>.versions/<version>``) and then points the catalog's table to
it, which is a single change of the catalog.  Until then readers see the old
rows; a build that dies in the middle, or whose rows break a declared limit,
leaves the table as it was.  The version before is kept for readers that have
begun; older ones go.

Limits (NOT NULL, VARCHAR(n), NUMERIC(p, s)) are observed metrics of the write
itself, so nothing is scanned for them: a task that is tried again counts once.
A primary key is looked at in the written key column.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .limits import limit_counts, missing_columns
from .schemas import PRIMARY_KEYS, columns


class LimitsBroken(ValueError):
    """Rows broke declared limits; ``failures`` lists (test, relation, column, rows)."""

    def __init__(self, failures: Sequence[tuple[str, str, str, int]]):
        self.failures = list(failures)
        super().__init__("declared limits are broken: " + "; ".join(
            f"{test} {relation}.{column}: {n}" for test, relation, column, n in failures))


def file_system(spark: SparkSession, path: str):
    """Hadoop's (file system, path) of a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def as_declared(df: DataFrame, declared: str) -> DataFrame:
    """``df`` with the declared column types (a value that does not fit: NULL,
    which the limits count on the values before)."""
    kinds = {c.name: c.spark_type for c in columns(declared)}
    return df.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds
                       and df.schema[c].dataType != kinds[c] else c for c in df.columns])


def write_observed(df: DataFrame, path: str, declared: str, relation: str | None = None,
                   left_out: Sequence[str] = (), check_key: bool = True
                   ) -> tuple[int, list[tuple[str, str, str, int]]]:
    """Write ``df`` to ``path`` in its declared types; returns the number of rows and
    a report (test, relation, column, failures) as ``constraint_report`` has it."""
    from ..operators.quality import repeated_keys

    relation = relation or declared
    report = [("missing_column", relation, c, 1) for c in missing_columns(df, declared, left_out)]
    labels, aggs = limit_counts(df, declared)
    seen = Observation(f"limits of {relation}")
    observed = df.observe(seen, F.count(F.lit(1)).alias("n"),
                          *[a.alias(f"c{i}") for i, a in enumerate(aggs)])
    as_declared(observed, declared).write.parquet(path)
    counts = seen.get
    report += [(test, relation, c, counts[f"c{i}"]) for i, (test, c) in enumerate(labels)]
    key = PRIMARY_KEYS.get(declared)
    if check_key and key in df.columns:
        kept = df.sparkSession.read.schema(as_declared(df, declared).schema).parquet(path)
        report.append(("primary_key", relation, key, repeated_keys(kept.select(key), key)))
    return counts["n"], report


def refuse_broken(report: Sequence[tuple[str, str, str, int]]) -> None:
    broken = [r for r in report if r[3]]
    if broken:
        raise LimitsBroken(broken)


def _column_types(df: DataFrame, declared: str | None) -> list[tuple[str, str]]:
    lengths = {c.name: c.max_length for c in columns(declared)} if declared else {}
    return [(f.name, f"varchar({lengths[f.name]})" if lengths.get(f.name)
             else f.dataType.simpleString()) for f in df.schema.fields]


def _present_types(spark: SparkSession, qualified: str) -> list[tuple[str, str]]:
    out = []
    for r in spark.sql(f"DESCRIBE TABLE {qualified}").collect():
        if not r["col_name"] or r["col_name"].startswith("#"):
            break
        out.append((r["col_name"], r["data_type"]))
    return out


def point_to(spark: SparkSession, schema: str, name: str, types: list[tuple[str, str]],
             path: str) -> None:
    """Make the table ``schema.name`` read ``path``.  With the columns it has,
    that is one change of the catalog.  A table whose columns have changed is made anew
    under another name and renamed, after the old one has gone."""
    qualified = f"`{schema}`.`{name}`"

    def create(table: str) -> None:
        spark.sql(f"CREATE TABLE {table} ({', '.join(f'`{c}` {t}' for c, t in types)}) "
                  f"USING parquet LOCATION '{path}'")

    if not spark.catalog.tableExists(qualified):
        create(qualified)
    elif _present_types(spark, qualified) == types:
        spark.sql(f"ALTER TABLE {qualified} SET LOCATION '{path}'")
    else:
        following = f"`{schema}`.`{name}__{uuid.uuid4().hex[:8]}`"
        create(following)
        spark.sql(f"DROP TABLE {qualified}")
        spark.sql(f"ALTER TABLE {following} RENAME TO {qualified}")
    spark.catalog.refreshTable(qualified)


def versions_folder(spark: SparkSession, schema: str, name: str) -> str:
    return f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{name}.versions"


def publish(df: DataFrame, schema: str, name: str, declared: str | None = None,
            left_out: Sequence[str] = (), keep: int = 1) -> str:
    """Rebuild ``schema.name`` from ``df``.  With ``declared``, the name of a
    declared table, it gets the declared types, and rows that break its limits
    raise ``LimitsBroken``.  ``keep`` versions before the new one stay."""
    spark = df.sparkSession
    folder = versions_folder(spark, schema, name)
    path = f"{folder}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        if declared:
            refuse_broken(write_observed(df, path, declared, name, left_out)[1])
            df = as_declared(df, declared)
        else:
            df.write.parquet(path)
        point_to(spark, schema, name, _column_types(df, declared), path)
    except BaseException:
        delete_folder(spark, path)
        raise
    for old in folder_names(spark, folder)[:-1 - keep]:
        delete_folder(spark, f"{folder}/{old}")
    return f"`{schema}`.`{name}`"
