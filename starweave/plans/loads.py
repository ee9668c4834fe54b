"""Inserting into the declared tables, whose SERIAL keys go on from load to load.

A load is a folder in the table's location, ``from-<first key>``.  It is
written beside the table, with its limits counted in the writing pass, and
moved in by one rename; a small file in it holds its last key.  The rename
commits rows and sequence together: a load that fails leaves neither, so keys
run from 1 without gap or repeat.  Keys are fixed in a written copy before, so a
task that is tried again writes the same ones.  Of two loads that begin at the same
key, one finds the folder there and is refused (where the file system renames
folders atomically, as HDFS does; an object store needs one writer at a time).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.keys import number_rows, surrogate_key
from ..session import owned_scratch
from ..sources.schemas import columns
from ..sources.tables import create_schema, recreate_declared_table
from ..sources.versions import (
    delete_folder, file_system, folder_names, refuse_broken, write_observed,
)

_LAST = "_last"  # hidden from readers of the table
_PREFIX = "from-"


@dataclass(frozen=True)
class Load:
    first: int  # the first key of the load
    last: int   # the last; below ``first`` if no rows were given


def _location(spark: SparkSession, qualified: str) -> str:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}").collect():
        if r["col_name"] == "Location":
            return r["data_type"].rstrip("/")
    raise ValueError(f"{qualified} has no location")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = file_system(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder; raises if the target is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    none = getattr(hadoop, "Options$Rename").NONE
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = none
    context = hadoop.FileContext.getFileContext(
        hadoop.Path(target).toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(hadoop.Path(source), hadoop.Path(target), options)


def last_key(spark: SparkSession, qualified: str) -> int:
    """The sequence's high-water mark: the last key of the last load, 0 before any."""
    location = _location(spark, qualified)
    loads = [n for n in folder_names(spark, location) if n.startswith(_PREFIX)]
    return int(_read_text(spark, f"{location}/{loads[-1]}/{_LAST}")) if loads else 0


def create_loadable(spark: SparkSession, schema: str, table: str, name: str | None = None) -> str:
    """The declared table, made anew and empty, in the form that loads go into."""
    create_schema(spark, schema)
    return recreate_declared_table(spark, schema, table, name)


def insert_rows(df: DataFrame, qualified: str, declared: str,
                order_by: Sequence[str] | None = None) -> Load:
    """Append ``df`` to a declared table with a SERIAL first column, numbered on
    from its last key: in the given order (then by all other columns), or in
    any order, without a shuffle.  Columns are matched by name and must be the declared
    ones; rows that break a limit raise ``LimitsBroken`` and nothing is added."""
    spark = df.sparkSession
    names = [c.name for c in columns(declared)]
    serial = names[0]
    if columns(declared)[0].sql_type != "SERIAL":
        raise ValueError(f"{declared} has no SERIAL key")
    extra = [c for c in df.columns if c not in names[1:]]
    if extra:
        raise ValueError(f"{declared} has no columns {extra}")
    location = _location(spark, qualified)
    before = last_key(spark, qualified)
    staged = f"{location}.loads/{uuid.uuid4().hex}"
    try:
        with owned_scratch(spark):
            rows = df.select(*[c for c in names[1:] if c in df.columns])
            numbered = surrogate_key(rows, serial, order_by, base=before) \
                if order_by is not None else number_rows(rows, serial, base=before)
            # The keys are new and dense by construction.
            n, report = write_observed(numbered, staged, declared, qualified.replace("`", ""),
                                       check_key=False)
        refuse_broken(report)
        if n:
            _write_text(spark, f"{staged}/{_LAST}", str(before + n))
            _rename(spark, staged, f"{location}/{_PREFIX}{before + 1:019d}")
    finally:
        delete_folder(spark, staged)
    spark.catalog.refreshTable(qualified)
    return Load(before + 1, before + n)
