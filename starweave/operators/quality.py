"""Data-quality checks as DataFrames.

Each check yields one row ``(test, relation, column_name, failures)``, where
``failures`` counts what the declarative test would return:

* ``unique``        - distinct non-NULL values seen more than once;
* ``not_null``      - rows holding NULL;
* ``relationships`` - child rows whose non-NULL value has no parent;
* ``max_length``    - values longer than a declared VARCHAR(n);
* ``numeric_range`` - values that do not fit a declared NUMERIC(p, s);
* ``missing_column`` - 1 for a declared column that the relation lacks.

Every check is an aggregate, so a report is many small one-row results
unioned in one job.  Heavy sides are reduced before they are shuffled: the
child of a relationship meets a large parent as distinct values with counts
(map-side partial aggregation), and the row-level checks of one relation
share a single scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.limits import limit_counts, missing_columns
from ..sources.schemas import PRIMARY_KEYS
from ..session import stored
from .joins import (
    DEFAULT_BROADCAST_BYTES, fits_broadcast, fitting_together, hot_keys, lookup_join,
)
from .ranges import possible_repeats

REPORT_COLUMNS = ("test", "relation", "column_name", "failures")


def _row(df_one: DataFrame, test: str, relation: str, column: str) -> DataFrame:
    """Label a one-column, one-row aggregate as a report row."""
    return df_one.select(
        F.lit(test).alias("test"),
        F.lit(relation).alias("relation"),
        F.lit(column).alias("column_name"),
        F.coalesce(F.col(df_one.columns[0]).cast("long"), F.lit(0)).alias("failures"),
    )


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """The failing rows of ``unique``: each duplicated value and its count."""
    c = F.col(column)
    return (df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def key_profile(df: DataFrame, column: str) -> DataFrame:
    """One grouped pass over a key column answering both ``unique`` and
    ``not_null``: ``duplicated`` (non-NULL values seen more than once) and
    ``nulls`` (rows holding NULL - NULL keys form one group)."""
    c = F.col(column)
    groups = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.count_if(c.isNotNull() & (F.col("_n") > 1)).alias("duplicated"),
        F.coalesce(F.sum(F.when(c.isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
    )


def unique(df: DataFrame, relation: str, column: str) -> DataFrame:
    return _row(unique_violations(df, column).agg(F.count(F.lit(1))), "unique", relation, column)


def unique_by_ranges(df: DataFrame, relation: str, column: str) -> DataFrame:
    """``unique`` for a written table: only keys where sorted ranges overlap
    are grouped, none if it was written in key order and is clean."""
    rows = possible_repeats(df, column)
    return unique(df.where(F.lit(False)) if rows is None else rows, relation, column)


def not_null(df: DataFrame, relation: str, column: str) -> DataFrame:
    return _row(df.agg(F.count_if(F.col(column).isNull())), "not_null", relation, column)


def relationships(child: DataFrame, relation: str, column: str,
                  parent: DataFrame, field: str,
                  max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Child rows whose non-NULL ``column`` is missing from ``parent.field``.

    A parent key set within the broadcast bound is probed map-side by every
    child row, and only orphans are counted: no shuffle of the child.  Larger
    sets of whole-number keys meet as bitmaps (``orphan_rows``).  For other
    types the child's distinct keys with counts meet the parent, a map-side
    partial aggregate, so a hot key crosses the network once per task.  That
    path is an outer join plus a NULL test, because Catalyst would push an
    anti join back below the aggregation.
    """
    c = F.col(column)
    present = child.where(c.isNotNull())
    parents = parent.select(F.col(field).alias("_k"))
    if fits_broadcast(parents, max_broadcast_bytes):
        orphans = present.select(c.alias("_k")).join(F.broadcast(parents), "_k", "left_anti")
        return _row(orphans.agg(F.count(F.lit(1))), "relationships", relation, column)
    if all(d.schema[n].dataType.typeName() in ("integer", "long")
           for d, n in ((child, column), (parent, field))):
        return _row(orphan_rows(present.select(c.cast("long").alias("_k")),
                                parents.select(F.col("_k").cast("long"))),
                    "relationships", relation, column)
    keys = present.groupBy(c.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    found = parents.distinct().select("_k", F.lit(True).alias("_found"))
    orphans = keys.join(found.hint("merge"), "_k", "left").where(F.col("_found").isNull())
    return _row(orphans.agg(F.sum("_n")), "relationships", relation, column)


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(_b, _bits, _rows): the non-NULL whole-number keys as bitmaps of 32,768
    bits a bucket, made map-side first: a task sends 4 kB for each bucket it
    has seen, however many rows hold those keys."""
    k = F.col(key)
    return df.where(k.isNotNull()).groupBy(F.bitmap_bucket_number(k).alias("_b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("_bits"),
        F.count(F.lit(1)).alias("_rows"))


# Buckets named in a filter; beyond, they are joined.
MAX_BUCKETS = 1000


def _in_buckets(df: DataFrame, key: str, buckets: DataFrame, few: list[int] | None) -> DataFrame:
    number = F.bitmap_bucket_number(F.col(key))
    if few is not None:
        return df.where(number.isin(few))
    return df.join(buckets.select("_b"), number == F.col("_b"), "left_semi")


def _few(buckets: DataFrame) -> list[int] | None:
    """The numbers of the buckets if they are few enough to be listed."""
    found = buckets.select("_b").limit(MAX_BUCKETS + 1).collect()
    return [r["_b"] for r in found] if len(found) <= MAX_BUCKETS else None


def orphan_rows(child: DataFrame, parents: DataFrame) -> DataFrame:
    """How many rows of ``child`` (_k, whole numbers) have no parent (_k), as one row.

    The bitmaps of both sides meet by bucket: a bucket has orphans where
    the union has more bits than the parents.  Only the rows of such buckets are
    looked at again; clean data ends with the bitmaps."""
    own = key_bitmaps(parents, "_k").select("_b", "_bits", F.bitmap_count("_bits").alias("_p"))
    both = key_bitmaps(child, "_k").select("_b", "_bits", F.lit(0).cast("long").alias("_p")) \
        .unionAll(own)
    bad = stored(both.groupBy("_b").agg(F.bitmap_or_agg("_bits").alias("_bits"),
                                        F.max("_p").alias("_p"))
                 .where(F.bitmap_count("_bits") > F.col("_p")).select("_b"))
    few = _few(bad)
    if few == []:
        return bad.agg(F.count(F.lit(1)).alias("n"))
    keys = _in_buckets(child, "_k", bad, few).groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    found = _in_buckets(parents, "_k", bad, few).distinct().withColumn("_found", F.lit(True))
    return keys.join(found, "_k", "left").where(F.col("_found").isNull()).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def repeated_keys(df: DataFrame, key: str) -> int:
    """How many non-NULL values of ``key`` occur more than once in a written table.

    Keys written in order need no more than their ranges (``possible_repeats``).
    Where ranges overlap, whole numbers are counted as bitmaps: where a bucket
    has as many bits as rows, its keys are unique.  Only other buckets are
    grouped key by key; other types are grouped at once."""
    df = possible_repeats(df, key)
    if df is None:
        return 0
    if df.schema[key].dataType.typeName() in ("integer", "long"):
        df = df.select(F.col(key).cast("long"))
        bad = stored(key_bitmaps(df, key).where(F.bitmap_count("_bits") < F.col("_rows"))
                     .select("_b"))
        few = _few(bad)
        if few == []:
            return 0
        df = _in_buckets(df, key, bad, few)
    return unique_violations(df, key).count()


def star_matches(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]],
                 max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                 hot_from: DataFrame | None = None) -> DataFrame:
    """``count(*)`` of ``fact`` inner-joined to every ``(dim, key)``.

    Each dimension is reduced to one row per key with its multiplicity, so
    no join multiplies rows: every fact row carries a weight, the product of
    the multiplicities it meets, and the count is the sum of the weights -
    equal to the row-level inner joins even when a dimension key repeats.

    Dimensions that together fit the broadcast bound are applied first,
    streaming the fact through hash lookups with no shuffle.  Before each remaining
    (shuffled) join the fact is summed down to its distinct remaining keys,
    a map-side partial aggregate, so a hot key or a pile of copies crosses
    the network as one row per task.  ``hot_from`` is a table with the fact's
    keys, read once to find hot ones for all joins; the fact itself is read once.
    """
    counted = []
    # A count table has at most the dimension's rows, each a key and a long:
    # measuring that projection bounds it without running the aggregation.
    fits = fitting_together([dim.select(key, F.lit(0).cast("long").alias("_m"))
                             for dim, key in dims], max_broadcast_bytes)
    for (dim, key), small in zip(dims, fits):
        counted.append((dim.groupBy(key).agg(F.count(F.lit(1)).alias("_m")), key, small))
    acc = fact.select(*[k for _, k in dims], F.lit(1).cast("long").alias("_w"))
    for counts, key, small in counted:
        if small:
            acc = lookup_join(acc, counts, [key], "inner", broadcast=True) \
                .select(*[c for c in acc.columns if c != "_w"],
                        (F.col("_w") * F.col("_m")).alias("_w"))
    remaining = [key for _, key, small in counted if not small]
    hot = dict(zip(remaining, hot_keys(hot_from, [[k] for k in remaining]))) \
        if hot_from is not None else {}
    for counts, key, small in counted:
        if small:
            continue
        acc = acc.groupBy(*remaining).agg(F.sum("_w").alias("_w"))
        acc = lookup_join(acc, counts, [key], "inner", broadcast=False, hot=hot.get(key)) \
            .select(*[k for k in remaining if k != key],
                    (F.col("_w") * F.col("_m")).alias("_w"))
        remaining.remove(key)
    return acc.agg(F.coalesce(F.sum("_w"), F.lit(0)).cast("long").alias("n"))


@dataclass(frozen=True)
class Check:
    """One declared test, as listed in a model's schema file."""

    test: str            # unique | not_null | relationships
    relation: str
    column: str
    to: str | None = None      # relationships: parent relation
    field: str | None = None   # relationships: parent column


def run_checks(relations: dict[str, DataFrame], checks: Iterable[Check],
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
               in_key_order: bool = False) -> DataFrame:
    """Evaluate ``checks`` over named relations; one report row per check.

    A column tested for both ``unique`` and ``not_null`` is profiled once:
    both report rows read the same grouped count, whose shuffle Spark then
    runs a single time (exchange reuse).  With ``in_key_order`` the relations
    are written tables, mostly in key order: ``unique`` then reads the key's
    ranges here and groups only keys where they overlap.
    """
    checks = list(checks)
    tested = {}
    for ch in checks:
        tested.setdefault((ch.relation, ch.column), set()).add(ch.test)
    profiles: dict[tuple[str, str], DataFrame] = {}
    rows = []
    for ch in checks:
        df = relations[ch.relation]
        key = (ch.relation, ch.column)
        if ch.test == "unique" and in_key_order:
            rows.append(unique_by_ranges(df, ch.relation, ch.column))
        elif ch.test in ("unique", "not_null") and not in_key_order \
                and {"unique", "not_null"} <= tested[key]:
            if key not in profiles:
                profiles[key] = key_profile(df, ch.column)
            field = "duplicated" if ch.test == "unique" else "nulls"
            rows.append(_row(profiles[key].select(field), ch.test, ch.relation, ch.column))
        elif ch.test == "unique":
            rows.append(unique(df, ch.relation, ch.column))
        elif ch.test == "not_null":
            rows.append(not_null(df, ch.relation, ch.column))
        elif ch.test == "relationships":
            rows.append(relationships(df, ch.relation, ch.column,
                                      relations[ch.to], ch.field, max_broadcast_bytes))
        else:
            raise ValueError(f"unknown test {ch.test!r}")
    return reduce(DataFrame.unionAll, rows)


def constraint_report(df: DataFrame, relation: str, declared: str | None = None,
                      primary_key: str | None = None,
                      left_out: Sequence[str] = ()) -> DataFrame:
    """Check ``df`` against a declared table: NOT NULL, VARCHAR(n) length,
    NUMERIC(p, s) range and the primary key.

    A declared column that ``df`` lacks is a failure of its own
    (``missing_column``), unless the caller names it in ``left_out``.  All
    row-level checks are counted in one aggregate (one scan); the primary key
    adds one grouped count.  One report row per (column, constraint).
    """
    declared = declared or relation
    pk = primary_key if primary_key is not None else PRIMARY_KEYS.get(declared)
    missing = missing_columns(df, declared, left_out, primary_key)
    labels, aggs = limit_counts(df, declared)
    labels = [("missing_column", c) for c in missing] + labels
    aggs = [F.lit(1).cast("long")] * len(missing) + aggs
    rows: list[DataFrame] = []
    if aggs:
        counts = df.agg(F.count(F.lit(1)), *[a.alias(f"_c{i}") for i, a in enumerate(aggs)])
        stack = ", ".join(
            f"'{t}', '{name}', _c{i}" for i, (t, name) in enumerate(labels)
        )
        rows.append(counts.selectExpr(
            f"stack({len(labels)}, {stack}) AS (test, column_name, failures)"
        ).select(
            "test", F.lit(relation).alias("relation"), "column_name",
            F.col("failures").cast("long").alias("failures"),
        ))
    if pk and pk in df.columns:
        rows.append(unique(df, relation, pk).withColumn("test", F.lit("primary_key")))
    return reduce(DataFrame.unionAll, rows)
