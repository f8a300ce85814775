"""Data-quality checks; each returns a small DataFrame of findings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from salesloom.functions.dates import parse_date
from salesloom.operators.keys import ROW_BITS


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _null_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]


def null_report(df: DataFrame, name: str) -> DataFrame:
    """NULLs per column that has any, in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *_null_counts(df))
    return (
        counted.unpivot("_rows", list(df.columns), "column", "nulls")
        .filter("nulls > 0")
        .select(
            F.lit(name).alias("dataset"),
            "column",
            "nulls",
            F.round(F.col("nulls").cast("decimal(20,0)") * 100 / F.col("_rows"), 1).alias("null_pct"),
        )
    )


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def hash_counts(df: DataFrame) -> DataFrame:
    """One row: rows, NULL cells, and the row hashes that more than one row has. Only a hash per row is shuffled."""
    nulls = reduce(lambda total, c: total + F.col(f"`{c}`").isNull().cast("int"), df.columns, F.lit(0))
    per_hash = df.select(_row_hash(df).alias("hash"), nulls.alias("nulls")).groupBy("hash")
    counted = per_hash.agg(F.count(F.lit(1)).alias("copies"), F.sum("nulls").alias("nulls"))
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("copies", "rows"), ("nulls", "nulls"))]
    return counted.agg(*totals, F.count_if(F.col("copies") > 1).alias("repeated"))


def full_row_copies(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one.

    Equal rows have equal hashes, so just the rows behind repeated hashes are compared in full, which keeps the
    count exact whatever the hash does.
    """
    hashed = df.withColumn("_hash", _row_hash(df))
    repeated = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("_hash")
    same = hashed.join(repeated, "_hash", "left_semi").groupBy(*[F.col(f"`{c}`") for c in df.columns])
    return same.agg((F.count(F.lit(1)) - 1).alias("extra")).agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicates"))


def quality_report(datasets: dict[str, DataFrame], max_null_percent: float = 5.0) -> DataFrame:
    """Rows, mean share of NULLs, full-row repeats and a verdict per dataset, and a TOTAL row.

    The first read of the datasets runs when this is called and brings a row per dataset to the driver; only datasets where
    a row hash repeats are read again.
    """
    counts = _union([hash_counts(df).select(F.lit(name).alias("dataset"), "rows", "nulls", "repeated") for name, df in datasets.items()])
    widths = {name: len(df.columns) for name, df in datasets.items()}
    first = {r["dataset"]: r for r in counts.collect()}
    spark = next(iter(datasets.values())).sparkSession
    known = spark.createDataFrame(
        [(name, width, first[name]["rows"], first[name]["nulls"]) for name, width in widths.items()],
        "dataset string, width int, rows bigint, nulls bigint",
    )
    repeats = [
        full_row_copies(df).select(F.lit(name).alias("dataset"), "duplicates")
        for name, df in datasets.items()
        if first[name]["repeated"]
    ]
    if repeats:
        found = known.join(_union(repeats), "dataset", "left").withColumn("duplicates", F.coalesce("duplicates", F.lit(0)))
    else:
        found = known.withColumn("duplicates", F.lit(0).cast("bigint"))
    cells = (F.col("rows") * F.col("width")).cast("decimal(20,0)")
    share = F.try_divide(F.col("nulls").cast("decimal(20,0)") * 100, cells)
    passed = (F.coalesce(share, F.lit(0)) < max_null_percent) & (F.col("duplicates") == 0)
    judged = found.withColumns({"null_pct": F.round(share, 1).cast("decimal(5,1)"), "status": F.when(passed, "PASS").otherwise("CHECK")})
    # Rolled up, so that the total does not compute every dataset again.
    single = lambda c: F.when(F.grouping("dataset") == 0, F.max(c)).alias(c)
    rolled = judged.rollup("dataset").agg(F.sum("rows").alias("rows"), *[single(c) for c in ("null_pct", "duplicates", "status")])
    return rolled.withColumn("dataset", F.coalesce("dataset", F.lit("TOTAL")))


def date_parse_report(raw: DataFrame, source: str, columns: Sequence[str]) -> DataFrame:
    """Dates that became NULL: how many were unreadable, how many were missing to begin with."""
    counts = []
    for c in columns:
        parsed = parse_date(raw, c)
        unreadable = F.count_if(F.col(c).isNotNull() & parsed.isNull()).cast("bigint")
        missing = F.count_if(F.col(c).isNull()).cast("bigint")
        counts.append(
            F.struct(
                F.lit(source).alias("source"), F.lit(c).alias("column"),
                unreadable.alias("unreadable"), missing.alias("missing"), (unreadable + missing).alias("null_dates"),
            )
        )
    return raw.agg(F.array(*counts).alias("findings")).selectExpr("inline(findings)")


@dataclass(frozen=True)
class Reference:
    """A column that must point at a row of another table."""

    label: str
    child: DataFrame
    parent: DataFrame
    key: str
    parent_key: str | None = None


def orphan_keys(ref: Reference) -> DataFrame:
    """Keys without a parent and how many rows use each.

    Rows collapse per key before the anti join, so a key with very many rows costs one row.
    """
    used = ref.child.groupBy(F.col(ref.key).alias("key")).agg(F.count(F.lit(1)).alias("child_rows"))
    known = ref.parent.select(F.col(ref.parent_key or ref.key).alias("key"))
    return used.join(known, "key", "left_anti")


def _key_columns(references: Sequence[Reference]) -> dict[tuple[int, str], list[Reference]]:
    """The references of each distinct child column; a child is known by its identity."""
    columns: dict[tuple[int, str], list[Reference]] = {}
    for r in references:
        columns.setdefault((id(r.child), r.key), []).append(r)
    return columns


def _used_keys(columns: dict[tuple[int, str], list[Reference]], key_type: T.DataType) -> DataFrame:
    """A row (column, key, child_rows) per child column and key; each child is read once for all its columns."""
    tagged = []
    for child in dict.fromkeys(child for child, _ in columns):
        numbers = {str(n): key for n, (owner, key) in enumerate(columns) if owner == child}
        frame = next(asked[0].child for (owner, _), asked in columns.items() if owner == child)
        keys = frame.select(*[F.col(key).cast(key_type).alias(n) for n, key in numbers.items()])
        tagged.append(keys.unpivot([], list(numbers), "column", "key"))
    per_key = _union(tagged).groupBy(F.col("column").cast("int").alias("column"), "key")
    return per_key.agg(F.count(F.lit(1)).alias("child_rows"))


def orphan_checks(references: Sequence[Reference]) -> DataFrame:
    """Rows per reference whose key has no parent, NULL keys included.

    The distinct keys of all child columns are taken in one pass over each child, tagged by column, and those of all
    parents likewise, with a bit for each parent that has them. Both sides are then partitioned alike, so that one
    join without a further shuffle answers all references. Integer keys are compared as 64 bits; if any key is
    something else, all are compared as text, so both ends of a reference should have one type.
    """
    columns = _key_columns(references)
    parents = [r.parent.select(F.col(r.parent_key or r.key)) for r in references]
    types = [r.child.schema[r.key].dataType for r in references] + [p.schema[0].dataType for p in parents]
    key_type = T.LongType() if all(isinstance(t, T.IntegralType) for t in types) else T.StringType()
    if any(len(asked) > 63 for asked in columns.values()):
        raise ValueError("a column can be checked against at most 63 parents")
    known = _union(
        [
            r.parent.select(
                F.lit(number).alias("column"),
                F.col(r.parent_key or r.key).cast(key_type).alias("key"),
                F.lit(1 << bit).cast("bigint").alias("parents"),
            )
            for number, asked in enumerate(columns.values())
            for bit, r in enumerate(asked)
        ]
    )
    # A parent's NULL key matches nothing; without this filter all of them would be one key's rows.
    known = known.filter("key IS NOT NULL").groupBy("column", "key").agg(F.bit_or("parents").alias("parents"))
    resolved = _used_keys(columns, key_type).join(known, ["column", "key"], "left")
    had = F.coalesce("parents", F.lit(0))
    findings = []
    for number, asked in enumerate(columns.values()):
        for bit, r in enumerate(asked):
            orphan = (F.col("column") == number) & (had.bitwiseAND(F.lit(1 << bit)) == 0)
            orphans = F.coalesce(F.sum(F.when(orphan, F.col("child_rows"))), F.lit(0))
            findings.append((references.index(r), F.struct(F.lit(r.label).alias("check"), orphans.alias("orphans"))))
    ordered = [finding for _, finding in sorted(findings, key=lambda f: f[0])]
    status = F.when(F.col("orphans") == 0, F.lit("OK")).otherwise(
        F.concat(F.col("orphans").cast("string"), F.lit(" orphans"))
    )
    return resolved.agg(F.array(*ordered).alias("findings")).select(F.inline("findings")).withColumn("status", status)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def missing_values(df: DataFrame, dataset: str, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL in columns that must be filled, zero included."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "nulls").select(F.lit(dataset).alias("dataset"), "column", "nulls")


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted set, NULL included, with their row counts."""
    outside = ~F.coalesce(F.col(column).isin(*accepted), F.lit(False))
    return (
        df.filter(outside)
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(column).alias("column"), "value", "rows")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def broken_rules(df: DataFrame, dataset: str, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules in one pass. A rule states what must hold."""
    counted = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations").select(
        F.lit(dataset).alias("dataset"), "rule", "violations"
    )


def identity_breaks(df: DataFrame, left: Column, right: Column, tolerance: int = 1) -> DataFrame:
    """Rows whose two sides, each rounded to one decimal, differ by the tolerance or more."""
    return df.filter(F.abs(F.round(left, 1) - F.round(right, 1)) >= tolerance)


def expected_rows(expectations: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows of each table beside the number that another table, of one row and column, says it must have."""
    counts = [
        df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("rows")).withColumn("expected", wanted.scalar().cast("bigint"))
        for name, (df, wanted) in expectations.items()
    ]
    return _union(counts).withColumn("holds", F.col("rows") == F.col("expected"))


def order_inversions(ordered: DataFrame, measure: str) -> DataFrame:
    """How often a table that should fall by `measure` rises from one row to the next.

    Rows are compared inside the partitions they were sorted into; between partitions only the
    last and first values meet, one row per partition.
    """
    placed = ordered.select(F.col(measure).alias("v"), F.monotonically_increasing_id().alias("place"))
    placed = placed.withColumn("part", F.shiftright("place", ROW_BITS))
    before = F.lag("v").over(W.partitionBy("part").orderBy("place"))
    parts = (
        placed.withColumn("before", before)
        .groupBy("part")
        .agg(
            F.count_if(F.col("v") > F.col("before")).alias("inside"),
            F.min_by("v", "place").alias("first"),
            F.max_by("v", "place").alias("last"),
        )
        .withColumn("previous_last", F.lag("last").over(W.orderBy("part")))
    )
    between = F.count_if(F.col("first") > F.col("previous_last"))
    return parts.agg((F.coalesce(F.sum("inside"), F.lit(0)) + between).alias("inversions"))


def key_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def more_rows_than(df: DataFrame, other: DataFrame) -> DataFrame:
    """Row counts of both tables and whether the first has more."""
    left = df.agg(F.count(F.lit(1))).scalar()
    right = other.agg(F.count(F.lit(1))).scalar()
    return df.sparkSession.range(1).select(
        left.alias("rows"), right.alias("other_rows"), (left > right).alias("holds")
    )


def ids_without_match(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Distinct ids of the first table that the second does not have."""
    return df.select(key).subtract(other.select(key))


def headline_sanity(cards: DataFrame) -> DataFrame:
    return broken_rules(
        cards,
        "kpi_cards",
        {
            "revenue_positive": F.col("total_revenue") > 0,
            "profit_below_revenue": F.col("total_profit") < F.col("total_revenue"),
            "margin_between_0_and_100": (F.col("avg_margin") > 0) & (F.col("avg_margin") < 100),
            "orders_positive": F.col("total_orders") > 0,
            "customers_positive": F.col("unique_customers") > 0,
            "units_positive": F.col("total_units") > 0,
        },
    )


def tables_present(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Whether each table or view is known to the session."""
    found = [(name, spark.catalog.tableExists(name)) for name in names]
    return spark.createDataFrame(found, "name string, present boolean")
