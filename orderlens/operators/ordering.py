"""Ranks, running totals, carried values and order statistics without a single-task window.

The shared idea: cut the order into buckets, do the work inside each bucket in parallel,
then add what the earlier buckets contribute. The bucket table is small next to the data,
so no task ever sees a whole key, even when one key holds a third of all rows.
"""

from __future__ import annotations

import math

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.session import bounded_rows

BEFORE = (W.unboundedPreceding, -1)
UP_TO = (W.unboundedPreceding, 0)

# A lookup key is "hot" above this share of the rows; fewer than HOT_KEYS keys can be.
HOT_KEYS = 1000


def hash_key(identifier: str, seed: int) -> Column:
    """Portable, partition-independent shuffle order of ids."""
    return F.md5(F.concat(F.col(identifier).cast("string"), F.lit(f":{seed}")))


# Rows of a hash bucket that one task ranks, about; a bucket that holds more is cut further.
RANKED = 1_000_000


def bucket_digits(rows: int) -> int:
    """Hex digits that give buckets of at most RANKED rows on average; from 3 to 5, as the
    table of buckets is ordered as a whole."""
    return min(5, max(3, math.ceil(math.log(max(rows, 1) / RANKED, 16))))


def hash_rank(df: DataFrame, identifier: str, seed: int, by: list[str] | None = None,
              name: str = "rank", digits: int = 3) -> DataFrame:
    """1-based rank of every row in hashed order, optionally within groups.

    Rows are ranked inside 16**digits hash buckets, then shifted by the sizes of the
    buckets before. Hashes spread evenly, so the buckets do too.
    """
    by = by or []
    keyed = df.withColumn("_h", hash_key(identifier, seed)).withColumn(
        "_b", F.substring("_h", 1, digits))
    inner = keyed.withColumn(
        "_r", F.row_number().over(W.partitionBy(*by, "_b").orderBy("_h", identifier)))
    sizes = inner.groupBy(*by, "_b").agg(F.max("_r").alias("_n"))
    partition = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    offsets = sizes.select(*by, "_b", F.coalesce(
        F.sum("_n").over(partition.orderBy("_b").rowsBetween(*BEFORE)), F.lit(0)
    ).alias("_o"))
    return (
        inner.join(offsets, [*by, "_b"])
        .withColumn(name, F.col("_o") + F.col("_r"))
        .drop("_h", "_b", "_r", "_o"))


def hash_cuts(df: DataFrame, identifier: str, label: str, seed: int, quotas: dict,
              digits: int = 3) -> dict:
    """For each class, the hash below or at which exactly ``quota`` rows lie.

    ``quotas`` maps class -> list of row counts. A counting pass finds the hash bucket that
    holds each cut, and further passes cut buckets of more than RANKED rows finer; only the
    last ones are ranked. The caller then splits with a plain comparison, so the split itself
    moves no data.
    """
    keyed = df.select(label, hash_key(identifier, seed).alias("_h"))
    spark, kind = df.sparkSession, keyed.schema[label].dataType.simpleString()
    # (class, bucket so far, rows wanted inside it, rows wanted in all)
    wanted = [(cls, "", count, count) for cls, counts in quotas.items()
              for count in sorted(set(counts)) if count > 0]
    length, largest = 0, None
    while wanted and (largest is None or largest > RANKED) and length < 30:
        length += digits
        known = spark.createDataFrame(sorted({w[:2] for w in wanted}, key=str),
                                      f"_c {kind}, _in string")
        inside = F.col(label).eqNullSafe(F.col("_c")) & F.col("_h").startswith(F.col("_in"))
        sizes = keyed.join(F.broadcast(known), inside, "left_semi").groupBy(
            label, F.substring("_h", 1, length).alias("_b")).count()
        rows = bounded_rows(sizes, len(wanted) * 16 ** digits, "hash buckets per class")
        finer, largest = [], 0
        for cls, bucket, left, count in wanted:
            for name, n in sorted((r["_b"], r["count"]) for r in rows
                                  if r[label] == cls and r["_b"].startswith(bucket)):
                if left <= n:
                    finer.append((cls, name, left, count))
                    largest = max(largest, n)
                    break
                left -= n
        wanted = finer
    keyed = keyed.withColumn("_b", F.substring("_h", 1, length))
    cuts = {cls: {0: ""} for cls in quotas}
    if not wanted:
        return cuts
    targets = spark.createDataFrame(wanted, f"_c {kind}, _in string, _k bigint, _q bigint")
    # NULL is a class like any other.
    same = F.col(label).eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_in"))
    ranked = keyed.join(F.broadcast(targets.select("_c", "_in").distinct()), same, "left_semi") \
        .withColumn("_r", F.row_number().over(W.partitionBy(label, "_b").orderBy("_h")))
    found = ranked.join(F.broadcast(targets), same & (F.col("_r") == F.col("_k")))
    for r in bounded_rows(found.select(label, "_q", "_h"), len(wanted), "cut hashes"):
        cuts[r[label]][r["_q"]] = r["_h"]
    return cuts


def running_totals(df: DataFrame, key: list[str], order: list[str], bucket: Column,
                   totals: dict[str, Column], firsts: dict[str, Column] | None = None,
                   side: DataFrame | None = None) -> DataFrame:
    """Sums over all earlier rows of the same key, excluding the row itself.

    ``bucket`` must not decrease along ``order`` (a day of the order time, say). ``firsts``
    adds the key-wide minimum of a column. ``side`` has one row per key; it is joined to the
    bucket table, so a hot key never meets it row by row.
    """
    keyed = df.withColumn("_b", bucket)
    within = W.partitionBy(*key, "_b").orderBy(*order)
    for name, expr in totals.items():
        keyed = keyed.withColumn(f"_v_{name}", expr.cast("bigint"))
    inner = keyed
    for name in totals:
        inner = inner.withColumn(
            f"_c_{name}", F.sum(f"_v_{name}").over(within.rowsBetween(*UP_TO)))
    per_bucket = inner.groupBy(*key, "_b").agg(
        *[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in totals],
        *[F.min(expr).alias(name) for name, expr in (firsts or {}).items()])
    across = W.partitionBy(*key).orderBy("_b")
    offsets = per_bucket.select(
        *key, "_b",
        *[F.coalesce(F.sum(f"_t_{name}").over(across.rowsBetween(*BEFORE)), F.lit(0))
          .alias(f"_o_{name}") for name in totals],
        *[F.min(name).over(W.partitionBy(*key)).alias(name) for name in (firsts or {})])
    if side is not None:
        offsets = offsets.join(side, key, "left")
    out = inner.join(offsets, [*key, "_b"])
    for name in totals:
        out = out.withColumn(
            name, F.col(f"_o_{name}") + F.col(f"_c_{name}") - F.col(f"_v_{name}"))
    return out.drop("_b", *[f"_{p}_{n}" for n in totals for p in "vco"])


def carry_forward(df: DataFrame, key: list[str], order: list[str], bucket: Column,
                  values: list[str], before: bool = False) -> DataFrame:
    """Last non-NULL value so far per key, for several columns at once, as ``<value>_now``.

    Inside a bucket an ordinary window; across buckets only the last value of each bucket
    travels. ``before`` adds ``<value>_before``, which looks strictly before the row. The
    input is read twice (rows and bucket table), so stage it when it is expensive.
    """
    keyed = df.withColumn("_b", bucket)
    within = W.partitionBy(*key, "_b").orderBy(*order)
    frames = {"now": within.rowsBetween(*UP_TO)}
    if before:
        frames["before"] = within.rowsBetween(*BEFORE)
    inner = keyed.select("*", *[
        F.last(v, ignorenulls=True).over(frame).alias(f"_{name}_{v}")
        for name, frame in frames.items() for v in values])
    # The last value of a bucket, with NULLs skipped, straight from the rows.
    per_bucket = keyed.groupBy(*key, "_b").agg(*[
        F.max_by(v, F.when(F.col(v).isNotNull(), F.struct(*order))).alias(f"_last_{v}")
        for v in values])
    across = W.partitionBy(*key).orderBy("_b").rowsBetween(*BEFORE)
    prior = per_bucket.select(
        *key, "_b",
        *[F.last(f"_last_{v}", ignorenulls=True).over(across).alias(f"_prior_{v}")
          for v in values])
    return inner.join(prior, [*key, "_b"]).select(*df.columns, *[
        F.coalesce(f"_{name}_{v}", f"_prior_{v}").alias(f"{v}_{name}")
        for name in frames for v in values])


def carry_within(df: DataFrame, key: list[str], order: list[str], values: list[str],
                 before: bool = False) -> DataFrame:
    """``carry_forward`` for keys whose rows all lie in one bucket: a window and no join, so
    several of them in a row share one shuffle and one sort."""
    within = W.partitionBy(*key).orderBy(*order)
    frames = {"now": within.rowsBetween(*UP_TO)}
    if before:
        frames["before"] = within.rowsBetween(*BEFORE)
    return df.select("*", *[F.last(v, ignorenulls=True).over(frame).alias(f"{v}_{name}")
                            for name, frame in frames.items() for v in values])


def time_bucket(df: DataFrame, key: list[str], at: str, most: int = 100_000) -> Column:
    """The widest of day, hour, minute, second and microsecond in which no key has more than
    ``most`` rows, as a bucket that does not decrease along the time."""
    for unit in ("day", "hour", "minute", "second"):
        bucket = F.date_trunc(unit, at)
        sizes = df.groupBy(*key, bucket.alias("_b")).agg(F.count("*").alias("_n"))
        if sizes.where(F.col("_n") > most).isEmpty():
            return bucket
    return F.col(at).cast("timestamp")


def turn_number(df: DataFrame, key: list[str], order: list[str], bucket: Column,
                name: str = "turn") -> DataFrame:
    """0-based position of a row within its key."""
    return running_totals(df, key, order, bucket, {name: F.lit(1)})


def segmented_lists(df: DataFrame, key: list[str], position: Column, fields: list[str],
                    size: int, name: str = "items") -> DataFrame:
    """The rows of every key as lists of at most ``size``, in the order of their 0-based
    position: (key, segment, previous, n, items).

    ``previous`` points to the segment before, NULL for the first, so a reader follows as much
    of a long list as it needs and no task ever holds a whole one.
    """
    rows = df.select(*key, position.alias("_p"), F.struct(
        position.alias("position"), *fields).alias("_row"))
    return rows.groupBy(*key, F.floor(F.col("_p") / size).cast("bigint").alias("segment")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list("_row")).alias(name)).select(
        *key, "segment", F.when(F.col("segment") > 0, F.col("segment") - 1).alias("previous"),
        "n", name)


def hot_keys(facts: DataFrame, key: str) -> DataFrame:
    """Keys that hold more than 1/HOT_KEYS of the rows, so fewer than HOT_KEYS of them."""
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = facts.agg(F.count("*").alias("n"))
    return counts.where(F.col("_n") * HOT_KEYS > total.scalar()).select(key)


def skewed_lookup(facts: DataFrame, dim: DataFrame, key: str,
                  hot: DataFrame | None = None) -> DataFrame:
    """Left join to a table with unique, non-negative integer (or any string) keys.

    Hot keys are answered by a broadcast of their few rows, which the pigeonhole bound keeps
    under HOT_KEYS; a hot key that the table lacks is among them. Their rows and NULL keys then go to the shuffle join under a spread,
    unmatchable key, so no task collects them. ``hot`` names the hot keys where they are
    known already; otherwise they are counted.
    """
    fields = [c for c in dim.columns if c != key]
    known = hot if hot is not None else hot_keys(facts, key)
    present = dim.join(F.broadcast(known), key, "left_semi").select(
        F.col(key), F.struct(*fields).alias("_hot"))
    # A hot key without a row is answered too: by nothing.
    hot = known.join(present, key, "left").withColumn("_met", F.lit(True))
    cold = dim.select(F.col(key).alias("_k"), F.struct(*fields).alias("_cold"))
    spread = F.xxhash64(*facts.columns)
    if dict(facts.dtypes)[key] == "string":
        away = F.concat(F.lit("\u0000"), spread.cast("string"))
    else:
        away = (-1 - F.pmod(spread, F.lit(2 ** 31 - 1))).cast(dict(facts.dtypes)[key])
    joined = facts.join(F.broadcast(hot), key, "left").withColumn(
        "_k", F.when(F.col("_met") | F.col(key).isNull(), away).otherwise(F.col(key)))
    out = joined.join(cold, "_k", "left").withColumn("_got", F.coalesce("_hot", "_cold"))
    return out.select(*facts.columns, *[F.col(f"_got.{f}").alias(f) for f in fields])


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int | Column,
                  name: str = "rank") -> DataFrame:
    """First k rows per group. A constant k is pruned map-side before the shuffle."""
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col(name) <= k)


# A position is looked up among at most this many values on the driver.
INSIDE = 10_000


def exact_positions(df: DataFrame, positions: dict[str, list], accuracy: int = 10_000
                    ) -> dict[str, list[tuple]]:
    """Exact order statistics of several columns, whatever the row count.

    ``positions[col]`` is a list of functions n -> 0-based position among the n values that
    are neither NULL nor NaN, or plain integers. Returns (value, offset among the rows equal
    to it, number of rows equal to it), None where there is no such position.

    Each round asks a sketch for two values around the position and counts exactly how many
    rows lie below and at them. Either value may be the answer; otherwise the position lies
    strictly between them, or outside. The open interval shrinks with every round because the
    values asked for lie inside it, so the search ends; intervals of few rows are read out.
    """
    def usable(c: str) -> Column:
        kind = dict(df.dtypes)[c]
        return F.when(~F.isnan(c), F.col(c)) if kind in ("double", "float") else F.col(c)

    whole = {c for c in positions if dict(df.dtypes)[c] in ("bigint", "int", "smallint", "tinyint")}
    first = df.agg(
        *[F.count(usable(c)).alias(c) for c in positions],
        *[F.min(c).alias(f"{c}|min") for c in whole],
        *[F.max(c).alias(f"{c}|max") for c in whole]).first()
    n = {c: first[c] for c in positions}
    # (column, place) -> position, open interval, rows at or below its lower end, rows in it.
    search = {}
    out: dict[str, list] = {c: [None] * len(ps) for c, ps in positions.items()}
    for c, ps in positions.items():
        for i, p in enumerate(ps):
            at = p(n[c]) if callable(p) else p
            if n[c] and 0 <= at < n[c]:
                ends = (first[f"{c}|min"] - 1, first[f"{c}|max"] + 1) if c in whole else (None, None)
                search[c, i] = (at, *ends, 0, n[c])
    while search:
        inside = {}
        for (c, i), (_, low, high, _, _) in search.items():
            x = usable(c)
            if low is not None:
                x = F.when(x > low, x)
            inside[c, i] = x if high is None else F.when(x < high, x)
        few = [k for k in search if search[k][4] <= INSIDE]
        if few:
            for k, found in _read_out(df, {k: inside[k] for k in few}, search).items():
                out[k[0]][k[1]] = found
                del search[k]
            continue
        probes = {}
        # The sketch computes in doubles, so integers are taken from their lower end.
        sketch = df.agg(*[F.percentile_approx(
            F.try_subtract(inside[k], F.lit(low)) if k[0] in whole else inside[k],
            F.array(*[F.lit(q) for q in _around(at - base, rows, accuracy)]), F.lit(accuracy))
            .alias(f"{k[0]}|{k[1]}") for k, (at, low, _, base, rows) in search.items()]).first()
        for k, (_, low, high, _, _) in search.items():
            found = sketch[f"{k[0]}|{k[1]}"]
            if k[0] in whole:
                found = [min(max(low + int(v), low + 1), high - 1) for v in found]
            probes[k] = sorted(set(found))
        counts = df.agg(*[
            F.count(F.when(test(usable(k[0]), v), 1)).alias(f"{k[0]}|{k[1]}|{j}|{name}")
            for k, vs in probes.items() for j, v in enumerate(vs)
            for name, test in (("below", lambda x, v: x < v), ("upto", lambda x, v: x <= v))
        ]).first()
        for k, vs in probes.items():
            at, low, high, base, rows = search.pop(k)
            top = base + rows
            for j, v in enumerate(vs):
                below, upto = (counts[f"{k[0]}|{k[1]}|{j}|{name}"] for name in ("below", "upto"))
                if below <= at < upto:
                    out[k[0]][k[1]] = (v, at - below, upto - below)
                    break
                if upto <= at:
                    low, base = v, upto
                else:
                    high, top = v, below
                    break
            if out[k[0]][k[1]] is None:
                search[k] = (at, low, high, base, top - base)
    return out


def _around(place: int, rows: int, accuracy: int) -> list[float]:
    """Shares a little below and above a position; the sketch is within 1/accuracy ranks."""
    slack = 2.0 / accuracy
    return [max(0.0, place / rows - slack), min(1.0, place / rows + slack)]


def _read_out(df: DataFrame, inside: dict[tuple, Column], search: dict) -> dict[tuple, tuple]:
    """Answers of intervals with at most INSIDE rows, from one pass over the rows."""
    names = {f"{c}|{i}": (c, i) for c, i in inside}
    wide = {"double": [], "bigint": []}
    for (c, i), x in inside.items():
        kind = "bigint" if dict(df.dtypes)[c] in ("bigint", "int", "smallint", "tinyint") \
            else "double"
        wide[kind].append(F.struct(F.lit(f"{c}|{i}").alias("w"), x.cast(kind).alias("v")))
    found: dict[tuple, list] = {k: [] for k in inside}
    for entries in filter(None, wide.values()):
        rows = df.select(F.explode(F.filter(F.array(*entries), lambda e: e["v"].isNotNull()))
                         .alias("e")).groupBy("e.w", "e.v").count().collect()
        for r in rows:
            found[names[r["w"]]].append((r["v"], r["count"]))
    out = {}
    for k, values in found.items():
        at, _, _, seen, _ = search[k]
        for v, count in sorted(values):
            if seen <= at < seen + count:
                out[k] = (v, at - seen, count)
                break
            seen += count
    return out


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Interpolating medians of many columns at once."""
    found = exact_positions(df, {c: [lambda n: (n - 1) // 2, lambda n: n // 2] for c in cols})
    return {c: (pair[0][0] + pair[1][0]) / 2 if pair[0] else None for c, pair in found.items()}


def all_of(conditions: list[Column]) -> Column:
    """Conjunction of the conditions; true for none."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
