"""Exact quantiles that stay distributed when one group holds most of the rows.

``percentile`` keeps every distinct value of a group in one task. Here the values are first
counted (``group, value -> n``, combined on the map side), then each group's counts are
rolled up into value bins. Running totals over the bins tell which bins hold the wanted
ranks, and only the values of those bins are put in order. No task ever sorts a group:

* the rolled-up step sorts bins, and a bin is a fixed fraction of an octave wide, so their
  number depends on the spread of the values and not on the number of rows;
* the last step sorts the distinct values of the few bins that hold a rank.

That first shuffle holds a row per distinct value. Where nearly every value is distinct,
``distribution_by_scans`` shuffles bins alone: the input is read once more for every step of
refinement, and only rows inside the bins that hold a rank are looked at again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.functions.casts import exprs, interpolated, ratio
from tripgauge.functions.scales import number
from tripgauge.session import scratch_dir

# bins per power of two: few enough that the bins of a group are a small table (minutes of a day
# span 11 octaves), many enough that a bin holds a small part of a group's values
BINS_PER_OCTAVE = 512
_ZERO = 1 << 28  # more than every possible bin of one sign: 2100 octaves
_NAN = 1 << 40
_LARGEST = "1.7976931348623157E308D"


# binary digits of the number of bins per octave, step by step: each step parts a bin in 4096. At the
# last one a bin holds some hundred neighbouring doubles at most
REFINEMENTS = (9, 21, 33, 45)


def value_bin(value: str, per_octave: int = BINS_PER_OCTAVE) -> str:
    """Order-preserving bin of a double: equal or smaller values never get a larger bin.

    With ``per_octave`` a power of two, the bins of a larger one lie inside those of a smaller one.
    """
    zero, nan = (_ZERO, _NAN) if per_octave <= BINS_PER_OCTAVE else (per_octave << 12, 1 << 60)
    size = f"least(abs({value}), {_LARGEST})"  # infinity shares the last bin
    octave = f"CAST(floor(log2({size}) * {per_octave}D) AS BIGINT)"
    return (f"CASE WHEN isnan({value}) THEN {nan}L WHEN {value} = 0 THEN 0L "
            f"WHEN {value} > 0 THEN {zero}L + {octave} ELSE -({zero}L + {octave}) END")


def value_histogram(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per distinct value of each group."""
    return df.groupBy(*keys, F.expr(f"{value} AS value")).agg(*exprs("count(1) AS n"))


_UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_HOLDS_RANK = ("(_before <= floor(_pos) AND floor(_pos) < _upto) OR "
               "(_before <= ceil(_pos) AND ceil(_pos) < _upto)")


def _holding_ranks(bins: DataFrame, keys: Sequence[str], flags: Sequence[str], rows: str, probs: Sequence[float]) -> DataFrame:
    """The bins that hold one of the two neighbouring ranks of a wanted quantile, with the rows before them.

    A group without any value keeps its only bin, so that its rows are still reported.
    """
    group = ", ".join(f"`{k}`" for k in keys)
    whole = f"OVER (PARTITION BY {group})"
    cumulated = bins.selectExpr(
        *keys, "_bin", f"sum(_n) OVER (PARTITION BY {group} ORDER BY _bin {_UPTO}) AS _upto",
        f"_n AS _in_bin", f"sum(_n) {whole} AS _total", f"sum(_rows) {whole} AS {rows}",
        *[f"{ratio(f'sum({f}_true) {whole}', f'sum({f}_known) {whole}')} AS {f}" for f in flags],
    )

    wanted = ", ".join(f"named_struct('q', {i}, 'p', {number(p)})"
                       for i, p in enumerate(probs))
    return cumulated.selectExpr("*", f"explode(array({wanted})) AS _want").selectExpr(
        *keys, "_bin", rows, *flags, "_total", "_upto", "_upto - _in_bin AS _before", "_in_bin",
        "_want.q AS _q", "_want.p * (_total - 1) AS _pos",
    ).where(f"{_HOLDS_RANK} OR _total = 0").drop("_total", "_upto")


def _at_ranks(found: DataFrame, keys: Sequence[str], flags: Sequence[str], shares: Sequence[str], rows: str,
              probs: Sequence[str]) -> DataFrame:
    """Quantiles from the values of the bins that hold their ranks."""
    group = ", ".join(f"`{k}`" for k in keys)
    # equal values may stand in several rows (one per condition outcome): each row takes its
    # own stretch of ranks, so the frame counts rows and not peers
    ranked = found.selectExpr(
        "*", f"_before + sum(_n) OVER (PARTITION BY {group}, _bin, _q ORDER BY _v {_UPTO}) AS _last"
    )
    at = "_last - _n <= {rank} AND {rank} < _last"
    at_low, at_high = at.format(rank="floor(_pos)"), at.format(rank="ceil(_pos)")
    ends = []
    for i in range(len(probs)):
        ends += [
            f"max(CASE WHEN _q = {i} AND {at_low} THEN _v END) AS _lo{i}",
            f"max(CASE WHEN _q = {i} AND {at_high} THEN _v END) AS _hi{i}",
            f"max(CASE WHEN _q = {i} THEN _pos - floor(_pos) END) AS _w{i}",
        ]
    groups = ranked.groupBy(*keys).agg(*exprs(
        f"max({rows}) AS {rows}", *[f"max({f}) AS {f}" for f in flags], *ends))
    return groups.selectExpr(
        *keys, rows,
        *[f"CASE WHEN _w{i} = 0 THEN _lo{i} ELSE {interpolated(f'_lo{i}', f'_hi{i}', f'_w{i}')} "
          f"END AS {name}" for i, name in enumerate(probs)],
        *[f"{f} AS {name}" for f, name in zip(flags, shares)],
    )


def distribution(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
                 shares: Mapping[str, str] | None = None, rows: str = "trips", weight: str = "1L") -> DataFrame:
    """Per group: row count, interpolated quantiles of ``value`` and shares of conditions.

    ``probs`` maps an output name to a probability, ``shares`` an output name to a condition;
    rows where a condition is NULL are left out of its share. A row counts ``weight`` times, so that
    an input may be a histogram itself. The input is read and shuffled
    once: counts, shares and quantiles all come from the same value histogram.
    """
    shares = dict(shares or {})
    flags = [f"_f{i}" for i in range(len(shares))]
    # conditions take part in the grouping: a group of equal rows stays one row, and both
    # uses below read the same shuffle
    hist = (
        df.selectExpr(*keys, f"CAST({value} AS DOUBLE) AS _v", f"{weight} AS _times",
                      *[f"({cond}) AS {f}" for f, cond in zip(flags, shares.values())])
        .groupBy(*keys, "_v", *flags).agg(*exprs("sum(_times) AS _n"))
        .selectExpr("*", f"CASE WHEN _v IS NOT NULL THEN {value_bin('_v')} END AS _bin")
    )

    # 1. bins, their running totals within the group, and the totals of the group
    bins = hist.groupBy(*keys, "_bin").agg(*exprs(
        "sum(_n) AS _rows", "sum(CASE WHEN _v IS NOT NULL THEN _n ELSE 0 END) AS _n",
        *[f"sum(CASE WHEN {f} IS NOT NULL THEN _n END) AS {f}_known" for f in flags],
        *[f"sum(CASE WHEN {f} THEN _n ELSE 0 END) AS {f}_true" for f in flags],
    ))
    # 2. the bins that hold the wanted ranks
    targets = _holding_ranks(bins, keys, flags, rows, list(probs.values()))

    # 3. the values of those bins, ranked; NULL keys match each other
    match = " AND ".join(f"t.`{k}` <=> h.`{k}`" for k in [*keys, "_bin"])
    found = (
        targets.alias("t")
        .join(hist.select(*keys, "_bin", "_v", "_n").alias("h"), F.expr(match))
        .selectExpr(*[f"t.`{k}` AS `{k}`" for k in keys], "t._bin AS _bin", rows, *flags,
                    "_before", "_q", "_pos", "_v", "_n")
        # the bins of a large group go to different tasks
        .repartition(*keys, "_bin")
    )
    return _at_ranks(found, keys, flags, list(shares), rows, list(probs))


def _in_targets(seen: DataFrame, targets: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """Rows of ``seen`` inside a target bin, with that bin. Targets come from files, so Spark knows their size."""
    match = " AND ".join([*[f"t.`{k}` <=> s.`{k}`" for k in keys], "t._bin <=> s._bin"])
    placed = seen.selectExpr(*keys, "_v", f"CASE WHEN _v IS NOT NULL THEN {value_bin('_v', 1 << bits)} END AS _bin")
    return placed.alias("s").join(targets.select(*keys, "_bin").distinct().alias("t"), F.expr(match), "left_semi")


def distribution_by_scans(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
                          shares: Mapping[str, str] | None = None, rows: str = "trips", most_values: int = 1_000_000) -> DataFrame:
    """``distribution`` for values that hardly repeat: what is shuffled are bins, never all values.

    The first scan counts rows per bin. While a bin that holds a wanted rank has more than ``most_values``
    rows, a further scan parts those bins, and only those, in 4096; the last scan reads the values of
    the bins left. Every scan combines before its shuffle, so a value that fills its bin costs one row.
    The bins looked for are written to the shared folder between scans (at most two per group and
    quantile), hence jobs run when this is called; df must give the same rows each time it is read.
    """
    spark, shares = df.sparkSession, dict(shares or {})
    flags = [f"_f{i}" for i in range(len(shares))]
    seen = df.selectExpr(*keys, f"CAST({value} AS DOUBLE) AS _v", *[f"({cond}) AS {f}" for f, cond in zip(flags, shares.values())])

    def written(targets: DataFrame) -> DataFrame:
        path = scratch_dir(spark, "quantile-bins")
        targets.write.parquet(path)
        return spark.read.schema(targets.schema).parquet(path)

    first, *finer = REFINEMENTS
    bins = seen.groupBy(*keys, F.expr(f"CASE WHEN _v IS NOT NULL THEN {value_bin('_v', 1 << first)} END AS _bin")).agg(*exprs(
        "count(1) AS _rows", "count(_v) AS _n",
        *[f"count({f}) AS {f}_known" for f in flags], *[f"count_if({f}) AS {f}_true" for f in flags]))
    targets, at = written(_holding_ranks(bins, keys, flags, rows, list(probs.values()))), first
    kept = [*[f"t.`{k}` AS `{k}`" for k in keys], *[f"t.{c} AS {c}" for c in (rows, *flags, "_q", "_pos")]]
    match = " AND ".join(f"t.`{k}` <=> h.`{k}`" for k in [*keys, "_bin"])
    for bits in finer:
        if (targets.agg(F.max("_in_bin")).first()[0] or 0) <= most_values:
            break
        parts = _in_targets(seen, targets, keys, at).groupBy(
            *keys, "_bin", F.expr(f"CASE WHEN _v IS NOT NULL THEN {value_bin('_v', 1 << bits)} END AS _part")).agg(*exprs("count(_v) AS _n"))
        within = ", ".join(f"t.`{c}`" for c in [*keys, "_bin", "_q"])
        upto = f"t._before + sum(h._n) OVER (PARTITION BY {within} ORDER BY h._part {_UPTO})"
        parted = targets.alias("t").join(parts.alias("h"), F.expr(match)).selectExpr(
            *kept, "h._part AS _bin", "h._n AS _in_bin", f"{upto} AS _upto")
        targets, at = written(parted.selectExpr("*", "_upto - _in_bin AS _before").where(f"{_HOLDS_RANK} OR _bin IS NULL").drop("_upto")), bits
    values = _in_targets(seen, targets, keys, at).groupBy(*keys, "_bin", "_v").agg(*exprs("count(_v) AS _n"))
    found = targets.alias("t").join(values.alias("h"), F.expr(match)).selectExpr(*kept, "t._bin AS _bin", "t._before AS _before", "h._v AS _v", "h._n AS _n")
    return _at_ranks(found, keys, flags, list(shares), rows, list(probs))
