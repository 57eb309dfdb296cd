"""Feature drift between a reference and a current data set.

Input is one frame holding both sides, with a boolean column that is true for
the reference rows. All features are tested in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.functions.numeric import ratio
from duewatch.functions.pvalues import chi_square_tail, ks_tail
from duewatch.operators.ranking import (
    SLICE,
    in_slices,
    inside_slice,
    sliced_quantiles,
    slices_before,
    staged_counts,
)
from duewatch.session import staged

# Fixed values.
SIGNIFICANCE = 0.05
KS_NAME = "Kolmogorov-Smirnov"
CHI2_NAME = "Chi-squared"
NOT_APPLICABLE = "Test not applicable"


def long_values(both: DataFrame, side: str, features: list[str], kind: str) -> DataFrame:
    """One row per feature and known value."""
    typed = both.select(F.col(side), *[F.col(f"`{name}`").cast(kind).alias(name) for name in features])
    values = typed.unpivot([side], [F.col(f"`{name}`") for name in features], "feature", "value")
    known = F.col("value").isNotNull()
    return values.where(known & ~F.isnan("value") if kind == "double" else known)


def side_counts(side: str) -> list:
    return [F.count_if(F.col(side)).alias("_ref"), F.count_if(~F.col(side)).alias("_cur")]


def side_totals(both: DataFrame, side: str, features: list[str], kind: str) -> DataFrame:
    """Known values per feature and side: one row per feature, from one pass without a shuffle of rows."""
    counts, records = [], []
    for place, name in enumerate(features):
        value = F.col(f"`{name}`").cast(kind)
        known = value.isNotNull() & ~F.isnan(value) if kind == "double" else value.isNotNull()
        counts += [
            F.count_if(F.col(side) & known).cast("double").alias(f"ref_{place}"),
            F.count_if(~F.col(side) & known).cast("double").alias(f"cur_{place}"),
        ]
        records.append(
            F.struct(
                F.lit(name).alias("feature"), F.col(f"ref_{place}").alias("_n_ref"), F.col(f"cur_{place}").alias("_n_cur")
            )
        )
    return both.agg(*counts).select(F.inline(F.array(*records)))


def for_every_feature(tested: DataFrame, features: list[str]) -> DataFrame:
    """The test results with a row for features without any known value, too."""
    listed = tested.sparkSession.createDataFrame([(name,) for name in features], "feature string")
    return listed.join(tested, "feature", "left").withColumn(
        "drift_detected", F.coalesce("drift_detected", F.lit(False))
    )


def ks_test(both: DataFrame, side: str, features: list[str], law: str = "asymptotic") -> DataFrame:
    """Largest distance between the two distribution functions of every numeric feature.

    The p-value follows one ``law`` at every size: asymptotic, one_sample or exact (see ``ks_tail``). A feature without known values on a side has none.
    """
    values = long_values(both, side, features, "double")
    counts = values.groupBy("feature", "value").agg(*side_counts(side))
    # One row per feature, so never larger than the column count.
    totals = F.broadcast(side_totals(both, side, features, "double"))
    sliced = in_slices(counts, ["feature"], "value").join(totals, "feature")
    frame = inside_slice(["feature"], "value")
    gap = ratio(F.sum("_ref").over(frame), F.col("_n_ref")) - ratio(F.sum("_cur").over(frame), F.col("_n_cur"))
    slices = (
        sliced.withColumn("_gap", gap)
        .groupBy("feature", SLICE)
        .agg(
            F.max("_gap").alias("_highest"),
            F.min("_gap").alias("_lowest"),
            F.sum("_ref").alias("_ref"),
            F.sum("_cur").alias("_cur"),
            F.max("_n_ref").alias("_n_ref"),
            F.max("_n_cur").alias("_n_cur"),
        )
    )
    earlier = slices_before(["feature"])
    start = F.coalesce(
        ratio(F.sum("_ref").over(earlier), F.col("_n_ref")) - ratio(F.sum("_cur").over(earlier), F.col("_n_cur")),
        F.lit(0.0),
    )
    widest = F.greatest(F.col("_start") + F.col("_highest"), -(F.col("_start") + F.col("_lowest")))
    tested = (
        slices.withColumn("_start", start)
        .groupBy("feature")
        .agg(
            F.max(widest).alias("statistic"),
            F.max("_n_ref").cast("long").alias("n_reference"),
            F.max("_n_cur").cast("long").alias("n_current"),
        )
        .withColumn("p_value", ks_tail(F.col("statistic"), F.col("n_reference"), F.col("n_current"), law))
        .withColumn("drift_detected", F.coalesce(F.col("p_value") < SIGNIFICANCE, F.lit(False)))
    )
    return for_every_feature(tested, features).fillna(0, ["n_reference", "n_current"])


def chi2_test(both: DataFrame, side: str, features: list[str]) -> DataFrame:
    """Chi-squared test of the category counts of every feature, with Yates' correction for two categories."""
    values = long_values(both, side, features, "string")
    counts = values.groupBy("feature", "value").agg(*side_counts(side))
    totals = side_totals(both, side, features, "string")
    sizes = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("_categories"))
    margins = totals.join(sizes, "feature")
    rows = counts.join(F.broadcast(margins), "feature")
    row_total = F.col("_ref") + F.col("_cur")
    grand_total = F.col("_n_ref") + F.col("_n_cur")

    def cell(observed: str, column_total: str):
        expected = row_total * F.col(column_total) / grand_total
        distance = F.abs(F.col(observed) - expected)
        corrected = F.when(F.col("_categories") == 2, distance - F.least(F.lit(0.5), distance)).otherwise(distance)
        return F.try_divide(corrected * corrected, expected)

    one_sided = (F.min("_n_ref") == 0) | (F.min("_n_cur") == 0)
    summed = rows.groupBy("feature").agg(
        F.sum(cell("_ref", "_n_ref") + cell("_cur", "_n_cur")).alias("_sum"),
        (F.max("_categories") - 1).cast("int").alias("freedom"),
        one_sided.alias("_one_sided"),
    )
    usable = summed.withColumn("statistic", F.when(~F.col("_one_sided"), F.col("_sum")))
    tested = usable.withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("freedom")))
    tested = tested.withColumn("drift_detected", F.coalesce(F.col("p_value") < SIGNIFICANCE, F.lit(False)))
    usable = ~F.coalesce(F.col("_one_sided"), F.lit(True))
    return for_every_feature(tested, features).select(
        "feature", "statistic", "freedom", "p_value", "drift_detected",
        F.when(~usable, F.lit(NOT_APPLICABLE)).alias("notes"),
    )


def drift_report(both: DataFrame, side: str, numeric: list[str], categorical: list[str]) -> DataFrame:
    """One record per feature: KS for numeric features, chi-squared for the others."""
    shared = ["feature", "statistic", "p_value", "drift_detected"]
    parts = []
    if numeric:
        tested = ks_test(both, side, numeric)
        notes = F.when(F.col("p_value").isNull(), F.lit(NOT_APPLICABLE)).alias("notes")
        parts.append(tested.select(*shared, F.lit(KS_NAME).alias("test"), notes))
    if categorical:
        parts.append(chi2_test(both, side, categorical).select(*shared, F.lit(CHI2_NAME).alias("test"), "notes"))
    if not parts:
        raise ValueError("no common features to test")
    report = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return report.select("feature", "test", "statistic", "p_value", "drift_detected", "notes")


def _auto_bins(rows, low, high, quartile_range):
    """Larger of the Sturges and the Freedman-Diaconis bin counts, 1 for a constant."""
    spread = high - low
    sturges = spread / (F.log2(rows) + 1)
    diaconis = 2.0 * quartile_range / F.pow(rows, F.lit(1.0 / 3.0))
    width = F.when(diaconis > 0, F.least(diaconis, sturges)).otherwise(sturges)
    return F.when(spread > 0, F.ceil(spread / width)).otherwise(F.lit(1)).cast("long")


BIN_LOT = 10_000  # bins are numbered in lots of so many


def density_histogram(
    both: DataFrame, side: str, features: list[str], bins: int | None = None, empty_bins: bool = False
) -> DataFrame:
    """Density of each bin per feature and side; each side has its own range and bin count.

    The bin count is automatic, or ``bins`` if given, at every size, and comes along as ``bins``. ``empty_bins`` lists all
    bins, those without a value with density 0; otherwise there are never more rows than distinct values, however far apart
    these lie. The rows are read once: ranges, quartiles and bins all come from the written counts of distinct values.
    """
    values = long_values(both, side, features, "double")
    counts = values.groupBy("feature", "value").agg(*side_counts(side))
    sliced = staged_counts(counts, ["feature"], "value")
    weights = F.array(
        F.struct(F.lit("reference").alias("_part"), F.col("_ref").alias("_rows")),
        F.struct(F.lit("current").alias("_part"), F.col("_cur").alias("_rows")),
    )
    parts = sliced.select("feature", SLICE, "value", F.inline(weights)).where(F.col("_rows") > 0)

    keys = ["feature", "_part"]
    bounds = parts.groupBy(*keys).agg(
        F.sum("_rows").cast("double").alias("_n"), F.min("value").alias("_low"), F.max("value").alias("_high")
    )
    quartiles = sliced_quantiles(parts, keys, "value", "_rows", [0.25, 0.75]).groupBy(*keys).agg(
        (F.max("quantile") - F.min("quantile")).alias("_iqr")
    )
    automatic = _auto_bins(F.col("_n"), F.col("_low"), F.col("_high"), F.col("_iqr"))
    # Two rows per feature; written because two branches below read it.
    plan = staged(
        bounds.join(quartiles, keys).withColumn("bins", automatic if bins is None else F.lit(bins).cast("long")), "bin-plan"
    )
    flat = F.col("_low") == F.col("_high")
    sides = (
        plan.select(
            *keys,
            "_n",
            "bins",
            F.when(flat, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("_low"),
            F.when(flat, F.col("_high") + 0.5).otherwise(F.col("_high")).alias("_high"),
        )
        .withColumn("_width", (F.col("_high") - F.col("_low")) / F.col("bins"))
    )

    def edge(number):
        return F.col("_low") + number * F.col("_width")

    rough = F.least(
        F.floor((F.col("value") - F.col("_low")) * (F.col("bins") / (F.col("_high") - F.col("_low")))),
        F.col("bins") - 1,
    )
    too_high = (F.col("value") < edge(F.col("_bin"))).cast("long")
    too_low = ((F.col("value") >= edge(F.col("_bin") + 1)) & (F.col("_bin") < F.col("bins") - 1)).cast("long")
    counted = (
        parts.join(F.broadcast(sides), keys)
        .withColumn("_bin", rough)
        .withColumn("bin", F.col("_bin") - too_high + too_low)
        .groupBy(*keys, "bin")
        .agg(F.sum("_rows").alias("_count"))
    )
    if empty_bins:
        # Lots spread over the tasks before they become bins, as one far value makes very many.
        lots = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(bins - 1) div {BIN_LOT}")))
        spread = sides.select(*keys, "bins", lots.alias("_lot")).hint("rebalance")
        own = F.sequence(F.col("_lot") * BIN_LOT, F.least((F.col("_lot") + 1) * BIN_LOT, F.col("bins")) - 1)
        listed = spread.select(*keys, F.explode(own).alias("bin"))
        counted = listed.join(counted, [*keys, "bin"], "left").withColumn("_count", F.coalesce("_count", F.lit(0)))
    return counted.join(F.broadcast(sides), keys).select(
        "feature",
        (F.col("_part") == "reference").alias(side),
        "bins",
        "bin",
        edge(F.col("bin")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        (F.col("_count") / (F.col("_n") * F.col("_width"))).alias("density"),
    )
