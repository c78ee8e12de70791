"""Band axes: labels, per-variable selection, and sub-annual steps as bands.

Every variable has its own band axis, so joins always use (variable, band).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridsteps.model import require_columns, single_rows

# Irrigation systems by number of systems in a band axis.
SYSTEMS = {
    2: ["rainfed", "irrigated"],
    4: ["rainfed", "surface irrigated", "sprinkler irrigated", "drip irrigated"],
}
# Band counts that are plain step numbers (annual, monthly, daily).
PLAIN_COUNTS = [1, 12, 365]


def strip_suffix(name: Column) -> Column:
    """``"band (soilc)"`` to ``"band"``."""
    return F.regexp_replace(name, r"\s*\(.*?\)", "")


def band_labels_from_names(variables: DataFrame) -> DataFrame:
    """One row (variable, band, band_label) per band of each metadata row.

    The grid variable gets lon and lat. Names are used when there is one per
    band, otherwise bands count from 1. Variables with a single band keep no
    label.
    """
    require_columns(variables, ["variable", "nbands", "band_names"])
    n = F.col("nbands")
    numbered = F.transform(F.sequence(F.lit(1), n), lambda i: i.cast("string"))
    labels = (
        F.when((F.col("variable") == "grid") & (n == 2), F.array(F.lit("lon"), F.lit("lat")))
        .when(F.size("band_names") == n, F.col("band_names"))
        .otherwise(numbered)
    )
    return (
        variables.filter(n > 1)
        .select("variable", F.posexplode(labels).alias("band", "band_label"))
    )


def label_bands(values: DataFrame, labels: DataFrame) -> DataFrame:
    """Attach ``band_label`` by (variable, band); unlabelled bands give NULL, two labels of one band are an error."""
    dim = single_rows(labels.select("variable", "band", "band_label"), "variable", "band")
    return values.join(dim, ["variable", "band"], "left")


def crop_band_labels(band_counts: DataFrame, crops: DataFrame,
                     land_uses: DataFrame | None = None) -> DataFrame:
    """Labels from crop lists for every variable of (variable, nbands).

    A count of 1, 12 or 365 is labelled "1".."n". A multiple of the number of
    crops (else of land uses) is "system crop", system outer and crop inner, if
    the multiple is 2 or 4. Other counts keep the band number as label.
    ``crops`` and ``land_uses`` are (pos, crop) tables.
    """
    def listing(df: DataFrame) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(F.col("pos").cast("int"), F.col("crop"))))
        return df.select(ordered["crop"].alias("names")).scalar()

    none = F.array().cast("array<string>")
    n = F.col("nbands")
    base = (
        band_counts.select("variable", n.cast("int").alias("nbands"))
        .withColumn("crops", F.coalesce(listing(crops), none))
        .withColumn("uses", F.coalesce(listing(land_uses), none) if land_uses is not None else none)
        .withColumn("list", F.when(n % F.nullif(F.size("crops"), F.lit(0)) == 0, F.col("crops"))
                    .when(n % F.nullif(F.size("uses"), F.lit(0)) == 0, F.col("uses")))
    )
    systems = F.lit(None).cast("array<string>")
    for count, names in SYSTEMS.items():
        systems = F.when(n == count * F.size("list"),
                         F.array(*[F.lit(s) for s in names])).otherwise(systems)
    combined = F.flatten(F.transform(
        F.col("systems"),
        lambda s: F.transform(F.col("list"), lambda c: F.concat_ws(" ", s, c))))
    plain = F.transform(F.sequence(F.lit(1), n), lambda i: i.cast("string"))
    unchanged = F.transform(F.sequence(F.lit(0), n - 1), lambda i: i.cast("string"))
    labels = (
        F.when(n.isin(*PLAIN_COUNTS), plain)
        .when(F.col("systems").isNotNull(), combined)
        .otherwise(unchanged)
    )
    return (
        base.filter(n > 0).withColumn("systems", systems)
        .select("variable", F.posexplode(labels).alias("band", "band_label"))
    )


def select_variable(values: DataFrame, variable: str, bands: DataFrame | None = None) -> DataFrame:
    """One variable with its own band labels, dimension suffixes stripped."""
    one = values.filter(F.col("variable") == variable)
    for name in one.columns:
        bare = name.split("(")[0].strip()
        if bare != name and bare not in one.columns:
            one = one.withColumnRenamed(name, bare)
    if bands is None:
        return one
    return label_bands(one, bands.filter(F.col("variable") == variable))


def steps_to_bands(values: DataFrame) -> DataFrame:
    """Sub-annual steps of one-band variables become the band axis.

    The band is the position of the step among the steps of (variable, year);
    positions come from the distinct steps, which a partial aggregate collapses
    before any shuffle. Variables with a single step keep their bands.
    """
    require_columns(values, ["variable", "year", "step", "band"])
    steps = values.groupBy("variable", "year", "step").agg(F.max("band").alias("__top"))
    order = Window.partitionBy("variable", "year").orderBy("step")
    whole = Window.partitionBy("variable", "year")
    axis = steps.select(
        "variable", "year", "step",
        (F.row_number().over(order) - 1).alias("__pos"),
        F.count(F.lit(1)).over(whole).alias("__nstep"),
        F.max("__top").over(whole).alias("__maxband"),
    )
    several = F.col("__nstep") > 1
    band = (
        F.when(several & (F.col("__maxband") > 0), F.raise_error(F.concat(
            F.lit("sub-annual steps with several bands: "), F.col("variable"))).cast("int"))
        .when(several, F.col("__pos"))
        .otherwise(F.col("band"))
    )
    return (
        values.join(axis, ["variable", "year", "step"])
        .withColumn("band", band.cast("int"))
        .drop("__pos", "__nstep", "__maxband", "step")
    )


def subannual_violations(values: DataFrame) -> DataFrame:
    """Variables that break the rule of :func:`steps_to_bands`."""
    keys = values.groupBy("variable", "year").agg(
        F.min("step").alias("lo"), F.max("step").alias("hi"), F.max("band").alias("top"))
    return (
        keys.filter((F.col("lo") != F.col("hi")) & (F.col("top") > 0))
        .select("variable", "year")
    )
