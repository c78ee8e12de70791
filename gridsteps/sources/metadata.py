"""Metadata sidecars and configuration catalogues as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gridsteps.model import METADATA


def _plain_label(label: Column) -> Column:
    """Decimal band names in one spelling: "200.000000" becomes "200.0"; others stay as they are."""
    decimal = label.rlike(r"^[+-]?[0-9]+\.[0-9]+$")
    return F.when(decimal, label.try_cast("double").cast("string")).otherwise(label)


def default_band_names(df: DataFrame) -> DataFrame:
    """Labels "0".."n-1" where a file gives none."""
    n = F.col("nbands")
    counted = F.when(n > 0, F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: i.cast("string"))
    ).when(n == 0, F.array().cast("array<string>"))
    return df.withColumn("band_names", F.coalesce(
        F.transform("band_names", _plain_label), counted))


def load_metadata(spark: SparkSession, path: str | list[str], glob: str = "*.json") -> DataFrame:
    """All sidecars below a path, or in the files of a list, one row per file, with its ``path``.

    The schema is fixed; a field that a file lacks is NULL. Files are read in
    parallel and never inferred from.
    """
    return default_band_names(
        spark.read.schema(METADATA).option("multiLine", True)
        .option("pathGlobFilter", glob).option("recursiveFileLookup", True)
        .json(path).withColumn("path", F.col("_metadata.file_path"))
    )


def _has_private(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(f.name.startswith("_") or _has_private(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_private(kind.elementType)
    return isinstance(kind, T.MapType) and (isinstance(kind.keyType, T.StringType) or _has_private(kind.valueType))


def _public(value: Column, kind: T.DataType) -> Column:
    """A value without the private keys of any level; a NULL stays NULL."""
    if not _has_private(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _public(x, kind.elementType))
    if isinstance(kind, T.MapType):
        kept = value
        if isinstance(kind.keyType, T.StringType):
            kept = F.map_filter(kept, lambda k, _: ~k.startswith("_"))
        return F.transform_values(kept, lambda _, v: _public(v, kind.valueType))
    fields = [_public(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields if not f.name.startswith("_")]
    # A struct of private keys only is an empty object, not nothing.
    return F.when(value.isNotNull(), F.struct(*fields) if fields else F.create_map().cast("map<string,string>"))


def public_columns(df: DataFrame) -> DataFrame:
    """The table without private columns and keys (leading ``_``), inside structs, arrays and maps too."""
    return df.select(*(_public(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
                       for f in df.schema.fields if not f.name.startswith("_")))


def write_metadata(variables: DataFrame, path: str) -> None:
    """Write the tree as JSON lines; private keys (leading ``_``) are left out at every level."""
    public_columns(variables).write.mode("overwrite").json(path)


def as_json(variables: DataFrame, out: str = "json") -> DataFrame:
    """One JSON text per row, without private keys of any level."""
    public = public_columns(variables)
    return public.select("variable", F.to_json(F.struct(*(F.col(f"`{c}`") for c in public.columns))).alias(out))


def merge_metadata(target: DataFrame, source: DataFrame, on: str = "variable") -> DataFrame:
    """Metadata of a converted file from both sides.

    Keys the target lacks come from the source, ``band_names`` always do, and
    the area file is named after the stem before the first dot of the source's.
    """
    have = [c for c in target.columns if c != on]
    renamed = source.select(on, *[F.col(c).alias(f"__{c}") for c in source.columns if c != on])
    joined = target.join(renamed, on, "left")
    columns = []
    for name in dict.fromkeys(have + [c for c in source.columns if c != on]):
        if name not in have:
            value = F.col(f"__{name}")
        elif f"__{name}" not in renamed.columns:
            value = F.col(name)
        elif name == "band_names":
            value = F.coalesce(F.col("__band_names"), F.col("band_names"))
        else:
            value = F.coalesce(F.col(name), F.col(f"__{name}"))
        if name == "ref_area" and "ref_area" in source.columns:
            stem = F.substring_index(F.col("__ref_area.filename"), ".", 1)
            value = F.when(
                F.col("__ref_area.filename").isNotNull(),
                value.withField("filename", F.concat(stem, F.lit(".bin.json")))).otherwise(value)
        columns.append(value.alias(name))
    return joined.select(on, *columns)


_FILE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("fmt", T.StringType()),
    T.StructField("socket", T.BooleanType()),
])
CONFIG = T.StructType([
    T.StructField("outputvar", T.ArrayType(T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("var", T.StringType()),
        T.StructField("unit", T.StringType()),
    ]))),
    T.StructField("output", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("file", _FILE),
    ]))),
    T.StructField("input", T.MapType(T.StringType(), T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("fmt", T.StringType()),
        T.StructField("socket", T.BooleanType()),
    ]))),
])


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Run configurations, one row per JSON file."""
    return spark.read.schema(CONFIG).option("multiLine", True).json(path).withColumn(
        "path", F.col("_metadata.file_path"))


def catalog_available(config: DataFrame) -> DataFrame:
    """Variables that a configuration can write: (path, index, name, var, unit)."""
    return config.select("path", F.explode("outputvar").alias("o")).select(
        "path", F.col("o.id").alias("index"), "o.name", "o.var", "o.unit")


def catalog_outputs(config: DataFrame, fmt: str | None = None,
                    coupled: bool | None = None) -> DataFrame:
    """Outputs that a configuration defines, with their numeric index.

    ``fmt`` keeps one file format, ``coupled`` keeps the exchanged ones.
    """
    outputs = config.select("path", F.explode("output").alias("o")).select(
        "path", F.col("o.id").alias("name"), F.col("o.file.name").alias("filename"),
        F.col("o.file.fmt").alias("fmt"),
        F.coalesce(F.col("o.file.socket"), F.lit(False)).alias("socket"))
    if fmt is not None:
        outputs = outputs.filter(F.col("fmt") == fmt)
    if coupled:
        outputs = outputs.filter("socket")
    index = catalog_available(config).select("path", "name", "index")
    return outputs.join(index, ["path", "name"], "left")


def catalog_inputs(config: DataFrame, coupled: bool | None = None) -> DataFrame:
    """Inputs of a configuration: (path, name, id, filename, fmt, socket)."""
    inputs = config.select("path", F.explode("input").alias("name", "i")).select(
        "path", "name", F.col("i.id").alias("id"), F.col("i.name").alias("filename"),
        F.col("i.fmt").alias("fmt"), F.coalesce(F.col("i.socket"), F.lit(False)).alias("socket"))
    return inputs.filter("socket") if coupled else inputs
