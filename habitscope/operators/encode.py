"""Category codes, frequency indices, one-hot columns, vectors and scalers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from habitscope.functions import columns as C
from habitscope.operators.onerow import STATS, attach_one_row, stat
from habitscope.sources.scratch import settled

# Labels of one count are ranked apart by so many leading bytes.
LEAD_BYTES = 4


def encode_codes(
    df: DataFrame, code_maps: Mapping[str, Mapping[str, float]], suffix: str = "_encoded"
) -> DataFrame:
    """Add ``<column><suffix>`` from a category -> code map; unmapped gives NULL."""
    return df.withColumns({c + suffix: C.code_of(c, m) for c, m in code_maps.items()})


# -- frequency index ----------------------------------------------------------------


def label_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, label, idx): 0 for the most frequent label, ties alphabetical.

    All columns are counted in one scan; the map side combines, so what is
    shuffled is one row per distinct label and task. A column's labels are ranked in
    parts of equal count and equal first bytes, which are then put one after the other:
    a column with very many labels is not sorted in one task.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("label")) for c in cols])
    )
    counts = (
        df.select(pairs.alias("pair"))
        .select("pair.column", "pair.label")
        .filter(F.col("label").isNotNull())
        .groupBy("column", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lead = F.hex(F.substring(F.encode("label", "UTF-8"), 1, LEAD_BYTES))
    counts = settled(counts.withColumn("lead", lead), "label-counts")
    earlier = Window.partitionBy("column").orderBy(F.col("n").desc(), "lead").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = counts.groupBy("column", "n", "lead").agg(F.count(F.lit(1)).alias("size")).select(
        "column", "n", "lead", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("column", "n", "lead").orderBy("label")
    return (
        counts.withColumn("place", F.row_number().over(inside) - 1)
        .join(parts, ["column", "n", "lead"])
        .select("column", "label", (F.col("before") + F.col("place")).cast("double").alias("idx"))
    )


#: A map is searched from its start, so only short ones replace a join.
MAP_LABELS = 64


def frequency_index(
    df: DataFrame, cols: Sequence[str], invalid: str = "keep", suffix: str = "_idx",
    fitted: DataFrame | None = None,
) -> DataFrame:
    """Index labels by frequency. ``keep``: unseen and NULL share the extra index
    (= number of labels); ``skip``: such rows are dropped.

    ``fitted`` is an earlier ``label_ranks``, to index one table by another's
    frequencies. The label table is settled. Columns of at most MAP_LABELS labels are looked up
    in maps that arrive as one row, without a join. Of the others Spark knows the bytes: it
    broadcasts a small table by its own check and else shuffles, splitting skewed
    partitions at run time.
    """
    ranks = settled(label_ranks(df, cols) if fitted is None else fitted, "label-ranks")
    sizes = {
        r["column"]: r["n"]
        for r in ranks.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    few = [c for c in cols if sizes.get(c, 0) <= MAP_LABELS]
    out = df
    if few:
        def of(c: str) -> Column:
            pairs = F.collect_list(F.when(F.col("column") == c, F.struct("label", "idx")))
            return F.map_from_entries(pairs).alias(c)

        maps = ranks.where(F.col("column").isin(few)).agg(*[of(c) for c in few])
        out = attach_one_row(out, maps).withColumns(
            {c + suffix: F.element_at(stat(c), F.col(c).cast("string")) for c in few}).drop(STATS)
    for c in cols:
        if c not in few:
            side = ranks.filter(F.col("column") == c).select(
                F.col("label").alias(f"label_of_{c}"), F.col("idx").alias(c + suffix)
            )
            out = out.join(side, F.col(c) == F.col(f"label_of_{c}"), "left").drop(f"label_of_{c}")
    if invalid == "skip":
        return out.dropna(subset=[c + suffix for c in cols])
    return out.withColumns(
        {c + suffix: F.coalesce(F.col(c + suffix), F.lit(float(sizes.get(c, 0)))) for c in cols})


# -- one-hot, vectors, scalers ----------------------------------------------------------


def one_hot_columns(df: DataFrame, col: str, invalid: str = "skip", prefix: str | None = None) -> DataFrame:
    """0/1 column per category index, last category dropped (all zeros)."""
    indexed = StringIndexer(inputCol=col, outputCol="hot_index", handleInvalid=invalid)
    hot = OneHotEncoder(inputCol="hot_index", outputCol="hot_vector", dropLast=True)
    model = Pipeline(stages=[indexed, hot]).fit(df)
    size = len(model.stages[0].labels) + (1 if invalid == "keep" else 0) - 1
    out = model.transform(df).withColumn("hot_array", vector_to_array("hot_vector"))
    return unpacked(out, "hot_array", [f"{prefix or col}_{i}" for i in range(size)]).drop(
        "hot_index", "hot_vector"
    )


def assemble(df: DataFrame, cols: Sequence[str], output: str, invalid: str = "error") -> DataFrame:
    """Vector column; ``skip`` drops rows with a NULL or NaN part, ``error`` fails on one."""
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid=invalid).transform(df)


def standard_scaler(source: str, output: str, center: bool) -> StandardScaler:
    """Unit sample deviation; not centring keeps one-hot vectors sparse."""
    return StandardScaler(inputCol=source, outputCol=output, withStd=True, withMean=center)


def unpacked(df: DataFrame, array: str, names: Sequence[str]) -> DataFrame:
    """One double column per slot of an array column."""
    slots = {name: F.element_at(array, i + 1) for i, name in enumerate(names)}
    return df.withColumns(slots).drop(array)


def feature_stages(
    numeric: Sequence[str], categorical: Sequence[str], output: str = "features"
) -> list:
    """Index + one-hot each category, assemble with the numbers, scale uncentred."""
    stages: list = []
    if categorical:
        stages.append(StringIndexer(
            inputCols=list(categorical), outputCols=[c + "_index" for c in categorical],
            handleInvalid="skip",
        ))
        stages.append(OneHotEncoder(
            inputCols=[c + "_index" for c in categorical],
            outputCols=[c + "_vec" for c in categorical], dropLast=True,
        ))
    stages.append(VectorAssembler(
        inputCols=[*numeric, *[c + "_vec" for c in categorical]], outputCol="raw_" + output
    ))
    stages.append(standard_scaler("raw_" + output, output, center=False))
    return stages


# -- min-max fitted on one table ----------------------------------------------------------


def column_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with ``<c>_min`` and ``<c>_max`` per column."""
    bounds = [(f(c).alias(f"{c}_{tag}")) for c in cols for f, tag in ((F.min, "min"), (F.max, "max"))]
    return df.agg(*bounds)


def scale_ranges(
    df: DataFrame, ranges: DataFrame, outputs: Mapping[str, str],
    scale: float = 100.0, epsilon: float = 1e-5,
) -> DataFrame:
    """Add ``outputs[c]`` = min-max scaled ``c`` by the one-row ``ranges``."""
    scaled = {
        out: C.range_scaled(c, stat(f"{c}_min"), stat(f"{c}_max"), epsilon, scale)
        for c, out in outputs.items()
    }
    return attach_one_row(df, ranges).withColumns(scaled).drop(STATS)
