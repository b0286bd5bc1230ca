"""The cleaning job: raw user records -> one clean, encoded row per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql import types as T

from habitscope.functions import columns as C
from habitscope.operators import clean, encode
from habitscope.plans import fixed_values as V
from habitscope.sources import tables
from habitscope.sources.scratch import settled

RAW_TEXT = [*V.FLAG_CODES, *V.ORDINAL_CODES, *V.NOMINAL_COLUMNS, V.DATE_COLUMN]


def raw_schema() -> T.StructType:
    """Declared schema for a raw file with its columns in this order: no inference
    pass. Numbers are read as double so that ``2019.0`` in an integer column is not
    lost; the other measures stay text and are cast leniently. For a file in any
    other column order use ``read_csv_text``: the casts accept text as well."""
    fields = [T.StructField(V.KEY, T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in V.INT_COLUMNS]
    fields += [T.StructField(c, T.StringType()) for c in (*V.DOUBLE_COLUMNS, *RAW_TEXT)]
    return T.StructType(fields)


def one_record_per_user(
    records: DataFrame, prefer: Sequence[Column] = (), copies: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Complete records win over incomplete ones, then ``prefer`` decides. Cast the
    records first (``typed``): text that is no number makes a record incomplete."""
    marks = [clean.is_complete(V.REQUIRED), *prefer]
    return clean.keep_one_per_key(records, [V.KEY], marks, copies, unique)


def typed(df: DataFrame) -> DataFrame:
    """Numbers, date, repaired text: a single projection after Catalyst collapses it."""
    targets = {c: "double" for c in V.DOUBLE_COLUMNS} | {c: "int" for c in V.INT_COLUMNS}
    out = clean.cast_columns(df, targets)
    out = clean.parse_dates(out, {V.DATE_COLUMN: V.DATE_PATTERN})
    out = clean.repair_apostrophes(out, V.TEXT_TO_REPAIR)
    return clean.floor_to_int(out, V.YEAR_COLUMN)


def accepted(df: DataFrame) -> DataFrame:
    return clean.exclude_value(
        clean.within_ranges(df, V.ACCEPTED_RANGES), "gender", V.EXCLUDED_GENDER
    )


def encoded(df: DataFrame) -> DataFrame:
    return encode.encode_codes(df, V.FLAG_CODES | V.ORDINAL_CODES)


def with_derived(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "total_time_on_instagram_per_day": C.total_of(
            "time_on_feed_per_day", "time_on_explore_per_day",
            "time_on_messages_per_day", "time_on_reels_per_day",
        ),
        "ads_ctr": C.guarded_ratio("ads_clicked_per_day", "ads_viewed_per_day"),
        "follower_following_ratio": C.guarded_ratio(
            "followers_count", "following_count", F.col("followers_count").cast("double")
        ),
        "account_age_years": C.years_since(V.YEAR_COLUMN, V.AS_OF_YEAR),
        "stress_score_normalized": C.scaled_down("perceived_stress_score", V.STRESS_SCALE),
    })


def clean_users(raw: DataFrame, prefer: Sequence[Column] = (), unique: bool = False) -> DataFrame:
    """Everything but the frequency indices: lazy, one shuffle (the dedupe). Incomplete
    records never win over a complete one and are dropped anyway, so they go first."""
    complete = clean.require_columns(typed(raw), V.REQUIRED)
    users = clean.keep_one_per_key(complete, [V.KEY], prefer, unique=unique)
    return with_derived(encoded(accepted(users)))


def clean_and_indexed_users(
    raw: DataFrame, prefer: Sequence[Column] = (), unique: bool = False
) -> DataFrame:
    """The full 80-column table. The clean rows are settled, because the label
    counts are needed before the first row can be indexed."""
    users = settled(clean_users(raw, prefer, unique), "users-clean")
    return encode.frequency_index(users, V.NOMINAL_COLUMNS, invalid="keep")


def users_by_gender(users: DataFrame) -> DataFrame:
    """Preview report: users and mean engagement by gender."""
    return (
        users.groupBy("gender")
        .agg(
            F.count(F.lit(1)).alias("total_users"),
            F.round(F.avg("user_engagement_score"), 4).alias("avg_engagement"),
        )
        .orderBy(F.col("total_users").desc(), "gender")
    )


def cleaning_rules() -> dict[str, Column]:
    """Acceptance rules in order, for the audit and the reject report."""
    rules = {f"{c}_present": F.col(c).isNotNull() for c in V.REQUIRED}
    rules |= {f"{c}_in_range": F.col(c).between(*r) for c, r in V.ACCEPTED_RANGES.items()}
    rules["gender_stated"] = F.col("gender") != F.lit(V.EXCLUDED_GENDER)
    return rules


def stage_sums() -> list[Column]:
    """Stage counts as aggregates of the typed one-row-per-user table, whose ``copies``
    column holds the raw records seen for the user."""
    complete = clean.is_complete(V.REQUIRED) == 1
    kept = complete & clean.in_ranges(V.ACCEPTED_RANGES) & (
        F.col("gender") != F.lit(V.EXCLUDED_GENDER)
    )
    return [
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
        F.count(F.lit(1)).alias("distinct_users"),
        F.count_if(complete).alias("after_nulls"),
        F.count_if(kept).alias("clean_rows"),
    ]


def stage_counts(raw: DataFrame, prefer: Sequence[Column] = ()) -> DataFrame:
    """Rows raw, after dedupe, after null removal, after the range filters, and
    removed in all: a single pass over the raw table."""
    counts = one_record_per_user(typed(raw), prefer, copies="copies").agg(*stage_sums())
    return counts.withColumn("removed_rows", F.col("raw_rows") - F.col("clean_rows"))


def run_cleaning(raw: DataFrame, output: str, fmt: str = "parquet",
                 prefer: Sequence[Column] = ()) -> dict[str, int]:
    """Write the 80-column table and return the row counts of every stage.

    The raw table is read and shuffled once: the typed one-row-per-user table goes
    to the shared scratch folder, the counts are observed in that write, and the label
    frequencies and the final write each read just the columns they need from there. It
    also ends the lineage, so a lost executor never sends the job back to the raw file.
    The observation is the last step before the write: a task that runs again counts once.
    """
    stages = Observation("stages")
    seen = settled(
        one_record_per_user(typed(raw), prefer, copies="copies").observe(stages, *stage_sums()), "users-typed")
    counts = dict(stages.get)
    counts["removed_rows"] = counts["raw_rows"] - counts["clean_rows"]
    users = accepted(clean.require_columns(seen.drop("copies"), V.REQUIRED))
    out = encode.frequency_index(with_derived(encoded(users)), V.NOMINAL_COLUMNS, invalid="keep")
    (tables.write_csv if fmt == "csv" else tables.write_parquet)(out, output)
    return counts | {"columns": len(out.columns)}
