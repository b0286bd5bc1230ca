"""The ten analytic reports over the clean user table.

Each takes the table and returns an ordered DataFrame. Group sizes and cuts are
arguments; rankings use the rounded values shown in the report, and every order
that could tie has the group keys as tiebreak.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from habitscope.functions.measures import mean_of, ratio_of_means, row_count, share_pct
from habitscope.functions.windows import number_desc, rank_desc, total_over
from habitscope.operators.anomaly import with_abs_z
from habitscope.operators.report import grouped, top_ranked
from habitscope.operators.segment import Segmentation, segment
from habitscope.plans import fixed_values as V

PERSONA = Segmentation(*V.PERSONA)
SESSION_HABIT = Segmentation(*V.SESSION_HABIT)
LOYALTY = Segmentation(*V.LOYALTY)
RESPONSE_TIER = Segmentation(*V.RESPONSE_TIER)
EXERCISE_LEVEL = Segmentation(*V.EXERCISE_LEVEL)
USAGE_LEVEL = Segmentation(*V.USAGE_LEVEL)
ANOMALY_CLASS = Segmentation(*V.ANOMALY_CLASS)
AGE_DECADE = Segmentation(*V.AGE_DECADE)
GENERATION = Segmentation(*V.GENERATION)


def persona_by_gender(users: DataFrame) -> DataFrame:
    """Posting personas by gender with their activity and happiness."""
    return grouped(users, [PERSONA.column(), "gender"], {
        "total_users": row_count(),
        "avg_followers": mean_of("followers_count", 0),
        "avg_following": mean_of("following_count", 0),
        "avg_likes_given": mean_of("likes_given_per_day", 1),
        "avg_reels_watched": mean_of("reels_watched_per_day", 1),
        "avg_posts_week": mean_of("posts_created_per_week", 2),
        "avg_happiness": mean_of("self_reported_happiness", 2),
        "avg_engagement": mean_of("user_engagement_score", 4),
    }).orderBy(PERSONA.name, F.col("total_users").desc(), "gender")


def session_habit_and_health(users: DataFrame) -> DataFrame:
    """Session-length classes against health measures, ranked by steps."""
    return grouped(users, [SESSION_HABIT.column()], {
        "user_count": row_count(),
        "avg_daily_steps": mean_of("daily_steps_count", 0),
        "avg_exercise_hours": mean_of("exercise_hours_per_week", 2),
        "avg_bp_systolic": mean_of("blood_pressure_systolic", 1),
        "avg_bp_diastolic": mean_of("blood_pressure_diastolic", 1),
        "avg_sleep_hours": mean_of("sleep_hours_per_night", 2),
        "avg_stress_score": mean_of("perceived_stress_score", 2),
        "avg_ig_minutes_day": mean_of("daily_active_minutes_instagram", 1),
    }).withColumn("steps_rank", rank_desc("avg_daily_steps")).select(
        SESSION_HABIT.name, "user_count", "avg_daily_steps", "steps_rank", "avg_exercise_hours",
        "avg_bp_systolic", "avg_bp_diastolic", "avg_sleep_hours", "avg_stress_score",
        "avg_ig_minutes_day",
    ).orderBy(SESSION_HABIT.name)


def privacy_and_messaging(users: DataFrame) -> DataFrame:
    """Privacy level by gender; message-to-comment ratio ranked within gender."""
    return grouped(users, ["privacy_setting_level", "gender"], {
        "total_users": row_count(),
        "avg_dms_sent": mean_of("dms_sent_per_week", 2),
        "avg_dms_received": mean_of("dms_received_per_week", 2),
        "avg_comments": mean_of("comments_written_per_day", 2),
        "avg_likes": mean_of("likes_given_per_day", 2),
        "avg_stories_viewed": mean_of("stories_viewed_per_day", 1),
        "dm_vs_comment_ratio": ratio_of_means("dms_sent_per_week", "comments_written_per_day", 2),
        "avg_followers": mean_of("followers_count", 0),
        "avg_engagement": mean_of("user_engagement_score", 4),
    }).withColumn(
        "privacy_rank_by_gender", rank_desc("dm_vs_comment_ratio", ["gender"])
    ).select(
        "privacy_setting_level", "gender", "total_users", "avg_dms_sent", "avg_dms_received",
        "avg_comments", "avg_likes", "avg_stories_viewed", "dm_vs_comment_ratio",
        "privacy_rank_by_gender", "avg_followers", "avg_engagement",
    ).orderBy("privacy_setting_level", "gender")


def loyalty_segments(users: DataFrame) -> DataFrame:
    """Visit frequency x engagement segments: share of users, ad value rank."""
    return grouped(users, [LOYALTY.column()], {
        "total_users": row_count(),
        "avg_minutes_spent": mean_of("daily_active_minutes_instagram", 1),
        "avg_sessions": mean_of("sessions_per_day", 2),
        "avg_engagement": mean_of("user_engagement_score", 4),
        "avg_ads_clicked": mean_of("ads_clicked_per_day", 2),
        "ads_ctr_pct": ratio_of_means("ads_clicked_per_day", "ads_viewed_per_day", 2, times=100.0),
        "avg_posts_week": mean_of("posts_created_per_week", 2),
        "avg_followers": mean_of("followers_count", 0),
        "avg_happiness": mean_of("self_reported_happiness", 2),
    }).select(
        LOYALTY.name, "total_users",
        share_pct(F.col("total_users"), total_over("total_users")).alias("pct_of_total"),
        "avg_minutes_spent", "avg_sessions", "avg_engagement", "avg_ads_clicked", "ads_ctr_pct",
        "avg_posts_week", "avg_followers", "avg_happiness",
        rank_desc("avg_ads_clicked").alias("ads_value_rank"),
    ).orderBy(LOYALTY.name)


def ad_targeting(
    users: DataFrame, more_than: int = V.MIN_GROUP_TARGETING, top: int = V.TOP_TARGETS
) -> DataFrame:
    """Best ad groups by clicks per hour online, among groups of enough users."""
    keys = ["income_level", "employment_status", "preferred_content_theme"]
    groups = grouped(users, keys, {
        "total_users": row_count(),
        "avg_ads_clicked": mean_of("ads_clicked_per_day", 3),
        "avg_time_online_mins": mean_of("daily_active_minutes_instagram", 2),
        "avg_engagement": mean_of("user_engagement_score", 4),
        "avg_followers": mean_of("followers_count", 0),
    }, having=F.col("total_users") > more_than)
    per_hour = F.try_divide(F.col("avg_ads_clicked"), F.col("avg_time_online_mins") / F.lit(60.0))
    rated = groups.withColumn("exact_click_rate", per_hour).withColumn(
        "ads_click_per_hour", F.round("exact_click_rate", 3)
    )
    return top_ranked(
        rated, top, ["ads_click_per_hour"], "exact_click_rate", "targeting_rank", keys
    ).select(
        *keys, "total_users", "avg_ads_clicked", "avg_time_online_mins", "ads_click_per_hour",
        "avg_engagement", "avg_followers", "targeting_rank",
    ).orderBy(
        F.col("ads_click_per_hour").desc_nulls_last(), F.col("targeting_rank").asc_nulls_last(),
        *[F.col(k).asc_nulls_last() for k in keys],
    )


def plan_and_notifications(users: DataFrame) -> DataFrame:
    """Subscription plan x notification response: share in plan, engagement order."""
    plan, tier = "subscription_status", RESPONSE_TIER.name
    return grouped(users, [plan, RESPONSE_TIER.column()], {
        "user_count": row_count(),
        "avg_linked_accounts": mean_of("linked_accounts_count", 2),
        "avg_engagement": mean_of("user_engagement_score", 4),
        "avg_ig_minutes": mean_of("daily_active_minutes_instagram", 1),
        "avg_sessions": mean_of("sessions_per_day", 2),
        "avg_notif_rate_pct": mean_of("notification_response_rate", 1, times=100.0),
    }).select(
        plan, tier, "user_count",
        share_pct(F.col("user_count"), total_over("user_count", [plan])).alias("pct_in_plan"),
        "avg_linked_accounts", "avg_engagement", "avg_ig_minutes", "avg_sessions",
        "avg_notif_rate_pct",
        number_desc("avg_engagement", [tier], [plan]).alias("engage_rank_in_plan"),
    ).orderBy(plan, tier)


def exercise_and_usage(users: DataFrame, at_least: int = V.MIN_GROUP_HEALTH) -> DataFrame:
    """Exercise x usage cross-table; stress ranked within the exercise level."""
    exercise, usage = EXERCISE_LEVEL.name, USAGE_LEVEL.name
    return grouped(users, [EXERCISE_LEVEL.column(), USAGE_LEVEL.column()], {
        "so_nguoi_dung": row_count(),
        "gio_ngu_tb": mean_of("sleep_hours_per_night", 2),
        "diem_stress_tb": mean_of("perceived_stress_score", 2),
        "diem_hanh_phuc_tb": mean_of("self_reported_happiness", 2),
        "bmi_tb": mean_of("body_mass_index", 2),
        "so_buoc_chan_tb": mean_of("daily_steps_count", 0),
        "exact_stress": mean_of("perceived_stress_score"),
    }, having=F.col("so_nguoi_dung") >= at_least).withColumn(
        "xep_hang_stress_trong_nhom", rank_desc("exact_stress", [exercise])
    ).drop("exact_stress").orderBy(exercise, usage)


def anomaly_classes(users: DataFrame) -> DataFrame:
    """Users by anomaly class (z-scores on four measures) and each class's profile."""
    scored = with_abs_z(users, V.ANOMALY_MEASURES).withColumn(
        "total_anomaly_score", F.round(F.expr("z_mins + z_eng + z_flw + z_clicks"), 4)
    )
    classes = grouped(segment(scored, ANOMALY_CLASS), [ANOMALY_CLASS.name], {
        "so_nguoi_dung": row_count(),
        "diem_bat_thuong_tb": mean_of("total_anomaly_score", 4),
        "followers_tb": mean_of("followers_count", 0),
        "so_click_ads_tb": mean_of("ads_clicked_per_day", 2),
        "phut_dung_ig_tb": mean_of("daily_active_minutes_instagram", 2),
        "diem_tuong_tac_tb": mean_of("user_engagement_score", 4),
    })
    return classes.select(
        ANOMALY_CLASS.name, "so_nguoi_dung",
        share_pct(F.col("so_nguoi_dung"), total_over("so_nguoi_dung")).alias("ty_le_phan_tram"),
        "diem_bat_thuong_tb", "followers_tb", "so_click_ads_tb", "phut_dung_ig_tb",
        "diem_tuong_tac_tb",
    ).orderBy(F.col("diem_bat_thuong_tb").desc_nulls_last(), ANOMALY_CLASS.name)


def countries_by_age(users: DataFrame) -> DataFrame:
    """Countries ranked by engagement inside each age group."""
    age = AGE_DECADE.name
    return grouped(users, [AGE_DECADE.column(), "country"], {
        "user_count": row_count(),
        "avg_engagement_score": mean_of("user_engagement_score", 4),
        "avg_daily_mins": mean_of("daily_active_minutes_instagram", 1),
    }).withColumn("ranking", rank_desc("avg_engagement_score", [age])).orderBy(
        age, "ranking", "country"
    )


def generations(users: DataFrame) -> DataFrame:
    """Usage, engagement and wellbeing by generation."""
    return grouped(users, [GENERATION.column()], {
        "user_count": row_count(),
        "avg_instagram_minutes": mean_of("daily_active_minutes_instagram", 2),
        "avg_sessions": mean_of("sessions_per_day", 2),
        "avg_engagement": mean_of("user_engagement_score", 4),
        "avg_stress": mean_of("perceived_stress_score", 2),
        "avg_happiness": mean_of("self_reported_happiness", 2),
        "avg_posts": mean_of("posts_created_per_week", 2),
        "avg_followers": mean_of("followers_count", 0),
    }).orderBy(F.col("avg_instagram_minutes").desc_nulls_last(), GENERATION.name)


ALL_REPORTS = {
    "persona_by_gender": persona_by_gender,
    "session_habit_and_health": session_habit_and_health,
    "privacy_and_messaging": privacy_and_messaging,
    "loyalty_segments": loyalty_segments,
    "ad_targeting": ad_targeting,
    "plan_and_notifications": plan_and_notifications,
    "exercise_and_usage": exercise_and_usage,
    "anomaly_classes": anomaly_classes,
    "countries_by_age": countries_by_age,
    "generations": generations,
}
