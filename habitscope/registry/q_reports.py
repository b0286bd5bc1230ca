"""Q0-Q10: the reports, run end to end from the raw records."""

from __future__ import annotations

from habitscope.plans import fixed_values as V
from habitscope.plans import reports, users
from habitscope.registry.catalog import query
from habitscope.registry.dataset import USERS_SQL, clean_users, half_up, sql_rules

# Group minimums for these tables: about a thousand users instead of a million.
MORE_THAN = 3
AT_LEAST = 10


def mean(column: str, digits: int, times: str = "") -> str:
    return half_up(f"AVG({column}){times}", digits)


def share(part: str, whole: str) -> str:
    return half_up(f"{part}::DOUBLE * 100.0::DOUBLE / ({whole})::DOUBLE", 2)


PERSONA, HABIT, LOYALTY, TIER, EXERCISE, USAGE, ANOMALY, DECADE, GENERATION = (
    sql_rules(r) for r in (
        V.PERSONA, V.SESSION_HABIT, V.LOYALTY, V.RESPONSE_TIER, V.EXERCISE_LEVEL, V.USAGE_LEVEL,
        V.ANOMALY_CLASS, V.AGE_DECADE, V.GENERATION,
    )
)

BY_GENDER = USERS_SQL + f"""
SELECT gender, COUNT(*) AS total_users, {mean("user_engagement_score", 4)} AS avg_engagement
FROM users GROUP BY gender"""


@query("q0_preview", BY_GENDER)
def q0(spark, sf_dir):
    return users.users_by_gender(clean_users(spark, sf_dir))


@query("q1_persona", USERS_SQL + f"""
SELECT {PERSONA} AS user_persona, gender, COUNT(*) AS total_users,
  {mean("followers_count", 0)} AS avg_followers, {mean("following_count", 0)} AS avg_following,
  {mean("likes_given_per_day", 1)} AS avg_likes_given,
  {mean("reels_watched_per_day", 1)} AS avg_reels_watched,
  {mean("posts_created_per_week", 2)} AS avg_posts_week,
  {mean("self_reported_happiness", 2)} AS avg_happiness,
  {mean("user_engagement_score", 4)} AS avg_engagement
FROM users GROUP BY ALL""")
def q1(spark, sf_dir):
    return reports.persona_by_gender(clean_users(spark, sf_dir))


@query("q2_session_habit", USERS_SQL + f""", a AS (
  SELECT {HABIT} AS session_habit, COUNT(*) AS user_count,
    {mean("daily_steps_count", 0)} AS avg_daily_steps,
    {mean("exercise_hours_per_week", 2)} AS avg_exercise_hours,
    {mean("blood_pressure_systolic", 1)} AS avg_bp_systolic,
    {mean("blood_pressure_diastolic", 1)} AS avg_bp_diastolic,
    {mean("sleep_hours_per_night", 2)} AS avg_sleep_hours,
    {mean("perceived_stress_score", 2)} AS avg_stress_score,
    {mean("daily_active_minutes_instagram", 1)} AS avg_ig_minutes_day
  FROM users GROUP BY ALL)
SELECT *, RANK() OVER (ORDER BY avg_daily_steps DESC NULLS LAST) AS steps_rank FROM a""")
def q2(spark, sf_dir):
    return reports.session_habit_and_health(clean_users(spark, sf_dir))


@query("q3_privacy", USERS_SQL + f""", a AS (
  SELECT privacy_setting_level, gender, COUNT(*) AS total_users,
    {mean("dms_sent_per_week", 2)} AS avg_dms_sent,
    {mean("dms_received_per_week", 2)} AS avg_dms_received,
    {mean("comments_written_per_day", 2)} AS avg_comments,
    {mean("likes_given_per_day", 2)} AS avg_likes,
    {mean("stories_viewed_per_day", 1)} AS avg_stories_viewed,
    {half_up("AVG(dms_sent_per_week) / NULLIF(AVG(comments_written_per_day), 0)", 2)}
      AS dm_vs_comment_ratio,
    {mean("followers_count", 0)} AS avg_followers,
    {mean("user_engagement_score", 4)} AS avg_engagement
  FROM users GROUP BY ALL)
SELECT *, RANK() OVER (PARTITION BY gender ORDER BY dm_vs_comment_ratio DESC NULLS LAST)
  AS privacy_rank_by_gender FROM a""")
def q3(spark, sf_dir):
    return reports.privacy_and_messaging(clean_users(spark, sf_dir))


@query("q4_loyalty", USERS_SQL + f""", a AS (
  SELECT {LOYALTY} AS user_segment, COUNT(*) AS total_users,
    {mean("daily_active_minutes_instagram", 1)} AS avg_minutes_spent,
    {mean("sessions_per_day", 2)} AS avg_sessions,
    {mean("user_engagement_score", 4)} AS avg_engagement,
    {mean("ads_clicked_per_day", 2)} AS avg_ads_clicked,
    {half_up("AVG(ads_clicked_per_day) * 100.0::DOUBLE / NULLIF(AVG(ads_viewed_per_day), 0)", 2)}
      AS ads_ctr_pct,
    {mean("posts_created_per_week", 2)} AS avg_posts_week,
    {mean("followers_count", 0)} AS avg_followers,
    {mean("self_reported_happiness", 2)} AS avg_happiness
  FROM users GROUP BY ALL)
SELECT *, {share("total_users", "SUM(total_users) OVER ()")} AS pct_of_total,
  RANK() OVER (ORDER BY avg_ads_clicked DESC NULLS LAST) AS ads_value_rank FROM a""")
def q4(spark, sf_dir):
    return reports.loyalty_segments(clean_users(spark, sf_dir))


@query("q5_ad_targeting", USERS_SQL + f""", a AS (
  SELECT income_level, employment_status, preferred_content_theme, COUNT(*) AS total_users,
    {mean("ads_clicked_per_day", 3)} AS avg_ads_clicked,
    {mean("daily_active_minutes_instagram", 2)} AS avg_time_online_mins,
    {mean("user_engagement_score", 4)} AS avg_engagement,
    {mean("followers_count", 0)} AS avg_followers
  FROM users GROUP BY ALL HAVING COUNT(*) > {MORE_THAN}
), b AS (
  SELECT *, avg_ads_clicked / NULLIF(avg_time_online_mins / 60.0::DOUBLE, 0) AS exact FROM a)
SELECT * EXCLUDE (exact), {half_up("exact", 3)} AS ads_click_per_hour,
  RANK() OVER (ORDER BY exact DESC NULLS LAST) AS targeting_rank FROM b
ORDER BY ads_click_per_hour DESC NULLS LAST, exact DESC NULLS LAST,
  income_level NULLS LAST, employment_status NULLS LAST, preferred_content_theme NULLS LAST
LIMIT {V.TOP_TARGETS}""")
def q5(spark, sf_dir):
    return reports.ad_targeting(clean_users(spark, sf_dir), more_than=MORE_THAN)


@query("q6_plan_tier", USERS_SQL + f""", a AS (
  SELECT subscription_status, {TIER} AS notif_responsiveness, COUNT(*) AS user_count,
    {mean("linked_accounts_count", 2)} AS avg_linked_accounts,
    {mean("user_engagement_score", 4)} AS avg_engagement,
    {mean("daily_active_minutes_instagram", 1)} AS avg_ig_minutes,
    {mean("sessions_per_day", 2)} AS avg_sessions,
    {mean("notification_response_rate", 1, " * 100")} AS avg_notif_rate_pct
  FROM users GROUP BY ALL)
SELECT *, {share("user_count", "SUM(user_count) OVER (PARTITION BY subscription_status)")}
    AS pct_in_plan,
  ROW_NUMBER() OVER (PARTITION BY subscription_status
    ORDER BY avg_engagement DESC NULLS LAST, notif_responsiveness) AS engage_rank_in_plan FROM a""")
def q6(spark, sf_dir):
    return reports.plan_and_notifications(clean_users(spark, sf_dir))


@query("q7_exercise_usage", USERS_SQL + f"""
SELECT {EXERCISE} AS muc_tap_the_duc, {USAGE} AS muc_dung_instagram, COUNT(*) AS so_nguoi_dung,
  {mean("sleep_hours_per_night", 2)} AS gio_ngu_tb,
  {mean("perceived_stress_score", 2)} AS diem_stress_tb,
  {mean("self_reported_happiness", 2)} AS diem_hanh_phuc_tb,
  {mean("body_mass_index", 2)} AS bmi_tb, {mean("daily_steps_count", 0)} AS so_buoc_chan_tb,
  RANK() OVER (PARTITION BY {EXERCISE} ORDER BY AVG(perceived_stress_score) DESC NULLS LAST)
    AS xep_hang_stress_trong_nhom
FROM users GROUP BY 1, 2 HAVING COUNT(*) >= {AT_LEAST}""")
def q7(spark, sf_dir):
    return reports.exercise_and_usage(clean_users(spark, sf_dir), at_least=AT_LEAST)


Z_SQL = USERS_SQL + """, s AS (
  SELECT """ + ", ".join(
    f"AVG({c}) AS mean_{n}, STDDEV_POP({c}) AS sd_{n}" for n, c in V.ANOMALY_MEASURES.items()
) + """ FROM users
), z AS (
  SELECT users.*, """ + ", ".join(
    f"ABS(({c} - mean_{n}) / NULLIF(sd_{n}, 0)) AS z_{n}" for n, c in V.ANOMALY_MEASURES.items()
) + f""" FROM users, s
), flagged AS (
  SELECT *, {half_up("z_mins + z_eng + z_flw + z_clicks", 4)} AS total_anomaly_score,
    {ANOMALY} AS nhom_phan_loai FROM z
)"""


@query("q8_anomaly", Z_SQL + f"""
SELECT nhom_phan_loai, COUNT(*) AS so_nguoi_dung,
  {share("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS ty_le_phan_tram,
  {mean("total_anomaly_score", 4)} AS diem_bat_thuong_tb,
  {mean("followers_count", 0)} AS followers_tb, {mean("ads_clicked_per_day", 2)} AS so_click_ads_tb,
  {mean("daily_active_minutes_instagram", 2)} AS phut_dung_ig_tb,
  {mean("user_engagement_score", 4)} AS diem_tuong_tac_tb
FROM flagged GROUP BY nhom_phan_loai""")
def q8(spark, sf_dir):
    return reports.anomaly_classes(clean_users(spark, sf_dir))


@query("q9_country_rank", USERS_SQL + f""", a AS (
  SELECT {DECADE} AS age_group, country, COUNT(*) AS user_count,
    {mean("user_engagement_score", 4)} AS avg_engagement_score,
    {mean("daily_active_minutes_instagram", 1)} AS avg_daily_mins
  FROM users GROUP BY ALL)
SELECT *, RANK() OVER (PARTITION BY age_group ORDER BY avg_engagement_score DESC NULLS LAST)
  AS ranking FROM a""")
def q9(spark, sf_dir):
    return reports.countries_by_age(clean_users(spark, sf_dir))


@query("q10_generation", USERS_SQL + f"""
SELECT {GENERATION} AS age_group, COUNT(*) AS user_count,
  {mean("daily_active_minutes_instagram", 2)} AS avg_instagram_minutes,
  {mean("sessions_per_day", 2)} AS avg_sessions,
  {mean("user_engagement_score", 4)} AS avg_engagement,
  {mean("perceived_stress_score", 2)} AS avg_stress,
  {mean("self_reported_happiness", 2)} AS avg_happiness,
  {mean("posts_created_per_week", 2)} AS avg_posts, {mean("followers_count", 0)} AS avg_followers
FROM users GROUP BY ALL""")
def q10(spark, sf_dir):
    return reports.generations(clean_users(spark, sf_dir))
