"""Fixed values of the wide user table: column names, category codes, accepted
ranges, thresholds and class labels.

They must be exactly these for results to agree with existing data and reports,
so they are stated here as plain data, in one place.
"""

from __future__ import annotations

# -- raw columns (57) -----------------------------------------------------------

KEY = "user_id"
REQUIRED = ["user_id", "age", "gender"]

DOUBLE_COLUMNS = [
    "exercise_hours_per_week",
    "sleep_hours_per_night",
    "weekly_work_hours",
    "volunteer_hours_per_month",
    "user_engagement_score",
    "body_mass_index",
    "notification_response_rate",
]

INT_COLUMNS = [
    "age",
    "perceived_stress_score",
    "self_reported_happiness",
    "blood_pressure_systolic",
    "blood_pressure_diastolic",
    "daily_steps_count",
    "hobbies_count",
    "social_events_per_month",
    "books_read_per_year",
    "travel_frequency_per_year",
    "daily_active_minutes_instagram",
    "sessions_per_day",
    "posts_created_per_week",
    "reels_watched_per_day",
    "stories_viewed_per_day",
    "likes_given_per_day",
    "comments_written_per_day",
    "dms_sent_per_week",
    "dms_received_per_week",
    "ads_viewed_per_day",
    "ads_clicked_per_day",
    "time_on_feed_per_day",
    "time_on_explore_per_day",
    "time_on_messages_per_day",
    "time_on_reels_per_day",
    "followers_count",
    "following_count",
    "account_creation_year",
    "linked_accounts_count",
    "average_session_length_minutes",
]

DATE_COLUMN = "last_login_date"
DATE_PATTERN = "M/d/yyyy"
TEXT_TO_REPAIR = "education_level"
YEAR_COLUMN = "account_creation_year"
AS_OF_YEAR = 2025
STRESS_SCALE = 40.0

# -- accepted ranges (closed) -----------------------------------------------------

ACCEPTED_RANGES = {
    "age": (13, 65),
    "sleep_hours_per_night": (3.0, 10.0),
    "exercise_hours_per_week": (0.0, 24.0),
    "weekly_work_hours": (0.0, 80.0),
    "body_mass_index": (15.0, 45.0),
    "average_session_length_minutes": (5, 52),
    "blood_pressure_systolic": (70, 200),
    "account_creation_year": (2010, 2025),
}
EXCLUDED_GENDER = "Prefer not to say"

# -- category codes -----------------------------------------------------------------

FLAG_CODES = {
    "gender": {"Male": 0.0, "Female": 1.0, "Non-binary": 2.0, "Prefer not to say": 3.0},
    "has_children": {"No": 0.0, "Yes": 1.0},
    "uses_premium_features": {"No": 0.0, "Yes": 1.0},
    "two_factor_auth_enabled": {"No": 0.0, "Yes": 1.0},
    "biometric_login_used": {"No": 0.0, "Yes": 1.0},
    "smoking": {"No": 0.0, "Former": 1.0, "Yes": 2.0},
}

ORDINAL_CODES = {
    "income_level": {
        "Low": 1.0, "Lower-middle": 2.0, "Middle": 3.0, "Upper-middle": 4.0, "High": 5.0,
    },
    "diet_quality": {
        "Very poor": 1.0, "Poor": 2.0, "Average": 3.0, "Good": 4.0, "Excellent": 5.0,
    },
    "alcohol_frequency": {
        "Never": 0.0, "Rarely": 1.0, "Weekly": 2.0, "Several times a week": 3.0, "Daily": 4.0,
    },
    "privacy_setting_level": {"Public": 0.0, "Friends only": 1.0, "Private": 2.0},
    "education_level": {
        "High school": 1.0, "Some college": 2.0, "Bachelor's": 3.0, "Master's": 4.0,
        "PhD": 5.0, "Other": 0.0,
    },
}

NOMINAL_COLUMNS = [
    "urban_rural",
    "employment_status",
    "relationship_status",
    "content_type_preference",
    "preferred_content_theme",
    "subscription_status",
    "country",
]

# -- report classes: (label, SQL predicate), first match wins ---------------------------

PERSONA = (
    "user_persona",
    [
        ("1. Pure Lurker   (Chi xem)", "posts_created_per_week = 0 AND reels_watched_per_day > 10"),
        ("2. Active Creator (Cham post)", "posts_created_per_week > 3 AND reels_watched_per_day < 5"),
    ],
    "3. Casual User    (Binh thuong)",
)

SESSION_HABIT = (
    "session_habit",
    [
        ("1. Short Sessions  (<15 min)", "average_session_length_minutes < 15"),
        ("2. Medium Sessions (15-45 min)", "average_session_length_minutes BETWEEN 15 AND 45"),
    ],
    "3. Doomscrolling   (>45 min)",
)

LOYALTY = (
    "user_segment",
    [
        ("1. Champions       (Trung thanh + Nang no)",
         "sessions_per_day >= 5 AND user_engagement_score >= 1.8"),
        ("2. Browsers        (Vao nhieu - It tuong tac)",
         "sessions_per_day >= 5 AND user_engagement_score < 1.8"),
        ("3. Quality Engagers(It vao - Chat luong cao)",
         "sessions_per_day < 5 AND user_engagement_score >= 1.8"),
    ],
    "4. At Risk          (Nguy co roi bo App)",
)

RESPONSE_TIER = (
    "notif_responsiveness",
    [
        ("1. High Response   (>70%)", "notification_response_rate > 0.7"),
        ("2. Medium Response (30-70%)", "notification_response_rate >= 0.3"),
    ],
    "3. Low Response    (<30%)",
)

EXERCISE_LEVEL = (
    "muc_tap_the_duc",
    [
        ("1. Khong tap (0h)", "exercise_hours_per_week = 0"),
        ("2. It tap    (<3h)", "exercise_hours_per_week < 3"),
        ("3. Vua phai  (3-6h)", "exercise_hours_per_week < 6"),
        ("4. Tich cuc  (6-10h)", "exercise_hours_per_week < 10"),
    ],
    "5. Cuong tap (>10h)",
)

USAGE_LEVEL = (
    "muc_dung_instagram",
    [
        ("1. Rat it   (<1h)", "daily_active_minutes_instagram < 60"),
        ("2. Vua phai (1-3h)", "daily_active_minutes_instagram < 180"),
        ("3. Nhieu    (3-5h)", "daily_active_minutes_instagram < 300"),
    ],
    "4. Nghien   (>5h)",
)

ANOMALY_CLASS = (
    "nhom_phan_loai",
    [
        ("Nghi Bot - Hoat dong qua muc", "z_mins > 2 AND z_eng > 2"),
        ("Nghi mua Followers ao", "z_flw > 3"),
        ("Nghi gian lan quang cao", "z_clicks > 2"),
        ("Bat thuong nhieu chieu - Can theo doi", "(z_mins + z_eng + z_flw) > 4"),
    ],
    "Nguoi dung binh thuong",
)

AGE_DECADE = (
    "age_group",
    [
        ("1. <20", "age < 20"),
        ("2. 20-30", "age BETWEEN 20 AND 30"),
        ("3. 31-40", "age BETWEEN 31 AND 40"),
        ("4. 41-50", "age BETWEEN 41 AND 50"),
    ],
    "5. >50",
)

GENERATION = (
    "age_group",
    [
        ("1. 14-29 (Gen Z)", "age BETWEEN 14 AND 29"),
        ("2. 30-45 (Millennial)", "age BETWEEN 30 AND 45"),
        ("3. 46-61 (Gen X)", "age BETWEEN 46 AND 61"),
    ],
    "4. 62+   (Baby Boomer)",
)

ANOMALY_MEASURES = {
    "mins": "daily_active_minutes_instagram",
    "eng": "user_engagement_score",
    "flw": "followers_count",
    "clicks": "ads_clicked_per_day",
}

MIN_GROUP_TARGETING = 500   # more than this many users per targeting group
MIN_GROUP_HEALTH = 100      # at least this many users per health group
TOP_TARGETS = 10

# -- clustering ---------------------------------------------------------------------------

CLUSTER_INPUTS = [
    "daily_active_minutes_instagram", "sessions_per_day", "average_session_length_minutes",
    "posts_created_per_week", "reels_watched_per_day", "stories_viewed_per_day",
    "likes_given_per_day", "comments_written_per_day", "dms_sent_per_week",
    "dms_received_per_week", "self_reported_happiness", "followers_count", "following_count",
    "notification_response_rate", "body_mass_index", "blood_pressure_systolic",
    "blood_pressure_diastolic", "daily_steps_count", "exercise_hours_per_week",
    "sleep_hours_per_night", "follower_following_ratio", "stress_score_normalized",
]

CLUSTER_FEATURES = [
    "daily_active_minutes_instagram", "sessions_per_day", "average_session_length_minutes",
    "creator_score", "consumer_score", "passive_active_ratio", "social_butterfly_index",
    "dm_reciprocity", "wellness_index", "stress_score_normalized", "self_reported_happiness",
    "followers_count", "follower_following_ratio", "addiction_risk_score",
    "usage_intensity_score",
]

CREATOR_WEIGHTS = {"posts_created_per_week": 1.5, "comments_written_per_day": 0.5}
CONSUMER_WEIGHTS = {"reels_watched_per_day": 1.0, "stories_viewed_per_day": 0.8}
RISK_WEIGHTS = {
    "daily_active_minutes_instagram": 0.4, "sessions_per_day": 1.5,
    "notification_response_rate": 10.0,
}
IDEAL_BMI, BMI_WEIGHT = 22, 3
IDEAL_SYSTOLIC, IDEAL_DIASTOLIC, PRESSURE_WEIGHT = 120, 80, 0.5
STEPS_PER_POINT, EXERCISE_WEIGHT, SLEEP_WEIGHT = 150, 5, 12.5
CLUSTERS = 4

# -- regression -----------------------------------------------------------------------------

REGRESSION_INPUTS = [
    "daily_active_minutes_instagram", "sessions_per_day", "time_on_reels_per_day",
    "notification_response_rate", "sleep_hours_per_night", "exercise_hours_per_week",
    "daily_steps_count", "age", "body_mass_index", "blood_pressure_systolic",
    "blood_pressure_diastolic", "time_on_feed_per_day",
]
REGRESSION_CATEGORIES = ["employment_status", "urban_rural"]
REGRESSION_LABEL = "perceived_stress_score"
REGRESSION_FEATURES = [
    "daily_active_minutes_instagram", "sessions_per_day", "time_on_reels_per_day",
    "notification_response_rate", "sleep_hours_per_night", "exercise_hours_per_week",
    "daily_steps_count", "age", "screen_to_sleep_ratio", "passive_consumption",
    "health_composite",
]
