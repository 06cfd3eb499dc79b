"""The seed, the smoothing weight and the column lists of each table."""

SEED = 42
SMOOTHING = 20
TARGET = "click"

ID_COLUMNS = ["userid", "adgroup_id", "campaign_id", "customer"]

FACT_KEY = ["userid", "adgroup_id", "time_stamp"]
FACT_COLUMNS = [
    "userid", "adgroup_id", "time_stamp", "click", "pid", "hour", "weekday", "date", "_split",
]
AD_COLUMNS = ["adgroup_id", "cate_id", "campaign_id", "customer", "brand", "price"]
USER_COLUMNS = [
    "userid", "cms_segid", "cms_group_id", "final_gender_code", "age_level", "pvalue_level",
    "shopping_level", "occupation", "new_user_class_level",
]

CATEGORICAL_FEATURES = [
    "cate_id", "brand", "pid", "cms_segid", "cms_group_id", "final_gender_code", "age_level",
    "pvalue_level", "shopping_level", "occupation", "new_user_class_level", "hour", "weekday",
]
ENCODED_FEATURES = ["userid_te", "adgroup_id_te", "campaign_id_te", "customer_te"]

# The 23 numeric features that the statistics compare, by family.
FEATURE_GROUPS = {
    "User behavior": ["user_clicks_before", "user_impressions_before", "user_ctr_before"],
    "Domain": [
        "price", "ag_clicks_before", "ag_impressions_before", "ag_ctr_before", "ag_revenue_before",
        "cate_clicks_before", "cate_impressions_before", "cate_ctr_before",
        "pid_x_cate_id_freq", "cate_id_x_age_level_freq", "brand_x_cms_group_id_freq",
    ],
    "Time-series (rolling 1d/3d)": [
        "ag_impressions_last_1d", "ag_ctr_last_1d", "ag_impressions_last_3d", "ag_ctr_last_3d",
        "ag_ctr_trend_1d_vs_3d",
    ],
    "User-based & item-based (CF)": [
        "item_coclick_affinity", "user_cate_affinity_before", "user_brand_affinity_before",
        "user_price_gap",
    ],
}
GROUPED_FEATURES = [c for cols in FEATURE_GROUPS.values() for c in cols]
NUMERIC_FEATURES = ENCODED_FEATURES + GROUPED_FEATURES
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES

GOLD_KEYS = ["userid_key", "adgroup_id_key", "user_prev_clicked_item", "time_stamp", "_split", TARGET]
GOLD_COLUMNS = GOLD_KEYS + FEATURES

INTERACTIONS = [("pid", "cate_id"), ("cate_id", "age_level"), ("brand", "cms_group_id")]

AD_STATIC = ["cate_id", "brand", "price"]
AD_DYNAMIC = [
    "adgroup_id_te", "campaign_id_te", "customer_te", "ag_clicks_before", "ag_impressions_before",
    "ag_ctr_before", "ag_revenue_before", "ag_impressions_last_1d", "ag_ctr_last_1d",
    "ag_impressions_last_3d", "ag_ctr_last_3d", "ag_ctr_trend_1d_vs_3d",
]
CATEGORY_DYNAMIC = ["cate_clicks_before", "cate_impressions_before", "cate_ctr_before"]
USER_CONTEXT = [
    "pid", "cms_segid", "cms_group_id", "final_gender_code", "age_level", "pvalue_level",
    "shopping_level", "occupation", "new_user_class_level", "hour", "weekday", "userid_te",
    "user_clicks_before", "user_impressions_before", "user_ctr_before", "user_prev_clicked_item",
]
SEGMENT_COLUMNS = [
    "final_gender_code", "age_level", "shopping_level", "occupation", "pvalue_level",
    "new_user_class_level",
]

RECALL_KS = [10, 20, 50, 100]
LIFT_PERCENTS = [5, 10, 20, 30, 50, 100]
USER_BUCKET_EDGES = [0.0, 0.05, 0.10, 0.20, 0.50, 1.00]
USER_BUCKET_LABELS = ["Top 0-5%", "Top 5-10%", "Top 10-20%", "Top 20-50%", "Top 50-100%"]
# Upper bounds of |delta| for the effect labels; anything above is "Large".
EFFECT_CUTS = [(0.147, "Negligible"), (0.33, "Small"), (0.474, "Medium")]
DAY_US = 86_400_000_000
