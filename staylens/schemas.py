"""Schemas of the raw files, the star schema and the layers.

All names are lower case; Spark resolves them case-insensitively, so inputs
with mixed-case headers bind without renaming.
"""
from __future__ import annotations

from pyspark.sql import types as T

# Layers (one namespace each) of the modelled job.
LAYERS = ("raw", "staging", "datawarehouse", "datamart")

# ---------------------------------------------------------------------------
# Raw monthly listing snapshot file (one row per listing per scrape).
# ---------------------------------------------------------------------------
SNAPSHOT_FIELDS = [
    ("listing_id", T.LongType()),
    ("scrape_id", T.LongType()),
    ("scraped_date", T.StringType()),
    ("host_id", T.LongType()),
    ("host_name", T.StringType()),
    ("host_since", T.StringType()),
    ("host_is_superhost", T.StringType()),
    ("host_neighbourhood", T.StringType()),
    ("listing_neighbourhood", T.StringType()),
    ("property_type", T.StringType()),
    ("room_type", T.StringType()),
    ("accommodates", T.LongType()),
    ("price", T.LongType()),
    ("has_availability", T.StringType()),
    ("availability_30", T.LongType()),
    ("number_of_reviews", T.LongType()),
    ("review_scores_rating", T.DoubleType()),
    ("review_scores_accuracy", T.DoubleType()),
    ("review_scores_cleanliness", T.DoubleType()),
    ("review_scores_checkin", T.DoubleType()),
    ("review_scores_communication", T.DoubleType()),
    ("review_scores_value", T.DoubleType()),
]
SNAPSHOT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in SNAPSHOT_FIELDS])

REVIEW_SCORE_COLUMNS = [
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_value",
]

# Listing dimension (surrogate id + 15 columns); review scores are whole numbers.
LISTING_DIM_COLUMNS = [
    "listing_id", "listing_neighbourhood", "property_type", "room_type",
    "accommodates", "price", "has_availability", "availability_30",
    "number_of_reviews", *REVIEW_SCORE_COLUMNS,
]

# Host dimension (surrogate id + 8 columns).
HOST_DIM_COLUMNS = [
    "listing_id", "scrape_id", "scraped_date", "host_id", "host_name",
    "host_since", "host_is_superhost", "host_neighbourhood",
]

# ---------------------------------------------------------------------------
# Census reference files. The column names of the census
# dimension, in the dimension's order (108 person counts, then 8 medians and
# averages). They must match the source files' headers.
# ---------------------------------------------------------------------------
CENSUS_COUNT_COLUMNS = [
    "tot_p_m", "tot_p_f", "tot_p_p",
    "age_0_4_yr_m", "age_0_4_yr_f", "age_0_4_yr_p",
    "age_5_14_yr_m", "age_5_14_yr_f", "age_5_14_yr_p",
    "age_15_19_yr_m", "age_15_19_yr_f", "age_15_19_yr_p",
    "age_20_24_yr_m", "age_20_24_yr_f", "age_20_24_yr_p",
    "age_25_34_yr_m", "age_25_34_yr_f", "age_25_34_yr_p",
    "age_35_44_yr_m", "age_35_44_yr_f", "age_35_44_yr_p",
    "age_45_54_yr_m", "age_45_54_yr_f", "age_45_54_yr_p",
    "age_55_64_yr_m", "age_55_64_yr_f", "age_55_64_yr_p",
    "age_65_74_yr_m", "age_65_74_yr_f", "age_65_74_yr_p",
    "age_75_84_yr_m", "age_75_84_yr_f", "age_75_84_yr_p",
    "age_85ov_m", "age_85ov_f", "age_85ov_p",
    "counted_census_night_home_m", "counted_census_night_home_f", "counted_census_night_home_p",
    "count_census_nt_ewhere_aust_m", "count_census_nt_ewhere_aust_f", "count_census_nt_ewhere_aust_p",
    "indigenous_psns_aboriginal_m", "indigenous_psns_aboriginal_f", "indigenous_psns_aboriginal_p",
    "indig_psns_torres_strait_is_m", "indig_psns_torres_strait_is_f", "indig_psns_torres_strait_is_p",
    "indig_bth_abor_torres_st_is_m", "indig_bth_abor_torres_st_is_f", "indig_bth_abor_torres_st_is_p",
    "indigenous_p_tot_m", "indigenous_p_tot_f", "indigenous_p_tot_p",
    "birthplace_australia_m", "birthplace_australia_f", "birthplace_australia_p",
    "birthplace_elsewhere_m", "birthplace_elsewhere_f", "birthplace_elsewhere_p",
    "lang_spoken_home_eng_only_m", "lang_spoken_home_eng_only_f", "lang_spoken_home_eng_only_p",
    "lang_spoken_home_oth_lang_m", "lang_spoken_home_oth_lang_f", "lang_spoken_home_oth_lang_p",
    "australian_citizen_m", "australian_citizen_f", "australian_citizen_p",
    "age_psns_att_educ_inst_0_4_m", "age_psns_att_educ_inst_0_4_f", "age_psns_att_educ_inst_0_4_p",
    "age_psns_att_educ_inst_5_14_m", "age_psns_att_educ_inst_5_14_f", "age_psns_att_educ_inst_5_14_p",
    "age_psns_att_edu_inst_15_19_m", "age_psns_att_edu_inst_15_19_f", "age_psns_att_edu_inst_15_19_p",
    "age_psns_att_edu_inst_20_24_m", "age_psns_att_edu_inst_20_24_f", "age_psns_att_edu_inst_20_24_p",
    "age_psns_att_edu_inst_25_ov_m", "age_psns_att_edu_inst_25_ov_f", "age_psns_att_edu_inst_25_ov_p",
    "high_yr_schl_comp_yr_12_eq_m", "high_yr_schl_comp_yr_12_eq_f", "high_yr_schl_comp_yr_12_eq_p",
    "high_yr_schl_comp_yr_11_eq_m", "high_yr_schl_comp_yr_11_eq_f", "high_yr_schl_comp_yr_11_eq_p",
    "high_yr_schl_comp_yr_10_eq_m", "high_yr_schl_comp_yr_10_eq_f", "high_yr_schl_comp_yr_10_eq_p",
    "high_yr_schl_comp_yr_9_eq_m", "high_yr_schl_comp_yr_9_eq_f", "high_yr_schl_comp_yr_9_eq_p",
    "high_yr_schl_comp_yr_8_belw_m", "high_yr_schl_comp_yr_8_belw_f", "high_yr_schl_comp_yr_8_belw_p",
    "high_yr_schl_comp_d_n_g_sch_m", "high_yr_schl_comp_d_n_g_sch_f", "high_yr_schl_comp_d_n_g_sch_p",
    "count_psns_occ_priv_dwgs_m", "count_psns_occ_priv_dwgs_f", "count_psns_occ_priv_dwgs_p",
    "count_persons_other_dwgs_m", "count_persons_other_dwgs_f", "count_persons_other_dwgs_p",
]
CENSUS_MEDIAN_FIELDS = [
    ("median_age_persons", T.LongType()),
    ("median_mortgage_repay_monthly", T.LongType()),
    ("median_tot_prsnl_inc_weekly", T.LongType()),
    ("median_rent_weekly", T.LongType()),
    ("median_tot_fam_inc_weekly", T.LongType()),
    ("average_num_psns_per_bedroom", T.DoubleType()),
    ("median_tot_hhd_inc_weekly", T.LongType()),
    ("average_household_size", T.DoubleType()),
]
CENSUS_MEDIAN_COLUMNS = [n for n, _ in CENSUS_MEDIAN_FIELDS]

# The four age bands the ad-hoc LGA report sums (3 columns each).
ADHOC_AGE_COLUMNS = [
    "age_0_4_yr_m", "age_0_4_yr_f", "age_0_4_yr_p",
    "age_5_14_yr_m", "age_5_14_yr_f", "age_5_14_yr_p",
    "age_15_19_yr_m", "age_15_19_yr_f", "age_15_19_yr_p",
    "age_20_24_yr_m", "age_20_24_yr_f", "age_20_24_yr_p",
]

CENSUS_01_SCHEMA = T.StructType(
    [T.StructField("lga_code_2016", T.StringType(), True)]
    + [T.StructField(c, T.LongType(), True) for c in CENSUS_COUNT_COLUMNS])
CENSUS_02_SCHEMA = T.StructType(
    [T.StructField("lga_code_2016", T.StringType(), True)]
    + [T.StructField(n, t, True) for n, t in CENSUS_MEDIAN_FIELDS])
LGA_CODE_SCHEMA = T.StructType([
    T.StructField("lga_code", T.LongType(), True),
    T.StructField("lga_name", T.StringType(), True)])
LGA_SUBURB_SCHEMA = T.StructType([
    T.StructField("lga_name", T.StringType(), True),
    T.StructField("suburb_name", T.StringType(), True)])

# Raw files the job knows by name (base name up to the first '.').
RAW_SCHEMAS = {
    "census_01": CENSUS_01_SCHEMA,
    "census_02": CENSUS_02_SCHEMA,
    "nsw_lga_code": LGA_CODE_SCHEMA,
    "nsw_lga_suburb": LGA_SUBURB_SCHEMA,
}
