"""Schemas of the landed inputs; none is ever inferred."""

from __future__ import annotations

FEED_ITEM = (
    "source_name string, source_ord int, item_ord int, title string, summary string,"
    " description string, link string, published string"
)
SEARCH_RESPONSE = (
    "query string, query_ord int,"
    " hits array<struct<title: string, url: string, objectID: string, created_at: string>>"
)
CLAIM = (
    "company_name string, business_idea string, industry string, location string,"
    " event_type string, value string, investors string, evidence_excerpt string,"
    " source_index int, confidence double, status string, notes string"
)
#: A record of the older extraction.
STARTUP_RECORD = (
    "company_name string, business_idea string, industry string, location string, funding_stage string, funding_amount string,"
    " investors string, founder_name string, year_founded string, source_index int"
)
IDENTITY_COLUMNS = [
    "company_id", "canonical_name", "normalized_name", "primary_domain", "headquarters_country", "description",
]
ALIAS_COLUMNS = ["company_id", "normalized_alias"]
QUALITY_REPORT = (
    "generated_at timestamp, score_version string, run_status string, n_ranked long,"
    " qualified_company_count_by_region map<string, long>, shortfall_by_region map<string, long>,"
    " rejected_candidate_count_by_reason map<string, long>, missingness_by_field map<string, double>,"
    " source_tier_distribution map<int, long>, invalid_homepage_count long, ambiguous_funding_count long,"
    " valuation_shown_as_funding_count long, stale_record_count long, duplicate_candidates_detected long,"
    " confidence_distribution map<string, long>, pct_ranked_with_confidence_ge_70 double,"
    " pct_ranked_with_two_sources_or_authoritative double, pct_ranked_with_verified_headquarters double,"
    " pct_ranked_with_verified_funding_dates double, pct_ranked_with_verified_employee_ranges double,"
    " pct_ranked_with_verified_hiring_data double, pct_ranked_with_recent_verified_event double,"
    " pct_ranked_with_verified_regional_assignment double, pct_ranked_with_valid_primary_domain double,"
    " pct_material_funding_claims_with_evidence double, llm_extraction_failure_rate double,"
    " provider_fallback_usage map<string, long>, passed_launch_thresholds boolean, threshold_failures array<string>"
)
RUN = (
    "run_id string, workflow_type string, score_version string, started_at timestamp, finished_at timestamp,"
    " run_status string, published boolean, articles_fetched long, candidates_extracted long, validation_failures long,"
    " companies_accepted long, companies_rejected long, regional_result_counts map<string, long>,"
    f" quality_report struct<{QUALITY_REPORT}>"
)
#: The published columns of a company, as readers are promised them.
RANKING = (
    "company_id string, canonical_name string, normalized_name string, primary_domain string, homepage string, homepage_confidence int,"
    " description string, industry string, subsector string, ai_relevance_score int, company_status string, founded_year string,"
    " headquarters_city string, headquarters_state string, headquarters_country string, region_bucket string, founders string,"
    " employee_count_min int, employee_count_max int, employee_count_as_of date, moat_summary string, moat_evidence string,"
    " moat_confidence int, hiring_status string, hiring_confidence int, verified_open_role_count int, latest_funding_stage string,"
    " latest_funding_amount_usd double, latest_funding_date date, total_disclosed_funding_usd double, momentum_score int,"
    " regional_rank int, rank_change_since_previous_snapshot int, data_confidence int, data_completeness int, why_ranked string,"
    " score_version string, last_seen timestamp, last_verified timestamp, active boolean"
)
