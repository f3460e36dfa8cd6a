"""Column lists of the stored tables. Loading and saving project to these; missing columns are null, extra ones dropped."""

from __future__ import annotations

from pyspark.sql.types import StructType

TABLES: dict[str, str] = {
    "accounts": ("account_id string, company string, in_universe boolean, active boolean, exclude boolean, hq string, "
                   "pipeline_status string, deal_owner string, primary_modalities string, modality_footprint string, "
                   "lineage_summary string, notes string"),
    "sites": ("site_id string, account_id string, region string, site string, city string, metro string, functions string, "
                "modality string, icp_fit string, icp_fit_reason string, verdict_auto string, verdict_manual string, "
                "named_site_head string, acquired_lineage string, source string"),
    "people": ("person_id string, account_id string, site_id string, name string, title string, persona string, "
                 "surfaced_via string, source_url string"),
    "signals": ("signal_id string, account_id string, site_id string, signal_type string, title string, date string, "
                  "named_people array<string>, topic string, confidence string, url string, source string"),
    "postings": ("posting_id string, account_id string, mirror_account_id string, mirror_site_id string, mirror_basis string, "
                   "site_id string, site_resolution string, n_site_candidates bigint, city_slug string, city_raw string, "
                   "icp_fit string, role_title string, role_slug string, req_id string, url_form string, careers_host string, "
                   "job_family string, job_family_rule string, seniority_rank int, seniority_rule string, excluded string, "
                   "tier2_admit boolean, tier2_score int, url string, first_seen date, last_seen date, seen_count bigint, "
                   "period_first string, period_last string, posted_date date, posted_date_source string, "
                   "extraction_tier string, body_chars int, extract_status string, last_run_id string"),
    "extracts": ("posting_id string, account_id string, team_name string, team_slug string, team_acronym string, "
                   "parent_org string, parent_slug string, supports_teams array<string>, reports_to_title string, "
                   "hiring_manager string, site_stated string, tech_stack array<string>, vocabulary array<string>, "
                   "autonomy_flag string, extraction_tier string, extract_status string, n_claims_dropped int"),
    "quotes": ("quote_id string, posting_id string, account_id string, claim_type string, subject string, subject_slug string, "
                 "quote_text string, verbatim_verified boolean, match_method string, display_date date, date_kind string"),
    "runs": ("run_id string, kind string, started_at timestamp, finished_at timestamp, accounts bigint, urls_seen bigint, "
               "new_urls bigint, extracted bigint, quarantined bigint, verify_pass_rate double, notes string"),
    "news_items": ("item_id string, account_id string, query_kind string, site_id array<string>, title string, source string, "
                     "url string, published date, snippet string"),
}


def schema(name: str) -> StructType:
    """The schema of a stored table; needs an active session."""
    return StructType.fromDDL(TABLES[name])
