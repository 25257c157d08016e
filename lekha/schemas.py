"""Schemas of the entities as DDL; strings keep their source form, scores are doubles."""

RAW = "seq bigint, source_name string, source_doc_id string, source_url string, license_tag string, pull_timestamp_utc string, text_raw string, script_hint string, lang_hint string, row_hash string, aksharantar_source string, aksharantar_score double, paired_with string, article_title string, takedown_contact string, model string, prompt_version string, category string"
PAIR = "pair_id string, roman_text string, telugu_text string, source_name string, license_tag string, pair_source string, quality_score double, confidence double, review_status string, created_at string, augmentation_variant string"
MANIFEST = "run_id string, source_name string, pull_timestamp_utc string, record_count bigint, output_file string, license_tag string, takedown_contact string"
REVIEW_SCORE = "ollama_score double, ollama_reason string, ollama_flag boolean, ollama_model string"
