"""Row layouts of each stage."""

# Field names and types of the stage records.
RAW_REQUIRED = ("id", "url", "domain", "content_hash", "timestamp")
RAW = """
    id string, url string, domain string, title string, content string, content_length int,
    links_found int, depth int, status_code int, timestamp string, content_hash string,
    links array<string>
"""
CLEANED = """
    id string, original_url string, domain string, title string, content string,
    language string, language_confidence double, quality_score double, content_length int,
    token_estimate int, content_hash string, duplicate_hash string, timestamp string,
    source string, license string, tags array<string>
"""
SHARD = """
    doc_id string, tokens array<int>, attention_mask array<int>, language string,
    quality_score float, token_count int
"""
SPLIT_MANIFEST = """
    version string, created_at string, total_shards bigint, total_documents bigint,
    total_tokens bigint,
    shards array<struct<shard_id:string,documents:bigint,tokens:bigint,
        languages:map<string,bigint>,avg_quality:double,created_at:string>>
"""
VERSIONS = """
    version string, created_at string, description string,
    source_versions map<string,string>, statistics map<string,double>,
    quality_metrics map<string,double>, provenance map<string,string>, checksum string
"""
JOBS_TABLE = """
    id string, job_type string, status string, progress float, message string,
    parameters string, result string, created_at timestamp, updated_at timestamp,
    started_at timestamp, completed_at timestamp
"""
DOCUMENTS_TABLE = """
    id string, url string, domain string, title string, content_hash string,
    duplicate_hash string, language string, language_confidence float, quality_score float,
    content_length int, token_estimate int, crawl_depth int, status_code int,
    crawled_at timestamp, processed_at timestamp, job_id string
"""
VERSIONS_TABLE = """
    version string, description string, statistics string, quality_metrics string,
    provenance string, checksum string, created_at timestamp, file_count int,
    total_size_bytes bigint
"""
