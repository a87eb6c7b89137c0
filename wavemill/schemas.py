"""Table layouts. Arrays that run in parallel are columns keyed by (record_id, ordinal)."""

SCHEMA_VERSION = 1
RECORDS = "record_id string, sample_rate_hz double, sample_count bigint, channel_names array<string>, units array<string>"
CHUNKS = "record_id string, channel_index int, channel_name string, chunk_id bigint, start_index bigint, samples array<double>"
ANNOTATIONS = "record_id string, ordinal bigint, sample_index bigint, symbol string"
MAPPING = "symbol string, target_name string, target_value int, excluded boolean"
WINDOWS = "record_id string, ordinal bigint, center_sample_index bigint, source_symbol string, target_value int, window array<double>"
FILES = "path string, size_bytes bigint, sha256 string"
MANIFEST = "schema_version int, files array<struct<path: string, size_bytes: bigint, sha256: string>>"
VIOLATIONS = "check string, partition string, severity string, message string"
