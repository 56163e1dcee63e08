"""User-level queries and the curation job."""
