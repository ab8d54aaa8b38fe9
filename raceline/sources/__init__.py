"""Readers: benchmark parquet tables, JSON landing payloads, resume ledgers."""
