"""Readers: header-safe CSV, lineage columns, table scans."""
