"""Relational building blocks: dedup, time-aware joins, numbering and upserts."""
