"""Operators of a training-data pipeline (chat formatting, tokenising, deduplication,
decontamination, scoring, extraction, scanning, fingerprints). Nothing outside this
subpackage imports it; ``queries`` holds the registered queries and their SQL."""
