"""Readers for delimited records, text corpora and word lists."""
