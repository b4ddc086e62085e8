"""Column expressions: typing and cleaning of records, tokenising and stemming of text."""
