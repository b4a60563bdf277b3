"""Training-data operators: secrets, toxicity, quality, WARC, decontamination, dedup, tokens, mixing.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered queries and ``oracle`` their DuckDB SQL.
"""
