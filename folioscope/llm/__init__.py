"""Training-data operators: quality, decontamination, mixing, token files, language, chat, PII, dedup, HTML, WARC.

Nothing outside this subpackage imports it. ``registry`` holds the queries and their SQL.
"""
