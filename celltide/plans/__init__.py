"""Registered queries (``queries.py`` imports every family) and their DuckDB oracles.

``q_ingest``: catalog, topics, envelopes, typed views, the cells table and the streaming ingest;
``q_windows``: windows, lateness, dedup (batch and streaming); ``q_logs``: logs and labels;
``q_reports``: SLOs, shadow, audit; ``q_jobs``: whole jobs (repeated ingest, files, retention); ``oracles``: SQL building blocks shared by the oracles.
"""
