"""Scalar text helpers as Spark built-in expressions (no UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def path_base(c: Column) -> Column:
    """Text after the last ``/``; unchanged when there is none or it is trailing."""
    return F.when(c.rlike("/[^/]+$"), F.substring_index(c, "/", -1)).otherwise(c)


def trim_space(c: Column) -> Column:
    """Strip space, newline, tab and carriage return at both ends."""
    return F.btrim(c, F.lit(" \n\t\r"))


def iso_text(ts: Column, fmt: str = ISO_MICROS) -> Column:
    """ISO-8601 UTC text of a timestamp (session time zone must be UTC)."""
    return F.date_format(ts, fmt)


def format_text(template: str, *values: Column) -> Column:
    """``template`` with ``%s`` and ``%d`` filled in, as a format function does."""
    return F.format_string(template, *values)


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)


def prefixed_id(relation: Column, suffix: Column) -> Column:
    """``relation-suffix`` device id, and its parts back with ``id_relation``."""
    return F.concat_ws("-", relation, suffix)


def id_relation(device_id: Column) -> Column:
    return F.regexp_extract(device_id, r"^(.*)-[^-]*$", 1)


def mqtt_filter_regex(topic_filter: str) -> str:
    """Anchored regex for an MQTT topic filter (``+`` one level, ``#`` the rest).

    ``a/#`` also matches ``a``; wildcards at the first level do not match
    topics that start with ``$``.
    """
    levels = topic_filter.split("/")
    for i, lvl in enumerate(levels):
        if "#" in lvl and (lvl != "#" or i != len(levels) - 1):
            raise ValueError(f"'#' must be a whole last level: {topic_filter}")
        if "+" in lvl and lvl != "+":
            raise ValueError(f"'+' must be a whole level: {topic_filter}")
    out = ""
    for i, lvl in enumerate(levels):
        sep = "" if i == 0 else "/"
        if lvl == "#":
            out += "(?:/.*)?" if i > 0 else ".*"
        elif lvl == "+":
            out += sep + "[^/]*"
        else:
            out += sep + re.escape(lvl)
    guard = "(?!\\$)" if levels[0] in ("+", "#") else ""
    return f"^{guard}{out}$"


def topic_matches(topic: Column, filters: list[str]) -> Column:
    """True when ``topic`` matches any of the MQTT subscription filters."""
    conds = [topic.rlike(mqtt_filter_regex(f)) for f in filters]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out
