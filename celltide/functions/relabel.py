"""Label rules on a ``MAP<STRING,STRING>`` column.

A rule is the usual relabel configuration: ``source_labels`` joined by
``separator``, a fully anchored ``regex``, a ``replacement`` with ``$1``
references and a ``target_label``.  Actions: ``replace``, ``keep``, ``drop``,
``labelmap``, ``labeldrop``, ``labelkeep``.  A missing source label counts as
the empty string; a replacement that yields the empty string removes the
target label; a ``replace`` whose regex does not match leaves the target as
it was.  Every rule compiles to built-in expressions (``rlike``,
``regexp_replace``, ``map_filter``, ``transform``).  A key that is written twice
keeps its last value: ``configure`` sets ``spark.sql.mapKeyDedupPolicy`` so, and
without it a repeated key fails the job.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    action: str = "replace"
    source_labels: tuple[str, ...] = field(default_factory=tuple)
    separator: str = ";"
    regex: str = "(.*)"
    replacement: str = "$1"
    target_label: str = ""


def anchored(regex: str) -> str:
    return rf"\A(?:{regex})\z"


def java_replacement(rep: str) -> str:
    """``${1}`` -> ``$1``; backslashes made literal for Java's replacement syntax."""
    rep = rep.replace("\\", "\\\\")
    return re.sub(r"\$\{(\d+)\}", r"$\1", rep)


def _assemble(labels: Column, changed: dict[str, Column]) -> Column:
    """``labels`` with the ``changed`` labels replaced; empty or NULL values removed."""
    if not changed:
        return labels
    overlay = F.map_from_arrays(F.array(*[F.lit(n) for n in changed]), F.array(*changed.values()))
    return F.map_filter(F.map_concat(labels, overlay), lambda k, v: v.isNotNull() & (v != ""))


def _labelmap(labels: Column, rx: str, rep: str) -> Column:
    """Matching keys get a renamed copy that wins over an existing label of that name; of several copies to one name
    that of the last label in the order of names wins, as label sets are sorted.

    The map is built once, from the labels and then the copies; each key is matched and renamed once.
    """
    entries = F.map_entries(labels)
    renamed = F.transform(F.array_sort(F.filter(entries, lambda e: e["key"].rlike(rx))),
                          lambda e: F.struct(F.regexp_replace(e["key"], rx, rep).alias("key"),
                                             e["value"].alias("value")))
    return F.map_from_entries(F.concat(entries, renamed))


def _whole_map(labels: Column, rule: Rule) -> Column:
    """The labels after a rule that looks at every label."""
    rx = anchored(rule.regex)
    if rule.action == "labelmap":
        return _labelmap(labels, rx, java_replacement(rule.replacement))
    if rule.action == "labeldrop":
        return F.map_filter(labels, lambda k, v: ~k.rlike(rx))
    if rule.action == "labelkeep":
        return F.map_filter(labels, lambda k, v: k.rlike(rx))
    raise ValueError(f"unsupported relabel action {rule.action!r}")


def relabel(df: DataFrame, rules: list[Rule], col: str = "labels",
            drop_internal: bool = False) -> DataFrame:
    """Apply ``rules`` in order; ``keep``/``drop`` rules filter rows.

    Each ``replace`` rule writes one plain string column (the new value of its
    target label) instead of rebuilding the map, and later rules read that
    column; the map is assembled once at the end, or before a rule that looks
    at every label (``labelmap``, ``labeldrop``, ``labelkeep``).  With
    ``drop_internal`` labels starting with ``__`` are removed at the end, as
    after target relabelling.
    """
    changed: dict[str, Column] = {}
    tmp: list[str] = []

    def value(name: str) -> Column:
        return changed.get(name, F.col(col).getItem(name))

    def src(rule: Rule) -> Column:
        if not rule.source_labels:
            return F.lit("")
        return F.concat_ws(rule.separator, *[F.coalesce(value(n), F.lit("")) for n in rule.source_labels])

    for rule in rules:
        rx = anchored(rule.regex)
        if rule.action == "replace":
            s = src(rule)
            new = F.when(s.rlike(rx), F.regexp_replace(s, rx, java_replacement(rule.replacement))) \
                .otherwise(value(rule.target_label))
            tmp.append(f"_rl{len(tmp)}")
            df = df.withColumn(tmp[-1], new)
            changed[rule.target_label] = F.col(tmp[-1])
        elif rule.action in ("keep", "drop"):
            m = src(rule).rlike(rx)
            df = df.where(m if rule.action == "keep" else ~m)
        else:
            df = df.withColumn(col, _assemble(F.col(col), changed))
            changed = {}
            df = df.withColumn(col, _whole_map(F.col(col), rule))
    df = df.withColumn(col, _assemble(F.col(col), changed))
    if drop_internal:
        df = df.withColumn(col, F.map_filter(F.col(col), lambda k, v: ~k.startswith("__")))
    return df.drop(*tmp)
