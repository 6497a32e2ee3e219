"""Log templates by a token tree.

Lines are grouped as a fixed-depth token tree does it: by their number of tokens and their first tokens.  Tokens that hold
a digit are variable from the start.  Inside a group, positions with many different values are variable too: first those with
more than ``max_values``; then, in groups that still have more than ``max_templates`` templates, those with more than half
as many, a quarter, and so on down to one.  So after a few rounds each group has few templates, whatever the lines hold,
and these are merged by similarity: from the most frequent on, a template joins the first one before it that has enough
tokens in common, and positions where they differ become variable.

Each round is a map-side combined count over the distinct lines that are left; only the last step collects a group, of at
most ``max_templates`` rows.  All of it is built-in functions, so that it runs inside the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.storage import delete_path, new_location

ANY = "<*>"


def _staged(df: DataFrame) -> tuple[DataFrame, str]:
    spark, path = df.sparkSession, new_location(df.sparkSession, "templates")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _tokens(line: Column) -> Column:
    """Parts between white space; one that holds a digit is variable."""
    parts = F.split(F.trim(F.regexp_replace(F.coalesce(line, F.lit("")), r"\s+", " ")), " ")
    return F.transform(parts, lambda t: F.when(t.rlike("[0-9]"), F.lit(ANY)).otherwise(t))


def _wider(found: DataFrame, by: list[str], lead: int, more_than: int, crowded: int | None) -> DataFrame:
    """``found`` with the positions of more than ``more_than`` values variable, in groups of more than ``crowded`` templates."""
    values = found.select(*by, F.posexplode("tokens").alias("at", "token")).where((F.col("at") >= lead) & (F.col("token") != ANY))
    many = values.distinct().groupBy(*by, "at").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > more_than)
    wild = many.groupBy(*by).agg(F.collect_set("at").alias("wild"))  # at most a position for each token
    if crowded is not None:
        wild = wild.join(found.groupBy(*by).agg(F.count(F.lit(1)).alias("t")).where(F.col("t") > crowded).select(*by), by, "left_semi")
    tokens = F.when(F.col("wild").isNull(), F.col("tokens")).otherwise(
        F.transform("tokens", lambda t, i: F.when(F.array_contains("wild", i), F.lit(ANY)).otherwise(t)))
    return found.join(wild, by, "left").select(*by, tokens.alias("tokens"), "n").groupBy(*by, "tokens").agg(F.sum("n").alias("n"))


def _merged(members: Column, similarity: float) -> Column:
    """Templates of one group, most frequent first, merged into those before them that are alike."""
    kind = "array<struct<tokens:array<string>,n:bigint>>"

    def alike(one: Column, other: Column) -> Column:
        same = F.filter(F.zip_with(one, other, lambda a, b: (a == b) & (a != ANY)), lambda x: x)
        return F.size(same) >= similarity * F.size(one)

    def add(leaders: Column, x: Column) -> Column:
        places = F.filter(F.transform(leaders, lambda l, i: F.when(alike(l["tokens"], x["tokens"]), i)), lambda i: i.isNotNull())
        # the place is bound once, as the element of a list of one
        return F.transform(F.array(F.try_element_at(places, F.lit(1))), lambda at: F.when(at.isNull(), F.array_append(leaders, x)).otherwise(
            F.transform(leaders, lambda l, i: F.when(i == at, F.struct(
                F.zip_with(l["tokens"], x["tokens"], lambda a, b: F.when(a == b, a).otherwise(F.lit(ANY))).alias("tokens"),
                (l["n"] + x["n"]).alias("n"))).otherwise(l))))[0]

    plain = F.transform(F.array_sort(members), lambda m: F.struct(m["tokens"].alias("tokens"), (-m["neg"]).alias("n")))
    return F.aggregate(plain, F.array().cast(kind), add)


def mine_templates(logs: DataFrame, line: str = "msg", by: tuple[str, ...] = (), lead: int = 1, max_values: int = 10, max_templates: int = 64,
                   similarity: float = 0.6) -> DataFrame:
    """(``by``..., template, n): templates of the text column ``line`` and how many lines have each.

    ``lead`` tokens name the group besides the number of tokens; ``similarity`` is the share of all tokens that two
    templates must have in common, variable ones not counted, to be merged (above 1: none are).  A null line is an empty
    one.  Every line is counted once, in one template.
    """
    spark = logs.sparkSession
    own = [f"by_{i}" for i in range(len(by))]
    tokens = logs.select(*(F.col(c).alias(o) for c, o in zip(by, own)), _tokens(F.col(line)).alias("tokens"))
    found = tokens.groupBy(*own, "tokens").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("size", F.size("tokens")).withColumn("lead", F.concat_ws(" ", F.slice("tokens", 1, lead)))
    for c in own:  # a null label is a value of its own
        found = found.withColumn(c, F.struct(F.col(c).alias("label")))
    group = [*own, "size", "lead"]
    found, path = _staged(found)
    more_than, crowded = max_values, None
    while True:
        wider, next_path = _staged(_wider(found, group, lead, more_than, crowded))
        delete_path(spark, path)
        found, path, crowded = wider, next_path, max_templates
        if more_than <= 1 or found.groupBy(*group).count().where(F.col("count") > max_templates).isEmpty():
            break
        more_than = max(more_than // 2, 1)
    members = F.collect_list(F.struct((-F.col("n")).alias("neg"), "tokens"))
    merged = found.groupBy(*group).agg(_merged(members, similarity).alias("merged")).select(*own, F.inline("merged"))
    return merged.select(*(F.col(o)["label"].alias(c) for c, o in zip(by, own)), F.array_join("tokens", " ").alias("template"), "n")
