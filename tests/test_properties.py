"""Randomised cross-checks of MQTT matching and relabel rules against plain
Python statements of the same rules (all cases evaluated in one Spark job)."""

import random
import re

from pyspark.sql import functions as F

from celltide.functions.relabel import Rule, relabel
from celltide.functions.text import topic_matches


def mqtt_match(flt: str, topic: str) -> bool:
    f, t = flt.split("/"), topic.split("/")
    if f[0] in ("+", "#") and topic.startswith("$"):
        return False
    for i, lvl in enumerate(f):
        if lvl == "#":
            return True
        if i >= len(t):
            return False
        if lvl != "+" and lvl != t[i]:
            return False
    return len(t) == len(f)


def test_mqtt_filters_random(spark):
    rng = random.Random(11)
    words = ["a", "b", "c", "$SYS", ""]
    cases = []
    for _ in range(400):
        topic = "/".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
        lv = [rng.choice(["a", "b", "+", ""]) for _ in range(rng.randint(1, 4))]
        if rng.random() < 0.4:
            lv.append("#")
        cases.append((topic, "/".join(lv)))
    df = spark.createDataFrame([(i, t, f) for i, (t, f) in enumerate(cases)], "i int, t string, f string")
    # one filter per row: evaluate each distinct filter as its own column expression
    filters = sorted({f for _, f in cases})
    cols = [topic_matches(F.col("t"), [f]).alias(f"m{j}") for j, f in enumerate(filters)]
    rows = df.select("i", "t", "f", *cols).collect()
    for r in rows:
        got = r[f"m{filters.index(r['f'])}"]
        assert got == mqtt_match(r["f"], r["t"]), (r["f"], r["t"])


def py_relabel(labels: dict, rules: list[Rule]):
    labels = dict(labels)
    for rule in rules:
        rx = re.compile(f"^(?:{rule.regex})$")
        src = rule.separator.join(labels.get(n, "") for n in rule.source_labels)
        if rule.action == "replace":
            m = rx.match(src)
            if m:
                val = m.expand(re.sub(r"\$(\d+)", r"\\\1", rule.replacement))
                if val == "":
                    labels.pop(rule.target_label, None)
                else:
                    labels[rule.target_label] = val
        elif rule.action == "keep" and not rx.match(src):
            return None
        elif rule.action == "drop" and rx.match(src):
            return None
        elif rule.action == "labelmap":
            for k, v in list(labels.items()):
                if rx.match(k):
                    labels[rx.sub(re.sub(r"\$(\d+)", r"\\\1", rule.replacement), k)] = v
    return {k: v for k, v in labels.items() if v != ""}


def test_relabel_random(spark):
    rng = random.Random(5)
    names = ["a", "b", "meta_x", "meta_y"]
    vals = ["", "1", "2", "x:1", "y"]
    rows = []
    for i in range(300):
        lab = {n: rng.choice(vals) for n in names if rng.random() < 0.7}
        rows.append((i, {k: v for k, v in lab.items() if v != ""}))
    rules = [
        Rule(source_labels=("a", "b"), separator=";", regex="(\\d*);(.*)", replacement="$1-$2", target_label="c"),
        Rule(source_labels=("meta_x",), regex="(\\w+):(\\d+)", replacement="$2", target_label="port"),
        Rule(action="drop", source_labels=("b",), regex="y"),
        Rule(action="labelmap", regex="meta_(.+)", replacement="m_$1"),
        Rule(source_labels=("c",), regex="-", replacement="", target_label="a"),
        Rule(action="keep", source_labels=("a", "c"), regex=".*1.*|;.*|.*;"),
    ]
    df = spark.createDataFrame(rows, "seq long, labels map<string,string>")
    got = {r["seq"]: dict(r["labels"]) for r in relabel(df, rules).collect()}
    for i, lab in rows:
        exp = py_relabel(lab, rules)
        if exp is None:
            assert i not in got, (lab, got.get(i))
        else:
            assert got.get(i) == exp, (lab, got.get(i), exp)


def test_latest_cells_random(spark):
    from celltide.operators.cells import latest_cells
    rng = random.Random(21)
    rows = []
    for seq in range(2000):
        rows.append((f"r{rng.randint(0, 30)}", "cf1", rng.choice(["a", "b", "c"]),
                     rng.choice([None, "1", "2", "x"]), rng.randint(0, 20), seq))
    df = spark.createDataFrame(rows, "row_key string, family string, qualifier string, value string, "
                                     "t int, seq long").withColumn("cell_ts", F.timestamp_seconds("t"))
    got = {(r["row_key"], r["qualifier"]): r["value"] for r in latest_cells(df).collect()}
    best = {}
    for rk, _, q, v, t, seq in rows:
        if (rk, q) not in best or (t, seq) > best[(rk, q)][0]:
            best[(rk, q)] = ((t, seq), v)
    assert got == {k: v for k, (_, v) in best.items()}
