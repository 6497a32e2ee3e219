"""Decoding, quarantine reasons and the canonical text of values."""

from pyspark.sql import functions as F

from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.sources.catalog import Catalog

CAT = Catalog({"dev": [("id", "STRING"), ("t", "FLOAT")]})


def _msgs(spark, payloads):
    rows = [(i, str(i), p) for i, p in enumerate(payloads)]
    return (spark.createDataFrame(rows, "seq long, message_id string, payload binary")
            .withColumn("publish_time", F.lit("2024-01-01 00:00:00").cast("timestamp")))


def test_every_reason(spark):
    payloads = [b"nope", b"[1,2]", b'{"relation":"dev"}', b'{"id":5,"relation":"dev"}',
                b'{"id":"a"}', b'{"id":"a","relation":"zzz"}', b'{"id":"\xff","relation":"dev"}',
                b'{"id":"a","relation":"dev"}', b'NaN', b'{"id":null,"relation":"dev"}']
    got = dict(D.decode(_msgs(spark, payloads), CAT).select("seq", "reason").collect())
    assert got == {0: "BAD_JSON", 1: "NOT_OBJECT", 2: "NO_ID", 3: "ID_NOT_STRING", 4: "NO_RELATION",
                   5: "UNKNOWN_RELATION", 6: "BAD_UTF8", 7: None, 8: "BAD_JSON", 9: "ID_NOT_STRING"}


def test_quarantine_keeps_payload(spark):
    d = D.decode(_msgs(spark, [b"nope", b'{"id":"a","relation":"dev"}']), CAT)
    bad = D.quarantined(d).collect()
    assert len(bad) == 1 and bytes(bad[0]["payload"]) == b"nope" and bad[0]["reason"] == "BAD_JSON"
    assert D.good(d).count() == 1


def test_canonical_text_and_present_null(spark):
    p = b'{"id":"a","relation":"dev","i":50,"f":1.10,"e":1e16,"z":50.0,"b":true,"n":null,"o":{"a":1},"l":[1,"q"]}'
    cells = C.to_cells(D.good(D.decode(_msgs(spark, [p]), CAT)))
    got = {(r["family"], r["qualifier"]): r["value"] for r in cells.collect()}
    assert got[("cf1", "i")] == "50"
    assert got[("cf1", "f")] == "1.1"
    assert got[("cf1", "e")] == "1.0E16"
    assert got[("cf1", "z")] == "50"
    assert got[("cf1", "b")] == "true"
    assert ("cf1", "n") in got and got[("cf1", "n")] is None  # present-null is a cell
    assert got[("cf1", "o")] == '{"a":1}'
    assert got[("cf1", "l")] == '[1,"q"]'
    assert got[("cf2", "relation")] == "dev" and got[("cf1", "relation")] == "dev"
    assert got[("cf1", "id")] == "a"


def test_duplicate_key_last_wins(spark):
    p = b'{"id":"a","relation":"dev","x":50,"x":51}'
    cells = C.to_cells(D.good(D.decode(_msgs(spark, [p]), CAT)))
    assert cells.where("qualifier = 'x'").first()["value"] == "51"


def test_known_and_unknown_relation(spark):
    df = spark.createDataFrame([("dev",), ("zzz",)], "relation string")
    assert [r[0] for r in D.known_relation(df, CAT).collect()] == ["dev"]
    assert [r[0] for r in D.unknown_relation(df, CAT).collect()] == ["zzz"]


def test_envelope_round_trip(spark):
    msgs = _msgs(spark, [b'{"id":"a"}', b"\x00\x01"]).withColumn(
        "attributes", F.create_map(F.lit("relation"), F.lit("dev")))
    back = D.decode_envelopes(D.encode_envelope(msgs)).collect()
    assert sorted(bytes(r["payload"]) for r in back) == sorted([b'{"id":"a"}', b"\x00\x01"])
    assert all(r["attributes"] == {"relation": "dev"} for r in back)


def test_relation_must_be_text(spark):
    bad = [b'{"id":"a","relation":null}', b'{"id":"a","relation":7}', b'{"id":"a","relation":"zz"}', b'{"id":"a","relation":"dev"}']
    want = {0: "RELATION_NOT_STRING", 1: "RELATION_NOT_STRING", 2: "UNKNOWN_RELATION", 3: None}
    assert dict(D.decode(_msgs(spark, bad), CAT).select("seq", "reason").collect()) == want
    assert dict(D.decode(_msgs(spark, bad)).select("seq", "reason").collect()) == want | {2: None}


def test_typed_reads_are_strict(spark):
    from celltide.operators import cells as C
    from celltide.operators import schema as S
    fields = [("id", "STRING"), ("n", "INTEGER"), ("x", "FLOAT"), ("t", "TIMESTAMP"), ("o", "POINT")]
    cat = Catalog({"dev": [*fields, ("relation", "STRING")]})
    texts = ['"n":1.9,"x":"12","t":5,"o":{"a":1}', '"n":7,"x":2,"t":"2024-01-01T00:00:00Z","o":"p"', '"n":50.0,"x":1e3,"t":"no"', '"n":null,"x":null,"t":null', '"n":99999999999,"x":true']
    msgs = D.good(D.decode(_msgs(spark, [f'{{"id":"k{i}","relation":"dev",{t}}}'.encode() for i, t in enumerate(texts)]), cat))
    got = {r["id"]: (r["n"], r["x"], r["t"] is not None, r["o"]) for r in S.typed_view(msgs, fields).collect()}
    assert got == {"k0": (None, None, False, '{"a":1}'), "k1": (7, 2.0, True, "p"), "k2": (50, 1000.0, False, None),
                   "k3": (None, None, False, None), "k4": (None, None, False, None)}
    stored = S.typed_latest(C.latest_cells(C.to_cells(msgs)), fields)
    kept = {r["id"]: (r["n"], r["x"], r["t"] is not None, r["o"]) for r in stored.collect()}
    # a stored cell no longer tells the text "12" from the number
    assert kept == got | {"k0": (None, 12.0, False, '{"a":1}')}
    report = {r["field"]: (r["missing"], r["extra"], r["badly_typed"]) for r in S.conformance(msgs, cat).collect()}
    assert report == {"id": (0, 0, 0), "n": (0, 0, 2), "x": (0, 0, 2), "t": (1, 0, 2), "o": (3, 0, 0), "relation": (0, 0, 0)}


def large_catalog():
    """A catalog beyond the bound of literals."""
    return Catalog({"dev": [("id", "STRING"), ("t", "FLOAT")]} | {f"r{i}": [(f"f{j}", "FLOAT") for j in range(4)] for i in range(2_000)})


def test_large_catalog_is_joined_with_hot_and_null_relations_split(spark):
    assert CAT.fits_in_plan() and not large_catalog().fits_in_plan()
    payloads = [b'{"id":"a","relation":"dev"}'] * 300 + [b"nope"] * 200 + [b'{"id":"a","relation":"r7"}', b'{"id":"a","relation":"zzz"}', b'{"id":"a"}']
    msgs = _msgs(spark, payloads)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):  # as the planner chooses, and by the salted key
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            one, other = (sorted(D.decode(msgs, c).select("seq", "reason").collect()) for c in (Catalog({**CAT.relations, "r7": []}), large_catalog()))
            assert one == other and len(one) == len(payloads)
        plan = D.decode(msgs, large_catalog())._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
        assert exchanges and all("_salt" in line for line in exchanges)
        parts = D.decode(msgs, large_catalog()).groupBy(F.spark_partition_id().alias("p"), "relation").count()
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = [r["count"] for r in parts.collect() if r["relation"] == "dev"]
        assert sum(sizes) == 300 and len(sizes) > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unknown_relation_keeps_rows_without_one(spark):
    df = spark.createDataFrame([("dev",), ("zzz",), (None,)], "relation string")
    for cat in (CAT, large_catalog()):
        assert [r[0] for r in D.known_relation(df, cat).collect()] == ["dev"]
        assert sorted(D.unknown_relation(df, cat).collect(), key=str) == sorted([("zzz",), (None,)], key=str)


def test_columns_of_the_source_do_not_clash(spark):
    msgs = _msgs(spark, [b'{"id":"a","relation":"dev"}']).withColumn("relation", F.lit("x")).withColumn("reason", F.lit("y"))
    row = D.decode(msgs, CAT).first()
    assert (row["relation"], row["reason"], row["row_key"]) == ("dev", None, "a")


def test_empty_catalog_knows_no_relation(spark):
    assert D.decode(_msgs(spark, [b'{"id":"a","relation":"dev"}']), Catalog({})).first()["reason"] == "UNKNOWN_RELATION"
