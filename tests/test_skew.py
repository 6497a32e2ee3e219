"""One key holding a third of all rows: results stay whole and exact, and the
plans combine map-side before the shuffle."""

from pyspark.sql import functions as F

from celltide.operators import audit as A
from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.operators import logs as LG
from celltide.operators import schema as S
from celltide.operators import shadow as SH
from celltide.sources import catalog as K
from celltide.sources import fixtures as X

from locations import SF_SMALL


def _skewed_events(spark):
    ev = X.load_events(spark, SF_SMALL)
    # every third event belongs to one hot device (purchase-1)
    hot = F.col("event_id") % 3 == 0
    return (ev.withColumn("user_id", F.when(hot, F.lit(1)).otherwise(F.col("user_id")))
              .withColumn("event_type", F.when(hot, F.lit("purchase")).otherwise(F.col("event_type"))))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_device_latest_and_shadow(spark):
    ev = _skewed_events(spark)
    good = D.good(D.decode(X.sparse_messages(ev), K.default_catalog()))
    latest = C.latest_cells(C.to_cells(good))
    p = _plan(latest)
    assert "partial_max_by" in p  # combined before the exchange
    hot = {r["qualifier"]: r["value"] for r in latest.where("row_key = 'purchase-1' AND family = 'cf1'").collect()}
    rows = ev.where("user_id = 1 AND event_type = 'purchase'").orderBy(F.col("event_id").desc()).collect()
    newest = rows[0]
    assert hot["timestamp"] == newest["ts"].strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    with_value = [r for r in rows if r["event_id"] % 5 != 0][0]
    assert float(hot["value"]) == with_value["value"]
    shadow = SH.device_shadow(good, ["value"])
    assert "partial_max_by" in _plan(shadow)
    s = shadow.where("id = 'purchase-1'").first()
    assert s["n_messages"] == len(rows) and float(s["f_value"]) == with_value["value"]


def test_hot_message_in_multiset_and_audit(spark):
    ev = X.load_events(spark, SF_SMALL)
    sent = ev.select(F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(
        F.col("event_id").cast("string")).alias("msg_hash"))
    received = sent.where("msg_hash <> 'hot'").unionByName(sent.where("msg_hash = 'hot'").limit(5))
    d = A.multiset_diff(sent, received).collect()
    n_hot = sent.where("msg_hash = 'hot'").count()
    assert [(r["msg_hash"], r["sent"], r["received"]) for r in d] == [("hot", n_hot, 5)]
    assert "partial_sum" in _plan(A.multiset_diff(sent, received))
    steps = sent.select("msg_hash", F.explode(F.array(F.lit("received"), F.lit("queued"),
                                                      F.lit("published"))).alias("step"))
    out = {r["outcome"]: r["n"] for r in LG.delivery_audit(steps).collect()}
    assert out == {"published": ev.count() - n_hot + 1}


def test_conformance_of_one_relation(spark):
    ev = X.load_events(spark, SF_SMALL).withColumn("event_type", F.lit("view"))
    n = ev.count()
    odd = {k: ev.where(F.col("event_id") % 89 == k).count() for k in (0, 1, 2)}
    msgs = D.good(D.decode(X.nonconforming_messages(ev), K.default_catalog()))
    got = {r["field"]: (r["missing"], r["extra"], r["badly_typed"]) for r in S.conformance(msgs, K.default_catalog()).collect()}
    assert got == {"id": (0, 0, 0), "timestamp": (0, 0, 0), "value": (0, 0, odd[0]), "k": (odd[2], 0, 0), "relation": (0, 0, 0), "x": (0, odd[1], 0)}
    assert msgs.count() == n
