"""Input frames derived from the driver's ``events`` table.

Each function turns ``events(event_id, ts, user_id, event_type, value, props)``
into one of the shapes the telemetry platform handles: device messages,
broker envelopes, bridge log lines, pod metadata and delivery measures.  The
injection rules (bad messages, sparse fields, late rows, ...) are fixed by
FIXTURES.md so that a DuckDB query can rebuild the expected result.

All frames are narrow projections of ``events``: no shuffle, and the work
grows linearly with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.functions.text import ISO_MICROS

# Fixed values of the fixtures (FIXTURES.md part B).
MQTT_TOPIC_ROOT = "telemetry"
BAD_MODULUS = 97
NONCONFORM_MODULUS = 89
POD_PHASES = ["Running", "Running", "Pending", "Succeeded", "Failed"]


_EVENTS: dict[tuple[str, str], DataFrame] = {}


def load_events(spark: SparkSession, sf_dir: str, refresh: bool = False) -> DataFrame:
    """``events`` with ``ts`` as a UTC ``timestamp`` (watermarks need it).

    The DataFrame definition (file listing, footer schema, split count) is
    kept per session and path and reused by every query; no rows are cached.
    ``refresh`` lists the files again.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if refresh or key not in _EVENTS:
        _EVENTS[key] = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return _EVENTS[key]


def _q(text: Column) -> Column:
    """JSON string literal of a column holding plain text (no escapes needed)."""
    return F.concat(F.lit('"'), text, F.lit('"'))


def _field(name: str, json_value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), json_value)


def _obj(*fields: Column) -> Column:
    """JSON object text; NULL fields are omitted (``concat_ws`` skips them)."""
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def device_id() -> Column:
    """Row key of an event's device: ``event_type-user_id``."""
    return F.concat_ws("-", F.col("event_type"), F.col("user_id").cast("string"))


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def payload_fields() -> dict[str, Column]:
    """JSON text of each field of the standard message, in payload order."""
    return {
        "id": _field("id", _q(device_id())),
        "timestamp": _field("timestamp", _q(F.date_format("ts", ISO_MICROS))),
        "value": _field("value", F.col("value").cast("string")),
        "k": _field("k", _k().cast("string")),
        "relation": _field("relation", _q(F.col("event_type"))),
    }


def payload_text() -> Column:
    """``{"id":…,"timestamp":…,"value":…,"k":…,"relation":…}`` for one event."""
    return _obj(*payload_fields().values())


def _message_columns(payload: Column, relation_attr: Column | None = None) -> list[Column]:
    attr = relation_attr if relation_attr is not None else F.col("event_type")
    return [
        F.col("event_id").alias("seq"),
        F.col("event_id").cast("string").alias("message_id"),
        F.concat_ws("/", F.lit(MQTT_TOPIC_ROOT), F.col("event_type"),
                    F.col("user_id").cast("string")).alias("topic"),
        payload.alias("payload"),
        F.col("ts").alias("publish_time"),
        F.create_map(F.lit("relation"), attr).alias("attributes"),
    ]


def messages(events: DataFrame) -> DataFrame:
    """One well-formed device message per event (binary payload, attributes)."""
    return events.select(*_message_columns(F.encode(payload_text(), "UTF-8")))


def sparse_messages(events: DataFrame) -> DataFrame:
    """Messages with omitted and present-null fields.

    ``k`` is omitted when ``event_id % 3 = 0``, ``value`` when ``% 5 = 0``;
    ``"k":null`` is written when ``% 7 = 0`` (wins over the omission).
    """
    f = payload_fields()
    eid = F.col("event_id")
    k = (F.when(eid % 7 == 0, F.lit('"k":null'))
         .when(eid % 3 == 0, F.lit(None).cast("string"))
         .otherwise(f["k"]))
    value = F.when(eid % 5 == 0, F.lit(None).cast("string")).otherwise(f["value"])
    text = _obj(f["id"], f["timestamp"], value, k, f["relation"])
    return events.select(*_message_columns(F.encode(text, "UTF-8")))


def bad_messages(events: DataFrame) -> DataFrame:
    """Messages where ``event_id % 97`` in 0..6 selects one kind of defect.

    0 not JSON, 1 JSON array, 2 no ``id``, 3 numeric ``id``, 4 no ``relation``,
    5 unknown relation, 6 invalid UTF-8 byte; every other row is good.
    """
    f = payload_fields()
    good = payload_text()
    r = F.col("event_id") % BAD_MODULUS
    text = (F.when(r == 0, F.concat(F.lit('{"id":"'), device_id(), F.lit('", broken')))
            .when(r == 1, F.concat(F.lit("["), good, F.lit("]")))
            .when(r == 2, _obj(f["timestamp"], f["value"], f["k"], f["relation"]))
            .when(r == 3, _obj(_field("id", F.col("user_id").cast("string")), f["timestamp"],
                               f["value"], f["k"], f["relation"]))
            .when(r == 4, _obj(f["id"], f["timestamp"], f["value"], f["k"]))
            .when(r == 5, _obj(f["id"], f["timestamp"], f["value"], f["k"],
                               _field("relation", _q(F.concat(F.lit("unknown_"), F.col("event_type"))))))
            .otherwise(good))
    payload = F.when(
        r == 6,
        # an 0xFF byte inside the id text: not valid UTF-8
        F.concat(F.encode(F.lit('{"id":"'), "UTF-8"), F.unhex(F.lit("FF")),
                 F.encode(F.concat(device_id(), F.lit('",'), F.concat_ws(",", f["timestamp"], f["value"],
                                                                    f["k"], f["relation"]), F.lit("}")), "UTF-8")),
    ).otherwise(F.encode(text, "UTF-8"))
    return events.select(*_message_columns(payload))


def nonconforming_messages(events: DataFrame) -> DataFrame:
    """Messages that break the catalog by ``event_id % 89``.

    0 ``value`` as the text ``"n/a"``, 1 an extra key ``x``, 2 ``k`` missing.
    """
    f = payload_fields()
    r = F.col("event_id") % NONCONFORM_MODULUS
    value = F.when(r == 0, _field("value", F.lit('"n/a"'))).otherwise(f["value"])
    k = F.when(r == 2, F.lit(None).cast("string")).otherwise(f["k"])
    extra = F.when(r == 1, _field("x", F.col("user_id").cast("string")))
    text = _obj(f["id"], f["timestamp"], value, k, f["relation"], extra)
    return events.select(*_message_columns(F.encode(text, "UTF-8")))


def duplicated_messages(events: DataFrame) -> DataFrame:
    """Each message once, and those with ``event_id % 10 = 0`` a second time."""
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (events.withColumn("copy", F.explode(copies))
            .select(*_message_columns(F.encode(payload_text(), "UTF-8")), "copy"))


def arrival_order(id_col: str = "event_id") -> Column:
    """Arrival position: ``event_id`` order, but ``event_id % 50 = 0`` 20 places later.

    ``2*event_id`` leaves odd slots free; a delayed row takes the slot right
    after the row ``event_id + 20``.
    """
    eid = F.col(id_col)
    return F.when(eid % 50 == 0, eid * 2 + 41).otherwise(eid * 2)


def envelopes(events: DataFrame, batch_size: int = 10) -> DataFrame:
    """REST publish envelopes ``{"messages":[{"data":…,"attributes":{…}}]}``.

    Events are packed ``batch_size`` per envelope by ``event_id`` range, so
    an envelope never holds more than ``batch_size`` messages.
    """
    msg = F.struct(
        F.base64(F.encode(payload_text(), "UTF-8")).alias("data"),
        F.create_map(F.lit("relation"), F.col("event_type"),
                     F.lit("message_id"), F.col("event_id").cast("string")).alias("attributes"),
    )
    return (events
            .groupBy(F.floor(F.col("event_id") / batch_size).alias("envelope_id"))
            .agg(F.to_json(F.struct(F.collect_list(msg).alias("messages"))).alias("body")))


# ---------------------------------------------------------------- logs

def log_level() -> Column:
    return (F.when(F.col("event_type") == "error", "error")
            .when(F.col("event_type") == "signup", "debug")
            .otherwise("info"))


def log_message() -> Column:
    base = F.concat(F.lit("user "), F.col("user_id").cast("string"),
                    F.lit(" value "), F.col("value").cast("string"))
    return F.when(F.col("event_id") % 41 == 0,
                  F.concat(base, F.lit(' saw "level=error"'))).otherwise(base)


def _go_quote(text: Column) -> Column:
    """Go ``%q`` for the texts used here: escape backslash and double quote."""
    return F.concat(F.lit('"'),
                    F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), '"', '\\\\"'),
                    F.lit('"'))


def log_lines(events: DataFrame) -> DataFrame:
    """Bridge log lines ``level=… ts=… caller=… msg="…"`` with pod labels."""
    uid = F.col("user_id")
    line = F.concat(
        F.lit("level="), log_level(),
        F.lit(" ts="), F.date_format("ts", ISO_MICROS),
        F.lit(" caller=main.go:"), (F.col("event_id") % 90 + 100).cast("string"),
        F.lit(" msg="), _go_quote(log_message()),
    )
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts").alias("arrival_ts"),
        line.alias("line"),
        F.when(uid % 3 < 2, "verne").otherwise("observe").alias("namespace"),
        F.when(uid % 2 == 0, "listener").otherwise("vernemq").alias("container"),
    )


def pod_metadata(events: DataFrame) -> DataFrame:
    """Discovery labels (before relabelling) of the pod that sent each event."""
    uid = F.col("user_id").cast("string")
    container = F.when(F.col("user_id") % 2 == 0, "listener").otherwise("vernemq")
    container_id = F.when(F.col("user_id") % 11 == 0, uid).otherwise(F.concat(F.lit("containerd://"), uid))
    phase = F.element_at(F.array(*[F.lit(p) for p in POD_PHASES]), (F.col("user_id") % 5 + 1).cast("int"))
    tier = F.when(F.col("user_id") % 4 == 0, "backend").when(F.col("user_id") % 4 == 1, "edge")
    address = F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string"), F.lit(":8080"))
    port = F.when(F.col("user_id") % 4 == 0, F.lit("9100"))
    labels = F.map_filter(F.create_map(
        F.lit("__address__"), address,
        F.lit("__meta_kubernetes_service_annotation_prometheus_io_port"), port,
        F.lit("__meta_kubernetes_namespace"), F.when(F.col("user_id") % 3 < 2, "verne").otherwise("observe"),
        F.lit("__meta_kubernetes_pod_name"), F.concat_ws("-", container, uid),
        F.lit("__meta_kubernetes_pod_container_name"), container,
        F.lit("__meta_kubernetes_pod_uid"), F.concat(F.lit("uid-"), uid),
        F.lit("__meta_kubernetes_pod_container_id"), container_id,
        F.lit("__meta_kubernetes_pod_phase"), phase,
        F.lit("__meta_kubernetes_pod_label_app_kubernetes_io_name"), container,
        F.lit("__meta_kubernetes_pod_label_tier"), tier,
    ), lambda k, v: v.isNotNull())
    return events.select(F.col("event_id").alias("seq"), labels.alias("labels"))


# ------------------------------------------------------------ delivery

def delivery_measures(events: DataFrame) -> DataFrame:
    """Load-test samples: one publish per event by virtual user ``user_id``.

    ``duration_ms = value``; ``bytes = length(props) * 2``; a publish of an
    ``error`` event failed, every other one was sent.
    """
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts"),
        F.col("user_id").alias("vu"),
        F.col("value").alias("duration_ms"),
        (F.length("props") * 2).alias("bytes"),
        F.when(failed, 0).otherwise(1).alias("sent"),
        F.when(failed, 1).otherwise(0).alias("failed"),
    )


def delivery_steps(events: DataFrame) -> DataFrame:
    """Bridge log steps per message, keyed by a hash of the payload.

    received always; queued unless ``event_id % 101 = 0``; once queued,
    published unless ``event_id % 53 = 0``, then failed.
    """
    eid = F.col("event_id")
    queued = eid % 101 != 0
    steps = F.array_compact(F.array(
        F.lit("received"),
        F.when(queued, F.lit("queued")),
        F.when(queued & (eid % 53 != 0), F.lit("published")),
        F.when(queued & (eid % 53 == 0), F.lit("failed")),
    ))
    return events.select(F.md5(payload_text()).alias("msg_hash"), F.col("ts"),
                         F.explode(steps).alias("step"))


def sent_received(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Round-trip sets: everything sent; received misses ``% 61 = 0``, repeats ``% 67 = 0``."""
    eid = F.col("event_id")
    sent = events.select(F.md5(payload_text()).alias("msg_hash"))
    times = F.when(eid % 61 == 0, F.array()).when(eid % 67 == 0, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0)))
    received = events.select(F.md5(payload_text()).alias("msg_hash"), F.explode(times).alias("copy")) \
        .select("msg_hash")
    return sent, received


def worded_lines(ev: DataFrame) -> DataFrame:
    """``seq, namespace, msg``: log messages whose variable parts are words and paths (numbers spelled in letters)."""
    word = lambda c: F.translate(c.cast("string"), "0123456789", "qwertyuiop")
    user, event = word(F.col("user_id")), word(F.col("event_id"))
    msg = (F.when(F.col("event_type") == "signup", F.concat(F.lit("new user "), user, F.lit(" signed up")))
           .when(F.col("event_type") == "purchase", F.concat(F.lit("order "), event, F.lit(" paid by "), user))
           .when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0), F.concat(F.lit("cannot open /var/"), event, F.lit(": permission denied")))
           .when(F.col("event_type") == "error", F.concat(F.lit("cannot open /var/"), event, F.lit(": not found")))
           .when(F.col("event_type") == "view", F.concat(F.lit("page /"), event, F.lit("/"), user, F.lit(" viewed")))
           .otherwise(F.concat(F.lit("link "), F.element_at(F.array(F.lit("top"), F.lit("left"), F.lit("right")), (F.col("event_id") % 3 + 1).cast("int")), F.lit(" was clicked"))))
    namespace = F.when(F.col("user_id") % 3 < 2, "verne").otherwise("observe")
    return ev.select(F.col("event_id").alias("seq"), namespace.alias("namespace"), msg.alias("msg"))
