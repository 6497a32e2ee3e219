"""Schema catalog: relation -> ordered list of (name, declared type).

The catalog is configuration (one JSON object, as a producer's schema file),
small in practice.  It is parsed once on the driver.  As a DataFrame it is a
local relation, whose size the planner knows; up to ``PLAN_FIELDS`` and
``PLAN_CHARS`` it is written into plans as literals, and no join is needed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Declared type names and their Spark types (anything else -> NULL).
DECLARED_TYPES = {
    "STRING": "string",
    "TIMESTAMP": "timestamp",
    "FLOAT": "double",
    "INTEGER": "int",
}

# The two device relations of the reference's schema file.
REFERENCE_SCHEMAS_JSON = """{
  "weather_sensor": [
    {"name": "id", "type": "STRING"},
    {"name": "timestamp", "type": "TIMESTAMP"},
    {"name": "temperature_c", "type": "FLOAT"},
    {"name": "humidity_percent", "type": "FLOAT"},
    {"name": "pressure_hpa", "type": "FLOAT"},
    {"name": "wind_speed_mps", "type": "FLOAT"},
    {"name": "rainfall_mm", "type": "FLOAT"}
  ],
  "machine_metrics": [
    {"name": "id", "type": "STRING"},
    {"name": "timestamp", "type": "TIMESTAMP"},
    {"name": "vibration_mms", "type": "FLOAT"},
    {"name": "motor_rpm", "type": "INTEGER"},
    {"name": "power_kw", "type": "FLOAT"},
    {"name": "oil_temp_c", "type": "FLOAT"},
    {"name": "status_code", "type": "INTEGER"}
  ]
}"""

# The relations of the driver's events table and their fields.
EVENT_RELATIONS = ["signup", "purchase", "error", "view", "click"]
EVENT_FIELDS = [("id", "STRING"), ("timestamp", "TIMESTAMP"), ("value", "FLOAT"),
                ("k", "INTEGER"), ("relation", "STRING")]


#: Most fields, and characters of names, of a catalog that is written into a plan.
PLAN_FIELDS, PLAN_CHARS = 5_000, 200_000


class Catalog:
    """Relation -> [(field, declared type)], insertion-ordered."""

    def __init__(self, relations: Mapping[str, Sequence[tuple[str, str]]]):
        self.relations = {r: [(n, t.upper()) for n, t in fields] for r, fields in relations.items()}

    @classmethod
    def from_json(cls, text: str) -> "Catalog":
        obj = json.loads(text)
        return cls({r: [(f["name"], f["type"]) for f in fields] for r, fields in obj.items()})

    @classmethod
    def from_file(cls, spark: SparkSession, path: str) -> "Catalog":
        """Read a schema file from any Hadoop path (``wholetext``: one small file)."""
        text = spark.read.text(path, wholetext=True).first()[0]
        return cls.from_json(text)

    def merged(self, other: "Catalog") -> "Catalog":
        return Catalog({**self.relations, **other.relations})

    def fits_in_plan(self) -> bool:
        """Whether names and fields are few and short enough to be literals of a plan."""
        fields = [n for fs in self.relations.values() for n, _ in fs]
        return len(fields) + len(self.relations) <= PLAN_FIELDS and sum(map(len, fields)) + sum(map(len, self.relations)) <= PLAN_CHARS

    def names(self) -> list[str]:
        return list(self.relations)

    def fields(self, relation: str) -> list[tuple[str, str]]:
        return self.relations[relation]

    def struct_type(self, relation: str) -> T.StructType:
        """Spark schema of a relation; unknown declared types become ``string``."""
        return T.StructType([
            T.StructField(n, T._parse_datatype_string(DECLARED_TYPES.get(t, "string")), True)
            for n, t in self.fields(relation)])

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One row per field: ``relation, pos, name, type`` (pos from 1)."""
        rows = [(r, i + 1, n, t) for r, fields in self.relations.items() for i, (n, t) in enumerate(fields)]
        return _local(spark, rows, "relation string, pos int, name string, type string")

    def relations_df(self, spark: SparkSession) -> DataFrame:
        return _local(spark, [(r,) for r in self.relations], "relation string")


def _local(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows of the driver as a local relation (through Arrow; a list would become an RDD of unknown size)."""
    schema = T.StructType.fromDDL(ddl)
    columns = zip(*rows) if rows else [()] * len(schema)
    kinds = {"string": pa.string(), "int": pa.int32()}
    table = pa.table({f.name: pa.array(c, kinds[f.dataType.simpleString()]) for f, c in zip(schema, columns)})
    return spark.createDataFrame(table, schema)


def reference_catalog() -> Catalog:
    return Catalog.from_json(REFERENCE_SCHEMAS_JSON)


def events_catalog() -> Catalog:
    return Catalog({r: EVENT_FIELDS for r in EVENT_RELATIONS})


def default_catalog() -> Catalog:
    return reference_catalog().merged(events_catalog())


def catalog_in_use(catalog: Catalog, relations_seen: DataFrame) -> DataFrame:
    """Catalog rows of the relations that occur in ``relations_seen(relation)`` (S14 + J1)."""
    spark = relations_seen.sparkSession
    # distinct relations: partial aggregation keeps the shuffle to a few rows
    seen = relations_seen.select("relation").distinct()
    return catalog.to_df(spark).join(seen, "relation", "left_semi")
