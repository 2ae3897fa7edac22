"""What messages really hold, against what their feed promises.

Parsing with a fixed schema gives NULL for a field that is missing, that has
another type, or that nobody knows of; a producer's change is not seen until a
table is empty. Here each message is read as a VARIANT, whatever it holds, and
its fields are counted by day, name and kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.schemas import Feed

# The type that a VARIANT reports, without its parameters, and the kind it is of.
_KINDS = {
    "BIGINT": "integer",
    "DECIMAL": "number",
    "DOUBLE": "number",
    "FLOAT": "number",
    "STRING": "string",
    "BOOLEAN": "boolean",
    "VOID": "null",
    "OBJECT": "object",
    "ARRAY": "array",
}
# Kinds that a field of a type may be of.
_ALLOWED = {
    T.StringType(): ("string",),
    T.IntegerType(): ("integer",),
    T.DoubleType(): ("integer", "number"),
}


def kind_of(value: Column) -> Column:
    """integer, number, string, boolean, null, object or array."""
    # Looked up, so that the type of a value is found once and not for each kind.
    name = F.substring_index(F.substring_index(F.schema_of_variant(value), "(", 1), "<", 1)
    kinds = F.create_map(*[F.lit(part) for pair in _KINDS.items() for part in pair])
    return F.coalesce(F.try_element_at(kinds, name), F.lit("other"))


def message_fields(bronze: DataFrame) -> DataFrame:
    """``(ingestion_date, field, kind, messages)``: how many messages of a day hold such a field.

    Under no field every message counts once: as ``object``, as ``no object`` if it
    is other JSON, or as ``unreadable``. Fields of objects within objects are not
    looked into. A message is parsed once; counts merge map-side.
    """
    read = bronze.select("ingestion_date", F.try_parse_json("json_payload").alias("body"))
    # Only an object can be read as a map; its own type would list all its fields first.
    read = read.withColumn("fields", F.try_variant_get("body", "$", "map<string, variant>"))
    whole = (
        F.when(F.col("body").isNull(), "unreadable")
        .when(F.col("fields").isNotNull(), "object")
        .otherwise("no object")
    )
    entries = F.transform(
        F.map_entries("fields"), lambda e: F.struct(e["key"].alias("field"), kind_of(e["value"]).alias("kind"))
    )
    none = F.array(F.struct(F.lit(None).cast("string").alias("field"), whole.alias("kind")))
    listed = F.when(whole == "object", F.concat(none, entries)).otherwise(none)
    one = read.select("ingestion_date", F.explode(listed).alias("e"))
    return one.groupBy("ingestion_date", F.col("e.field").alias("field"), F.col("e.kind").alias("kind")).agg(
        F.count("*").alias("messages")
    )


def schema_drift(bronze: DataFrame, feed: Feed) -> DataFrame:
    """``message_fields`` with a verdict on each, and a row for what is missing.

    ``verdict`` is ``expected``, ``other kind`` (the typed column is NULL or read
    from another form), ``empty`` (a JSON null), ``unknown`` (no column has it),
    ``missing`` (promised, and not in so many objects of the day) or ``unreadable``
    (no field can be read).
    """
    found = message_fields(bronze)
    field, kind = F.col("field"), F.col("kind")
    expected = known = F.lit(False)
    for promised in feed.payload:
        mine = field == promised.name
        known = known | mine
        expected = expected | (mine & kind.isin(*_ALLOWED[promised.dataType]))
    verdict = (
        F.when(field.isNull(), "unreadable")
        .when(~known, "unknown")
        .when(expected, "expected")
        .when(kind == "null", "empty")
        .otherwise("other kind")
    )
    # What is missing: a day's objects, less those that have the field. Each count adds
    # its part of that to the report, so the messages are read in one branch only.
    lost = F.lit("missing")
    entry = lambda name, of, n, said: F.struct(
        name.alias("field"), of.alias("kind"), n.alias("messages"), said.alias("verdict")
    )
    n = F.col("messages")
    is_object = field.isNull() & (kind == "object")
    own = F.array(entry(field, kind, n, verdict))
    parts = (
        F.when(is_object, F.array(*[entry(F.lit(p), lost, n, lost) for p in feed.payload.names]))
        .when(known, F.concat(own, F.array(entry(field, lost, -n, lost))))
        .otherwise(own)
    )
    report = found.select("ingestion_date", F.explode(parts).alias("e")).select("ingestion_date", "e.*")
    return (
        report.groupBy("ingestion_date", "field", "kind", "verdict")
        .agg(F.sum("messages").alias("messages"))
        .filter("messages > 0")
        .select(F.lit(feed.name).alias("feed"), "ingestion_date", "field", "kind", "messages", "verdict")
    )
