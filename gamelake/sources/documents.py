"""Nested documents: API result sets, flattening, validation, event and order documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SET = "resource string, parameters map<string,string>, resultSets array<struct<name:string, headers:array<string>, rowSet:array<array<string>>>>"
CLICK_EVENT = (
    "event_id string, event_type string, user_id string, session_id string, ts timestamp, page string, product_id string, "
    "filters_applied array<string>, metadata struct<device:string, browser:string, referrer:string, k:int>"
)
ADDRESS = "struct<name:string, street:string, city:string, state:string, zip:string, country:string>"
ORDER = (
    "order_id string, customer_id string, status string, created_at timestamp, currency string, total double, "
    f"shipping_address {ADDRESS}, billing_address {ADDRESS}, "
    "line_items array<struct<line_id:int, product_id:string, quantity:int, unit_price:double>>, "
    "shipments array<struct<shipment_id:string, carrier:string, items:array<struct<line_id:int, quantity:int>>>>, "
    "status_history array<struct<status:string, at:timestamp>>"
)


def to_json_documents(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Each row as a JSON document, with the time of ingest."""
    return df.select(F.to_json(F.struct("*")).alias("document"), (F.current_timestamp() if at is None else at).alias("ingested_at"))


def decode_result_set(df: DataFrame, name: str, fields: Mapping[str, str], parameters: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Rows of the named result set (headers and arrays of values), typed, with request parameters as columns."""
    doc = df.select(F.from_json(value, RESULT_SET).alias("d"))
    sets = doc.select("d.parameters", F.explode("d.resultSets").alias("s")).filter(F.col("s.name") == name)
    rows = sets.select("parameters", "s.headers", F.explode("s.rowSet").alias("row"))
    m = rows.select("parameters", F.map_from_arrays("headers", "row").alias("m"))
    return m.select(*(F.col("m")[k].cast(t).alias(k.lower()) for k, t in fields.items()), *(F.col("parameters")[p].alias(p.lower()) for p in parameters))


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested struct fields as top-level columns, to any depth."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        return [leaf for f in schema for leaf in (leaves(f.dataType, (*path, f.name)) if isinstance(f.dataType, T.StructType) else [(*path, f.name)])]

    return df.select(*(F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in leaves(df.schema, ())))


def explode_path(df: DataFrame, path: str, meta: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """One row per element of an array of structs at the path, with columns of the parent."""
    names = [c.replace(".", sep) for c in meta]
    out = df.select(*(F.col(c).alias(n) for c, n in zip(meta, names, strict=True)), F.explode(path).alias("_e"))
    return flatten_struct(out.select(*names, "_e.*"), sep)


def validate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the others with the names of those they break. A rule that gives null is broken."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())), lambda x: x.isNotNull())
    checked = df.withColumn("errors", broken)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def result_set_rules(doc: str = "d") -> dict[str, Column]:
    """A document needs a resource, result sets, and rows in each of them."""
    c = lambda x: F.col(f"{doc}.{x}")
    return {"resource": F.length(c("resource")) > 0, "result_sets": F.size(c("resultSets")) > 0, "rows": F.forall(c("resultSets"), lambda s: F.size(s["rowSet"]) > 0)}


def drop_all_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("all", subset=list(cols) if cols else None)


def parse_events(df: DataFrame, value: str = "value", schema: str = CLICK_EVENT) -> DataFrame:
    """Click-stream events with metadata as columns; text that is no JSON gives nulls."""
    return flatten_struct(df.select(F.from_json(value, schema).alias("e")).select("e.*"))


def parse_orders(df: DataFrame, value: str = "value") -> DataFrame:
    return df.select(F.from_json(value, ORDER).alias("o")).select("o.*")


def order_lines(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", F.explode_outer("line_items").alias("l")).select("order_id", "l.*")


def order_shipments(orders: DataFrame) -> DataFrame:
    s = orders.select("order_id", F.explode_outer("shipments").alias("s")).select("order_id", "s.shipment_id", "s.carrier", F.explode_outer("s.items").alias("i"))
    return s.select("order_id", "shipment_id", "carrier", "i.*")


def order_history(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", F.posexplode_outer("status_history").alias("step", "h")).select("order_id", "step", "h.*")
