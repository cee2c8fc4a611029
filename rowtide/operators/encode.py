"""Tuples to JSON keys and values.

Relations are only known at run time. Where a log holds few distinct column
lists, each gets its own projection with names and types as constants, which
Spark compiles. Where it holds many, one expression walks the column list that
comes with the relation. Both give the same text and the same errors; the
tests compare them.

A key column that the new tuple leaves out comes from the old tuple. One that
neither sends, or that is binary or a float without a JSON form, makes the
message an error: its key would name the wrong row.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.functions.json_text import quote
from rowtide.functions.pgtypes import FLOAT_OIDS, is_unencodable, json_text
from rowtide.operators.relations import History
from rowtide.schemas import COLUMN, DELETE, UPDATE

# Column lists, and columns in them, that projections are written out for.
MAX_SHAPES = 48
MAX_COLUMNS = 400


def choose_encoder(history: History) -> ShapeEncoder | ListEncoder:
    """Encoder for the relation versions of a log."""
    texts = {row["shape"] for row in history.rows or ()}
    shapes = {text: json.loads(text) for text in sorted(texts)}
    columns = sum(len(s["columns"]) for s in shapes.values())
    if history.rows is not None and len(shapes) <= MAX_SHAPES and columns <= MAX_COLUMNS:
        return ShapeEncoder(shapes)
    return ListEncoder()


# States of a key column, from good to bad.
SENT, BAD_FLOAT, NOT_SENT, BINARY = "0", "1", "2", "3"


def field_state(field: Column, old: Column, oid: Column) -> Column:
    """State of a key column, which the old tuple may supply."""

    def one(f: Column) -> Column:
        odd = oid.isin(*FLOAT_OIDS) & is_unencodable(f["data"])
        return (
            F.when(f["status"] == "b", BINARY)
            .when((f["status"] == "t") & odd, BAD_FLOAT)
            .when(f["status"].isin("t", "n"), SENT)
        )

    return F.coalesce(one(field), one(old), F.lit(NOT_SENT))


def _key_places(shape: dict) -> list[tuple[str, int | None, int]]:
    """Key columns with their place in the tuple and their type."""
    place = {c["name"]: i for i, c in enumerate(shape["columns"])}
    oids = {c["name"]: c["type_oid"] for c in shape["columns"]}
    return [(name, place.get(name), oids.get(name, 0)) for name in shape["key_columns"]]


def has_binary(sent: str) -> Column:
    """Whether a tuple holds columns in binary form, which are not decoded."""
    return F.coalesce(F.exists(sent, lambda c: c["status"] == "b"), F.lit(False))


class ShapeEncoder:
    """One constant projection per distinct column list."""

    def __init__(self, shapes: dict[str, dict]):
        self.shapes = shapes

    def prepare(self, joined: DataFrame) -> DataFrame:
        return joined

    def encode(self, joined: DataFrame, old_keys: bool) -> DataFrame:
        sent, old = F.col("_sent"), F.col("old_tuple")
        value = self._pick(lambda s: self._value(s, sent), "string")
        return joined.select(
            "*",
            self._pick(lambda s: self._key(s, sent, old), "string").alias("key"),
            self._pick(lambda s: self._key_state(s, sent, old), "string").alias("_key_state"),
            # The test for binary columns also keeps Spark from fusing this wide
            # projection into one generated method too long to be compiled.
            F.when((F.col("op") != DELETE) & ~has_binary("_sent"), value).alias("value"),
            self._pick(lambda s: self._bad_float(s, sent), "boolean").alias("_bad_float"),
            *([self._old_key(old).alias("_old_key")] if old_keys else []),
        )

    def _old_key(self, old: Column) -> Column:
        """Key an update moved away from, where the old tuple holds all of it."""
        key = self._pick(lambda s: self._key(s, old, old), "string")
        whole = self._pick(lambda s: self._key_state(s, old, old), "string") == SENT
        return F.when((F.col("op") == UPDATE) & old.isNotNull() & whole, key)

    def _pick(self, expression: Callable[[dict], Column], dtype: str) -> Column:
        cases = F.when(F.lit(False), F.lit(None).cast(dtype))
        for text, shape in self.shapes.items():
            cases = cases.when(F.col("shape") == text, expression(shape))
        return cases

    @staticmethod
    def _json(sent: Column, place: int, oid: int) -> Column:
        """JSON of one column: NULL where it was not sent."""
        field = F.get(sent, F.lit(place))
        return F.when(field["status"] == "n", "null").when(
            field["status"] == "t", json_text(field["data"], oid)
        )

    def _value(self, shape: dict, sent: Column) -> Column:
        by_name = sorted(enumerate(shape["columns"]), key=lambda x: x[1]["name"].encode())
        members = [
            F.concat(
                F.lit(json.dumps(c["name"], ensure_ascii=False) + ":"),
                self._json(sent, i, c["type_oid"]),
            )
            for i, c in by_name
        ]
        # concat_ws leaves out the columns that were not sent.
        return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))

    def _key(self, shape: dict, sent: Column, old: Column) -> Column:
        parts: list[Column] = []
        for n, (name, place, oid) in enumerate(_key_places(shape)):
            label = ("," if n else "{") + json.dumps(name, ensure_ascii=False) + ":"
            parts.append(F.lit(label))
            if place is None:
                parts.append(F.lit("null"))
            else:
                found = [self._json(t, place, oid) for t in (sent, old)]
                parts.append(F.coalesce(*found, F.lit("null")))
        key = F.concat(*parts, F.lit("}")) if parts else F.lit("{}")
        return F.when(sent.isNotNull(), key)

    @staticmethod
    def _key_state(shape: dict, sent: Column, old: Column) -> Column:
        """Whether the key is there, and if not, why: the worst of its columns."""
        states = [F.lit(SENT)]
        for _, place, oid in _key_places(shape):
            if place is None:
                states.append(F.lit(NOT_SENT))
            else:
                fields = [F.get(t, F.lit(place)) for t in (sent, old)]
                states.append(field_state(*fields, F.lit(oid)))
        return F.array_max(F.array(*states))

    @staticmethod
    def _bad_float(shape: dict, sent: Column) -> Column:
        bad = F.lit(False)
        for i, c in enumerate(shape["columns"]):
            if c["type_oid"] in FLOAT_OIDS:
                bad = bad | F.coalesce(is_unencodable(F.get(sent, F.lit(i))["data"]), F.lit(False))
        return bad


class ListEncoder:
    """One expression over the column list joined to each change."""

    def prepare(self, joined: DataFrame) -> DataFrame:
        ddl = f"columns array<{COLUMN}>, key_columns array<string>"
        return joined.withColumn("_shape", F.from_json("shape", ddl)).select(
            "*",
            F.col("_shape.columns").alias("_columns"),
            F.col("_shape.key_columns").alias("key_columns"),
        )

    def encode(self, joined: DataFrame, old_keys: bool) -> DataFrame:
        fields = _sent_fields(F.col("_sent"), F.col("_columns"))
        members = joined.withColumn("_fields", fields).withColumn("_members", _members("_fields"))
        floats = F.exists(
            "_fields", lambda f: f["oid"].isin(*FLOAT_OIDS) & is_unencodable(f["data"])
        )
        sent, old = F.col("_sent"), F.col("old_tuple")
        encoded = members.select(
            "*",
            _list_key(sent, old).alias("key"),
            _list_key_state(sent, old).alias("_key_state"),
            F.when((F.col("op") != DELETE) & ~has_binary("_sent"), _object("_members")).alias("value"),
            F.coalesce(floats, F.lit(False)).alias("_bad_float"),
        )
        if old_keys:
            moved = (F.col("op") == UPDATE) & old.isNotNull() & (_list_key_state(old, old) == SENT)
            encoded = encoded.withColumn("_old_key", F.when(moved, _list_key(old, old)))
        return encoded


def _place(name: Column) -> Column:
    """Place of a named column in the tuple, from 1; 0 if it has none."""
    names = F.transform("_columns", lambda c: c["name"])
    return F.coalesce(F.array_position(names, name), F.lit(0)).cast("int")


def _list_key(sent: Column, old: Column) -> Column:
    """Key object over the joined column list; a column that was not sent is null."""

    def member(name: Column) -> Column:
        at = _place(name) - 1
        column = F.get("_columns", at)

        def json_of(f: Column) -> Column:
            return F.when(f["status"] == "n", "null").when(
                f["status"] == "t", json_text(f["data"], column["type_oid"])
            )

        found = F.coalesce(json_of(F.get(sent, at)), json_of(F.get(old, at)), F.lit("null"))
        return F.concat(quote(name), F.lit(":"), found)

    text = F.array_join(F.transform("key_columns", member), ",")
    return F.when(sent.isNotNull(), F.concat(F.lit("{"), text, F.lit("}")))


def _list_key_state(sent: Column, old: Column) -> Column:
    def state(name: Column) -> Column:
        at = _place(name) - 1
        return field_state(F.get(sent, at), F.get(old, at), F.get("_columns", at)["type_oid"])

    states = F.transform("key_columns", state)
    return F.array_max(F.concat(F.array(F.lit(SENT)), states))


def _sent_fields(sent: Column, columns: Column) -> Column:
    """Columns of a tuple that were sent, paired with metadata by place.

    Surplus tuple columns are dropped, as are unchanged large values (status
    `u`), which the log does not carry.
    """
    paired = F.zip_with(
        F.slice(sent, F.lit(1), F.size(columns)),
        F.slice(columns, F.lit(1), F.size(sent)),
        lambda t, c: F.struct(
            c["name"].alias("name"),
            c["type_oid"].alias("oid"),
            t["status"].alias("status"),
            t["data"].alias("data"),
        ),
    )
    return F.filter(paired, lambda f: f["status"] != "u")


def _members(fields: str) -> Column:
    """Fields as `struct(name, json)`; NULL columns as the word null."""
    return F.transform(
        fields,
        lambda f: F.struct(
            f["name"].alias("name"),
            F.when(f["status"] == "n", "null")
            .otherwise(json_text(f["data"], f["oid"]))
            .alias("json"),
        ),
    )


def _object(members: str) -> Column:
    text = F.transform(
        F.array_sort(members), lambda m: F.concat(quote(m["name"]), F.lit(":"), m["json"])
    )
    return F.concat(F.lit("{"), F.array_join(text, ","), F.lit("}"))
