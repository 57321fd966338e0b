"""Declared schemas: value types, field rules, index settings."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T

from plumbline.errors import InvalidArgument

SPARSE = T.StructType(
    [
        T.StructField("indices", T.ArrayType(T.LongType())),
        T.StructField("values", T.ArrayType(T.FloatType())),
    ]
)

# The supported value types and how Spark holds each.
SCALARS = {
    "binary": T.BinaryType(),
    "string": T.StringType(),
    "bool": T.BooleanType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}
ARRAYS = {
    "arrayBinary": "binary",
    "arrayString": "string",
    "arrayBool": "bool",
    "arrayInt32": "int32",
    "arrayInt64": "int64",
    "arrayUInt32": "uint32",
    "arrayUInt64": "uint64",
    "arrayFloat": "float",
    "arrayDouble": "double",
}
DENSE = {
    "vectorBinary32": T.BinaryType(),
    "vectorBinary64": T.BinaryType(),
    "vectorFloat16": T.ArrayType(T.FloatType()),
    "vectorFloat32": T.ArrayType(T.FloatType()),
    "vectorFloat64": T.ArrayType(T.DoubleType()),
    "vectorInt4": T.ArrayType(T.ByteType()),
    "vectorInt8": T.ArrayType(T.ByteType()),
    "vectorInt16": T.ArrayType(T.ShortType()),
}
SPARSES = {"sparseVectorFloat16": SPARSE, "sparseVectorFloat32": SPARSE}

# Unsigned and packed ranges Spark types do not enforce.
RANGES = {
    "uint32": (0, 2**32 - 1),
    "uint64": (0, 2**64 - 1),
    "arrayUInt32": (0, 2**32 - 1),
    "arrayUInt64": (0, 2**64 - 1),
    "vectorInt4": (-8, 7),
}

# Rows per file, default and smallest allowed.
DEFAULT_SEGMENT_ROWS = 10_000_000
MIN_SEGMENT_ROWS = 1_000

# Index kinds with the settings and defaults of each.
INDEXES = {
    "flat": {"metric": "cosine", "quantization": "none"},
    "ivf": {
        "metric": "cosine",
        "cells": 1_024,
        "iterations": 10,
        "spill": False,
    },
    "approximate": {"metric": "cosine"},
    "inverted": {"range": True, "wildcard": False},
    "fulltext": {"tokenizer": "standard", "filters": [], "options": {}},
}


def spark_type(vtype: str) -> T.DataType:
    if vtype in SCALARS:
        return SCALARS[vtype]
    if vtype in ARRAYS:
        return T.ArrayType(SCALARS[ARRAYS[vtype]])
    if vtype in DENSE:
        return DENSE[vtype]
    if vtype in SPARSES:
        return SPARSES[vtype]
    raise InvalidArgument(f"unknown value type {vtype!r}")


def index_settings(kind: str, **settings) -> dict:
    """Settings of an index kind with defaults filled in."""
    if kind not in INDEXES:
        raise InvalidArgument(f"unknown index kind {kind!r}")
    unknown = set(settings) - set(INDEXES[kind])
    if unknown:
        raise InvalidArgument(f"index {kind!r} has no settings {sorted(unknown)}")
    return {"kind": kind, **INDEXES[kind], **settings}


@dataclass(frozen=True)
class Field:
    name: str
    vtype: str
    nullable: bool = False
    dim: int = 0
    index: dict | None = None

    def __post_init__(self):
        if not self.name:
            raise InvalidArgument("a field name must not be empty")
        spark_type(self.vtype)
        if self.vtype in DENSE:
            if self.dim <= 0:
                raise InvalidArgument("a dense vector needs positive dimensions")
        elif self.dim != 0:
            raise InvalidArgument("only dense vectors take dimensions")

    def struct_field(self) -> T.StructField:
        # Columns stay nullable in storage: a row may leave any field out.
        meta = {"vtype": self.vtype, "dim": self.dim, "required": not self.nullable}
        if self.index:
            meta["index"] = json.dumps(self.index, sort_keys=True)
        return T.StructField(self.name, spark_type(self.vtype), True, meta)

    @staticmethod
    def from_struct(column: T.StructField) -> Field:
        meta = column.metadata
        index = json.loads(meta["index"]) if "index" in meta else None
        return Field(
            column.name, meta["vtype"], not meta.get("required", False), meta.get("dim", 0), index
        )


@dataclass(frozen=True)
class Schema:
    name: str
    fields: tuple[Field, ...] = field(default_factory=tuple)
    segment_rows: int = DEFAULT_SEGMENT_ROWS

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(self.fields))
        if not self.name:
            raise InvalidArgument("a table name must not be empty")
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names) or "id" in names:
            raise InvalidArgument("field names must be unique and differ from 'id'")
        if self.segment_rows < MIN_SEGMENT_ROWS:
            raise InvalidArgument(f"segment_rows must be at least {MIN_SEGMENT_ROWS}")

    def __getitem__(self, name: str) -> Field:
        for item in self.fields:
            if item.name == name:
                return item
        raise InvalidArgument(f"unknown field {name!r}")

    def struct(self) -> T.StructType:
        key = T.StructField("id", T.StringType(), False)
        return T.StructType([key] + [f.struct_field() for f in self.fields])

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Schema:
        raw = json.loads(text)
        fields = tuple(Field(**f) for f in raw["fields"])
        return Schema(raw["name"], fields, raw["segment_rows"])
