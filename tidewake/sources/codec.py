"""The log's wire format and a file-backed schema registry.

A record is either one JSON object or a schema-registry frame: 0x00, a big-endian 4-byte schema id, the
zigzag list of message indexes, then a protobuf message. The message has seven scalar fields, so it is
read and written here without a protobuf package; unknown fields are skipped, absent ones are empty.
"""

from __future__ import annotations

import json
import os
import struct
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.schema import EVENT_COLUMNS

MAX_INDEXES = 8
DECODED = "event_id string, account_id string, time_us long, kind string, collection string, operation string, subject_account_id string, format string, schema_id int, error string"


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(b: bytes, i: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        if i >= len(b) or shift > 63:
            raise ValueError("truncated varint")
        n |= (b[i] & 0x7F) << shift
        shift, i = shift + 7, i + 1
        if b[i - 1] < 0x80:
            return n & (1 << 64) - 1, i


def encode(event: dict, schema_id: int) -> bytes:
    """Frames one event; empty fields are left out."""
    out = bytearray(b"\0" + struct.pack(">I", schema_id) + b"\0")
    for number, name in enumerate(EVENT_COLUMNS, 1):
        v = event.get(name)
        if name == "time_us":
            if v:
                out += bytes([number << 3]) + _varint(int(v))
        elif v:
            raw = v.encode()
            out += bytes([number << 3 | 2]) + _varint(len(raw)) + raw
    return bytes(out)


def _message(b: bytes, i: int) -> dict:
    ev = {n: 0 if n == "time_us" else "" for n in EVENT_COLUMNS}
    while i < len(b):
        tag, i = _read_varint(b, i)
        number, wire = tag >> 3, tag & 7
        if number == 0:
            raise ValueError("field number 0")
        if wire == 0:
            v, i = _read_varint(b, i)
        elif wire in (1, 5):
            v, i = None, i + (8 if wire == 1 else 4)
        elif wire == 2:
            n, i = _read_varint(b, i)
            v, i = b[i : i + n], i + n
        else:
            raise ValueError(f"wire type {wire}")
        if i > len(b):
            raise ValueError("truncated field")
        if 1 <= number <= len(EVENT_COLUMNS):
            name = EVENT_COLUMNS[number - 1]
            if name == "time_us" and wire == 0:
                ev[name] = v - (1 << 64) if v >> 63 else v
            elif name != "time_us" and wire == 2:
                ev[name] = v.decode()
    return ev


def decode(b: bytes | None) -> tuple[dict, str, int]:
    """(event, format, schema id); raises ValueError for anything that is not a record."""
    if not b:
        raise ValueError("empty record")
    if b[:1] == b"{":
        got = json.loads(b)
        ev = {n: got.get(n) or (0 if n == "time_us" else "") for n in EVENT_COLUMNS}
        if not all(isinstance(ev[n], int if n == "time_us" else str) for n in EVENT_COLUMNS):
            raise ValueError("json event with a field of another type")
        kind, schema_id = "json", 0
    elif b[0] == 0:
        if len(b) < 6:
            raise ValueError("truncated header")
        schema_id = struct.unpack(">I", b[1:5])[0]
        count, i = _read_varint(b, 5)
        count = (count >> 1) ^ -(count & 1)
        if not 0 <= count <= MAX_INDEXES:
            raise ValueError("message index list too long")
        for _ in range(count):
            _, i = _read_varint(b, i)
        ev, kind = _message(b, i), "protobuf"
    else:
        raise ValueError(f"unknown record format (first byte {b[0]})")
    if not ev["event_id"]:
        raise ValueError(f"{kind} event without event_id")
    return ev, kind, schema_id


def encode_log(log: DataFrame, schema_id: int, json_share: int = 0) -> DataFrame:
    """Adds ``value``: the framed event; with json_share n, every n-th offset is a legacy JSON record."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = pdf[EVENT_COLUMNS].to_dict("records")
            yield pdf.assign(value=[json.dumps(r).encode() if json_share and o % json_share == 0 else encode(r, schema_id) for r, o in zip(rows, pdf["kafka_offset"], strict=True)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in log.schema.fields)
    return log.mapInPandas(run, f"{schema}, value binary")


def decode_log(log: DataFrame, value: str = "value") -> DataFrame:
    """Adds a struct ``decoded`` (event columns, format, schema_id, error) in Arrow batches; bad records get an error, never an exception."""

    @F.pandas_udf(DECODED)
    def run(values: pd.Series) -> pd.DataFrame:
        rows = []
        for b in values:
            try:
                ev, kind, sid = decode(None if b is None else bytes(b))
                rows.append([*(ev[n] for n in EVENT_COLUMNS), kind, sid, None])
            except (ValueError, UnicodeDecodeError) as e:
                rows.append([None] * 9 + [str(e)])
        out = pd.DataFrame(rows, columns=[*EVENT_COLUMNS, "format", "schema_id", "error"])
        return out.astype({"time_us": "Int64", "schema_id": "Int32"})

    return log.withColumn("decoded", run(value))


class Registry:
    """Subjects and versions in one JSON file; a field may be added, never renumbered, retyped or reused."""

    def __init__(self, path: str):
        self.path = path

    def _load(self) -> dict:
        return json.load(open(self.path)) if os.path.exists(self.path) else {"schemas": [], "subjects": {}}

    def register(self, topic: str, fields: dict[int, tuple[str, str]]) -> int:
        """Id of the schema under ``<topic>-value``; ValueError if it is not BACKWARD compatible with the last."""
        state, subject = self._load(), f"{topic}-value"
        schema = {str(k): list(v) for k, v in sorted(fields.items())}
        ids = state["subjects"].setdefault(subject, [])
        for i in ids:
            if state["schemas"][i - 1] == schema:
                return i
        if ids:
            last = state["schemas"][ids[-1] - 1]
            names = {v[0]: k for k, v in last.items()}
            for k, (name, kind) in schema.items():
                if (k in last and last[k][1] != kind) or names.get(name, k) != k:
                    raise ValueError(f"409: field {name} ({k}) is incompatible")
        state["schemas"].append(schema)
        ids.append(len(state["schemas"]))
        fd, tmp = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(self.path)))
        with os.fdopen(fd, "w") as f:
            json.dump(state, f)
        os.replace(tmp, self.path)
        return ids[-1]
