"""JSON decode / encode of event payloads (native ``from_json`` / ``to_json``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def payload_text(value="value") -> Column:
    """The message value as UTF-8 text (Kafka values arrive as binary)."""
    c = _c(value)
    return c.cast("string")


def is_json_object(text) -> Column:
    """True when ``text`` parses as JSON *and* is an object.

    ``from_json`` turns ``[1]`` or ``"x"`` into a struct of nulls instead of
    NULL, so validity is checked separately: the text parses, and valid JSON
    whose first non-blank character is ``{`` is an object.
    """
    t = _c(text)
    return F.try_parse_json(t).isNotNull() & t.rlike(r"^\s*\{")


def decode(df: DataFrame, schema: T.StructType, value: str = "value",
           keep: tuple[str, ...] = (), drop_invalid: bool = True,
           require: tuple[str, ...] = ()) -> DataFrame:
    """Decode a JSON payload column into the typed, flattened columns of
    ``schema``.  Undecodable or non-object payloads are dropped (or kept with
    null fields when ``drop_invalid`` is false).  Columns in ``keep`` (e.g.
    ``topic``, ``offset``) are carried along.  Rows where a ``require``d
    field is missing or unparsable (e.g. an event time that is not ISO-8601)
    are skipped."""
    text = payload_text(value)
    out = df.select(*[F.col(k) for k in keep], text.alias("__txt"))
    if drop_invalid:
        out = out.filter(is_json_object(F.col("__txt")))
    out = out.select(*[F.col(k) for k in keep],
                     F.from_json(F.col("__txt"), schema).alias("__d"))
    out = out.select(*[F.col(k) for k in keep], "__d.*")
    for r in require:
        out = out.filter(F.col(r).isNotNull())
    return out


def encode(df: DataFrame, key: str | None, ignore_null_fields: bool = True) -> DataFrame:
    """Keyed JSON envelope ``(key, value)`` of every row: ``to_json(struct(*))``;
    times keep their microseconds."""
    opts = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    if not ignore_null_fields:
        opts["ignoreNullFields"] = "false"
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), opts)
    key_col = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(key_col.alias("key"), value.alias("value"))


def json_field(text, path: str, cast: str | None = None) -> Column:
    """One field of a JSON text by JSON path, optionally cast."""
    v = F.get_json_object(_c(text), path)
    return v.cast(cast) if cast else v
