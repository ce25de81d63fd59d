"""Redaction of log parameters, and white lists of JSON fields."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import unicode_trim

# Parts of names that make a key sensitive, and parts of values that make a value so.
SENSITIVE_KEYS = (
    "apikey", "authorization", "bearer", "bucket", "content", "databaseurl",
    "downloadurl", "fileref", "internalurl", "minio", "objectkey",
    "password", "prompt", "secret", "signedurl", "storageurl", "token",
    "url",
)
SENSITIVE_VALUES = (
    "api_key", "apikey", "authorization:", "bearer ", "database_url", "file_ref", "fileref",
    "http://", "https://", "internalurl", "minio", "objectkey", "password", "prompt",
    "s3://", "secret", "signedurl", "storageurl", "token", "x-amz-",
)
REDACTED, MOST_BYTES = "[redacted]", 256


def sensitive_key(key: Column) -> Column:
    return F.lower(F.translate(key, "_-", "")).rlike("|".join(SENSITIVE_KEYS))


def clean_value(value: Column) -> Column:
    text = unicode_trim(value)
    bad = (F.octet_length(text) > MOST_BYTES) | F.lower(text).rlike("|".join(SENSITIVE_VALUES))
    return F.when(bad, F.lit(REDACTED)).otherwise(text)


def clean_map(c: Column) -> Column:
    """A flat map<string,string> with trimmed keys, without blank and sensitive ones, and with redacted values.

    Of keys that are equal when trimmed, the last in key order stays.
    """
    entries = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.struct(unicode_trim(e["key"]).alias("key"), clean_value(e["value"]).alias("value")))
    entries = F.filter(entries, lambda e: (e["key"] != "") & ~sensitive_key(e["key"]))
    later = F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"),
                                                       F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]).alias("again")))
    return F.map_from_entries(F.transform(F.filter(later, lambda e: ~e["again"]), lambda e: F.struct(e["key"], e["value"])))


def _clean(value):
    if isinstance(value, dict):
        named = {k.strip(): v for k, v in value.items()}
        return {k: _clean(v) for k, v in named.items() if k and not any(n in k.replace("_", "").replace("-", "").lower() for n in SENSITIVE_KEYS)}
    if isinstance(value, list):
        return [_clean(v) for v in value]
    if isinstance(value, str):
        text = value.strip()
        return REDACTED if len(text.encode()) > MOST_BYTES or any(m in text.lower() for m in SENSITIVE_VALUES) else text
    return value


@F.pandas_udf(StringType())
def clean_json(texts: pd.Series) -> pd.Series:
    """Any depth of objects and lists; text that is no JSON becomes null."""
    def one(text):
        try:
            return json.dumps(_clean(json.loads(text)), sort_keys=True, ensure_ascii=False)
        except (TypeError, ValueError):
            return None
    return texts.map(one)


def only_fields(c: Column, schema: str) -> Column:
    """JSON with nothing but the fields of the schema."""
    return F.to_json(F.from_json(c, schema))


def strict_json(c: Column) -> Column:
    """The text as a variant if it is exactly one JSON value, else null: nothing may stand behind it."""
    # The parser stops behind the first value. What may follow it in a list may not in an object, so both together leave nothing but the end.
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$", "array<variant>")
    return F.when((F.size(listed) == 1) & F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}"))).isNotNull(), F.get(listed, F.lit(0)))


def strict_fields(c: Column, names: list[str]) -> Column:
    """Whether the text is exactly one JSON object that has no other field: nothing may stand behind it."""
    unknown = F.array_except(F.json_object_keys(c), F.array(*[F.lit(n) for n in names]))
    return F.coalesce(strict_json(c).isNotNull() & (F.size(unknown) == 0), F.lit(False))


#: The fields that a chunk of a chat stream may keep, by the object they stand in, and what marks it as one (fixed values).
CHUNK_MARK = "chat.completion.chunk"
CHUNK_FIELDS = {"chunk": ("id", "object", "created", "model", "system_fingerprint"), "choice": ("index", "finish_reason"), "delta": ("role", "content", "refusal"),
                "tool_call": ("index", "id", "type"), "function": ("name", "arguments"), "usage": ("prompt_tokens", "completion_tokens", "total_tokens")}


def _field(v: Column, name: str) -> Column:
    """A field of an object; SQL null where it is missing, a JSON null where it is that."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _is(v: Column, kind: str) -> Column:
    """Whether a value is missing, null or of the kind."""
    return (_kind(v) == "VOID") | _kind(v).startswith(kind)


def _items(v: Column) -> Column:
    """The list's values; none of a null."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(F.parse_json(F.lit("[]")), "$", "array<variant>"))


def _kept(v: Column, kind: str, **more: Column) -> Column:
    """The object's fields that stay, in the order of their names."""
    fields = {n: _field(v, n) for n in CHUNK_FIELDS[kind]} | more
    return F.struct(*[fields[n].alias(n) for n in sorted(fields)])


def _given(v: Column, value: Column) -> Column:
    return F.when(v.isNotNull(), value)


def chunk_valid(chunk: Column) -> Column:
    """Whether a variant is a stream's chunk: the mark, a list of choices, and objects or lists where such belong. Null counts as empty."""
    delta = lambda c: _field(c, "delta")
    call = lambda t: _is(t, "OBJECT") & _is(_field(t, "function"), "OBJECT")
    said = lambda d: _is(d, "OBJECT") & _is(_field(d, "function_call"), "OBJECT") & _is(_field(d, "tool_calls"), "ARRAY") \
        & F.forall(_items(_field(d, "tool_calls")), call)
    choices = _field(chunk, "choices")
    whole = (F.try_variant_get(chunk, "$.object", "string") == CHUNK_MARK) & (_kind(_field(chunk, "object")) == "STRING") & choices.isNotNull() & _is(choices, "ARRAY")
    return F.coalesce(whole & F.forall(_items(choices), lambda c: _is(c, "OBJECT") & said(delta(c))) & _is(_field(chunk, "usage"), "OBJECT"), F.lit(False))


def clean_chunk(c: Column) -> Column:
    """The JSON text of a stream's chunk with its permitted fields only, at every depth; null where the text is no valid chunk."""
    def tool_call(t: Column) -> Column:
        return _kept(t, "tool_call", function=_given(_field(t, "function"), _kept(_field(t, "function"), "function")))

    def choice(c: Column) -> Column:
        d = _field(c, "delta")
        called, tools = _field(d, "function_call"), _field(d, "tool_calls")
        delta = _kept(d, "delta", function_call=_given(called, _kept(called, "function")), tool_calls=_given(tools, F.transform(_items(tools), tool_call)))
        return _kept(c, "choice", delta=_given(d, delta))

    chunk = strict_json(c)
    used = _field(chunk, "usage")
    whole = _kept(chunk, "chunk", choices=F.transform(_items(_field(chunk, "choices")), choice), usage=_given(used, _kept(used, "usage")))
    return F.when(chunk_valid(chunk), F.to_json(whole))


#: The fields of an ingestion task, all of them required (fixed values).
TASK_FIELDS = ("requestId", "jobId", "documentId", "knowledgeBaseId", "userId")


def decoded_task(c: Column, names: tuple[str, ...] = TASK_FIELDS) -> Column:
    """struct(error, fields): the trimmed strings of a strict payload.

    error: 'body' where the text is not one object of these fields with string values, else the first field that is missing or blank, else null.
    """
    raw = F.from_json(c, ", ".join(f"`{n}` string" for n in names))
    tree = F.try_parse_json(c)
    typed = F.lit(True)
    for n in names:
        kind = F.schema_of_variant(F.try_variant_get(tree, f"$.{n}", "variant"))
        typed = typed & F.coalesce(kind.isin("STRING", "VOID"), F.lit(True))
    values = {n: F.coalesce(unicode_trim(raw[n]), F.lit("")) for n in names}
    error = F.when(~(strict_fields(c, list(names)) & typed), "body")
    for n in names:
        error = error.when(values[n] == "", n)
    return F.struct(error.alias("error"), *[F.when(error.isNull(), v).alias(n) for n, v in values.items()])
