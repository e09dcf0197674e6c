"""Row rules: every row is kept, with the names of the rules it breaks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.functions.messages import elements, ends_at_first_brace, is_one
from syncspark.schemas import NAME_LIMIT, STATE_LIMIT

VIOLATIONS = "violations"

Rules = Mapping[str, Column]


def not_null(*names: str) -> dict[str, Column]:
    return {f"{name} is null": F.col(name).isNull() for name in names}


def max_length(limit: int, *names: str) -> dict[str, Column]:
    """Length in characters; null is within any limit."""
    return {
        f"{name} longer than {limit}": F.coalesce(F.char_length(F.col(name)) > limit, F.lit(False))
        for name in names
    }


def users_rules() -> dict[str, Column]:
    return {**not_null("login"), **max_length(NAME_LIMIT, "login", "gravatar_id", "avatar_url", "url")}


def repositories_rules() -> dict[str, Column]:
    return {**not_null("name"), **max_length(NAME_LIMIT, "name", "url")}


def change_log_rules() -> dict[str, Column]:
    return {**users_rules(), **max_length(STATE_LIMIT, "state")}


# JSON types a field may have, as Spark names the type of a variant value.
INT = ("BIGINT",)
STRING = ("STRING",)
STRING_OR_NULL = ("STRING", "VOID")

# Document rules of the two collections.
USERS_DOCUMENT = {
    "user_id": INT,
    "login": STRING,
    "gravatar_id": STRING_OR_NULL,
    "avatar_url": STRING_OR_NULL,
    "url": STRING_OR_NULL,
}
REPOSITORIES_DOCUMENT = {"repo_id": INT, "name": STRING, "url": STRING_OR_NULL}


KINDS = "_kinds"
_WHOLE = "whole"


DOCUMENT = "_document"


def with_document(df: DataFrame, text: str) -> DataFrame:
    """Add the JSON value of a text as a variant; null where it is not one value."""
    # The variant parser stops at the end of the first value.
    body, closed = F.col(text), ends_at_first_brace(F.col(text))
    parsed = df.withColumn("_variant", F.try_parse_json(body)).withColumn(
        "_parts", F.when(~closed, elements(body))
    )
    whole = F.when(closed | is_one(F.col("_parts"), body), F.col("_variant"))
    return parsed.withColumn(DOCUMENT, whole).drop("_variant", "_parts")


def with_kinds(df: DataFrame, text: str, fields: Sequence[str]) -> DataFrame:
    """Add the JSON types of a document and of its fields; null where absent.

    The text is inspected rather than a parsed struct, because a parser that
    casts would turn the number 12 into an acceptable login.
    """
    document = F.col(DOCUMENT)
    kinds = [F.schema_of_variant(document).alias(_WHOLE)]
    for i, name in enumerate(fields):
        value = F.try_variant_get(document, f"$.{name}", "variant")
        kinds.append(F.schema_of_variant(value).alias(f"field_{i}"))
    return with_document(df, text).select(*df.columns, F.inline(F.array(F.struct(F.struct(*kinds).alias(KINDS)))))


WHOLE_DOCUMENT = "$"
UNREADABLE = "none"


def _values(df: DataFrame, text: str) -> DataFrame:
    """``field, value``: each document as a whole, and each of its fields."""
    document = F.col(DOCUMENT)
    fields = F.map_entries(F.try_variant_get(document, WHOLE_DOCUMENT, "map<string,variant>"))
    whole = F.array(F.struct(F.lit(WHOLE_DOCUMENT).alias("key"), document.alias("value")))
    return with_document(df.select(text), text).select(
        F.inline(F.when(fields.isNull(), whole).otherwise(F.concat(whole, fields))).alias("field", "value")
    )


def types_seen(df: DataFrame, text: str, declared: Mapping[str, Sequence[str]]) -> DataFrame:
    """``field, type, n, as_declared``: the JSON types that the fields of all texts have.

    The field ``$`` is the document itself, whose type is ``none`` where a text
    is null or not one JSON value. A field that is not declared, or has another
    type than declared, is not as declared; a document has to be an object.
    """
    type_name = F.coalesce(F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0), F.lit(UNREADABLE))
    seen = _values(df, text).groupBy("field", type_name.alias("type")).agg(F.count(F.lit(1)).alias("n"))
    as_declared = F.lit(False)
    for name, allowed in {WHOLE_DOCUMENT: ("OBJECT",), **declared}.items():
        as_declared = as_declared | ((F.col("field") == name) & F.col("type").isin(*allowed))
    return seen.withColumn("as_declared", as_declared)


def merged_types(df: DataFrame, text: str) -> DataFrame:
    """``field, type, n``: the one type that holds every value of a field, VARIANT where none does."""
    fields = _values(df, text).where(F.col("field") != WHOLE_DOCUMENT)
    return fields.groupBy("field").agg(F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("n"))


def document_rules(types: Mapping[str, Sequence[str]], required: Sequence[str]) -> dict[str, Column]:
    """Rules on the types found by :func:`with_kinds` for the same fields."""
    rules = {"not an object": ~F.coalesce(F.col(f"{KINDS}.{_WHOLE}").startswith("OBJECT"), F.lit(False))}
    for i, (name, allowed) in enumerate(types.items()):
        kind = F.col(f"{KINDS}.field_{i}")
        if name in required:
            rules[f"{name} is missing"] = kind.isNull()
        rules[f"{name} has a wrong type"] = F.coalesce(~kind.isin(*allowed), F.lit(False))
    return rules


def check_documents(
    df: DataFrame, text: str, types: Mapping[str, Sequence[str]], required: Sequence[str]
) -> DataFrame:
    """Add the names of the document rules that each JSON text breaks."""
    kinds = with_kinds(df, text, list(types))
    return check(kinds, document_rules(types, required)).drop(KINDS)


def check(df: DataFrame, rules: Rules) -> DataFrame:
    """Add the sorted names of the broken rules.

    They are generated, not projected, so a filter on them does not evaluate
    every rule a second time.
    """
    named = [F.when(test, F.lit(name)) for name, test in sorted(rules.items())]
    names = F.array_compact(F.array(*named)).alias(VIOLATIONS)
    return df.select("*", F.inline(F.array(F.struct(names))))


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def broken(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(VIOLATIONS) > 0)


def require_columns(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail at analysis, before any data is read, when columns are not as declared."""
    have = {f.name: f.dataType for f in df.schema.fields}
    if not have:
        raise ValueError("the frame has no columns")
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        f"{have[f.name].simpleString() if f.name in have else 'nothing'}"
        for f in expected.fields
        if have.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df
