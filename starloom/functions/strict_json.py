"""Strictly typed reads of JSON text, as SQL expressions over Spark's VARIANT type.

Plain JSON readers coerce (a number becomes text, "42" becomes a long); these check the JSON kind first and
give null for a value of the wrong kind, so that a caller can tell a bad record from a good one. They are
SQL text because a projection has hundreds of them and building Column objects for each costs seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog import Kind


def parsed_steps(value: str) -> dict[str, str]:
    """Expressions, each using those before it, up to document: an array VARIANT around the single JSON value that the text of a
    column holds, null if it holds not exactly one.

    The JSON parser stops after the first value, so the text is parsed inside brackets: rubbish after the
    value breaks the array, an empty text leaves it empty and a second value leaves a second element. Only
    a text with "]" in it could close the bracket itself; that one must also parse as an object member.
    The brackets stay, because taking the value out of them would copy it.
    """
    alone = at("wrapped", "$[1]") + " is null"
    closed = f"case when contains({value}, ']') then try_parse_json(concat('{{\"v\":', {value}, '}}')) is not null else true end"
    return {"wrapped": f"try_parse_json(concat('[', {value}, ']'))", "document": f"case when {alone} and {closed} then wrapped end"}


def let(steps: dict[str, str], body: str) -> str:
    """body with the names of steps bound to their values, each evaluated once and only when body is."""
    for name, value in reversed(steps.items()):
        body = f"element_at(transform(array({value}), {name} -> {body}), 1)"
    return body


_AT_ONCE_BYTES = 1 << 20
_AT_ONCE = "map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '_corrupt', 'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"


def with_shapes(df: DataFrame, value: str, shapes: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds, by name, the JSON value that the text of a column holds as a struct of a type, in the rows that a condition holds for: shapes
    gives (type, condition). Read in one pass; members outside the type are skipped.

    Null says nothing: the text may hold no value, several, one of another shape, or one that has to be read as a whole. The text is
    parsed inside brackets; as it has no "]" of its own, nothing but one value with nothing behind it gives one element.
    """
    read = {f"_read{name}": F.expr(
        f"case when {condition} and not contains({value}, ']') and octet_length({value}) <= {_AT_ONCE_BYTES} "
        f"then from_json(concat('{{\"v\":[', {value}, ']}}'), 'v array<{shape}>, _corrupt string', {_AT_ONCE}) end")
        for name, (shape, condition) in shapes.items()}
    found = {name: F.expr(f"case when _read{name}._corrupt is null and size(_read{name}.v) = 1 then _read{name}.v[0] end") for name in shapes}
    return df.withColumns(read).withColumns(found).drop(*read)


def at(document: str, path: str) -> str:
    """The value at a path: null if absent, a JSON null if null. Copies the value, so take scalars by full path."""
    return f"try_variant_get({document}, '{path}', 'variant')"


def kind_of(value: str) -> str:
    """BIGINT, STRING, BOOLEAN, DECIMAL(p,s), DOUBLE, OBJECT<...>, ARRAY<...>, VOID for JSON null; null if absent."""
    return f"schema_of_variant({value})"


def is_object(value: str) -> str:
    """Whether value is a JSON object; this derives the whole type, so ask only where a member does not tell."""
    return f"coalesce({kind_of(value)} like 'OBJECT<%', false)"


def present(value: str) -> str:
    """True for a member that exists and is not JSON null."""
    return f"({value} is not null and not is_variant_null({value}))"


def typed(document: str, path: str, json_kind: str, kind: Kind) -> str:
    """The value at a path, of kind json_kind, as the Spark type of kind; null where the JSON kind does not allow that."""
    read = lambda spark_type: f"try_variant_get({document}, '{path}', '{spark_type}')"
    cases = {
        Kind.BIGINT: [("= 'BIGINT'", read("bigint"))],
        Kind.INTEGER: [("= 'BIGINT'", read("int"))],
        Kind.TEXT: [("= 'STRING'", read("string"))],
        Kind.DECIMAL_TEXT: [("<> 'VOID'", read("string"))],
        Kind.BOOLEAN: [("= 'BOOLEAN'", read("boolean")), ("= 'BIGINT'", f"{read('int')} <> 0")],
        Kind.MILLIS: [("= 'BIGINT'", read("bigint")), ("= 'STRING'", f"try_cast({read('string')} as bigint)")],
    }[kind]
    return "case " + " ".join(f"when {json_kind} {test} then {value}" for test, value in cases) + " end"
