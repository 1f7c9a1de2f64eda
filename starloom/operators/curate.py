"""Raw change events to typed curated records, with bad records routed to quarantine.

Every raw row falls in exactly one class, decided in this order:

* ignored: no value (tombstone), unknown topic, or no after-image;
* parse-failed: the text is not one JSON envelope;
* projection-failed: a required field is missing or null, or a field has the wrong JSON kind;
* curated.

The whole thing is one stateless projection without a shuffle. A change of the usual form is read in one typed pass over its text;
any row that this pass can't vouch for is parsed again, into a VARIANT, and judged member by member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.catalog import CATALOG, Catalog, EntitySpec, Field, Kind
from starloom.functions.scalars import operation_letter, text
from starloom.functions.strict_json import at, is_object, kind_of, let, parsed_steps, present, typed, with_shapes
from starloom.session import materialize

CURATED, IGNORED = "curated", "ignored"
PARSE_FAILED, PROJECTION_FAILED = "parse-failed", "projection-failed"
QUARANTINE = "_quarantine"


def _pinned(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with the columns passed through a one-row generator.

    The optimizer moves a filter below a projection by copying the projected expressions into it, which would
    parse the JSON once per mention; it does not move a filter on a generator's output.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns))))


def _operation(code: str) -> str:
    """Envelope operation codes; an unknown code stays, a missing one becomes "?"."""
    return f"case {code} when 'r' then 'snapshot' when 'c' then 'insert' when 'u' then 'update' when 'd' then 'delete' else coalesce({code}, '?') end"


def _envelope_steps() -> dict[str, str]:
    """Expressions, each using those before it, up to operation, source_ts_ms, after (VARIANT) and parsed (boolean) of a text in value."""
    pick = lambda path: f"case when inside then {at('document', f'$[0].payload.{path}')} else {at('document', f'$[0].{path}')} end"
    op_ok = f"case when op is not null then {kind_of('op')} in ('STRING', 'VOID') else true end"
    source_ok = (f"case when ts is not null then {kind_of('ts')} = 'BIGINT' "
                 f"when {pick('source')} is not null then {is_object(pick('source'))} else true end")
    # only where it does not follow from a member that was found is a whole object looked at
    envelope_ok = (f"case when after is not null then true when inside then {is_object(at('document', '$[0].payload'))} "
                   f"else {is_object(at('document', '$[0]'))} end")
    return {
        **parsed_steps("value"), "nested": at("document", "$[0].payload.after"),
        "inside": f"nested is not null or {at('document', '$[0].payload')} is not null",
        "after": f"case when inside then nested else {at('document', '$[0].after')} end", "op": pick("op"), "ts": pick("source.ts_ms"),
        "code": "try_variant_get(op, '$', 'string')", "operation": _operation("code"),
        "source_ts_ms": "coalesce(try_variant_get(ts, '$', 'bigint'), 0)", "parsed": f"({envelope_ok}) and ({op_ok}) and ({source_ok})"}


def _known(raw: DataFrame, catalog: Catalog) -> DataFrame:
    """The non-null rows of known topics with their entity."""
    entity = F.create_map(*[F.lit(x) for s in catalog for x in (s.raw_topic, s.entity)])
    return raw.where(F.col("topic").isin(catalog.raw_topics) & F.col("value").isNotNull()).withColumn("entity", entity[F.col("topic")])


def parse_envelopes(raw: DataFrame, catalog: Catalog = CATALOG) -> DataFrame:
    """Known, non-null raw rows with entity, operation, source_ts_ms, after (VARIANT) and parsed (boolean)."""
    parts = _known(raw, catalog)
    for name, value in _envelope_steps().items():
        parts = parts.withColumn(name, F.expr(value))
    found = ["operation", "source_ts_ms", "after", "parsed"]
    return _pinned(parts.select(*raw.columns, "entity", *found), found)


def _owners(catalog: Catalog) -> dict[str, tuple[Field, list[str]]]:
    """Each field name of the catalog with the entities that have it."""
    owners: dict[str, tuple[Field, list[str]]] = {}
    for spec in catalog:
        for field in spec.fields:
            owners.setdefault(field.name, (field, []))[1].append(spec.entity)
    return owners


def _names(entities: list[str]) -> str:
    return ", ".join(f"'{e}'" for e in entities)


def _per_entity(catalog: Catalog, expression) -> str:
    """expression(spec) of the row's own entity."""
    return "case entity " + " ".join(f"when '{s.entity}' then {expression(s)}" for s in catalog) + " end"


_USUAL = {Kind.BIGINT: "bigint", Kind.INTEGER: "int", Kind.BOOLEAN: "boolean", Kind.MILLIS: "bigint", Kind.TEXT: "variant", Kind.DECIMAL_TEXT: "variant"}


def _usual_value(field: Field, change: str) -> str:
    member = f"{change}.after.`{field.source}`"
    return f"try_variant_get({member}, '$', 'string')" if _USUAL[field.kind] == "variant" else member


def _usual_ok(field: Field, change: str) -> str:
    """Whether the typed pass tells the field's value; a member of a wrong kind made a number or boolean unreadable before."""
    member = f"{change}.after.`{field.source}`"
    if field.kind is Kind.TEXT:
        return f"coalesce({kind_of(member)} in ('STRING', 'VOID'), true)" if field.nullable else f"coalesce({kind_of(member)} = 'STRING', false)"
    if not field.nullable:
        return f"{_usual_value(field, change)} is not null"
    return f"({_usual_value(field, change)} is not null or not {present(member)})" if field.kind is Kind.DECIMAL_TEXT else "true"


def _result(outcome: str, message: str, operation: str, ts: str, values: dict[str, str]) -> str:
    fields = "".join(f", '_t_{name}', {value}" for name, value in values.items())
    return f"named_struct('outcome', {outcome}, 'message', {message}, 'operation', {operation}, 'source_ts_ms', {ts}{fields})"


def _own(entities: list[str], catalog: Catalog, value: str) -> str:
    """value in rows of some entities, else null."""
    return value if len(entities) == len(catalog.entities) else f"case when entity in ({_names(entities)}) then {value} end"


def _with_usual(known: DataFrame, catalog: Catalog) -> DataFrame:
    """known with _usual, the result of a row that one typed pass shows to be curated; null for a row to be judged in full.

    A row is read into a struct of its own entity's members: the reader's cost grows with the members it could find, not with those there."""
    owners = _owners(catalog)
    if any(len({f.source.lower() for f in s.fields}) < len(s.fields) for s in catalog) or any(
            f.kind is not owners[f.name][0].kind for s in catalog for f in s.fields):     # names that differ in case alone, or a column of two kinds
        return known.withColumn("_usual", F.lit(None))
    change = {s.entity: f"_change_{i}" for i, s in enumerate(catalog)}
    shapes, changes = {}, {}
    for i, spec in enumerate(catalog):
        members = ", ".join(f"`{f.source}`: {_USUAL[f.kind]}" for f in spec.fields)
        body = f"op: variant, source: struct<ts_ms: bigint>, after: struct<{members}>"
        shapes[f"_shape_{i}"] = (f"struct<payload: struct<{body}>, {body}>", f"entity = '{spec.entity}'")
        # an object without "payload" is the change itself; a name may be spelled in escapes
        changes[f"_change_{i}"] = F.expr(
            f"case when _shape_{i}.payload.after is not null then _shape_{i}.payload when _shape_{i}.after is not null and not contains(value, 'payload') "
            f"and not contains(value, concat(chr(92), 'u')) then named_struct('op', _shape_{i}.op, 'source', _shape_{i}.source, 'after', _shape_{i}.after) end")
    placed = with_shapes(known, "value", shapes).withColumns(changes).drop(*shapes)
    code = _per_entity(catalog, lambda s: f"try_variant_get({change[s.entity]}.op, '$', 'string')")
    usual = _per_entity(catalog, lambda s: f"{change[s.entity]}.source.ts_ms is not null and coalesce({kind_of(f'{change[s.entity]}.op')} in ('STRING', 'VOID'), true) and "
                        + " and ".join(_usual_ok(f, change[s.entity]) for f in s.fields))
    values = {name: "case entity " + " ".join(f"when '{e}' then {_usual_value(field, change[e])}" for e in entities) + " end" for name, (field, entities) in owners.items()}
    result = _result(f"'{CURATED}'", "cast(null as string)", _operation("_code"), _per_entity(catalog, lambda s: f"{change[s.entity]}.source.ts_ms"), values)
    told = placed.withColumn("_code", F.expr(code))
    return told.withColumn("_usual", F.expr(f"case when {usual} then {result} end")).drop("_code", *changes)


def _in_full(catalog: Catalog) -> str:
    """The result of any row, from its text as a VARIANT."""
    owners = _owners(catalog).values()
    path = lambda field: f"$.{field.source}"
    kinds = ", ".join(f"'_k_{field.name}', {_own(entities, catalog, kind_of(at('after', path(field))))}" for field, entities in owners)
    values = ", ".join(f"'_t_{field.name}', {typed('after', path(field), f'k._k_{field.name}', field.kind)}" for field, _ in owners)
    outcome = (f"case when not parsed then '{PARSE_FAILED}' when not {present('after')} then '{IGNORED}' "
               f"when failure is not null then '{PROJECTION_FAILED}' else '{CURATED}' end")
    message = (f"case outcome when '{PARSE_FAILED}' then 'The value is not a well-formed change envelope.' "
               f"when '{PROJECTION_FAILED}' then failure end")
    steps = {**_envelope_steps(), "k": f"named_struct({kinds})", "t": f"named_struct({values})", "failure": _per_entity(catalog, _spec_failure), "outcome": outcome}
    return let(steps, _result("outcome", message, "operation", "source_ts_ms", {field.name: f"case when outcome = '{CURATED}' then t._t_{field.name} end" for field, _ in owners}))


def _failure(field: Field) -> str:
    """Message for a field that cannot be projected, else null."""
    json_kind, value = f"k._k_{field.name}", f"t._t_{field.name}"
    wrong = f"{field.source}: not of a kind that {field.name} ({field.kind.value}) can hold"
    absent = f"({json_kind} is null or {json_kind} = 'VOID')"
    if field.nullable:
        return f"case when not {absent} and {value} is null then '{wrong}' end"
    missing = f"{field.source}: absent or null, {field.name} is required"
    return f"case when {absent} then '{missing}' when {value} is null then '{wrong}' end"


def _spec_failure(spec: EntitySpec) -> str:
    """Message of the first field of spec, in its order, that cannot be projected."""
    required = next(f for f in spec.fields if not f.nullable)
    not_object = (f"case when k._k_{required.name} is null and not {is_object('after')} "
                  "then 'The after-image is not a JSON object.' end")
    return f"coalesce({', '.join([not_object, *[_failure(f) for f in spec.fields]])})"


def _judged(raw: DataFrame, catalog: Catalog) -> DataFrame:
    """Known raw rows with the typed fields of all entities (null unless curated), operation, source_ts_ms, outcome and message."""
    usual = _with_usual(_known(raw, catalog), catalog)
    # the full reading is evaluated for the rows that need it, and stays out of the code generated for all others
    judged = _pinned(usual.withColumn("_row", F.expr(f"coalesce(_usual, {_in_full(catalog)})")).drop("_usual"), ["_row"])
    return judged.select(*[c for c in judged.columns if c != "_row"], "_row.*")


def _curated_at(curated_at) -> Column:
    instant = curated_at if isinstance(curated_at, Column) else F.lit(curated_at).cast("timestamp")
    return F.unix_millis(instant)


def classify(raw: DataFrame, curated_at, catalog: Catalog = CATALOG) -> DataFrame:
    """Every known raw row once, with its outcome, message and the fields of all entities side by side.

    A field that several entities share is one column; it is null in rows of other entities. One write of
    this frame partitioned by route replaces a pass per entity.
    """
    judged = _judged(raw, catalog)
    good = F.col("outcome") == CURATED
    fields = [F.col(f"_t_{name}").alias(name) for name in _owners(catalog)]
    key = F.expr(_per_entity(catalog, lambda s: f"coalesce(cast(_t_{s.key_field} as string), '')"))
    return judged.select(
        F.when(good, F.col("entity")).otherwise(QUARANTINE).alias("route"), "entity", "outcome", "message", "topic",
        "partition", "offset", *fields, "operation", F.col("source_ts_ms").alias("sourceTsMs"),
        _curated_at(curated_at).alias("curatedAtUtc"), F.when(good, key).alias("key"))


def entity_frame(classified: DataFrame, spec: EntitySpec) -> DataFrame:
    """The curated records of one entity out of classify's output, with key and position."""
    return classified.where(F.col("route") == spec.entity).select(
        *[f.name for f in spec.to_struct_type().fields], "key", "partition", "offset")


def curate_entity(raw: DataFrame, spec: EntitySpec, curated_at) -> DataFrame:
    """The curated records of one entity, projecting only its own fields."""
    catalog = Catalog([spec])
    judged = _judged(raw.where(F.col("topic") == spec.raw_topic), catalog)
    return judged.where(F.col("outcome") == CURATED).select(
        *[F.col(f"_t_{f.name}").alias(f.name) for f in spec.fields], "operation",
        F.col("source_ts_ms").alias("sourceTsMs"), _curated_at(curated_at).alias("curatedAtUtc"), "partition", "offset",
        text(F.col(f"_t_{spec.key_field}").cast("string")).alias("key"))


def quarantine(classified: DataFrame, trace_id: str, observed_at) -> DataFrame:
    """Error rows of the records that could not be curated."""
    at = observed_at if isinstance(observed_at, Column) else F.lit(observed_at).cast("timestamp")
    return classified.where(F.col("outcome").isin(PARSE_FAILED, PROJECTION_FAILED)).select(
        at.alias("event_time"), F.lit(trace_id).alias("trace_id"), F.lit("curation").alias("service"),
        F.col("outcome").alias("error_code"), F.col("message"), F.lit("").alias("stack"),
        "topic", "partition", "offset")


def curate(raw: DataFrame, curated_at, catalog: Catalog = CATALOG, trace_id: str = "") -> tuple[dict[str, DataFrame], DataFrame]:
    """Curated frame per entity and the error rows."""
    classified = materialize(classify(raw, curated_at, catalog), "classified")       # parsed once, read per entity
    frames = {s.entity: entity_frame(classified, s) for s in catalog}
    return frames, quarantine(classified, trace_id, curated_at)


def record_counts(curated: DataFrame, catalog: Catalog = CATALOG) -> DataFrame:
    """Records per entity, 0 for an entity without any, in catalog order of names."""
    spark = curated.sparkSession
    names = spark.createDataFrame([(e,) for e in catalog.entities], "entity string")
    counts = curated.where(F.col("outcome") == CURATED).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    return names.join(F.broadcast(counts), "entity", "left").select(
        "entity", F.coalesce("n", F.lit(0)).cast("bigint").alias("records"))


def customer_change_events(customers: DataFrame) -> DataFrame:
    """The commerce change contract: customer id, code and I/U/D."""
    return customers.select("customerId", "customerCode", operation_letter("operation").alias("operation"))
