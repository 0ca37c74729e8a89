"""Chat formatting: calls of tools linked with their results, put in order, checked, serialised.

Events are calls and results that name a call by an identifier within a conversation. They are
hash-joined by it; calls are put in topological order of the calls they need; arguments are
validated against the schema of their tool; each call becomes one line of canonical JSON (keys
sorted, no white space, one form for each number). Calls with one need form chains, whose depths
come from pointer doubling (rounds in the logarithm of the longest chain); rounds of Kahn's
algorithm place only the calls with several needs, so their number is how many of those lie behind
one another. A conversation is never gathered: its lines are numbered by running sums over buckets
of about equal size, so one of any length is many tasks' work.

No event is lost: the sum of `copies` (rows of the call, or of the event itself) and
`result_copies` (rows of its result) over all lines is the number of events. `status` tells apart:
`linked`; `no_result`; `no_call`, a result whose call is missing; `no_id`, a call or result without
identifier, linked to nothing; `cycle`, a call in a circle of needs or behind one; `conflict`, a
call (result) whose identifier an earlier one of another content has: the first by position, then by
text, is linked; `other`, an event of another or no kind, with its name and content. Lines without a
level come last. Rows of equal content are one line. Needs that no call meets are counted in
`missing` and don't hold a call up. Null and empty texts are kept as null and empty. A null
conversation is one of its own. An empty table gives an empty one.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offer_engine.llm.common import running, ship, small, stored

EVENT = "conv_id, position, kind, call_id, name, arguments, needs, content"
LINE = (
    "conv_id long, place long, level int, position long, call_id string, name string,"
    " status string, copies int, result_copies int, missing int, valid boolean, errors array<string>, json string"
)

#: Lines of a conversation, or of one depth in it, up to which they are ordered in one task, and
#: the buckets of about equal size that more are cut into.
LARGE = 100_000
CUTS = 512
#: Large groups up to which their cuts are broadcast.
CUT_GROUPS = 1000
#: Rounds after which the table of placed calls is stored anew.
STORE_ROUNDS = 8

Json = None | bool | int | float | str | list | dict


def canonical(value: Json) -> str:
    """JSON with sorted keys (by UTF-16 code units), no white space and one form of numbers."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("number is not finite")
        if value.is_integer() and abs(value) < 1e21:
            return str(int(value))
        mantissa, _, exponent = repr(value).partition("e")
        if not exponent:
            return mantissa
        power = int(exponent)
        if -7 < power < 0:
            return f"{value:.{len(mantissa.replace('.', '').lstrip('-')) - 1 - power}f}"
        return f"{mantissa.removesuffix('.0')}e{power:+d}"
    return json.dumps(value, ensure_ascii=False)


def parsed(text: str) -> Json:
    """The value of a JSON text; keys must be distinct and numbers finite."""

    def distinct(pairs: list[tuple[str, Json]]) -> dict[str, Json]:
        found = dict(pairs)
        if len(found) < len(pairs):
            raise ValueError("an object repeats a key")
        return found

    def refuse(name: str) -> None:
        raise ValueError(f"{name} is no JSON number")

    return json.loads(text, object_pairs_hook=distinct, parse_constant=refuse)


def kind_of(value: Json) -> str:
    if isinstance(value, bool):
        return "boolean"
    names = {dict: "object", list: "array", str: "string", type(None): "null", int: "integer"}
    if isinstance(value, float):
        return "integer" if value.is_integer() else "number"
    return names[type(value)]


def faults(value: Json, schema: Mapping, at: str = "$") -> list[str]:
    """What in the value breaks the schema (type, enum, required, properties,
    additionalProperties, items, minimum, maximum, minLength, maxLength, pattern)."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    kind = kind_of(value)
    if kinds and kind not in kinds and not (kind == "integer" and "number" in kinds):
        return [f"{at}: {kind} in place of {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not one of the values")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}: {k} is missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                found += faults(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}: {k} is unknown")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += faults(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            found.append(f"{at}: below {schema['minimum']}")
        if value > schema.get("maximum", value):
            found.append(f"{at}: above {schema['maximum']}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            found.append(f"{at}: shorter than {schema['minLength']}")
        if len(value) > schema.get("maxLength", len(value)):
            found.append(f"{at}: longer than {schema['maxLength']}")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            found.append(f"{at}: not of the pattern")
    return found


def checked(name: str | None, arguments: str | None, schemas: Mapping[str, Mapping]):
    """The arguments' value, and what is wrong with them."""
    try:
        value = parsed(arguments) if arguments is not None else None
        canonical(value)
    except (ValueError, RecursionError) as e:
        return arguments, [f"$: no JSON ({type(e).__name__})"]
    if name not in schemas:
        return value, ["$: unknown tool"]
    return value, faults(value, schemas[name])


def serialised(schemas: Mapping[str, Mapping]):
    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            valid, errors, lines = [], [], []
            for row in batch.to_pylist():
                line = {"id": row["call_id"], "status": row["status"]}
                wrong: list[str] = []
                if row["is_call"]:
                    value, wrong = checked(row["name"], row["arguments"], schemas)
                    line |= {"name": row["name"], "arguments": value}
                    line["needs"] = sorted(set(row["needs"] or []) - {None})
                if row["has_result"]:
                    line["result"] = row["content"]
                if row["status"] == "other":
                    line |= {"name": row["name"], "content": row["content"]}
                valid.append(bool(row["is_call"]) and not wrong)
                errors.append(wrong)
                lines.append(canonical(line))
            kept = [
                f.name for f in batch.schema if f.name not in ("arguments", "content", "needs", "is_call", "has_result")
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(batch.schema.get_field_index(n)) for n in kept],
                    pa.array(valid, pa.bool_()),
                    pa.array(errors, pa.list_(pa.string())),
                    pa.array(lines, pa.string()),
                ],
                [*kept, "valid", "errors", "json"],
            )

    return work


def first_of(events: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """One row per identifier, the first content by position, then by text, with its copies; and
    the other contents."""
    first = F.min(F.struct("late", "position", *columns, "copies")).alias("first")
    rows = events.groupBy("scope", "conv_id", "call_id", *columns).agg(
        F.min("position").alias("position"), F.sum("copies").cast("int").alias("copies")
    )
    rows = stored(rows.withColumn("late", F.col("position").isNull()))
    found = rows.groupBy("scope", "call_id").agg(
        first, F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("contents")
    )
    found = stored(found)
    taken = found.select("scope", "conv_id", "call_id", "first.*").drop("late")
    shared = found.filter("contents > 1").select("scope", "call_id", "first")
    own = F.struct("late", "position", *columns, "copies")
    others = rows.join(shared, ["scope", "call_id"]).filter(~own.eqNullSafe(F.col("first")))
    return taken, others.drop("first", "late")


def chains(state: DataFrame) -> DataFrame:
    """id, head, steps and known of all calls: the call that its chain of single needs ends at, how
    far off that is, and whether the chain ends at all."""
    alone = F.col("open") == 1
    chain = stored(
        state.select(
            "id",
            F.when(alone, F.col("up")).otherwise(F.col("id")).alias("head"),
            alone.cast("long").alias("steps"),
            (~alone).alias("known"),
        )
    )
    before, left = -1, chain.filter("not known").count()
    # Every round doubles the steps; while a chain that ends is unknown, some become known.
    while left and left != before:
        ahead = chain.select(
            F.col("id").alias("head"),
            F.col("head").alias("next"),
            F.col("steps").alias("more"),
            F.col("known").alias("ends"),
        )
        further = chain.filter("not known").join(ahead, "head")
        further = further.selectExpr("id", "next AS head", "steps + more AS steps", "ends AS known")
        chain = stored(chain.filter("known").unionByName(further))
        before, left = left, chain.filter("not known").count()
    return chain


def levels(calls: DataFrame) -> DataFrame:
    """id and level of the calls (id, needs array of ids) that no circle holds up."""
    ids = calls.select("id")
    edges = calls.select("id", F.explode(F.array_distinct("needs")).alias("need"))
    edges = stored(edges.join(ids.select(F.col("id").alias("need")), "need", "left_semi"))
    counts = edges.groupBy("id").agg(F.count(F.lit(1)).alias("open"), F.min("need").alias("up"))
    state = stored(
        ids.join(counts, "id", "left").select("id", F.coalesce("open", F.lit(0)).alias("open"), "up")
    )
    chain = chains(state)
    ended = chain.filter("known").select("id", "head", "steps")

    # Calls of several needs wait for the heads that the chains of their needs end at.
    waiting = stored(state.filter("open > 1").select("id", "open", F.lit(0).cast("long").alias("level")))
    fresh = done = state.filter("open = 0").select(F.col("id").alias("head"), F.lit(0).cast("long").alias("level"))
    behind = edges.join(waiting.select("id"), "id", "left_semi")
    behind = behind.join(ended.withColumnRenamed("id", "need"), "need").select("id", "head", "steps")
    rounds = 0
    if not waiting.isEmpty():
        behind = stored(behind)
    while not waiting.isEmpty() and not fresh.isEmpty():
        met = behind.join(fresh, "head").groupBy("id").agg(
            F.count(F.lit(1)).alias("met"), F.max(F.col("level") + F.col("steps") + 1).alias("least")
        )
        now = waiting.join(met, "id", "left").select(
            "id",
            (F.col("open") - F.coalesce("met", F.lit(0))).alias("open"),
            F.greatest("level", F.coalesce("least", F.lit(0))).alias("level"),
        )
        now = stored(now)
        fresh = now.filter("open = 0").select(F.col("id").alias("head"), "level")
        waiting = now.filter("open > 0")
        done = done.unionByName(fresh)
        rounds += 1
        if rounds % STORE_ROUNDS == 0:
            done = stored(done)
    return ended.join(done, "head").select("id", (F.col("level") + F.col("steps")).cast("int").alias("level"))


def cut_code(value: Column, cuts: Column) -> Column:
    """Number of the bucket that the cuts place a value in, with buckets of their own for values
    that are cuts (odd numbers); 0 without cuts."""
    below = F.size(F.filter(cuts, lambda c: c < value))
    return F.coalesce(2 * below + F.array_contains(cuts, value).cast("int"), F.lit(0))


def with_cuts(lines: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """lines with the number of the bucket of `value` among those of the same keys, where these
    hold more than LARGE lines."""
    large = stored(lines.groupBy(*keys).count().filter(F.col("count") > LARGE).drop("count"))
    if large.isEmpty():
        return lines.withColumn(out, F.lit(0))
    shares = [i / CUTS for i in range(1, CUTS)]
    large = small(large, CUT_GROUPS)
    cuts = lines.join(large, keys, "left_semi").groupBy(*keys)
    cuts = stored(cuts.agg(F.array_distinct(F.percentile_approx(value, shares)).alias("_cuts")))
    found = lines.join(small(cuts, CUT_GROUPS), keys, "left")
    return found.withColumn(out, cut_code(F.col(value), F.col("_cuts"))).drop("_cuts")


def numbered(lines: DataFrame) -> DataFrame:
    """lines with their place in their conversation: by level, position and, where these are equal,
    a hash of the line."""
    text = ["call_id", "name", "arguments", "content", "status"]
    lines = stored(
        lines.withColumns(
            {
                "depth": F.coalesce("level", F.lit(2**31 - 1)).cast("long"),
                "near": F.coalesce("position", F.lit(2**63 - 1)),
                "tie": F.xxhash64(*text),
                "one": F.lit(1),
            }
        )
    )
    lines = with_cuts(lines, ["scope"], "depth", "depth_cut")
    lines = with_cuts(lines, ["scope", "depth_cut"], "near", "near_cut")
    # Cuts of positions tell levels apart only where a bucket holds one level.
    alone = F.col("depth_cut") % 2 == 1
    near = F.when(alone, F.col("near_cut")).otherwise(0)
    tie = F.when(near % 2 == 1, F.shiftright("tie", 55)).otherwise(0)
    bucket = F.struct("depth_cut", near.alias("near"), tie.alias("tie"))
    lines = stored(lines.withColumn("bucket", bucket).drop("depth_cut", "near_cut"))
    order: list[Column | str] = ["depth", F.col("position").asc_nulls_last(), "tie", *text]
    return running(lines, ["scope"], "bucket", order, "one", "place")


def linked_calls(events: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row per call, and per result without one or other event, of events (conv_id, position,
    kind, call_id, name, arguments, needs, content): LINE's columns. place counts from 0 in a
    conversation."""
    ship(events.sparkSession)
    scope = F.when(F.col("conv_id").isNull(), "null").otherwise(
        F.concat(F.lit("="), F.col("conv_id").cast("string"))
    )
    rows = events.select(
        scope.alias("scope"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("position").cast("long").alias("position"),
        "kind",
        F.col("call_id").cast("string").alias("call_id"),
        *[F.col(c).cast("string").alias(c) for c in ("name", "arguments", "content")],
        F.col("needs").cast("array<string>").alias("needs"),
    )
    rows = stored(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("int").alias("copies")))
    named = rows.filter("call_id is not null")
    calls, other_calls = first_of(named.filter("kind = 'call'"), "name", "arguments", "needs")
    results, other_results = first_of(named.filter("kind = 'result'"), "content")
    calls = calls.withColumn("is_call", F.lit(True))
    results = results.select(
        "scope",
        "call_id",
        F.lit(True).alias("has_result"),
        F.col("copies").alias("result_copies"),
        F.col("conv_id").alias("result_conv"),
        F.col("position").alias("result_position"),
        "content",
    )
    both = stored(calls.join(results, ["scope", "call_id"], "full_outer"))

    identity = lambda c: F.concat_ws("\x1f", F.col("scope"), c)
    own = both.filter("is_call").select(
        identity(F.col("call_id")).alias("id"),
        F.transform(
            F.filter(F.coalesce("needs", F.array().cast("array<string>")), lambda n: n.isNotNull()),
            identity,
        ).alias("needs"),
    )
    placed = levels(own)
    known = own.select("id", F.explode(F.array_distinct("needs")).alias("need"))
    missing = known.join(own.select(F.col("id").alias("need")), "need", "left_anti")
    missing = missing.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("missing"))

    status = (
        F.when(F.col("is_call").isNull(), "no_call")
        .when(F.col("level").isNull(), "cycle")
        .when(F.col("has_result").isNull(), "no_result")
        .otherwise("linked")
    )
    found = (
        both.withColumn("id", identity(F.col("call_id")))
        .join(placed, "id", "left")
        .join(missing, "id", "left")
        .select(
            "scope",
            F.coalesce("conv_id", "result_conv").alias("conv_id"),
            "level",
            F.coalesce("position", "result_position").alias("position"),
            "call_id",
            "name",
            status.alias("status"),
            F.coalesce("copies", F.lit(0)).alias("copies"),
            F.coalesce("result_copies", F.lit(0)).alias("result_copies"),
            F.coalesce("missing", F.lit(0)).alias("missing"),
            "arguments",
            "needs",
            "content",
            F.coalesce("is_call", F.lit(False)).alias("is_call"),
            F.coalesce("has_result", F.lit(False)).alias("has_result"),
        )
    )

    def apart(rows: DataFrame, status: str, is_call: Column, has_result: Column) -> DataFrame:
        """Lines of events that are linked to nothing."""
        own = {"name": "string", "arguments": "string", "needs": "array<string>", "content": "string"}
        has = {c: F.col(c) if c in rows.columns else F.lit(None).cast(t) for c, t in own.items()}
        return rows.select(
            "scope",
            "conv_id",
            F.lit(None).cast("int").alias("level"),
            "position",
            "call_id",
            has["name"].alias("name"),
            F.lit(status).alias("status"),
            F.when(has_result, 0).otherwise(F.col("copies")).alias("copies"),
            F.when(has_result, F.col("copies")).otherwise(0).alias("result_copies"),
            F.lit(0).alias("missing"),
            *[has[c].alias(c) for c in ("arguments", "needs", "content")],
            is_call.alias("is_call"),
            has_result.alias("has_result"),
        )

    no, yes = F.lit(False), F.lit(True)
    is_event = F.coalesce(F.col("kind").isin("call", "result"), no)
    nameless = rows.filter(is_event & F.col("call_id").isNull())
    lines = (
        found.unionByName(apart(nameless, "no_id", F.col("kind") == "call", F.col("kind") == "result"))
        .unionByName(apart(other_calls, "conflict", yes, no))
        .unionByName(apart(other_results, "conflict", no, yes))
        .unionByName(apart(rows.filter(~is_event), "other", no, no))
    )
    names = ["conv_id", "place", "level", "position", "call_id", "name", "status", "copies", "result_copies", "missing"]
    more = ["arguments", "needs", "content", "is_call", "has_result"]
    return numbered(lines).select(*names, *more).mapInArrow(serialised(schemas), LINE)


#: The tools that from_turns() derives from plain conversations.
TURN_SCHEMAS = {
    "configure": {
        "type": "object",
        "required": ["instructions"],
        "properties": {"instructions": {"type": "string", "minLength": 1}},
        "additionalProperties": False,
    },
    "answer": {
        "type": "object",
        "required": ["question", "turn", "words"],
        "properties": {
            "question": {"type": "string", "minLength": 1},
            "turn": {"type": "integer", "minimum": 0},
            "words": {"type": "integer", "minimum": 1},
        },
        "additionalProperties": False,
    },
}


def from_turns(conversations: DataFrame) -> DataFrame:
    """One event for each row of conversations (conv_id, turn, role, text). A user's turn calls
    `answer`, which needs the user's call two turns before; a turn of the assistant or of a tool is the
    result of the user's call one turn before; a system's turn calls `configure`. Rows of another
    or no role are events of that role."""

    def call(role: str, turn: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(role), turn.cast("string"))

    turn = F.col("turn").cast("long")
    words = F.size(F.filter(F.split(F.col("text"), r"\s+"), lambda w: w != ""))
    question = F.to_json(
        F.struct(F.col("text").alias("question"), turn.alias("turn"), words.alias("words"))
    )
    setting = F.to_json(F.struct(F.col("text").alias("instructions")))
    role = F.coalesce(F.lower("role"), F.lit(""))
    user, system = role == "user", role == "system"
    result = role.isin("assistant", "tool")
    own = F.when(result, call("user", turn - 1)).when(user, call("user", turn)).when(system, call("system", turn))
    return conversations.select(
        "conv_id",
        turn.alias("position"),
        F.when(result, "result").when(user | system, "call").otherwise("other").alias("kind"),
        F.when(turn.isNotNull(), own).alias("call_id"),
        F.when(user, "answer").when(system, "configure").when(~result, F.col("role")).alias("name"),
        F.when(user, question).when(system, setting).alias("arguments"),
        F.when(user & (turn >= 2), F.array(call("user", turn - 2)))
        .otherwise(F.array().cast("array<string>"))
        .alias("needs"),
        F.when(~(user | system), F.col("text")).alias("content"),
    )
