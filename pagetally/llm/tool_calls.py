"""Tool calls of conversations: linked with their results, ordered, validated, serialised.

Everything here is a DataFrame operation. Calls and results are brought to one row per identifier
before they are hash-joined, so an identifier that very many rows share is no hot key. The order
follows what a call says it comes after. Where that is one call, the distance looked back doubles
each round; calls after several are forks, and what lies between forks is contracted to one step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from pagetally.llm.common import only_last, stored

KEY = ("conv_id", "call_id")


@dataclass(frozen=True)
class Parameter:
    """kind is string, integer, number, boolean, object or array; choices limit a string."""

    kind: str
    required: bool = True
    choices: tuple[str, ...] = ()


Schemas = dict[str, dict[str, Parameter]]

#: How the type of a JSON value is written, as a pattern.
KINDS = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DOUBLE|DECIMAL.*",
    "boolean": "BOOLEAN",
    "object": "OBJECT.*",
    "array": "ARRAY.*",
}


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def problems(schemas: Schemas) -> Column:
    """What is wrong with the arguments of a call, as sorted texts: unknown_tool, bad_json (not
    JSON, or a key twice), not_an_object, missing:x, type:x, choice:x, unexpected:x. The column
    `parsed` holds the arguments as a variant; null is as good as missing."""
    found = []
    for tool, parameters in schemas.items():
        for name, p in parameters.items():
            path = "$[\"" + _quoted(name).replace('"', '\\"') + "\"]"
            value = F.expr(f"try_variant_get(parsed, '{path}', 'variant')")
            kind = F.schema_of_variant(value)
            absent = kind.isNull() | (kind == "VOID")
            text = F.expr(f"try_variant_get(parsed, '{path}', 'string')")
            checks = F.when(absent, F.lit(f"missing:{name}" if p.required else None))
            checks = checks.when(~kind.rlike(f"^({KINDS[p.kind]})$"), f"type:{name}")
            if p.choices:
                checks = checks.when(~text.isin(*p.choices), f"choice:{name}")
            found.append(F.when(F.col("name") == tool, checks))
    allowed = F.create_map(
        *[x for t, ps in schemas.items() for x in (F.lit(t), F.array(*map(F.lit, ps)))]
    )
    others = F.array_except(F.json_object_keys("arguments"), allowed[F.col("name")])
    extra = F.transform(others, lambda k: F.concat(F.lit("unexpected:"), k))
    listed = F.concat(F.array_compact(F.array(*found)), F.coalesce(extra, F.array().cast("array<string>")))
    unknown = ~F.coalesce(F.col("name").isin(*schemas), F.lit(False))
    return (
        F.when(unknown, F.array(F.lit("unknown_tool")))
        .when(F.col("parsed").isNull(), F.array(F.lit("bad_json")))
        .when(~F.schema_of_variant("parsed").startswith("OBJECT"), F.array(F.lit("not_an_object")))
        .otherwise(F.array_sort(listed))
    )


def _first(rows: DataFrame, columns: list[str], count: str) -> DataFrame:
    """One row per identifier: the one of the smallest turn, and how many there are. Rows without
    an identifier are left to the caller."""
    known = rows.where("conv_id is not null and call_id is not null")
    picked = known.groupBy(*KEY).agg(F.min(F.struct("turn", *columns)).alias("x"), F.count("*").alias(count))
    return picked.select(*KEY, "x.*", count)


def _followed(nodes: DataFrame, edges: DataFrame, trail: list[str]) -> DataFrame:
    """The ways back of nodes (least) over edges (before, add) among them, each to the first fork,
    a node of several edges: fork, to, add, least and moving. The level is at least `least`, and
    that of `to`, if any, and `add`. Ways that are still moving lead into circles."""
    own = edges.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("before").alias("to"), F.max("add").alias("add"))
    n = F.coalesce("n", F.lit(0))
    state = nodes.join(own, [*KEY], "left").select(
        *KEY,
        (n > 1).alias("fork"),
        F.when(n == 1, F.col("to")).alias("to"),
        F.when(n == 1, F.col("add")).alias("add"),
        "least",
        (n == 1).alias("moving"),
    )
    state, before = stored(state, "levels", trail), None
    while (left := state.where("moving").count()) not in (0, before):
        before = left
        # Rows that stay meet themselves, so that null is no hot key.
        to = state.withColumn("at", F.coalesce("to", "call_id")).join(_ahead(state), ["conv_id", "at"])
        hop = F.col("moving") & ~F.col("fork_at")
        state = to.select(
            *KEY,
            "fork",
            F.when(hop, F.col("to_at")).otherwise(F.col("to")).alias("to"),
            F.when(hop, F.col("add") + F.col("add_at")).otherwise(F.col("add")).alias("add"),
            F.when(hop, F.greatest("least", F.col("add") + F.col("least_at"))).otherwise(F.col("least")).alias("least"),
            (hop & F.col("moving_at")).alias("moving"),
        )
        state = stored(state, "levels", trail)
        only_last(nodes.sparkSession, trail)
    return state


def _ahead(state: DataFrame) -> DataFrame:
    others = [F.col(c).alias(f"{c}_at") for c in ("fork", "to", "add", "least", "moving")]
    return state.select("conv_id", F.col("call_id").alias("at"), *others)


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id and level of calls (conv_id, call_id, after), after being a list: 0 for a
    call that comes after none that is there, else one more than the greatest level of these, so
    the longest way; null if a way leads into a circle.

    Forks whose ways meet again at one fork are no forks in the next round. The rounds are as many
    as forks are nested without meeting, and each takes only the forks that are left.
    """
    spark, trails = calls.sparkSession, []
    there = calls.select("conv_id", F.col("call_id").alias("before"))
    pairs = calls.select(*KEY, F.explode(F.array_distinct("after")).alias("before")).join(there, ["conv_id", "before"])
    nodes = calls.select(*KEY, F.lit(0).cast("long").alias("least"))
    edges = stored(pairs.select(*KEY, "before", F.lit(1).cast("long").alias("add")), "after", helpers := [])
    layers, before = [], None
    while True:
        trails.append([])
        state = _followed(nodes, edges, trails[-1])
        layers.append(state)
        forks = state.where("fork")
        if (left := forks.count()) in (0, before):  # all that is left comes after circles
            break
        before = left
        ends = edges.join(forks.select(*KEY), [*KEY], "left_semi").withColumnRenamed("before", "at")
        ends = ends.join(_ahead(state), ["conv_id", "at"])
        stays = F.col("fork_at") | F.col("moving_at")
        # An edge into a circle becomes one of its own: the fork never gets a level.
        end = F.when(F.col("fork_at"), F.col("at")).when(F.col("moving_at"), F.col("call_id")).otherwise(F.col("to_at"))
        ends = ends.select(
            *KEY,
            end.alias("before"),
            F.when(stays, F.col("add")).otherwise(F.col("add") + F.col("add_at")).alias("add"),
            F.when(~stays, F.col("add") + F.col("least_at")).alias("gain"),
        )
        met = stored(ends.groupBy(*KEY, "before").agg(F.max("add").alias("add"), F.max("gain").alias("gain")), "after", helpers)
        only_last(spark, helpers)
        edges = met.where("before is not null").drop("gain")
        gains = met.groupBy(*KEY).agg(F.max("gain").alias("gain"))
        nodes = forks.select(*KEY, "least").join(gains, [*KEY]).select(*KEY, F.greatest("least", "gain").alias("least"))
    found = layers.pop()
    found = found.select(*KEY, F.when(F.col("to").isNull() & ~F.col("fork"), F.col("least")).alias("level"))
    named: list[str] = []
    for state in reversed(layers):
        known = found.select("conv_id", F.col("call_id").alias("at"), F.col("level").alias("level_at"))
        rows = state.where("not fork").withColumn("at", F.coalesce("to", "call_id")).join(known, ["conv_id", "at"], "left")
        level = F.when(F.col("to").isNull(), F.col("least")).when(
            F.col("level_at").isNotNull(), F.greatest("least", F.col("add") + F.col("level_at"))
        )
        found = stored(found.unionByName(rows.select(*KEY, level.alias("level"))), "levels", named)
        only_last(spark, named)
    return found


def listed(calls: DataFrame) -> DataFrame:
    """The calls with `after` as a list; a single identifier is a list of one."""
    if isinstance(calls.schema["after"].dataType, ArrayType):
        return calls.withColumn("after", F.col("after").cast("array<string>"))
    return calls.withColumn("after", F.array(F.col("after").cast("string")))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """Linked calls: conv_id, call_id, turn, level, status, problems, n_calls, n_results, message.

    calls are (conv_id, call_id, turn, name, arguments, after), arguments being JSON and after the
    call_id it comes after, or a list of such, or null; results are (conv_id, call_id, turn,
    content). All columns may be null, in lists too, others are not read. There is a row per identifier: of several calls or results with
    it the first by turn counts, and n_calls and n_results tell their number. Rows without conv_id
    or call_id are linked with nothing and stay as they are, a row each.

    status is `linked`, `no_result`, `no_call`, `early_result` (the result stands before its call),
    `circle` or `no_id`. message is canonical JSON: keys in order at every depth, no blanks, null
    keys left out; arguments that are no JSON stand there as text. Rows sorted by (conv_id, level,
    turn, call_id) are in topological order, rows of no level last.
    """
    calls = listed(calls.select("conv_id", "call_id", "turn", "name", "arguments", "after"))
    results = results.select("conv_id", "call_id", "turn", "content")
    called = stored(_first(calls, ["name", "arguments", "after"], "n_calls"), "calls")
    answered = _first(results, ["content"], "n_results").withColumnRenamed("turn", "answer_turn")
    ordered = called.join(levels(called), [*KEY], "left")
    both = ordered.join(answered.hint("shuffle_hash"), [*KEY], "full_outer")
    status = (
        F.when(F.col("n_calls").isNull(), "no_call")
        .when(F.col("level").isNull(), "circle")
        .when(F.col("n_results").isNull(), "no_result")
        .when(F.col("answer_turn") < F.col("turn"), "early_result")
        .otherwise("linked")
    )
    rows = both.withColumn("status", status).withColumn("turn", F.coalesce("turn", "answer_turn"))
    rows = rows.drop("answer_turn", "after")
    loose = "conv_id is null or call_id is null"
    one = F.lit(1).cast("long")
    calls_alone = calls.where(loose).drop("after").withColumns({"n_calls": one, "status": F.lit("no_id")})
    results_alone = results.where(loose).withColumns({"n_results": one, "status": F.lit("no_id")})
    for alone in (calls_alone, results_alone):
        rows = rows.unionByName(alone, allowMissingColumns=True)
    rows = rows.withColumn("parsed", F.try_parse_json("arguments"))
    is_call = F.col("n_calls").isNotNull()
    rows = rows.withColumn("problems", F.when(is_call, problems(schemas)).otherwise(F.array().cast("array<string>")))
    readable = F.col("parsed").isNotNull()
    fields = {
        "arguments": F.when(readable, F.col("parsed")),
        "arguments_text": F.when(~readable, F.col("arguments")),
        "call_id": F.col("call_id"),
        "conv_id": F.col("conv_id"),
        "name": F.col("name"),
        "problems": F.when(F.size("problems") > 0, F.col("problems")),
        "result": F.col("content"),
        "status": F.col("status"),
    }
    message = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select(
        *KEY, "turn", "level", "status", "problems", n("n_calls"), n("n_results"), message.alias("message")
    )


# --- calls derived from plain conversations ----------------------------------------------------

TOOLS: Schemas = {
    "search": {"query": Parameter("string"), "limit": Parameter("integer")},
    "translate": {
        "text": Parameter("string"),
        "target": Parameter("string", choices=("de", "en", "es", "fr")),
    },
    "count_words": {"text": Parameter("string"), "options": Parameter("object", required=False)},
}


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every user message as a call that comes after the user message two turns before, every third
    also after the one six turns before, and every assistant message as the result of the message
    before it. Arguments vary with the turn and
    the length of the text; some break their schema, keys are in no order."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    size, kind = F.length("text"), F.expr("pmod(turn div 2, 3)")
    limit = F.pmod(size, F.lit(20)) + 1
    json = lambda **fields: F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    text = F.col("text")
    target = F.element_at(F.array(*map(F.lit, ("en", "de", "fr", "es", "xx"))), F.pmod(size, F.lit(5)) + 1)
    options = F.struct(F.lit(True).alias("unique"), F.pmod(size, F.lit(3)).alias("least"))
    arguments = (
        F.when((kind == 0) & (F.pmod(size, F.lit(7)) == 0), json(query=text, limit=limit.cast("string")))
        .when(kind == 0, json(query=text, limit=limit))
        .when(kind == 1, json(text=text, target=target))
        .when(F.pmod(size, F.lit(11)) == 0, json(options=options, lang=F.lit("en")))
        .otherwise(json(text=text, options=options))
    )
    name = F.element_at(F.array(*map(F.lit, TOOLS)), (kind + 1).cast("int"))
    at = lambda turn: F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    turn = F.col("turn")
    after = F.when(kind == 2, F.array(at(turn - 2), at(turn - 6))).otherwise(F.array(at(turn - 2)))
    calls = rows.where("role = 'user'").select(
        "conv_id", at(turn).alias("call_id"), "turn", name.alias("name"), arguments.alias("arguments"), after.alias("after")
    )
    results = rows.where("role = 'assistant'").select(
        "conv_id", at(turn - 1).alias("call_id"), "turn", text.alias("content")
    )
    return calls, results
