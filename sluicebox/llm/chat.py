"""Tool calls of conversations: linked to their results, ordered, validated and written as canonical JSON.

Calls and results are aggregated to one row per identifier, so that the join of the two has unique keys on both sides.
Chains of calls are ordered by doubling pointers, calls with several dependencies by rounds that take those whose
dependencies have all been taken. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.work import stored

KEY = ["conv_id", "call_id"]

# What a call of each tool may hold: kind of each argument, and whether it is required. Kinds are string, integer,
# number, boolean, array and object.
Schema = dict[str, tuple[str, bool]]
TOOLS: dict[str, Schema] = {
    "search": {"query": ("string", True), "limit": ("integer", True), "turn": ("integer", False)},
    "summarise": {"query": ("string", True), "limit": ("integer", False), "turn": ("integer", False)},
    "translate": {"query": ("string", True), "target": ("string", True), "turn": ("integer", False)},
}

# Types of parsed JSON values that are of a kind.
_KINDS = {
    "string": "STRING",
    "integer": "BIGINT|DECIMAL[(][0-9]+,0[)]",
    "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*",
    "boolean": "BOOLEAN",
    "array": "ARRAY.*",
    "object": "OBJECT.*",
}


def _first(rows: DataFrame, count: str, *columns: str) -> DataFrame:
    """One row per key: the first in the order of the columns, and how many there are."""
    return rows.groupBy(*KEY).agg(F.min(F.struct(*columns)).alias("first"), F.count("*").alias(count)).select(*KEY, "first.*", count)


def _heads(single: DataFrame) -> DataFrame:
    """For calls with one dependency: the first call behind them that has none or several, and how far away it is.

    Pointers are doubled, so the rounds grow with the logarithm of the longest chain. What is left when a round brings
    nothing to its head runs into a cycle and is left out.
    """
    pointers = stored(single.select(*KEY, F.col("needed").alias("head"), F.lit(1).cast("long").alias("distance")), "pointers")
    known = single.select("conv_id", F.col("call_id").alias("head"))
    pending = stored(pointers.join(known, ["conv_id", "head"], "left_semi"), "pointers")
    found = stored(pointers.join(known, ["conv_id", "head"], "left_anti"), "pointers")
    left = pending.count()
    while left:
        steps = found.union(pending.select(found.columns)).select(
            "conv_id", F.col("call_id").alias("head"), F.col("head").alias("next"), F.col("distance").alias("more")
        )
        moved = pending.join(steps, ["conv_id", "head"]).select(*KEY, F.col("next").alias("head"), F.expr("distance + more").alias("distance"))
        moved = stored(moved, "pointers")
        found = stored(found.select(moved.columns).union(moved.join(known, ["conv_id", "head"], "left_anti").select(moved.columns)), "pointers")
        pending = stored(moved.join(known, ["conv_id", "head"], "left_semi"), "pointers")
        before, left = left, pending.count()
        if left == before:
            break
    return found.select(*KEY, "head", "distance")


def _without_implied(edges: DataFrame) -> DataFrame:
    """The dependencies but those that others imply, which change neither levels nor cycles.

    The latest earlier dependency of each call makes a forest. A call also depends on all that its path in there leads to,
    and a dependency on one of these says nothing new. Whether it is one is looked up by jumps that double. All links of the
    forest stay, so whatever is left out is still reached, on a longer way.
    """
    earlier = edges.where("needed_place < place").groupBy(*KEY).agg(F.max_by("needed", "needed_place").alias("needed"))
    forest = stored(earlier, "forest")
    extra = stored(edges.join(forest, [*KEY, "needed"], "left_anti").select(*KEY, "needed"), "extra")
    if extra.isEmpty():
        return edges
    depths = stored(_heads(forest), "depths")
    needed = depths.select(
        "conv_id", F.col("call_id").alias("needed"), F.col("head").alias("needed_head"), F.col("distance").alias("needed_distance")
    )
    found = extra.join(depths, KEY).join(needed, ["conv_id", "needed"], "left")
    found = found.where(F.col("head") == F.coalesce("needed_head", "needed")).select(
        *KEY, "needed", F.col("call_id").alias("at"), (F.col("distance") - F.coalesce("needed_distance", F.lit(0))).alias("steps")
    )
    found = stored(found.where("steps > 1"), "steps")
    longest = found.agg(F.max("steps")).first()[0] or 0
    above = forest.select("conv_id", F.col("call_id").alias("at"), F.col("needed").alias("above"))
    jump = 1
    while jump <= longest:
        moved = F.when(F.col("steps").bitwiseAND(F.lit(jump)) != 0, F.col("above")).otherwise(F.col("at"))
        found = stored(found.join(above, ["conv_id", "at"], "left").select(*KEY, "needed", moved.alias("at"), "steps"), "steps")
        jump *= 2
        if jump <= longest:
            further = above.select("conv_id", F.col("at").alias("above"), F.col("above").alias("further"))
            above = stored(above.join(further, ["conv_id", "above"]).select("conv_id", "at", F.col("further").alias("above")), "jumps")
    return edges.join(found.where("at = needed").select(*KEY, "needed"), [*KEY, "needed"], "left_anti")


def levels(calls: DataFrame, depends_on: str = "depends_on") -> DataFrame:
    """Each call with ``level``: 0 without dependencies, else one more than the highest of them.

    Dependencies on calls that the conversation lacks are passed over. Calls in a cycle, or behind one, have no level.
    Dependencies that others imply are left out first, by ``turn`` if there is one, and chains of calls with one dependency
    each are jumped over; rounds then go over calls with several dependencies only, as many as lie one behind another.
    Each round reads what the one before it wrote, so that plans do not grow with the rounds.
    """
    place = F.struct(*[F.col(name) for name in ("turn",) if name in calls.columns], F.col("call_id")).alias("place")
    nodes = stored(calls.select(*KEY, place), "calls")
    edges = calls.select(*KEY, place, F.explode(F.array_distinct(depends_on)).alias("needed"))
    needed = nodes.select("conv_id", F.col("call_id").alias("needed"), F.col("place").alias("needed_place"))
    edges = stored(edges.join(needed, ["conv_id", "needed"]).select(*KEY, "place", "needed", "needed_place"), "dependencies")
    edges = stored(_without_implied(edges).select(*KEY, "needed"), "dependencies")
    nodes = nodes.select(*KEY)
    counted = edges.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("needed").alias("needed"))
    heads = stored(_heads(counted.where("n = 1")), "heads")

    # Calls with several dependencies, each with the head of its chain; a call that is a head is its own.
    several = edges.join(counted.where("n > 1").select(*KEY, "n"), KEY)
    through = heads.select("conv_id", F.col("call_id").alias("needed"), "head", "distance")
    chained = counted.where("n = 1").select("conv_id", F.col("call_id").alias("needed"), F.lit(True).alias("chained"))
    several = several.join(through, ["conv_id", "needed"], "left").join(chained, ["conv_id", "needed"], "left")
    several = several.select(
        *KEY, "n", F.when(F.col("chained"), F.col("head")).otherwise(F.col("needed")).alias("head"), F.coalesce("distance", F.lit(0)).alias("distance")
    )
    several = stored(several, "several")
    # Of each call how many dependencies have a level so far, and the level these give it; it is taken when all have one.
    zero = F.lit(0).cast("long")
    met = stored(nodes.join(edges, KEY, "left_anti").select(*KEY, zero.alias("n"), zero.alias("met"), zero.alias("level")), "levels")
    rounds = [met]
    while not several.isEmpty() and not met.where("met = n").isEmpty():
        at = met.where("met = n").select("conv_id", F.col("call_id").alias("head"), "level")
        more = several.join(at, ["conv_id", "head"]).select(*KEY, "n", F.lit(1).cast("long").alias("met"), F.expr("level + distance + 1").alias("level"))
        both = met.where("met < n").unionByName(more).groupBy(*KEY, "n").agg(F.sum("met").alias("met"), F.max("level").alias("level"))
        met = stored(both, "levels")
        rounds.append(met)
    written = [path for some in rounds for path in some.inputFiles()]
    taken = calls.sparkSession.read.schema(met.schema).parquet(*written).where("met = n").select(*KEY, "level")
    at = taken.select("conv_id", F.col("call_id").alias("head"), F.col("level").alias("base"))
    chains = heads.join(at, ["conv_id", "head"]).select(*KEY, F.expr("base + distance").alias("level"))
    return nodes.join(taken.union(chains), KEY, "left").select(*KEY, F.col("level").cast("int").alias("level"))


def argument_errors(name: Column, arguments: Column, tools: dict[str, Schema]) -> Column:
    """What is wrong with parsed arguments, in the order of the names; an empty array if nothing is."""
    object_ = F.schema_of_variant(arguments).startswith("OBJECT")
    fields = F.map_keys(F.try_variant_get(arguments, "$", "map<string,variant>"))
    found = F.array(F.lit("unknown tool"))
    for tool, schema in tools.items():
        checks = []
        for field, (kind, required) in sorted(schema.items()):
            type_of = F.schema_of_variant(F.try_variant_get(arguments, f"$['{field}']", "variant"))
            missing = ~F.array_contains(fields, field)
            wrong = ~type_of.rlike(f"^({_KINDS[kind]})$")
            checks.append(
                F.when(missing, F.lit(f"{field}: missing") if required else F.lit(None)).when(
                    F.coalesce(wrong, F.lit(True)), f"{field}: not of kind {kind}"
                )
            )
        extra = F.transform(
            F.array_sort(F.array_except(fields, F.array(*[F.lit(field) for field in schema]))), lambda x: F.concat(x, F.lit(": unknown"))
        )
        found = F.when(name == tool, F.concat(F.array_compact(F.array(*checks)), extra)).otherwise(found)
    return F.when(arguments.isNull(), F.array(F.lit("not JSON"))).when(~object_, F.array(F.lit("not an object"))).otherwise(found)


def link_tool_calls(calls: DataFrame, results: DataFrame, tools: dict[str, Schema] | None = None) -> DataFrame:
    """One row per call, and per result that no call asked for.

    ``calls`` has ``conv_id``, ``call_id``, ``turn``, ``name``, ``arguments`` (JSON) and ``depends_on`` (call ids of the same
    conversation); ``results`` has ``conv_id``, ``call_id``, ``turn`` and ``content``. Ids are strings or numbers.

    ``level`` is a topological order: a call comes after all it depends on; NULL in a cycle and for results alone.
    ``status`` is ``answered``, ``unanswered``, ``early`` (the result comes before the call), ``cycle`` or ``orphan``.
    ``errors`` lists what is wrong with the arguments. ``record`` is canonical JSON: keys in order, no white space,
    without NULLs; arguments that are not JSON are kept as text. Of calls or results that share an id the first by
    turn counts, and ``n_calls`` and ``n_results`` tell how many there were. Without a conversation or call id nothing is
    linked: such calls are unanswered and have no level, such results are orphans. Other columns are ignored.
    """
    tools = TOOLS if tools is None else tools
    calls = _first(calls, "n_calls", "turn", "name", "arguments", "depends_on")
    results = _first(results, "n_results", "turn", "content").withColumnRenamed("turn", "result_turn")
    level = levels(calls.dropna(subset=KEY))
    placed = calls.join(level, KEY, "left").drop("depends_on")
    linked = placed.hint("shuffle_hash").join(results, KEY, "full_outer")
    parsed = linked.withColumn("parsed", F.try_parse_json("arguments"))
    called = F.col("n_calls").isNotNull()
    errors = F.when(called, argument_errors(F.col("name"), F.col("parsed"), tools))
    status = (
        F.when(~called, "orphan")
        .when(F.col("level").isNull() & F.col("call_id").isNotNull() & F.col("conv_id").isNotNull(), "cycle")
        .when(F.col("n_results").isNull(), "unanswered")
        .when(F.col("result_turn") < F.col("turn"), "early")
        .otherwise("answered")
    )
    return parsed.select(
        *KEY,
        "turn",
        "level",
        "name",
        status.alias("status"),
        errors.alias("errors"),
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.to_json(
            F.struct(
                F.col("parsed").alias("arguments"),
                F.when(F.col("parsed").isNull(), F.col("arguments")).alias("arguments_text"),
                F.col("call_id").alias("id"),
                "name",
                F.col("content").alias("result"),
                F.col("result_turn").alias("result_turn"),
                "turn",
            )
        ).alias("record"),
    )


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results derived from plain conversations, which have none.

    A user's message is a call and the assistant's message in the next turn its result. A call depends on the user's
    call two turns earlier; in some conversations on the one four turns earlier too, and in some the first call depends on
    the third, which makes a cycle where there is one. Remainders of lengths and ids choose the tool and give some calls
    the defects that validation looks for. Messages of all other roles are results that no call asked for, one each.
    """
    turn = F.col("turn")
    length = F.coalesce(F.length("text"), F.lit(0))
    call_id = F.concat_ws("_", F.lit("call"), "conv_id", "turn")
    name = F.when(length % 3 == 0, "search").when(length % 3 == 1, "summarise").otherwise("translate")
    limit = F.when(F.col("conv_id") % 11 == 3, F.lit('"many"')).otherwise(length.cast("string"))
    query = F.regexp_replace(F.to_json(F.array(F.coalesce("text", F.lit("")))), r"^\[|\]$", "")
    # The keys are out of order, and the JSON of some conversations is cut off.
    pairs = F.concat_ws(
        ", ",
        F.concat(F.lit('"turn": '), turn.cast("string")),
        F.when(length % 7 != 6, F.concat(F.lit('"query": '), query)),
        F.when(name == "translate", F.lit('"target": "en"')).otherwise(F.concat(F.lit('"limit": '), limit)),
    )
    whole = F.concat(F.lit("{"), pairs, F.when(F.col("conv_id") % 13 == 5, "").otherwise("}"))

    def call_at(distance: int) -> Column:
        return F.concat_ws("_", F.lit("call"), "conv_id", turn + distance)

    users = conversations.where("role = 'user'")
    calls = users.select(
        "conv_id",
        call_id.alias("call_id"),
        "turn",
        name.alias("name"),
        whole.alias("arguments"),
        F.array_compact(
            F.array(
                call_at(-2),
                F.when(F.col("conv_id") % 7 == 2, call_at(-4)),
                F.when((F.col("conv_id") % 17 == 4) & (turn < 2), call_at(4)),
            )
        ).alias("depends_on"),
    )
    answers = conversations.where("role = 'assistant'")
    results = answers.select(
        "conv_id", F.concat_ws("_", F.lit("call"), "conv_id", turn - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    other = conversations.where(~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False)))
    notes = other.select("conv_id", F.concat_ws("_", F.lit("note"), "conv_id", "turn").alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results.union(notes)
