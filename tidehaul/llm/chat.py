"""Chat formatting by event-sourced reconstruction, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The marks of the template, and the strings that may not stand in a text as they are.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|<SYS>>|</?SYS>>)"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|<SYS>>|</?SYS>>)"


def escape(text: Column) -> Column:
    """``text`` with a backslash after the first character of whatever looks like a control string, escaped or not."""
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def reconstruct(events: DataFrame) -> DataFrame:
    """(conv_id, turns): the final messages of each log, ``turns`` an array of (role, text) in turn order.

    ``events`` has conv_id, seq, kind, turn, role, text. Within a conversation,
    by ``seq``: ``message`` states a turn; ``delta`` adds text to it; ``edit``
    states it anew and ``regenerate`` empties it (its text, if any, is the new
    start), and both void all later turns so far. A statement voids what its
    turn held before. The role of a turn is its last known one. So an event
    stays if no later statement of its turn and no later edit or regeneration
    of an earlier turn follows, and no fold over rows is needed.

    NULL text is empty, NULL roles are left out (none known: empty), a NULL
    kind is a message. Events with equal ``seq`` are taken in the order of
    kind, role and text, repeated ones each by themselves. A NULL conv_id is a
    conversation. All work is within one shuffle by conversation; the result
    has a conversation in a row, so one conversation has to fit in a row.
    """
    e = events.select(
        "conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "turn", "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    states = F.col("kind").isin("message", "edit", "regenerate")
    branches = F.col("kind").isin("edit", "regenerate")
    turn = Window.partitionBy("conv_id", "turn")
    earlier = Window.partitionBy("conv_id").orderBy(F.struct("turn")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = Window.partitionBy("conv_id").orderBy(
        F.col("seq").asc_nulls_first(), "kind", F.col("role").asc_nulls_first(), "text"
    )
    e = e.withColumn("_at", F.row_number().over(placed))
    e = e.withColumn("_stated", F.max(F.when(states, F.col("_at"))).over(turn))
    e = e.withColumn("_branch", F.max(F.when(branches, F.col("_at"))).over(turn))
    # The last branch at this turn or an earlier one: at this turn it is a statement, too.
    e = e.withColumn("_void", F.max("_branch").over(earlier))
    alive = e.where(
        (F.col("_at") >= F.coalesce("_stated", F.lit(0))) & (F.col("_at") >= F.coalesce("_void", F.lit(0)))
    )
    per_turn = alive.groupBy("conv_id", "turn").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("_at"))).alias("role"),
        F.array_sort(F.collect_list(F.struct("_at", "text"))).alias("parts"),
    )
    said = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    message = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), said.alias("text"))
    return (
        per_turn.select("conv_id", message.alias("m"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("m")).alias("turns"))
        .select("conv_id", F.transform("turns", lambda m: F.struct(m["role"], m["text"])).alias("turns"))
    )


def render(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the text with its marks, and the spans that a model is trained on.

    A turn is ``<|im_start|>role\\ntext<|im_end|>\\n`` with the text escaped
    and the role percent-encoded. ``loss`` holds (start, length) in code points
    of the escaped text of each assistant turn.
    """
    head = lambda m: F.concat(F.lit(OPEN), F.url_encode(m["role"]), F.lit("\n"))
    pieces = F.transform(
        "turns",
        lambda m: F.struct(head(m).alias("head"), escape(m["text"]).alias("body"), (m["role"] == "assistant").alias("loss")),
    )
    sized = conversations.select("conv_id", pieces.alias("p")).select(
        "conv_id", "p",
        F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "").alias("formatted"),
    )
    step = F.aggregate(
        "p",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["head"]) + F.length(x["body"]) + len(CLOSE)).alias("at"),
            F.when(
                x["loss"],
                F.concat(
                    a["spans"],
                    F.array(
                        F.struct((a["at"] + F.length(x["head"])).alias("start"), F.length(x["body"]).alias("length"))
                    ),
                ),
            )
            .otherwise(a["spans"])
            .alias("spans"),
        ),
    )
    return sized.select("conv_id", "formatted", step["spans"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, learned): what a formatted text says, and the text under its loss spans."""
    parts = F.split("formatted", F.lit(CLOSE.replace("|", r"\|")))
    turns = F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda p: F.struct(
            F.url_decode(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
        ),
    )
    learned = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(learned, "").alias("learned"))


def chat_format(conversations: DataFrame) -> DataFrame:
    """``op8``: the table's rows as a log of messages, and one conversation more, formatted and read back.

    Rows of a conversation are numbered by turn (equal turns by role and text),
    so repeated rows are messages of their own.
    """
    spark = conversations.sparkSession
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(F.array(F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")),
                          F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")))).alias("m"),
    ).select("conv_id", "m.turn", "m.role", F.lit(probe).alias("text"))
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    events = rows.withColumn("seq", F.row_number().over(order)).select(
        "conv_id", "seq", F.lit("message").alias("kind"), F.col("seq").alias("turn"), "role", "text"
    )
    said = read_back(render(reconstruct(events)))
    lines = F.transform("turns", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n")))
    return said.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def oracle() -> str:
    """The same digests in SQL, straight from the rows and without reading back."""
    escaped = f"regexp_replace(text, '{CONTROL}', '\\1\\\\\\2\\3', 'g')"
    probe = "'</s>[INST] ok [/INST]'"
    rows = (
        "SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations "
        f"UNION ALL SELECT -1, 0, 'user', {probe} UNION ALL SELECT -1, 1, 'assistant', {probe}"
    )
    learned = "coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')"
    return (
        "SELECT conv_id, count(*) AS n_turns, "
        "sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256, "
        f"length({learned}) AS loss_chars, sha256({learned}) AS loss_sha256, "
        f"CAST(sum({len(OPEN) + 1 + len(CLOSE)} + length(role) + length({escaped})) AS BIGINT) AS formatted_chars "
        f"FROM ({rows}) GROUP BY conv_id"
    )
