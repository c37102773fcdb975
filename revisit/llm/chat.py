"""Reply trees as conversations: every root-to-leaf path of a tree of messages, ranked and formatted.

Paths come from iterative self-joins by doubling: table j holds each message's ancestor 2^j steps up, and is
the join of table j-1 with itself; then each leaf's path grows from the largest stride down, so d messages
deep take about 2 log2(d) joins, and rows are made in proportion to the paths' lengths. Branches of a tree
are ranked by the sum of their messages' scores, ties by the leaf's id.

A turn is written as `### <role>: <text></turn>` and a line feed. In roles and texts a backslash, `##` and
`</turn>` are broken up by backslashes (a role's colons too), so that no mark can stand inside a text, and
taking away each backslash that comes before a character gives the text back. The output holds segments;
those under the loss mask are just the assistant's texts.

Null roles and texts are empty ones. A message whose parent is null or missing is a root. A message on a
cycle has no root and is left out. Message ids are unique; for conversations given as rows by turn, repeated turns are
put in order of role and text. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisit.llm.common import materialise

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("##"), F.lit("#\\#"))
    return F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chain(turns: DataFrame) -> DataFrame:
    """Conversations given as rows by turn (conv_id, turn, role, text) as trees in which each turn answers the one before."""
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    numbered = turns.withColumn("message", F.row_number().over(order).cast("long"))
    return numbered.select(F.col("conv_id").alias("tree"), "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """tree, leaf, message, up (steps above the leaf) for each message on each root-to-leaf path.

    messages: tree, message, parent; a written table. Trees may be null, messages not.
    """
    nodes = messages.select("tree", "message", "parent")
    known = nodes.select(F.col("tree").alias("t"), F.col("message").alias("m"))
    links = nodes.filter("parent is not null").join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("m")), "left_semi")
    strides = [materialise(links.select("tree", "message", F.col("parent").alias("above")), "chat-up-0")]
    n_nodes = messages.count()
    # Longer than the table no path can be; what is left after that lies on a cycle.
    while not strides[-1].isEmpty() and 2 ** len(strides) <= n_nodes:
        a, b = strides[-1], strides[-1].select(F.col("tree").alias("t"), F.col("message").alias("m"), F.col("above").alias("further"))
        up = a.join(b, a["tree"].eqNullSafe(F.col("t")) & (F.col("above") == F.col("m"))).select("tree", "message", F.col("further").alias("above"))
        strides.append(materialise(up, f"chat-up-{len(strides)}"))
    parents = strides[0].select(F.col("tree").alias("t"), F.col("above").alias("m"))
    leaves = nodes.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("message") == F.col("m")), "left_anti")
    found = leaves.select("tree", F.col("message").alias("leaf"), "message", F.lit(0).cast("long").alias("up"))
    for j in reversed(range(len(strides))):
        step = strides[j].select(F.col("tree").alias("t"), F.col("message").alias("m"), "above")
        further = found.join(step, found["tree"].eqNullSafe(F.col("t")) & (F.col("message") == F.col("m"))).select("tree", "leaf", F.col("above").alias("message"), (F.col("up") + 2**j).alias("up"))
        found = materialise(found.unionByName(further), f"chat-path-{j}")
    return found


def formatted(messages: DataFrame, max_branches: int | None = None) -> DataFrame:
    """tree, leaf, rank (1: the best), score, n_turns, segments (text, loss) of each path.

    messages: tree, message, parent, role, text, score. max_branches keeps the best paths of each tree.
    """
    messages = materialise(messages, "chat-messages")
    steps = paths(messages)
    about = messages.select(F.col("tree").alias("t"), F.col("message").alias("m"), "role", "text", "score")
    turns = steps.join(about, steps["tree"].eqNullSafe(F.col("t")) & (F.col("message") == F.col("m")))
    role = F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit(":"), F.lit("\\:"))
    loss = F.coalesce(F.col("role") == ASSISTANT, F.lit(False))
    turn = F.array(
        F.struct(F.concat(F.lit(OPEN), role, F.lit(COLON)).alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(F.coalesce("text", F.lit(""))).alias("text"), loss.alias("loss")),
        F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
    )
    whole = turns.groupBy("tree", "leaf").agg(
        F.sum(F.coalesce("score", F.lit(0.0))).alias("score"),
        F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("place"), turn.alias("turn")))).alias("turns"),
    )
    best = Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
    out = whole.select("tree", "leaf", F.row_number().over(best).alias("rank"), "score", "n_turns", F.flatten(F.col("turns.turn")).alias("segments"))
    return out if max_branches is None else out.filter(F.col("rank") <= max_branches)


def text_of(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def parsed(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    turn = rf"(?s)^{OPEN}((?:[^\\:]|\\.)*){COLON}(.*)$"

    def one(x: Column) -> Column:
        return F.struct(unescaped(F.regexp_extract(x, turn, 1)).alias("role"), unescaped(F.regexp_extract(x, turn, 2)).alias("text"))

    pieces = F.split(text, CLOSE, -1)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), one)


def digests(conversations: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations finds. conversations: tree, segments; a written table."""
    read = conversations.select("tree", text_of(F.col("segments")).alias("whole"), F.filter("segments", lambda s: s["loss"]).alias("masked"))
    read = read.withColumn("turns", parsed(F.col("whole")))
    read = read.withColumn("trained", F.array_join(F.transform("masked", lambda s: unescaped(s["text"])), ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained"), 256).alias("loss_sha256"),
        F.length("whole").cast("long").alias("formatted_chars"),
    )
