"""Chat formatting of reply trees.

Messages form trees by their parents. Iterated self-joins double the reach of
parent links and add up scores along the way, so about log2(depth) rounds give
the mean score of every branch from leaf to root; branches are ranked by it, and
each chosen one is enumerated by the same links and becomes a conversation.

Template: ``<|role|>``, line feed, text, ``<|end|>``, line feed per turn. Inside
roles and texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so control
strings stand only where the template puts them, and the text can be had back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrystone.llm.common import Query, drop_scratch, scratch_paths, stored, table

END = "<|end|>\n"
HEAD = "|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As texts, and ``|>`` becomes ``|\\>``: the first ``|>`` of a turn ends its role."""
    return F.replace(escape(role), F.lit("|>"), F.lit("|\\>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("|\\>"), F.lit("|>")))


def _renamed(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed({c: "r_" + c for c in frame.columns})


def _jumps(messages: DataFrame) -> list[DataFrame]:
    """Tables of (tree, node, above, total, steps), one per round.

    In round k ``above`` is the message 2**k links above the node, null past the
    root; ``total`` and ``steps`` are the sum of scores and the number of the
    messages from the node up to it, itself excluded. The rounds end when nobody
    has a message above, or with more links than messages: the rest goes in circles.
    """
    nodes = messages.select("tree", "node", "parent", "score")
    known = _renamed(nodes.select("tree", "node"))
    same_tree = F.col("tree").eqNullSafe(F.col("r_tree"))
    first = nodes.join(known, same_tree & (F.col("parent") == F.col("r_node")), "left")
    first = first.select("tree", "node", F.col("r_node").alias("above"), F.col("score").alias("total"), F.lit(1).cast("long").alias("steps"))
    jumps, count = [stored(first, "chat-jumps")], messages.count()
    while 2 ** (len(jumps) - 1) <= count and not jumps[-1].where("above is not null").isEmpty():
        low = jumps[-1]
        on_the_way = low.where("above is not null").join(_renamed(low), same_tree & (F.col("above") == F.col("r_node")))
        further = on_the_way.select(
            "tree", "node", F.col("r_above").alias("above"), (F.col("total") + F.col("r_total")).alias("total"), (F.col("steps") + F.col("r_steps")).alias("steps")
        )
        jumps.append(stored(low.where("above is null").unionByName(further), "chat-jumps"))
    return jumps


def branches(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, node, up): the messages of the ``best`` branches of every tree, ``up`` links above the leaf.

    ``messages`` has tree, node (one row each), parent and score. A parent that is
    null or not in the tree makes a root. Messages that lead into a circle are on
    no branch. Branches are ranked by their mean score before any is enumerated.
    """
    with scratch_paths() as made:
        jumps = _jumps(messages)
        same_tree = F.col("tree").eqNullSafe(F.col("r_tree"))
        parents = _renamed(jumps[0].where("above is not null").select("tree", "above").distinct())
        ended = jumps[-1].where("above is null")
        leaves = ended.join(parents, same_tree & (F.col("node") == F.col("r_above")), "left_anti")
        place = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("steps")), "node"))
        chosen = leaves.withColumn("place", place).where(F.col("place") <= best)
        found = stored(chosen.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "chat-branches")
        for k, jump in enumerate(jumps[:-1]):
            reach = _renamed(jump.where("above is not null").select("tree", "node", "above"))
            higher = found.join(reach, same_tree & (F.col("node") == F.col("r_node")))
            higher = higher.select("tree", "leaf", F.col("r_above").alias("node"), (F.col("up") + 2**k).alias("up"))
            found = stored(found.unionByName(higher), "chat-branches")
    drop_scratch(messages.sparkSession, made[:-1])
    return found


def format_trees(messages: DataFrame, best: int = 1, trained_role: str = "assistant") -> DataFrame:
    """The ``best`` branches of every tree as formatted conversations.

    ``messages``: tree, node, parent, role, text, score (double). Null texts and
    roles count as empty, a null score as 0; a null node takes no part, a null
    tree is a tree. Of rows with one tree and node the least one counts. Ties of
    branches go to the smaller leaf.

    Returns tree, leaf, n_turns, formatted and loss (array of start and end, in
    code points of ``formatted``, end exclusive: texts of the trained role).
    """
    fields = F.struct("parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                      F.coalesce("score", F.lit(0.0)).alias("score"))
    single = messages.where("node is not null").groupBy("tree", "node").agg(F.min(fields).alias("m"))
    return _format(single.select("tree", "node", "m.*"), best, trained_role)


def _format(messages: DataFrame, best: int, trained_role: str) -> DataFrame:
    """``format_trees`` of messages with one row per tree and node and no null role, text or score."""
    single = stored(messages, "chat-messages")
    paths = _renamed(branches(single, best))
    on = F.col("tree").eqNullSafe(F.col("r_tree")) & (F.col("node") == F.col("r_node"))
    turns = single.join(paths, on).withColumnsRenamed({"r_leaf": "leaf", "r_up": "up"})
    head, body = F.concat(F.lit("<|"), escape_role(F.col("role")), F.lit(HEAD)), escape(F.col("text"))
    turns = turns.select("tree", "leaf", "up", "role", head.alias("head"), body.alias("body"))
    size = F.length("head") + F.length("body") + len(END)
    before = F.sum(size).over(Window.partitionBy("tree", "leaf").orderBy(F.desc("up"))) - size
    start = (before + F.length("head")).alias("start")
    turns = turns.select("tree", "leaf", "up", "role", F.concat("head", "body", F.lit(END)).alias("piece"), start, F.length("body").alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "piece", "start", "n")))
    grouped = turns.groupBy("tree", "leaf").agg(F.count("*").alias("n_turns"), ordered.alias("turns"))
    spans = F.transform(
        F.filter("turns", lambda t: t["role"] == trained_role),
        lambda t: F.struct(t["start"].alias("start"), (t["start"] + t["n"]).alias("end")),
    )
    return grouped.select(
        "tree", "leaf", "n_turns", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), spans.alias("loss")
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text) from a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda p: p != "")
    cut = lambda p: F.locate(HEAD, p)

    def turn(p: Column) -> Column:
        role = F.substring(p, F.lit(3), cut(p) - 3)
        text = F.substring(p, cut(p) + len(HEAD), F.length(p))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Rows of plain conversations as trees of one branch: each turn replies to the one before; null roles and texts are empty."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    rows = conversations.select("conv_id", "turn", role, text).withColumn("node", node)
    parent = F.when(F.col("node") > 1, F.col("node") - 1).alias("parent")
    return rows.select(F.col("conv_id").alias("tree"), "node", parent, "role", "text", F.lit(0.0).alias("score"))


def digests(conversations: DataFrame) -> DataFrame:
    """What can be read back from every formatted conversation."""
    done = _format(conversation_messages(conversations), 1, "assistant")
    line = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))))
    read = done.select("tree", "formatted", line.alias("lines"), F.array_join(masked, "").alias("lost"))
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("lines").cast("long").alias("n_turns"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"),
        F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _conversations(spark, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    return given.unionByName(own)


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
e AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS body,
    replace(replace(replace(role, '\', '\\'), '<|', '<\|'), '|>', '|\>') AS head
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(head) + length(body) + 13) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

QUERIES = {"op4_chat": Query(lambda spark, sf_dir: digests(_conversations(spark, sf_dir)), SQL)}
