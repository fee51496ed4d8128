"""Chat formatting of reply trees.

Messages (tree, message, parent, score, role, text) form trees. Self-joins
that double their reach each time give every message its depth and the score
of its path from the root; the leaves are the branches, ranked per tree by
path score. The chosen branches are walked back to the root with the same
jumps (each ancestor once, by the binary digits of its distance), and each
root-to-leaf path is formatted as one conversation. A tree of depth d takes
log2(d) joins, not d, and every join is on a message, never on a tree.

Template: a turn is ``### role: text</turn>`` and a line break. Inside roles
and texts ``\\``, ``<`` and ``#`` are written ``\\\\``, ``\\l`` and ``\\h`` (in roles also
``:`` as ``\\c``), so no marker can occur there and the escape can be undone.

Defined cases: null roles and texts count as empty; a null score counts as 0;
a null tree id is a tree of its own; a message whose parent does not exist is
a root; messages on or under a reply cycle have no root and belong to no
path; branches of equal score are ranked by the smaller leaf id; of several
rows with one (tree, message) id the first by (parent, role, text) is kept;
extra columns are ignored; empty tables give empty results. A conversation is
one output value, so its turns meet in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

TURN_START, ROLE_END, TURN_END = "### ", ": ", "</turn>\n"
#: Added to the table's conversations: control strings inside its texts.
CONTROL_CONVERSATION = -7
CONTROL_TEXT = r"\### Assistant: </turn> ok"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit("#"), F.lit("\\h"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape(text: Column) -> Column:
    """Undoes both escapes: pairs of backslashes are taken from the left first."""
    parts = F.split(text, r"\\\\")
    marks = (("\\l", "<"), ("\\h", "#"), ("\\c", ":"))
    plain = F.transform(parts, lambda p: reduce(lambda c, m: F.replace(c, F.lit(m[0]), F.lit(m[1])), marks, p))
    return F.array_join(plain, "\\")


def _jumps(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(node, depth, path_score) of every message that has a root, and the
    jump tables (node, up): table k leads 2**k messages up."""
    step = nodes.select("node", F.col("parent").alias("up"), F.lit(1).alias("depth"), F.col("score").alias("path_score"))
    size = max(1, nodes.count())
    tables: list[DataFrame] = []
    while True:
        step = saved(step, "jumps")
        jump = step.filter("up IS NOT NULL").select("node", "up")
        if 2 ** len(tables) > size or not jump.head(1):  # beyond that only cycles still lead up
            return step.filter("up IS NULL").drop("up"), tables
        tables.append(jump)
        far = step.select(
            F.col("node").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("path_score").alias("_score")
        )
        step = step.join(far, "up", "left").select(
            "node", F.col("_up").alias("up"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            (F.col("path_score") + F.coalesce("_score", F.lit(0.0))).alias("path_score"),
        )


def root_to_leaf_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(conv_id, leaf, branch_rank, depth, role, text): each message of each
    chosen path; ``branches`` best-scored leaves of a tree, or all."""
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("\0"))
    order = Window.partitionBy("tree", "msg_id").orderBy("parent_id", "role", "text")
    nodes = (
        messages.select(
            "conv_id", "msg_id", "parent_id", "role", "text", tree.alias("tree"),
            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        )
        .withColumn("_first", F.row_number().over(order)).filter("_first = 1")
        .withColumn("node", F.to_json(F.struct("tree", "msg_id")))
        .withColumn("parent", F.when(F.col("parent_id").isNotNull(), F.to_json(F.struct("tree", F.col("parent_id").alias("msg_id")))))
        .drop("_first")
    )
    nodes = saved(nodes, "messages")
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("_known"))
    linked = nodes.select("node", "parent", "score").join(known, "parent", "left")
    linked = linked.withColumn("parent", F.when(F.col("_known"), F.col("parent")))
    linked = saved(linked.select("node", "parent", "score"), "links")
    depths, tables = _jumps(linked)
    parents = linked.filter("parent IS NOT NULL").select(F.col("parent").alias("node"))
    leaves = depths.join(parents, "node", "left_anti").join(nodes.select("node", "tree", "msg_id"), "node")
    best = Window.partitionBy("tree").orderBy(F.desc("path_score"), "msg_id")
    leaves = leaves.select("*", F.row_number().over(best).alias("branch_rank"))
    if branches is not None:
        leaves = leaves.filter(F.col("branch_rank") <= branches)
    walk = leaves.select(F.col("node").alias("leaf"), "branch_rank", "depth", "node")
    for k, jump in enumerate(tables):
        up = walk.join(jump, "node").select("leaf", "branch_rank", (F.col("depth") - 2**k).alias("depth"), F.col("up").alias("node"))
        walk = saved(walk.unionByName(up), "walk")
    return walk.join(nodes.select("node", "conv_id", "role", "text"), "node").drop("node")


def format_paths(paths: DataFrame) -> DataFrame:
    """One formatted conversation per path: (conv_id, leaf, branch_rank,
    formatted, loss_mask), the mask as (start, length) spans of assistant
    text in code points of ``formatted``, counted from 0."""
    head = F.concat(F.lit(TURN_START), escape_role(F.coalesce("role", F.lit(""))), F.lit(ROLE_END))
    body = escape(F.coalesce("text", F.lit("")))
    turns = paths.select("*", head.alias("_head"), body.alias("_body"), (F.col("role") == LOSS_ROLE).alias("_loss"))
    size = F.length("_head") + F.length("_body") + F.lit(len(TURN_END))
    before = Window.partitionBy("leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("_start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("_head"))
    span = F.struct(F.col("_start").alias("start"), F.length("_body").cast("long").alias("length"), F.coalesce("_loss", F.lit(False)).alias("loss"))
    piece = F.struct("depth", F.concat("_head", "_body", F.lit(TURN_END)).alias("piece"), span.alias("span"))
    whole = turns.groupBy("leaf").agg(
        F.first("conv_id").alias("conv_id"), F.first("branch_rank").alias("branch_rank"),
        F.sort_array(F.collect_list(piece)).alias("pieces"),
    )
    marked = F.filter(F.col("pieces.span"), lambda s: s["loss"])
    return whole.select(
        "conv_id", "leaf", "branch_rank",
        F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        F.transform(marked, lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss_mask"),
    )


def parse_turns(formatted: Column) -> Column:
    """The (role, text) turns read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, TURN_END), lambda p: p != "")

    def turn(part: Column) -> Column:
        cut = F.instr(part, ROLE_END)
        start = len(TURN_START)
        role = F.substring(part, F.lit(start + 1), cut - F.lit(start + 1))
        text = F.substring(part, cut + F.lit(len(ROLE_END)), F.length(part))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def masked_text(formatted: Column, loss_mask: Column) -> Column:
    """The text under the mask, unescaped span by span."""
    spans = F.transform(loss_mask, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(spans, "")


def chain_messages(conversations: DataFrame) -> DataFrame:
    """A table of turns as messages: each turn replies to the one before it;
    repeated (conv_id, turn) rows stand one after the other by role and text."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "turn", "role", "text", F.row_number().over(w).cast("long").alias("msg_id"))
    parent = F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)
    return numbered.select("conv_id", "msg_id", parent.alias("parent_id"), F.lit(0.0).alias("score"), "role", "text")


def op8_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what is read back from the output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    types = dict(turns.dtypes)
    extra = [(0, "user"), (1, "assistant")]
    for turn, role in extra:
        turns = turns.unionByName(spark.range(1).select(
            F.lit(CONTROL_CONVERSATION).cast(types["conv_id"]).alias("conv_id"), F.lit(turn).cast(types["turn"]).alias("turn"),
            F.lit(role).alias("role"), F.lit(CONTROL_TEXT).alias("text"),
        ))
    out = format_paths(root_to_leaf_paths(chain_messages(turns)))
    read = F.transform(parse_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    out = out.select("conv_id", "formatted", F.array_join(read, "").alias("turns"), F.size(read).cast("long").alias("n_turns"),
                     masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    return out.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_SQL_ESCAPE = r"replace(replace(replace({}, '\', '\\'), '<', '\l'), '#', '\h')"
OP8_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {CONTROL_CONVERSATION}, t, r, '{CONTROL_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_SQL_ESCAPE.format("text")}) + length(replace({_SQL_ESCAPE.format("role")}, ':', '\c')) + 14) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
