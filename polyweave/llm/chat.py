"""Chat formatting of reply trees, with DataFrame functions only.

Iterative self-joins enumerate root-to-leaf paths: jump pointers double their reach each round, and the rows (leaf, ancestor)
double with them, so a chain of n turns takes log n rounds. Paths are ranked by the sum of their messages' scores, and each
chosen path is written as one conversation.

Template: each turn is <s>role[INST]text</s>. In roles and texts a backslash is doubled, and each control string gets a backslash
behind its first character; dropping one backslash before every character restores them. The loss mask is the place of each
assistant text in the output.

Defined results: null role and text count as empty, a null score as 0; a message whose parent is not in its tree is a root; a
cycle of replies is broken at its smallest message, which becomes a root; of rows with one tree and message the smallest
(parent, role, text, score) counts, and rows without tree or message none; equal scores are ranked by leaf. chains makes each
of a conversation's rows a turn of its own, repeated ones too; those without a conv_id are one conversation, and without a turn
they come last. An empty table gives an empty result; further columns are ignored. A conversation is one output row, so its size is bounded by what one row holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_of

#: Control strings of the template and of its kin (fixed values): <s> </s> [INST] [/INST] <<SYS>> <</SYS>>.
CONTROL_START = r"([<\[])(?=/?s>|/?INST\]|</?SYS>>)"
TURN = r"(?s)<s>(.*?)\[INST\](.*?)</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL_START, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def doubled(jumps: DataFrame) -> DataFrame:
    """Jumps (tree, node, up) of twice the reach."""
    onwards = jumps.select("tree", F.col("node").alias("middle"), "up")
    return jumps.withColumnRenamed("up", "middle").join(onwards, ["tree", "middle"]).select("tree", "node", "up")


def levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Jumps of 1, 2, 4, ... replies, as far as there are any; and the messages on cycles, which jumps never leave, if there are some."""
    known = nodes.select("tree", F.col("node").alias("parent"))
    jumps, out, longest = staged(nodes.join(known, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("up")), "jumps"), [], None
    while not jumps.isEmpty():
        if len(out) >= 6 and longest is None:
            longest = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if longest is not None and 1 << len(out) > longest:
            return out, jumps.select("tree", F.col("up").alias("node")).distinct()
        out.append(jumps)
        jumps = staged(doubled(jumps), "jumps")
    return out, None


def without_cycles(nodes: DataFrame, on_cycle: DataFrame, rounds: int) -> DataFrame:
    """nodes, with the smallest message of each cycle as a root."""
    state = staged(nodes.join(on_cycle, ["tree", "node"], "left_semi").select("tree", "node", F.col("parent").alias("up"), F.col("node").alias("low")), "cycles")
    for _ in range(rounds):
        onwards = state.select("tree", F.col("node").alias("up"), F.col("up").alias("further"), F.col("low").alias("their_low"))
        state = staged(state.join(onwards, ["tree", "up"]).select("tree", "node", F.col("further").alias("up"), F.least("low", "their_low").alias("low")), "cycles")
    smallest = state.where("node = low").select("tree", "node", F.lit(True).alias("cut"))
    return nodes.join(smallest, ["tree", "node"], "left").select("tree", "node", F.when(F.col("cut").isNull(), F.col("parent")).alias("parent"))


def paths(messages: DataFrame) -> DataFrame:
    """tree, leaf, message, distance (from the leaf) for every message on every root-to-leaf path. A message is one row of its tree."""
    nodes = messages.select("tree", F.col("message").alias("node"), "parent")
    jumps, on_cycle = levels(nodes)
    if on_cycle is not None:
        nodes = staged(without_cycles(nodes, on_cycle, len(jumps)), "cut-cycles")
        jumps, _ = levels(nodes)
    leaves = nodes.join(known_parents(nodes), (nodes["tree"] == F.col("of_tree")) & (nodes["node"] == F.col("of_node")), "left_anti")
    out = staged(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("distance")), "paths")
    for k, level in enumerate(jumps):
        further = out.join(level, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("distance") + (1 << k)).alias("distance"))
        out = staged(out.unionByName(further), "paths")
    return out.withColumnRenamed("node", "message")


def known_parents(nodes: DataFrame) -> DataFrame:
    return nodes.where("parent is not null").select(F.col("tree").alias("of_tree"), F.col("parent").alias("of_node")).distinct()


def chosen(steps: DataFrame, messages: DataFrame, branches: int) -> DataFrame:
    """tree, leaf, rank of the best branches of each tree. Best ones of salted parts first, so that no tree is sorted whole."""
    scored = steps.join(messages.select("tree", "message", "score"), ["tree", "message"]).groupBy("tree", "leaf").agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("score"))
    order = [F.col("score").desc(), F.col("leaf")]
    part = Window.partitionBy("tree", F.pmod(F.xxhash64("leaf"), F.lit(256))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= branches)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order))).where(F.col("rank") <= branches).select("tree", "leaf", "rank", "score")


def single(messages: DataFrame) -> DataFrame:
    """One row for each message of each tree."""
    own = F.min(F.struct("parent", "role", "text", "score")).alias("own")
    return messages.where("tree is not null and message is not null").groupBy("tree", "message").agg(own).select("tree", "message", "own.*")


def format_trees(messages: DataFrame, branches: int = 1, repeated: bool = True) -> DataFrame:
    """Of messages(tree, message, parent, role, text, score): tree, leaf, rank, score, formatted and loss_spans (start, length; from 0).

    repeated: rows with one tree and message may occur; without, the caller says that there are none, and null is a tree too.
    """
    if repeated:
        messages = staged(single(messages), "messages")
    # As a field, a null tree meets itself in joins.
    messages = messages.withColumn("tree", F.struct("tree"))
    steps = paths(messages)
    best = chosen(steps, messages, branches)
    said = messages.select("tree", "message", escape(text_of("role")).alias("said_role"), escape(text_of("text")).alias("said_text"), (text_of("role") == "assistant").alias("loss"))
    # Where each turn ends in the output: the marks <s>[INST]</s> around role and text are 13 characters.
    order = Window.partitionBy("tree", "leaf").orderBy(F.col("distance").desc())
    end = F.sum(F.length("said_role") + F.length("said_text") + 13).over(order)
    written = F.concat(F.lit("<s>"), F.col("said_role"), F.lit("[INST]"), F.col("said_text"), F.lit("</s>"))
    turn = F.struct((-F.col("distance")).alias("at"), written.alias("written"), "loss", (F.col("end") - 4 - F.length("said_text")).cast("int").alias("start"), F.length("said_text").alias("length"))
    talks = steps.join(best, ["tree", "leaf"]).join(said, ["tree", "message"]).withColumn("end", end).groupBy("tree", "leaf", "rank", "score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return talks.select("tree.tree", "leaf", "rank", "score", F.array_join(F.transform("turns", lambda t: t["written"]), "").alias("formatted"), spans.alias("loss_spans"))


def chains(rows: DataFrame) -> DataFrame:
    """Rows by turn as reply trees with one branch: each row replies to the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), text_of("role"), text_of("text"))
    numbered = rows.select("conv_id", "turn", "role", "text").withColumn("message", F.row_number().over(order).cast("long"))
    return numbered.select(F.col("conv_id").alias("tree"), "message", (F.col("message") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def read_back(talks: DataFrame) -> DataFrame:
    """The contract's columns, taken from the formatted text and its loss spans alone."""
    part = lambda k: F.regexp_extract_all("formatted", F.lit(TURN), F.lit(k))
    turns = F.array_join(F.zip_with(part(1), part(2), lambda r, t: F.concat(unescape(r), F.lit("\n"), unescape(t), F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return talks.select(
        F.col("tree").alias("conv_id"), F.size(part(1)).cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e as (
  select *, length(regexp_replace(role, '(\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>)', '\1_', 'g')) + 13
    + length(regexp_replace(text, '(\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>)', '\1_', 'g')) as written
  from t
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(written)::bigint as formatted_chars
from e group by conv_id
"""
