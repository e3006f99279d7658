"""Chat formatting of reply trees, in DataFrame operations only.

Nodes know their parent. Self-joins double what every node sees: after round k it
knows its ancestor 2**k replies up and the sums on the way, so a tree of any depth
takes the logarithm of its depth in rounds. Leaves are then ranked within their
tree by the mean score of their branch, the best are chosen, and the same jumps
enumerate the nodes of the chosen branches alone.

Turns are written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (in roles also a line
break ``&nl;``), so no control string can come from a text and every text can be
read back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import discard, stage

START, END = "<|im_start|>", "<|im_end|>"
TURN_END = END + "\n"
LEARNT_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&nl;"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def _mended(nodes: DataFrame) -> DataFrame:
    """Nodes whose parent is missing, is themselves or in another tree become roots."""
    parents = nodes.select(F.col("node").alias("parent"), F.col("tree").alias("parent_tree"))
    return nodes.join(parents, "parent", "left").withColumn(
        "parent", F.when((F.col("parent_tree") == F.col("tree")) & (F.col("parent") != F.col("node")), F.col("parent"))
    ).drop("parent_tree")


def branches(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """The ``per_tree`` best root-to-leaf paths of every tree: (tree, branch, rank, depth, node).

    ``nodes`` has node (unique, not NULL), parent (NULL at a root), tree and
    score (NULL counts 0). ``branch`` is the leaf. Branches rank by mean score, then length,
    then leaf, highest mean, longest and smallest leaf first. Nodes that only
    reach a circle have no root and are on no path.
    """
    base = stage(_mended(nodes.select("node", "parent", "tree", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))), "nodes")
    start = base.select("node", F.col("parent").alias("up"), "score", F.lit(1).cast("long").alias("length"))
    # Nodes that have reached their root take no part in later rounds, but are looked at by those below.
    jumps, done, written = [start.where("up is not null")], start.where("up is null"), [base]
    most = max(1, base.count())
    while len(jumps) <= most.bit_length() and not jumps[-1].isEmpty():
        above = jumps[-1].unionByName(done).select(
            F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"), F.col("length").alias("length2")
        )
        further = jumps[-1].join(above, "up").select(
            "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"), (F.col("length") + F.col("length2")).alias("length")
        )
        written.append(stage(further, "jumps"))
        jumps.append(written[-1].where("up is not null"))
        done = done.unionByName(written[-1].where("up is null"))
    whole = done  # what still jumps goes round in a circle
    leaves = base.join(base.select(F.col("parent").alias("node")).where("node is not null").distinct(), "node", "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("mean"), F.desc("length"), "node")
    best = (
        leaves.select("node", "tree")
        .join(whole.select("node", "length", (F.col("score") / F.col("length")).alias("mean")), "node")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= per_tree)
        .select("tree", F.col("node").alias("branch"), "rank", "length", "node", F.lit(0).cast("long").alias("up_by"))
    )
    reached = [stage(best, "reached")]
    chosen = reached[0]
    for k, jump in enumerate(jumps):
        far = chosen.join(jump.select("node", "up"), "node").select(
            "tree", "branch", "rank", "length", F.col("up").alias("node"), (F.col("up_by") + (1 << k)).alias("up_by")
        )
        reached.append(stage(far, "reached"))  # as many rows as were reached before, at most
        chosen = reduce(DataFrame.unionByName, reached)
    found = stage(chosen.select("tree", "branch", "rank", (F.col("length") - F.col("up_by")).alias("depth"), "node"), "branches")
    for table in (*written, *reached):
        discard(table)
    return found


def formatted_branches(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """One conversation per chosen branch: tree, branch, rank, formatted, mask.

    ``nodes`` also has role and text (NULL: empty). ``mask`` lists start and
    length, in code points of ``formatted`` from 0, of every text the loss covers.
    """
    path = branches(nodes, per_tree)
    said = nodes.select("node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), _escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    turn = F.struct(
        "depth",
        F.concat(head, body, F.lit(TURN_END)).alias("piece"),
        F.char_length(head).alias("head"),
        F.char_length(body).alias("body"),
        (F.col("role") == LEARNT_ROLE).alias("learnt"),
    )
    together = path.join(said, "node").groupBy("tree", "branch", "rank").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.expr(
        f"""aggregate(turns, named_struct('at', 0L, 'mask', cast(array() as array<struct<start:bigint,length:bigint>>)),
            (s, t) -> named_struct(
                'at', s.at + t.head + t.body + {len(TURN_END)},
                'mask', if(t.learnt, array_append(s.mask, named_struct('start', s.at + t.head, 'length', cast(t.body as bigint))), s.mask)),
            s -> s.mask)"""
    )
    return together.select(
        "tree", "branch", "rank", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), spans.alias("mask")
    )


def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    pieces = F.filter(F.split(formatted, F.lit(r"<\|im_end\|>\n"), -1), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            _unescaped_role(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescaped(F.substr(p, F.locate("\n", p) + 1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped."""
    return unescaped(
        F.array_join(F.transform(mask, lambda m: F.substr(formatted, (m["start"] + 1).cast("int"), m["length"].cast("int"))), "")
    )


def as_reply_tree(conversations: DataFrame) -> DataFrame:
    """Conversations by turn as trees: every row replies to the one before it.

    Turns of equal number follow by role and text, NULLs first. All rows without
    conv_id form one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    ).withColumn("n", F.row_number().over(order))
    name = lambda n: F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")), n.cast("string"))
    return rows.select(
        name(F.col("n")).alias("node"),
        F.when(F.col("n") > 1, name(F.col("n") - 1)).alias("parent"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("tree"),
        F.lit(0.0).alias("score"),
        "role",
        "text",
    )


def conversation_report(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    done = formatted_branches(stage(as_reply_tree(conversations), "replies"))
    turns = read_back(F.col("formatted"))
    read = done.select(
        F.expr("try_cast(tree as bigint)").alias("conv_id"), "formatted", turns.alias("turns"), loss_text(F.col("formatted"), F.col("mask")).alias("loss")
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
