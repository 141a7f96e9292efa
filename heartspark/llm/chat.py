"""Chat formatting of reply trees.

Messages point to the message that they answer. Iterative self-joins double the reach of each
message's pointer (1, 2, 4, ... ancestors away) and add up the scores on the way, so a tree of
depth d takes log2(d) joins; after the last one each leaf has the score and depth of its
root-to-leaf path. Branches are ranked by score, and the chosen leaves walk the same pointers to
list the messages on their paths. Each chosen path is formatted as one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside roles and texts a backslash is
doubled, then control strings get a single backslash after their first character (a line break in
a role becomes ``<\\n>``). A single backslash between ``<`` or ``[`` and the rest of a control string
can only come from the second step, so both steps can be undone in reverse order.

Results by definition: null roles and texts are empty; messages whose parent is null or missing
are roots; of rows with the same conversation and message id the least (parent, score, role, text)
counts; rows that tie on the turn of a linear conversation are ordered by role, then text, and
each counts, repeated rows too; a null conversation id is an id like others; messages that lead
to no root (a cycle) are on no path; ties between branches go to the deeper one, then to the lower
leaf id; an empty table gives an empty result; further columns of the input are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import col, cut, pick, text_or_empty

START, END = "<|im_start|>", "<|im_end|>\n"
#: What a template could mistake for its own marks: this one's and two other common ones'.
CONTROL = r"([<\[])(\||/?INST\]|/?s>)"
ESCAPED = r"([<\[])\\(\||/?INST\]|/?s>)"


def escape(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\$2")


def unescape(c: Column) -> Column:
    return F.replace(F.regexp_replace(c, ESCAPED, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("<\\n>"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("<\\n>"), F.lit("\n")))


def linear_tree(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """Turns of plain conversations as a reply tree: each turn answers the one before it."""
    rows = pick(df, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    rows = rows.withColumn("msg_id", n)
    return rows.select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
                       "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(conv_id, leaf_id, branch, path_score, pos, role, text) of every turn of the chosen paths.

    ``messages``: conv_id, msg_id, parent_id, role, text, score. ``best`` paths of each
    conversation are kept, all by default; ``branch`` is the rank, from 1.
    """
    spark = messages.sparkSession
    rows = (messages.groupBy("conv_id", "msg_id")
            .agg(F.min(F.struct("parent_id", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"), "role", "text")).alias("x"))
            .select("conv_id", "msg_id", "x.*"))
    ids = cut(spark, rows.select("conv_id", "msg_id", "parent_id", "score"))
    c, same = F.col, lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    known = ids.select("conv_id", c("msg_id").alias("known"))
    up = cut(spark, ids.alias("u").join(known.alias("k"), same("u", "k") & (c("u.parent_id") == c("k.known")), "left")
             .select("u.conv_id", "u.msg_id", c("k.known").alias("to"), c("u.score").alias("total"), F.lit(1).cast("long").alias("steps")))
    leaves = (up.alias("u").join(up.select("conv_id", c("to").alias("answered")).distinct().alias("k"),
                                 same("u", "k") & (c("u.msg_id") == c("k.answered")), "left_anti")
              .select("conv_id", c("msg_id").alias("leaf_id")))
    most = ids.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    reach = [up]
    while (1 << (len(reach) - 1)) <= most and reach[-1].where("to is not null").limit(1).count():
        u = reach[-1]
        # Messages whose pointer has passed the root are done and take no part in further joins.
        further = u.where("to is not null").alias("u").join(u.alias("a"), same("u", "a") & (c("u.to") == c("a.msg_id"))).select(
            "u.conv_id", "u.msg_id", "a.to", (c("u.total") + c("a.total")).alias("total"), (c("u.steps") + c("a.steps")).alias("steps"))
        reach.append(cut(spark, further.unionByName(u.where("to is null"))))
    full = reach[-1].where("to is null")
    ranked = (leaves.alias("l").join(full.alias("f"), same("l", "f") & (c("l.leaf_id") == c("f.msg_id")))
              .select("l.conv_id", "l.leaf_id", c("f.total").alias("path_score"), c("f.steps").alias("depth")))
    order = Window.partitionBy("conv_id").orderBy(F.desc("path_score"), F.desc("depth"), "leaf_id")
    ranked = ranked.withColumn("branch", F.row_number().over(order))
    ranked = cut(spark, ranked if best is None else ranked.where(c("branch") <= best))
    on = ranked.withColumns({"msg_id": c("leaf_id"), "pos": c("depth")})
    for k, up_k in enumerate(reach[:-1]):
        further = (on.alias("p").join(up_k.where("to is not null").alias("a"), same("p", "a") & (c("p.msg_id") == c("a.msg_id")))
                   .select(*[c(f"p.{x}") for x in ranked.columns], c("a.to").alias("msg_id"), (c("p.pos") - (1 << k)).alias("pos")))
        on = cut(spark, on.unionByName(further))
    return (on.alias("p").join(rows.alias("r"), same("p", "r") & (c("p.msg_id") == c("r.msg_id")))
            .select("p.conv_id", "p.leaf_id", "p.branch", "p.path_score", "p.pos",
                    text_or_empty(c("r.role")).alias("role"), text_or_empty(c("r.text")).alias("text")))


def format_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, leaf_id, branch, path_score, formatted, loss_spans) of the paths in ``turns``.

    ``loss_spans``: start and end, in code points of ``formatted``, of each assistant's text.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    parts = turns.select("conv_id", "leaf_id", "branch", "path_score", "pos", (F.col("role") == "assistant").alias("loss"),
                         head.alias("head"), escape(F.col("text")).alias("body"))
    length = F.length("head") + F.length("body") + len(END)
    before = Window.partitionBy("conv_id", "leaf_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("n", length.cast("long")).withColumn(
        "start", F.coalesce(F.sum("n").over(before), F.lit(0)) + F.length("head"))
    turn = F.struct("pos", F.concat("head", "body", F.lit(END)).alias("piece"), "start",
                    (F.col("start") + F.length("body")).alias("end"), "loss")
    whole = parts.groupBy("conv_id", "leaf_id", "branch", "path_score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "conv_id", "leaf_id", "branch", "path_score", F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
        .alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    pieces = F.split(formatted, END.replace("|", r"\|"), -1)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        at = F.instr(piece, "\n")
        return F.struct(unescape_role(F.substring(piece, F.lit(len(START) + 1), at - len(START) - 1)).alias("role"),
                        unescape(F.substring(piece, at + 1, F.length(piece))).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """The text under the loss mask, unescaped span by span."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def digests(df: DataFrame) -> DataFrame:
    """What formatted conversations say when they are read back."""
    turns = df.withColumns({"turns": read_turns(F.col("formatted")), "loss": read_loss(F.col("formatted"), F.col("loss_spans"))})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
