"""Reply trees to chat texts, with DataFrame functions only.

Paths are found by iterative self-joins that double their reach: round k knows every node's ancestor
2**k steps up and the score of the nodes between, so a chain of any length takes its logarithm in
rounds. Only chosen branches are then enumerated, from far to near ancestors, each node once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placelytics.llm.shared import cut, require

#: What opens and closes a turn of each role; any other role is named, a null one is marked as such.
MARKS = {
    "system": ("<<SYS>> ", " <</SYS>>"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s> ", " </s>"),
}
NAMED, NAME_END, NO_NAME, END = "[ROLE] ", " [/ROLE] ", "[NULL] ", " [END]"
#: Everything of a control string but its first character, which is one of ``<`` and ``[``.
_REST = r"(</?SYS>>|/?s>|/?INST\]|/?ROLE\]|NULL\]|END\])"
#: Salts that share the branches of one tree before the final choice.
SALTS = 32


def escaped(text: Column) -> Column:
    """``text`` in which no control string occurs: each gets one more backslash behind its first character."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _REST, "$1$2$3")


def ancestors(nodes: DataFrame) -> list[DataFrame]:
    """Tables ``(tree, node, up, length, total)``: table k jumps 2**k nodes up, or to the end (null).

    ``length`` and ``total`` count the nodes jumped over and add their scores. In the last table
    every node that leads to a root has no ``up``; nodes of a cycle, or below one, keep theirs.
    """
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    tables = [
        cut(
            nodes.join(known, ["tree", "parent"], "left").select(
                "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"),
                F.lit(1).cast("long").alias("length"), F.coalesce("score", F.lit(0.0)).alias("total"),
            )
        )
    ]
    rows = tables[0].count()
    while 1 << (len(tables) - 1) <= rows and not tables[-1].where("up IS NOT NULL").isEmpty():
        last = tables[-1]
        above = last.select(
            "tree", F.col("node").alias("up"), F.col("up").alias("next"),
            F.col("length").alias("more"), F.col("total").alias("plus"),
        )
        # Nodes that have reached their root are done and take no part in the join.
        further = last.where("up IS NOT NULL").join(above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"),
            (F.col("length") + F.col("more")).alias("length"), (F.col("total") + F.col("plus")).alias("total"),
        )
        tables.append(cut(further.unionByName(last.where("up IS NULL"))))
    return tables


def best_branches(nodes: DataFrame, tables: list[DataFrame], per_tree: int = 1) -> DataFrame:
    """``(tree, branch, leaf, score)``: the root-to-leaf paths with the best mean score, best first.

    Ties go to the smaller leaf. Branches of one tree are ranked under salts first, so a tree with very
    many leaves is not sorted by one task.
    """
    inner = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = (
        tables[-1].where("up IS NULL").join(inner, ["tree", "node"], "left_anti")
        .select("tree", F.col("node").alias("leaf"), (F.col("total") / F.col("length")).alias("score"))
        .withColumn("salt", F.pmod(F.xxhash64("leaf"), F.lit(SALTS)))
    )
    order = [F.desc("score"), F.asc("leaf")]
    for keys in (["tree", "salt"], ["tree"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        leaves = leaves.withColumn("branch", rank).where(F.col("branch") <= per_tree)
    return leaves.select("tree", "branch", "leaf", "score")


def path_nodes(branches: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``(tree, branch, node)`` of every node on the chosen paths."""
    found = branches.select("tree", "branch", F.col("leaf").alias("node"))
    for table in reversed(tables):
        jump = table.where("up IS NOT NULL").select("tree", "node", "up")
        above = found.join(jump, ["tree", "node"]).select("tree", "branch", F.col("up").alias("node"))
        # Each round uses the one before twice: without a cut the plan doubles.
        found = cut(found.unionByName(above))
    return found


def formatted(turns: DataFrame, keys: list[str], at: str = "at") -> DataFrame:
    """One row per key: ``text``, and ``loss``, the code points ``(first, end)`` of assistant texts in it.

    ``turns(*keys, at, role, text)`` are in the order of ``at``; a null text is empty. The loss mask
    covers the escaped text of assistant turns and no mark. A conversation is one text, so its turns
    meet in one row, and nothing else does.
    """
    opening, closing = F.concat(F.lit(NAMED), escaped(F.col("role")), F.lit(NAME_END)), F.lit(END)
    opening = F.when(F.col("role").isNull(), NO_NAME).otherwise(opening)
    for role, (left, right) in MARKS.items():
        opening = F.when(F.col("role") == role, left).otherwise(opening)
        closing = F.when(F.col("role") == role, right).otherwise(closing)
    pieces = turns.select(
        *keys, at, (F.col("role") == "assistant").alias("own"), opening.alias("opening"),
        escaped(F.coalesce("text", F.lit(""))).alias("body"), closing.alias("closing"),
    ).withColumn("n", F.char_length("opening") + F.char_length("body") + F.char_length("closing"))
    before = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(before), F.lit(0)) + F.char_length("opening")
    spanned = pieces.select(
        *keys, at, "own", first.alias("first"), (first + F.char_length("body")).alias("end"),
        F.concat("opening", "body", "closing").alias("piece"),
    )
    parts = F.sort_array(F.collect_list(F.struct(at, "piece", "own", "first", "end")))
    return (
        spanned.groupBy(*keys)
        .agg(parts.alias("parts"))
        .select(
            *keys,
            F.array_join(F.col("parts.piece"), "").alias("text"),
            F.transform(
                F.filter("parts", lambda p: F.coalesce(p["own"], F.lit(False))),
                lambda p: F.struct(p["first"].alias("first"), p["end"].alias("end")),
            ).alias("loss"),
        )
    )


def _between(text: Column, left: Column, right: Column) -> Column:
    """``text`` without its first ``left`` and last ``right`` code points."""
    return F.substr(text, left + 1, F.char_length(text) - left - right)


def parsed(text: Column) -> Column:
    """The turns ``(role, text)`` of a formatted conversation, unescaped."""
    shapes = [f"{re.escape(left)}.*?{re.escape(right)}" for left, right in MARKS.values()]
    shapes += [f"{re.escape(NAMED)}.*?{re.escape(NAME_END)}.*?{re.escape(END)}", f"{re.escape(NO_NAME)}.*?{re.escape(END)}"]
    pattern = "(?s)" + "|".join(shapes)

    def turn(piece: Column) -> Column:
        name = F.regexp_extract(piece, f"(?s)^{re.escape(NAMED)}(.*?){re.escape(NAME_END)}", 1)
        skip = F.lit(len(NAMED) + len(NAME_END)) + F.char_length(name)
        role = F.when(F.startswith(piece, F.lit(NO_NAME)), F.lit(None)).otherwise(unescaped(name))
        body = F.when(
            F.startswith(piece, F.lit(NO_NAME)), _between(piece, F.lit(len(NO_NAME)), F.lit(len(END)))
        ).otherwise(_between(piece, skip, F.lit(len(END))))
        for known, (left, right) in MARKS.items():
            is_known = F.startswith(piece, F.lit(left))
            role = F.when(is_known, F.lit(known)).otherwise(role)
            body = F.when(is_known, _between(piece, F.lit(len(left)), F.lit(len(right)))).otherwise(body)
        return F.struct(role.alias("role"), unescaped(body).alias("text"))

    return F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), turn)


def masked(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(loss, lambda s: unescaped(F.substr(text, (s["first"] + 1).cast("int"), (s["end"] - s["first"]).cast("int")))), ""
    )


def reply_chats(
    nodes: DataFrame, *, tree: str = "tree", node: str = "node", parent: str = "parent", role: str = "role",
    text: str = "text", score: str = "score", per_tree: int = 1,
) -> DataFrame:
    """``(tree, branch, score, text, loss)``: the ``per_tree`` best root-to-leaf paths of every tree.

    A node whose parent is null or absent is a root; a tree may have several. Nodes on a cycle, or
    below one, lie on no path. Rows with a null node are ignored; of rows that repeat tree and node one stays, that with the
    greatest score, then the greatest parent, role and text. Null trees are one tree. A null score counts
    as 0 and a null text as empty. An empty table gives an empty result; other columns are ignored.
    """
    require(nodes, tree, node, parent, role, text, score)
    plain = (
        nodes.where(F.col(node).isNotNull())
        .select(
            F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("-")).alias("tree"), F.col(node).alias("node"),
            F.struct(
                F.col(score).cast("double").alias("score"), F.col(parent).alias("parent"), F.col(role).alias("role"),
                F.col(text).alias("text"), F.col(tree).alias("name"),
            ).alias("row"),
        )
        .groupBy("tree", "node")
        .agg(F.max("row").alias("row"))
        .select("tree", "node", "row.*")
    )
    plain = cut(plain)
    tables = ancestors(plain)
    branches = cut(best_branches(plain, tables, per_tree))
    depth = tables[-1].select("tree", "node", F.col("length").alias("at"))
    turns = path_nodes(branches, tables).join(plain, ["tree", "node"]).join(depth, ["tree", "node"])
    chats = formatted(turns, ["tree", "branch"])
    names = branches.join(plain.select("tree", F.col("node").alias("leaf"), "name"), ["tree", "leaf"])
    return chats.join(names, ["tree", "branch"]).select(F.col("name").alias(tree), "branch", F.col("score").alias("score"), "text", "loss")
