"""Merkle manifest of a dataset: nested-interval labels.

A row's leaf is the SHA-256 of its fields. The leaves of a group (a language),
in the order of their ids, have the ranks 0, 1, 2, ...; every node above them is
labelled with the interval of ranks that it covers, [lo, hi). While a level of
a group has several nodes, each ``FAN`` consecutive ones become one node above
them; the last one left is the group's root, and the groups' roots, in the
order of their names, become the dataset's root in the same way.

Proofs come down the levels. The nodes of a level meet their ancestors' part of
the proof in a containment join: both are bucketed by the ranks that a node of the upper
level covers, and the child's interval must lie inside the parent's. What the
parent's interval has besides the child's are its siblings, left and right of it.
A parent meets ``FAN`` children at most, so no key is hot, and a level has an
eighth of the rows of the one below: the rows that are shuffled add up to little
more than the leaves.

Built-in functions throughout; each level is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import checkpointed

#: Children of a node.
FAN = 8
#: Up to so many groups, their first ranks and sizes (a name and two numbers each) are broadcast.
FEW_GROUPS = 10_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def leaf(values: list[Column]) -> Column:
    """SHA-256, as lower-case hex, of the values one after the other: ``-`` for a null, else its length in UTF-8 bytes, a colon and itself."""

    def told(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.sha2(F.concat(*map(told, values)), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (with a column ``g``, by which ``order`` starts) with rank, from 0 inside each g, and n, the size of g.

    A range sort; a range may split a g and also rows that are alike. One number
    a partition is summed up in one place, and one row a g is joined.
    """
    placed = checkpointed(rows).withColumn("place", F.monotonically_increasing_id())  # the range sort reads its rows twice
    keys = [*order, F.col("place")]
    stored = checkpointed(placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("place")).withColumn("at", F.monotonically_increasing_id())
    part, position = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    stored = stored.withColumn("part", part).withColumn("position", position).drop("at")
    sizes = stored.groupBy("part", "g").agg(F.count(F.lit(1)).alias("m"), F.min("position").alias("first"))
    sizes = checkpointed(sizes)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("m").alias("m")).select("part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"))
    firsts = sizes.join(F.broadcast(parts), "part").groupBy("g").agg(F.min(F.col("before") + F.col("first")).alias("first"), F.sum("m").alias("n"))
    firsts = checkpointed(firsts.withColumnRenamed("g", "h"))
    if firsts.count() <= FEW_GROUPS:
        firsts = F.broadcast(firsts)
    there = stored.join(F.broadcast(parts), "part").join(firsts, F.col("g").eqNullSafe(F.col("h")))
    return there.withColumn("rank", F.col("before") + F.col("position") - F.col("first")).select(*rows.columns, "rank", "n")


def levels(leaves: DataFrame, kept: list[str]) -> list[DataFrame]:
    """The nodes of each level above the leaves, lowest first, until all groups have one node.

    leaves: g, rank, n, digest and the columns ``kept``. A node: g, lo, hi, n
    (leaves of its group), digest, hashed (false where it is the one node of
    the level below), members: its children's lo, hi and digest, and ``kept``.
    """
    out: list[DataFrame] = []
    below = leaves.select("g", "n", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", *kept)
    top = leaves.agg(F.max("n")).first()[0] or 0
    width = 1
    while not out or width < top:
        member = F.struct("lo", "hi", "digest", *(kept if not out else []))
        runs = below.groupBy("g", F.floor(F.col("lo") / (width * FAN)).alias("run")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(member)).alias("members"))
        hashed = F.col("n") > width
        digest = F.when(hashed, F.sha2(_joined(F.col("members.digest")), 256)).otherwise(F.get("members", F.lit(0))["digest"])
        runs = runs.select("g", "n", F.get("members", F.lit(0))["lo"].alias("lo"), F.element_at("members", -1)["hi"].alias("hi"), digest.alias("digest"), hashed.alias("hashed"), "members")
        out.append(checkpointed(runs))
        below = out[-1]
        width *= FAN
    return out


def members_with_paths(nodes: DataFrame) -> DataFrame:
    """Of nodes with the ``path`` above them, each member (g, child) with its own: its siblings, by interval difference, come first."""
    child = F.col("child")
    one = nodes.select("g", "hashed", "path", "members", F.explode("members").alias("child"))
    before = F.filter("members", lambda m: m["hi"] <= child["lo"])
    after = F.filter("members", lambda m: m["lo"] >= child["hi"])
    step = F.array(F.struct(_joined(before["digest"]).alias("before"), _joined(after["digest"]).alias("after")))
    return one.select("g", "child", F.when(F.col("hashed"), F.concat(step, "path")).otherwise(F.col("path")).alias("path"))


def attached(nodes: DataFrame, above: DataFrame, width: int) -> DataFrame:
    """``nodes`` of a level, which cover up to ``width`` ranks, with the paths of the members of the level above that contain them."""
    up = above.select(F.col("g").alias("h"), F.col("child.lo").alias("from"), F.col("child.hi").alias("to"), F.floor(F.col("child.lo") / width).alias("b"), "path")
    inside = (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
    return nodes.join(up, F.col("g").eqNullSafe(F.col("h")) & (F.floor(F.col("lo") / width) == F.col("b")) & inside).select("g", "hashed", "members", "path")


def _down(tree: list[DataFrame], top: DataFrame) -> DataFrame:
    """Paths of the leaves, given the nodes of the highest level with theirs."""
    nodes = top
    for k in range(len(tree) - 1, 0, -1):
        nodes = attached(tree[k - 1], members_with_paths(nodes), FAN**k)
    return members_with_paths(nodes)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and the siblings along its path give."""
    return F.aggregate(path, digest, lambda h, p: F.sha2(F.concat(p["before"], h, p["after"]), 256))


def manifest(df: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", tampered: Column | None = None) -> DataFrame:
    """Per row: doc_id, g (its group), lo and hi (its interval), leaf, subroot, root, proof (siblings from its run up to the root), given (the leaf that is put to the test), folded_root, verified.

    ``tampered``: the rows whose text is put to the test with A-Z lower-cased;
    their original leaves and siblings make the tree all the same.

    Rows with the same id follow each other by leaf; null ids come last in
    their group. A null group is a group of its own, the first one. Null, empty
    and long fields are taken whole as they are. Rows that are alike are leaves
    of their own; which comes first is open, and their digests are the same. An
    empty table gives no rows; columns other than the fields aren't looked at.
    A group of one leaf has it as its root, a dataset of one group that group's.
    """
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    values = [F.col(c) for c in fields]
    other = [lower_ascii(F.col(c)) if c == text_col else F.col(c) for c in fields]
    rows = df.select(F.col(group_col).cast("string").alias("g"), F.col(id_col).cast("long").alias("doc_id"), leaf(values).alias("digest"), F.when(changed, leaf(other)).alias("given"))
    rows = ranked(rows, [F.col("g").asc_nulls_first(), F.col("doc_id").asc_nulls_last(), F.col("digest")])
    tree = levels(rows, ["doc_id", "given"])

    # the groups' roots are the leaves of one more tree
    subroots = tree[-1].select(F.lit(0).alias("g"), F.col("g").alias("name"), "digest")
    groups = ranked(subroots, [F.col("g"), F.col("name").asc_nulls_first()])
    above = levels(groups, ["name"])
    none = F.array().cast(_PATH)
    paths = _down(above, above[-1].select("g", "hashed", "members", none.alias("path")))
    root = above[-1].select(F.col("digest").alias("root"))
    tops = paths.crossJoin(F.broadcast(root)).select(F.col("child.name").alias("h"), F.col("child.digest").alias("subroot"), "root", "path")  # one row
    tops = checkpointed(tops)
    if tops.count() <= FEW_GROUPS:
        tops = F.broadcast(tops)
    top = tree[-1].join(tops.select("h", "path"), F.col("g").eqNullSafe(F.col("h"))).select("g", "hashed", "members", "path")
    leaves = _down(tree, top).join(tops.select("h", "subroot", "root"), F.col("g").eqNullSafe(F.col("h")))
    child, path = F.col("child"), F.col("path")
    proof = _joined(F.transform(path, lambda p: F.concat(p["before"], p["after"])))
    given = F.coalesce(child["given"], child["digest"])
    out = leaves.select(child["doc_id"].alias("doc_id"), "g", child["lo"].alias("lo"), child["hi"].alias("hi"), child["digest"].alias("leaf"), "subroot", "root", proof.alias("proof"), given.alias("given"), fold(given, path).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
