"""A Merkle manifest of a table: subroots by source, one root, and a proof for every row.

A leaf is the hash of a row's fields.  Within a source the leaves ascend by id; every 16
consecutive nodes of a level become their hash until one remains, the subroot.  The subroots,
ordered by source, give the root the same way.

A level is one grouped aggregate: conditional aggregates spread the children of a parent
over 16 slot columns.  Their concatenation is what the parent hashes; the concatenation
without the own slot is what a child's proof needs from that level.  Going down again, a
parent's siblings are handed to its children, so what many rows share is kept once a run of
16 rows, and no row carries its proof through a shuffle.

Ranks come from a range sort by source, id, leaf and row, so neither a source, nor an id,
nor a copy that is in a third of all rows meets in one task.  Null sources come first, null
ids last; rows with equal ids stand by their leaves, and rows equal in all fields are
interchangeable.  A null id is never tampered.  An empty table has no rows and no root.
A single row is its own subroot and root, and its proof is the hash of nothing.  Columns
other than the fields are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docstrata.llm.storage import staged, workspace

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROWS_PER_TASK, _LINE_BITS = 500_000, 33
_UP = "array<struct<pre:string,post:string>>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' concatenation; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf(fields: list[Column]) -> Column:
    """A row's leaf: of each field '-' if null, else its UTF-8 byte count, ':' and its value."""
    texts = [field.cast("string") for field in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _CAPITALS, _CAPITALS.lower())


def ranked(rows: DataFrame, order: list[Column], path: str) -> DataFrame:
    """Rows with ``rank`` within ``g``, which leads the order, and ``size``, the rows of ``g``.

    Tasks sort a range of the order each; a row's rank is its place in the task's part of
    the group, moved by the group's rows in the tasks before.
    """
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // _ROWS_PER_TASK))
    line = staged(rows.repartitionByRange(tasks, "g", *order).sortWithinPartitions("g", *order).withColumn("line", F.monotonically_increasing_id()), path)
    line = line.withColumn("task", F.shiftright("line", _LINE_BITS))
    parts = line.groupBy("g", "task").agg(F.count("*").alias("n"), F.min("line").alias("first"))
    own = Window.partitionBy("g")
    before = F.sum("n").over(own.orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    shifts = parts.select("g", "task", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("size"))
    return line.join(shifts, ["g", "task"]).withColumn("rank", F.col("line") + F.col("shift")).drop("line", "task", "shift")


def _slots(name: str) -> list[Column]:
    return [F.col(f"{name}{k}") for k in range(FANOUT)]


class Tree:
    """The levels of the trees of all groups: (g, run, runs, h0 .. h15) tables, lowest first.

    ``nodes`` has g, rank, size, h and ``carried`` columns, which the lowest level spreads
    over slots as well.  Groups of one node have no level.
    """

    def __init__(self, nodes: DataFrame, folder: str, carried: tuple[str, ...] = ()):
        self.carried, self.levels = carried, []
        self.alone = nodes.where("size = 1").select("g", "h", *carried)
        level = self._above(nodes.where("size > 1"), carried)
        while True:
            self.levels.append(staged(level, f"{folder}/level-{len(self.levels)}"))
            if not (self.levels[-1].agg(F.max("runs").alias("most")).first()["most"] or 0) > 1:
                break
            above = self.levels[-1].where("runs > 1")
            level = self._above(above.select("g", F.col("run").alias("rank"), F.col("runs").alias("size"), digest(*_slots("h")).alias("h")), ())

    @staticmethod
    def _above(nodes: DataFrame, carried: tuple[str, ...]) -> DataFrame:
        slot = F.pmod("rank", F.lit(FANOUT))
        spread = [F.max(F.when(slot == k, F.col(name))).alias(f"{name}{k}") for name in ("h", *carried) for k in range(FANOUT)]
        return nodes.groupBy("g", F.shiftright("rank", 4).alias("run")).agg(F.ceil(F.max("size") / FANOUT).alias("runs"), *spread)

    def roots(self) -> DataFrame:
        """(g, top): the last node of every group."""
        tops = [level.where("runs = 1").select("g", digest(*_slots("h")).alias("top")) for level in self.levels]
        return reduce(DataFrame.unionByName, tops, self.alone.select("g", F.col("h").alias("top")))

    def lowest_runs(self, tops: DataFrame | None = None) -> DataFrame:
        """The lowest level with ``up``, the siblings on the way from its parents to the root.

        ``tops`` has g, ``up`` (the way above the group's own root) and further columns,
        which are kept; without it, nothing is above the groups' roots.
        """
        names, children, at = [c for c in tops.columns if c != "g"] if tops else ["up"], None, None
        for level in reversed(self.levels):
            rooted = level.where("runs = 1")
            at = rooted.join(tops, "g") if tops else rooted.withColumn("up", _nothing())
            if children is not None:
                at = at.unionByName(level.where("runs > 1").join(children, ["g", "run"]))
            children = _children(at, names).select("g", (F.col("run") * FANOUT + F.col("slot")).alias("run"), _joined().alias("up"), *[c for c in names if c != "up"])
        return at


def _children(at: DataFrame, kept: list[str], carried: tuple[str, ...] = ()) -> DataFrame:
    """One row for each child of a level's runs: slot, h, its siblings before and after it."""
    h = _slots("h")
    each = [
        F.when(h[k].isNotNull(), F.struct(
            F.lit(k).alias("slot"), h[k].alias("h"), F.concat_ws("", *h[:k]).alias("pre"), F.concat_ws("", *h[k + 1 :]).alias("post"), *[F.col(f"{c}{k}").alias(c) for c in carried]
        ))
        for k in range(FANOUT)
    ]
    return at.select("g", "run", *kept, F.explode(F.array_compact(F.array(*each))).alias("child")).select("g", "run", *kept, "child.*")


def _joined() -> Column:
    return F.concat(F.array(F.struct("pre", "post")), F.col("up"))


def _nothing() -> Column:
    return F.from_json(F.lit("[]"), _UP)


def siblings_text(up: Column) -> Column:
    return F.array_join(F.transform(up, lambda s: F.concat(s["pre"], s["post"])), "")


def fold(node: Column, up: Column) -> Column:
    """The root that a node and the siblings on its way give."""
    return F.aggregate(up, node, lambda h, s: digest(s["pre"], h, s["post"]))


def manifest(docs: DataFrame, *, fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id", source: str = "source", changed: dict[str, Column] | None = None, tampered: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``folded_root`` folds the row as it is now with the stored siblings: rows where
    ``tampered`` is true have the fields ``changed``, all others are as they were.
    """
    folder, changed = workspace(docs.sparkSession, "merkle"), changed or {}
    now = leaf([changed.get(name, F.col(name)) for name in fields])
    group = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("!"))  # null first, then by bytes
    rows = staged(
        docs.select(
            group.alias("g"), F.col(doc_id).alias("id"), leaf([F.col(name) for name in fields]).alias("h"),
            F.when(tampered if tampered is not None else F.lit(False), now).alias("now"), F.monotonically_increasing_id().alias("row"),
        ),
        f"{folder}/leaves",
    )
    line = ranked(rows, [F.col("id").asc_nulls_last(), F.col("h"), F.col("row")], f"{folder}/line")
    tree = Tree(line, f"{folder}/sources", ("id", "now"))
    subroots = staged(tree.roots(), f"{folder}/subroots")
    listed = ranked(subroots.select(F.lit("").alias("g"), F.col("g").alias("source"), F.col("top").alias("h")), [F.col("source")], f"{folder}/listed")
    crown = Tree(listed, f"{folder}/crown", ("source",))
    root = crown.roots().first()  # one digest
    below = _children(crown.lowest_runs(), ["up"], ("source",)).select(F.col("source").alias("g"), F.col("h").alias("subroot"), _joined().alias("up"))
    tops = staged(below.unionByName(crown.alone.select(F.col("source").alias("g"), F.col("h").alias("subroot"), _nothing().alias("up"))), f"{folder}/tops")

    shared = ["up", "above", "subroot"]
    runs = tree.lowest_runs(tops).withColumn("above", siblings_text(F.col("up")))
    leaves = _children(runs, shared, ("id", "now"))
    alone = tree.alone.join(tops, "g").select("g", F.lit(0).cast("bigint").alias("run"), "up", siblings_text(F.col("up")).alias("above"), "subroot", "h", "id", "now")
    first = F.sha2(F.concat("pre", F.coalesce("now", "h"), "post"), 256)
    every = leaves.select("g", "id", "h", "subroot", digest(F.col("pre"), F.col("post"), F.col("above")).alias("proof_sha256"), fold(first, F.col("up")).alias("folded_root")).unionByName(
        alone.select("g", "id", "h", "subroot", digest(F.col("above")).alias("proof_sha256"), fold(F.coalesce("now", "h"), F.col("up")).alias("folded_root"))
    )
    whole = F.lit(root["top"] if root else None).cast("string")
    return every.select(
        F.col("id").alias("doc_id"), F.when(F.col("g") != "!", F.substring("g", 2, 1 << 30)).alias("source"), F.col("h").alias("leaf"), "subroot", whole.alias("root"),
        "proof_sha256", "folded_root", (F.col("folded_root") == whole).alias("verified"),
    )
