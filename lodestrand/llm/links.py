"""From bucket keys to connected classes: candidate pairs that grow with the rows, not with the square of a group.

In every bucket (nodes that share a key) each node is paired with the bucket's leader and with the two nodes before
it, which covers all pairs of buckets of up to four. The order is by how many nodes a node meets in all its buckets: among
the variants of a text those with the fewest edits meet most, and they are similar to most others. The verified pairs give
classes. A larger bucket that still holds nodes of different classes (lines that share a phrase or a passage and nothing
else) is dealt anew: either the operator names the pairs that can hold by bounds, or it gives each node keys of what
distinguishes it from the leader, and the nodes that share such a key make a bucket of the next level. What is left after
DEPTH levels is compared in full. No bucket has a cap. Pairs whose sizes are too far apart to be similar, or that earlier
levels have put into one class, are left out: they can give no new link.

Nodes are numbered once, among those that share a bucket, so that joins and labels work on longs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stored, components, small

#: Nodes of a bucket whose order one task sorts; larger buckets are cut by a hash of the node.
PER_RUN = 4096
#: The largest bucket of which the leader and the predecessors make all pairs.
COMPLETE = 4
#: Pairs that one copy of a node's data serves in the verifying join; nodes with more pairs are copied.
PER_COPY = 256
#: Levels of buckets; after the last, nodes of different classes in a bucket are compared in full.
DEPTH = 4


def _can(x: str, y: str, least: float | None) -> Column:
    """Whether nodes of the sizes x and y can be similar: the sizes differ by no more edits than ``least`` allows the larger."""
    if least is None:
        return F.lit(True)
    longer = F.greatest(x, y)
    return F.coalesce(longer - F.least(x, y) <= F.floor(longer * F.lit(1 - least) + F.lit(1e-9)), F.lit(True))


def _pairs(members: DataFrame, least: float | None) -> DataFrame:
    """(a, b), a < b: every node of a bucket with its leader and predecessors, as far as they can be similar and are not
    known to be of one class. members: bucket, node, size, component, met, size_of, leader (its node, size, component)."""
    w = W.partitionBy("bucket", "run").orderBy(F.desc("met"), "node")
    runs = members.withColumn("run", F.pmod(F.xxhash64("node"), F.floor((F.col("size_of") - 1) / PER_RUN) + 1))
    own = F.struct("node", "size", "component")
    others = runs.select("node", "size", "component", F.array("leader", F.lag(own, 1).over(w), F.lag(own, 2).over(w)).alias("others"))
    each = others.select("node", "size", "component", F.explode(F.array_distinct(F.filter("others", lambda x: x.isNotNull()))).alias("other"))
    apart = F.coalesce(F.col("component") != F.col("other.component"), F.col("node") != F.col("other.node"))
    return each.where(apart & _can("size", "other.size", least)).select(F.least("node", "other.node").alias("a"), F.greatest("node", "other.node").alias("b")).distinct()


def attach(pairs: DataFrame, data: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with a_<column> and b_<column> of both ends. data: node and the columns, one row a node.

    A node with many pairs (the leader of a large group) is copied once for each PER_COPY of its pairs, so that its
    pairs spread over that many keys. The copies are dealt while a pair is two numbers; then each end's data moves once.
    """
    ends = [pairs.select(F.col(x).alias("node"), F.lit(int(x == "a")).alias("as_a"), F.lit(int(x == "b")).alias("as_b")) for x in ("a", "b")]
    nodes = Stored(ends[0].unionByName(ends[1]).groupBy("node").agg(F.sum("as_a").alias("n_a"), F.sum("as_b").alias("n_b")), "pair-nodes")
    more = lambda n: F.floor((F.col(n) - 1) / PER_COPY).cast("int")
    for end, other in (("a", "b"), ("b", "a")):
        many = small(nodes).where(F.col(f"n_{end}") > PER_COPY).select(F.col("node").alias(end), more(f"n_{end}").alias("more"))
        copy = F.coalesce(F.pmod(F.xxhash64(other), F.col("more") + 1), F.lit(0)).cast("int")
        pairs = pairs.join(many, end, "left").withColumn(f"{end}_copy", copy).drop("more")
    for end in ("a", "b"):
        own = data.join(small(nodes).where(F.col(f"n_{end}") > 0), "node")
        copies = own.select(F.col("node").alias(end), F.explode(F.sequence(F.lit(0), more(f"n_{end}"))).alias(f"{end}_copy"), *[F.col(c).alias(f"{end}_{c}") for c in columns])
        pairs = pairs.join(copies, [end, f"{end}_copy"]).drop(f"{end}_copy")
    return pairs


def _numbered(rows: DataFrame) -> tuple[Stored, DataFrame]:
    """Names (id, node, doc, size) of the nodes that share a bucket, and (bucket, node: the id, size) of the shared buckets.

    Buckets are found by 64-bit hashes of the nodes, so that two longs a row are all that moves. Nodes whose hashes are
    equal get numbers of their own and meet in each other's buckets, which costs a comparison and changes nothing.
    """
    rows = rows.where("node is not null").withColumn("h", F.xxhash64("node"))
    found = rows.select(F.explode("buckets").alias("bucket"), "h").where("bucket is not null")
    several = Stored(found.groupBy("bucket").agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least != most").select("bucket"), "shared-buckets")
    shared = Stored(found.join(small(several), "bucket").groupBy("bucket", "h").agg(F.lit(1).alias("one")).drop("one"), "shared-rows")
    several.drop()
    wanted = Stored(shared.df.select("h").distinct(), "shared-nodes")
    names = Stored(rows.select("h", "node", "doc", "size").join(small(wanted), "h").groupBy("h", "node").agg(F.min("doc").alias("doc"), F.max("size").alias("size")).withColumn("id", F.monotonically_increasing_id()), "names")
    wanted.drop()
    return names, shared.df.join(small(names).select("h", "id", "size"), "h").select("bucket", F.col("id").alias("node"), "size")


def _members(each: Stored, least: float | None) -> Stored:
    """bucket, node, size, component, size_of, met, leader of the buckets with two nodes or more that can have a new link.

    each: bucket, node, size, component (null before the first classes are known); it is dropped. A bucket of one class
    has no new link, and neither has one of two nodes whose sizes are too far apart.
    """
    sizes = each.df.groupBy("bucket").agg(F.count("*").alias("size_of"), *[f(c).alias(f"{n}_{c}") for c in ("component", "size") for n, f in (("least", F.min), ("most", F.max))])
    sizes = sizes.where("size_of > 1 and (least_component is null or least_component != most_component)").where((F.col("size_of") > 2) | _can("least_size", "most_size", least)).select("bucket", "size_of")
    sized = each.df.join(sizes, "bucket")
    met = Stored(sized.join(sized.groupBy("node").agg(F.sum("size_of").alias("met")), "node"), "met-buckets")
    each.drop()
    order = F.least("met", F.lit(1 << 22)) * -(1 << 40) + F.pmod(F.xxhash64("node"), F.lit(1 << 40))
    leaders = met.df.groupBy("bucket").agg(F.min_by(F.struct("node", "size", "component"), order).alias("leader"))
    members = Stored(met.df.join(leaders, "bucket"), "buckets")
    met.drop()
    return members


def _mixed(members: DataFrame, found: DataFrame) -> Stored:
    """The nodes of large buckets with several classes: bucket, node, size, component, leader, largest, lead (component of the leader)."""
    large = members.where(F.col("size_of") > COMPLETE).select("bucket", "node", "size", F.col("leader.node").alias("leader"))
    labelled = Stored(large.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "labelled")
    parts = labelled.df.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.max(F.col("node") == F.col("leader")).alias("leads"))
    split = parts.groupBy("bucket").agg(F.count("*").alias("k"), F.max_by("component", "n").alias("largest"), F.max(F.when(F.col("leads"), F.col("component"))).alias("lead")).where("k > 1")
    out = Stored(labelled.df.join(split.select("bucket", "largest", "lead"), "bucket"), "mixed")
    labelled.drop()
    return out


def classes(
    rows: DataFrame,
    load: Callable[[DataFrame], Stored],
    verify: Callable[[DataFrame, DataFrame], Stored],
    narrow: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    refine: Callable[[DataFrame, DataFrame], Stored] | None = None,
    done: Callable[[], None] = lambda: None,
    least: float | None = None,
) -> DataFrame:
    """(node, component) for every node with a verified link; component is a number.

    rows: node (binary), buckets (array of long), doc (a row that holds the node), size (long, if ``least`` is given: nodes
    whose sizes differ by more than 1 - least of the larger are not similar); a node may repeat. Null nodes and buckets are
    no candidates. load takes names (id, node, doc) and stores what is compared, with the number as ``node``.
    verify takes pairs (a, b) of numbers and that table, and stores those that hold. ``narrow`` takes the nodes of
    buckets with several classes (bucket, node, component, leader, lead: the leader's component) and names the pairs of
    different classes that can hold, given that all pairs with the leader were verified. ``refine`` takes the same nodes
    and stores (bucket, node, size, component) of the next level, each node once in a bucket. Without either, and after DEPTH levels, the nodes outside the bucket's
    largest class are verified against all of the bucket. ``done`` is called as soon as rows are not read any more.
    """
    names, own = _numbered(rows if least is not None else rows.withColumn("size", F.lit(None).cast("long")))
    own = Stored(own.withColumn("component", F.lit(None).cast("long")), "bucket-nodes")
    done()
    data = load(names.df.select("id", "node", "doc"))
    tested: list[DataFrame] = []
    links: list[DataFrame] = []

    def look(pairs: DataFrame) -> DataFrame:
        """The components after these pairs were verified too."""
        for seen in tested:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        held = Stored(pairs, "candidates")
        tested.append(held.df)
        links.append(verify(held.df, data.df).df)
        every = links[0]
        for x in links[1:]:
            every = every.unionByName(x)
        return components(every, "a", "b", "long")

    for level in range(1, DEPTH + 1):
        members = _members(own, least)
        if level > 1 and not members.df.limit(1).count():
            members.drop()
            break
        found = look(_pairs(members.df, least))
        mixed = _mixed(members.df, found)
        members.drop()
        if not mixed.df.limit(1).count():
            break
        if narrow or not refine or level == DEPTH:
            found = look(narrow(mixed.df, data.df) if narrow else _across(mixed.df, least))
            break
        own = refine(mixed.df, data.df)
        mixed.drop()
    data.drop()
    return found.join(names.df.select(F.col("id").alias("node"), F.col("node").alias("name")), "node").select(F.col("name").alias("node"), "component")


def _across(mixed: DataFrame, least: float | None) -> DataFrame:
    rest = mixed.where("component != largest").select("bucket", F.col("node").alias("x"), F.col("component").alias("cx"), F.col("size").alias("sx"))
    both = rest.join(mixed.select("bucket", F.col("node").alias("y"), F.col("component").alias("cy"), F.col("size").alias("sy")), "bucket").where((F.col("cx") != F.col("cy")) & _can("sx", "sy", least))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
