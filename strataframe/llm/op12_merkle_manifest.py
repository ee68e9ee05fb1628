"""A Merkle manifest of a table: a root over all rows, and a proof for each row.

Every row is a leaf, the SHA-256 of its columns. Rows of one group (here: language) form a tree in
the order of their id; the trees' subroots, in the order of the groups, form the tree of the root.

A tree is built in aligned blocks of ``FAN_OUT ** HEIGHT`` nodes. A block keeps each of its levels as one
string of hexadecimal digests, 64 characters a node: the parents of a level are the hashes of its
substrings of ``64 * FAN_OUT`` characters, and the siblings of a node are the substrings on either side of
it within its run. The tops of a tree's blocks are the nodes of the next stage, until one is left. A
node's path to the root is its segment of siblings in its own block, then its block's, and so on.

No task holds more than a block. Places in a tree come from a range sort and the sizes of its
partitions, so neither a language with most rows nor an id that many rows repeat meets in one task:
rows that tie are spread by the number they had when the leaves were written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.llm.tables import cut_lineage, partitions, table
from strataframe.session import broadcast_if_small

FAN_OUT = 2
HEIGHT = 8
DIGEST = 64  # characters of a digest in hexadecimal
_LOCAL = (1 << 33) - 1  # a row's number within its partition, in Spark's increasing ids


def record_hash(values: Sequence[Column]) -> Column:
    """SHA-256 of the values as text, each with its length in bytes in front; a null is ``-``."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, values)).cast("binary"), 256)


def leaves(
    rows: DataFrame, columns: Sequence[str], key: str, group: str, changes: Mapping[str, Column] | None = None,
    changed: Column | None = None,
) -> DataFrame:
    """``(key, tree, leaf, shown, row)``: each row's leaf, and the leaf that is shown for it later.

    ``tree`` is the group as text that sorts nulls first. ``shown`` is the leaf with ``changes``
    to its columns where ``changed`` holds, else the leaf. The table is written, so ``row`` stays the same.
    """
    own = record_hash([F.col(c) for c in columns])
    other = record_hash([(changes or {}).get(c, F.col(c)) for c in columns])
    return cut_lineage(rows.select(
        F.col(key).alias("key"), F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("tree"),
        own.alias("leaf"), (own if changed is None else F.when(changed, other).otherwise(own)).alias("shown"),
        F.monotonically_increasing_id().alias("row"),
    ))


def placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``at``, each node's place in its ``tree`` by ``order`` (nulls first), and the tree's ``size``."""
    spark = nodes.sparkSession
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ranges = nodes.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
    numbered = cut_lineage(ranges.withColumn("_n", F.monotonically_increasing_id()))
    part = F.shiftright("_n", 33).alias("_part")
    within = Window.partitionBy("tree").orderBy("_part")
    offsets = numbered.groupBy("tree", part).agg(F.min("_n").alias("_first"), F.count("*").alias("_rows")).select(
        "tree", "_part", "_first",
        F.coalesce(F.sum("_rows").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy("tree")).alias("size"),
    )
    joined = numbered.withColumn("_part", part).join(broadcast_if_small(offsets), ["tree", "_part"])
    return joined.withColumn("at", F.col("_n") - F.col("_first") + F.col("_before")).drop("_n", "_part", "_first", "_before")


def blocks_of(nodes: DataFrame, fan_out: int = FAN_OUT, height: int = HEIGHT) -> DataFrame:
    """``(tree, block, size, items, levels, top)`` of nodes ``(tree, at, size, node, ...)``.

    ``items`` holds the block's nodes with their other columns in order, ``levels`` its levels' strings. A
    tree of one block rises to one node; the blocks of a larger one rise by ``height`` levels.
    """
    width = fan_out**height
    others = [c for c in nodes.columns if c not in ("tree", "size")]
    gathered = nodes.groupBy("tree", F.expr(f"at div {width}").alias("block")).agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("at", *[c for c in others if c != "at"]))).alias("items"))
    rising = " + ".join(f"int(size > {fan_out**k})" for k in range(height))
    above = f"""array_join(transform(sequence(0, (octet_length(element_at(done, -1)) div {DIGEST} - 1) div {fan_out}),
        i -> sha2(substring(element_at(done, -1), i * {DIGEST * fan_out} + 1, {DIGEST * fan_out}), 256)), '')"""
    raised = gathered.withColumn("_rise", F.expr(rising)).withColumn("levels", F.expr(f"""
        aggregate(filter(sequence(1, {height}), k -> k <= _rise), array(array_join(items.node, '')),
                  (done, k) -> concat(done, array({above})))"""))
    return raised.select("tree", "block", "size", "items", "levels", F.element_at("levels", -1).alias("top"))


def segment(at: str, fan_out: int = FAN_OUT, height: int = HEIGHT) -> str:
    """SQL for a node's siblings in its block, level by level: what stands left of it in its run, and right."""
    steps = f"array({', '.join(str(fan_out**k) for k in range(height + 1))})"
    place = f"(({at}) % {fan_out**height}) div element_at({steps}, k)"
    return f"""
        transform(filter(sequence(1, {height}), k -> k < size(levels)), k -> named_struct(
            'left', substring(element_at(levels, k), int(({place}) div {fan_out} * {fan_out} * {DIGEST} + 1), int(({place}) % {fan_out} * {DIGEST})),
            'right', substring(element_at(levels, k), int((({place}) + 1) * {DIGEST} + 1), int(({fan_out - 1} - ({place}) % {fan_out}) * {DIGEST}))))"""


def _tops(blocks: DataFrame, width: int) -> DataFrame:
    return blocks.select("tree", F.col("block").alias("at"), F.expr(f"(size + {width - 1}) div {width}").alias("size"), F.col("top").alias("node"))


def grown(nodes: DataFrame, fan_out: int = FAN_OUT, height: int = HEIGHT) -> list[DataFrame]:
    """The written blocks of each stage, lowest first; each tree has one block in the last."""
    width, stages = fan_out**height, []
    while True:
        stages.append(cut_lineage(blocks_of(nodes, fan_out, height)))
        if (stages[-1].agg(F.max("size")).first()[0] or 0) <= width:
            return stages
        nodes = _tops(stages[-1], width)


def _paths_down(stages: Sequence[DataFrame], ends: DataFrame, fan_out: int, height: int) -> DataFrame:
    """Paths from the blocks of the lowest of ``stages`` to the root; ``ends`` has each tree's, and other columns."""
    width = fan_out**height
    others = [c for c in ends.columns if c not in ("tree", "path")]
    down = ends.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(stages[1:]):
        item = f"struct(x.at as block, concat({segment('x.at', fan_out, height)}, path) as path)"
        down = blocks.join(down, ["tree", "block"]).selectExpr("tree", *others, f"inline(transform(items, x -> {item}))")
        down = cut_lineage(down)
    return down


def manifest(leaf_rows: DataFrame, fan_out: int = FAN_OUT, height: int = HEIGHT) -> DataFrame:
    """``(key, leaf, subroot, root, path, shown)`` of leaves, one row each.

    ``path`` lists what stands left and right of the node in its run, from the leaf to the root; nodes that are alone
    have empty strings on both sides. Leaves are ordered by key, nulls first, equal keys by their leaf.
    Repeated rows are leaves of their own. Without rows there is nothing. Roots of groups are ordered with
    the null group first, then bytewise by their text.
    """
    trees = grown(placed(leaf_rows.withColumnRenamed("leaf", "node"), ["key", "node", "row"]), fan_out, height)
    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("member"), F.col("top").alias("node"))
    forest = grown(placed(subroots, ["member"]), fan_out, height)
    root = forest[-1].select(F.col("tree").alias("_tree"), F.lit(0).cast("long").alias("_block"), F.col("top").alias("root"))
    start = root.select(F.col("_tree").alias("tree"), "root", F.expr("cast(array() as array<struct<left:string,right:string>>)").alias("path"))
    down = _paths_down(forest, start, fan_out, height)
    ends = forest[0].join(down, ["tree", "block"]).selectExpr("root", f"""
        inline(transform(items, x -> struct(x.member as tree, x.node as subroot, concat({segment('x.at', fan_out, height)}, path) as path)))""")
    tops = _paths_down(trees, ends.select("tree", "subroot", "root", "path"), fan_out, height)
    joined = trees[0].join(tops, ["tree", "block"])
    item = f"struct(x.key as key, x.node as leaf, x.shown as shown, concat({segment('x.at', fan_out, height)}, path) as path)"
    return joined.selectExpr("subroot", "root", f"inline(transform(items, x -> {item}))")


def folded(leaf: str, path: str = "path") -> str:
    """SQL for the root that a leaf and its path give."""
    return f"aggregate({path}, {leaf}, (node, s) -> sha2(concat(s.left, node, s.right), 256))"


def proofs(rows: DataFrame, columns: Sequence[str], key: str, group: str, changes: Mapping[str, Column] | None = None,
           changed: Column | None = None, fan_out: int = FAN_OUT, height: int = HEIGHT) -> DataFrame:
    """``(key, leaf, subroot, root, proof_sha256, folded_root, verified)``: does each row, as shown, give the root?"""
    found = manifest(leaves(rows, columns, key, group, changes, changed), fan_out, height)
    return found.selectExpr(
        f"key as `{key}`", "leaf", "subroot", "root",
        "sha2(array_join(transform(path, s -> concat(s.left, s.right)), ''), 256) as proof_sha256", f"{folded('shown')} as folded_root",
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh document, by the checksum of its id, is shown with one added to n_chars."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return proofs(table(spark, sf_dir, "documents"), COLUMNS, "doc_id", "lang", {"n_chars": F.col("n_chars") + 1}, tampered)


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(cast({value} as varchar))) || ':' || cast({value} as varchar), '-')"


def _leaf(n_chars: str = "n_chars") -> str:
    return f"sha256({' || '.join(_field(c if c != 'n_chars' else n_chars) for c in COLUMNS)})"


_CRC_BYTES = "list_concat([4294967295], list_transform(string_split(cast(doc_id as varchar), ''), lambda d: ascii(d)::bigint))"
_CRC = f"""xor(4294967295, list_reduce({_CRC_BYTES},
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""

SQL = f"""
with recursive
  l as (select doc_id, coalesce('1' || lang, '0') as tree, {_leaf()} as leaf, case when doc_id is not null and {_CRC} % 7 = 0 then {_leaf('(n_chars + 1)')} end as bad from documents),
  p as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n from l),
  t(tree, lvl, pos, node, n) as (
    select tree, 0, pos, leaf, n from p
    union all
    select tree, lvl + 1, pos // 2, sha256(string_agg(node, '' order by pos)), (n + 1) // 2 from t where n > 1 group by tree, lvl, pos // 2, n),
  s as (select tree, node as subroot, row_number() over (order by tree) - 1 as pos, count(*) over () as n from t where n = 1),
  u(lvl, pos, node, n) as (
    select 0, pos, subroot, n from s
    union all
    select lvl + 1, pos // 2, sha256(string_agg(node, '' order by pos)), (n + 1) // 2 from u where n > 1 group by lvl, pos // 2, n),
  steps as (
    select p.doc_id, p.tree, p.pos, a.lvl, case when (p.pos >> a.lvl) % 2 = 1 then 'l' else 'r' end as side, b.node as sib
    from p join (select distinct tree, lvl from t where n > 1) a on a.tree = p.tree
    left join t b on b.tree = p.tree and b.lvl = a.lvl and b.pos = xor(p.pos >> a.lvl, 1)
    union all
    select p.doc_id, p.tree, p.pos, 1000 + a.lvl, case when (s.pos >> a.lvl) % 2 = 1 then 'l' else 'r' end, b.node
    from p join s on s.tree = p.tree cross join (select distinct lvl from u where n > 1) a
    left join u b on b.lvl = a.lvl and b.pos = xor(s.pos >> a.lvl, 1)),
  path as (select tree, pos, list(side || coalesce(sib, '') order by lvl) as steps from steps group by tree, pos),
  f as (
    select p.doc_id, p.leaf, s.subroot, (select node from u where n = 1) as root,
      sha256(coalesce(array_to_string(list_transform(path.steps, lambda x: substr(x, 2)), ''), '')) as proof_sha256,
      list_reduce(list_concat([coalesce(p.bad, p.leaf)], coalesce(path.steps, [])),
        lambda c, x: sha256(case when x[1] = 'l' then substr(x, 2) || c else c || substr(x, 2) end)) as folded_root
    from p join s on s.tree = p.tree left join path on path.tree = p.tree and path.pos = p.pos)
select *, folded_root = root as verified from f"""
