"""Resharding by minimum-cost flow.

Old shards send bytes to new shards of given capacities; what stays costs nothing and what moves costs
by the byte, so the cheapest flow moves the fewest bytes. The flow is solved on shard sizes alone. Each
old shard is then laid out as a line of blocks, and the line is cut where the flow says: a document goes
where its middle lies. A second, small flow settles what whole documents left over or under, out of the
smallest documents of overfull shards. Shards that neither send nor receive keep their files.

The driver sees sums of shards and blocks only (`blocks` a shard, whatever the input's size).

Defined results: a null text has size 1 and the checksum of the empty text. Rows without an old shard
count as shard 0. Repeated rows are placed one by one. An empty table stays empty. Law `bytes`: sizes
differ by no more than small documents do.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

BLOCKS = 256


def solve_transfers(sizes: list[int], capacities: list[int], cost: dict[tuple[int, int], int] | None = None) -> dict[tuple[int, int], int]:
    """The cheapest flow from old to new shards: {(old, new): bytes}.

    A byte that stays in its shard is free; any other costs 1, or what `cost` says. Successive shortest
    paths on a graph with one node for each old and each new shard.
    """
    if sum(sizes) > sum(capacities):
        raise ValueError("the new shards are too small")
    n_old, n_new = len(sizes), len(capacities)
    source, sink = n_old + n_new, n_old + n_new + 1
    room: dict[tuple[int, int], int] = {}
    price: dict[tuple[int, int], int] = {}
    near: list[set[int]] = [set() for _ in range(n_old + n_new + 2)]

    def edge(a: int, b: int, most: int, each: int) -> None:
        room[a, b], room[b, a] = most, 0
        price[a, b], price[b, a] = each, -each
        near[a].add(b)
        near[b].add(a)

    for i, size in enumerate(sizes):
        edge(source, i, size, 0)
        for j in range(n_new):
            edge(i, n_old + j, size, (cost or {}).get((i, j), int(i != j)))
    for j, capacity in enumerate(capacities):
        edge(n_old + j, sink, capacity, 0)
    while True:
        far, came, queue = {source: 0}, {}, deque([source])
        while queue:
            a = queue.popleft()
            for b in near[a]:
                if room[a, b] > 0 and far[a] + price[a, b] < far.get(b, 1 << 62):
                    far[b], came[b] = far[a] + price[a, b], a
                    queue.append(b)
        if sink not in far:
            break
        path, b = [], sink
        while b != source:
            path.append((came[b], b))
            b = came[b]
        amount = min(room[e] for e in path)
        for a, b in path:
            room[a, b] -= amount
            room[b, a] += amount
    return {(i, j): room[n_old + j, i] for i in range(n_old) for j in range(n_new) if room[n_old + j, i]}


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def _sums(rows: DataFrame, keys: list[str]) -> list:
    return rows.groupBy(*keys).agg(F.sum("size").cast("long").alias("bytes"), F.count("*").alias("rows")).orderBy(*keys).collect()


def _line(rows: DataFrame, bands: Column, blocks: int) -> tuple[DataFrame, dict[int, int]]:
    """Where each row begins on the line of its shard, ordered by band and block; and the shards' sizes."""
    rows = rows.withColumn("band", bands.cast("int")).withColumn("draw", F.xxhash64("doc_id")).withColumn("block", F.pmod("draw", F.lit(blocks)).cast("int"))
    begins, ends = [], {}
    for r in _sums(rows, ["shard", "band", "block"]):
        begins.append((r.shard, r.band, r.block, ends.get(r.shard, 0)))
        ends[r.shard] = ends.get(r.shard, 0) + r.bytes
    spark = rows.sparkSession
    offsets = spark.createDataFrame(begins, "shard int, band int, block int, begin long")  # a row a block
    inside = Window.partitionBy("shard", "band", "block").orderBy("draw", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(F.broadcast(offsets), ["shard", "band", "block"]).withColumn("at", F.col("begin") + F.col("before"))
    return placed.drop("band", "draw", "block", "before", "begin"), ends


def _cut_lines(line: DataFrame, flow: dict[tuple[int, int], int], stay_last: bool) -> DataFrame:
    """New shard of each row: the segment of its shard's line that holds its middle."""
    segments = []
    for old in sorted({i for i, _ in flow}):
        at = 0
        for new in sorted((j for i, j in flow if i == old), key=lambda j: ((j == old) == stay_last, j)):
            segments.append((old, new, at, at + flow[old, new]))
            at += flow[old, new]
        segments[-1] = (*segments[-1][:3], 1 << 62)
    spark = line.sparkSession
    cuts = spark.createDataFrame(segments, "old int, new int, low long, high long")  # shards x shards rows
    by_shard = cuts.groupBy("old").agg(F.array_sort(F.collect_list(F.struct("low", "high", "new"))).alias("segments"))
    middle = F.col("at") + F.col("size") / 2
    target = F.filter("segments", lambda s: (s["low"] <= middle) & (middle < s["high"]))[0]["new"]
    joined = line.join(F.broadcast(by_shard), F.col("shard") == F.col("old"), "left")
    return joined.withColumn("shard", F.coalesce(target, F.col("shard"))).drop("old", "segments", "at")


def place(docs: DataFrame, old_shard: Column, shards: int, blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, old_shard, shard, slot; sizes of shards near equal."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old_shard"))
    rows = cut(rows)
    shard = rows.withColumn("shard", F.col("old_shard"))
    # first flow: lines in the order of a hash of the ids
    line, sizes = _line(shard, F.lit(0), blocks)
    total = sum(sizes.values())
    if not total:
        return shard.withColumn("slot", F.lit(0).cast("long")).limit(0)
    n_old = max(max(sizes) + 1, shards)
    capacities = equal_capacities(total, shards)
    flow = solve_transfers([sizes.get(i, 0) for i in range(n_old)], capacities + [0] * (n_old - shards))
    shard = cut(_cut_lines(line, flow, stay_last=False))
    # second flow: the smallest documents first, for what is left over
    line, sizes = _line(shard, F.log2(F.col("size")) * 2, 16)
    over = [max(0, sizes.get(i, 0) - c) for i, c in enumerate(capacities)]
    under = [max(0, c - sizes.get(i, 0)) for i, c in enumerate(capacities)]
    moves = solve_transfers(over, under, {(i, i): 1 for i in range(shards)})
    for i, n in sizes.items():
        moves[i, i] = n - over[i]
    shard = cut(_cut_lines(line, {k: v for k, v in moves.items() if v}, stay_last=True))
    return _with_slots(shard, blocks)


def _with_slots(rows: DataFrame, blocks: int) -> DataFrame:
    """Gapless numbers from 0 in each shard: counts of blocks before, and the place inside the block."""
    rows = rows.withColumn("draw", F.xxhash64("doc_id")).withColumn("block", F.pmod("draw", F.lit(blocks)).cast("int"))
    begins, ends = [], {}
    for r in _sums(rows, ["shard", "block"]):
        begins.append((r.shard, r.block, ends.get(r.shard, 0)))
        ends[r.shard] = ends.get(r.shard, 0) + r.rows
    offsets = rows.sparkSession.createDataFrame(begins, "shard int, block int, begin long")
    inside = Window.partitionBy("shard", "block").orderBy("draw", "doc_id", "size", "text_crc32")
    numbered = rows.withColumn("nth", F.row_number().over(inside) - 1).join(F.broadcast(offsets), ["shard", "block"])
    return numbered.withColumn("slot", F.col("begin") + F.col("nth")).drop("draw", "block", "begin", "nth")


def rewrite(spark: SparkSession, root: str, target: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Reshard the files under `root` (folders shard=K); returns (shard, folder), also written as a manifest.

    Only shards that send or receive rows are written, under `target`; the others stay where they are.
    Nothing is overwritten, so a run that fails can be repeated with another target.
    """
    docs = spark.read.parquet(root)
    placed = cut(place(docs, F.col("shard"), shards, id_col=id_col, text_col=text_col).select("doc_id", "size", "text_crc32", "old_shard", F.col("shard").alias("_new")))
    moved = placed.where("old_shard <> _new").select(F.explode(F.array("old_shard", "_new")).alias("shard")).distinct()
    affected = {r.shard for r in moved.collect()}  # shard numbers
    held = {r.shard for r in placed.select(F.col("_new").alias("shard")).distinct().collect()}
    if affected:
        text = F.col(f"`{text_col}`").cast("string")
        keyed = docs.where(F.col("shard").isin(*affected) | F.col("shard").isNull()).withColumns({"_id": F.col(f"`{id_col}`"), "_size": (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long"), "_crc": F.crc32(F.coalesce(text, F.lit("")).cast("binary")), "_old": F.coalesce(F.col("shard").cast("int"), F.lit(0))})
        same = lambda cols: Window.partitionBy(*cols).orderBy(F.lit(0))  # noqa: E731 - equal rows are interchangeable
        left = keyed.withColumn("_nth", F.row_number().over(same(["_id", "_size", "_crc", "_old"])))
        right = placed.select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("text_crc32").alias("_crc"), F.col("old_shard").alias("_old"), "_new").withColumn("_nth", F.row_number().over(same(["_id", "_size", "_crc", "_old"])))
        keys = ["_id", "_size", "_crc", "_old", "_nth"]
        matched = [left[k].eqNullSafe(right[k]) for k in keys]
        condition = matched[0]
        for c in matched[1:]:
            condition = condition & c
        written = left.join(right, condition).select(*[left[c] for c in docs.columns if c != "shard"], right["_new"].alias("shard"))
        # a large shard is written by as many tasks as its size asks for
        written.hint("rebalance", "shard").write.partitionBy("shard").parquet(f"{target}/data")
    rows = [(s, f"{target}/data/shard={s}" if s in affected else f"{root}/shard={s}") for s in sorted(held)]
    manifest = spark.createDataFrame(rows, "shard int, folder string")
    manifest.write.parquet(f"{target}/manifest")
    return manifest
