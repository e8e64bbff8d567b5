"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix. DataFrame and SQL only.

1. Rows fall into virtual partitions by hash. How many rows of each partition go to each shard is drawn from
   the multivariate hypergeometric law that a uniform shuffle gives these counts: first for groups of
   partitions, then within each group, so that a row of the matrix costs a draw per shard and no row of the
   table is looked at. A draw inverts the distribution outward from its mode, over 12 deviations.
2. Within a partition rows are permuted by hash and cut by the partition's counts: that is the exchange.
3. Within a shard rows are permuted again: by hash into buckets, whose counted sizes give each its first slot.

All randomness is a hash of seed and row, so a lost task repeats itself. Shard sizes differ by one row at
most. Nulls hash like values, repeated rows are interchangeable, an empty table stays empty, and columns named
shard or slot are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentrail.llm.arrow import without
from sentrail.session import materialise

#: rows of a virtual partition or bucket, about; the matrix has MAX_PARTITIONS rows at most
PARTITION_ROWS = 100_000
GROUP = 256
MAX_PARTITIONS = GROUP * GROUP


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` where ``name`` stands for ``value``, worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hypergeometric(total: str, good: str, drawn: str, chance: str) -> str:
    """SQL for the number of good ones among ``drawn`` of ``total`` with ``good`` good ones, by inversion of ``chance``."""
    up = "(h.good - k) * (h.drawn - k) / ((k + 1D) * (h.rest + k + 1D))"
    down = "k * (h.rest + k) / ((h.good - k + 1D) * (h.drawn - k + 1D))"
    sums = lambda ks, ratio: f"aggregate({ks}, named_struct('w', 1D, 's', 0D), (a, k) -> named_struct('w', a.w * {ratio}, 's', a.s + a.w), a -> a.s)"
    find = lambda ks, ratio, target, last: (
        f"aggregate({ks}, named_struct('w', 1D, 's', 0D, 'k', cast(null as bigint)), (a, k) -> named_struct('w', a.w * {ratio}, 's', a.s + a.w, "
        f"'k', coalesce(a.k, if(a.s + a.w > {target}, k, cast(null as bigint)))), a -> coalesce(a.k, {last}))"
    )
    rising, falling = "sequence(m.mode, m.high)", "sequence(m.mode, m.low, -1L)"
    pick = f"if(x.t < x.up, {find(rising, up, 'x.t', 'm.high')}, {find(falling, down, 'x.t - x.up + 1D', 'm.low')})"
    summed = _let("s", f"named_struct('up', {sums(rising, up)}, 'down', {sums(falling, down)})", _let("x", f"named_struct('up', s.up, 't', {chance} * (s.up + s.down - 1D))", pick))
    limits = "named_struct('mode', b.mode, 'low', greatest(b.lo, b.mode - b.r), 'high', least(b.hi, b.mode + b.r))"
    spread = "sqrt(h.drawn * (h.good / h.total) * ((h.total - h.good) / h.total) * ((h.total - h.drawn) / greatest(h.total - 1D, 1D)))"
    bounds = (
        "named_struct('lo', greatest(0L, -h.rest), 'hi', least(h.drawn, h.good), "
        "'mode', greatest(greatest(0L, -h.rest), least(least(h.drawn, h.good), cast(floor((h.drawn + 1D) * (h.good + 1D) / (h.total + 2D)) as bigint))), "
        f"'r', cast(ceil(12 * {spread}) as bigint) + 12L)"
    )
    drawn_ = _let("b", bounds, _let("m", limits, summed))
    facts = f"named_struct('total', {total}, 'good', {good}, 'drawn', {drawn}, 'rest', {total} - {good} - {drawn})"
    return _let("h", facts, f"if(h.total = 0 or h.good = 0 or h.drawn = 0, 0L, {drawn_})")


def _rows_of_matrix(counts: str, sizes: str, seed: int) -> Column:
    """Array of matrix rows: for each struct(id, n) of ``counts``, in order, n split over what is left of ``sizes``."""
    chance = f"shiftrightunsigned(xxhash64({seed}L, c.id, s), 11) * {2.0**-53!r}D"
    cell = hypergeometric("q.total", "element_at(a.left, s)", "q.n", chance)
    # within a row: draw shard after shard from what the row and the shards still have
    next_cell = "named_struct('total', q.total - element_at(a.left, s), 'n', q.n - d, 'out', concat(q.out, array(d)))"
    row = (
        "aggregate(sequence(1, size(a.left)), named_struct('total', aggregate(a.left, 0L, (t, v) -> t + v), 'n', c.n, "
        f"'out', cast(array() as array<bigint>)), (q, s) -> {_let('d', cell, next_cell)}, q -> q.out)"
    )
    next_row = "named_struct('left', zip_with(a.left, r, (x, y) -> x - y), 'rows', concat(a.rows, array(named_struct('id', c.id, 'row', r))))"
    return F.expr(
        f"aggregate({counts}, named_struct('left', {sizes}, 'rows', cast(array() as array<struct<id:bigint,row:array<bigint>>>)), "
        f"(a, c) -> {_let('r', row, next_row)}, a -> a.rows)"
    )


def communication_matrix(counts: DataFrame, sizes: list[int], seed: int) -> DataFrame:
    """(id, row) for each (id, n): how many of partition ``id``'s n rows go to each shard; columns add up to ``sizes``."""
    listed = F.array_sort(F.collect_list(F.struct("id", "n"))).alias("counts")  # GROUP entries at most
    grouped = counts.groupBy(F.floor(F.col("id") / GROUP).alias("part")).agg(listed)
    parts = counts.groupBy(F.floor(F.col("id") / GROUP).alias("id")).agg(F.sum("n").alias("n"))
    upper = parts.agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("counts"))  # MAX_PARTITIONS / GROUP entries at most
    size_list = f"array({', '.join(f'{size}L' for size in sizes)})"
    rows = upper.select(F.explode(_rows_of_matrix("counts", size_list, 2 * seed)).alias("m")).select(F.col("m.id").alias("part"), F.col("m.row").alias("sizes"))
    return grouped.join(rows, "part").select(F.explode(_rows_of_matrix("counts", "sizes", 2 * seed + 1)).alias("m")).select("m.id", "m.row")


def shuffle_shards(docs: DataFrame, shards: int = 8, seed: int = 0, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """``docs`` with shard (0 to shards - 1) and slot (gapless from 0 in each shard)."""
    docs = without(docs, ["shard", "slot"])
    columns = [F.col(f"`{name}`") for name in docs.columns]
    row = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), *columns)
    rows = docs.count()
    partitions = min(MAX_PARTITIONS, max(16, -(-rows // partition_rows)))
    part = F.pmod(row("part"), F.lit(partitions))
    counts = materialise(docs.groupBy(part.alias("id")).agg(F.count("*").alias("n")), "partition_counts")
    sizes = [rows // shards + (shard < rows % shards) for shard in range(shards)]
    matrix = materialise(communication_matrix(counts, sizes, seed), "matrix")

    local = Window.partitionBy("_part").orderBy("_order", *columns)
    placed = docs.withColumns({"_part": part, "_order": row("local")}).withColumn("_at", F.row_number().over(local) - 1)
    ends = matrix.select(F.col("id").alias("_part"), F.expr("transform(sequence(1, size(row)), k -> aggregate(slice(row, 1, k), 0L, (s, v) -> s + v))").alias("_ends"))
    # the matrix has MAX_PARTITIONS rows of ``shards`` numbers at most
    placed = placed.join(F.broadcast(ends), "_part").withColumn("shard", F.expr("size(filter(_ends, e -> e <= _at))"))
    buckets = max(1, partitions // shards)
    again = row("again")
    placed = materialise(
        placed.select(*docs.columns, "shard", F.pmod(F.shiftright(again, 20), F.lit(buckets)).alias("_bucket"), again.alias("_order")), "exchanged"
    )
    filled = materialise(placed.groupBy("shard", "_bucket").agg(F.count("*").alias("n")), "bucket_sizes")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = filled.select("shard", "_bucket", before.alias("_first"))  # about MAX_PARTITIONS rows at most
    within = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_order", *columns)) - 1
    slots = placed.withColumn("_within", within).join(F.broadcast(first), ["shard", "_bucket"])
    return slots.select(*docs.columns, "shard", (F.col("_first") + F.col("_within")).alias("slot"))


def shard_report(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, read off the shuffled whole rows."""
    placed = shuffle_shards(docs, shards, seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int"),
        F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
