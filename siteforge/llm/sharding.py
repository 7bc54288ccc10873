"""Uniform sharding by a hypergeometric communication matrix (DataFrame and SQL functions only).

1. The rows are materialised, so that their partitions are fixed.
2. How many rows of partition p go to shard k is drawn exactly: a multivariate hypergeometric matrix whose row sums are the
   partition sizes and whose column sums are the shard sizes (at most one apart). The draw runs down a tree over the
   partitions with FANOUT children a node, so no task sees more than FANOUT counts, whatever the number of partitions.
3. Each partition is permuted locally (no exchange) and cut by its row of the matrix.
4. One exchange by (shard, random sub-range), and a second local permutation gives gapless slots.

Nulls: a null text has no bytes (size 1, crc32 0); a null doc_id is a row like any other. Repeated rows are rows of their own.
Ties between random keys fall to any order of equal chance. An empty table gives an empty result, a very long text is a row like any
other (the query carries only its size and checksum), and other columns than those asked for are never read.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.llm.common import cut, read

FANOUT = 16
SEED = 20240601
#: Rows in one sub-range of a shard: a task of the last exchange sorts about so many.
RANGE_ROWS = 20_000


def hypergeometric_sql(n: str, good: str, total: str, u: str) -> str:
    """SQL for a hypergeometric draw: good ones among n drawn out of total, by inversion with the uniform u.

    Weights follow the ratio of neighbouring probabilities, outwards from the mode (weight 1), for 12 standard deviations and
    40 more values on either side (the rest holds less than 1e-30); no factorials are needed.
    """
    walk = lambda d, start, body, init, done: f"aggregate(sequence(1, h.width), {init}, (a, i) -> {body}, a -> {done})"
    up = "((h.g - {x}) * (h.n - {x})) / (({x} + 1) * (h.t - h.g - h.n + {x} + 1))"
    down = "({x} * (h.t - h.g - h.n + {x})) / ((h.g - {x} + 1) * (h.n - {x} + 1))"

    def total_of(ratio: str, sign: str) -> str:
        x = f"(h.mode {sign} i {'- -' if sign == '-' else '-'} 1)"  # the value that this step leaves
        r = ratio.format(x=f"cast({x} as double)")
        stop = f"{x} < h.hi" if sign == "+" else f"{x} > h.lo"
        return walk(sign, "", f"if({stop}, named_struct('w', a.w * {r}, 's', a.s + a.w * {r}), a)", "named_struct('w', 1d, 's', 0d)", "a.s")

    def pick(ratio: str, sign: str, target: str) -> str:
        x = f"(h.mode {sign} i {'- -' if sign == '-' else '-'} 1)"
        r = ratio.format(x=f"cast({x} as double)")
        stop = f"{x} < h.hi" if sign == "+" else f"{x} > h.lo"
        step = f"if(a.left < 0 or not {stop}, a, named_struct('w', a.w * {r}, 'left', a.left - a.w * {r}, 'x', h.mode {sign} i))"
        return walk(sign, "", step, f"named_struct('w', 1d, 'left', {target}, 'x', h.mode)", "a.x")

    base = (
        f"named_struct('n', cast({n} as double), 'g', cast({good} as double), 't', cast({total} as double), 'lo', greatest(0L, {n} + {good} - {total}), 'hi', least({n}, {good}), "
        f"'mode', cast(floor((({n} + 1d) * ({good} + 1d)) / ({total} + 2d)) as bigint), "
        f"'width', cast(40 + 12 * sqrt(greatest(0d, {n} * ({good} / greatest(1d, {total})) * (1 - {good} / greatest(1d, {total})))) as int))"
    )
    # s: weights above and below the mode; t: what of the total weight u leaves after the mode
    with_s = f"element_at(transform(array({base}), h -> named_struct('h', h, 'up', {total_of(up, '+')}, 'down', {total_of(down, '-')}, 'u', {u})), 1)"
    chosen = f"if(g.t < 0, h.mode, if(g.t < g.up, {pick(up, '+', 'g.t')}, {pick(down, '-', 'g.t - g.up')}))"
    with_t = f"transform(array({with_s}), s -> named_struct('h', s.h, 'up', s.up, 't', s.u * (1 + s.up + s.down) - 1))"
    return f"if({n} <= 0 or {good} <= 0, 0L, if({good} >= {total}, {n}, element_at(transform({with_t}, g -> element_at(transform(array(g.h), h -> {chosen}), 1)), 1)))"


def _rows_sql(shards: int, seed: int) -> str:
    """SQL: array of the children's matrix rows, from caps (array of what each shard still takes) and kids (array of id, n)."""
    u = f"(shiftrightunsigned(xxhash64(c.id, k, lvl, {seed}), 11) / 9007199254740992d)"
    # over the shards: left rows of this child, total places from shard k on
    x = hypergeometric_sql("b.n", "element_at(a.caps, k)", "b.total", u)
    deal = (
        f"aggregate(sequence(1, {shards}), named_struct('n', c.n, 'total', aggregate(a.caps, 0L, (s, v) -> s + v), 'row', cast(array() as array<bigint>)), "
        f"(b, k) -> element_at(transform(array({x}), d -> named_struct('n', b.n - d, 'total', b.total - element_at(a.caps, k), 'row', concat(b.row, array(d)))), 1), b -> b.row)"
    )
    return (
        "aggregate(kids, named_struct('caps', caps, 'out', cast(array() as array<struct<id:bigint,row:array<bigint>>>)), "
        f"(a, c) -> element_at(transform(array({deal}), r -> named_struct('caps', zip_with(a.caps, r, (p, q) -> p - q), 'out', concat(a.out, array(named_struct('id', c.id, 'row', r))))), 1), a -> a.out)"
    )


def communication_matrix(sizes: DataFrame, shards: int, total: int, partitions: int, seed: int = SEED) -> DataFrame:
    """(pid, row array<bigint>) drawn for sizes (pid, n); row sums are n, column sums the shard sizes."""
    spark = sizes.sparkSession
    levels = max(1, math.ceil(math.log(max(2, partitions), FANOUT)))
    caps = [total // shards + (k < total % shards) for k in range(shards)]
    nodes = spark.range(1).select(F.col("id"), F.array(*[F.lit(c).cast("bigint") for c in caps]).alias("caps"))
    for level in range(levels):
        width = FANOUT ** (levels - level - 1)
        kids = sizes.groupBy(F.floor(F.col("pid") / width).cast("bigint").alias("kid")).agg(F.sum("n").alias("n"))
        kids = kids.groupBy(F.floor(F.col("kid") / FANOUT).cast("bigint").alias("id")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("kid").alias("id"), "n"))).alias("kids")
        )
        dealt = nodes.join(kids, "id").withColumn("lvl", F.lit(level)).select(F.explode(F.expr(_rows_sql(shards, seed))).alias("r"))
        nodes = dealt.select(F.col("r.id").alias("id"), F.col("r.row").alias("caps"))
    return nodes.select(F.col("id").alias("pid"), F.col("caps").alias("row"))


def shard(df: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """df with shard (int) and slot (long, gapless from 0 in each shard): a uniform shuffle with sizes at most one apart.

    df's columns are all carried and materialised; project first what is not needed.
    """
    names = df.columns
    kept = cut(df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("v"), F.rand(seed).alias("u")))
    kept = kept.withColumn("pid", F.spark_partition_id().cast("bigint"))
    sizes = kept.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("n"), F.max("pid").alias("p")).first()  # two numbers
    matrix = communication_matrix(sizes, shards, total.n or 0, (total.p or 0) + 1, seed)
    # bounded by the number of partitions: a row of the matrix has `shards` numbers
    ends = cut(matrix.select("pid", F.expr("transform(sequence(1, size(row)), i -> aggregate(slice(row, 1, i), 0L, (a, x) -> a + x))").alias("ends")))
    local = kept.sortWithinPartitions("u").withColumn("r", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    if (total.p or 0) < 200_000:
        ends = F.broadcast(ends)
    dealt = local.join(ends, "pid").select("v", F.expr("size(filter(ends, e -> e <= r))").alias("shard"), F.xxhash64("u", "pid", "r", F.lit(seed)).alias("k"))
    per = 1 << max(0, math.ceil(math.log2(max(1, (total.n or 0) / shards / RANGE_ROWS))))
    dealt = dealt.withColumn("range", F.pmod("k", F.lit(per)).cast("int"))
    counts = dealt.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("c"))
    before = counts.select("shard", "range", (F.sum("c").over(W.partitionBy("shard").orderBy("range")) - F.col("c")).alias("before"))
    if shards * per <= 200_000:
        before = F.broadcast(before)
    rank = F.row_number().over(W.partitionBy("shard", "range").orderBy("k"))
    out = dealt.withColumn("rank", rank).join(before, ["shard", "range"])
    taken = {c.lower() for c in names}
    extra = [("shard", F.col("shard").cast("int")), ("slot", F.col("before") + F.col("rank") - 1)]
    return out.select(*[F.col("v").getField(c).alias(c) for c in names if c.lower() not in ("shard", "slot")], *[e.alias(c) for c, e in extra])


def op1_sharding(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    d = d.select("doc_id", (F.octet_length(text).cast("bigint") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = shard(d, 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
