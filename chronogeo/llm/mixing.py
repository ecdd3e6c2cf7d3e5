"""Mixing sources to target weights: a low-discrepancy source schedule.

Slot i gets the golden-ratio point frac(i * phi), in 32-bit integer arithmetic; the point falls into the cumulative
weights and so names a source.  Slots are ranked per source and joined to that source's shuffled blocks of equal token
counts.  A source with fewer blocks than slots starts over (another epoch), so targets are met exactly; without a budget
of tokens every block of every source is used at least once.

The running token count that cuts a source into blocks is a two-level prefix sum over hash buckets: no task has to hold
or sort a whole source, however hot it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

BLOCK_TOKENS = 2048
SEED = 42
GOLDEN = 2654435769  # floor(2^32 / phi)
#: buckets of the shuffle order in one source; a task of the last sort holds one bucket
HEX = 3
#: weights are scaled to a sum of about 2^SCALE
SCALE = 30
#: slots by which a source's share of the first n points may lag behind its weight (their discrepancy grows with log n)
MARGIN = 8


def documents_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0b]+")).cast("long")
    order = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(text)))
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), n.alias("n_tokens"), order.alias("order"))


def placed(d: DataFrame) -> DataFrame:
    """Each document with the number of tokens before it in its source's shuffled order."""
    d = d.where("n_tokens > 0").withColumn("bucket", F.substring("order", 1, HEX))
    per = d.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("t"))
    w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("source", "bucket", F.coalesce(F.sum("t").over(w), F.lit(0)).alias("base"))
    w = Window.partitionBy("source", "bucket").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = d.withColumn("before", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))
    return inside.join(per, ["source", "bucket"]).select("doc_id", "source", "n_tokens", (F.col("base") + F.col("before")).alias("at"))


def point(slot):
    """The golden-ratio point of a slot, times 2^32. Slot and product are taken modulo 2^32 in halves of 16 bits, so that no product
    leaves 64 bits, however high the slot."""
    low, high = slot.bitwiseAND(0xFFFF), F.shiftright(slot, 16).bitwiseAND(0xFFFF)
    return (low * F.lit(GOLDEN) + (high * F.lit(GOLDEN)).bitwiseAND(0xFFFF) * 65536).bitwiseAND(0xFFFFFFFF)


def schedule(d: DataFrame, weights: dict[str, int] | None = None, tokens: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(slot, source, rank) for every slot; per source its weight range and number of blocks."""
    tot = d.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    if weights is None:  # tempered: the square root of a source's tokens
        weight = F.floor(F.sqrt(F.col("tokens").cast("double")) * 100.0)
    else:
        weight = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("source")), F.lit(0)) if weights else F.lit(0)
    # one row a source: a table as small as the list of sources
    rows = sorted(tot.select("source", "tokens", weight.cast("long").alias("weight")).where("weight > 0").collect(), key=lambda r: r["source"].encode())
    spark, cum, out = d.sparkSession, 0, []
    given = sum(r["weight"] for r in rows)
    scaled = [max(1, (r["weight"] << SCALE) // given) for r in rows]  # so that a point times the total fits 64 bits
    total = sum(scaled)
    slots = 0
    for r, w in zip(rows, scaled):
        blocks = -(-r["tokens"] // BLOCK_TOKENS)
        out.append((r["source"], cum, cum + w, blocks))
        cum += w
        slots = max(slots, -(-(blocks + MARGIN) * total // w))
    if tokens is not None:
        slots = -(-tokens // BLOCK_TOKENS) if out else 0
    info = spark.createDataFrame(out, "source string, lo long, hi long, blocks long")
    s = spark.range(slots).select(F.col("id").alias("slot")).withColumn("target", point(F.col("slot")) * F.lit(total))
    s = s.join(F.broadcast(info), (F.col("target") >= F.col("lo") * (1 << 32)) & (F.col("target") < F.col("hi") * (1 << 32)))
    # ranks in two levels, too: chunks of slots, then slots in a chunk
    s = s.withColumn("chunk", F.shiftright("slot", 14))
    per = s.groupBy("source", "chunk").count()
    w = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("source", "chunk", F.coalesce(F.sum("count").over(w), F.lit(0)).alias("base"))
    w = Window.partitionBy("source", "chunk").orderBy("slot")
    ranked = s.withColumn("r", F.row_number().over(w) - 1).join(per, ["source", "chunk"])
    return ranked.select("slot", "source", (F.col("base") + F.col("r")).alias("rank"), "blocks"), info


def pieces_of(p: DataFrame) -> DataFrame:
    """The parts of documents in each block: (source, block, doc_id, tok_start, tok_stop)."""
    b = F.lit(BLOCK_TOKENS)
    first, last = F.expr(f"at div {BLOCK_TOKENS}"), F.expr(f"(at + n_tokens - 1) div {BLOCK_TOKENS}")
    p = p.withColumn("block", F.explode(F.sequence(first, last)))
    return p.select("source", "block", "doc_id", F.greatest(F.lit(0), F.col("block") * b - F.col("at")).alias("tok_start"), F.least(F.col("n_tokens"), (F.col("block") + 1) * b - F.col("at")).alias("tok_stop"), (F.greatest(F.col("at"), F.col("block") * b)).alias("place"))


def mix(docs: DataFrame, weights: dict[str, int] | None = None, tokens: int | None = None) -> DataFrame:
    """slot, source, epoch, block, doc_id, tok_start, tok_stop: the schedule with what each slot's block holds.

    weights: whole numbers by source; None gives each source the root of its tokens. tokens: the length of the mix, to whole
    blocks; None makes it long enough for every block of every source to be used, which costs many epochs of the others if
    a large source has a small weight. A source that has no weight or no
    token gets no slot. A null source is the source ''; null and empty texts have no tokens and so no rows; a null
    doc_id is passed on; rows that repeat a document are both used (ties in the shuffle have the same tokens, so either
    order gives the same blocks); a long document spans as many blocks as it needs; the last block of a source is short.
    Extra columns are not read. Empty tables give an empty result.
    """
    d = cut(documents_of(docs))  # texts are counted and hashed once; what goes on is a few numbers a document
    slots, _ = schedule(d, weights, tokens)
    slots = slots.withColumn("block", F.expr("rank % blocks")).withColumn("epoch", F.expr("rank div blocks"))
    out = slots.join(pieces_of(placed(d)), ["source", "block"])
    return out.select("slot", "source", "epoch", "block", "doc_id", "tok_start", "tok_stop")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the training mix of docs, as a schedule of token ranges."""
    return mix(docs)


def sql(docs: str = "documents") -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f\\v]+'))::BIGINT AS n_tokens,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS ord
  FROM {docs}),
e AS (SELECT *, (sum(n_tokens) OVER (PARTITION BY source ORDER BY ord, doc_id ROWS UNBOUNDED PRECEDING) - n_tokens)::BIGINT AS pos FROM d WHERE n_tokens > 0),
t0 AS (SELECT source, floor(sqrt(sum(n_tokens)::DOUBLE) * 100)::BIGINT AS given, ((sum(n_tokens) + {BLOCK_TOKENS - 1}) // {BLOCK_TOKENS})::BIGINT AS blocks FROM e GROUP BY source),
t AS (SELECT source, blocks, greatest(1, (given << {SCALE}) // (sum(given) OVER ())::BIGINT)::BIGINT AS weight FROM t0 WHERE given > 0),
u AS (SELECT source, weight, blocks, (sum(weight) OVER (ORDER BY encode(source) ROWS UNBOUNDED PRECEDING) - weight)::BIGINT AS lo, (sum(weight) OVER ())::BIGINT AS total FROM t),
n AS (SELECT max(((blocks + {MARGIN}) * total + weight - 1) // weight)::BIGINT AS slots, max(total) AS total FROM u),
s AS (SELECT r.slot, (r.slot * {GOLDEN}) & 4294967295 AS point, n.total FROM n, LATERAL (SELECT unnest(range(n.slots)) AS slot) r),
k AS (SELECT s.slot, u.source, u.blocks, row_number() OVER (PARTITION BY u.source ORDER BY s.slot) - 1 AS rank
      FROM s JOIN u ON s.point * s.total >= u.lo * 4294967296 AND s.point * s.total < (u.lo + u.weight) * 4294967296),
p AS (SELECT source, doc_id, n_tokens, pos, unnest(range(pos // {BLOCK_TOKENS}, (pos + n_tokens - 1) // {BLOCK_TOKENS} + 1)) AS block FROM e)
SELECT k.slot, k.source, (k.rank // k.blocks)::BIGINT AS epoch, p.block::BIGINT AS block, p.doc_id,
       greatest(0, p.block * {BLOCK_TOKENS} - p.pos)::BIGINT AS tok_start, least(p.n_tokens, (p.block + 1) * {BLOCK_TOKENS} - p.pos)::BIGINT AS tok_stop
FROM k JOIN p ON k.source = p.source AND k.rank % k.blocks = p.block
"""


SQL = sql()
