"""A mix of sources by weight: Sainte-Lague apportionment of equal blocks of words, then a seeded choice of blocks.

Sources share the size of the whole table by their weights, none above three times its own size. The share is dealt
in blocks: every block goes to the source with the highest quotient target / (2 k + 1) for its k-th block, so the
blocks' order by quotient is the mix, and a stretch of that order is a shard with whole quotas. Each source is
cut into blocks over its documents in order; quotas are filled by the source's blocks in a seeded order, again from
the start where a source is taken more than once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_table
from tidemark.llm.ranges import with_running
from tidemark.sources.scratch import stored

#: Weights of the sources in order, repeating, and how often a source may be taken.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
#: Words in a block, and blocks in a shard.
BLOCK_WORDS = 32
SHARD_BLOCKS = 32_768
SEED = 20
#: Blocks that one row unfolds to, so that a large source is unfolded by many tasks.
_UNFOLD = 16_384


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, place, target) of (source, source_size): words that each source shall give.

    Sources by code point, null last, weigh ``weights``, repeating. Filled like communicating vessels: in the order of
    size by weight, a source whose limit is below its share of what the earlier ones leave is held at its limit; the
    others share the rest by weight. That is where resharing the excess ends.
    """
    base = 1
    for w in weights:
        base *= w
    ordered = sizes.select("source", "source_size", F.col("source").isNull().alias("last"), F.lit(1).alias("one"))
    placed = with_running(ordered, [], ["last", "source"], {"one": "place"})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before_place") % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * most).alias("bound")
    weighed = placed.select("source", "source_size", F.col("before_place").alias("place"), weight.cast("bigint").alias("weight"), limit)
    weighed = weighed.withColumn("fill", F.expr(f"bound * ({base} div weight)"))
    filled = stored(with_running(weighed, [], ["fill", "place"], {"bound": "bound", "weight": "weight"}), "fill")
    total = f"CAST(total_bound div {most} AS DECIMAL(19, 0))"
    free = filled.filter(F.expr(f"bound * CAST(total_weight - before_weight AS DECIMAL(19, 0)) > ({total} - before_bound) * weight"))
    rest = F.struct(F.expr(f"CAST({total} - before_bound AS BIGINT)").alias("words"), F.expr("total_weight - before_weight").alias("weight"))
    first = free.agg(F.min_by(rest, F.struct("fill", "place")).alias("rest")).first()["rest"]  # one row
    words, among = (first["words"], first["weight"]) if first else (0, 1)
    held = F.expr(f"bound * {among}BD <= {words}BD * weight")
    target = F.when(held, F.col("bound").cast("double")).otherwise(F.expr(f"CAST(weight * {words}L AS DOUBLE) / {among}D"))
    return filled.select("source", "source_size", "place", target.alias("target"))


def _unfolded(rows: DataFrame, count: str, name: str) -> DataFrame:
    """A row for each number below ``count``; large counts are spread before they are unfolded."""
    starts = F.expr(f"sequence(0L, {count} - 1, {_UNFOLD}L)")
    spread = rows.filter(F.col(count) > 0).select("*", F.explode(starts).alias("start")).repartition("place", "start")
    numbers = F.expr(f"sequence(start, least(start + {_UNFOLD}, {count}) - 1)")
    return spread.select(*rows.columns, F.explode(numbers).alias(name))


def seats(targets: DataFrame, block: int = BLOCK_WORDS, shard: int = SHARD_BLOCKS, most: int = MOST_TIMES) -> DataFrame:
    """(place, seat, shard): the blocks of the mix by highest quotients, and the shard that each one is for.

    Of every source only so many quotients are ranked as the divisor can let through, all in all not many more than there
    are blocks. A source has at most ``most`` times its blocks.
    """
    whole = targets.agg(F.sum("source_size").alias("words"), F.count("*").alias("sources")).first()
    words, sources = whole["words"] or 0, whole["sources"]
    wanted = max((2 * words + block) // (2 * block), 1) if words else 0
    highest = F.floor(F.expr(f"target * {wanted + 2 * sources}D / {max(words, 1)}D + 1.5D"))
    able = F.expr(f"(source_size + {block - 1}) div {block} * {most}")
    open_seats = _unfolded(targets.select("place", "target", F.least(highest, able).alias("seats")), "seats", "seat")
    ranked = open_seats.select("place", "seat", F.expr("-target / (2 * seat + 1)").alias("fall"), F.lit(1).alias("one"))
    ranked = with_running(ranked, [], ["fall", "place", "seat"], {"one": "rank"}).filter(F.col("before_rank") < wanted)
    return ranked.select("place", "seat", F.expr(f"before_rank div {shard}").alias("shard"))


def quotas(dealt: DataFrame) -> DataFrame:
    """(shard, place, blocks): whole quotas of each shard; over the shards so far they are the apportionment too."""
    return dealt.groupBy("shard", "place").agg(F.count("*").alias("blocks"))


def chosen_blocks(targets: DataFrame, dealt: DataFrame, block: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """(place, block, shard, repeat): which blocks fill the quotas.

    A source's blocks stand in the order of a seeded digest; its first seat takes the first one and so on, and after
    the last one the first again.
    """
    counted = targets.select("place", F.expr(f"(source_size + {block - 1}) div {block}").alias("blocks"))
    digest = F.md5(F.concat_ws(":", F.lit(seed), "place", "block"))
    each = _unfolded(counted, "blocks", "block").select("place", "block", digest.alias("draw"), F.lit(1).alias("one"))
    turn = with_running(each, ["place"], ["draw", "block"], {"one": "turn"})
    turn = turn.select("place", "block", F.col("before_turn").alias("turn"))
    turns = dealt.join(counted, "place").select("place", "shard", F.expr("seat % blocks").alias("turn"), F.expr("seat div blocks").alias("repeat"))
    return turn.join(turns, ["place", "turn"]).drop("turn")


@dataclass(frozen=True)
class Mix:
    """``documents``: (doc_id, size, source, source_size, target, place, start), ``start`` being the words of the source
    before it. ``pieces``: (place, start, doc_id, first, words, shard, repeat), the words of a document that a shard takes
    from ``first`` on. ``quotas``: (shard, place, blocks)."""

    documents: DataFrame
    pieces: DataFrame
    quotas: DataFrame


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_TIMES,
    block: int = BLOCK_WORDS,
    shard: int = SHARD_BLOCKS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> Mix:
    """Mix the documents of all sources by weight; the mix is as large as the table.

    A source's words differ from its target by less than one block for each time it is taken, and one more. Null texts
    and texts without words have size 0 and are never taken; a null source is a source, the last one; repeated rows and
    null ids count each. An empty table, or one without words, takes nothing. Extra columns are ignored.
    """
    rows = as_table(docs, doc_id=doc_id, text=text, source=source)
    sized = rows.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("tie"))
    sized = stored(sized, "sizes")
    targets = stored(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    placed = sized.join(targets.withColumnRenamed("source", "of"), F.expr("source <=> of")).drop("of")
    placed = with_running(placed, ["place"], ["doc_id", "size", "tie"], {"size": "size"})
    placed = stored(placed.withColumnRenamed("before_size", "start").drop("total_size", "tie"), "placed")

    dealt = stored(seats(targets, block, shard, most), "seats")
    blocks = F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")
    parts = placed.filter("size > 0").select("place", "start", "size", "doc_id", F.explode(blocks).alias("block"))
    words = F.expr(f"least(start + size, (block + 1) * {block}) - greatest(start, block * {block})")
    pieces = parts.join(chosen_blocks(targets, dealt, block, seed), ["place", "block"]).select(
        "place", "start", "doc_id", F.expr(f"greatest(block * {block} - start, 0)").alias("first"), words.alias("words"), "shard", "repeat"
    )
    return Mix(placed, pieces, quotas(dealt))


def taken_words(mix: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken): how many words of each document the mix takes, repeats counted."""
    # Documents with words differ in (place, start); the others are not in any piece.
    taken = mix.pieces.groupBy("place", "start").agg(F.sum("words").alias("taken"))
    taken = taken.withColumn("some", F.lit(True))
    joined = mix.documents.withColumn("some", F.col("size") > 0).join(taken, ["place", "start", "some"], "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


ORACLE_SQL = r"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, 3 * source_size AS bound, [5, 2, 1][place % 3 + 1] AS weight FROM sources),
ordered AS (SELECT *, sum(source_size) OVER () AS words, sum(weight) OVER () AS weights,
    coalesce(sum(bound) OVER earlier, 0) AS used, coalesce(sum(weight) OVER earlier, 0) AS gone
  FROM weighed WINDOW earlier AS (ORDER BY bound * (10 // weight), place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rest AS (SELECT words - used AS left_words, weights - gone AS left_weight FROM ordered
  WHERE bound * (weights - gone) > (words - used) * weight ORDER BY bound * (10 // weight), place LIMIT 1),
targets AS (SELECT source, source_size, place, words, (2 * words + 32) // 64 AS wanted, (source_size + 31) // 32 AS blocks,
    CASE WHEN left_words IS NULL OR bound * left_weight <= left_words * weight THEN CAST(bound AS DOUBLE)
      ELSE CAST(weight * left_words AS DOUBLE) / CAST(left_weight AS DOUBLE) END AS target
  FROM ordered LEFT JOIN rest ON true),
quotients AS (SELECT place, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place, k) AS rank, wanted FROM (
  SELECT place, target, wanted, unnest(range(CAST(3 * blocks AS BIGINT))) AS k FROM targets)),
seats AS (SELECT place, count(*) AS seats FROM quotients WHERE rank <= wanted GROUP BY place),
drawn AS (SELECT place, block, row_number() OVER (PARTITION BY place ORDER BY md5('20:' || place || ':' || block), block) - 1 AS turn
  FROM (SELECT place, unnest(range(CAST(blocks AS BIGINT))) AS block FROM targets)),
times AS (SELECT place, block, seats // blocks + CASE WHEN turn < seats % blocks THEN 1 ELSE 0 END AS times
  FROM drawn JOIN targets USING (place) JOIN seats USING (place)),
placed AS (SELECT row_number() OVER () AS i, doc_id, size, source_size, target, place,
    coalesce(sum(size) OVER (PARTITION BY place ORDER BY doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
pieces AS (SELECT i, place, start, size, unnest(range(CAST(start // 32 AS BIGINT), CAST((start + size - 1) // 32 + 1 AS BIGINT))) AS block
  FROM placed WHERE size > 0),
taken AS (SELECT i, sum((least(start + size, (block + 1) * 32) - greatest(start, block * 32)) * times) AS taken
  FROM pieces JOIN times USING (place, block) GROUP BY i)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM placed LEFT JOIN taken USING (i)"""
