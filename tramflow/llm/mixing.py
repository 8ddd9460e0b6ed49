"""Mixing sources to target weights by Sainte-Lague apportionment (native).

Sources get target words by weight, capped at a number of epochs of their own size.
Blocks of equal word counts are given to the sources by the highest quotients
``target / (2 * seats + 1)``, then each source's blocks to its shards in the same
way. Within a shard the documents stand in a seeded order, laid end to end, and
the shard's quota of blocks is taken from the front, again and again if need be.

Everything is DataFrame work: one scan of the texts for their sizes (written once to
the checkpoint folder), aggregates by source and shard, and one window by shard.
A source gets shards in proportion to its words, so no window holds a hot source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramflow.llm.common import WORD
from tramflow.session import ensure_checkpoint_dir

WEIGHTS = (5, 2, 1)
EPOCHS = 3
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 20
SEED = "mix-1"


def sainte_lague(votes: DataFrame, seats: Column, group: list[str], key: list[Column]) -> DataFrame:
    """Adds ``quota``: the seats each row of a group wins by the highest quotients ``votes / (2s + 1)``.

    ``seats`` is the group's number of seats, ``key`` the order that breaks ties. The rows
    start from their rounded share; rounding is off by half the group's rows at
    most, so only the quotients next to the rounded share are ranked: for a row
    with share p of R rows, p * R / 2 + 2 of them.
    """
    whole = Window.partitionBy(*group)
    rounded = (
        votes.withColumn("_rank", F.row_number().over(whole.orderBy(*key)))
        .withColumn("_all", F.sum("votes").over(whole))
        .withColumn("_rows", F.count(F.lit(1)).over(whole))
        .withColumn("_share", F.when(F.col("_all") > 0, F.col("votes") / F.col("_all")).otherwise(0.0))
        .withColumn("_seats", F.floor(seats * F.col("_share") + 0.5))
        .withColumn("_open", F.when(F.col("_all") > 0, seats - F.sum("_seats").over(whole)).otherwise(0))
    )
    step = F.explode(F.sequence(F.lit(0), F.floor(F.col("_share") * F.col("_rows") / 2).cast("int") + 1))
    tried = rounded.where("_open <> 0").select(*group, "_rank", "_open", "votes", "_seats", step.alias("_t"))
    more, divisor = F.col("_open") > 0, 2 * (F.col("_seats") + F.when(F.col("_open") > 0, F.col("_t")).otherwise(-F.col("_t") - 1)) + 1
    tried = tried.withColumn("_quotient", F.col("votes") / divisor).where(more | (F.col("_seats") > F.col("_t")))
    order = [F.when(more, -F.col("_quotient")).otherwise(F.col("_quotient")), F.when(more, F.col("_rank")).otherwise(-F.col("_rank")), "_t"]
    won = (
        tried.withColumn("_place", F.row_number().over(whole.orderBy(*order)))
        .where(F.col("_place") <= F.abs("_open"))
        .groupBy(*group, "_rank")
        .agg(F.sum(F.signum("_open")).cast("long").alias("_won"))
    )
    same = F.col("r._rank") == F.col("w._rank")
    for g in group:
        same &= F.col(f"r.{g}").eqNullSafe(F.col(f"w.{g}"))
    quota = (F.col("r._seats") + F.coalesce(F.col("w._won"), F.lit(0))).cast("long").alias("quota")
    return rounded.alias("r").join(won.alias("w"), same, "left").select(*[f"r.{c}" for c in votes.columns], quota)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: ``source_size`` and ``target``, the source's share by weight of all words.

    Targets stop at ``epochs`` times the source's size and the excess goes to the others by
    weight. In the order of cap / weight the capped sources come first, so one running
    sum finds the level at which the rest is shared: that of the first source that it does not cap, the
    largest, as each source wrongly left out lowers it. The windows hold one row per source.
    """
    order, whole = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    by_cap = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_w", weight)
        .withColumn("_cap", epochs * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
        .withColumn("_rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(by_cap), F.lit(0)))
        .withColumn("_over", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(by_cap), F.lit(0)))
        .withColumn("_level", F.col("_rest") / F.col("_over"))
        .withColumn("_level", F.max(F.when(F.col("_ratio") > F.col("_level"), F.col("_level"))).over(whole))
        .select("source", "source_size", F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_w") * F.col("_level"), F.col("_cap").cast("double"))).alias("target"))
    )


def mix(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED, row: str | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``, and its column ``row`` if one is named.

    ``taken`` counts the words that the mix takes of a document, repeats included: whole
    epochs of its shard, and a part where the quota ends. A null text has no words and
    a null source is a source of its own, the last. Rows with equal ids and sizes are
    interchangeable: each is a document, and as many such rows are taken in any run.
    A source without words, or an empty table, gets nothing.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12), 16, 10).cast("long")
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    also = [row] if row else []
    sized = docs.select("doc_id", "source", size.alias("size"), place.alias("place"), *also).checkpoint()

    source = targets(sized, weights, epochs)
    blocks = F.floor(F.sum("source_size").over(Window.partitionBy("_one")) / block_words + 0.5)
    source = sainte_lague(source.withColumn("votes", F.col("target")).withColumn("_one", F.lit(1)).withColumn("_blocks", blocks), F.col("_blocks"), ["_one"], [F.col("source").asc_nulls_last()])
    source = source.select("source", "source_size", "target", F.col("quota").alias("source_quota"), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"))

    same = F.col("d.source").eqNullSafe(F.col("s.source"))
    sharded = sized.alias("d").join(source.alias("s"), same).select("d.doc_id", "d.source", "d.size", "d.place", "s.source_size", "s.target", "s.source_quota", (F.col("d.place") % F.col("s.shards")).alias("shard"), *[F.col(f"d.{c}") for c in also])
    shard = sharded.groupBy("source", "shard").agg(F.sum("size").cast("double").alias("votes"), F.first("source_quota").alias("source_quota"))
    shard = sainte_lague(shard, F.col("source_quota"), ["source"], [F.col("shard")])
    words = F.least(F.col("quota") * block_words, epochs * F.col("votes").cast("long"))
    shard = shard.select("source", "shard", F.col("votes").cast("long").alias("shard_size"), words.alias("shard_words"))

    same = F.col("d.source").eqNullSafe(F.col("q.source")) & (F.col("d.shard") == F.col("q.shard"))
    laid = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sharded.withColumn("start", F.coalesce(F.sum("size").over(laid), F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("d.start") + F.col("d.size"), F.col("rest")) - F.col("d.start"))
    return (
        placed.alias("d")
        .join(shard.alias("q"), same)
        .withColumn("epochs", F.when(F.col("q.shard_size") > 0, F.floor(F.col("q.shard_words") / F.col("q.shard_size"))).otherwise(0))
        .withColumn("rest", F.col("q.shard_words") - F.col("epochs") * F.col("q.shard_size"))
        .select("d.doc_id", "d.size", "d.source_size", "d.target", (F.col("epochs") * F.col("d.size") + part).cast("long").alias("taken"), *[F.col(f"d.{c}") for c in also])
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mixed corpus of ``docs`` (see ``apply_mix``), whose ids may be null or repeated.

    Rows are numbered once, and the numbered rows are checkpointed, so that each row gets its own quota and no other row's. The
    columns of ``docs`` come back, whatever they are called; an empty table gives no rows.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    order = docs.columns
    number = "_row" + "_" * max(map(len, order))  # longer than any column's name
    rows = docs.withColumn(number, F.monotonically_increasing_id()).checkpoint()
    return apply_mix(rows, mix(rows.select("doc_id", "source", "text", number), row=number), number).select(*order)


def apply_mix(docs: DataFrame, taken: DataFrame, key: str = "doc_id") -> DataFrame:
    """The mixed corpus: each document as often as ``taken`` has it whole, then its first words if a part is left.

    A part is cut after its last word, so its text is a prefix of the document's. Documents
    with no word taken go. ``key``, a column of both, must be unique in ``docs`` here (see ``mixed``); ``n_chars`` is counted anew.
    """
    take = taken.where("taken > 0").select(F.col(key).alias("_id"), F.col("size").alias("_size"), F.col("taken").alias("_taken"))
    words = F.split(F.col("text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    copies = F.explode(F.sequence(F.lit(1), F.ceil(F.col("_taken") / F.col("_size")).cast("int")))
    rest = F.col("_taken") - (F.col("_copy") - 1) * F.col("_size")
    text = F.when(rest >= F.col("_size"), F.col("text")).otherwise(F.concat_ws("", F.slice(words, F.lit(1), rest.cast("int"))))
    return (
        docs.join(take, F.col(key).eqNullSafe(F.col("_id")))
        .withColumn("_copy", copies)
        .withColumn("text", text)
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .select(*docs.columns)
    )


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS place
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w,
         {EPOCHS} * source_size AS cap FROM src),
levels AS (
  SELECT a.source, a.cap / a.w AS ratio, a.source_size, a.w, a.cap,
         ((SELECT sum(source_size) FROM weighed) - coalesce(sum(b.cap) FILTER (b.cap / b.w < a.cap / a.w), 0))
         / ((SELECT sum(w) FROM weighed) - coalesce(sum(b.w) FILTER (b.cap / b.w < a.cap / a.w), 0)) AS lvl
  FROM weighed a, weighed b GROUP BY a.source, a.source_size, a.w, a.cap),
target AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), w * (SELECT max(lvl) FROM levels WHERE ratio > lvl)) AS target FROM levels),
seats AS (
  SELECT source, count(*) AS source_quota FROM (
    SELECT source, row_number() OVER (ORDER BY target / (2 * s + 1) DESC, source NULLS LAST, s) AS place
    FROM target, range(0, 1 + (SELECT CAST(floor(sum(source_size) / {BLOCK_WORDS} + 0.5) AS BIGINT) FROM src)) t(s) WHERE target > 0)
  WHERE place <= (SELECT floor(sum(source_size) / {BLOCK_WORDS} + 0.5) FROM src) GROUP BY source),
dealt AS (
  SELECT d.*, t.source_size, t.target, coalesce(q.source_quota, 0) AS source_quota,
         d.place % greatest(1, CAST(ceil(t.source_size / {SHARD_WORDS}) AS BIGINT)) AS shard
  FROM sized d JOIN target t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN seats q ON d.source IS NOT DISTINCT FROM q.source),
shards AS (SELECT source, shard, sum(size) AS votes, any_value(source_quota) AS source_quota FROM dealt GROUP BY source, shard),
shard_seats AS (
  SELECT source, shard, count(*) AS quota FROM (
    SELECT source, shard, source_quota, row_number() OVER (PARTITION BY source ORDER BY CAST(votes AS DOUBLE) / (2 * s + 1) DESC, shard, s) AS place
    FROM shards, LATERAL (SELECT unnest(range(0, CAST(source_quota AS BIGINT) + 1)) AS s) WHERE votes > 0)
  WHERE place <= source_quota GROUP BY source, shard),
took AS (
  SELECT s.source, s.shard, CAST(s.votes AS BIGINT) AS shard_size, CAST(least(coalesce(q.quota, 0) * {BLOCK_WORDS}, {EPOCHS} * s.votes) AS BIGINT) AS shard_words
  FROM shards s LEFT JOIN shard_seats q ON s.source IS NOT DISTINCT FROM q.source AND s.shard = q.shard),
laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM dealt)
SELECT d.doc_id, d.size, d.source_size, d.target,
       CAST(CASE WHEN q.shard_size = 0 THEN 0 ELSE q.shard_words // q.shard_size * d.size
            + greatest(0, least(d.start + d.size, q.shard_words % q.shard_size) - d.start) END AS BIGINT) AS taken
FROM laid d JOIN took q ON d.source IS NOT DISTINCT FROM q.source AND d.shard = q.shard
"""
