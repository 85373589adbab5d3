"""Mixing sources to target weights with a low-discrepancy schedule.

Every source's documents are shuffled and cut into blocks of equally many words. The schedule is
the van der Corput sequence: the points of its turns, mapped through the cumulative weights of the
sources, name the source of each slot, so that every stretch of the schedule holds the sources in
nearly their shares. The r-th slot of a source takes its r-th block, starting again after the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velolake.llm.common import BUCKET_ROWS, SPACE, bucket_bits, running_total, with_row, word_count
from velolake.session import stored

# Words of a block.
BLOCK_WORDS = 4096
# A source's target is at most so many times its size.
MOST_REPEATS = 3
# Other seeds give other shuffles.
SEED = 42


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and `_row`, stored. Null text has size 0."""
    return with_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                word_count(F.col("text")).alias("size")), "sized")


def source_targets(sized: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: source_no, source, source_size, weight, target.

    Sources in code-point order, null last, weigh 1, 2, 3, 1, 2, 3, ... The targets share the sum
    of all sizes by weight; one stops at `most` times its source's size and the excess goes to the
    others by weight until none is above. Sources without words have target 0.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = running_total(sources, "source_no", F.lit(1), F.col("source").asc_nulls_last())
    sources = stored(sources.withColumn("weight", F.pmod("source_no", F.lit(3)) + 1), "sources")
    cap = F.col("source_size") * most
    words, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (words or 0) / (weights or 1), -1
    while True:  # each turn caps more sources or ends
        full = cap <= F.col("weight") * F.lit(level)
        count, used, free = sources.agg(F.count_if(full), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if count == capped or not free:
            break
        capped, level = count, (words - (used or 0)) / free
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def bit_reversed(number: Column, bits: int) -> Column:
    """The lowest `bits` bits in reverse: the turn whose van der Corput point is number / 2**bits."""
    return F.conv(F.reverse(F.lpad(F.bin(number), bits, "0")), 2, 10).cast("long")


def slot_schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots: source_no, turn (their order), rank in the source, block, epoch, and limit.

    limit is the number of words that the slot's epoch takes of the source's shuffled words. A
    source needs as many slots as its target has blocks; the last takes what is missing, so the
    words taken equal the rounded target. With these counts as cumulative weights, a source owns
    an interval of the points n / 2**bits, and each point belongs to one turn.
    """
    size, quota = F.col("source_size"), F.round("target").cast("long")
    blocks = F.ceil(size / F.lit(block_words)).cast("long")
    rest = F.pmod(quota, size)
    needs = targets.filter((size > 0) & (quota > 0)).select(
        "source_no", "source_size", quota.alias("quota"), blocks.alias("blocks"),
        (F.floor(quota / size) * blocks + F.ceil(rest / F.lit(block_words))).cast("long").alias("slots"))
    needs = stored(running_total(needs, "first", F.col("slots"), F.col("source_no")), "needs")
    total = needs.agg(F.sum("slots")).first()[0] or 0
    bits = max(1, (total - 1).bit_length()) if total else 1
    pieces = needs.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(BUCKET_ROWS).cast("long"))))
    ends = F.least(F.col("from") + BUCKET_ROWS, F.col("slots")) - 1
    slots = (pieces.repartition("source_no", "from").withColumn("cell", F.explode(F.sequence("from", ends)))
             .withColumn("turn", bit_reversed(F.col("first") + F.col("cell"), bits)))
    # Rank in the source by turn: slots of earlier stretches of turns, then those within the stretch.
    stretch = F.shiftright("turn", max(0, BUCKET_ROWS.bit_length() - 1)).alias("stretch")
    slots = slots.select("source_no", "source_size", "quota", "blocks", "turn", stretch)
    earlier = Window.partitionBy("source_no").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = slots.groupBy("source_no", "stretch").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("source_no", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("source_no", "stretch").orderBy("turn")
    ranked = slots.join(counts, ["source_no", "stretch"]).withColumn("rank", F.col("before") + F.row_number().over(within) - 1)
    epoch = F.floor(F.col("rank") / F.col("blocks")).cast("long")
    return ranked.select("source_no", "turn", "rank", F.pmod("rank", "blocks").alias("block"), epoch.alias("epoch"),
                         F.least(F.col("source_size"), F.col("quota") - epoch * F.col("source_size")).alias("limit"))


def block_segments(sized: DataFrame, targets: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The parts of documents in the blocks of their shuffled source.

    Columns: source_no, block, _row, doc_id, at (position in the source), start (in the document), words.
    """
    owned = sized.filter("size > 0").join(targets.select("source_no", F.col("source").alias("_source")),
                                          F.col("source").eqNullSafe(F.col("_source")))
    bits = bucket_bits(sized.count())
    key = F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(-1)))
    owned = owned.select("source_no", "_row", "doc_id", "size", key.alias("key"), F.shiftright(key, 64 - bits).alias("bucket"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = owned.groupBy("source_no", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.select("source_no", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = (Window.partitionBy("source_no", "bucket").orderBy("key", "doc_id", "size", "_row")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = owned.join(sums, ["source_no", "bucket"]).withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    ends = F.col("at") + F.col("size")
    first, last = F.floor(F.col("at") / block_words), F.floor((ends - 1) / block_words)
    parts = placed.withColumn("block", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    begin = F.greatest("at", F.col("block") * block_words)
    end = F.least(ends, (F.col("block") + 1) * block_words)
    return parts.select("source_no", "block", "_row", "doc_id", begin.alias("at"), (begin - F.col("at")).alias("start"), (end - begin).alias("words"))


def mix(sized: DataFrame, targets: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix: rows of (turn, epoch, source_no, _row, doc_id, start, words), ordered by turn.

    Each row takes `words` words of a document from word `start`. Within a source, document words
    repeat only after all of its words are taken; no word is taken more than MOST_REPEATS times.
    The result depends on seed and rows only, not on partitions. Documents without words are not
    in it; an empty table gives an empty mix.
    """
    slots, parts = slot_schedule(targets, block_words), block_segments(sized, targets, block_words, seed)
    words = F.least(F.col("words"), F.col("limit") - F.col("at"))
    taken = slots.join(parts, ["source_no", "block"]).withColumn("words", words).filter("words > 0")
    return taken.select("turn", "epoch", "source_no", "_row", "doc_id", "start", "words")


def mixed_totals(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, size, source_size, target, taken, and its source.

    Null doc_ids and repeated rows are documents of their own; other columns are ignored.
    """
    sized = sized_documents(docs)
    targets = stored(source_targets(sized), "targets")
    taken = mix(sized, targets).groupBy("_row").agg(F.sum("words").alias("taken"))
    totals = targets.select(F.col("source").alias("_source"), "source_size", "target")
    return (sized.join(taken, "_row", "left").join(totals, F.col("source").eqNullSafe(F.col("_source")))
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, with the columns of `docs`: a row for each time that a document is taken.

    Where the mix ends within a document, that row has the words up to there, and n_chars to match.
    All columns stay, whatever their names. Documents of null or blank text have no words and are not
    taken; repeated rows are documents of their own; a null source is one too, after all others; an
    empty table gives no rows.
    """
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = with_row(packed, "mix-documents")
    sized = rows.select("_row", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.source").cast("string").alias("source"),
                        word_count(F.col("row.text")).alias("size"))
    sized = stored(sized, "sized")
    uses = mix(sized, stored(source_targets(sized), "targets")).groupBy("_row", "epoch").agg(F.sum("words").alias("words"))
    uses = stored(uses.groupBy(F.col("_row").alias("used")).agg(F.collect_list("words").alias("uses")), "uses").hint("shuffle_hash")
    taken = rows.join(uses, F.col("_row") == F.col("used")).select("row", F.explode("uses").alias("words"))
    text = F.col("row.text").cast("string")
    words = F.regexp_extract_all(text, F.lit(f"[{SPACE}]*[^{SPACE}]+"), F.lit(0))
    part = F.when(F.col("words") < word_count(text), F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), ""))
    taken = taken.select("row", part.alias("part"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.coalesce(F.length("part"), columns["n_chars"]).cast(docs.schema["n_chars"].dataType)
    columns["text"] = F.coalesce("part", columns["text"])
    return taken.select(*(value.alias(name) for name, value in columns.items()))
