"""Mixing sources to target weights (DataFrame functions only).

Documents of a source are laid end to end, in an order that hashes decide, and
cut into blocks of equally many words. The output is a list of slots, dealt to
shards of equally many; each shard draws how many of its slots every source
gets, a slot's number within its source is mapped through a pseudorandom
permutation to a block, and slots meet blocks by (source, block).

Draws of all shards together miss the wanted numbers of slots a little. The
permutation goes over the slots as drawn, so those beyond a source's number
are spread over all shards; they go to the sources that drew too few. Then
each source's slots are all used once, its blocks are passed through as often
as its target asks for, and the last slot takes only the words still wanted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import cut

#: Slices of a source by hash, so that no task orders a whole source. Fixed, so the table of offsets stays small.
SLICES = 2048
#: Shards whose counts are summed together before the sums are.
SHARD_RUN = 1024
#: Copies of one document that are listed by one row.
COPY_RUN = 4096
#: Ranges that draws are looked up by.
LOOKUPS = 1024
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    #: Weights of the sources in the order of their code points, null last, repeating.
    weights: Sequence[float] = (5.0, 2.0, 1.0)
    #: Words of the mix, as a share of all words.
    share: float = 1.5
    #: Most that a source gives, as a multiple of its words.
    most: float = 2.0
    block_words: int = 512
    shard_slots: int = 4096
    #: Rounds of the permutation.
    rounds: int = 24
    seed: int = 13


def permuted(i: Column, n: Column, tag: Column, settings: Settings) -> Column:
    """Image of ``i`` under a pseudorandom permutation of 0 .. n - 1 that ``tag`` names (swap-or-not shuffle).

    In each round a number and its mirror image about a random centre are
    both kept or both exchanged, by a bit that hangs on the greater of them.
    """

    some = F.greatest(n, F.lit(1))

    def round_(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(tag, r, F.lit(settings.seed)), some) + some - x, some)
        bit = F.xxhash64(tag, r, F.greatest(x, mirror), F.lit(settings.seed + 1)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(settings.rounds)), i, round_)


def targets(sources: DataFrame, settings: Settings) -> DataFrame:
    """``sources`` (name, source, size) with place, weight and target.

    A source's target is its weight's share of the mix, but at most ``most``
    times its size; what that leaves over is shared by weight among the rest.
    Sorted by the size that a unit of weight stands for, the limited sources
    come first, so one pass of running sums finds them. There is one row a
    source, not a document, in this pass.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    everyone = Window.partitionBy()
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in settings.weights)), (F.col("place") % len(settings.weights) + 1).cast("int"))
    rows = sources.withColumn("place", place).withColumn("weight", weight).withColumn("limit", F.col("size") * settings.most)
    rows = rows.withColumn("mix", F.sum("size").over(everyone) * settings.share)
    before = Window.orderBy(F.col("limit") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    left = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    rows = rows.withColumn("level", (F.col("mix") - left("limit")) / (F.sum("weight").over(everyone) - left("weight")))
    free = F.col("level") <= F.col("limit") / F.col("weight")
    return rows.withColumn("target", F.when(free, F.max(F.when(free, F.col("level"))).over(everyone) * F.col("weight")).otherwise(F.col("limit"))).drop("limit", "mix", "level")


def plan(sources: DataFrame, settings: Settings) -> DataFrame:
    """Targets, and how they are met: words wanted, blocks, whole passes through them, words beyond those, and slots."""
    size, step = F.col("size"), settings.block_words
    rows = targets(sources, settings).withColumn("wanted", F.least(F.round("target"), F.floor(size * settings.most)).cast("long"))
    rows = rows.withColumn("passes", F.when(size > 0, F.floor(F.col("wanted") / size)).otherwise(0).cast("long")).withColumn("rest", F.col("wanted") - F.col("passes") * size)
    rows = rows.withColumn("blocks", F.ceil(size / step).cast("long"))
    return rows.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / step).cast("long"))


def _ranges(sources: DataFrame, length: str, total: int) -> tuple[DataFrame, int]:
    """(key, low, high, name): intervals end to end, listed under every one of LOOKUPS equal ranges that they meet."""
    width = max(1, -(-total // LOOKUPS))
    ends = sources.where(F.col(length) > 0).select("name", F.sum(length).over(Window.orderBy("place")).alias("high"), (F.sum(length).over(Window.orderBy("place")) - F.col(length)).alias("low"))
    return ends.select("name", "low", "high", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))).alias("key")), width


def _owner(numbers: DataFrame, at: str, sources: DataFrame, length: str, total: int) -> DataFrame:
    """``numbers`` with the name of the source in whose interval their number lies, and the interval's beginning, low."""
    ranges, width = _ranges(sources, length, total)
    return numbers.withColumn("key", F.expr(f"{at} div {width}")).join(ranges, "key").where((F.col(at) >= F.col("low")) & (F.col(at) < F.col("high"))).drop("key", "high")


def draw(sources: DataFrame, total: int, settings: Settings) -> DataFrame:
    """(shard, name, n): how many slots of each shard fall to each source, by multinomial draws in proportion to the sources' slots."""
    spark = sources.sparkSession
    slots = spark.range(total).select(F.expr(f"id div {settings.shard_slots}").alias("shard"), F.pmod(F.xxhash64("id", F.lit(settings.seed)), F.lit(total)).alias("u"))
    return _owner(slots, "u", sources, "slots", total).groupBy("shard", "name").agg(F.count(F.lit(1)).alias("n"))


def _numbered(drawn: DataFrame) -> DataFrame:
    """``drawn`` with the number of its first slot within its source; sums of runs of shards first, so no task sums a source's shards alone."""
    run = F.expr(f"shard div {SHARD_RUN}")
    rows = drawn.withColumn("run", run)
    within = Window.partitionBy("name", "run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("name").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("name", "run").agg(F.sum("n").alias("n")).select("name", "run", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    first = F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return rows.join(runs, ["name", "run"]).select("name", "shard", "n", first.alias("first"))


def slots(sources: DataFrame, settings: Settings) -> DataFrame:
    """(shard, name, place, block, words): the words that each slot takes from the beginning of its block, all slots of the plan once."""
    total = int(sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0])
    drawn = cut(draw(sources, total, settings), "draws")
    numbered = _numbered(drawn)
    counted = sources.join(numbered.groupBy("name").agg(F.sum("n").alias("drawn")), "name", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    over, under = F.greatest(F.col("drawn") - F.col("slots"), F.lit(0)), F.greatest(F.col("slots") - F.col("drawn"), F.lit(0))
    counted = counted.withColumns({"over": over, "under": under}).withColumn("over_before", F.sum("over").over(Window.orderBy("place")) - F.col("over"))
    listed = numbered.select("name", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("i"))
    listed = listed.join(counted.select("name", "place", "slots", "drawn", "over_before"), "name").select("shard", "name", "slots", "over_before", permuted(F.col("i"), F.col("drawn"), F.col("place"), settings).alias("k"))
    own = listed.where("k < slots").select("shard", "name", "k")
    moved = listed.where("k >= slots").select("shard", (F.col("over_before") + F.col("k") - F.col("slots")).alias("u"))
    spare = int(counted.agg(F.coalesce(F.sum("under"), F.lit(0))).first()[0])
    moved = _owner(moved, "u", counted, "under", spare).join(counted.select("name", "drawn"), "name").select("shard", "name", (F.col("drawn") + F.col("u") - F.col("low")).alias("k"))
    return _blocks_of(own.unionAll(moved), sources, settings)


def _blocks_of(numbered: DataFrame, sources: DataFrame, settings: Settings) -> DataFrame:
    """Which block the k-th slot of a source takes: whole blocks in a new pseudorandom order each pass, the short one at its end."""
    rows = numbered.join(sources.select("name", "place", "size", "passes", "rest", "blocks"), "name")
    rows = rows.select("shard", "name", "place", "size", "passes", "rest", "blocks", F.expr("k div blocks").alias("pass"), (F.col("k") % F.col("blocks")).alias("j"), F.expr(f"size div {settings.block_words}").alias("whole"))
    shuffled = permuted(F.col("j"), F.greatest("whole", F.lit(1)), F.hash("place", "pass"), settings)
    block = F.when(F.col("j") < F.col("whole"), shuffled).otherwise(F.col("j"))
    # only the last pass can be cut short; before its j-th slot come j whole blocks
    wanted = F.when(F.col("pass") < F.col("passes"), settings.block_words).otherwise(F.least(F.col("rest") - F.col("j") * settings.block_words, F.lit(settings.block_words)))
    return rows.select("shard", "name", "pass", block.alias("block"), wanted.cast("long").alias("words"))


def count_words(text: Column) -> Column:
    """Words of a text; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass
class Mix:
    """documents (name, id, size, mark, copy, first): each with its first word's number within its source; sources: the plan; settings."""

    documents: DataFrame
    sources: DataFrame
    settings: Settings

    def pieces(self) -> DataFrame:
        """documents in pieces of one block each (block, low, high: words within the block; skipped: words of the document before)."""
        step = self.settings.block_words
        spans = self.documents.where("size > 0").select("*", F.explode(F.sequence(F.expr(f"first div {step}"), F.expr(f"(first + size - 1) div {step}"))).alias("block"))
        low = F.greatest(F.col("first") - F.col("block") * step, F.lit(0))
        return spans.select(
            "name", "id", "size", "mark", "copy", "block", low.alias("low"), F.least(F.col("first") + F.col("size") - F.col("block") * step, F.lit(step)).alias("high"),
            (F.col("block") * step + low - F.col("first")).alias("skipped"),
        )

    def taken_pieces(self) -> DataFrame:
        """(shard, name, block, pass, id, size, mark, copy, skipped, words): what the slots take of each document, words from its ``skipped``-th on."""
        met = self.pieces().join(slots(self.sources, self.settings), ["name", "block"])
        words = F.least("high", "words") - F.col("low")
        return met.where(words > 0).select("shard", "name", "block", "pass", "id", "size", "mark", "copy", "skipped", "low", words.alias("words"))


def lay_out(df: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", settings: Settings = Settings()) -> Mix:
    """Words counted, documents laid end to end, and the plan of the mix.

    Documents that agree in id, source, size and hash of their text are counted first and
    listed again at the end, so a document repeated ever so often is one row
    in between. A null source is a source of its own, and null ids, texts,
    empty texts and empty tables are allowed: a text without words is laid
    out nowhere. Other columns are left behind, whatever their names.
    """
    name = F.when(F.col(f"`{source}`").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(f"`{source}`").cast("string")))
    rows = df.select(name.alias("name"), F.col(f"`{id_column}`").alias("id"), count_words(F.col(f"`{text}`")).alias("size"), F.xxhash64(f"`{text}`").alias("mark"))
    keys = cut(rows.groupBy("name", "id", "size", "mark").agg(F.count(F.lit(1)).alias("copies")), "mix")
    slice_ = F.pmod(F.xxhash64("id", "mark"), F.lit(SLICES)).cast("int")
    keys = keys.withColumn("slice", slice_)
    words = F.col("size") * F.col("copies")
    sums = keys.groupBy("name", "slice").agg(F.sum(words).alias("words"))
    total = cut(sums.groupBy("name").agg(F.sum("words").alias("size")), "mix")
    original = F.when(F.col("name") != "-", F.expr("substring(name, 2)"))
    sources = cut(plan(total.select("name", original.alias("source"), "size"), settings), "mix")
    earlier = Window.partitionBy("name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("name", "slice", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("name", "slice").orderBy("id", "size", "mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = keys.withColumn("inside", F.coalesce(F.sum(words).over(within), F.lit(0))).join(offsets, ["name", "slice"])
    runs = placed.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPY_RUN}"))).alias("run"))
    copies = runs.select("*", F.explode(F.sequence(F.col("run") * COPY_RUN, F.least(F.col("run") * COPY_RUN + COPY_RUN, F.col("copies")) - 1)).alias("copy"))
    return Mix(copies.select("name", "id", "size", "mark", "copy", (F.col("base") + F.col("inside") + F.col("copy") * F.col("size")).alias("first")), sources, settings)


def mix(df: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", settings: Settings = Settings()) -> DataFrame:
    """(id, size, source, source_size, target, taken) of every document: the words that the mix takes of it, repeats counted; see ``lay_out``."""
    laid = lay_out(df, id_column, text, source, settings)
    key = ["name", "id", "size", "mark", "copy"]
    everyone = laid.documents.select(*key, F.lit(0).cast("long").alias("words"))
    counted = everyone.unionAll(laid.taken_pieces().select(*key, "words")).groupBy(*key).agg(F.sum("words").alias("taken"))
    sizes = laid.sources.select("name", "source", F.col("size").alias("source_size"), "target")
    return counted.join(sizes, "name").select(F.col("id").alias(id_column), "size", "source", "source_size", "target", "taken")


def mixed_texts(df: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", settings: Settings = Settings()) -> DataFrame:
    """(shard, place, source, id, skipped, words, text): the mix itself, pieces of texts in the order of their shard.

    Slots of a shard are ordered by hash, so that sources alternate. A piece's
    text is its words, joined by spaces. Pieces of documents that agree in id,
    source, size and 64-bit hash of their text take the text of one of them.
    """
    laid = lay_out(df, id_column, text, source, settings)
    name = F.when(F.col(f"`{source}`").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(f"`{source}`").cast("string")))
    given = df.select(name.alias("name"), F.col(f"`{id_column}`").alias("id"), F.xxhash64(f"`{text}`").alias("mark"), count_words(F.col(f"`{text}`")).alias("size"), F.col(f"`{text}`").alias("body"))
    one = given.where("size > 0").groupBy("name", "id", "size", "mark").agg(F.min("body").alias("body"))
    taken, other = laid.taken_pieces().alias("t"), one.alias("o")
    same = F.col("t.id").eqNullSafe(F.col("o.id")) & (F.col("t.name") == F.col("o.name")) & (F.col("t.size") == F.col("o.size")) & (F.col("t.mark") == F.col("o.mark"))
    met = taken.join(other, same).select("t.*", "o.body").join(laid.sources.select("name", "source"), "name")
    order = Window.partitionBy("shard").orderBy(F.hash("name", "block", "pass"), "name", "block", "pass", "low", "id", "mark", "copy")
    words = F.slice(F.regexp_extract_all("body", F.lit(WORD), F.lit(0)), (F.col("skipped") + 1).cast("int"), F.col("words").cast("int"))
    return met.select("shard", (F.row_number().over(order) - 1).alias("place"), "source", F.col("id").alias(id_column), "skipped", "words", F.array_join(words, " ").alias("text"))
