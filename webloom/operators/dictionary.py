"""Which words of a large dictionary occur in which texts, also inside other words.

Every word has an anchor: of its q-grams the one that fewest texts have. A text is cut into
its distinct q-grams, these meet the anchors by equality, and what meets is verified. So no
text meets every word, and the plan is the same for ten words and for ten million. A filter of
fixed size, bits of hashed grams, drops most grams of the texts where they are cut.

Defined results: null and empty words and null texts match nothing; repeated words count
once; several rows of one key are one document; words shorter than q are their own anchors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.session import stage_table

GRAM = 3
# The filter has 2**FILTER_BITS bits, in longs.
FILTER_BITS = 20


def _grams(text: Column, q: int) -> Column:
    """All q-grams in order; a lookahead finds overlapping ones in one pass."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{q}}}))"), F.lit(1))


def _slot(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(1 << FILTER_BITS))


def _filter_of(grams: DataFrame) -> DataFrame:
    """One row: the filter over ``grams`` (gram) as an array of longs."""
    slots = grams.select(_slot(F.col("gram")).alias("slot"))
    longs = slots.groupBy(F.shiftright("slot", 6).alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")
    )
    whole = grams.sparkSession.range(1 << (FILTER_BITS - 6)).join(longs, "id", "left")
    cells = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return stage_table(whole.agg(F.transform(cells, lambda c: c["bits"]).alias("bits")), "gram-filter")


def text_grams(docs: DataFrame, lengths: list[int], known: DataFrame) -> DataFrame:
    """(doc_key, gram): distinct grams of every text that the filter over ``known`` lets pass."""
    bits = _filter_of(known).select("bits").scalar()
    parts = [
        docs.select("doc_key", F.explode(F.array_distinct(_grams(F.col("text"), n))).alias("gram"))
        for n in lengths
    ]
    rows = reduce(lambda a, b: a.unionByName(b), parts).withColumn("slot", _slot(F.col("gram")))
    in_filter = F.getbit(F.get(bits, F.shiftright("slot", 6)), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))
    return rows.where(in_filter == 1).select("doc_key", "gram")


def word_grams(words: DataFrame, q: int) -> DataFrame:
    """(word, gram): the grams a word's anchor may be."""
    own = F.when(F.length("word") < q, F.array("word")).otherwise(F.array_distinct(_grams(F.col("word"), q)))
    return words.select("word", F.explode(own).alias("gram"))


def anchors(met: DataFrame, per_word: DataFrame) -> DataFrame:
    """(gram, word): the rarest gram of each word, counted over all texts.

    A word with a gram that no text has occurs nowhere and has no anchor.
    """
    freqs = met.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("rarest")
    best = per_word.join(freqs, "gram", "left").groupBy("word").agg(rarest)
    return best.where("rarest.n > 0").select("rarest.gram", "word")


def dictionary_join(docs: DataFrame, words: DataFrame, q: int = GRAM) -> DataFrame:
    """(doc_key, word) for every word of ``words`` (word) that stands in a text of ``docs``
    (doc_key, text)."""
    words = stage_table(words.where("word <> ''").select("word").distinct(), "dictionary-words")
    docs = docs.select("doc_key", "text").where("text IS NOT NULL")
    # At most q numbers.
    short = words.select(F.least(F.length("word"), F.lit(q)).alias("n")).distinct().collect()
    lengths = sorted(r["n"] for r in short)
    if not lengths:
        return docs.limit(0).join(words, F.lit(True)).select("doc_key", "word")
    per_word = stage_table(word_grams(words, q), "word-grams")
    # Texts are cut once; what the filter lets pass is at most a gram per place in a text.
    met = stage_table(text_grams(docs, lengths, per_word.select("gram").distinct()), "text-grams")
    chosen = stage_table(anchors(met, per_word), "anchors")
    # A frequent gram fills rows on the left, where the join splits it.
    candidates = stage_table(met.join(chosen, "gram").select("doc_key", "word"), "dictionary-candidates")
    found = candidates.join(docs, "doc_key").where(F.col("text").contains(F.col("word")))
    return found.select("doc_key", "word").distinct()


def tags_of(matches: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(doc_key, tag): tags of which a word was found; ``dictionary`` has (tag, word)."""
    return matches.join(dictionary, "word").select("doc_key", "tag").distinct()
