"""Benchmark decontamination with a positional inverted index (operator 4), in DataFrame functions only.

One pass over the documents stores a posting (document, position, term) for every word
that the benchmark has, and one for each document's end, whose position is the number of
words. How long a term's list is, is counted from what is stored. For each window of a
benchmark item the two terms with the shortest lists are taken: the rarest term's list
meets the item's place for it, which gives candidates (document, item, shift), and those
are intersected with the next rarest term's list, adjusted by its offset. What is left is
intersected with the lists of all of the item's terms, so each candidate has the places
where item and document agree; runs of at least a window's length are exact phrases. So a
common word's list is read for few documents, unless a window has no rarer one.

The documents are read once, however many terms the benchmark has. Terms are broadcast if
they are few (counted); otherwise words meet them by a shuffle, in which adaptive execution
splits frequent words. Every other join is on documents and positions.

Defined results: null text has no words. Repeated item rows count once, and rows of one
item id with different texts are one item; a null item id counts as empty text. Repeated
document rows get equal results. With an empty benchmark nothing is hit. Other columns are
carried.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, materialise, sized, sized_arrays

#: Consecutive words that make a window.
WINDOW = 10
#: What separates words, after lower-casing.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The term that every document ends with; no word is empty.
END, END_NO = "", -1


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(no, item, size, j, word): the words of each distinct item, in order; a number for each item id and text, and how many words a window of it has at most."""
    own = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w")).filter("size(w) > 0").distinct()
    numbered = own.select(F.monotonically_increasing_id().alias("no"), "item", "w")
    return numbered.select("no", "item", F.size("w").alias("size"), F.posexplode("w").alias("j", "word"))


class PositionalIndex:
    """Stored postings of the documents for the terms of the given items."""

    def __init__(self, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW):
        self.size = size
        plain = materialise(item_words(items, item_id_col, item_text_col), "item_words")
        numbered = plain.select("word").distinct().select("word", F.monotonically_increasing_id().alias("term"))
        end = docs.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(END_NO).cast("long").alias("term"))
        ends = F.concat(words(F.col(text_col)), F.array(F.lit(END)))
        terms = materialise(numbered.unionAll(end), "terms")
        tokens = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.posexplode(ends).alias("pos", "word"))
        #: (id, h, pos, term), with the document's end; h tells apart rows of one id.
        self.postings = materialise(tokens.join(sized(terms), "word").select("id", "h", "pos", "term"), "postings")
        #: (no, item, size, j, term)
        self.items = materialise(plain.join(terms, "word").select("no", "item", "size", "j", "term"), "items")
        #: A row for each document row.
        self.documents = self.postings.filter(F.col("term") == END_NO).select("id", "h", F.col("pos").cast("long").alias("n_words"))

    @cached_property
    def anchored(self) -> DataFrame:
        """(no, term, j, term2, j2): the rarest two terms of each window by their posting lists, each pair of places once. A window of one word has no second."""
        lists = self.postings.groupBy("term").agg(F.count("*").alias("n"))
        frame = Window.partitionBy("no").orderBy("j").rowsBetween(0, self.size - 1)
        rarest = F.slice(F.array_sort(F.collect_list(F.struct("n", "j", "term")).over(frame)), 1, 2)
        counted = self.items.join(lists, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        starts = counted.withColumn("two", rarest).filter(F.col("j") <= F.greatest(F.col("size") - self.size, F.lit(0)))
        one, two = F.get("two", F.lit(0)), F.get("two", F.lit(1))
        anchors = starts.filter(one["n"] > 0).select("no", one["term"].alias("term"), one["j"].alias("j"), two["term"].alias("term2"), two["j"].alias("j2"))
        return materialise(anchors.distinct(), "anchors")

    @cached_property
    def candidates(self) -> DataFrame:
        """(id, h, no, shift): where the lists of a window's two rarest terms meet; an item's word j would stand at shift + j, which is below 0 for words that a document starts after."""
        first = self.postings.join(sized(self.anchored), "term").select("id", "h", "no", (F.col("pos") - F.col("j")).alias("shift"), "term2", "j2")
        seconds = self.anchored.select("term2").distinct().withColumnRenamed("term2", "term")
        second = self.postings.join(sized(materialise(seconds, "second_terms")), "term", "left_semi").select(F.col("id").alias("id2"), F.col("h").alias("h2"), F.col("pos").alias("pos2"), F.col("term").alias("list2"))
        at = F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")) & (F.col("shift") + F.col("j2") == F.col("pos2")) & (F.col("term2") == F.col("list2"))
        both = first.filter("term2 is not null").join(second, at, "left_semi").select("id", "h", "no", "shift")
        alone = first.filter("term2 is null").select("id", "h", "no", "shift")
        return materialise(both.unionAll(alone).distinct(), "candidates")

    def phrases(self) -> DataFrame:
        """(id, h, item, start, length): the longest runs of an item's words in a document, each of a window's length at least."""
        own = ["id", "h", "no", "shift"]
        some = materialise(self.candidates.select(F.col("id").alias("id2"), F.col("h").alias("h2")).distinct(), "candidate_documents")
        here = F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2"))
        lists = self.postings.join(sized(some), here, "left_semi").select(F.col("id").alias("id2"), F.col("h").alias("h2"), F.col("pos").alias("pos2"), F.col("term").alias("term2"))
        wanted = self.candidates.join(sized(self.items), "no")
        agree = here & (F.col("shift") + F.col("j") == F.col("pos2")) & (F.col("term") == F.col("term2"))
        met = wanted.join(lists, agree, "left_semi").select(*own, "item", "size", "j")
        runs = met.withColumn("run", F.col("j") - F.row_number().over(Window.partitionBy(*own).orderBy("j")))
        found = runs.groupBy(*own, "item", "size", "run").agg(F.min("j").alias("j"), F.count("*").alias("length"))
        return found.filter(F.col("length") >= F.least(F.col("size"), F.lit(self.size))).select("id", "h", "item", (F.col("shift") + F.col("j")).alias("start"), "length")

    def nearby(self) -> DataFrame:
        """(id, h, item, pos): every place of a window's rarest term that has all its other words within a window's reach, in any order."""
        lists = self.postings.groupBy("term").agg(F.count("*").alias("n"))
        frame = Window.partitionBy("no").orderBy("j").rowsBetween(0, self.size - 1)
        counted = self.items.join(lists, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        starts = counted.withColumn("all", F.array_sort(F.collect_list(F.struct("n", "j", "term")).over(frame))).filter(F.col("j") <= F.greatest(F.col("size") - self.size, F.lit(0)))
        windows = starts.filter(F.get("all", F.lit(0))["n"] > 0).select("item", F.get("all", F.lit(0))["term"].alias("term"), F.array_distinct(F.transform("all", lambda x: x["term"])).alias("terms")).distinct()
        windows = materialise(windows.select(F.monotonically_increasing_id().alias("window"), "*"), "windows")
        block = F.floor(F.col("pos") / self.size)
        first = self.postings.join(windows, "term").select("id", "h", "window", "item", "pos", F.size("terms").alias("n_terms"), F.explode("terms").alias("want"), block.alias("block"))
        first = first.withColumn("block", F.explode(F.array(F.col("block") - 1, "block", F.col("block") + 1)))
        second = self.postings.select(F.col("id").alias("id2"), F.col("h").alias("h2"), F.col("pos").alias("pos2"), F.col("term").alias("want"), block.alias("block"))
        near = first.join(second, ["want", "block"]).filter(F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")) & (F.abs(F.col("pos") - F.col("pos2")) < self.size))
        met = near.groupBy("id", "h", "window", "item", "pos", "n_terms").agg(F.count_distinct("want").alias("n"))
        return met.filter("n = n_terms").select("id", "h", "item", "pos").distinct()


def hit_documents(index: PositionalIndex) -> DataFrame:
    """(id, h, n_hit, items) for each document with an occurrence of a window."""
    grouped = index.phrases().groupBy("id", "h").agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    places = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"].cast("int") - 1))))
    return materialise(grouped.select("id", "h", F.size(places).cast("long").alias("n_hit"), "items"), "hits")


def contamination_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    index = PositionalIndex(docs, items, id_col, text_col, item_id_col, item_text_col)
    hits = hit_documents(index).withColumnsRenamed({"id": "hit_id", "h": "hit_h"})
    own = index.documents.join(sized_arrays(hits, "items"), F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("h") == F.col("hit_h")), "left")
    found = F.coalesce("items", F.array().cast("array<string>"))
    return own.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.array_join(found, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs in which no window occurs, with all their columns."""
    index = PositionalIndex(docs, items, id_col, text_col, item_id_col, item_text_col)
    own, by_id, by_h = fresh(docs, "h_"), fresh(docs, "hit_id"), fresh(docs, "hit_h")
    hits = hit_documents(index).select(F.col("id").alias(by_id), F.col("h").alias(by_h))
    return docs.withColumn(own, F.xxhash64(text_col)).join(sized(hits), F.col(id_col).eqNullSafe(F.col(by_id)) & (F.col(own) == F.col(by_h)), "left_anti").drop(own)
