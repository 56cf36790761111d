"""Benchmark decontamination by a distributed positional inverted index.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. A benchmark item gives windows of ``size``
consecutive words; an item of fewer words, but not none, is one window.

1. The terms of all windows are counted over the whole corpus (partial sums before the shuffle).
2. Each window is looked up by its rarest term: the postings (document, position) of that term, less the term's offset in
   the window, are the places where the window may start. Common words never produce a posting list.
3. At each of these places the other terms' postings are intersected: the document's terms at the window's offsets
   must be the window's terms. What is left are exact phrase matches.
4. Matches become hit words (union of their intervals) and items per document.

The probes (one row per window) are broadcast only if their measured size is within a bound. Beyond it the postings
are shuffled by term, and the surviving places meet their documents again in a second join; skewed terms are split by
adaptive execution. Neither path drops a posting.

Cases: NULL or wordless texts have no words and no hits; wordless items have no window; repeated items and windows
count once; an item with a NULL id marks words but isn't counted as an item; rows that repeat a document (same id and
text) get the same answer each, and rows that share an id but not the text are judged apart; empty tables on either
side give no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffloom.llm.common import ascii_lower, broadcast_if_small, checkpointed

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13


def split_words(text: Column) -> Column:
    """Words in order. The first and the last entry may be empty (text that begins or ends with separators)."""
    return F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)


def n_words(words: Column) -> Column:
    ends = (F.element_at(words, 1) == "").cast("long") + ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("long")
    return F.size(words) - ends


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"),
        split_words(F.col(f"`{text}`")).alias("words"),
    )


def bench_windows(bench: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """item_id, phrase (the words, space-joined), terms."""
    words = F.filter(split_words(F.col(f"`{text}`")), lambda w: w != "")
    return (
        bench.select(F.col(f"`{item_id}`").alias("item_id"), words.alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))))
        .select("item_id", F.slice("words", F.col("at"), F.lit(size)).alias("terms"))
        .withColumn("phrase", F.array_join("terms", " "))
        .distinct()
    )


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Corpus count of each of ``terms`` (term) that occurs."""
    terms, _ = broadcast_if_small(terms, F.octet_length("term"))
    tokens = docs.select(F.explode("words").alias("term"))
    return tokens.join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))


def probes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """term, offset, phrase, terms: each distinct window under its rarest term. A window with an absent term is left out."""
    each = windows.select("phrase", "terms").distinct()
    placed = each.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    rarest = (
        placed.join(counts, "term")
        .groupBy("phrase", "size")
        .agg(F.count("*").alias("found"), F.min(F.struct("n", "offset", "term")).alias("rarest"))
        .filter("found = size")
    )
    return each.join(rarest, "phrase").select("rarest.term", "rarest.offset", "phrase", "terms")


def phrase_matches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, text_key, start, size, phrase: every occurrence of a window. ``docs`` as of ``keyed``."""
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    known = checkpointed(probes(windows, term_counts(docs, terms)))
    known, small = broadcast_if_small(known, F.octet_length("phrase") * 3)
    same = F.slice("words", F.col("start") + 1, F.size("terms")) == F.col("terms")
    out = ["doc_id", "text_key", "start", F.size("terms").alias("size"), "phrase"]
    start = F.col("pos") - F.col("offset")
    if small:
        postings = docs.select("doc_id", "text_key", "words", F.posexplode("words").alias("pos", "term"))
        places = postings.join(known, "term").withColumn("start", start).filter("start >= 0")
        return places.filter(same).select(*out)
    postings = docs.select("doc_id", "text_key", F.posexplode("words").alias("pos", "term"))
    places = postings.join(known, "term").withColumn("start", start).filter("start >= 0").drop("term", "pos", "offset")
    texts = docs.dropDuplicates(["doc_id", "text_key"]).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "words")
    met = places.join(texts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")))
    return met.filter(same).select(*out).distinct()


def proximity_matches(docs: DataFrame, bench: DataFrame, terms: int = 4, span: int = 30, doc_id: str = "doc_id",
                      text: str = "text", item_id: str = "item_id") -> DataFrame:
    """doc_id, text_key, item_id, pos: places whose last ``span`` words hold all of an item's ``terms`` rarest terms, in any
    order. Items with fewer distinct terms need all they have."""
    docs = keyed(docs, doc_id, text)
    words = bench.select(F.col(f"`{item_id}`").alias("item_id"), F.explode(F.array_distinct(F.filter(
        split_words(F.col(f"`{text}`")), lambda w: w != ""))).alias("term")).distinct()
    counts = term_counts(docs, words.select("term").distinct())
    order = Window.partitionBy("item_id").orderBy(F.coalesce("n", F.lit(0)), "term")
    rare = words.join(counts, "term", "left").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= terms)
    needed = rare.groupBy("item_id").agg(F.count("*").alias("needed"))
    rare = checkpointed(rare.join(needed, "item_id").select("term", "item_id", "needed"))
    rare, _ = broadcast_if_small(rare, F.octet_length("term"))
    near = Window.partitionBy("doc_id", "text_key", "item_id").orderBy("pos").rangeBetween(-span + 1, 0)
    postings = docs.select("doc_id", "text_key", F.posexplode("words").alias("pos", "term")).distinct()
    return (
        postings.join(rare, "term")
        .withColumn("near", F.size(F.collect_set("term").over(near)))
        .filter("near = needed").select("doc_id", "text_key", "item_id", "pos")
    )


def contamination(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, n_hit, n_items, items (ids as text, sorted, comma-joined)."""
    docs = keyed(docs, doc_id, text)
    windows = checkpointed(bench_windows(bench, item_id, "text", size))
    matches = checkpointed(phrase_matches(docs, windows))
    # union of the intervals: what each start adds beyond the furthest end before it
    before = Window.partitionBy("doc_id", "text_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    hits = (
        matches.groupBy("doc_id", "text_key", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
        .withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
        .groupBy("doc_id", "text_key").agg(F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).alias("n_hit"))
    )
    items = (
        matches.select("doc_id", "text_key", "phrase").distinct()
        .join(windows.select("phrase", F.col("item_id").cast("string").alias("item")), "phrase")
        .groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = hits.join(items, hits.doc_id.eqNullSafe(items.doc_id) & (hits.text_key == items.text_key)).select(
        hits.doc_id.alias("id"), hits.text_key.alias("key"), "n_hit", "items")
    rows = docs.select("doc_id", "text_key", n_words(F.col("words")).cast("long").alias("n_words"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
    )


def contaminated() -> Column:
    """The rule on the columns of ``contamination``: some hit, and at least a twentieth of the words."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def decontaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rule leaves, with their columns."""
    judged = contamination(docs, bench).filter(contaminated()).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    return docs.join(judged, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_key")), "left_anti")
