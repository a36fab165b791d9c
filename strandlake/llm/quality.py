"""Quality rules with cross-document line frequency, in built-in functions only.

Rules on a text by itself: its words (runs without ASCII white space), symbols, repeated
lines and words in repeated three-word windows. A text fails them with fewer than
``MIN_WORDS`` words or over ``REPEAT_PERCENT`` percent of its words in repeated windows.

Rules across documents: lines are normalised (stripped, in lower case) and hashed; for each line
and host the distinct documents that have it are counted, equal texts once. A line that at least
``LINE_DOCS`` of a host's documents and over ``LINE_PERCENT`` percent of them have is boilerplate
there and is removed. A document that loses lines is depleted, and rejected, if fewer than
``MIN_WORDS`` words or less than ``LEFT_PERCENT`` percent of its lines' code points are left.

Windows are compared by a 64-bit hash within one text, lines by one within a host.

Defined results: a null text has no words and no lines and fails, and stays null; an empty one is one
line without a word; a null host is a host of its own; rows with the same id are judged apart, and
count once for a host if their texts are equal; a line in exactly ``LINE_DOCS`` documents is within the
first limit, one in exactly ``LINE_PERCENT`` percent isn't over the second; very long texts are
taken whole; an empty table gives no rows. ``judge`` keeps just its own columns; ``keep_good`` passes all
columns on, whatever their names, the text without its boilerplate lines. The id has to be a
number or a text that is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import doc_key, materialise

MIN_WORDS = 50
REPEAT_PERCENT = 50
LINE_DOCS = 5
LINE_PERCENT = 10
LEFT_PERCENT = 80

BLANK = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def _repeat_words(docs: DataFrame) -> DataFrame:
    """n_repeat_words of column __words: words in three-word windows found twice or more.

    Windows are sorted by hash and place; neighbours with the same hash are repeats. Their
    places, sorted again, cover three words each, less what the one before covers.
    """
    hashed = docs.withColumn("__grams", F.expr("case when size(__words) >= 3 then slice(transform(__words, (w, i) -> xxhash64(w, get(__words, i + 1), get(__words, i + 2))), 1, size(__words) - 2) else cast(array() as array<bigint>) end"))
    # most texts have no repeated window: they need no sort
    some = hashed.withColumn("__some", F.size(F.array_distinct("__grams")) < F.size("__grams"))
    sorted_ = some.withColumn("__sorted", F.expr("case when __some then sort_array(transform(__grams, (g, i) -> struct(g as g, i as i))) end"))
    places = sorted_.withColumn("__places", F.expr("sort_array(transform(filter(__sorted, (s, k) -> s.g <=> get(__sorted, k - 1).g or s.g <=> get(__sorted, k + 1).g), s -> s.i))"))
    counted = places.withColumn("n_repeat_words", F.coalesce(F.expr("aggregate(transform(__places, (p, k) -> case when k = 0 then 3 else least(3, p - get(__places, k - 1)) end), 0L, (a, x) -> a + x)"), F.lit(0).cast("long")))
    return counted.drop("__grams", "__some", "__sorted", "__places")


def text_rules(docs: DataFrame, *, text_col: str = "text", min_words: int = MIN_WORDS, repeat_percent: int = REPEAT_PERCENT) -> DataFrame:
    """The columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    worded = docs.withColumn("__words", words_of(text))
    lined = worded.withColumn("__lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    counted = _repeat_words(lined)
    n_words = F.size("__words").cast("long")
    return (
        counted.withColumn("n_words", n_words)
        .withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("line_chars", F.expr("aggregate(__lines, 0L, (a, x) -> a + length(btrim(x, ' \t\x0b\x0c\r')))"))
        .withColumn("base_failed", (n_words < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * n_words))
        .drop("__words", "__lines")
    )


#: What a strip removes from both ends of a line.
ENDS = " \t\x0b\x0c\r"


def _line_key(host: Column, line: Column) -> Column:
    """Hashes the host and the normalised line; null for a blank one."""
    x = F.btrim(F.lower(line), F.lit(ENDS))
    return F.when(x != "", F.xxhash64(host, x))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, copy, host, line): each text's distinct lines that aren't blank."""
    keys = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), lambda x: _line_key(F.col("host"), x)), lambda k: k.isNotNull()))
    return docs.select("doc", "copy", "host", F.explode(keys).alias("line"))


def boilerplate(docs: DataFrame, *, line_docs: int = LINE_DOCS, line_percent: int = LINE_PERCENT) -> DataFrame:
    """(line): lines whose frequency in their host is above the limits. ``docs``: (doc, copy, host, text).

    Both counts are pre-aggregated before each shuffle; a line in a third of all documents
    reaches its last task as one row from each.
    """
    hosts = docs.select("host", "copy").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs")).withColumnRenamed("host", "h")
    seen = _lines(docs).groupBy("line", "copy").agg(F.min("host").alias("host"))
    often = seen.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("host").alias("host")).where(F.col("n") >= line_docs)
    return often.join(hosts, F.col("host").eqNullSafe(F.col("h"))).where(100 * F.col("n") > line_percent * F.col("host_docs")).select("line")


def _own(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> list[Column]:
    host = F.col(host_col).cast("string")
    return [doc_key(id_col).alias("doc"), F.xxhash64(host, F.coalesce(text_col, F.lit(""))).alias("copy"), host.alias("host"), F.coalesce(text_col, F.lit("")).alias("text")]


def _without(text: Column, host: Column, lost: Column) -> Column:
    """The text without its lines whose key is in ``lost``."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.coalesce(F.array_contains(lost, _line_key(host, x)), F.lit(False))), "\n")


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", left_percent: int = LEFT_PERCENT, line_docs: int = LINE_DOCS, line_percent: int = LINE_PERCENT, min_words: int = MIN_WORDS, **rules) -> DataFrame:
    """For each row doc_id, the text rules' columns, lost (keys of its lines that are boilerplate, null: none),
    left_words and left_chars (of what stays), depleted and kept."""
    own = docs.select(F.col(id_col).alias("doc_id"), *_own(docs, id_col, text_col, host_col))
    common = materialise(boilerplate(own, line_docs=line_docs, line_percent=line_percent), "boilerplate")
    # every occurrence by its place; lines, not texts, meet the boilerplate, and only those found are measured
    each = own.select("doc", "copy", F.posexplode(F.transform(F.split("text", "\n"), lambda x: F.struct(_line_key(F.col("host"), x).alias("line"), x.alias("x")))).alias("i", "e"))
    hit = each.select("doc", "copy", "i", F.col("e.line").alias("line"), F.col("e.x").alias("x")).where("line is not null").join(common, "line")
    once = hit.groupBy("doc", "copy", "i").agg(F.min("line").alias("line"), F.max(F.length(F.btrim("x", F.lit(ENDS)))).alias("chars"), F.max(F.regexp_count("x", F.lit(r"[^\x20\x09-\x0D]+"))).alias("words"))
    lost = once.groupBy("doc", "copy").agg(F.collect_set("line").alias("lost"), F.sum("chars").alias("lost_chars"), F.sum("words").alias("lost_words"))
    # written first: a filter on the result would otherwise be moved into the rules' expressions,
    # which then run anew for every element of every array
    ruled = materialise(text_rules(own, min_words=min_words, **rules).drop("text", "host"), "text-rules")
    joined = ruled.join(lost, ["doc", "copy"], "left").withColumns({"left_words": F.col("n_words") - F.coalesce("lost_words", F.lit(0)), "left_chars": F.col("line_chars") - F.coalesce("lost_chars", F.lit(0))})
    depleted = F.col("lost").isNotNull() & ((F.col("left_words") < min_words) | (100 * F.col("left_chars") < left_percent * F.col("line_chars")))
    return joined.withColumn("depleted", depleted).withColumn("kept", ~F.col("base_failed") & ~depleted)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows that are kept, with all their columns, and their texts without boilerplate lines."""
    id_col, text_col, host_col = options.get("id_col", "doc_id"), options.get("text_col", "text"), options.get("host_col", "source")
    told = judge(docs, **options).where("not kept or lost is not null").select("doc", "copy", "kept", "lost").dropDuplicates(["doc", "copy"])
    doc, copy, host, _ = _own(docs, id_col, text_col, host_col)
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), doc, copy, host)
    good = held.join(told, ["doc", "copy"], "left").where(F.coalesce("kept", F.lit(True)))
    text = F.when(F.col("lost").isNull(), F.col("row")[text_col]).otherwise(_without(F.col("row")[text_col], F.col("host"), F.col("lost")))
    return good.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))


def op4_quality(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
