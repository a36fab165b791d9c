"""Source divergence audit: how far each source's words are from its language's and from other sources'.

Counts of terms become smoothed shares in whole billionths, and two shares p and q are (p - q)^2 / (p + q) apart, rounded down.

* Top terms of a group (a source within a language): its terms are put into buckets by count. A bucket's largest count and its
  least share in the language bound the value of every term in it, for the value grows with p and falls with q. Buckets are opened
  best bound first, twice as many in each round, until what isn't opened is bounded strictly below the last of the
  best terms. Rounds are Spark jobs over all groups at once.
* Pairs of sources: a sum over all kept terms. Where neither source has a term, all such terms give the same;
  where one has it, sources with equal counts give the same; where both have it, the term's posting list gives the pair's share,
  summed in small matrices in each task. So no row is made for a term that a source lacks.

Terms are counted in the tasks that read texts, so what is shuffled are sums. Shares are divided in three steps of three digits, which
keeps 64-bit arithmetic exact for up to 9 * 10^15 terms. A term's posting list has at most as many entries as its language has
sources, and the result has a row for each two of these: the number of sources of a language is what bounds this operator.

Defined results: null text, language and source are empty strings; a group without terms, and a language without kept ones, has pairs
(of value 0 if nothing is kept) but no terms; repeated rows are documents of their own; ties go to the smaller
item in UTF-8; very long texts are counted whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandlake.llm.runtime import drop, materialise, ship_code

MIN_DOCS = 10
TOP = 10
#: Different terms that a worker holds before it hands its counts on.
HELD = 200_000
#: Sources on a side of a matrix of pairs, and matrices that a worker holds.
SIDE = 256
MATRICES = 64

#: ASCII letters in lower case and all bytes of other letters stay; the rest parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

GROUP = ["lang", "source"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms in each group, as far as the worker has them."""
    seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    new = 0

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, source), (c, d) in seen.items():
            terms = pa.array(list(c), pa.binary()).cast(pa.string())
            counts = [pa.array(x, pa.int64()) for x in (list(c.values()), [d[t] for t in c])]
            yield pa.record_batch([pa.array([lang] * len(terms)), pa.array([source] * len(terms)), terms, *counts], ["lang", "source", "term", "c", "d"])
        seen.clear()

    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            cut = batch.slice(lo, 200)
            for lang, source, text in zip(cut.column("lang").to_pylist(), cut.column("source").to_pylist(), cut.column("text").cast(pa.binary()).to_pylist()):
                terms = text.translate(LETTERS).split()
                if not terms:
                    continue
                c, d = seen.setdefault((lang, source), (Counter(), Counter()))
                new -= len(c)
                c.update(terms)
                d.update(set(terms))
                new += len(c)
                if new > HELD:
                    yield from told()
                    new = 0
    yield from told()


def source_terms(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, c, d): occurrences of each term and documents with it."""
    ship_code(docs.sparkSession)
    own = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    rows = docs.select(own(lang_col, "lang"), own(source_col, "source"), own(text_col, "text"))
    found = rows.mapInArrow(_counted, "lang string, source string, term string, c long, d long")
    return found.groupBy(*GROUP, "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))


def share(count: str, whole: str) -> str:
    """SQL of 1 + floor(10^9 * (count + 2) / whole), without larger numbers on the way than 1000 * whole."""
    whole, rest, digits = f"greatest({whole}, 1)", f"({count} + 2)", []
    for _ in range(3):
        digits.append(f"(({rest} * 1000) div {whole})")
        rest = f"(({rest} * 1000) % {whole})"
    return f"(1 + {digits[0]} * 1000000 + {digits[1]} * 1000 + {digits[2]})"


def apart(p: str, q: str) -> str:
    """SQL of floor((p - q)^2 / (p + q))."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From posting lists (sources by number, their shares and shares of a term they lack): what each two sources
    in a list add, beyond what they would if the other lacked the term."""
    held: dict[tuple[str, int, int], np.ndarray] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, a, b), sums in held.items():
            i, j = np.nonzero(sums)
            if len(i):
                yield pa.record_batch([pa.array([lang] * len(i)), pa.array(i + a * SIDE), pa.array(j + b * SIDE), pa.array(sums[i, j])], ["lang", "i", "j", "both"])
        held.clear()

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    for batch in batches:
        lists = batch.column("list")
        flat, ends = lists.flatten(), lists.offsets.to_numpy()
        ks, ps, zs = (flat.field(n).to_numpy() for n in ("k", "p", "z"))
        for lang, lo, hi in zip(batch.column("lang").to_pylist(), ends.tolist(), ends[1:].tolist()):
            k, p, z = ks[lo - ends[0] : hi - ends[0]], ps[lo - ends[0] : hi - ends[0]], zs[lo - ends[0] : hi - ends[0]]
            sides = np.unique(k // SIDE).tolist() if len(k) and k[-1] >= SIDE else [0]
            for a in sides:
                x = slice(*np.searchsorted(k, (a * SIDE, (a + 1) * SIDE)))
                for b in sides[sides.index(a) :]:
                    y = slice(*np.searchsorted(k, (b * SIDE, (b + 1) * SIDE)))
                    if (lang, a, b) not in held and len(held) >= MATRICES:
                        yield from told()
                    sums = held.setdefault((lang, a, b), np.zeros((SIDE, SIDE), np.int64))
                    pa_, za, pb, zb = p[x, None], z[x, None], p[None, y], z[None, y]
                    sums[(k[x] % SIDE)[:, None], (k[y] % SIDE)[None, :]] += f(pa_, pb) - f(pa_, zb) - f(za, pb) + f(za, zb)
    yield from told()


def _pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language. Values are the same both ways."""
    numbered = materialise(groups.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).withColumn("z", F.expr(share("0", "n + 2 * v"))), "source-numbers")
    other = numbered.select("lang", F.col("source").alias("item"), F.col("k").alias("j"), F.col("z").alias("y"))
    # terms that one source has: the same for all terms of a count
    kinds = kept.groupBy(*GROUP, "c").agg(F.count(F.lit(1)).alias("terms")).join(numbered, GROUP).withColumn("p", F.expr(share("c", "n + 2 * v")))
    one = kinds.join(other, "lang").where("k <> j").groupBy("lang", "k", "j").agg(F.sum(F.expr(f"terms * ({apart('p', 'y')} - {apart('z', 'y')})")).alias("one"))
    one = one.groupBy("lang", F.least("k", "j").alias("k"), F.greatest("k", "j").alias("j")).agg(F.sum("one").alias("one"))
    # terms that both have
    entry = F.struct(F.col("k"), F.expr(share("c", "n + 2 * v")).alias("p"), F.col("z"))
    lists = kept.join(numbered, GROUP).groupBy("lang", "term").agg(F.sort_array(F.collect_list(entry)).alias("list")).where(F.size("list") > 1).select("lang", "list")
    both = lists.mapInArrow(_paired, "lang string, i long, j long, both long").where("i < j").groupBy("lang", F.col("i").cast("int").alias("k"), F.col("j").cast("int").alias("j")).agg(F.sum("both").alias("both"))
    halves = numbered.join(other, "lang").where("k < j").join(one, ["lang", "k", "j"], "left").join(both, ["lang", "k", "j"], "left")
    value = F.expr(f"v * {apart('z', 'y')}") + F.coalesce("one", F.lit(0)) + F.coalesce("both", F.lit(0))
    halves = halves.select("lang", "source", "item", value.alias("value"))
    return halves.unionByName(halves.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def count_bucket(c: Column) -> Column:
    """Counts up to 16 apart, then four buckets for each doubling."""
    return F.when(c <= 16, c).otherwise(F.floor(4 * F.log2(c)) + 1).cast("int")


def _best(found: DataFrame, top: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", place).where(F.col("rank") <= top)


def _terms(groups: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank) of each group's best terms."""
    scored = kept.withColumn("bucket", count_bucket(F.col("c"))).join(groups, GROUP)
    p, q = share("c", "n + 2 * v"), share("lc", "whole + 2 * v")
    sizes = scored.groupBy(*GROUP, "bucket").agg(*(F.max(x).alias(x) for x in ("c", "n", "v", "whole")), F.min("lc").alias("lc"))
    bounds = sizes.select(*GROUP, "bucket", F.expr(p).alias("p"), F.expr(q).alias("q")).where("p > q").select(*GROUP, "bucket", F.expr(apart("p", "q")).alias("bound"))
    bounds = materialise(bounds.withColumn("turn", F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("bound"), "bucket"))), "count-buckets")
    best, opened, step = None, 0, 1
    while True:
        wanted = bounds.where((F.col("turn") > opened) & (F.col("turn") <= opened + step))
        later = bounds.where(F.col("turn") > opened)
        if best is not None:
            last = best.where(F.col("rank") == top).select(*GROUP, F.col("value").alias("last"))
            open_ = lambda b: b.join(last, GROUP, "left").where("last is null or bound >= last")
            wanted, later = open_(wanted), open_(later)
            if later.isEmpty():
                return best
        found = scored.join(wanted.select(*GROUP, "bucket"), [*GROUP, "bucket"]).select(*GROUP, F.col("term").alias("item"), F.expr(p).alias("p"), F.expr(q).alias("q")).where("p > q").select(*GROUP, "item", F.expr(apart("p", "q")).alias("value"))
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        old, best = best, materialise(_best(found, top), "best-terms")
        if old is not None:
            drop(old)
        opened, step = opened + step, 2 * step


def divergence(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): other sources of the language ('pair') and the group's own terms ('term'),
    farthest first."""
    own = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    counts = materialise(source_terms(docs, text_col=text_col, lang_col=lang_col, source_col=source_col), "source-terms")
    terms = counts.groupBy("lang", "term").agg(F.sum("c").alias("lc"), F.sum("d").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term", "lc")
    kept = materialise(counts.join(terms, ["lang", "term"]).select(*GROUP, "term", "c", "lc"), "kept-terms")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lc").alias("whole"))
    totals = kept.groupBy(*GROUP).agg(F.sum("c").alias("n"))
    groups = docs.select(own(lang_col, "lang"), own(source_col, "source")).distinct().join(totals, GROUP, "left").join(langs, "lang", "left")
    groups = materialise(groups.select(*GROUP, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "v", "whole"))), "source-sizes")
    pairs = _best(_pairs(groups, kept), (1 << 31) - 1).withColumn("part", F.lit("pair"))
    columns = [*GROUP, "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")]
    return pairs.select(columns).unionByName(_terms(groups, kept, top).withColumn("part", F.lit("term")).select(columns))


def op12_divergence(docs: DataFrame) -> DataFrame:
    return divergence(docs)
