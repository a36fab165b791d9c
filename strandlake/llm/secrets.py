"""Secret scans in built-in functions only: patterns and a battery of randomness tests.

Three kinds are patterns: assignments to a password-like name (the value has 8 characters or
more), access keys, and long runs of hexadecimal digits. Matches are leftmost and don't
overlap within a kind.

The fourth kind, ``random``, comes from tests on every run of ``TOKEN_CHARS`` or more characters
of the Base64 alphabets (cut at the marks that end words). Its encoding is inferred from
its characters: decimal, hexadecimal, Base32, letters and digits of one case, or Base64.
Three statistics are compared with what words of the same texts give under the same alphabet. For
each token the words around it, written as one string (capitals at word starts where the alphabet has both
cases), are its control; the controls of all texts together are the null hypothesis "words":

* chi-squared against a uniform alphabet of k: its excess a character in controls sets the mean
  k - 1 + n * excess and the spread of words of n characters (``EXCESS`` counts as some controls
  more); the p-value is the lower tail;
* the Wald-Wolfowitz runs test about the middle of the alphabet, and the serial correlation of
  neighbouring characters, both in standard errors: the p-value is the share of controls that are
  as near to randomness, or nearer.

The three p-values are combined by Fisher's sum with Brown's correction for their
correlation in the controls. Benjamini and Hochberg's step-up rule over all tokens of all texts, in
classes of length, controls the share of false discoveries at ``FDR``: the p-values are counted on a fixed
logarithmic grid, whose size doesn't depend on the texts, the number of words in a class is estimated from
its p-values over a half (Storey), and each class gets the largest level at which the expected
number of words is within the share.

Defined results: a null text is empty and has no span; rows with the same id are scanned apart;
equal tokens in many rows count as often as they occur; without any control (no words around
tokens) chi-squared alone speaks, with ``EXCESS`` for words; very long texts are scanned whole, in a time that
grows with their length; an empty table gives no rows; other columns are ignored. The id has to
be a number or a text that is one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import doc_key, materialise

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
TOKEN_CHARS = 20
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{TOKEN_CHARS},}}"
MIN_ASSIGN, MIN_ACCESS = 8, 16
FDR = 0.01
#: Bits of the p-value grid: level -j stands for p <= 2^-j.
GRID = 200
#: Where no control speaks: chi-squared's excess a character in words, as a share of the alphabet's size.
EXCESS = 0.04
#: What is assumed about words counts as so many controls.
ASSUMED = 20
#: Steps of the grid of standard errors, to one, and its end; a statistic that isn't defined stands there.
STEPS, FAR = 8, 10
#: Characters around a token, to each side, that its control is taken from, as a multiple of its length.
AROUND = 4
SPANS = "array<struct<start:int,stop:int,kind:string,value:string>>"


def _with(x: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(x), body), 1)


def running(lengths: Column) -> Column:
    """Running sums of an array of integers, in blocks of its root's size: no long array is built up step by step."""
    add = lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    zero = F.array(F.lit(0))

    def of(v: Column) -> Column:
        size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v))).cast("int"))
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / size).cast("int") - 1), lambda b: F.aggregate(F.slice(v, b * size + 1, size), zero, add))
        before = lambda bs: F.aggregate(bs, zero, lambda a, x: add(a, F.element_at(x, -1)))
        joined = lambda bs: _with(before(bs), lambda o: F.flatten(F.transform(bs, lambda x, k: F.transform(F.slice(x, 2, F.size(x) - 1), lambda y: y + F.get(o, k)))))
        return F.when(F.size(v) > 0, _with(blocks, joined)).otherwise(F.expr("cast(array() as array<int>)"))

    return _with(lengths, of)


def spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost matches that don't overlap: array of (start, stop, kind, value), code points, end exclusive.

    Between the matches lie the pieces that a split leaves; lengths add up to offsets.
    """
    whole = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    value = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(2)) if group else whole
    gaps = F.split(text, pattern, -1)

    def of(x: Column) -> Column:
        steps = F.slice(F.zip_with(x["gaps"], x["whole"], lambda g, w: F.length(g) + F.length(w)), 1, F.size(x["whole"]))
        ends = F.arrays_zip(running(steps).alias("stop"), x["whole"].alias("whole"), x["value"].alias("value"))
        told_ = F.transform(ends, lambda e: F.struct((e["stop"] - F.length(e["whole"])).alias("start"), e["stop"].alias("stop"), F.lit(kind).alias("kind"), e["value"].alias("value")))
        return F.filter(told_, lambda e: F.length(e["value"]) >= least)

    return _with(F.struct(gaps.alias("gaps"), whole.alias("whole"), value.alias("value")), of)


def _searched(text: Column, pattern: str, kind: str, **options) -> Column:
    """Only texts with a match are taken apart."""
    none = F.expr(f"cast(array() as {SPANS})")
    return F.when(text.rlike(pattern), spans(text, pattern, kind, **options)).otherwise(none)


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with assign, access and hex: their spans."""
    text = F.col(text_col)
    return docs.withColumns({
        "assign": _searched(text, ASSIGN, "assign", group=2, least=MIN_ASSIGN),
        "access": _searched(text, ACCESS, "access", least=MIN_ACCESS),
        "hex": _searched(text, HEX, "hex"),
    })


def alphabet(value: Column) -> Column:
    """The size of the smallest usual alphabet that has all the characters."""
    plain = F.regexp_replace(value, "=+$", "")
    return (
        F.when(plain.rlike("^[0-9]+$"), 10)
        .when(plain.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16)
        .when(plain.rlike("^[A-Z2-7]+$"), 32)
        .when(plain.rlike("^([a-z0-9]+|[A-Z0-9]+)$"), 36)
        .when(plain.rlike("^[A-Za-z0-9]+$"), 62)
        .otherwise(64)
    )


def control(near: Column, k: Column) -> Column:
    """The words of a stretch of text as one string of letters, in the case that the alphabet asks for."""
    words = F.regexp_replace(F.regexp_replace(near, TOKEN, " "), "[^A-Za-z]+", " ")
    return F.regexp_replace(F.when(k >= 62, F.initcap(words)).when(k == 32, F.upper(words)).otherwise(F.lower(words)), " ", "")


def statistics(values: DataFrame) -> DataFrame:
    """The columns of ``values`` (with ``value`` and k) and n, chi2, runs and serial: the latter two in standard errors, FAR at most."""
    chars = values.withColumn("c", F.expr("transform(split(regexp_replace(value, '=+$', ''), ''), x -> ascii(x))"))
    # the place in the alphabet, digits first; capitals and small letters apart only where both occur
    placed = chars.withColumn("v", F.expr("""transform(c, x -> pmod(case when x between 48 and 57 then x - 48
        when x between 65 and 90 then if(k = 32, x - 65, x - 55) when x between 97 and 122 then if(k in (10, 16, 36), x - 87, x - 61) else if(x in (43, 45), 62, 63) end, k))"""))
    counted = placed.withColumn("n", F.size("v")).withColumn("sorted", F.sort_array("v"))
    # the sum of squared counts: each run of r equal values in order adds r^2 = the sum of 2j - 1 over its places j
    squares = F.expr("aggregate(sorted, struct(-1 as last, 0 as j, 0L as s), (a, x) -> struct(x as last, if(x = a.last, a.j + 1, 1) as j, a.s + 2 * if(x = a.last, a.j + 1, 1) - 1 as s), a -> a.s)")
    chi = counted.withColumn("chi2", F.col("k") * squares.cast("double") / F.col("n") - F.col("n"))
    middle = chi.withColumn("high", F.expr("transform(v, x -> if(2 * x >= k, 1, 0))")).withColumn("n1", F.expr("aggregate(high, 0, (a, x) -> a + x)").cast("double"))
    n, n1 = F.col("n").cast("double"), F.col("n1")
    n0 = n - n1
    runs = F.expr("1 + size(filter(transform(high, (x, i) -> x <> get(high, i - 1)), x -> x))").cast("double")
    mean = 1 + 2 * n1 * n0 / n
    var = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))
    far = lambda z: F.least(F.abs(z), F.lit(float(FAR)))
    ran = middle.withColumn("runs", F.when((n < 2) | (n1 == 0) | (n0 == 0), F.lit(float(FAR))).otherwise(far((runs - mean) / F.sqrt(var))))
    centre = ran.withColumn("m", F.expr("aggregate(v, 0L, (a, x) -> a + x)") / n)
    sums = centre.withColumn("ss", F.expr("aggregate(v, 0D, (a, x) -> a + (x - m) * (x - m))")).withColumn("cs", F.expr("aggregate(transform(v, (x, i) -> if(i = 0, 0D, (x - m) * (v[i - 1] - m))), 0D, (a, x) -> a + x)"))
    serial = sums.withColumn("serial", F.when(F.col("ss") > 0, far(F.col("cs") / F.col("ss") * F.sqrt(n) + 1 / F.sqrt(n))).otherwise(float(FAR)))
    return serial.drop("c", "v", "sorted", "high", "n1", "m", "ss", "cs")


def _gap(excess: Column) -> Column:
    """Standard errors by which chi-squared lies below that of words, by the spread of a non-central distribution."""
    k, n = F.col("k").cast("double"), F.col("n").cast("double")
    return (k - 1 + n * excess - F.col("chi2")) / F.sqrt(2 * (k - 1) + 4 * n * excess)


class Null:
    """What controls, all of them, say about words: numbers of a fixed count, by alphabet."""

    def __init__(self, controls: DataFrame):
        known = controls.where("n >= 2")
        by_k = known.groupBy("k").agg(F.sum((F.col("chi2") - F.col("k") + 1) / F.col("n")).alias("s"), F.count(F.lit(1)).alias("m")).collect()
        self.excess = {r["k"]: max((r["s"] + ASSUMED * EXCESS * r["k"]) / (r["m"] + ASSUMED), 1e-3) for r in by_k}
        gap = _gap(self._of_k(self.excess, lambda k: EXCESS * k))
        told_ = known.withColumn("gap", gap)
        self.spread = {r["k"]: max(1.0, math.sqrt((r["s"] + ASSUMED) / (r["m"] + ASSUMED))) for r in told_.groupBy("k").agg(F.sum(F.col("gap") * F.col("gap")).alias("s"), F.count(F.lit(1)).alias("m")).collect()}
        self.below = {name: self._shares(known, name) for name in ("runs", "serial")}
        pairs = [("gap", "runs"), ("gap", "serial"), ("runs", "serial")]
        names = sorted({x for p in pairs for x in p})
        found = told_.agg(*(F.covar_pop(a, b).alias(f"{a}_{b}") for a, b in pairs), *(F.stddev_pop(x).alias(x) for x in names)).first()

        def rho(a: str, b: str) -> float:
            spread = (found[a] or 0.0) * (found[b] or 0.0)
            return found[f"{a}_{b}"] / spread if spread > 0 else 0.0

        # a large gap and a small error say the same
        usable = [-rho(*pairs[0]), -rho(*pairs[1]), rho(*pairs[2])]
        var = 12 + 2 * sum(3.263 * r + 0.710 * r * r + 0.027 * r**3 for r in usable if r > 0)
        #: Brown: the sum is like ``scale`` times a chi-squared of ``freedom`` degrees (even, rounded down).
        self.scale, self.freedom = var / 12, max(2, int(72 / var) // 2 * 2)

    @staticmethod
    def _of_k(by_k: dict[int, float], other) -> Column:
        out = F.lit(0.0)
        for k in (10, 16, 32, 36, 62, 64):
            out = F.when(F.col("k") == k, F.lit(float(by_k.get(k, other(k))))).otherwise(out)
        return out

    @staticmethod
    def _shares(known: DataFrame, name: str) -> dict[int, list[float]]:
        """For each alphabet the share of controls up to each step of the grid, one more than there are counted far."""
        counts: dict[int, list[int]] = {}
        for r in known.groupBy("k", F.floor(F.col(name) * STEPS).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("m")).collect():
            counts.setdefault(r["k"], [0] * (STEPS * FAR + 1))[r["bin"]] += r["m"]
        return {k: [(1 + sum(own[: b + 1])) / (1 + sum(own)) for b in range(len(own))] for k, own in counts.items()}

    def _level(self, name: str) -> Column:
        """-ln p of a statistic in standard errors: the share of controls as near to randomness."""
        out = F.lit(0.0)
        for k, shares in self.below[name].items():
            at = F.get(F.array(*(F.lit(-math.log(x)) for x in shares)), F.floor(F.col(name) * STEPS).cast("int"))
            out = F.when(F.col("k") == k, at).otherwise(out)
        return out

    def judge(self, tested: DataFrame) -> DataFrame:
        """The columns of ``tested`` (statistics of tokens) and p_chi, p_runs, p_serial (as -ln p) and level: -log2 of the combined p-value."""
        gap = _gap(self._of_k(self.excess, lambda k: EXCESS * k)) / self._of_k(self.spread, lambda k: 1.0)
        # the lower tail of a normal distribution, by Mills' bound on its logarithm
        chi = F.when(gap <= 0.5, F.lit(0.0)).otherwise(gap * gap / 2 + F.log(gap * F.lit(2.5066282746)))
        out = tested.withColumn("p_chi", F.greatest(chi, F.lit(0.0))).withColumn("p_runs", self._level("runs")).withColumn("p_serial", self._level("serial"))
        half = (F.col("p_chi") + F.col("p_runs") + F.col("p_serial")) / self.scale
        tail = {2: F.lit(1.0), 4: 1 + half, 6: 1 + half + half * half / 2}[self.freedom]
        return out.withColumn("level", F.greatest((half - F.log(tail)) / math.log(2), F.lit(0.0)))


def length_class(n: Column) -> Column:
    """Lengths by powers of two."""
    return F.floor(F.log2(n.cast("double"))).cast("int")


def levels(tested: DataFrame, fdr: float = FDR) -> DataFrame:
    """(class, least): for each class of length the least -log2 p that is a discovery."""
    binned = tested.select(length_class(F.col("n")).alias("class"), F.least(F.floor("level"), F.lit(GRID)).cast("int").alias("bin")).groupBy("class", "bin").agg(F.count(F.lit(1)).alias("m"))
    # words among all: twice as many as have a p-value over a half (Storey's estimate), one more, all at most
    total = binned.groupBy("class").agg(F.least(F.sum("m"), 2 * F.sum(F.when(F.col("bin") < 1, F.col("m")).otherwise(0)) + 1).alias("total"))
    # at least as many discoveries as m(j) tokens at level j or higher; words among them: total * 2^-j
    tail = binned.alias("a").join(binned.alias("b"), (F.col("a.class") == F.col("b.class")) & (F.col("b.bin") >= F.col("a.bin"))).groupBy(F.col("a.class").alias("class"), F.col("a.bin").alias("bin")).agg(F.sum("b.m").alias("found"))
    ok = tail.join(total, "class").where(F.col("total") * F.pow(F.lit(2.0), -F.col("bin")) <= fdr * F.col("found"))
    return ok.groupBy("class").agg(F.min("bin").alias("least"))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """For each row doc_id and spans: array of (start, order, stop, kind, value), sorted.

    ``order`` numbers the kinds: assign, access, hex, random. A random span that overlaps one
    of the others isn't told again.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), doc_key(id_col).alias("doc"), F.xxhash64(text_col).alias("copy"), F.coalesce(text_col, F.lit("")).alias("text"))
    based = base_spans(own.withColumn("random", _searched(F.col("text"), TOKEN, "random")))
    shape = "struct(x.start as start, {} as order, x.stop as stop, x.kind as kind, x.value as value)"
    joined = F.expr("concat({})".format(", ".join(f"transform({k}, x -> {shape.format(i)})" for i, k in enumerate(("assign", "access", "hex")))))
    # only candidates outside base spans are kept, with the text around them for their controls
    free = F.filter("random", lambda x: ~F.exists("base", lambda b: (b["start"] < x["stop"]) & (b["stop"] > x["start"])))
    wide = lambda x: AROUND * (x["stop"] - x["start"])
    near = lambda x: F.concat(F.substring("text", F.greatest(F.lit(1), x["start"] + 1 - wide(x)), F.least(x["start"], wide(x))), F.lit(" "), F.substring("text", x["stop"] + 1, wide(x)))
    kept = based.withColumn("base", F.sort_array(joined)).withColumn("random", F.transform(free, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"), near(x).alias("near"))))
    found = materialise(kept.select("doc_id", "doc", "copy", "base", "random"), "secrets")
    tokens = found.where(F.size("random") > 0).select("doc", "copy", F.explode("random").alias("x")).select("doc", "copy", F.lit("random").alias("kind"), "x.*").withColumn("k", alphabet(F.col("value")))
    controls = materialise(statistics(tokens.select("k", control(F.col("near"), F.col("k")).alias("value")).where("value <> ''")), "secret-controls")
    tested = materialise(Null(controls).judge(statistics(tokens.drop("near"))), "secret-tests")
    least = levels(tested, fdr)  # a row for each class of length: as many as an int has bits, at most
    told = tested.withColumn("class", length_class(F.col("n"))).join(F.broadcast(least), "class").where(F.floor("level") >= F.col("least"))
    added = told.groupBy("doc", "copy").agg(F.collect_set(F.struct("start", F.lit(3).alias("order"), "stop", "kind", "value")).alias("added"))
    whole = F.sort_array(F.concat("base", F.coalesce("added", F.expr("cast(array() as array<struct<start:int,order:int,stop:int,kind:string,value:string>>)"))))
    return found.join(added, ["doc", "copy"], "left").select("doc_id", "base", whole.alias("spans"))


def told(spans_: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def base_values(docs: DataFrame) -> DataFrame:
    """The patterns alone: doc_id, n_assign, n_access, n_hex and the matches' values, in order."""
    found = base_spans(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    of = lambda k: [F.size(k).cast("long").alias(f"n_{k}"), F.array_join(F.transform(k, lambda x: x["value"]), " ").alias(f"{k}_values")]
    return found.select("doc_id", *of("assign"), *of("access"), *of("hex"))


def op8_secrets(docs: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(docs).select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(told(F.col("base")).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
