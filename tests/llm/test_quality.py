"""Quality rules against brute force, and line frequency on planted boilerplate."""

import re
from collections import Counter, defaultdict

from strandlake.llm.quality import judge, keep_good, op4_quality
from strandlake.llm.queries import queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def got(rows):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)


def test_rules(docs, tricky, sample, empty):
    rows = op4_quality(docs).collect()
    assert got(rows) == sorted((-1 if i is None else i, *base(t)) for i, t in tricky)
    assert not any(r.kept and r.base_failed for r in rows)
    assert got(op4_quality(sample).collect()) == sorted((r.doc_id, *base(r.text)) for r in sample.collect())
    assert op4_quality(empty).count() == 0


def judged(rows, line_docs, line_percent, left_percent):
    """(id, text) -> the text without boilerplate and the verdict, from whole tables in memory."""
    normal = lambda x: x.lower().strip(" \t\x0b\x0c\r")
    seen, hosts = defaultdict(set), defaultdict(set)
    for _, h, t in rows:
        hosts[h].add(t or "")
        for x in (t or "").split("\n"):
            seen[h, normal(x)].add(t)
    bad = {k for k, v in seen.items() if k[1] and len(v) >= line_docs and 100 * len(v) > line_percent * len(hosts[k[0]])}
    out = {}
    for i, h, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if (h, normal(x)) not in bad]
        size = lambda xs: sum(len(normal(x)) for x in xs)
        gone = len(stay) < len(lines) and (len(WORD.findall("\n".join(stay))) < 50 or 100 * size(stay) < left_percent * size(lines))
        out[i, t] = ("\n".join(stay) if t is not None else None, not base(t)[-1] and not gone)
    return out


def check(spark, rows, limits):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, doc string, lost string, `a.b` int" if len(rows[0]) > 3 else "doc_id long, source string, text string")
    want = judged([r[:3] for r in rows], **limits)
    kept = keep_good(df, **limits)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted((i, t) for (i, x), (t, ok) in want.items() if ok for r in rows if r[0] == i and r[2] == x)
    return want


def test_line_frequency(spark):
    footer = ["Home | Products | Contact", "All rights reserved by the owner", "Cookies are used on these pages", "Call 1234 for help"]
    rows = []
    for i in range(400):  # the footer of four lines is found whole, and what has little else goes
        own = " ".join(f"w{i}x{k}" for k in range(60 if i % 2 else 45))
        rows.append((i, "a", "\n".join([f"title {i}", own, *(x.upper() if i % 3 else x for x in footer)]), "x", "y", 1))
    text = "\n".join(" ".join(f"c{k}v{j}" for j in range(9)) for k in range(12))
    rows += [(1000 + i, "b", text, "x", "y", 1) for i in range(60)]  # copies count once
    rows += [(2000, None, None, "x", "y", 1), (2001, None, "", "x", "y", 1), (2002, "a", footer[0], "x", "y", 1), (1, "a", rows[1][2], "x", "y", 1)]
    want = check(spark, rows, {"line_docs": 4, "line_percent": 5, "left_percent": 30})
    assert not any(footer[3].upper() in (t or "").upper() for (i, _), (t, _) in want.items() if i < 400)
    good = {i for (i, _), (_, ok) in want.items() if ok}
    assert good == {i for i in range(400) if i % 2} | set(range(1000, 1060))


def test_limits(spark):
    """At the first limit a line is boilerplate, at the second it isn't yet."""
    page = lambda i, x: (i, "a", "\n".join([" ".join(f"w{i}x{k}" for k in range(55)), x]))
    for shared in (3, 4, 5):
        check(spark, [page(i, "the same line" if i < shared else f"line {i}") for i in range(40)], {"line_docs": 4, "line_percent": 10, "left_percent": 50})


def test_method_rejects(spark):
    """At production limits there are documents that only line frequency rejects."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    want = judged(rows, 5, 10, 80)
    got = {r.doc_id: (r.base_failed, r.kept) for r in op4_quality(docs).collect()}
    assert got == {i: (base(t)[-1], ok) for (i, t), (_, ok) in want.items()}
    assert any(not failed and not kept for failed, kept in got.values())


def test_native(spark, tmp_path):
    for name in ("op4_quality", "op8_secrets"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
