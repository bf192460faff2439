import re
from collections import Counter

from pyspark.sql import functions as F

from shopsight.llm import quality


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    marked = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked), failed


def test_base_counts(spark, corpus):
    extra = [(900, "a b c\na b c\n\n \n#x <y> | a b c\na b c"), (901, "l\nl\nl\n"), (902, "x\r\nx\r\n")]
    rows = [(i, t, "en") for i, t, *_ in corpus] + [(i, t, None) for i, t in extra]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    q = F.col("quality")
    got = quality.judge(df).select("text", *(q[n] for n in quality.COUNTS[:5]), q["base_failed"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == brute(r[0]), r[0]


def test_strange_documents_are_rejected_and_clean_ones_kept(spark):
    r = __import__("random").Random(4)
    words = "the of and to in house river walked seven mountain quickly because winter letter".split()
    clean = [(i, " ".join(r.choice(words) for _ in range(300)), "en") for i in range(60)]
    junk = [(100, clean[0][1].upper(), "en"), (101, " ".join(w + "***" for w in clean[1][1].split()), "en"),
            (102, "short ***", "en")]
    kept = quality.keep_good(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string"))
    assert {x.doc_id for x in kept.collect()} == set(range(60))


def test_columns_pass_through(spark, docs):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert quality.keep_good(docs.limit(0)).count() == 0
    assert {r.doc_id for r in kept.collect()} >= set(range(24))


def test_distance(spark):
    a = spark.createDataFrame([([1, 0], 1, [0.0, 1.0]), ([1, 1], 2, [0.5, 0.5]), ([0, 0], 0, [0.5, 0.5])],
                              "c array<long>, n long, r array<double>")
    got = [x.d for x in a.select(quality.js_distance(F.col("c"), F.col("n"), F.col("r")).alias("d")).collect()]
    assert got == [1.0, 0.0, 0.0]


def test_thin_mixed_and_empty_references_equal_the_oracle(spark):
    import duckdb
    import pandas as pd

    from shopsight.llm.oracle import ORACLE_SQL

    r = __import__("random").Random(6)
    known = [w for w in quality.VOCABULARY if w.isalpha()]
    clean = lambda n: " ".join(r.choice(known) for _ in range(n))
    other = lambda n: " ".join(f"q{r.randrange(10**6)}z" for _ in range(n))
    rows = [(0, clean(300), "aa"), (1, other(300), "aa")]  # each is far from their mean: no reference is left
    rows += [(10 + i, clean(200), "bb") for i in range(5)] + [(20, other(20_000), "bb")]  # one text is most of bb
    rows += [(30 + i, clean(200) if i % 2 else other(200), None) for i in range(8)] + [(40, clean(20), "cc")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x.kept for x in quality.judge(df).select("doc_id", "quality.kept").collect()}
    with duckdb.connect() as db:
        db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang"]))
        want = {x[0]: x[-1] for x in db.execute(ORACLE_SQL["op4_quality_rules"]).fetchall()}
    assert got == want
    assert (got[0], got[1]) == (False, False)
