"""run() and its stages on a small table, against plain Python and the oracle's SQL."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import public_tokenizers

import corpus_pipeline as C
from shopsight.llm import packing, pii
from shopsight.llm.common import cut
from shopsight.llm.oracle import ORACLE_SQL
from tests.llm import test_jaccard, test_pii

WORDS = ("the of and to in is that for it was on are as with by house river walked seven mountain quickly because winter "
         "letter garden window paper yellow morning street music teacher bridge island market corner").split()


def table():
    """(doc_id, text, lang, source, n_chars) with clean, copied, near-copied, private, junk, empty and null rows."""
    r = random.Random(11)
    prose = lambda n: [r.choice(WORDS) for _ in range(n)]
    rows = [(i, " ".join(prose(80 + 6 * i)), f"s{i % 3}") for i in range(1, 31)]
    copied = prose(160)
    rows += [(100 - k, " ".join(copied), "s0") for k in range(4)]
    for k in range(4):  # near copies; the smallest id comes last
        w = list(copied)
        for j in range(k):
            w[50 * j + 20] = f"edit{j}"
        rows.append((80 - k, " ".join(w), "s1"))
    private = prose(120) + ["ask", "zorblax", "at", "same@corp.example"]
    rows += [(200 + k, " ".join([*private, "now"] if k else private), "s2") for k in range(4)]  # near copies share an address
    rows += [(210 + k, " ".join([*prose(100), "quixano", "of", "ann@corp.example", *prose(30)]), "s2") for k in range(5)]
    rows += [(220, " ".join([*prose(90), "card 4111 1111 1111 1111 from 10.0.0.255 or +49 30 1234567 call", *prose(20)]), "hot")]
    rows += [(230, " ".join(w + "***" for w in prose(200)), "hot"), (231, " ".join(prose(300)).upper(), "hot"),
             (232, "one two " * 100, "hot"), (233, "", "hot"), (234, None, None), (235, "too short", "s0"),
             (None, " ".join(prose(140)), "s0"), (236, " ".join(prose(130)), None)]
    equal = " ".join(prose(110))
    rows += [(237, equal, "s1"), (237, equal, "s1"), (238, " ".join(prose(3000)), "s1")]
    return [(i, t, "en", s, len(t or "")) for i, t, s in rows]


def kept_by_sql(rows):
    with duckdb.connect() as db:
        db.register("d", pd.DataFrame([(k, t, x) for k, (_, t, x, *_) in enumerate(rows)], columns=["doc_id", "text", "lang"]))
        db.execute("CREATE VIEW documents AS SELECT * FROM d")
        kept = {x[0] for x in db.execute(ORACLE_SQL["op4_quality_rules"]).fetchall() if x[-1]}
    return [r for k, r in enumerate(rows) if k in kept]


def one_of_each(rows):
    stay = {c for _, n, c in test_jaccard.brute([(r[0], r[1]) for r in rows], 5, 80) if n}
    return list({r[0]: r for r in rows if r[0] in stay}.values())


def masked(rows):
    rule, near, holders, having = pii.Disclosure(), defaultdict(set), defaultdict(set), Counter()
    for k, r in enumerate(rows):
        having.update(set(re.findall(r"[^\W\d_]{3,}", r[1].lower())))
        for kind, pattern, ok in test_pii.RULES:
            for m in (m for m in re.finditer(pattern, r[1]) if ok(m[0])):
                left = re.sub(r"^[^\W\d_]+", "", r[1][max(0, m.start() - 60) : m.start()])
                right = re.sub(r"[^\W\d_]+$", "", r[1][m.end() : m.end() + 60])
                holders[kind, m[0].lower()].add(k)
                for w in re.findall(r"[^\W\d_]{3,}", (left + " " + right).lower()):
                    near[kind, m[0].lower(), w].add(k)
    terms = defaultdict(set)
    for (kind, e, w), ids in near.items():
        n, n_e = len(rows), len(holders[kind, e])
        shown = math.log2(n * len(ids) / (having[w] * n_e))
        if len(ids) >= rule.min_support and shown > 0 and shown >= rule.max_disclosure * math.log2(n / n_e):
            for k in holders[kind, e]:
                terms[k].add(w)
    out = []
    for k, r in enumerate(rows):
        spans = [(int(a), int(b), kind) for kind, a, b in (s.split(":") for s in test_pii.brute(r[1]))]
        spans += [(m.start(), m.end(), "term") for w in terms[k] for m in re.finditer(rf"(?i)\b{w}\b", r[1])
                  if not any(a < m.end() and m.start() < b for a, b, _ in spans)]
        text, at = "", 0
        for a, b, kind in sorted(spans):
            if a >= at:
                text += r[1][at:a] + pii.LABELS[kind]
            at = max(at, b)
        out.append((r[0], text + r[1][at:], *r[2:]))
    return out


def check_mixture(rows, mixed):
    """Every row once at least, and as many words of each source as its quota lets in."""
    copies, words = Counter(mixed), defaultdict(list)
    assert set(copies) == set(rows)
    for r in rows:
        words[r[3]].append(len(r[1].split()))
    tokens = {s: sum(w) for s, w in words.items()}
    largest, least = max(tokens.values()), min(tokens.values())
    exponent = max(0.0, 1 - math.log(1.5) / math.log(largest / least))
    top = max(n / (n / largest) ** exponent for n in tokens.values())
    for s, n in tokens.items():
        quota = top * (n / largest) ** exponent
        got = sum(c * len(r[1].split()) for r, c in copies.items() if r[3] == s)
        assert quota - 2 * max(words[s]) - 1 < got <= quota * 1.001 + 1, s
        assert all(quota // n - 1 <= c <= quota // n + 1 for r, c in copies.items() if r[3] == s)


def test_run_equals_plain_python(spark, tmp_path):
    rows = table()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got, docs = [], spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        docs = cut(stage(spark, docs, str(tmp_path)))
        got.append([tuple(r) for r in docs.collect()])
    good = kept_by_sql(rows)
    assert Counter(got[0]) == Counter(good) and 40 < len(good) < len(rows) - 4
    single = one_of_each(good)
    assert Counter(got[1]) == Counter(single) and {77, 200, 237, None} <= {r[0] for r in single}
    clean = masked(single)
    assert Counter(got[2]) == Counter(clean)
    texts = {r[0]: r[1] for r in clean}
    assert "zorblax at [EMAIL]" in texts[200] and "quixano" not in texts[212] and "4111" not in texts[220]
    check_mixture(clean, got[3])
    # one row a piece of each drawn copy, in sequences without gaps
    want = Counter()
    for i, text, *_ in got[3]:
        ids = packing.token_ids(text, public_tokenizers.path("byte_bpe_50k.tiktoken"))
        for at in range(0, len(ids), 1024):
            want[i, at, len(ids[at : at + 1024]), zlib.crc32(ids[at : at + 1024].tobytes()), len(ids)] += 1
    packed = [tuple(r) for r in C.run(spark, str(tmp_path)).collect()]
    assert Counter(r[:5] for r in packed) == want
    ends = defaultdict(int)
    for r in sorted(packed, key=lambda r: r[5:]):
        assert r[6] == ends[r[5]]
        ends[r[5]] += r[2]
    assert max(ends.values()) <= 1024
