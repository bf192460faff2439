import hashlib
from collections import Counter

import numpy as np
import pytest

from shopsight.llm import lpf


def brute(rows, length, keep):
    seen = Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
    out, done = Counter(), set()
    for i, b in sorted(raw, key=lambda r: (r[0] is None, r[0] or 0)):
        flags = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if (seen[w] > 1) if keep == "none" else (w in done):
                flags[k : k + length] = True
            done.add(w)
        spans = int((flags[1:] & ~flags[:-1]).sum()) + int(flags[0]) if len(flags) else 0
        kept = np.frombuffer(b, np.uint8)[~flags].tobytes()
        out[i, len(b), int(flags.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("length", "keep", "in_task"), [(400, "none", 4096), (64, "none", 1), (64, "first", 2), (64, "first", 4096)])
def test_equals_brute_force(spark, corpus, length, keep, in_task, monkeypatch):
    """Also with few stretches a task, so that most are joined by Spark."""
    monkeypatch.setattr(lpf, "IN_TASK", in_task)
    x = " ".join(corpus[20][1].split()[:150])
    rows = [(i, t) for i, t, *_ in corpus if i not in (135, 137)] + [
        (700, x), (701, "é" * 500 + x[200:]), (702, x[300:] + "é" * 300), (703, "x" + x[50:450] + "y"), (704, x[50:450]),
        (705, "ab" * 600), (706, x[449:849] + x[50:449])]
    if keep == "first":  # equal rows have one place in that order
        rows = list({(i, t): (i, t) for i, t in rows}.values())
        rows = [r for r in rows if r[0] is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in lpf.dedup(df, length=length, keep=keep).collect())
    assert got == brute(rows, length, keep)


def test_kept_bytes_and_edges(spark, docs):
    out = lpf.dedup(docs, with_text=True)
    assert out.count() == docs.count()
    for r in out.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    assert lpf.dedup(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="keep"):
        lpf.dedup(docs, keep="last")
