"""Periodic runs against all pairs of places, on random words of small alphabets and on frames with odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tidegrid.llm import periods, queries_spans


def slow_runs(words, least=12):
    """Every run, by comparing words at every distance."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def test_transform_sums_are_exact():
    rng = np.random.default_rng(1)
    for b in (2, 4, 16, 64):
        low, high = (1, 6) if b == 2 else (2 * b - 1, 4 * b - 2)
        blocks = rng.integers(0, 3000, (5, b)).astype(np.uint64)
        windows = rng.integers(0, 3000, (5, high - low + b)).astype(np.uint64)
        windows[2, 3 : 3 + b] = blocks[2]
        got = periods.squared_differences(blocks, windows)
        for k in range(5):
            for d in range(high - low + 1):
                want = int(((blocks[k].astype(np.int64) - windows[k, d : d + b].astype(np.int64)) ** 2).sum())
                assert got[k, d] == want % int(periods.PRIME)
        assert got[2, 3] == 0


def texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(60):
        words = [rng.choice("ab" if rng.random() < 0.3 else "abcdefghijklmn") for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):  # stretches of any period, some nested, some broken by one word
            unit = [rng.choice("abcxyz") for _ in range(rng.randint(1, 40))]
            tail = (unit * 9)[: rng.randint(1, 9 * len(unit))]
            if rng.random() < 0.4:
                tail[rng.randrange(len(tail))] = "!"
            at = rng.randint(0, len(words))
            words[at:at] = tail
        out.append(words)
    return out + [[], ["a"] * 11, ["a"] * 12, ["a"] * 400, ["a", "b"] * 100 + ["c"] + ["a", "b"] * 100]


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_those_of_all_pairs(seed):
    made = texts(seed) + [fibonacci(300)]
    names = {w: k for k, w in enumerate(sorted({w for ws in made for w in ws}))}
    n = np.array([len(ws) for ws in made])
    flat = np.array([names[w] for ws in made for w in ws], np.int64)
    start, end, q = periods.runs_of(flat, n)
    base = np.cumsum(n) - n
    text = np.searchsorted(np.cumsum(n), start, side="right")
    got = [[] for _ in made]
    for t, s, e, p in zip(text, start, end, q):
        got[t].append((int(s - base[t]), int(e - s), int(p)))
    for ws, own in zip(made, got):
        assert own == slow_runs(ws), ws


def test_a_long_text_of_one_word_is_one_run():
    start, end, q = periods.runs_of(np.zeros(300_000, np.int64), np.array([300_000]))
    assert (start.tolist(), end.tolist(), q.tolist()) == ([0], [300_000], [1])


def test_frame_with_nulls_repeats_and_clashing_columns(spark):
    line = "to be or not to be "
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, line * 5 + "end", "x", 1), (3, line * 5 + "end", "x", 1), (None, " \t\n", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `my col` string, runs int")
    got = periods.periodic_runs(docs)
    assert got.columns == ["doc_id", "text", "my col", "runs", "collapsed"]
    found = sorted(((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()))
    words = (line * 5 + "end").split()
    want = slow_runs(words)
    assert [f[1] for f in found] == [[], [], [], want, want]
    assert found[3][2] == "to be or not to be end"
    assert periods.periodic_runs(docs.limit(0)).count() == 0


def test_query_equals_plain_python(spark, tmp_path):
    rng = random.Random(7)
    rows = [(k, " ".join(rng.choice(["la", "li", "lo", "\u00e9t\u00e9", "x\u00a0y"]) for _ in range(rng.randint(0, 120)))) for k in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "\n \x0b"), (1003, "a " * 50)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries_spans.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for k, text in rows:
        w = [x.decode() for x in (text or "").encode().split()]
        h, n = zlib.crc32(str(k).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = slow_runs(w)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(((-m, s, q) for s, m, q in runs), default=None)
        r = got[k]
        assert r.n_runs == len(runs)
        want = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == want
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert r.runs_sha256 == digest("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r.collapsed_sha256 == digest(" ".join(x for i, x in enumerate(w) if i not in gone))
