"""Secrets against plain Python regular expressions and counts, and held-out strings of either sort."""

import hashlib
import math
import random
import re
import string

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidegrid.llm import keyscan, queries_spans
from tidegrid.llm.common import stored

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def slow_base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    return sorted(found)


def written(spans):
    return ",".join(f"{(*keyscan.KINDS, 'random')[k]}:{s}:{e}" for s, k, e in spans)


def secret(rng, n=24, letters=string.ascii_letters + string.digits):
    return "".join(rng.choices(letters, k=n))


def corpus():
    rng = random.Random(5)
    words = "the internationalization of administrative responsibilities über naïve counterrevolutionaries 2024 version_2 userAccountName".split()
    parts = "in ter na tion al ly con struc ment able pre fer ence dis trib ute ad min is tra com mun i ca ver si ty".split()
    words += ["".join(rng.choices(parts, k=rng.randint(2, 8))) for _ in range(600)]
    out = []
    for k in range(120):
        text = rng.choices(words, k=rng.randint(0, 60))
        extra = [
            f"password={secret(rng)}", f"token: 'short'", f'API_KEY = "{secret(rng, 30)}"', "AKIA" + secret(rng, 16, string.ascii_uppercase + string.digits),
            secret(rng, 32, "0123456789abcdef"), "AKIAshort", secret(rng, 28), f"secret=token={secret(rng, 14)}", 'token: "secret: abcdefghijklmnop"',
        ]
        for e in rng.sample(extra, rng.randint(0, 4)):
            text.insert(rng.randint(0, len(text)), e)
        out.append(" ".join(text))
    return out + [None, "", "AKIA" * 9, "token=" * 30, "f" * 400, "password=" + "é" * 20, "😀 passwd:x" + "0" * 15 + " 😀 " + "0" * 16]


def test_base_spans_equal_plain_python(spark):
    texts = corpus()
    rows = [(k, t, "c", 1) for k, t in enumerate(texts)] + [(0, texts[0], "c", 1), (None, texts[1], None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `my col` string, spans int")
    model = keyscan.Model(keyscan.ratios({}), 10**9)
    made = keyscan.find_secrets(docs, model)
    assert made.columns == ["doc_id", "text", "my col", "n_assign", "n_access", "n_hex", "base", "spans"]
    got = made.collect()
    assert len(got) == len(rows)
    for r in got:
        want = slow_base(r.text or "")
        assert r.base == r.spans == written(want), r.text
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in want) for j in range(3))
    assert keyscan.find_secrets(docs.limit(0), model).count() == 0
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text("aAKI0f=:_- \"\u00e9tokensecret\n", max_size=60), min_size=1, max_size=20))
def test_base_spans_of_any_text(spark, texts):
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in keyscan.find_secrets(docs, keyscan.Model(keyscan.ratios({}), 10**9)).collect():
        assert r.base == written(slow_base(r.text))


def test_sums_of_many_steps(spark):
    row = spark.range(1).select(keyscan.running(F.sequence(F.lit(1).cast("bigint"), F.lit(2500).cast("bigint"))).alias("s")).first()
    assert row.s == [k * (k + 1) // 2 for k in range(1, 2501)]


def slow_model(samples):
    """Ratios and threshold by plain counting."""
    counts, tests = {}, {0: [], 1: []}
    for s, label in sorted(set(samples)):
        codes = [0] + [max(1, min(95, ord(c) - 31)) for c in s]
        if hashlib.md5(s.encode()).hexdigest()[0] in "012":
            tests[label] += [codes] * (len(s) >= keyscan.LEAST_CANDIDATE)
            continue
        for pair in zip(codes, codes[1:]):
            counts[label, *pair] = counts.get((label, *pair), 0) + 1
    total = lambda label, a: 95 * keyscan.PRIOR + sum(n for (x, y, _), n in counts.items() if (x, y) == (label, a))
    totals = {(label, a): total(label, a) for label in (0, 1) for a in range(96)}
    p = lambda label, a, b: (counts.get((label, a, b), 0) + keyscan.PRIOR) / totals[label, a]
    ratio = [round(1000 * math.log(p(1, a, b) / p(0, a, b))) for a in range(96) for b in range(96)]

    def quantile(label, share):
        scores = sorted(sum(ratio[a * 96 + b] for a, b in zip(c, c[1:])) for c in tests[label])
        at = (len(scores) - 1) * share
        low = scores[int(at)]
        return round(low + (at - int(at)) * (scores[min(int(at) + 1, len(scores) - 1)] - low))

    return ratio, max(quantile(0, 1 - keyscan.FALSE_SHARE) + 1, quantile(1, keyscan.MISSED_SHARE))


def test_model_equals_plain_counts_and_tells_held_out_strings_apart(spark):
    rng = random.Random(9)
    stems = "account user name order invoice delivery address customer payment session manager builder controller request response service".split()
    plain = ["_".join(rng.sample(stems, rng.randint(1, 4))) for _ in range(1500)] + [f"{rng.choice(stems)}{rng.randint(1, 99)}" for _ in range(300)]
    keys = [secret(rng, rng.randint(16, 40), *(["0123456789abcdef-"] * (k % 3 == 0))) for k in range(1500)]
    samples = [(s, 0) for s in plain] + [(s, 1) for s in keys] + [("", 1), (None, 0), (keys[0], 1)]
    model = keyscan.train(spark.createDataFrame(samples, "string string, label int"))
    ratio, threshold = slow_model([(s, y) for s, y in samples if s])
    assert list(model.ratio) == ratio and model.threshold == threshold
    fresh = [("_".join(rng.sample(stems, 3)), 0) for _ in range(500)] + [(secret(rng, 24), 1) for _ in range(500)] + [(secret(rng, 24, "0123456789abcdef-"), 2) for _ in range(200)]
    got = spark.createDataFrame(fresh, "string string, label int").select("label", (model.score(F.col("string")) >= model.threshold).alias("hit")).collect()
    assert sum(r.hit for r in got if r.label == 1) >= 0.97 * 500
    # mostly digits, which also end ordinary names here
    assert sum(r.hit for r in got if r.label == 2) >= 0.7 * 200
    assert sum(r.hit for r in got if r.label == 0) <= 0.01 * 500


def test_added_spans_are_planted_keys_and_query_equals_sql(spark, tmp_path):
    texts = corpus()
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries_spans.op12_secrets(spark, str(tmp_path)).collect()))
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(duckdb.sql(queries_spans.ORACLE["op12_secrets"]).fetchall())
    free = re.compile("(?<![A-Za-z0-9_=:\"'])[A-Za-z0-9]{28}(?![A-Za-z0-9])")
    planted = [(k, m.start()) for k, t in enumerate(texts) for m in free.finditer(t or "") if any(c.isdigit() for c in m[0])]
    added = {(r[0], int(x.split(":")[1])) for r in got for x in r[5].split(",") if x.startswith("random")}
    assert len(planted) > 20 and len(added & set(planted)) >= 0.95 * len(planted)
    assert not [(k, s) for k, s in added if (texts[k][s:].split() or [""])[0] in ("internationalization", "counterrevolutionaries", "responsibilities")]


def test_training_without_a_label_still_gives_a_model(spark):
    model = keyscan.train(spark.createDataFrame([("hello", 0)], "string string, label int"))
    assert len(model.ratio) == 96 * 96 and model.threshold == 0
    empty = spark.createDataFrame([], "doc_id int, text string")
    scanned = stored(keyscan.scan(empty))
    assert keyscan.find(scanned, keyscan.train(keyscan.labelled(scanned, empty))).count() == 0
