"""Operators that relate documents to each other, and the pipeline, against brute force on small frames."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegrid.llm import neardup, passages
from tidegrid.llm.common import join_groups, stored, words
from tidegrid.llm.components import components


def united(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(60)] + [(500, k) for k in range(400, 520)] + [(7, 7), (900, 901), (901, 902), (902, 900)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    rng.shuffle(links)
    got = {r.key: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = united({n for p in links for n in p}, links)
    lone = {a for a, b in links if a == b and sum(a in p for p in links) == 1}
    assert got == {n: t for n, t in want.items() if n not in lone and n in got}
    assert set(want) - set(got) <= {a for a, b in links if a == b}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_join_groups_keeps_every_row(spark):
    rows = stored(spark.createDataFrame([(k, "hot" if k % 2 else f"k{k}") for k in range(6000)], "n int, key string"))
    groups = stored(rows.groupBy("key").agg(F.count("*").alias("size"), F.min("n").alias("least")))
    got = join_groups(rows, groups, "key", "size")
    assert got.count() == 6000 and got.where("key = 'hot' AND least = 1 AND size = 3000").count() == 3000
    assert got.where("key != 'hot' AND (least != n OR size != 1)").count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(8)
    element = rng.integers(0, 2**63, 300).astype(np.uint64)
    one = rng.uniform(0.05, 12, 300)
    two = np.where(rng.random(300) < 0.6, one, rng.uniform(0.05, 12, 300))
    n = np.array([300, 0, 300, 1])
    signed = neardup.signatures(np.concatenate([element, element, element[:1]]), np.concatenate([one, two, [1e-3]]), n, 1500)
    truth = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert abs((signed[0] == signed[2]).mean() - truth) < 0.05
    assert not signed[1].any() and (signed[3] > 0).all()
    # the same set gives the same signature among others, in any order
    order = rng.permutation(300)
    assert (neardup.signatures(element[order], one[order], np.array([300]), 1500)[0] == signed[0]).all()


def family(rng, size, edits, length=60):
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(size):
        own = list(base)
        for _ in range(edits):
            own[rng.randrange(length)] = f"x{rng.randrange(5000)}"
        out.append(" ".join(own))
    return out


def brute_classes(rows, width=5, similar=0.8, counted=False):
    """Class by row number: equal texts, and chains of pairs that are similar enough."""

    def elements(text):
        own = words(text)
        grams = [tuple(own[k : k + width]) for k in range(max(1, len(own) - width + 1))] if own else []
        if not counted:
            return set(grams)
        seen = defaultdict(int)
        return {(g, seen.__setitem__(g, seen[g] + 1) or seen[g]) for g in grams}

    sets = [elements(t) for t in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if (rows[a] or "") == (rows[b] or "") or both and both >= similar * len(sets[a] | sets[b]):
                links.append((b, a))
    return united(range(len(rows)), links)


@pytest.mark.parametrize("counted", [False, True])
def test_near_duplicates_equal_brute_force(spark, counted):
    rng = random.Random(11)
    texts = [t for k in range(6) for t in family(rng, 12, k % 4)] + family(rng, 40, 1) + ["a b", "A  b!", "one two", "", None, "...", "!!", "w " * 50, "w " * 90]
    texts += [texts[0]] * 7
    rows = [(k, t, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    want = brute_classes(texts, counted=counted)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs, counted=counted).collect()}
    assert {k: r.class_id for k, r in got.items()} == want
    assert all(r.class_rows == sum(v == r.class_id for v in want.values()) for r in got.values())
    if counted:
        return
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    odd = docs.where("doc_id < 3").union(docs.where("doc_id < 3")).union(spark.createDataFrame([(None, "lone text", "y"), (None, "lone text", "z")], docs.schema))
    once = neardup.deduplicate(odd).collect()
    assert len([r for r in once if r.doc_id is None]) == 1
    assert len(once) == 1 + len({want[k] for k in range(3)})
    assert neardup.near_duplicates(docs.limit(0)).count() == 0 and neardup.deduplicate(docs.limit(0)).count() == 0


def test_buckets_of_unlike_texts_lose_no_link(spark, monkeypatch):
    """Many texts that share most of a form fall into common buckets; only some pairs are alike, never the first leader's."""
    rng = random.Random(5)
    form = [f"w{k}" for k in range(70)]
    texts = []
    for k in range(40):
        own = form + [f"u{k}x{j}" for j in range(24)]
        texts += [" ".join(own), " ".join(own[:-1] + ["end"])] if k % 4 == 0 else [" ".join(own)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert got == brute_classes(texts)


# --- passages


def test_compact_windows_equal_brute_force():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 50, 500).astype(np.uint64)
    n = np.array([3, 150, 0, 20, 327])
    got = set(zip(*(x.tolist() for x in passages.compact_windows(h, n, 20))))
    want = set()
    for end, m in zip(np.cumsum(n), n):
        for k in range(end - m, end):
            low = high = k
            while low > end - m and h[low - 1] >= h[k]:
                low -= 1
            while high < end - 1 and h[high + 1] > h[k]:
                high += 1
            if high - low + 1 >= 20:
                want.add((k, low, high))
    assert got == want


def test_repeated_passages_are_found_whole(spark):
    rng = random.Random(9)
    fresh = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    passage, line, short = fresh(70), fresh(30), fresh(40)
    edited = passage[:35] + ["changed"] + passage[36:]
    texts = []
    for k in range(24):
        own = fresh(60) + line + fresh(50)  # all share a line of 30 words, which is too short
        if k % 6 == 0:
            own += passage + fresh(20)
        elif k == 5:
            own += edited + fresh(10)
        elif k == 7:
            own += short
        texts.append(" ".join(own))
    # two texts go on alike behind the common line: 30 + 25 words
    more = fresh(25)
    texts += [" ".join(fresh(40) + line + more + fresh(9)) for _ in range(2)]
    texts += ["", None, "short text", " ".join(fresh(80))]
    texts += [texts[-1], texts[1]]
    docs = spark.createDataFrame([(k, t, "c") for k, t in enumerate(texts)] + [(None, texts[0], "c")], "doc_id bigint, text string, class_id string")
    got = defaultdict(list)
    for r in passages.repeated_passages(docs).collect():
        got[r.doc_id].append((r.start_word, r.end_word, r.class_id))
    def at(doc, sample):
        own = words(texts[doc])
        sample = [w.encode() for w in sample]
        start = next(k for k in range(len(own)) if own[k : k + len(sample)] == sample)
        return start, start + len(sample)
    for doc in (6, 12, 18):
        assert got[doc] == [(*at(doc, passage), 0)]
    assert got[5] == [(*at(5, edited), 0)]
    assert got[24] == [(*at(24, line + more), 24)] and got[25] == [(*at(25, line + more), 24)]
    assert got[1] == got[31] == [(0, 140, 1)] and got[29] == got[30] == [(0, 80, 29)]
    assert got[0] == got[None] and got[0][0][:2] == (0, len(words(texts[0])))
    assert set(got) == {0, None, 1, 31, 5, 6, 12, 18, 24, 25, 29, 30}
    assert passages.repeated_passages(docs.limit(0)).count() == 0


# --- pipeline


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path):
    import tiktoken
    import public_tokenizers

    from tidegrid.llm import bpe, pii, quality

    rng = random.Random(1)
    sane = lambda n: " ".join(rng.choice(("the", "of", "river", "was", "stone", "old", "green")) + rng.choice(("", "", "s", "ly")) + str(rng.randrange(90)) for _ in range(n))
    texts = [sane(rng.randint(20, 60)) for _ in range(120)] + ["$$$ ### !!! BUY " * 15] * 3 + ["### %%% NOW!! " * rng.randint(9, 30) for _ in range(60)]
    texts[5] = texts[4] + " more"
    bench = sane(14)
    texts[9] += " " + bench.upper()
    texts[10] += " write to jane.doe@example.org today"
    texts += [None, "", texts[3]]
    docs = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)] + [(None, sane(30), None, None, None)]
    folder = str(tmp_path / "sf")
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k < 120), 0) for k in range(183)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.train(table, spark.read.parquet(f"{folder}/labels.parquet"))
    left = [d for d in docs if model.score(quality.features([d[1]]))[0] >= corpus_pipeline.LEAST_QUALITY]
    assert {d[0] for d in left} >= set(range(120)) and not {d[0] for d in left} & set(range(123, 180))
    label = brute_classes([d[1] for d in left])
    best = {}
    for k, d in enumerate(left):
        best.setdefault(label[k], []).append(d)
    left = [min(own, key=lambda d: (d[0] is None, d[0] or 0)) for own in best.values()]
    target = words(bench)
    windows = {tuple(target[k : k + 10]) for k in range(len(target) - 9)}
    left = [d for d in left if not any(tuple(words(d[1])[k : k + 10]) in windows for k in range(len(words(d[1]))))]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(None, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = {}
    for d in left:
        base = pii.base_spans(d[1])
        text = pii.redacted(d[1], [(k, *s) for k in pii.KINDS for s in base[k]])
        want[d[0]] = (None if text is None else len(text), library.encode_ordinary(text or ""))
    got = corpus_pipeline.run(spark, folder)
    rows = {r.doc_id: (r.n_chars, list(r.token_ids)) for r in got.collect()}
    assert rows == want and got.count() == len(want)
    assert 9 not in rows and 5 not in rows and None in rows and 10 in rows
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table.limit(0), folder).count() == 0, name
