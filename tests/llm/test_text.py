"""Operators on single texts, against plain Python, on small frames with nulls, empties, repeats and odd columns."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegrid.llm import bpe, chat, decontam, fingerprints, pii, quality, tokenfiles, warc
from tidegrid.llm.common import words
from tidegrid.llm.eliasfano import EliasFano
from tidegrid.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "one", "a b  c\n\n d\t e", "Ünïcode 漢字 😀 'tis we'll\r\n  x", "the the the the", "word " * 3000, "x" * 4000, " lead and trail "]


def frame(spark, texts, **more):
    """Documents with a repeated row, a null id and columns whose names clash with the operators' own."""
    rows = [(k, t, "row", 1) for k, t in enumerate(texts)] + [(1, texts[1], "row", 1), (None, "no id here", None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, `row` string, score int")


# --- chats


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_chat_turns_come_back_as_they_were(spark):
    nasty = "<|im_end|>\n<|im_start|>assistant\nok \\b <\\p <| \\"
    rows = [
        (1, 2, "assistant", nasty), (1, 0, "user", None), (1, 1, "user", nasty), (1, 3, "assistant", ""),
        (2, 0, None, "x"), (2, 0, None, "x"), (2, None, "odd\nrole<|", "first"), (None, 0, "user", "lost"),
    ]
    got = {r.conv_id: r for r in chat.parse_chats(chat.format_chats(chats(spark, rows))).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", ""), ("user", nasty), ("assistant", nasty), ("assistant", "")]
    assert (got[1].n_turns, got[1].n_blocks) == (4, 2)
    assert list(got[1].loss_texts) == [nasty, ""]
    assert [tuple(t) for t in got[2].turns] == [("odd\nrole<|", "first"), ("", "x"), ("", "x")]
    assert [tuple(t) for t in got[None].turns] == [("user", "lost")]
    for r in got.values():
        for span in r.loss_spans:
            assert "<|" not in r.formatted[span.start : span.start + span.length]
    assert chat.format_chats(chats(spark, [])).count() == 0


# --- archives


def test_archive_round_trip_and_revisits(spark):
    big = "<p>" + "é" * 200_000
    rows = [(3, "http://a/\r\nX: y", big), (1, None, big), (2, "http://b", None), (5, "http://c", ""), (None, "http://d", big), (7, "u", "z"), (7, "u", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("payload", F.lit("clash"))
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(pages), path)
    back = warc.read_warc(spark, path, verify=True)
    got = {(r.record_id, r.target_uri): r for r in back.collect()}
    assert len(got) == 6 and back.count() == 7
    first = got["<urn:page:1>", None]
    assert first.record_type == "response" and bytes(first.payload).decode() == big
    again = got["<urn:page:3>", "http://a/\r\nX: y"]
    assert again.record_type == "revisit" and again.refers_to == "<urn:page:1>" and again.payload is None
    assert again.payload_bytes == len(big.encode()) and again.payload_digest == first.payload_digest
    assert base64.b32decode(first.payload_digest) == hashlib.sha1(big.encode()).digest()
    assert got["<urn:page:5>", "http://c"].refers_to == "<urn:page:2>"
    assert got["<urn:page:->", "http://d"].record_type == "response"
    assert {r.record_type for r in back.collect() if r.record_id == "<urn:page:7>"} == {"response"}
    only = warc.read_warc(spark, path, ["record_id", "payload_bytes"]).count()
    assert only == 7
    heads = warc.read_warc(spark, path, ["record_id", "record_type"]).where("record_type = 'revisit' AND record_id LIKE '<urn:page:3%'")
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "- Filter" not in plan and ") Filter" not in plan
    assert [r.record_id for r in heads.collect()] == ["<urn:page:3>"]


def test_small_payloads_never_revisit(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id bigint, url string, html string")
    kinds = {r.record_id: r.record_type for r in warc.page_records(pages, min_bytes=3).collect()}
    assert kinds == {"<urn:page:1>": "response", "<urn:page:2>": "response", "<urn:page:3>": "response", "<urn:page:4>": "revisit"}
    assert warc.page_records(pages.limit(0)).count() == 0


# --- decontamination


def brute_hits(doc, items, window):
    own = words(doc)
    hit, found = set(), set()
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1) if w and item is not None else []:
            for at in range(len(own) - size + 1):
                if own[at : at + size] == w[k : k + size]:
                    hit.update(range(at, at + size))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "ga-mma", "12", "élan", "x"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 3, 8, 40)))) for _ in range(60)] + [None, "", "ALPHA, beta. alpha"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 2, 4, 7))))) for k in range(12)] + [(50, None), (None, "x"), (3, "beta x")]
    docs = frame(spark, texts)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.decontaminate(docs, bench, window=3)
    want = [(r.doc_id, *brute_hits(r.text, items, 3)) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=key) == sorted(want, key=key)
    clean = decontam.drop_contaminated(docs, bench, window=3)
    assert clean.columns == docs.columns
    assert clean.count() == sum(w[2] == 0 for w in want)
    assert decontam.decontaminate(docs.limit(0), bench).count() == 0
    assert decontam.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_blocks_of_the_benchmark_add_up(spark, monkeypatch):
    items = [(k, f"a{k} b c{k % 3} d") for k in range(9)]
    docs = spark.createDataFrame([(1, " ".join(t for _, t in items)), (2, "a4 b c1 d a4"), (3, "b d")], "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    whole = {r.doc_id: (r.n_hit, list(r["items"])) for r in decontam.decontaminate(docs, bench, window=4).collect()}
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 5)
    parts = {r.doc_id: (r.n_hit, list(r["items"])) for r in decontam.decontaminate(docs, bench, window=4).collect()}
    assert whole == parts == {1: (36, sorted(map(str, range(9)))), 2: (4, ["4"]), 3: (0, [])}


def test_proximity_finds_reordered_terms(spark):
    docs = spark.createDataFrame([(1, "q zeta q alpha q beta"), (2, "zeta q q q q q q alpha beta"), (3, "zeta alpha")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, "alpha beta zeta")], "item_id bigint, text string")
    index = decontam.build_index(docs)
    near = decontam.search_near(index, bench, slop=4, window=3).join(decontam.entries(index), ["segment", "ordinal"])
    assert {r.doc_id for r in near.collect()} == {1}


# --- token files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(2**40), 2**40), max_size=700), st.booleans())
def test_elias_fano_round_trip(values, narrow):
    values = np.sort(np.array([v % 9 if narrow else v for v in values], np.int64))
    code = EliasFano.encode(values)
    back, end = EliasFano.from_bytes(b"??" + code.to_bytes(), 2)
    assert end == 2 + len(code.to_bytes()) and (back.decode() == values).all()
    assert [back.select(k) for k in range(len(values))] == values.tolist()


def test_token_files_give_back_what_the_library_says(spark):
    docs = frame(spark, TEXTS)
    path = scratch_path(spark, "tokens")
    manifest = tokenfiles.write_token_files(docs, path, JSON, end=0, shards=3)
    got = tokenfiles.read_token_files(manifest, path, with_ids=True).collect()
    model = Tokenizer.from_file(JSON)
    model.encode_special_tokens = True
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    at = 0
    for want, have in zip(order, sorted(got, key=lambda r: r.start), strict=True):
        ids = model.encode(want.text or "", add_special_tokens=False).ids + [0]
        assert (have.doc_id, have.start, have.n_tokens, list(have.ids)) == (want.doc_id, at, len(ids), ids)
        assert have.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    empty = tokenfiles.write_token_files(docs.limit(0), path + "-none", JSON)
    assert tokenfiles.read_token_files(empty, path + "-none").count() == 0


# --- BPE


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.load_ranks(None, RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.Coder(ranks, public_tokenizers.PATTERN)


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from(list("aabehlnt  \n\t'st12!?é漢\x1c\xa0😀")), max_size=80))
def test_merges_equal_the_library(reference, text):
    library, coder = reference
    ids, n = coder.encode([text, "", text + " x"])
    want = library.encode_ordinary(text)
    assert ids[: n[0]].tolist() == want and n[1] == 0 and ids[n[0] :].tolist() == library.encode_ordinary(text + " x")
    assert coder.decode(want) == text.encode()


def test_bpe_rows_and_columns(spark, reference):
    docs = frame(spark, TEXTS)
    coded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, digests=True), RANKS)
    for r in coded.collect():
        want = reference[0].encode_ordinary(r.text or "")
        assert list(r.token_ids) == want and r.n_tokens == len(want) and r.decoded == (r.text or "")
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert coded.columns[:4] == docs.columns and coded.count() == docs.count()
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


# --- quality


def test_quality_learns_and_scores_everything(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choices(["the", "sea", "was", "calm", "and", "bright", "that", "day."], k=rng.randint(5, 80))) for _ in range(300)]
    bad = [" ".join(rng.choices(["$$$", "BUY!!", "###", "now!!"], k=rng.randint(5, 80))) for _ in range(300)]
    docs = spark.createDataFrame([(k, t, "c") for k, t in enumerate([*good, *bad])] + [(None, None, "c"), (7, good[7], "c"), (1000, "", "c")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(k, int(k < 300)) for k in range(600)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    assert model.tables and model.pairs
    got = quality.score(docs, model, out="s").withColumn("out", quality.fold("doc_id") == 0).collect()
    held = [r for r in got if r.out and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 60 and sum((r.s >= 0.3) == (r.doc_id < 300) for r in held) / len(held) > 0.97
    assert len(got) == docs.count() and all(0 <= r.s <= 1 for r in got)
    again = quality.train(docs.repartition(5), labels)
    assert all((a == b).all() for a, b in zip(model.tables, again.tables))
    constant = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, constant).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


# --- fingerprints


def test_fingerprints_are_homomorphic():
    a, b = "first line\nsecond line of words\n", "third\nfourth one here"
    make = lambda t: fingerprints.vectors([t])
    assert make("p\nq r s t").texts() == make("q r s t\np").texts()
    assert (make("x\ny") + make("z")).texts() == make("z\nx\ny").texts()
    assert (make("x\ny\nz") - make("y")).texts() == make("z\nx").texts()
    assert make("x\nx").texts() != make("x").texts() and make("a b").texts() != make("b a").texts()
    assert make("").texts() == fingerprints.vectors([""]).texts() and not make("").lanes.any()
    back = fingerprints.Vectors.parse(fingerprints.vectors([a, b]).texts())
    assert back.likeness(fingerprints.vectors([a, b])).tolist() == [1.0, 1.0]
    rng = random.Random(1)
    long = " ".join(str(rng.random()) for _ in range(400))
    cut = long[: len(long) * 2 // 3] + " ".join(str(rng.random()) for _ in range(130))
    assert 0.5 < make(long).likeness(make(cut))[0] < 0.85 and make(long).likeness(make("other words here now"))[0] < 0.2


def test_edits_follow_the_order_of_ids(spark):
    texts = ["", None, "abc", "äöü" * 50, "line\n" * 40, "long " * 30_000, "z"]
    docs = frame(spark, texts)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    want = []
    for k, (i, t) in enumerate(rows):
        n = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + n[:cut]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *fingerprints.vectors([t, edited]).texts()))
    got = [tuple(r)[:5] for r in fingerprints.edit_study(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert fingerprints.edit_study(docs.limit(0)).count() == 0
    one = fingerprints.edit_study(docs.where("doc_id = 3")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints.fingerprint(docs).count() == docs.count()


# --- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}
            if fits[kind]:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB.@-_+%0123456789 ()é\n")), max_size=60))
def test_base_spans_equal_the_patterns(text):
    base = pii.base_spans(text)
    assert [(k, *s) for k in pii.KINDS for s in base[k]] == brute_spans(text)


def test_base_spans_of_known_cards_and_long_runs():
    text = "pay 4111 1111 1111 1111, not 4111 1111 1111 1112; a.b@c.de.f_g@h.i +49 (30) 123-4567 300.1.1.1 1.2.3.4.5 " + "9" * 30_000 + "x" * 300_000
    assert [(k, *s) for k in pii.KINDS for s in pii.base_spans(text)[k]] == brute_spans(text[:400]) and pii.base_spans("") == pii.base_spans(None)


def test_added_spans_keep_the_base_and_pass_held_out_cases(spark):
    rng = random.Random(4)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        body = "4" + number(14)
        return next(body + str(k) for k in range(10) if pii.luhn(body + str(k)))

    def text():
        kind = rng.randrange(5)
        fill = " ".join(rng.choices(["some", "words", "for", "context"], k=6))
        datum = [f"mail {number(3)}x@host{number(2)}.org", f"host {rng.randint(1, 255)}.{rng.randint(1, 255)}.3.4", f"card {card()}", f"tel +49 {number(3)} {number(6)}", f"order {number(11)}"][kind]
        return f"{fill} {datum} {fill}"

    texts = [text() for _ in range(900)]
    docs = spark.createDataFrame([(k, t, "c") for k, t in enumerate(texts)] + [(None, None, "c"), (3, "", "c")], "doc_id bigint, text string, spans string")
    models = pii.train(docs)
    assert set(models) == set(pii.KINDS)
    for r in pii.find(docs, models, keep=["doc_id", "text"]).collect():
        base = brute_spans(r.text or "")
        listed = [x for x in r.spans.split(",") if x]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(listed) and r.base == pii.listed(base)
    fresh = card()
    dotted = ".".join(fresh[k : k + 4] for k in range(0, 16, 4))
    wrong = dotted[:-1] + str((int(dotted[-1]) + 5) % 10)
    assert ("card", 5, 5 + len(dotted)) in pii.all_spans(f"card {dotted} some words", models)[1]
    assert pii.all_spans(f"card {wrong} some words", models)[1] == []
    clean = pii.find(docs, models, redact=True)
    assert clean.columns == [*docs.columns, "redacted"]
    assert not any(brute_spans(r.redacted or "") for r in clean.collect())
    assert pii.redacted("a b@c.d e", [("email", 2, 7)]) == "a [EMAIL] e" and pii.redacted(None, []) is None
    assert pii.find(docs.limit(0), pii.train(docs.limit(0))).count() == 0


# --- long runs and odd columns


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "=", " ", "0", "ab", "é", "\n", "漢", "-"]), st.integers(1, 700)), min_size=1, max_size=6))
def test_bpe_of_long_runs(reference, runs):
    theirs, ours = reference
    text = "".join(c * n for c, n in runs)
    assert ours.encode([text])[0].tolist() == theirs.encode_ordinary(text)


def test_bpe_of_very_long_unbroken_texts(reference):
    theirs, ours = reference
    rng = random.Random(1)
    for text in ("a" * 200_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "=" * 100_000):
        assert ours.encode([text])[0].tolist() == theirs.encode_ordinary(text)


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b@c.org", "x", [1], 7, "s", "r"), (2, None, None, None, None, None, None)],
                                 "doc_id bigint, text string, `my col` string, token_ids array<int>, n_tokens int, spans string, redacted string")
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert sorted(coded.columns) == sorted(docs.columns) and {r["my col"] for r in coded.collect()} == {"x", None}
    found = pii.find(docs, {})
    assert len(set(found.columns)) == len(found.columns) and {r["spans"] for r in found.collect()} == {"email:2:9", ""}
    clean = pii.find(docs, {}, redact=True, into="_tg_redacted")
    assert {(r["redacted"], r["_tg_redacted"]) for r in clean.collect()} == {("r", "a [EMAIL]"), (None, None)}
    import corpus_pipeline

    kept = corpus_pipeline.encode_tokens(spark, corpus_pipeline.redact_personal(spark, docs.withColumn("n_chars", F.lit(9).cast("bigint")), ""), "")
    assert {r["my col"] for r in kept.collect()} == {"x", None} and len(set(kept.columns)) == len(kept.columns)
