"""Alignment of two tokenizers against whole-text encoding, plain counting and one dictionary of all pairs."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tidegrid.llm import alignment, queries_spans

A_FILE, B_FILE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [None, "", " ", "a", "a ", "  two  spaces ", "\n\t lines\r\n  x", "<|endoftext|> <s> </s> <unk> <0x41>", "literal \u2581 mark", "\u2581",
       "na\u00efve \u6f22\u5b57 \U0001f600\U0001f600 e\u0301 \ufb01 \u00a0 x", "x" * 3000, "0" * 500 + " " * 40 + "=" * 99, "\x00\x01 \u200b", "the the the the"]


def slow(texts):
    """Per text: counts, groups, and the links; by sets of byte offsets."""
    a_model = Tokenizer.from_file(A_FILE)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    chars = alignment.byte_characters()
    out = []
    for text in texts:
        if not text:
            out.append(([], "", 0, 0))
            continue
        a = a_model.encode(" " + text, add_special_tokens=False)
        b = b_model.encode(text)
        a_bytes = [bytes(chars[c] for c in t) for t in a.tokens]
        b_bytes = [bytes([int(b_model.id_to_piece(k)[3:-1], 16)]) if b_model.is_byte(k) else b_model.id_to_piece(k).replace("\u2581", " ").encode() for k in b]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            out.append(([], "", 0, 0))
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        cuts = sorted(set(a_ends.tolist()) & set(b_ends.tolist()))
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        own = [([i for i, g in zip(a.ids, a_group) if g == k], [i for i, g in zip(b, b_group) if g == k]) for k in range(len(cuts))]
        links = [(x, y) for xs, ys in own for x in xs for y in ys]
        out.append((links, ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in own), len(a.ids), len(b)))
    return out


def expected(texts):
    rows = slow(texts)
    count = Counter(p for links, *_ in rows for p in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [
        (n_a, n_b, len(g.split(";")) if g else 0, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), g)
        for links, g, n_a, n_b in rows
    ]


def corpus(n):
    rng = random.Random(3)
    words = ["the", "Straße", "token", "über", "12345", "don't", "x=y;", "(a)", "Señor", "internationalization", "漢字", "\n", "AKIA7Q", "....", "e\u0301t"]
    return [(" " if rng.random() < 0.9 else "").join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(n)] + ODD


def test_rows_equal_plain_counting_at_any_fan(spark):
    texts = corpus(120)
    rows = [(k, t, "c", 5) for k, t in enumerate(texts)] + [(0, texts[0], "c", 5), (None, texts[1], None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `my col` string, n_best int").repartition(23, "doc_id")
    want = expected([r[1] for r in rows])
    order = [(-1 if r[0] is None else r[0]) for r in rows]
    for fan in (128, 3):
        made = alignment.align(docs, A_FILE, B_FILE, fan=fan)
        assert made.columns == ["doc_id", "text", "my col", *alignment.COUNTS, "n_best", "count_sum", "groups"]
        got = sorted((-1 if r.doc_id is None else r.doc_id, *(r[c] for c in made.columns[3:])) for r in made.collect())
        assert got == sorted((k, *w) for k, w in zip(order, want))
    assert alignment.align(docs.limit(0), A_FILE, B_FILE).count() == 0


def test_query_rows(spark, tmp_path):
    texts = corpus(30)
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries_spans.op13_token_alignment(spark, str(tmp_path)).collect()}
    for k, (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) in enumerate(expected(texts)):
        r = got[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == (n_a, n_b, n_groups, n_links, n_best, count_sum)
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_pieces_are_encoded_as_in_the_whole_text():
    texts = [t for t in corpus(300) if t]
    aligner = alignment.Aligner(A_FILE, B_FILE)
    counts, groups, *_ = aligner.align(texts)
    for text, own, listed in zip(texts, counts, groups):
        found = aligner.whole(text)
        made = aligner.aligned(*found)[0] if found else []
        assert listed == ";".join(made)
        assert tuple(own[:2]) == ((len(found[0]), len(found[1])) if found else (0, 0))


def test_packed_numbers_come_back():
    x = np.array([0, 1, 1, 500, 2**40, -7], np.int64)
    assert alignment.unpack(alignment.pack(x)).tolist() == x.tolist()
    y = np.array([3, 3, 9, 2**33], np.int64)
    assert alignment.unpack(alignment.pack(y, ordered=True), ordered=True).tolist() == y.tolist()
    assert len(alignment.unpack(alignment.pack(x[:0]))) == 0
