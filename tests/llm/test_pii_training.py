"""The personal-data trees: their training sample, and what they add on spellings that the base patterns do not know."""

import random

from tidegrid.llm import pii


def test_a_rare_kind_has_a_model(spark):
    """Twenty texts in two thousand hold an address; a blind sample of 400 would hold four."""
    texts = [f"mail x{k}@host{k}.org to me" if k % 100 == 0 else f"order 123456{k} words {k}" for k in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert set(pii.train(docs, max_train=400)) == set(pii.KINDS)


def test_held_out_spellings_are_found_and_near_misses_left(spark):
    rng = random.Random(4)
    words = "the order of last week was sent to you by our house and will come soon please write or call if not".split()

    def text(*data):
        out = rng.choices(words, k=40)
        for d in data:
            out.insert(rng.randint(1, 39), d)
        return " ".join(out)

    known = [text(*(pii.made(k, rng) for k in pii.KINDS if rng.random() < 0.4)) for _ in range(900)]
    docs = spark.createDataFrame(list(enumerate(known)), "doc_id bigint, text string")
    models = pii.train(docs)
    hit, planted, wrong, missed = 0, 0, 0, 0
    for kind in pii.KINDS:
        for _ in range(150):
            datum = pii.made(kind, rng)
            fresh = rng.choice(pii.respelt(kind, datum, rng))
            body = text()
            at = body.index(" ", rng.randint(5, 120)) + 1
            base, spans = pii.all_spans(f"{body[:at]}{fresh} {body[at:]}", models)
            known_already = any(s < at + len(fresh) and e > at for own in base.values() for s, e in own)
            if not known_already:
                planted += 1
                hit += any(s < at + len(fresh) and e > at for _, s, e in spans)
            near = rng.choice(pii.spoilt(kind, datum, rng))
            base, spans = pii.all_spans(f"{body[:at]}{near} {body[at:]}", models)
            if not any(base.values()):
                missed += 1
                wrong += bool(spans)
    print(f"added spans on held-out spellings: recall {hit / planted:.3f} of {planted}, near misses taken {wrong / missed:.3f} of {missed}")
    assert hit >= 0.85 * planted and wrong <= 0.1 * missed


def test_a_text_with_many_numbers_and_a_repeated_id_stay_bounded(spark):
    many = " ".join(str(10**13 + k) for k in range(5000))
    assert len(pii.examples([many])) < 40 * pii.PER_TEXT
    docs = spark.createDataFrame([(1, many)] * 50 + [(2, "a b@c.org")], "doc_id bigint, text string")
    assert pii.find(docs, pii.train(docs)).count() == 51
