"""Personal data in texts: fixed base patterns, and further spans chosen by boosted trees.

Generators propose overlapping spans of any kind that might fit, far more than are personal data. Trees look at the form of
each proposal and at the text around it; their calibrated probability must reach the threshold of the kind, the least at which
a held-out part of the training data was precise enough. Training data is made from a bounded sample of documents: what the
base patterns accept, also respelt in ways that the patterns do not know, against near misses (a wrong check digit, an
impossible part). Proposals that the patterns refuse count little, since some are data in another spelling.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidegrid.llm import boosting
from tidegrid.llm.common import chunks, map_batches, stored

KINDS = ("email", "ip", "card", "phone")
#: The trees are trained on at most so many documents, an eighth for each kind with a base match and with another proposal.
MAX_TRAIN = 4_000
#: Precision on held-out training rows that sets the threshold of a kind.
PRECISION = 0.98
#: Weight of a proposal that the base patterns refuse, as an example of what is not personal data.
UNLABELLED = 0.2
#: Examples of either sort from one text, and the least of a kind; data of its form are planted to reach it.
PER_TEXT, LEAST_EXAMPLES = 40, 200
NEAR = 24  # characters of context on either side

# The base patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

# Proposals beyond the base patterns.
NUMBER = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[ ().\-/_]{0,3}[0-9]){6,23}(?![0-9A-Za-z])")
DOTTED = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}){3}(?![0-9A-Za-z])")
SPELT_AT = re.compile(r" ?(?:\(at\)|\[at\]|\{at\}|\[@\]|\(@\)) ?", re.IGNORECASE)
SPELT_HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\[\.\]|\(\.\)) ?|\.)[A-Za-z0-9-]{1,63}){1,5}", re.IGNORECASE)
HINTS = {
    "email": ("mail", "contact", "write", "address", "courriel", "correo"),
    "ip": ("ip", "host", "server", "addr", "node", "client"),
    "card": ("card", "visa", "pay", "credit", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "ring", "llama"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the pattern, found from the at-signs: the local part is the run of its characters before one."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Start and end of every base match by kind; null and empty texts have none."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return out
    out["email"] = emails(text)
    if "." in text:
        out["ip"] = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(DIGITS.findall(m[0])) <= 15]
    return out


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Spans of every kind they might be; they may overlap."""
    out = []
    for m in NUMBER.finditer(text):
        n = len(DIGITS.findall(m[0]))
        out += [("card", *m.span())] * (12 <= n <= 20) + [("phone", *m.span())] * (7 <= n <= 15)
    if "." in text:
        out += [("ip", *m.span()) for m in DOTTED.finditer(text)]
    for m in SPELT_AT.finditer(text):
        start = m.start()
        while start > max(0, m.start() - 64) and text[start - 1] in LOCAL:
            start -= 1
        host = SPELT_HOST.match(text, m.end())
        if start < m.start() and host:
            out.append(("email", start, host.end()))
    return out


def described(kind: str, span: str, left: str, right: str) -> list[float]:
    """Format and context of one proposal."""
    digits = "".join(DIGITS.findall(span))
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    parts = re.findall(r"[0-9]+", span)
    marks = {c for c in span if not c.isalnum()}
    words = re.findall(r"[A-Za-z]+", span)
    before = left.lower()
    return [
        len(span),
        len(digits),
        len(groups),
        max(groups),
        min(groups),
        len(marks),
        float(luhn(digits)) if digits else -1.0,
        float(span.startswith("+") or span.startswith("00")),
        float("(" in span and ")" in span),
        float(all(len(p) <= 3 and int(p) <= 255 for p in parts)) if parts else -1.0,
        len(set(digits)),
        len(words[-1]) if words else 0,
        len(words),
        float(digits[:1] in "3456") if digits else -1.0,
        float(left[-1:].isspace() or not left),
        float(right[:1].isspace() or not right),
        float(right[:1] in ".,;)"),
        float(any(h in before for h in HINTS[kind])),
        float(before.rstrip().endswith((":", "=", "-"))),
        sum(c.isdigit() for c in left) + sum(c.isdigit() for c in right),
    ]


def around(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[start:end], text[max(0, start - NEAR) : start], text[end : end + NEAR]


def respelt(kind: str, span: str, rng: random.Random) -> list[str]:
    """The same datum in spellings that the base patterns may not know."""
    digits = "".join(DIGITS.findall(span))
    if kind == "email":
        name, _, host = span.rpartition("@")
        at, dot = rng.choice((" (at) ", "(at)", " [at] ", "[@]")), rng.choice((" (dot) ", "[dot]", ".", "[.]"))
        return [name + at + host.replace(".", dot)]
    if kind == "ip":
        return [span.replace(".", rng.choice(("[.]", "(.)")))]
    if kind == "card":
        by = rng.choice("./_")
        return [by.join(digits[k : k + 4] for k in range(0, len(digits), 4))]
    return ["00" + rng.choice(("", " ")) + span[1:], rng.choice("./ -").join([f"(0{digits[2:4]})", digits[4:7], digits[7:]])]


def spoilt(kind: str, span: str, rng: random.Random) -> list[str]:
    """Near misses of a datum."""
    digits = [k for k, c in enumerate(span) if c.isdigit()]
    if kind == "card" and digits:
        k = rng.choice(digits)
        return [span[:k] + str((int(span[k]) + rng.randint(1, 9)) % 10) + span[k + 1 :]]
    if kind == "ip":
        parts = span.split(".")
        parts[rng.randrange(4)] = str(rng.randint(256, 999))
        return [".".join(parts), "[.]".join(parts)]
    if kind == "phone":
        plain = "".join(span[k] for k in digits)
        return [plain, "".join(rng.choice("0123456789") for _ in range(rng.randint(7, 16)))]
    name = re.sub(r"[@.]", " ", span)
    return [name, span.split("@")[0] + " (at) " + "home"]


def made(kind: str, rng: random.Random) -> str:
    """A datum of the kind as the base patterns know it, out of thin air."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))
    if kind == "email":
        return f"{word()}{rng.choice(('', '.', '_'))}{word()}@{word()}.{rng.choice(('com', 'org', 'net', 'de', 'fr', 'es'))}"
    if kind == "ip":
        return ".".join(str(rng.randint(1, 255)) for _ in range(4))
    if kind == "card":
        body = rng.choice("3456") + digits(14)
        return next(body + c for c in "0123456789" if luhn(body + c))
    return f"+{rng.randint(1, 99)} {digits(rng.randint(2, 4))} {digits(rng.randint(5, 8))}"


def spread(items: list, most: int) -> list:
    """At most so many of the items, evenly from all of them."""
    return items if len(items) <= most else [items[k * len(items) // most] for k in range(most)]


def taught(kind: str, span: str, left: str, right: str, rng: random.Random) -> list[tuple[str, float, float, list[float]]]:
    """Kind, label, weight and description of a datum, its other spellings and its near misses in one context."""
    out = [(kind, 1.0, 1.0, described(kind, s, left, right)) for s in [span, *respelt(kind, span, rng)]]
    out += [(kind, 0.0, 1.0, described(kind, s, left, right)) for s in spoilt(kind, span, rng)]
    for s in [span, *respelt(kind, span, rng), *spoilt(kind, span, rng)]:  # and it is of no other kind, however it is written
        out += [(k, 0.0, 1.0, described(k, s[a:b], (left + s[:a])[-NEAR:], (s[b:] + right)[:NEAR])) for k, a, b in proposals(s) if k != kind]
    return out


def examples(texts: list[str]) -> list[tuple[str, float, float, list[float]]]:
    """Training spans of texts, at most PER_TEXT of either sort and kind from each; in each text also one planted datum of each kind."""
    out = []
    for text in texts:
        base = base_spans(text)
        rng = random.Random(len(text))
        for kind in KINDS:
            for start, end in spread(base[kind], PER_TEXT):
                out += taught(kind, *around(text, start, end), rng)
            at = rng.randint(0, len(text))
            planted = taught(kind, made(kind, rng), text[max(0, at - NEAR) : at] + " ", " " + text[at : at + NEAR], rng)
            out += [("planted " + k, *rest) for k, *rest in planted]
        taken = {(k, *s) for k in KINDS for s in base[k]}
        other = [p for p in proposals(text) if p not in taken]
        for kind in KINDS:
            out += [(k, 0.0, UNLABELLED, described(k, *around(text, a, b))) for k, a, b in spread([p for p in other if p[0] == kind], PER_TEXT)]
    return out


def train(docs: DataFrame, max_train: int = MAX_TRAIN, id: str = "doc_id", text: str = "text") -> dict[str, boosting.Trees]:
    """Calibrated trees by kind.

    At most ``max_train`` documents are learnt from, one text of each and PER_TEXT examples of a sort, so what is broadcast and
    collected is bounded: for each kind those with the smallest hashed ids among all that have a base match of it, and among
    all that have another proposal. A kind with fewer than LEAST_EXAMPLES learns also from data of its form that are planted
    in these texts, so none is without a model unless no document holds anything like personal data. Null ids are left out.
    """
    named = docs.select(F.col(id).alias("_tg_id"), F.col(text).alias("text")).where("_tg_id IS NOT NULL")
    flags = [f"{sort}_{k}" for k in KINDS for sort in ("base", "other")]

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows = []
            for t in batch.column("text").to_pylist():
                base = base_spans(t)
                other = {k for k, *span in (proposals(t) if t else []) if tuple(span) not in base[k]}
                rows.append([has for k in KINDS for has in (bool(base[k]), k in other)])
            held = np.array(rows, bool).reshape(-1, len(flags))
            some = held.any(axis=1)
            ids = batch.column("_tg_id").filter(pa.array(some))
            yield pa.RecordBatch.from_pydict({"_tg_id": ids} | {f: pa.array(held[some, k]) for k, f in enumerate(flags)})

    schema = StructType([named.schema["_tg_id"]])
    for flag in flags:
        schema = schema.add(flag, "boolean")
    held = stored(map_batches(named, holding, schema))
    first = [held.where(f).select("_tg_id").distinct().orderBy(F.xxhash64("_tg_id"), "_tg_id").limit(max(1, max_train // len(flags))) for f in flags]
    ids = stored(reduce(DataFrame.union, first).distinct())
    texts = named.join(F.broadcast(ids), "_tg_id").groupBy("_tg_id").agg(F.min("text").alias("text")).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = examples([t for t in batch.column("text").to_pylist() if t])
            yield pa.RecordBatch.from_pydict(
                {
                    "kind": pa.array([r[0] for r in rows], pa.string()),
                    "label": pa.array([r[1] for r in rows], pa.float64()),
                    "weight": pa.array([r[2] for r in rows], pa.float64()),
                    "form": pa.array([r[3] for r in rows], pa.list_(pa.float64())),
                }
            )

    got: dict[str, list] = {prefix + k: [] for k in KINDS for prefix in ("", "planted ")}
    for r in map_batches(texts, run, "kind string, label double, weight double, form array<double>").collect():
        got[r.kind].append([r.label, r.weight, *r.form])
    models = {}
    for kind in KINDS:
        rows = np.array(sorted(got[kind]))
        if not len(rows) or rows[:, 0].sum() < LEAST_EXAMPLES:
            rows = np.array(sorted(got[kind]) + sorted(got["planted " + kind]))
        if not len(rows) or min(rows[:, 0].sum(), (1 - rows[:, 0]).sum()) < 10:
            continue  # next to nothing in the whole input: no document to learn from
        rows = rows[np.random.default_rng(1).permutation(len(rows))]
        seen = len(rows) * 7 // 10
        models[kind] = boosting.fit(rows[:seen, 2:], rows[:seen, 0], rows[:seen, 1])
        models[kind].calibrate(rows[seen:, 2:], rows[seen:, 0], rows[seen:, 1], PRECISION)
    return models


class Taken:
    """Stretches of a text that are covered."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k == 0 or self.ends[k - 1] <= start

    def add(self, start: int, end: int) -> None:
        k = bisect_left(self.starts, start)
        self.starts.insert(k, start)
        self.ends.insert(k, end)


def all_spans(text: str | None, models: dict[str, boosting.Trees]) -> tuple[dict, list[tuple[str, int, int]]]:
    """Base spans by kind, and all spans in order: base ones stay, added ones overlap no other span."""
    text = text or ""
    base = base_spans(text)
    out = [(k, *s) for k in KINDS for s in base[k]]
    taken = Taken([s for own in base.values() for s in own])
    more = [p for p in proposals(text) if p[0] in models and taken.free(*p[1:])] if text else []
    scored = []
    for kind in {p[0] for p in more}:
        own = [p for p in more if p[0] == kind]
        chance = models[kind].probability(np.array([described(kind, *around(text, a, b)) for _, a, b in own]))
        scored += [(-c, p) for c, p in zip(chance, own) if c >= models[kind].threshold]
    for _, p in sorted(scored):
        if taken.free(*p[1:]):
            taken.add(*p[1:])
            out.append(p)
    return base, sorted(out, key=lambda p: (KINDS.index(p[0]), p[1], p[2]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, models: dict[str, boosting.Trees], text: str = "text", keep: list[str] | None = None, redact: bool = False, into: str = "redacted") -> DataFrame:
    """Each row's base and added spans, as counts and text; with ``redact`` the text itself, spans replaced by their kind, as ``into``.

    Null texts have no spans and stay null. Rows stay one by one and keep the columns ``keep`` (default: all), whatever their
    names; one named like a result is replaced. Positions are code points, ends exclusive. An empty table stays empty.
    """
    kinds = [f"n_{k}" for k in KINDS]
    results = [into] if redact else [*kinds, "base", "spans"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in results]
    sent = docs.sparkSession.sparkContext.broadcast(models)
    rows = docs.select(F.struct(F.lit(0).alias("_tg"), *[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            texts = batch.column("text").to_pylist()
            found = [all_spans(t, sent.value) for t in texts]
            columns = {"row": batch.column("row")}
            if redact:
                columns["redacted"] = pa.array([redacted(t, spans) for t, (_, spans) in zip(texts, found)], pa.string())
            else:
                columns |= {n: pa.array([len(base[k]) for base, _ in found], pa.int64()) for n, k in zip(kinds, KINDS)}
                columns["base"] = pa.array([listed([(k, *s) for k in KINDS for s in base[k]]) for base, _ in found], pa.string())
                columns["spans"] = pa.array([listed(spans) for _, spans in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = StructType([rows.schema["row"]])
    for n in [] if redact else kinds:
        schema = schema.add(n, "long")
    for n in ["redacted"] if redact else ["base", "spans"]:
        schema = schema.add(n, "string")
    made = map_batches(rows, run, schema)
    return made.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *[F.col(c).alias(name) for c, name in zip(made.columns[1:], results)])


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its kind; overlapping spans are one stretch, named after its first."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
