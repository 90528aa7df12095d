"""Quality scores of documents by a generalised additive model with pairwise interactions.

Each feature of a text falls into a bin; a score is the sum of one table entry per feature and one per chosen pair of
features. The tables are learnt by cyclic boosting: in turn, each feature (later each pair) gets a shallow tree over its
bins, fitted to what is still unexplained, shrunk and added to its table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidegrid.llm.common import chunks, map_batches, words

#: The model is fitted on at most so many labelled rows, those with the smallest hashed ids.
MAX_TRAIN = 20_000
FEATURES = (
    "log_words mean_word long_words distinct_words repeated_next top_word symbols bars bangs upper digits non_ascii stops lines spaces"
).split()
GROUPS = {"symbols": b"#$%&*@^~=+<>{}[]_\\", "bars": b"|", "bangs": b"!?", "digits": b"0123456789", "stops": b".,;:", "lines": b"\n", "spaces": b" \t"}


def features(texts: list[str | None]) -> np.ndarray:
    """One row of FEATURES per whole text; null and empty texts have zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    masks = np.zeros((256, len(GROUPS)))
    for k, group in enumerate(GROUPS.values()):
        masks[list(group), k] = 1
    at = {name: k for k, name in enumerate(FEATURES)}
    columns = [at[name] for name in GROUPS]
    for k, text in enumerate(texts):
        if not text:
            continue
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        count = np.bincount(raw, minlength=256)
        row, own = out[k], words(text)
        row[columns] = count @ masks / len(raw)
        upper, lower = count[65:91].sum(), count[97:123].sum()
        row[at["upper"]] = upper / max(1, upper + lower)
        row[at["non_ascii"]] = count[128:].sum() / len(raw)
        n = len(own)
        row[at["log_words"]] = np.log1p(n)
        if n:
            tally: dict[bytes, int] = {}
            for w in own:
                tally[w] = tally.get(w, 0) + 1
            sizes = np.fromiter(map(len, own), np.int64, n)
            row[at["mean_word"]] = sizes.mean()
            row[at["long_words"]] = (sizes > 12).mean()
            row[at["distinct_words"]] = len(tally) / n
            row[at["top_word"]] = max(tally.values()) / n
            row[at["repeated_next"]] = sum(map(bytes.__eq__, own, own[1:])) / n
    return out


@dataclass
class Model:
    """Bin edges and tables; ``pairs`` lists the features of each pair table, on coarser bins."""

    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edge, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best cut of ordered bins, and its gain."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    k = int(np.argmax(gains))
    return float(gains[k]), k + 1


def _shallow(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A tree of a few leaves over the bins of one feature: the value of each bin."""
    parts = [(0, len(g))]
    for _ in range(leaves - 1):
        cuts = [(*_split(g[a:b], h[a:b]), a, b) for a, b in parts]
        best, cut, a, b = max(cuts)
        if best <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _shallow_pair(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree of depth two over a grid: one cut across, then one in each half. Its gain and the value of each cell."""
    best, out = 0.0, np.zeros_like(g)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(gg)):
            gain, value = -_gain(gg.sum(), hh.sum()), np.zeros_like(gg)
            for rows in (slice(0, cut), slice(cut, None)):
                a, b = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
                _, k = _split(a, b)
                for cells in (slice(0, k), slice(k, None)):
                    s, t = a[cells].sum(), b[cells].sum()
                    gain += _gain(s, t)
                    value[rows, cells] = s / (t + 1.0)
            if gain > best:
                best, out = float(gain), value.T if turned else value
    return best, out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 30, n_pairs: int = 6, rate: float = 0.1, bins: int = 48) -> Model:
    """Tables for 0/1 labels ``y``. Without rows, or with one label only, the model is a constant."""
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Model(float(np.log(rate_of_ones / (1 - rate_of_ones))))
    if len(y) == 0 or y.min() == y.max():
        return model
    count = x.shape[1]
    model.edges = [_edges(x[:, j], bins) for j in range(count)]
    model.coarse = [_edges(x[:, j], 10) for j in range(count)]
    code = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    margin = np.full(len(y), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _shallow(np.bincount(code[j], g, len(table)), np.bincount(code[j], h, len(table)))
            table += step
            margin += step[code[j]]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        shape = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
        return np.bincount(rough[a] * shape[1] + rough[b], v, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ranked = sorted(((_shallow_pair(grid(a, b, g), grid(a, b, h))[0], a, b) for a, b in combinations(range(count), 2)), reverse=True)
    model.pairs = [(a, b) for gain, a, b in ranked[:n_pairs] if gain > 0]
    model.pair_tables = [np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = rate * _shallow_pair(grid(a, b, g), grid(a, b, h))[1]
            table += step
            margin += step[rough[a], rough[b]]
    return model


def fold(id: str | Column) -> Column:
    """Remainder of the checksum of the id as text by 5; 0 is held out."""
    return F.pmod(F.crc32(F.col(id).cast("string") if isinstance(id, str) else id), F.lit(5))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The model for ``labels``, learnt from rows outside the held-out fold.

    At most ``max_train`` labelled rows are used, so what is broadcast and collected (their features) is bounded. Rows with
    a null id or label are left out; an id that is repeated in ``labels`` counts once, by its greatest label.
    """
    known = labels.select(F.col(id).alias("_tg_id"), F.col(label).cast("double").alias("_tg_label")).dropna()
    known = known.where(fold("_tg_id") != 0).groupBy("_tg_id").agg(F.max("_tg_label").alias("_tg_label"))
    known = known.orderBy(F.xxhash64("_tg_id"), "_tg_id").limit(max_train)
    texts = docs.select(F.col(id).alias("_tg_id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(known), "_tg_id").select("_tg_label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            made = features(batch.column("text").to_pylist())
            columns = {"y": batch.column("_tg_label")} | {f"f{k}": pa.array(made[:, k]) for k in range(len(FEATURES))}
            yield pa.RecordBatch.from_pydict(columns)

    schema = "y double, " + ", ".join(f"f{k} double" for k in range(len(FEATURES)))
    got = np.array(map_batches(rows, run, schema).collect(), np.float64).reshape(-1, len(FEATURES) + 1)
    got = got[np.lexsort(got.T)]  # the same tables, whatever the order of arrival
    return fit(got[:, 1:], got[:, 0])


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score of 0 to 1 for every row; a null text counts as empty. A column named ``out`` is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            made = sent.value.score(features(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "score": pa.array(made, pa.float64())})

    made = map_batches(rows, run, StructType([rows.schema["row"]]).add("score", "double"))
    return made.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != out], F.col("score").alias(out))
