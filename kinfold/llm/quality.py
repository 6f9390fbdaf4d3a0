"""Co-trained quality classifier (operator 4).

Two views of a document are learned apart: its content (which words and symbol
runs it holds) and its page metadata (source, language, length and layout).
In each round every unlabelled document is scored by each view's logistic
regression, and some of those that a view is sure of are handed to the other
view as labelled. At the end the two are calibrated together on labelled
documents that neither has seen, and every document is scored. One such pair is
trained for quality, one for toxicity.

The fit takes at most ``max_labels`` labelled documents and, a round, at most
``max_handed`` documents of either class from either view: those of the smallest
id hashes among all that qualify.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .pretoken import mixed, span_hashes
from .shared import temporary, written
from .shingles import LOWER, byte_groups, words_of

CONTENT_BITS, META_BITS = 18, 12
WORD, SYMBOL = 1, 2
#: Of each byte: white space and controls 0, letters, digits and bytes of other scripts 1, symbols 2.
KIND = np.zeros(256, np.uint8)
KIND[33:127] = SYMBOL
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    KIND[_a:_b] = WORD
MAX_LABELS, MAX_HANDED, ROUNDS, SURE = 8000, 250, 3, 0.97


def _rows(doc: np.ndarray, place: np.ndarray, bits: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features by document: counts and features."""
    both = np.unique((doc.astype(np.int64) << bits) | place.astype(np.int64))
    return np.bincount(both >> bits, minlength=n), both & ((1 << bits) - 1)


class Views:
    """Hashed binary features of both views for a run of texts."""

    def content(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind, low, docs, places = KIND[data], LOWER[data], [], []
        for what in (WORD, SYMBOL):
            s, e, of = words_of(data, offsets, kind == what)
            if len(s):
                docs.append(np.repeat(np.arange(len(of) - 1), np.diff(of)))
                places.append(mixed(span_hashes(low, s, e) + np.uint64(what)) >> np.uint64(64 - CONTENT_BITS))
        none = np.zeros(0, np.int64)
        return _rows(np.concatenate(docs) if docs else none, np.concatenate(places) if places else none, CONTENT_BITS, len(offsets) - 1)

    def metadata(self, data: np.ndarray, offsets: np.ndarray, lang: list, source: list, n_chars: list) -> tuple[np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        total = lambda flags: (c := np.append(0, np.cumsum(flags)))[offsets[1:]] - c[offsets[:-1]]
        size = np.maximum(np.diff(offsets), 1)
        s, _, of = words_of(data, offsets, KIND[data] != 0)
        words = np.diff(of)
        upper, symbols = total((data >= 65) & (data <= 90)), total(KIND[data] == SYMBOL)
        digits, lines = total((data >= 48) & (data <= 57)), total(data == 10) + 1
        log = lambda x: np.floor(2 * np.log2(np.maximum(x, 0) + 1.0))
        share = lambda x: np.floor(16 * np.sqrt(x / size))
        chars = np.array([np.nan if x is None else x for x in n_chars], float)
        numbers = [np.where(np.isnan(chars), -1, log(np.nan_to_num(chars))), log(words), log(lines), log(size / lines), share(upper), share(symbols), share(digits), np.floor(size / np.maximum(words, 1))]
        named = [np.array([_hash_text(v) for v in column], np.uint64) for column in (lang, source)]
        values = [x.astype(np.int64).view(np.uint64) for x in numbers] + named
        places = np.concatenate([mixed(mixed(v) + np.uint64(k + 1)) >> np.uint64(64 - META_BITS) for k, v in enumerate(values)])
        return _rows(np.tile(np.arange(n), len(values)), places, META_BITS, n)


def _hash_text(value) -> int:
    h = 1469598103934665603
    for byte in (b"\xff" if value is None else str(value).encode()):
        h = (h ^ byte) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
    return h


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def margins(self, counts: np.ndarray, places: np.ndarray) -> np.ndarray:
        total = np.append(0.0, np.cumsum(self.weights[places], dtype=float))
        ends = np.append(0, np.cumsum(counts))
        return total[ends[1:]] - total[ends[:-1]] + self.bias


def _pick(counts: np.ndarray, places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.cumsum(counts) - counts
    take = counts[rows]
    at = np.repeat(start[rows] - (np.cumsum(take) - take), take) + np.arange(take.sum())
    return take, places[at]


def fit_linear(counts: np.ndarray, places: np.ndarray, y: np.ndarray, size: int, steps: int = 80, ridge: float = 1e-4, rate: float = 0.15, least: float = 2.5) -> Linear:
    """Logistic regression on binary features by full-batch Adam.

    A feature counts in proportion to how far the positive rows that have it are
    from what chance would give, in standard deviations; below ``least`` it is
    left out, so that a few telling words outweigh many rare ones.
    """
    used, at = np.unique(places, return_inverse=True)
    row = np.repeat(np.arange(len(counts)), counts)
    prior = np.clip(y.mean(), 0.01, 0.99)
    seen = np.bincount(at, minlength=len(used))
    away = np.abs(np.bincount(at, y[row], len(used)) - prior * seen) / np.sqrt(prior * (1 - prior) * seen + 0.5)
    telling = away >= least
    used, scale, kept = used[telling], away[telling] / 5, telling[at]
    at, row = (np.cumsum(telling) - 1)[at[kept]], row[kept]
    w, m, v = (np.zeros(len(used) + 1) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        z = np.bincount(row, (scale * w[:-1])[at], len(counts)) + w[-1]
        error = (_sigmoid(z) - y) / len(y)
        g = np.append(np.bincount(at, error[row], len(used)) * scale + ridge * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    out = np.zeros(size, np.float32)
    out[used] = scale * w[:-1]
    return Linear(out, float(w[-1]))


@dataclass
class CoTrained:
    """A pair of views and how their margins combine to a probability."""

    content: Linear
    metadata: Linear
    mix: np.ndarray

    def probability(self, content: tuple, metadata: tuple) -> np.ndarray:
        a, b = self.content.margins(*content), self.metadata.margins(*metadata)
        return _sigmoid(self.mix[0] * np.clip(a, -30, 30) + self.mix[1] * np.clip(b, -30, 30) + self.mix[2])


def calibrated(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights of the margins, none below 0, and a constant: Newton steps with a weak pull to zero.

    A view whose weight would be negative is left out and the rest fitted again.
    """
    views = list(range(x.shape[1]))
    while True:
        design = np.column_stack([*(np.clip(x[:, v], -30, 30) for v in views), np.ones(len(x))])
        w = np.zeros(design.shape[1])
        for _ in range(steps):
            p = _sigmoid(design @ w)
            h = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(len(w))
            w -= np.clip(np.linalg.solve(h, design.T @ (p - y) + 0.1 * w), -2, 2)
        if not views or w[:-1].min() >= 0:
            break
        del views[int(np.argmin(w[:-1]))]
    out = np.zeros(x.shape[1] + 1)
    out[[*views, -1]] = w
    return out


def _joined(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    return np.append(a[0], b[0]), np.append(a[1], b[1])


@dataclass
class CoFit:
    """One target's training: the labelled rows of both views, and what each has been handed by the other."""

    views: tuple[tuple, tuple]
    y: np.ndarray
    handed: list = field(default_factory=lambda: [{}, {}])

    def __post_init__(self):
        rows = np.arange(len(self.y))
        self.held, self.kept = rows[::5], np.setdiff1d(rows, rows[::5])

    @property
    def trainable(self) -> bool:
        """Both the training rows and every fifth one, held out for the calibration, have both classes."""
        return len(np.unique(self.y[self.kept])) == 2 == len(np.unique(self.y[self.held]))

    def hand(self, view: int, key, features: tuple, label: int) -> None:
        """Give a view a row (count, places) with a label. A key's last label counts."""
        self.handed[view][key] = (features, label)

    def fit(self) -> tuple[Linear, Linear]:
        models = []
        for v, size in ((0, 1 << CONTENT_BITS), (1, 1 << META_BITS)):
            rows, target = _pick(*self.views[v], self.kept), self.y[self.kept].astype(float)
            if self.handed[v]:
                extra, labels = zip(*(self.handed[v][k] for k in sorted(self.handed[v])), strict=True)
                rows = _joined(rows, (np.array([len(x) for x in extra], np.int64), np.concatenate(extra)))
                target = np.append(target, np.array(labels, float))
            models.append(fit_linear(*rows, target, size))
        return models[0], models[1]

    def calibrated(self, models: tuple[Linear, Linear]) -> CoTrained:
        x = np.column_stack([m.margins(*_pick(*view, self.held)) for m, view in zip(models, self.views, strict=True)])
        return CoTrained(*models, calibrated(x, self.y[self.held].astype(float)))


@dataclass
class QualityModel:
    quality: CoTrained | None
    toxic: CoTrained | None


COLUMNS = {"text": "string", "lang": "string", "source": "string", "n_chars": "long"}
TABLE = pa.schema([("doc_id", pa.int64()), ("content", pa.binary()), ("metadata", pa.binary())])


def _features(batch: pa.RecordBatch, views: Views, at: list[int]):
    """(first row, content, metadata) of runs of the batch's rows. ``at``: where it has the columns of COLUMNS."""
    lang, source, chars = (batch.column(i).to_pylist() for i in at[1:])
    for first, data, offsets in byte_groups(batch.column(at[0])):
        here = slice(first, first + len(offsets) - 1)
        yield first, views.content(data, offsets), views.metadata(data, offsets, lang[here], source[here], chars[here])


def _viewed(docs: DataFrame, kept: list[str]) -> tuple[list, list[int]]:
    """Columns to select: those kept, and those of COLUMNS that aren't among them in the right type; and where COLUMNS are."""
    kinds = dict(docs.dtypes)
    picked, at = [F.col(f"`{c}`").alias(f"kept__{i}") for i, c in enumerate(kept)], []
    for c, kind in COLUMNS.items():
        if c in kept and kinds[c] == kind.replace("long", "bigint"):
            at.append(kept.index(c))
        else:
            at.append(len(picked))
            picked.append((F.col(c) if c in kinds else F.lit(None)).cast(kind).alias(f"view__{c}"))
    return picked, at


def _packed(counts: np.ndarray, places: np.ndarray) -> pa.Array:
    """Places as 4-byte numbers, a binary value a document."""
    ends = np.append(0, 4 * np.cumsum(counts)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(places.astype("<i4"))])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    places = np.frombuffer(column.buffers()[2] or b"", "<i4", (ends[-1] - ends[0]) // 4, ends[0]) if ends[-1] > ends[0] else np.zeros(0, np.int32)
    return np.diff(ends).astype(np.int64) // 4, places.astype(np.int64)


def features(docs: DataFrame) -> DataFrame:
    """doc_id and both views' features, for every document of an id."""
    picked, at = _viewed(docs, [])
    at = [i + 1 for i in at]

    def run(batches):
        views = Views()
        for batch in batches:
            for first, content, metadata in _features(batch, views, at):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(content[0])), _packed(*content), _packed(*metadata)], schema=TABLE)

    return docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), *picked).mapInArrow(run, "doc_id long, content binary, metadata binary")


def _collected(table: DataFrame, wanted: DataFrame) -> pa.Table:
    """The rows of features() with an id of ``wanted``, and its other columns, in the order of ids and features. ``wanted`` is of bounded size."""
    return table.join(F.broadcast(wanted), "doc_id").toArrow().sort_by([("doc_id", "ascending"), ("content", "ascending"), ("metadata", "ascending")]).combine_chunks()


def _view(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = table.column(name).combine_chunks()
    return _unpacked(column.cast(pa.binary()) if column.type != pa.binary() else column)


def _sure(table: DataFrame, labelled: DataFrame, models: list, sure: float, most: int) -> list[tuple[int, int]]:
    """(slot, doc_id): for each slot, at most ``most`` unlabelled documents of the smallest id hashes of all that qualify.

    Slot 4 * target + 2 * view + label is of the documents for which that view's
    probability of that label is at least ``sure``. Every row of features() is scored.
    """
    shared = table.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in batches:
            views = [_unpacked(batch.column(i)) for i in (1, 2)]
            slots = np.zeros(batch.num_rows, np.int32)
            for target, pair in enumerate(shared.value):
                for v, view in enumerate(views if pair else ()):
                    p = _sigmoid(pair[v].margins(*view))
                    for label, q in ((0, 1 - p), (1, p)):
                        slots |= (q >= sure).astype(np.int32) << (4 * target + 2 * v + label)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(slots)], names=["doc_id", "slots"])

    told = table.mapInArrow(run, "doc_id long, slots int")
    with temporary():
        told = written(told.filter("slots <> 0").join(labelled, "doc_id", "left_anti"), "sure")
        lists = None
        for slot in range(4 * len(models)):
            if models[slot // 4]:
                some = told.filter(F.col("slots").bitwiseAND(1 << slot) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(F.lit(slot).alias("slot"), "doc_id")
                lists = some if lists is None else lists.unionByName(some)
        return [] if lists is None else [tuple(r) for r in lists.collect()]


def train(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, max_handed: int = MAX_HANDED, rounds: int = ROUNDS, sure: float = SURE) -> QualityModel:
    """Fit on the labelled documents of the smallest id hashes, at most ``max_labels``, and what the views hand each other.

    Texts are read once, for a table of features that all rounds use.

    Defined results: labels of one document that disagree count as low quality
    and as toxic; null labels and labels of documents that aren't there are
    ignored; every row of a repeated id is a row of the fit; a target of which
    the fit or its held-out fifth lacks a class has no model; no labels or no
    documents give no models; clashing names don't matter.
    """
    spark = docs.sparkSession
    with temporary():
        said = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).cast("int").alias("toxic"))
        said = written(said, "labels")
        known = written(said.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels), "fit-ids")
        table = written(features(docs), "features")
        got = _collected(table, known)
        if not got.num_rows:
            return QualityModel(None, None)
        views = _view(got, "content"), _view(got, "metadata")
        fits = [CoFit(views, got.column(c).to_numpy().astype(np.int64)) for c in ("quality", "toxic")]
        for _ in range(rounds):
            models = [f.fit() if f.trainable else None for f in fits]
            handed = _sure(table, said.select("doc_id"), models, sure, max_handed)
            if not handed:
                break
            ids = spark.createDataFrame([(i,) for i in sorted({i for _, i in handed})], "doc_id long")
            extra = _collected(table, ids)
            at: dict[int, list[int]] = {}
            for row, key in enumerate(extra.column("doc_id").to_pylist()):
                at.setdefault(key, []).append(row)
            found = [np.split(places, np.cumsum(counts)[:-1]) for counts, places in (_view(extra, "content"), _view(extra, "metadata"))]
            for slot, key in sorted(handed):
                other, label = 1 - slot % 4 // 2, slot % 2
                for row in at[key]:
                    fits[slot // 4].hand(other, (key, row - at[key][0]), found[other][row], label)
        return QualityModel(*(f.calibrated(f.fit()) if f.trainable else None for f in fits))


ADDED = StructType([StructField("p_quality", DoubleType()), StructField("p_toxic", DoubleType()), StructField("accepted", BooleanType())])


def scored(docs: DataFrame, model: QualityModel, least_quality: float = 0.5, most_toxic: float = 0.5) -> DataFrame:
    """The documents with all their columns and p_quality, p_toxic, accepted (columns of these names are replaced).

    Every whole text is scored. Defined results: null or empty text has no
    content features and is judged by the rest; columns lang, source or n_chars
    that are null or absent count as such; without a model (no labels, or one
    class only) the probability is null and rejects nothing; a probability right
    at a threshold is accepted as quality and rejected as toxic; repeated rows
    score alike; an empty table gives no rows; other columns of any name stay.
    """
    names = [c for c in docs.columns if c not in ADDED.names]
    docs = docs.select([F.col(f"`{c}`") for c in names])
    schema = StructType([*docs.schema, *ADDED])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    picked, at = _viewed(docs, names)

    def run(batches):
        views, m = Views(), shared.value
        for batch in batches:
            for first, content, metadata in _features(batch, views, at):
                n = len(content[0])
                quality = m.quality.probability(content, metadata) if m.quality else None
                toxic = m.toxic.probability(content, metadata) if m.toxic else None
                good = np.ones(n, bool)
                if quality is not None:
                    good &= quality >= least_quality
                if toxic is not None:
                    good &= toxic < most_toxic
                told = [pa.nulls(n, pa.float64()) if p is None else pa.array(p) for p in (quality, toxic)]
                yield pa.RecordBatch.from_arrays([*[c.slice(first, n) for c in batch.columns[: len(names)]], *told, pa.array(good)], schema=arrow)

    return docs.select(picked).mapInArrow(run, schema)
