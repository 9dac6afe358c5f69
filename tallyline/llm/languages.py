"""Language identification in two steps: the family first, then the languages within it.

Texts are lower-cased; what is not a letter becomes a space. The features are the relative frequencies of the byte
sequences of two, three and four bytes, hashed into tables of fixed size. Linear support vector machines, one for each
pair of families and one for each pair of languages in a family, vote (one-versus-one); scores come from the margins of
the winner's votes, scaled on training passages.

The machines are fitted on a bounded sample of labelled documents, and predictions are a function of the text alone, row
by row, with tables of a size that depends on the number of languages only.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import SLICE_BYTES, narrow

UNDETERMINED = "und"
#: Families by language code. Fixed values. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("ar", "he", "mt"),
}
#: Labelled documents of each language that the machines are fitted on at most: those whose texts have the least hashes.
SAMPLE_DOCUMENTS = 1500
#: Passages that are taken of each sampled document, their lengths in words, and their longest size in bytes.
PASSAGES, PASSAGE_WORDS, PASSAGE_BYTES = 4, (4, 10, 25, 60), 2000
ORDERS, BUCKETS = (2, 3, 4), 1 << 15
EPOCHS, BATCH, PENALTY = 8, 64, 1e-5
NOT_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
#: Weights are whole multiples of one in so many: their sums do not depend on the order in which they are added.
FIXED = 1 << 20
_MODELS: dict[str, "Model"] = {}


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters, a space before and after each; empty without a letter (Unicode category L)."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    return b" " + b" ".join(text.lower().encode().translate(NOT_LETTERS).split()) + b" "


def hashed(data: bytes) -> list[np.ndarray]:
    """Of each order the table place of the sequence that starts at each byte."""
    b = np.frombuffer(data + bytes(max(ORDERS)), np.uint8).astype(np.uint32)
    out, h = [], b[:-1] * np.uint32(0x01000193)
    for order in range(2, max(ORDERS) + 1):
        h = (h[: len(b) - order] ^ b[order - 1 : len(b) - 1]) * np.uint32(0x01000193)
        if order in ORDERS:
            out.append(((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1))[: len(data)].astype(np.intp))
    return out


@dataclass
class Machine:
    """Decides between two classes: a positive margin means the first."""

    first: str
    second: str
    weights: np.ndarray
    bias: float
    slope: float


@dataclass
class Model:
    families: dict[str, list[str]]
    between: list[Machine] = field(default_factory=list)
    within: dict[str, list[Machine]] = field(default_factory=dict)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text; ``und`` and 0 without a letter, or if no language was learned."""
        data = [letters(t) for t in texts]
        known = [i for i, d in enumerate(data) if d and self.families]
        out = [(UNDETERMINED, 0.0)] * len(texts)
        if not known:
            return out
        machines = [*self.between, *(m for own in self.within.values() for m in own)]
        margins = dict(zip(map(id, machines), _margins([data[i] for i in known], machines), strict=True))
        for k, i in enumerate(known):
            family, sure = _voted(sorted(self.families), self.between, margins, k)
            lang, surer = _voted(self.families[family], self.within.get(family, []), margins, k)
            out[i] = lang, sure * surer
        return out


def _voted(classes: list[str], machines: list[Machine], margins: dict[int, np.ndarray], k: int) -> tuple[str, float]:
    """The class with most votes, of several the one with the greatest sum of probabilities, then the first by name; its
    score is its least probability against another."""
    votes, total, least = dict.fromkeys(classes, 0), dict.fromkeys(classes, 0.0), dict.fromkeys(classes, 1.0)
    for m in machines:
        p = float(1 / (1 + np.exp(-np.clip(m.slope * margins[id(m)][k], -30, 30))))
        for c, q in ((m.first, p), (m.second, 1 - p)):
            votes[c] += q > 0.5 or (q == 0.5 and c == m.first)
            total[c] += q
            least[c] = min(least[c], q)
    best = max(classes, key=lambda c: (votes[c], total[c]))
    return best, least[best]


def _margins(data: list[bytes], machines: list[Machine]) -> list[np.ndarray]:
    """Zero bytes stand between the texts, so that a sequence of one never reaches into the next, as in training."""
    gap = bytes(max(ORDERS))
    sizes = np.array([len(d) for d in data])
    starts = np.concatenate([[0], np.cumsum(sizes + len(gap))[:-1]])
    spans = np.stack([starts, starts + sizes], 1).ravel()
    places = hashed(gap.join([*data, b""]))
    out = []
    for m in machines:
        total = sum(np.add.reduceat(m.weights[order][at], spans, dtype=np.int64)[::2] for order, at in enumerate(places))
        out.append(m.bias + total / (FIXED * sizes))
    return out


def _fit(first: str, second: str, passages: list[bytes], signs: np.ndarray, seed: int) -> Machine:
    """A linear support vector machine by averaged stochastic subgradient steps on the squared hinge loss."""
    weights = np.zeros(len(ORDERS) * BUCKETS)
    mean, bias, mean_bias, steps = np.zeros_like(weights), 0.0, 0.0, 0
    order = np.random.default_rng(seed)
    rows, owners, sizes = [], [], np.array([len(p) for p in passages])
    for p in passages:
        rows.append(np.concatenate([at + k * BUCKETS for k, at in enumerate(hashed(p))]))
    for epoch in range(EPOCHS):
        shuffled = order.permutation(len(passages))
        for at in range(0, len(shuffled), BATCH):
            picked = shuffled[at : at + BATCH]
            columns = np.concatenate([rows[i] for i in picked])
            lengths = np.array([len(rows[i]) for i in picked])
            begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            margin = np.add.reduceat(weights[columns], begins) / sizes[picked] + bias
            lack = np.maximum(0, 1 - signs[picked] * margin) * signs[picked]
            rate = 20.0 / (1 + epoch)
            weights *= 1 - rate * PENALTY
            weights += rate * np.bincount(columns, np.repeat(lack / sizes[picked], lengths), len(weights)) / len(picked)
            bias += 0.05 * lack.mean() / (1 + epoch)
            if epoch >= EPOCHS // 2:
                steps += 1
                mean += (weights - mean) / steps
                mean_bias += (bias - mean_bias) / steps
    machine = Machine(first, second, np.rint(mean * FIXED).astype(np.int32).reshape(len(ORDERS), BUCKETS), mean_bias, 1.0)
    margin = _margins(passages, [machine])[0] * signs
    machine.slope = min((1.0, 2.0, 3.0, 4.0, 6.0, 8.0), key=lambda s: float(np.logaddexp(0, -s * margin).mean()))
    return machine


def sample(labelled: DataFrame, text: str, lang: str, documents: int = SAMPLE_DOCUMENTS) -> list[tuple[str, bytes]]:
    """(language, passage) of at most ``documents`` labelled documents of each language, in a fixed order."""
    rows = narrow(labelled, text=text, lang=lang).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    # hashes are even: this share of a language's texts is a little more than the sample
    shares = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 1.3 * documents / n + 50 / n))])
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / float(1 << 40)

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, places, texts = [], [], []
            for lang, place, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                langs.append(lang)
                places.append(place)
                texts.append(_passages(letters(text)))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(places, pa.float64()), pa.array(texts, pa.list_(pa.binary()))], ["lang", "place", "passages"])

    picked = rows.withColumn("place", place).where(F.col("place") < shares[F.col("lang")]).select("lang", "place", "text")
    found = picked.mapInArrow(passages, "lang string, place double, passages array<binary>").distinct().collect()
    out = []
    for lang in sorted(counts):
        own = sorted((r["place"], r["passages"]) for r in found if r["lang"] == lang)[:documents]
        out += [(lang, bytes(p)) for _, passages in own for p in passages]
    return out


def _passages(data: bytes) -> list[bytes]:
    """Passages of several lengths from places that the text's own checksum picks."""
    words, out = data.split(), []
    for k, n in enumerate(PASSAGE_WORDS[:PASSAGES] if words else ()):
        start = zlib.crc32(data, k) % max(1, len(words) - n + 1)
        out.append(b" " + b" ".join(words[start : start + n])[:PASSAGE_BYTES] + b" ")
    return sorted(set(out))


def family_of(lang: str) -> str:
    return next((family for family, codes in FAMILIES.items() if lang in codes), lang)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Fitted on the labelled documents given (null labels and null texts are passed over). With one language alone it is
    predicted for every text with a letter; with none, nothing is."""
    passages = sample(labelled, text, lang, documents)
    langs = sorted({lang for lang, _ in passages})
    families: dict[str, list[str]] = {}
    for one in langs:
        families.setdefault(family_of(one), []).append(one)

    def pairs(classes: list[str], name) -> list[Machine]:
        out = []
        for seed, (a, b) in enumerate(combinations(classes, 2)):
            own = [(p, 1.0 if name(one) == a else -1.0) for one, p in passages if name(one) in (a, b)]
            out.append(_fit(a, b, [p for p, _ in own], np.array([s for _, s in own]), seed))
        return out

    return Model(families, pairs(sorted(families), family_of), {f: pairs(own, lambda one: one) for f, own in families.items()})


def predicted(model: Model, spark, text: Column) -> Column:
    """lang and score of a text as a struct.

    Null texts and texts without a letter are ``und`` with score 0. Votes that tie go to the greater sum of probabilities,
    then to the first name. Prediction is by row: repeated rows, null keys and other columns are nothing to it.
    """
    shared, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    def each(texts: pa.Array) -> pa.Array:
        if name not in _MODELS:
            _MODELS.clear()
            _MODELS[name] = shared.value
        out, held, size = [], [], 0
        for one in texts.to_pylist():
            held.append(one)
            size += len(one or "")
            if size > SLICE_BYTES // 4:
                out += _MODELS[name].predict(held)
                held, size = [], 0
        out += _MODELS[name].predict(held)
        return pa.StructArray.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())], ["lang", "score"])

    return F.arrow_udf(each, "struct<lang:string,score:double>", F.ArrowUDFType.SCALAR)(text)
