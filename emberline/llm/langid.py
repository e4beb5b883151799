"""Language identification by error-correcting output codes.

Each language has a codeword; a binary classifier over hashed character n-grams is trained for each bit. A text is
read as the language whose codeword loses least against the classifiers' margins, each weighted by how well it does on
that language in training. A text whose two best codewords are close is flagged as ambiguous.

The model is fitted on the driver from a sample of at most `per_language` labelled texts of each language; prediction
runs over whole texts in Arrow batches, without a shuffle.
"""

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from emberline.llm.texts import add_columns

UNKNOWN = "und"


@dataclass(frozen=True)
class Training:
    """Bounds and settings of a fit. `per_language` texts are drawn by a hash of the text, none is cut."""

    per_language: int = 300
    buckets: int = 1 << 14
    rounds: int = 300
    l2: float = 1e-4
    seed: int = 7
    # A text is ambiguous if the two nearest codewords lie less than this apart, in weighted loss a bit: halves of two
    # languages do as a rule, a text in one language with words of another does not.
    least_gap: float = 0.45


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    codes: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray  # bits
    trust: np.ndarray  # languages x bits, rows sum to the number of bits
    settings: Training


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(text: str, buckets: int, window: int = 1 << 20) -> tuple[np.ndarray, bool]:
    """Counts of hashed 1- to 3-grams over letters and single gaps, and whether there is a letter.

    A very long text is taken in windows that overlap by two characters, so that memory stays bounded.
    """
    counts = np.zeros(buckets, np.float32)
    any_letter = False
    low = text.lower()
    mask = np.uint32(buckets - 1)
    for at in range(0, max(1, len(low)), window):
        part = low[max(0, at - 2) : at + window] if at else low[:window]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        any_letter |= bool(letter.any())
        codes = np.where(letter, points, np.uint32(32))
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        codes = codes[keep]
        if not len(codes):
            continue
        one = codes * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (codes[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
        three = (two[:-1] ^ (codes[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
        shift = np.uint32(15)
        for grams in (one, two, three):
            counts += np.bincount(((grams ^ (grams >> shift)) & mask).astype(np.int64), minlength=buckets)
    return counts, any_letter


def features(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of square roots of n-gram counts at length 1, and whether each text has a letter."""
    rows, known = np.zeros((len(texts), buckets), np.float32), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        if text:
            rows[i], known[i] = _grams(text, buckets)
    np.sqrt(rows, out=rows)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    return rows, known


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of -1 and 1. Few languages get the exhaustive code, more a random one with well-spread rows."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        # Every way to split the languages in two, once: the first is always on the side of 1.
        splits = [c for size in range(1, n) for c in combinations(range(n), size) if 0 in c]
        codes = -np.ones((n, len(splits)))
        for bit, members in enumerate(splits):
            codes[list(members), bit] = 1
        return codes
    rng, bits, best, far = np.random.default_rng(seed), max(15, int(np.ceil(10 * np.log2(n)))), None, -1
    for _ in range(200):
        codes = rng.choice([-1.0, 1.0], size=(n, bits))
        gaps = (bits - codes @ codes.T) / 2 + bits * np.eye(n)
        if gaps.min() > far and (np.abs(codes.sum(0)) < n).all():
            best, far = codes, gaps.min()
    return best


def fit(texts: list[str], labels: list[str], settings: Training = Training()) -> Model:
    """One logistic classifier per bit by full gradient steps with momentum, then its accuracy per language."""
    languages = tuple(sorted(set(labels)))
    codes = codewords(len(languages), settings.seed)
    bits = codes.shape[1]
    x, _ = features(texts, settings.buckets)
    y = np.array([languages.index(v) for v in labels], int)
    target = codes[y].astype(np.float32)
    # Languages weigh alike however many texts each has.
    share = (1.0 / np.bincount(y, minlength=len(languages)))[y].astype(np.float32) / max(1, len(languages)) if len(y) else y
    # The weights are sums of the sample's rows, so the steps are taken on the rows' shares: the texts meet only in
    # their products, and a step costs rows x rows instead of rows x buckets.
    products = x @ x.T
    part, b = np.zeros((len(x), bits), np.float32), np.zeros(bits, np.float32)
    v, vb = np.zeros_like(part), np.zeros_like(b)
    for _ in range(settings.rounds if len(languages) > 1 else 0):
        slope = -target / (1 + np.exp(target * (products @ part + b))) * share[:, None]
        v = 0.9 * v + (slope + settings.l2 * part)
        vb = 0.9 * vb + slope.sum(0)
        part -= 2.0 * v
        b -= 2.0 * vb
    w = x.T @ part
    right = (np.sign(products @ part + b) == target).astype(float)
    trust = np.array([right[y == i].mean(0) if (y == i).any() else np.ones(bits) for i in range(len(languages))])
    trust = trust.reshape(len(languages), bits)
    trust *= bits / np.maximum(trust.sum(1, keepdims=True), 1e-9)
    return Model(languages, codes, w, b, trust, settings)


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language by loss-weighted decoding, its probability, and how much farther the next codeword is, a bit."""
    loss = np.logaddexp(0, -model.codes[None] * margins[:, None, :])
    loss = (loss * model.trust[None]).sum(2)
    best = loss.argmin(1)
    least = loss[np.arange(len(best)), best]
    odds = np.exp(-(loss - least[:, None]))
    loss[np.arange(len(best)), best] = np.inf
    return best, 1 / odds.sum(1), (loss.min(1) - least) / model.codes.shape[1]


def predict(model: Model, texts: list[str | None]) -> list[list]:
    """lang_pred, score, ambiguous."""
    langs, scores, unsure = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
    if not model.languages:
        return [langs, scores, unsure]
    for at in range(0, len(texts), 256):  # bounds the feature rows
        part = texts[at : at + 256]
        x, known = features(part, model.settings.buckets)
        best, top, gap = decode(model, (x @ model.weights + model.bias).astype(float))
        for i in np.flatnonzero(known):
            langs[at + i] = model.languages[best[i]]
            scores[at + i] = float(min(1.0, top[i]))
            unsure[at + i] = bool(gap[i] < model.settings.least_gap)
    return [langs, scores, unsure]


def sample(labelled: DataFrame, settings: Training = Training()) -> tuple[list[str], list[str]]:
    """At most `per_language` distinct texts with their labels: those of least hash, so the same ones on every run.

    Hashes alone are ranked: copies fold before the shuffle, and a task passes on no more hashes of a language than
    are taken. The chosen texts are then fetched by their hashes.
    """
    rows = labelled.select("lang", "text").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("_hash", F.xxhash64(F.lit(settings.seed), "text"))
    place = F.row_number().over(W.partitionBy("lang").orderBy("_hash"))
    chosen = rows.select("lang", "_hash").distinct().withColumn("_place", place)
    chosen = chosen.filter(F.col("_place") <= settings.per_language).select("lang", "_hash")
    # At most `per_language` rows a language: a bound that is set, so they may be sent to all tasks.
    texts = rows.join(F.broadcast(chosen), ["lang", "_hash"]).groupBy("lang", "_hash").agg(F.min("text").alias("text"))
    found = sorted((r["lang"], r["text"]) for r in texts.select("lang", "text").collect())
    return [t for _, t in found], [v for v, _ in found]


def train(labelled: DataFrame, settings: Training = Training()) -> Model:
    return fit(*sample(labelled, settings), settings)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with lang_pred, score (0 to 1) and ambiguous; only the text is looked at.

    A text that is null, empty or without a letter is `und` with score 0, and so is every text if the model has seen
    no language. Repeated rows come out alike; an empty table stays empty. Columns of these names are replaced.
    """
    fields = [
        StructField("lang_pred", StringType(), False),
        StructField("score", DoubleType(), False),
        StructField("ambiguous", BooleanType(), False),
    ]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is set by the settings, not by the data

    def compute(texts: pa.Array) -> list[list]:
        return predict(shared.value, texts.to_pylist())

    return add_columns(docs, "text", fields, compute)
