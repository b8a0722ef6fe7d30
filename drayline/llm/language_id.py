"""Language identification by interpolated Kneser-Ney character models.

One model a language over the letters of lower-cased words, each word between
start marks and an end mark.  The grams of a bounded sample of labelled texts
are counted by Spark; a language's counts become sorted arrays of gram hashes
with their interpolated probabilities, and of context hashes with the weight
that passes to the next shorter context.  A text is given the language of least
cross-entropy per symbol.  Labelled texts that a model has not counted calibrate
how far above the usual a cross-entropy may lie; beyond that the text is
rejected.  Where labelled texts are few, all are counted, and each calibrates by
a model of the others.

The score of a word does not depend on its neighbours, so a task scores each
different word once; the cache is bounded and changes the speed only.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

ORDER = 5
#: Labelled texts counted for each language, and as many more for the calibration, on average.
SAMPLE_DOCS = 800
#: A language with no more labelled texts than both together has all of them counted; this many models, each without one part, calibrate it.
FOLDS = 4
#: Texts and different words that a task handles at a time.
TEXTS_AT_A_TIME, WORDS_AT_A_TIME = 128, 20_000
START, END = 2, 3
#: Parts of a language that is not dealt to folds.
COUNTED, MEASURED = -1, -2
#: Symbols that a model has never seen share the probability of this many.
UNSEEN = 1000
#: A text may lie this many times as far above the usual as all but one in a thousand of the calibration texts,
MARGIN = 2.0
#: and at least this far: 1.5 nats a symbol for long texts.  Mixed or odd prose stays below, letters at random lie far above.
LEAST_BOUND = 30.0
#: Symbols beyond which more text makes a cross-entropy no surer.
SURE_AFTER = 400
CACHED_WORDS = 200_000
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(map(str.isalpha, words)) or any(c.isalpha() for w in words for c in w)


def gram_hashes(columns: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of code points."""
    out = np.zeros(len(columns), dtype=np.uint64)
    for k in range(columns.shape[1]):
        out = (out + columns[:, k].astype(np.uint64) + np.uint64(1)) * _FACTOR
        out ^= out >> np.uint64(31)
    return out * _MIX


def grams_of(words: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the words, one row each, and the number of symbols of each word."""
    start, end = chr(START) * (order - 1), chr(END)
    joined = "".join([f"{start}{w}{end}" for w in words])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    at = np.flatnonzero(points != START)
    return np.lib.stride_tricks.sliding_window_view(points, order)[at - order + 1], lengths


@dataclass
class Model:
    """One language: for each order gram hashes, log probabilities, context hashes and log weights."""

    lang: str
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    #: A model that nothing has calibrated rejects no text.
    centre: float = 0.0
    bound: float = math.inf

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each gram's last symbol after the others."""
        order = grams.shape[1]
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for n in range(order, 0, -1):
            if not len(left):
                return out
            part = grams[left, order - n :]
            at = _find(self.keys[n - 1], gram_hashes(part))
            found = at >= 0
            out[left[found]] += self.logp[n - 1][at[found]]
            left = left[~found]
            context = _find(self.contexts[n - 1], gram_hashes(part[~found, :-1]))
            out[left] += np.where(context >= 0, self.weights[n - 1][np.maximum(context, 0)], 0.0)
        out[left] -= np.log(UNSEEN)
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted hash in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def build(lang: str, grams: np.ndarray, counts: np.ndarray) -> Model:
    """The model of a language from its distinct grams of full order and their counts.

    Shorter grams count the different symbols seen before them; the discount of
    each order is ``n1 / (n1 + 2 n2)`` of its counts.
    """
    order, levels = grams.shape[1], []
    current, counts = grams, counts.astype(float)
    for n in range(order, 0, -1):
        context, inverse = np.unique(gram_hashes(current[:, :-1]), return_inverse=True)
        total, kinds = np.bincount(inverse, counts), np.bincount(inverse)
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)
        weight = discount * kinds / total
        suffix, first, back = np.unique(gram_hashes(current[:, 1:]), return_index=True, return_inverse=True)
        levels.append((gram_hashes(current), np.maximum(counts - discount, 0) / total[inverse], inverse, context, weight, back))
        current, counts = current[first][:, 1:], np.bincount(back).astype(float)
    keys, logp, contexts, weights = [], [], [], []
    below = np.array([1.0 / UNSEEN])
    for hashes, direct, inverse, context, weight, back in reversed(levels):
        p = direct + weight[inverse] * below[back]
        by_hash = np.argsort(hashes)
        keys.append(hashes[by_hash])
        logp.append(np.log(p[by_hash]))
        contexts.append(context)
        weights.append(np.log(weight))
        below = p
    return Model(lang, keys, logp, contexts, weights)


def _build_summed(lang: str, grams: np.ndarray, counts: np.ndarray) -> Model:
    """``build`` where a gram may stand in several rows, in any order of rows."""
    by_gram = np.lexsort(grams.T[::-1])
    grams = grams[by_gram]
    first = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]).any(axis=1)))
    return build(lang, grams[first], np.add.reduceat(counts[by_gram], first))


class Scorer:
    """Cross-entropies of words under all models, each different word scored once."""

    def __init__(self, models: list[Model], order: int = ORDER):
        self.models, self.order = models, order
        self.known: dict[str, int] = {}
        self.table = np.empty((1024, len(models) + 1))

    def _learn(self, words: list[str]) -> None:
        grams, lengths = grams_of(words, self.order)
        _, first, inverse = np.unique(gram_hashes(grams), return_index=True, return_inverse=True)
        starts = np.cumsum(lengths) - lengths
        begin, end = len(self.known), len(self.known) + len(words)
        if end > len(self.table):
            self.table = np.concatenate([self.table[:begin], np.empty((2 * end - begin, len(self.models) + 1))])
        for k, model in enumerate(self.models):
            self.table[begin:end, k] = -np.add.reduceat(model.log_probabilities(grams[first])[inverse], starts)
        self.table[begin:end, -1] = lengths
        self.known.update(zip(words, range(begin, end), strict=True))

    def totals(self, texts: list[str | None]) -> np.ndarray:
        """For each text its nats under each model and its number of symbols, zero without a letter."""
        out = np.zeros((len(texts), len(self.models) + 1))
        for at in range(0, len(texts), TEXTS_AT_A_TIME):
            split = [words_of(t) if t else [] for t in texts[at : at + TEXTS_AT_A_TIME]]
            if len(self.known) > CACHED_WORDS:
                self.known = {}
            new = list(set().union(*split).difference(self.known))
            for k in range(0, len(new), WORDS_AT_A_TIME):
                self._learn(new[k : k + WORDS_AT_A_TIME])
            look = self.known.__getitem__
            for i, words in enumerate(split):
                if has_letter(words):
                    out[at + i] = self.table[np.fromiter(map(look, words), dtype=np.int64, count=len(words))].sum(axis=0)
        return out


def entropies(totals: np.ndarray) -> np.ndarray:
    return totals[:, :-1] / np.maximum(totals[:, -1:], 1)


def _surplus(entropy: np.ndarray, centre: float, symbols: np.ndarray) -> np.ndarray:
    """How far a cross-entropy lies above the usual, in units that allow for short texts."""
    return (entropy - centre) * np.sqrt(np.minimum(symbols, SURE_AFTER))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, order: int = ORDER) -> list[Model]:
    """Models of all languages that label a text with a letter.

    Of a language with more than ``2 * sample_docs`` such texts about as many
    are used, whole, drawn by a seeded random number: one half is counted, the
    other calibrates.  Of any other language all are counted; for the
    calibration its different texts are dealt to ``FOLDS`` parts, and each part
    is measured by a model of the other parts.  A language of a single different
    text has nothing to be measured by and rejects nothing.  What reaches the
    driver is bounded by that sample.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not sizes:
        return []
    shares = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, 2.0 * sample_docs / n)])
    drawn = rows.where(F.rand(seed=17) < shares[F.col("lang")])
    sample = drawn.select("lang", "text", F.xxhash64("text").alias("hash"), (F.rand(seed=18) < 0.5).alias("count")).persist()
    few = [lang for lang, n in sizes.items() if n <= 2 * sample_docs]

    def part_of(batch: pd.DataFrame) -> pd.Series:
        """The part of each text: a fold of a language with few texts, else ``COUNTED`` or ``MEASURED``."""
        part = np.where(batch["count"], COUNTED, MEASURED)
        for lang, at in batch.groupby("lang").indices.items():
            if lang in places:
                part[at] = np.searchsorted(places[lang], batch["hash"].to_numpy()[at]) * FOLDS // len(places[lang])
        return pd.Series(part, index=batch.index, name="part")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (lang, k), texts in batch.groupby(["lang", part_of(batch)])["text"]:
                if k == MEASURED:
                    continue
                seen: Counter[bytes] = Counter()
                for at in range(0, len(texts), TEXTS_AT_A_TIME):
                    words = [w for t in texts.iloc[at : at + TEXTS_AT_A_TIME] for w in words_of(t)]
                    if words:
                        grams = grams_of(words, order)[0]
                        _, first, times = np.unique(gram_hashes(grams), return_index=True, return_counts=True)
                        raw = np.ascontiguousarray(grams[first], dtype="<u4").view(f"V{4 * order}").ravel()
                        for gram, n in zip(raw.tolist(), times.tolist(), strict=True):
                            seen[bytes(gram)] += n
                yield pd.DataFrame({"lang": lang, "part": k, "gram": list(seen), "n": list(seen.values())})

    try:
        # the different texts of languages with few, at most 2 * sample_docs hashes each
        hashes = sample.where(F.col("lang").isin(few)).select("lang", "hash").distinct().toPandas() if few else pd.DataFrame({"lang": [], "hash": []})
        places = {lang: np.sort(x.to_numpy()) for lang, x in hashes.groupby("lang")["hash"]}
        counted = sample.mapInPandas(count, "lang string, part int, gram binary, n long").groupBy("lang", "part", "gram").agg(F.sum("n").alias("n")).toPandas()
        models: list[Model] = []
        measuring: dict[tuple[str, int], Model] = {}
        for lang, all_parts in sorted(counted.groupby("lang"), key=lambda x: x[0]):
            grams = np.frombuffer(b"".join(map(bytes, all_parts["gram"])), dtype="<u4").reshape(-1, order)
            parts, times = all_parts["part"].to_numpy(), all_parts["n"].to_numpy()
            models.append(_build_summed(lang, grams, times))
            if lang not in places:
                measuring[lang, MEASURED] = models[-1]
            elif len(np.unique(parts)) > 1:
                for k in np.unique(parts).tolist():
                    measuring[lang, k] = _build_summed(lang, grams[parts != k], times[parts != k])
        place = {m.lang: i for i, m in enumerate(models)}
        shared = labelled.sparkSession.sparkContext.broadcast(measuring)

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorers = {key: Scorer([model], order) for key, model in shared.value.items()}
            for batch in batches:
                for key, texts in batch.groupby(["lang", part_of(batch)])["text"]:
                    if key in scorers:
                        totals = scorers[key].totals(texts.tolist())
                        totals = totals[totals[:, -1] > 0]
                        yield pd.DataFrame({"lang": key[0], "entropy": entropies(totals)[:, 0], "symbols": totals[:, -1]})

        measured = sample.mapInPandas(measure, "lang string, entropy double, symbols double").toPandas()
    finally:
        sample.unpersist()
    for lang, part in measured.groupby("lang"):
        model = models[place[lang]]
        model.centre = float(part["entropy"].median())
        surplus = _surplus(part["entropy"].to_numpy(), model.centre, part["symbols"].to_numpy())
        model.bound = max(MARGIN * float(np.quantile(surplus, 0.999)), LEAST_BOUND)
    return models


def predict(docs: DataFrame, models: list[Model], text_col: str = "text", order: int = ORDER) -> DataFrame:
    """The input's columns, then ``lang_pred``, ``score``, ``cross_entropy`` (nats a symbol) and ``rejected``.

    A null text or one without a letter is ``und`` with score 0 and rejected.
    ``score`` is the weight of the chosen language among all under the text's
    own length, at most ``SURE_AFTER`` symbols of it.  ``rejected`` tells that
    even the chosen model finds the text far less likely than texts of its
    language are.  Ties go to the first language in order.  Rows are judged
    alone, so repeated rows and ids get equal results; an empty table gives an
    empty result.  Input columns named like a result column are left out.
    """
    made = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("cross_entropy", T.DoubleType()), ("rejected", T.BooleanType())]
    names = [c for c in docs.columns if c not in [n for n, _ in made]]
    at = names.index(text_col)
    plain = docs.select(*names).toDF(*[f"c{i}" for i in range(len(names))])
    schema = T.StructType([*plain.schema.fields, *[T.StructField(f"o{i}", t) for i, (_, t) in enumerate(made)]])
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        scorer = Scorer(models, order)  # of this task alone: an idle worker keeps nothing
        langs = np.array([*[m.lang for m in models], UNDETERMINED], dtype=object)
        for batch in batches:
            totals = scorer.totals(batch.column(at).to_pylist())
            seen = totals[:, -1] > 0
            entropy = entropies(totals)
            if models:
                best = entropy.argmin(axis=1)
                least = entropy[np.arange(len(totals)), best]
                sure = np.minimum(totals[:, -1:], SURE_AFTER)
                score = 1.0 / np.exp(-(entropy - least[:, None]) * sure).sum(axis=1)
                centre, bound = (np.array([getattr(m, n) for m in models])[best] for n in ("centre", "bound"))
                far = (least - centre) * np.sqrt(np.minimum(totals[:, -1], SURE_AFTER)) > bound
            else:
                best, least, score, far = (np.zeros(len(totals), dtype=k) for k in (int, float, float, bool))
            columns = [
                pa.array(langs[np.where(seen, best, len(models))], pa.string()),
                pa.array(np.where(seen, score, 0.0)),
                pa.array(np.where(seen, least, 0.0), mask=~seen),
                pa.array(far | ~seen),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[f.name for f in schema])

    judged = plain.mapInArrow(judge, schema)
    return judged.toDF(*names, *[n for n, _ in made])
