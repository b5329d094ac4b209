"""Language ID by interpolated Kneser-Ney character language models.

One model per language over runs of letters (lower case, everything else one blank).
Counts of the highest order come from Spark; lower orders use continuation counts
(number of distinct characters seen before), discounts follow from counts of counts.
Interpolated probabilities of all seen n-grams and the backoff weights of all contexts are
stored in sorted arrays of 64-bit hashes with one column per language, looked up by
binary search. A text gets the language of lowest cross-entropy per character.

Rejection is calibrated on the sampled rows that are kept out of the counts (one of
``CALIBRATE``, where a language has ``CALIBRATE_FROM`` at least): a text is rejected when its cross-entropy exceeds its language's median there
by more than ``REJECT_MARGIN`` times the 99.9 % quantile of the length-scaled excess; a language
without such rows rejects nothing.

The fit uses a bounded sample: of each language the ``fit_rows`` distinct texts with a letter whose
hashes are lowest, or all; where they have more than ``fit_chars`` characters together, a piece
of each longer one (of one length per language, from a place given by the hash). That bounds
the n-grams collected and sent to the tasks. Scoring reads every whole text.

Cases: a text that is null or has no letter is ``und`` with score 0 and is rejected; ties go
to the first language by name; repeated rows score alike; rows of null language or id are
not learned from; with no row to learn from everything is ``und``; an empty table gives no
rows; extra columns are carried, those named like a result column are replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from voltlens.llm.common import annotate, materialize, pick, position, slices

ORDER = 5
REJECT_MARGIN = 3.0
#: One of so many sampled rows calibrates.
CALIBRATE = 5
#: Sampled rows from which a language spares some for that.
CALIBRATE_FROM = 10
#: Characters below which the spread of a text's cross-entropy is taken to shrink with length.
SETTLED = 400
UNKNOWN = "und"
#: Characters handled at once; arrays of some 150 bytes a character exist meanwhile.
SLICE_CHARS = 1 << 19
BLANK = 32


@lru_cache(1)
def character_table() -> np.ndarray:
    """Code point -> lower-case code point for letters (category L), blank for the rest."""
    table = np.full(0x110000, BLANK, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def symbols(texts: list[str | None], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters of all texts, each led by ``pad`` blanks; the places of its own
    characters and how many each text has (0 without any letter)."""
    table, parts, counts = character_table(), [], np.zeros(len(texts), np.int64)
    lead = np.full(pad, BLANK, np.uint32)
    for i, t in enumerate(texts):
        a = table[np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
        if len(a):
            a = a[(a != BLANK) | np.concatenate([[True], a[:-1] != BLANK])]
            if len(a) == 1 and a[0] == BLANK:
                a = a[:0]  # no letter
        counts[i] = len(a)
        parts += [lead, a]
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    own = np.arange(counts.sum()) + pad * (np.repeat(np.arange(len(counts)), counts) + 1)
    return flat, own, counts


MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                      0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def hash_grams(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points."""
    h = np.zeros(len(grams), np.uint64)
    for j in range(grams.shape[1]):
        h += (grams[:, j].astype(np.uint64) + np.uint64(1)) * MULTIPLIERS[grams.shape[1] - 1 - j]
    return h ^ (h >> np.uint64(32))


def rolled_hashes(flat: np.ndarray, own: np.ndarray) -> np.ndarray:
    """``hash_grams`` of the n-gram of highest order that ends at each place."""
    h = np.zeros(len(own), np.uint64)
    for j in range(ORDER):
        h += (flat[own - j].astype(np.uint64) + np.uint64(1)) * MULTIPLIERS[j]
    h ^= h >> np.uint64(32)
    return h


def grams_at(flat: np.ndarray, places: np.ndarray) -> np.ndarray:
    return flat[places[:, None] + np.arange(1 - ORDER, 1)]


def count_grams(rows: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` of all n-grams of the highest order; rows have lang and text."""

    def run(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own_texts = [t for t, l in zip(texts, langs) if l == lang]
                for lo, hi in slices([len(t) for t in own_texts], SLICE_CHARS):
                    flat, own, _ = symbols(own_texts[lo:hi], ORDER - 1)
                    _, first, n = np.unique(rolled_hashes(flat, own), return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "lang": [lang] * len(first), "n": n.tolist(),
                        "gram": ["".join(map(chr, g)) for g in grams_at(flat, own[first]).tolist()]})

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, n long, gram string")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def unique_grams(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first, inverse = np.unique(hash_grams(grams), return_index=True, return_inverse=True)
    return grams[first], inverse


def discounted(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Discounted share of every gram in its context, the contexts and their backoff weights."""
    n1, n2 = (counts == 1).sum(), (counts == 2).sum()
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    contexts, inverse = unique_grams(grams[:, :-1])
    total = np.bincount(inverse, weights=counts)
    kinds = np.bincount(inverse)
    return (counts - d) / total[inverse], contexts, d * kinds / total


def fit_language(grams: np.ndarray, counts: np.ndarray, alphabet: int) -> tuple[list, list, float]:
    """Per order the grams with log probabilities and the contexts with log backoff weights,
    and the log probability of an unseen character."""
    by_order = [(grams, counts.astype(np.float64))]
    while by_order[0][0].shape[1] > 1:  # continuation counts: distinct grams that end alike
        tails, inverse = unique_grams(by_order[0][0][:, 1:])
        by_order.insert(0, (tails, np.bincount(inverse).astype(np.float64)))
    seen, backoffs, lower = [], [], None
    unseen = 0.0
    for g, c in by_order:
        share, contexts, weight = discounted(g, c)
        context_of = np.searchsorted(np.sort(hash_grams(contexts)), hash_grams(g[:, :-1]))
        weight_sorted = weight[np.argsort(hash_grams(contexts))]
        if lower is None:
            unseen = float(weight_sorted[0] / alphabet) if len(weight_sorted) else 1 / alphabet
            p = share + unseen
        else:
            keys, lp = lower
            p = share + weight_sorted[context_of] * lp[np.searchsorted(keys, hash_grams(g[:, 1:]))]
        h = hash_grams(g)
        order = np.argsort(h)
        lower = (h[order], p[order])
        seen.append((h[order], np.log(p[order])))
        hc = hash_grams(contexts)
        backoffs.append((np.sort(hc), np.log(weight[np.argsort(hc)])))
    return seen, backoffs, float(np.log(unseen))


class Model:
    """All languages' models in shared sorted hash arrays."""

    def __init__(self, languages: list[str], fitted: list[tuple[list, list, float]]):
        self.languages = languages
        self.unseen = np.array([f[2] for f in fitted], np.float32)
        self.grams = [self.shared([f[0][k] for f in fitted], np.nan) for k in range(ORDER)]
        self.contexts = [self.shared([f[1][k] for f in fitted], 0.0) for k in range(ORDER)]
        self.median = np.zeros(len(languages))
        self.excess = np.full(len(languages), np.inf)

    @staticmethod
    def shared(parts: list[tuple[np.ndarray, np.ndarray]], missing: float) -> tuple[np.ndarray, np.ndarray]:
        keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in parts)]))
        values = np.full((len(keys), len(parts)), missing, np.float32)
        for j, (k, v) in enumerate(parts):
            values[np.searchsorted(keys, k), j] = v
        return keys, values

    @staticmethod
    def look(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: np.ndarray | float) -> np.ndarray:
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return np.where((table[0][at] == keys)[:, None], table[1][at], missing)

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Of the last character given those before it: grams x languages."""
        out = np.broadcast_to(self.unseen, (len(grams), len(self.languages)))
        for k in range(ORDER):
            g = grams[:, ORDER - 1 - k:]
            seen = self.look(self.grams[k], hash_grams(g), np.nan)
            weight = self.look(self.contexts[k], hash_grams(g[:, :-1]), 0.0) if k else 0.0
            out = np.where(np.isnan(seen), out + weight, seen)
        return out.astype(np.float32)


class Scorer:
    """Scores texts; the last looked-up n-grams are kept in a table of fixed size."""

    def __init__(self, model: Model):
        self.model = model
        self.bits = max(10, 22 - int(np.ceil(np.log2(max(len(model.languages), 1)))))
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.zeros((1 << self.bits, len(model.languages)), np.float32)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts x languages, nan without letters) and characters."""
        flat, own, counts = symbols(texts, ORDER - 1)
        out = np.full((len(texts), len(self.model.languages)), np.nan)
        if not len(own) or not self.model.languages:
            return out, counts
        rolled = rolled_hashes(flat, own)
        slot = ((rolled * MULTIPLIERS[1]) >> np.uint64(64 - self.bits)).astype(np.int64)
        values = self.values[slot]
        new = np.flatnonzero(self.keys[slot] != rolled)
        if len(new):
            keys, first, inverse = np.unique(rolled[new], return_index=True, return_inverse=True)
            looked = self.model.log_probabilities(grams_at(flat, own[new[first]]))
            values[new] = looked[inverse]
            at = slot[new[first]]
            self.keys[at], self.values[at] = keys, looked
        some = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
        out[some] = -np.add.reduceat(values, starts, axis=0, dtype=np.float64) / counts[some, None]
        return out, counts

    def predict(self, texts: list[str | None]) -> tuple[list, list, list, list]:
        """Language, score, rejected and cross-entropy of every text."""
        entropy, counts = self.entropies(texts)
        lang, score, rejected, best = [], [], [], []
        for e, n in zip(entropy, counts):
            if not len(e) or np.isnan(e[0]):
                lang.append(UNKNOWN), score.append(0.0), rejected.append(True), best.append(None)
                continue
            k = int(np.argmin(e))
            lang.append(self.model.languages[k])
            score.append(float(1 / np.exp(-(e - e[k]) * min(n, 100)).sum()))
            excess = (e[k] - self.model.median[k]) / np.sqrt(1 / n + 1 / SETTLED)
            rejected.append(bool(excess > REJECT_MARGIN * self.model.excess[k]))
            best.append(float(e[k]))
        return lang, score, rejected, best


def learned(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def piece_length(sizes: list[int], total: int) -> int:
    """Largest length such that pieces of at most that length have ``total`` characters together."""
    left = sorted(sizes)
    for k, n in enumerate(left):
        if n * (len(left) - k) > total:
            return max(1, total // (len(left) - k))
        total -= n
    return left[-1]


def draw(rows: DataFrame, fit_rows: int, fit_chars: int) -> DataFrame:
    """``(lang, text, counts)``: the sample; rows have lang and text."""
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.xxhash64(F.lit(6), "text").alias("h"))
    texts = materialize(rows.groupBy("lang", "h").agg(F.max(F.length("text")).alias("chars")), "langid_texts")
    below = F.lit(None).cast("long")
    for r in texts.groupBy("lang").agg(F.count("*").alias("n")).collect():
        some = fit_rows + 6 * fit_rows ** 0.5 + 10  # hashes below hold fit_rows texts, all but surely
        edge = (1 << 63) - 1 if r.n <= some else int(some / r.n * (1 << 64)) - (1 << 63)
        below = F.when(F.col("lang") == r.lang, F.lit(edge)).otherwise(below)
    lowest: dict[str, list] = {}
    for r in texts.where(F.col("h") <= below).toLocalIterator():
        lowest.setdefault(r.lang, []).append((r.h, r.chars))
    drawn = []
    for lang, own in sorted(lowest.items()):
        own = sorted(own)[:fit_rows]
        longest = piece_length([n for _, n in own], fit_chars)
        for k, (h, n) in enumerate(own):
            size = min(n, longest)
            counts = len(own) < CALIBRATE_FROM or k % CALIBRATE > 0
            drawn.append((lang, h, 1 + h % (n - size + 1), size, counts))
    chosen = rows.sparkSession.createDataFrame(drawn, "lang string, h long, first int, size int, counts boolean")
    piece = F.substring("text", F.col("first"), F.col("size"))
    sample = rows.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "h", piece.alias("text"), "counts")
    return materialize(sample.dropDuplicates(["lang", "h"]).select("lang", "text", "counts"), "langid")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = 1200, fit_chars: int = 3_000_000) -> Model:
    rows = pick(docs, {"doc_id": id_col, "text": text_col, "lang": lang_col})
    rows = rows.where(learned(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = draw(rows, fit_rows, fit_chars)
    grams: dict[str, tuple[list, list]] = {}
    for r in count_grams(sample.where("counts")).toLocalIterator():
        g, n = grams.setdefault(r.lang, ([], []))
        g.append(r.gram), n.append(r.n)
    languages = sorted(grams)
    if not languages:
        return Model([], [])
    codes = {k: np.frombuffer("".join(g).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER)
             for k, (g, _) in grams.items()}
    alphabet = len(np.unique(np.concatenate([np.unique(c) for c in codes.values()]))) + 1
    model = Model(languages, [fit_language(codes[k], np.array(grams[k][1]), alphabet) for k in languages])
    calibrate(model, sample.where("not counts"))
    return model


def calibrate(model: Model, rows: DataFrame) -> None:
    """Median cross-entropy and 99.9 % excess per language, on rows that were not counted."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(sent.value)

        def work(texts):
            e, n = scorer.entropies(texts)
            return [e.tolist(), n.tolist()]

        return work

    fields = [T.StructField("e", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType())]
    scored = annotate(rows, "text", fields, make, keep=["lang"], limit=SLICE_CHARS).where("n > 0").collect()
    for k, lang in enumerate(model.languages):
        own = np.array([(r.e[k], r.n) for r in scored if r.lang == lang]).reshape(-1, 2)
        if len(own):
            model.median[k] = np.median(own[:, 0])
            excess = (own[:, 0] - model.median[k]) / np.sqrt(1 / own[:, 1] + 1 / SETTLED)
            model.excess[k] = max(float(np.quantile(excess, 0.999)), 1.0)


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("rejected", T.BooleanType()), T.StructField("cross_entropy", T.DoubleType())]


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep=None) -> DataFrame:
    """Append ``lang_pred``, ``score``, ``rejected`` and ``cross_entropy`` (nats per character)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(sent.value)
        return lambda texts: list(scorer.predict(texts))

    return annotate(docs, text_col, FIELDS, make, keep, SLICE_CHARS)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, with their columns as they are."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    marked = predict(docs.toDF(*names), model, names[position(docs, text_col)])
    return marked.where(~F.col("rejected")).select(*names).toDF(*docs.columns)
